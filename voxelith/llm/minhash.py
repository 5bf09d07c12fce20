"""Near-dedup by HyperMinHash.

1. sketch: the set of a document's word shingles is hashed into BUCKETS buckets; of each bucket's smallest
   hash the count of leading zeros and MANTISSA following bits are kept, two bytes. Documents with the same
   set form a class, and only one of each class goes on.
2. bands: six registers at a time (an empty bucket borrows from another one, the same for the same occupied
   buckets) give a key; documents of similarity 0.8 share one of the 42 keys but for 3 in a million.
3. star: within a key each document is compared with the hub, the one with the most neighbours overall. A pair
   goes to verification unless its collision-corrected estimate is far below the threshold; verification
   compares the full sets. Groups of copies so cost a pair for each member, not each pair.
4. across: where the links found leave the documents of a key in several components, those outside the key's
   largest one are compared with all documents of the key, by their registers and in blocks of bounded size.
   Components with a pair that may be a link form a cluster; of a block only the pairs that it takes to join
   them leave.
5. rest: in a cluster of several components the documents outside the largest one are compared with all of the
   cluster, by full sets and in blocks of bounded bytes: an inverted list of a block's shingles gives all
   intersections with it at once, and only links leave. So no link between documents that share a key is lost:
   two documents are in one component, estimated far below the threshold, or compared in full.
6. connected components over all links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelith.operators.components import components

from .common import Scratch, short_batches, small, worker_state
from .wordbpe import Numbers, portions

BANDS, PER_BAND = 42, 6
BUCKETS = BANDS * PER_BAND
MANTISSA = 10
EMPTY = 0xFFFF
#: Standard errors below the threshold at which an estimate still goes to verification.
SLACK = 4.5
#: Documents of a key that are compared at once with as many others; of a very large key, and the size from which one is.
BLOCK, LARGE_BLOCK, LARGE = 2_048, 8_192, 1 << 18
#: Documents of small keys that go to Python as one group.
AT_ONCE = 20_000
#: Bytes of the texts that are compared in full at once with as many others.
BLOCK_BYTES = 8_000_000
CACHED_WORDS = 200_000

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of x moves every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


#: Preference of each bucket for each other one when it borrows.
_BORROW = mix(np.arange(1, BUCKETS * BUCKETS + 1, dtype=np.uint64)).reshape(BUCKETS, BUCKETS)


class Shingler:
    """Sets of word shingles as sorted 64-bit hashes. Words are runs of anything but [\\x20\\x09-\\x0D], A-Z in lower case."""

    def __init__(self, size: int):
        self.size = size
        self.known, self.hashes = Numbers(), np.zeros(1024, np.uint64)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > CACHED_WORDS:
            self.known = Numbers()
        before = len(self.known)
        at = np.array(list(map(self.known.__getitem__, words)), np.int64)
        if len(self.known) > before:
            from itertools import islice

            fresh = list(islice(reversed(self.known), len(self.known) - before))[::-1]
            while len(self.hashes) < len(self.known):
                self.hashes = np.resize(self.hashes, 2 * len(self.hashes))
            self.hashes[before : len(self.known)] = [xxhash.xxh64_intdigest(w) for w in fresh]
        h = self.hashes[at]
        k = min(self.size, len(h))  # fewer words: the whole sequence as one
        out = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            out = mix(out + h[i : len(h) - k + 1 + i])
        return np.unique(out)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """documents x BUCKETS: leading zeros << MANTISSA | mantissa of each bucket's smallest hash, EMPTY without one."""
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    least = np.full(len(sets) * BUCKETS, np.iinfo(np.uint64).max)
    bucket = ((flat >> np.uint64(32)) * np.uint64(BUCKETS) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(least, of * BUCKETS + bucket, mix(flat ^ _MIX2))
    part, exponent = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 62).astype(np.uint16)
    out = zeros << np.uint16(MANTISSA) | np.minimum((part * 2 - 1) * (1 << MANTISSA), (1 << MANTISSA) - 1).astype(np.uint16)
    out[least == np.iinfo(np.uint64).max] = EMPTY
    return out.reshape(len(sets), BUCKETS)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """documents x BANDS keys, of documents that have any shingle."""
    full = regs.copy()
    for i in np.flatnonzero((regs == EMPTY).any(axis=1)):
        empty, own = np.flatnonzero(regs[i] == EMPTY), np.flatnonzero(regs[i] != EMPTY)
        if len(own):
            full[i, empty] = regs[i, own[_BORROW[np.ix_(empty, own)].argmin(axis=1)]]
    grouped = full.reshape(len(regs), BANDS, PER_BAND).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), grouped.shape[:2])
    for i in range(PER_BAND):
        key = mix(key + (grouped[:, :, i] + np.uint64(1)) * _MIX1)
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(similarity, registers it rests on) of rows of registers, less the collisions expected of unlike sets.

    Expected collisions follow the published approximation for registers of 2^-MANTISSA resolution.
    """
    used = ~((a == EMPTY) & (b == EMPTY))
    k = used.sum(axis=-1)
    same = ((a == b) & used).sum(axis=-1)
    big, little = np.maximum(n_a, n_b).astype(float), np.minimum(n_a, n_b).astype(float)
    ratio = big / np.maximum(little, 1)
    by_chance = np.minimum(0.169919487159739093975 * BUCKETS * 2.0**-MANTISSA * (4 * ratio / (1 + ratio) ** 2), 0.5 * BUCKETS) / BUCKETS
    share = same / np.maximum(k, 1)
    return np.clip((share - by_chance) / (1 - by_chance), 0, 1), k


def promising(similarity: np.ndarray, k: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    t = percent / 100
    near = similarity >= t - SLACK * np.sqrt(t * (1 - t) / np.maximum(k, 1))
    return near & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))


def sketch(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, n, print, regs, keys): number of shingles, digest of the set, registers and band keys (empty without shingles)."""
    own = short_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = worker_state(("minhash", shingle), lambda: Shingler(shingle))
        for batch in batches:
            for a, b, texts in portions(batch.column(1)):
                sets = [shingler(t) for t in texts]
                n = np.array([len(s) for s in sets])
                regs = registers(sets)
                keys = band_keys(regs)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([r.tobytes() for r in regs], pa.binary()), pa.array([k if m else [] for k, m in zip(keys, n, strict=True)], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "print", "regs", "keys"],
                )

    return own.mapInArrow(run, "doc_id long, n long, print binary, regs binary, keys array<long>")


def _estimated(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of those of (a, b, n_a, n_b, regs_a, regs_b) that may be links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            regs = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, BUCKETS) for i in (4, 5)]
            may = pa.array(promising(*estimate(*regs, n_a, n_b), n_a, n_b, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(may), batch.column(1).filter(may)], names=["a", "b"])

    return pairs.select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int, scratch: Scratch, rows: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold. docs: (doc_id, text); of rows that share an identifier any pair of texts counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = worker_state(("minhash", shingle), lambda: Shingler(shingle))
        last, last_set = None, None
        for batch in batches:
            a, b, ok = batch.column(0), batch.column(1), []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                y = y.as_py()
                if y != last:  # rows come by hub
                    last, last_set = y, shingler(y)
                ok.append(linked(shingler(x.as_py()), last_set, percent))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    # texts are looked up once for both ends: a document goes to the pairs in which it is a, and once to its own as b
    ends = scratch.store(pairs.select(F.col("a").alias("doc_id"), "b", F.lit(True).alias("is_a")).union(pairs.select(F.col("b").alias("doc_id"), "b", F.lit(False).alias("is_a")).distinct()), 2 * rows)
    with_text = docs.join(small(ends, ends.count()), "doc_id")
    left = with_text.where("is_a").select(F.col("doc_id").alias("a"), "b", F.col("text").alias("text_a"))
    right = with_text.where("NOT is_a").select("b", F.col("text").alias("text_b"))
    return left.join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= percent * (len(a) + len(b) - both)


def _join(left: np.ndarray, right: np.ndarray, rep: np.ndarray, component: np.ndarray, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Pairs of a left and a right row that it takes to join the components which near(row, rows) finds a pair between."""
    label = component.copy()
    for i in left.tolist():
        to = right[label[right] != label[i]]
        for j in to[near(i, to)].tolist() if len(to) else []:
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                yield int(min(rep[i], rep[j])), int(max(rep[i], rep[j]))


def _dealt(rows: DataFrame, key: str, size: Column, per_block: Column, total: int, at_once: int) -> DataFrame:
    """rows (key, rep, outside, ...) with lot, mine, other, left, right: what is compared is the left and the right rows of one lot, mine and other.

    A key whose size is at most per_block is one piece, and several such are a lot, of about at_once. A larger one is dealt
    into blocks; each block of rows that are outside meets each block of all rows, so a row is copied as often as its key
    has blocks, and no piece grows with its key.
    """
    blocks = F.ceil(size / per_block).cast("int")
    block, every, yes, no = F.pmod(F.xxhash64("rep"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1)), F.lit(True), F.lit(False)
    lot = F.pmod(F.xxhash64(key), F.lit(1 + total // at_once))
    columns = lambda lot, mine, other, left, right: (lot.alias("lot"), mine.alias("mine"), other.alias("other"), left.alias("left"), right.alias("right"), F.col(key).alias("key"), *[c for c in rows.columns if c != key])
    whole = rows.where(blocks <= 1).select(*columns(lot, F.lit(-1), F.lit(-1), F.col("outside"), yes))
    large = rows.where(blocks > 1)
    mine = large.where("outside").select(*columns(F.col(key), block, every, yes, no))
    return whole.union(mine).union(large.select(*columns(F.col(key), every, block, no, yes)))


def _keyed(table: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """(rows, left, right) of each key of a lot."""
    table = table.sort_by("key")
    key = table.column("key").to_numpy()
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]).tolist()
    for start, stop in zip(starts, [*starts[1:], len(key)], strict=True):
        part = table.slice(start, stop - start)
        yield part, *(np.flatnonzero(part.column(c).to_numpy()) for c in ("left", "right"))


def _pairs(pairs: set[tuple[int, int]]) -> pa.Table:
    a, b = zip(*sorted(pairs), strict=True) if pairs else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _across(members: DataFrame, regs: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) that join the components of members (key, rep, component) between which a pair that shares a key may be a link."""
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("k"))
    sizes = sizes.groupBy("key").agg(F.max(F.struct("k", "component")).alias("top"), F.sum("k").alias("size"), F.count("*").alias("parts"))
    mixed = scratch.store(sizes.where("parts > 1").select("key", F.col("top.component").alias("main"), "size"))
    keys, total = mixed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    held = scratch.store(members.join(small(mixed, keys), "key").join(regs, "rep").withColumn("outside", F.col("component") != F.col("main")).drop("main"))
    per_block = F.when(F.col("size") >= LARGE, LARGE_BLOCK).otherwise(BLOCK)

    def run(table: pa.Table) -> pa.Table:
        pairs: set[tuple[int, int]] = set()
        for part, left, right in _keyed(table):
            rep, component, n = (part.column(c).to_numpy() for c in ("rep", "component", "n"))
            own = np.frombuffer(b"".join(part.column("regs").to_pylist()), np.uint16).reshape(-1, BUCKETS)

            def near(i: int, to: np.ndarray, n=n, own=own) -> np.ndarray:
                ok = 100 * np.minimum(n[to], n[i]) >= percent * np.maximum(n[to], n[i])
                ok[ok] = promising(*estimate(own[i][None, :], own[to[ok]], n[i], n[to[ok]]), n[i], n[to[ok]], percent)
                return ok

            pairs.update(_join(left, right, rep, component, near))
        return _pairs(pairs)

    pairs = scratch.store(_dealt(held, "key", F.col("size"), per_block, total, AT_ONCE).groupBy("lot", "mine", "other").applyInArrow(run, "a long, b long").distinct())
    scratch.free(mixed, held)
    return pairs


def _rest(members: DataFrame, docs: DataFrame, shingle: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) that join the components of members (cluster, rep, component, main), all of a cluster that has several."""
    held = scratch.store(docs.withColumnRenamed("doc_id", "rep").join(small(members, members.count()), "rep").select("cluster", "rep", "component", (F.col("component") != F.col("main")).alias("outside"), "text"))
    sizes = scratch.store(held.groupBy("cluster").agg(F.sum(F.length("text") + 1).alias("size")))
    clusters, total = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()

    def run(table: pa.Table) -> pa.Table:
        shingler = worker_state(("minhash", shingle), lambda: Shingler(shingle))
        pairs: set[tuple[int, int]] = set()
        for part, left, right in _keyed(table):
            rep, component = (part.column(c).to_numpy() for c in ("rep", "component"))
            sets = [shingler(t.as_py()) for t in part.column("text")]
            n = np.array([len(s) for s in sets])
            flat, of = np.concatenate([sets[j] for j in right] or [np.zeros(0, np.uint64)]), np.repeat(right, n[right])
            order = np.argsort(flat, kind="stable")
            flat, of = flat[order], of[order]

            def near(i: int, to: np.ndarray, sets=sets, n=n, flat=flat, of=of) -> np.ndarray:
                first = np.searchsorted(flat, sets[i], "left")
                each = np.searchsorted(flat, sets[i], "right") - first
                hits = of[np.repeat(first - np.cumsum(each) + each, each) + np.arange(each.sum())]
                both = np.bincount(hits, minlength=len(n))[to]
                return 100 * both >= percent * (n[i] + n[to] - both)

            pairs.update(_join(left, right, rep, component, near))
        return _pairs(pairs)

    dealt = _dealt(held.join(small(sizes, clusters), "cluster"), "cluster", F.col("size"), F.lit(BLOCK_BYTES), total, 2 * BLOCK_BYTES)
    pairs = scratch.store(dealt.groupBy("lot", "mine", "other").applyInArrow(run, "a long, b long").distinct())
    scratch.free(held, sizes)
    return pairs


def links(df: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(members, components): (doc_id, n, rep) of each row, and (node, component) of each rep that has a link."""
    sketches = scratch.store(sketch(df, id_col, text_col, shingle))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where("doc_id IS NOT NULL")
    # what is joined back is written first: an aggregate and a join on one exchange could not be split where a key is hot
    classes = scratch.store(sketches.where("n > 0").groupBy("print").agg(F.min("doc_id").alias("rep")))
    members = scratch.store(sketches.select("doc_id", "n", "print").join(classes, "print", "left"))
    heads = scratch.store(sketches.where("doc_id IS NOT NULL").join(classes.select("print", F.col("rep").alias("doc_id")), ["print", "doc_id"]).select(F.col("doc_id").alias("rep"), "n", "regs", "keys"))
    scratch.free(sketches)

    keyed = heads.select("rep", F.explode("keys").alias("key"))
    shared = scratch.store(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"))
    live = scratch.store(keyed.join(shared, "key"))
    degree = scratch.store(live.groupBy("rep").agg(F.sum("size").alias("degree")))
    hubs = scratch.store(live.join(degree, "rep").groupBy("key").agg(F.max(F.struct("degree", (-F.col("rep")).alias("minus"))).alias("top")).select("key", (-F.col("top.minus")).alias("hub")))
    star = scratch.store(live.select("key", "rep").join(hubs, "key").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct())
    pairs = star.count()
    ends = scratch.store(star.select(F.col("a").alias("rep")).union(star.select("b")).distinct(), 2 * pairs)
    regs = scratch.store(heads.select("rep", "n", "regs").join(small(ends, ends.count()), "rep", "left_semi"))
    maybe = scratch.store(_estimated(star.join(regs.toDF("a", "n_a", "regs_a"), "a").join(regs.toDF("b", "n_b", "regs_b"), "b"), percent).distinct(), pairs)
    found = scratch.store(_verified(maybe, docs, shingle, percent, scratch, pairs))
    first = components(found.toDF("u", "v"), scratch, rows=pairs).toDF("rep", "component")

    # a key's hub has met the others already, and with two documents there is no other pair
    parts = scratch.store(live.where("size > 2").select("key", "rep").join(first, "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component")))
    across = _across(parts, regs, percent, scratch)
    linked_nodes = first.toDF("node", "component")
    if more := across.count():
        pairs += more
        clusters = components(found.union(across).toDF("u", "v"), scratch, rows=pairs).toDF("rep", "cluster")
        named = scratch.store(clusters.join(first, "rep", "left").withColumn("component", F.coalesce("component", "rep")), 2 * pairs)
        sizes = named.groupBy("cluster", "component").agg(F.count("*").alias("k")).groupBy("cluster").agg(F.max(F.struct("k", "component")).alias("top"), F.count("*").alias("parts"))
        mixed = scratch.store(sizes.where("parts > 1").select("cluster", F.col("top.component").alias("main")), 2 * pairs)
        rest = _rest(named.join(mixed, "cluster"), docs, shingle, percent, scratch)
        linked_nodes = components(found.union(rest).toDF("u", "v"), scratch, rows=2 * pairs)
        scratch.free(named, mixed, rest)
    scratch.free(classes, heads, live, hubs, degree, shared, star, ends, regs, maybe, found, parts, across)
    return members, linked_nodes


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of df: id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= percent * union of their sets of `shingle`-word shingles; with fewer
    words the whole sequence is the one shingle. Null and empty texts have no shingle and are linked with nothing.
    component_id is the smallest identifier reachable. Rows that repeat an identifier count as one document, linked
    with whatever any of its texts is; a row without identifier is linked with nothing, has no component_id and is
    kept. An empty table gives an empty result. Only the two columns are read.
    """
    scratch = scratch or Scratch(df.sparkSession, "minhash")
    members, linked = links(df, id_col, text_col, shingle, percent, scratch)
    joined = members.join(linked.withColumnRenamed("node", "rep"), "rep", "left")
    top = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    out = joined.select("doc_id", F.col("n").alias("n_shingles"), top.alias("component_id"), (top.isNull() | (F.col("doc_id") == top)).alias("kept"))
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """The rows that stay, with all columns: of each component those of the smallest identifier.

    Nulls, ties and repeated rows as in groups(): rows without identifier, text or words stay, rows that repeat an
    identifier stay or go together; an empty table gives an empty result.
    """
    scratch = scratch or Scratch(df.sparkSession, "minhash")
    name = "_gone"
    while name in df.columns:
        name += "_"
    gone = scratch.store(groups(df, id_col, text_col, shingle, percent, scratch).where(~F.col("kept")).select(F.col(id_col).alias(name)).distinct())
    return df.join(small(gone, gone.count()), F.col(f"`{id_col}`").cast("long") == F.col(name), "left_anti")
