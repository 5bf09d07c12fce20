"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters, four at a time: capitals are one symbol and digits another, any other character is its
own, of whatever script; one beyond the first plane is two symbols, those of its UTF-16 pair. Its counts come from every second trusted document, by a hash, and stay tables throughout:
n-gram counts, continuation counts, context sums and discounts are aggregated and joined by context and by suffix in
hash shards, order by order, which gives the interpolated probability of each n-gram seen and the back-off weight of
each context.

Documents meet those tables by joins as well. A lot of documents gives one row for each of its different n-grams, with
the places and counts of the documents that have it. The different n-grams of all lots are joined with the tables,
order by order, and their log-probabilities with the rows; sums by lot and place are the log-probabilities of the
documents. The HEAD most frequent n-grams of the model, which are hot keys of that join, are joined by a broadcast of
their fixed number instead, so that only the rarer ones are shuffled. A lot is numbered as it is written, so rows that repeat an identifier, or have none, are each scored by
themselves, and the carried columns travel with their lot.

A document is kept if its perplexity lies between two quantiles of its own language, taken over all trusted
documents (the upper one over those that the model has not seen), widened by MARGIN.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, short_batches, small, worker_state

ORDER = 4
BITS = 16
START = 0
#: Log-probabilities are whole multiples of this, so that their sums are exact and do not depend on any order.
UNIT = 2.0**-24
#: Characters that are counted at once: of a lot, or of a piece of a longer text. Documents of a lot.
LOT_CHARS, LOT_DOCS = 4_000_000, 4_096
#: Quantiles of log perplexity, and the factors by which the bounds are widened.
LOW, HIGH = 0.005, 0.995
MARGIN = 0.06
LEAST_DOCS = 30
#: Decimals of the values whose quantiles are taken: bounds how many different ones there are, whatever the input.
DECIMALS = 4
#: A mean over n characters is uncertain by about this, divided by the root of n; a document has the benefit of it.
SPREAD = 3.0
CAPITAL, DIGIT = "A", "0"

#: N-grams that are joined by broadcast: the most frequent ones, a megabyte at any size of the corpus.
HEAD = 65_536

#: N-grams, contexts, symbols seen and one more for all others, and the codes of the head, in order, with their log-probabilities.
Tables = tuple[DataFrame, DataFrame, int, np.ndarray, np.ndarray]


def symbol_of(char: str) -> str:
    return CAPITAL if char.isupper() else DIGIT if char.isdigit() else char


class Alphabet:
    def __init__(self):
        self.table = np.array([ord(symbol_of(chr(c))) or 1 for c in range(1 << BITS)], np.uint16)

    def symbols(self, text: str) -> np.ndarray:
        """text: of units()."""
        return self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def units(text: str) -> str:
    """With a character for each UTF-16 unit, so that all fit 16 bits."""
    if text.isascii() or max(text) < chr(1 << BITS):
        return text
    return np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16).astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")


def _pieces(texts: list[str]) -> Iterator[list[tuple[int, str, bool]]]:
    """(place, piece, whether it begins its text) in lots of up to LOT_CHARS; a piece that doesn't begin has the ORDER - 1 characters before it in front."""
    lot, held = [], 0
    for i, t in enumerate(texts):
        for a in range(0, len(t), LOT_CHARS):
            piece = t[max(0, a - ORDER + 1) : a + LOT_CHARS]
            if lot and held + len(piece) > LOT_CHARS:
                yield lot
                lot, held = [], 0
            lot.append((i, piece, a == 0))
            held += len(piece)
    if lot:
        yield lot


def counted(alphabet: Alphabet, lot: list[tuple[int, str, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, first, place, n): different n-grams of a lot, where each one's entries begin (and the end), and the place and count of each entry."""
    pad = chr(0) * (ORDER - 1)
    flat = alphabet.symbols("".join(pad + p if begins else p for _, p, begins in lot))
    lengths = np.array([len(p) + (ORDER - 1) * begins for _, p, begins in lot], np.int64)
    begin = np.cumsum(lengths) - lengths
    for k in range(ORDER - 1):
        flat[begin[[b for _, _, b in lot]] + k] = START
    # as few bits as the lot's own symbols need, so that n-gram and place fit one word and one sort counts them
    seen = np.zeros(1 << BITS, bool)
    seen[flat] = True
    own = np.flatnonzero(seen)
    places, of = np.unique([i for i, _, _ in lot], return_inverse=True)
    bits, place_bits = max(1, int(len(own) - 1).bit_length()), int(len(places) - 1).bit_length()
    if ORDER * bits + place_bits > 64:
        half = [counted(alphabet, part) for part in (lot[: len(lot) // 2], lot[len(lot) // 2 :])]
        codes, first = np.concatenate([h[0] for h in half]), np.concatenate([half[0][1][:-1], half[0][1][-1] + half[1][1]])
        return codes, first, np.concatenate([h[2] for h in half]), np.concatenate([h[3] for h in half])
    dense = (np.cumsum(seen) - 1).astype(np.uint16)[flat]
    word = np.zeros(len(flat) - ORDER + 1, np.uint64)
    for k in range(ORDER):
        word <<= np.uint64(bits)
        word |= dense[k : k + len(word)]
    del dense, flat
    whole = np.ones(len(word), bool)  # n-grams that lie in one piece
    for k in range(1, ORDER):
        whole[begin[1:] - k] = False
    word = word[whole]
    word <<= np.uint64(place_bits)
    word |= np.repeat(of.astype(np.uint32), lengths - (ORDER - 1))
    word.sort()
    new = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
    n, word = np.diff(np.r_[new, len(word)]), word[new]
    gram = word >> np.uint64(place_bits)
    first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]) if len(gram) else np.zeros(0, np.int64)
    codes = np.zeros(len(first), np.uint64)
    for k in range(ORDER):
        part = gram[first] >> np.uint64(bits * (ORDER - 1 - k)) & np.uint64((1 << bits) - 1)
        codes = codes << np.uint64(BITS) | own[part.astype(np.int64)].astype(np.uint64)
    return codes.view(np.int64), np.r_[first, len(gram)], places[(word & np.uint64((1 << place_bits) - 1)).astype(np.int64)], n


ENTRY = np.dtype([("place", "<u2"), ("n", "u1")])
#: Entries that are summed at once.
SUMMED = 2_000_000


def _alphabet() -> Alphabet:
    return worker_state(("quality",), Alphabet)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lot in _pieces(list(map(units, batch.column(0).to_pylist()))):
            codes, first, _, n = counted(_alphabet(), lot)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(np.add.reduceat(n, first[:-1]))], names=["code", "n"])


def _suffix(code: str, k: int) -> Column:
    return F.col(code).bitwiseAND((1 << BITS * k) - 1) if k < ORDER else F.col(code)


def _context(code: str) -> Column:
    return F.shiftrightunsigned(code, BITS)


def log_of(p: Column) -> Column:
    return F.rint(F.log(p) / UNIT) * UNIT


def kneser_ney(counts: DataFrame, scratch: Scratch) -> Tables:
    """counts (code, n) of ORDER-grams -> (k, code, p) of all grams seen, (k, context, gamma) of all contexts seen, the number of symbols, and the head.

    The highest order uses counts; each lower one the number of different symbols seen before a gram. Discounts for
    counts of 1, 2 and 3 or more come from the counts of counts of their order. All symbols that were not seen are
    one more together.
    """
    by_order = {ORDER: scratch.store(counts.select("code", "n"))}
    for k in range(ORDER - 1, 0, -1):
        by_order[k] = scratch.store(by_order[k + 1].groupBy(_suffix("code", k).alias("code")).agg(F.count("*").alias("n")))
    symbols = by_order[1].count() + 1
    lower, grams, contexts = None, [], []
    for k in range(1, ORDER + 1):
        rows = by_order[k]
        n1, n2, n3, n4 = rows.agg(*[F.sum((F.col("n") == i).cast("long")) for i in (1, 2, 3, 4)]).first()
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        d1, d2, d3 = (max(0.0, min(i, i - (i + 1) * y * (b / a))) if a and b else 0.5 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        # from whole counts, so that it is the same in any order
        held = sum(F.sum(is_.cast("long")) * d for is_, d in ((F.col("n") == 1, d1), (F.col("n") == 2, d2), (F.col("n") > 2, d3)))
        sums = rows.groupBy(_context("code").alias("context")).agg(F.sum("n").alias("total"), held.alias("held"))
        joined = rows.withColumn("context", _context("code")).join(sums, "context")
        own = (F.col("n") - discount) / F.col("total")
        gamma = F.col("held") / F.col("total")
        if lower is None:
            p = joined.select("code", (own + gamma / symbols).alias("p"))
        else:
            p = joined.withColumn("suffix", _suffix("code", k - 1)).join(lower.toDF("suffix", "below"), "suffix").select("code", (own + gamma * F.col("below")).alias("p"))
        lower = scratch.store(p)
        grams.append(lower.select(F.lit(k).alias("k"), "code", "p"))
        contexts.append(sums.select(F.lit(k).alias("k"), "context", gamma.alias("gamma")))
    union = lambda frames: frames[0] if len(frames) == 1 else union([frames[0].union(frames[1]), *frames[2:]])
    head = by_order[ORDER].orderBy(F.desc("n"), "code").limit(HEAD).select("code").join(lower, "code").select("code", log_of(F.col("p")).alias("log_p")).orderBy("code").toArrow()
    return scratch.store(union(grams)), scratch.store(union(contexts)), symbols, *(c.to_numpy() for c in head.columns)


def resolved(codes: DataFrame, tables: Tables) -> DataFrame:
    """(code, log_p) of n-grams, seen or not: the longest suffix that was seen gives p, and every context passed over on the way its weight."""
    grams, contexts, symbols, *_ = tables
    rows = codes.select("code", F.lit(None).cast("double").alias("p"), F.lit(1.0).alias("weight"))
    for k in range(ORDER, 0, -1):
        mine = grams.where(F.col("k") == k).select(F.col("code").alias("c"), F.col("p").alias("found"))
        gamma = contexts.where(F.col("k") == k).select(F.col("context").alias("x"), "gamma")
        if k == 1:  # one row for each symbol at most, and there are 65,536
            mine, gamma = F.broadcast(mine), F.broadcast(gamma)
        if k == 2:
            gamma = F.broadcast(gamma)
        rows = rows.withColumn("c", _suffix("code", k)).withColumn("x", _context("c")).join(mine, "c", "left").join(gamma, "x", "left")
        rows = rows.select(
            "code", F.coalesce("p", F.col("weight") * F.col("found")).alias("p"),
            F.when(F.col("p").isNull() & F.col("found").isNull(), F.col("weight") * F.coalesce("gamma", F.lit(1.0))).otherwise(F.col("weight")).alias("weight"),
        )
    return rows.select("code", log_of(F.coalesce("p", F.col("weight") / symbols)).alias("log_p"))


def scored(df: DataFrame, tables: Tables, text_col: str, scratch: Scratch, with_text: bool = False) -> DataFrame:
    """df (with or without its text) with log_perplexity (null without characters) and n_symbols, row by row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    others = [c for c in df.columns if c != text_col]
    carried = [*([text_col] if with_text else []), *others]
    head = df.sparkSession.sparkContext.broadcast(tables[3:])
    frame = short_batches(df).select(text_col, *others).toDF(*([] if with_text else ["_t"]), *[f"c{i}" for i in range(len(carried))])

    def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, texts, heads = TaskContext.get().partitionId() << 32, [], []
        known, log_p = head.value

        def close() -> Iterator[pa.RecordBatch]:
            sums = np.zeros(len(texts))
            for lot in _pieces(texts):
                codes, first, place, n = counted(_alphabet(), lot)
                at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
                hot = known[at] == codes if len(known) else np.zeros(len(codes), bool)
                each = np.diff(first)
                inside = np.repeat(hot, each)
                sums += np.bincount(place[inside], (n * np.repeat(np.where(hot, log_p[at], 0) if len(known) else 0.0, each))[inside], len(texts))
                codes, place, n, each = codes[~hot], place[~inside], n[~inside], each[~hot]
                times = -(-n // 255)  # an entry has a byte for its count
                entries = np.empty(times.sum(), ENTRY)
                entries["place"], entries["n"] = np.repeat(place, times), 255
                entries["n"][np.cumsum(times) - 1] = n - 255 * (times - 1)
                ends = np.r_[0, np.cumsum(times)][np.r_[0, np.cumsum(each)]]
                body = pa.BinaryArray.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer((ends * ENTRY.itemsize).astype(np.int32)), pa.py_buffer(entries.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), number)), pa.array(codes), body], names=["shard", "code", "body"])
            table = pa.Table.from_batches(heads).combine_chunks()
            table = table.append_column("n_symbols", pa.array([len(t) for t in texts], pa.int64())).append_column("log_p", pa.array(sums))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([None], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["shard", "code", "body"])

        for batch in batches:
            own, part, start, held = [units(t or "") for t in batch.column(0).to_pylist()], batch.select(batch.schema.names[not with_text :]), 0, sum(map(len, texts))
            for i, t in enumerate(own):
                if texts and (held + len(t) > LOT_CHARS or len(texts) >= LOT_DOCS):
                    heads.append(part.slice(start, i - start))
                    yield from close()
                    number, texts, heads, start, held = number + 1, [], [], i, 0
                texts.append(t)
                held += len(t)
            heads.append(part.slice(start))
        if texts:
            yield from close()

    rows = scratch.store(frame.mapInArrow(lots, "shard long, code long, body binary"))
    grams, heads = rows.where("code IS NOT NULL"), rows.where("code IS NULL")
    known = scratch.store(resolved(grams.select("code").distinct(), tables))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By lot and place, of some rows at a time."""
        shards, places, values, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            lots, of = np.unique(np.concatenate(shards), return_inverse=True)
            key, back = np.unique(of * LOT_DOCS + np.concatenate(places), return_inverse=True)
            total = np.bincount(back, np.concatenate(values))
            ends = np.searchsorted(key, np.arange(len(lots) + 1) * LOT_DOCS)
            blobs = [(key[a:b] % LOT_DOCS).astype("<u2").tobytes() + total[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            for kept in (shards, places, values):
                kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(lots), pa.array(blobs, pa.binary())], names=["shard", "body"])

        for batch in batches:
            size = pc.binary_length(batch.column(2)).to_numpy() // ENTRY.itemsize
            entry = np.frombuffer(b"".join(batch.column(2).to_pylist()), ENTRY)
            shards.append(np.repeat(batch.column(0).to_numpy(), size))
            places.append(entry["place"])
            values.append(entry["n"] * np.repeat(batch.column(1).to_numpy(), size))
            held += len(entry)
            if held >= SUMMED:
                yield flush()
                held = 0
        if held:
            yield flush()

    partial = grams.join(known, "code").select("shard", "log_p", "body").mapInArrow(sums, "shard long, body binary")
    schema = T.StructType([*[T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(carried)], T.StructField("log_perplexity", T.DoubleType()), T.StructField("n_symbols", T.LongType())])
    arrow = to_arrow_schema(schema)

    def finish(table: pa.Table) -> pa.Table:
        rows, total = None, np.zeros(LOT_DOCS)
        for is_head, raw in zip(table.column("head").to_pylist(), table.column("body").to_pylist(), strict=True):
            if is_head:
                rows = pa.ipc.open_stream(raw).read_all()
            else:
                n = len(raw) // 10
                total[np.frombuffer(raw, "<u2", n)] += np.frombuffer(raw, np.float64, n, 2 * n)
        sizes = rows.column("n_symbols").to_numpy()
        score = pa.array(-(total[: len(sizes)] + rows.column("log_p").to_numpy()) / np.maximum(sizes, 1), mask=sizes == 0)
        return rows.drop_columns(["n_symbols", "log_p"]).append_column("log_perplexity", score).append_column("n_symbols", pa.array(sizes)).cast(arrow)

    every = heads.select("shard", F.lit(True).alias("head"), "body").union(partial.select("shard", F.lit(False), "body"))
    return every.groupBy("shard").applyInArrow(finish, schema).toDF(*carried, "log_perplexity", "n_symbols")


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[Tables | None, DataFrame | None]:
    """(tables, trusted documents (lang, text, fit)) from documents labelled of quality 1 and not toxic.

    Half of them is counted, the other half is for calibration; labels that repeat an identifier with another
    verdict count as not trusted. (None, None) without trusted documents.
    """
    verdict = labels.groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.min(F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))).alias("ok"))
    trusted = scratch.store(verdict.where("ok AND _id IS NOT NULL").select("_id"))
    count = trusted.count()
    if not count:
        return None, None
    draw = F.pmod(F.xxhash64(F.lit("quality"), "_id"), F.lit(1 << 20))
    own = short_batches(docs).select(F.col(id_col).cast("long").alias("_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("text <> ''")
    sample = scratch.store(own.join(small(trusted.withColumn("_draw", draw), count), "_id").select("lang", "text", (F.col("_draw") % 2 == 0).alias("fit")))
    counts = sample.where("fit").select("text").mapInArrow(_gram_counts, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    tables = kneser_ney(counts, scratch)
    return (None, None) if tables[2] == 1 else (tables, sample)


def _bounded() -> tuple[Column, Column]:
    """What is compared with the lower and the upper bound."""
    spread = F.try_divide(F.lit(SPREAD), F.sqrt("n_symbols"))
    return F.col("log_perplexity") + spread, F.col("log_perplexity") - spread


def thresholds(calibration: DataFrame, low: float = LOW, high: float = HIGH, margin: float = MARGIN) -> DataFrame:
    """(lang, low, high) from scored trusted documents; the row of a null language holds for those with fewer than LEAST_DOCS.

    Documents that the model was fitted on (fit) look more predictable than others, so they count for the lower bound only.
    """
    least, most = _bounded()
    values = calibration.select("lang", F.round(least, DECIMALS).alias("least"), F.when(~F.col("fit"), F.round(most, DECIMALS)).alias("most"))
    ends = values.select("lang", F.expr("stack(2, 'least', least, 'most', most) AS (end, value)")).where("value IS NOT NULL").groupBy("lang", "end", "value").agg(F.count("*").alias("n"))
    quantile = lambda c, q: F.expr(f"percentile(CASE WHEN end = '{c}' THEN value END, {q}D, CASE WHEN end = '{c}' THEN n ELSE 0 END)")
    bounds = (F.sum(F.when(F.col("end") == "least", F.col("n"))).alias("k"), (quantile("least", low) * (1 - margin)).alias("low"), (quantile("most", high) * (1 + margin)).alias("high"))
    own = ends.where("lang IS NOT NULL").groupBy("lang").agg(*bounds).where(F.col("k") >= LEAST_DOCS)
    return own.union(ends.agg(F.lit(None).cast("string").alias("lang"), *bounds)).select("lang", "low", "high")


def _judged(docs: DataFrame, labels: DataFrame, carried: list[str], id_col: str, text_col: str, lang_col: str, scratch: Scratch) -> DataFrame:
    """docs' carried columns with log_perplexity, n_symbols, low, high and kept."""
    tables, calibration = train(docs, labels, scratch, id_col, text_col, lang_col)
    with_text = text_col in carried
    names = [f"k{i}" for i in range(len(carried))]
    back = [F.col("_text" if c == text_col else n).alias(c) for c, n in zip(carried, names, strict=True)]
    frame = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carried, names, strict=True) if c != text_col], F.col(f"`{lang_col}`").cast("string").alias("_lang"), F.col(f"`{text_col}`").alias("_text"))
    if tables is None:
        out = frame.withColumns({"log_perplexity": F.lit(None).cast("double"), "n_symbols": (F.length(F.coalesce("_text", F.lit(""))) + F.regexp_count(F.coalesce("_text", F.lit("")), F.lit(r"[\x{10000}-\x{10FFFF}]"))).cast("long"), "low": F.lit(None).cast("double"), "high": F.lit(None).cast("double")})
        return out.withColumn("kept", F.col("n_symbols") > 0).select(*back, "log_perplexity", "n_symbols", "low", "high", "kept")
    rows = thresholds(scored(calibration, tables, "text", scratch)).collect()  # one for each language with calibration documents
    every = next(r for r in rows if r["lang"] is None)
    judged = scored(frame, tables, "_text", scratch, with_text)
    side = judged.sparkSession.createDataFrame([(r["lang"], r["low"], r["high"]) for r in rows if r["lang"] is not None] or [("", None, None)], "_of string, low double, high double")
    joined = judged.join(F.broadcast(side), F.col("_lang") == F.col("_of"), "left")
    low, high = F.coalesce("low", F.lit(every["low"])), F.coalesce("high", F.lit(every["high"]))
    least, most = _bounded()
    kept = F.coalesce((least >= low) & (most <= high), F.col("log_perplexity").isNotNull())
    return joined.select(*back, "log_perplexity", "n_symbols", low.alias("low"), high.alias("high"), kept.alias("kept"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", scratch: Scratch | None = None) -> DataFrame:
    """One row per row of docs: id, lang, log_perplexity, n_symbols, low, high, kept.

    A null or empty text has no perplexity and is rejected. A null language, or one with few trusted documents, is judged
    by the quantiles over all languages. Without trusted documents nothing but empty texts is rejected. Repeated rows
    are judged alike; an empty table gives an empty result.
    """
    return _judged(docs, labels, [id_col, lang_col], id_col, text_col, lang_col, scratch or Scratch(docs.sparkSession, "quality"))


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", scratch: Scratch | None = None) -> DataFrame:
    """The rows of docs that classify() keeps, with all their columns."""
    scratch = scratch or Scratch(docs.sparkSession, "quality")
    names = [f"x{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names, strict=True))
    flat = docs.toDF(*names)
    renamed = labels.select(F.col(id_col).alias(own[id_col]), "quality", "toxic")
    return _judged(flat, renamed, names, own[id_col], own[text_col], own[lang_col], scratch).where("kept").select(*names).toDF(*docs.columns)
