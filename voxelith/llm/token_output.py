"""Token-ID output in fixed-width packed files.

Documents are put in order of their identifiers, encoded, and their ids packed with the minimum number of
bits that the vocabulary needs. A file is self-contained:

    magic 8 bytes | version, bits, ids in a block, documents, ids, blocks: 6 x uint64
    document identifiers: int64 x documents | first id of each document, and the end: uint64 x (documents + 1)
    byte offset of each block: uint64 x blocks | the blocks | a bit for each document, set if it has an identifier

Blocks but the last hold the same number of ids, so any id is found from its number; a block unpacks with
numpy alone. Files are the `file` column of a Parquet table in the shared folder, so Spark's commit
protocol decides which attempts count when executors are lost; export() writes them out one by one.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import wordbpe
from .bpe_codec import default_path
from .common import Scratch, partitions, short_batches, small, worker_state

MAGIC = b"VXTOKEN1"
BLOCK_IDS = 65_536
FILE_IDS = 2_000_000
END_ID = 1
CACHED = 500_000
#: Stretches that go to the library at once.
AT_ONCE = 10_000


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 to vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(wide[:, 32 - bits :].reshape(-1)).tobytes()


def unpack(raw, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f">u{bits // 8}", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits).reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - bits :] = flat
    return np.packbits(wide, axis=1).view(">u4").reshape(-1).astype(np.uint32)


def write_file(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS, named: np.ndarray | None = None) -> bytes:
    """named: which documents have an identifier; all if it isn't given."""
    named = np.ones(len(doc_ids), bool) if named is None else named
    blocks = [pack(ids[a : a + block_ids], bits) for a in range(0, len(ids), block_ids)]
    head = np.array([2, bits, block_ids, len(doc_ids), len(ids), len(blocks)], "<u8").tobytes()
    starts = np.r_[0, np.cumsum(lengths)].astype("<u8").tobytes()
    first = len(MAGIC) + len(head) + 8 * len(doc_ids) + len(starts) + 8 * len(blocks)
    offsets = (first + np.cumsum([0, *map(len, blocks)])[: len(blocks)]).astype("<u8").tobytes()
    return b"".join([MAGIC, head, doc_ids.astype("<i8").tobytes(), starts, offsets, *blocks, np.packbits(named).tobytes()])


class TokenFile:
    """Random access to a packed file held in any buffer (bytes, or a memory map)."""

    def __init__(self, buffer):
        if bytes(buffer[:8]) != MAGIC:
            raise ValueError("not a token file")
        self.buffer = memoryview(buffer)
        _, self.bits, self.block_ids, docs, self.n, blocks = np.frombuffer(buffer, "<u8", 6, 8).astype(np.int64).tolist()
        self.doc_ids = np.frombuffer(buffer, "<i8", docs, 56)
        self.starts = np.frombuffer(buffer, "<u8", docs + 1, 56 + 8 * docs).astype(np.int64)
        self.offsets = np.frombuffer(buffer, "<u8", blocks, 56 + 8 * (2 * docs + 1)).astype(np.int64)
        self.named = np.unpackbits(np.frombuffer(buffer, np.uint8)[len(self.buffer) - -(-docs // 8) :], count=docs).astype(bool)

    def block(self, k: int) -> np.ndarray:
        n = min(self.block_ids, self.n - k * self.block_ids)
        at = int(self.offsets[k])
        return unpack(self.buffer[at : at + -(-n * self.bits // 8)], n, self.bits)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        part = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return part[start - first * self.block_ids : stop - first * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


class LibraryEncoder:
    """The tokenizers library: whole texts beyond Latin-1, and each distinct stretch between white space of others once.

    Words never cross white space. So the library takes many stretches in one text, and the bytes that its tokens stand for
    tell which ids are of which stretch.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # chunks can spell a special token in lower case, which the text didn't: they go to the same model without added tokens
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.normalizer, self.plain.pre_tokenizer = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.vocabulary = wordbpe.Vocabulary(path)
        self.token_bytes = np.array([len(t.removesuffix(self.vocabulary.suffix)) for t in self.vocabulary.tokens.tolist()])
        self.cache = wordbpe.CachedEncoder(self.vocabulary.special, None, self.whole, CACHED, self.chunks)

    def whole(self, text: str, tokenizer=None) -> np.ndarray:
        return np.array((tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of chunks of Latin-1 in lower case, of which the library's normaliser and splitter keep every byte."""
        each, ids = [], []
        for a in range(0, len(chunks), AT_ONCE):
            part = chunks[a : a + AT_ONCE]
            own = self.whole(" ".join(part), self.plain)
            upto = np.cumsum(self.token_bytes[own])
            ends = np.cumsum([len(c.encode()) for c in part])
            last = np.searchsorted(upto, ends)
            if len(upto) and upto[-1] == ends[-1] and (upto[last] == ends).all():
                each.append(np.diff(last, prepend=-1))
                ids.append(own)
            else:  # a vocabulary whose tokens do not keep to the bytes: one by one
                alone = [self.whole(c, self.plain) for c in part]
                each.append(np.array([len(x) for x in alone], np.int64))
                ids += alone
        return np.concatenate(each), np.concatenate(ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.cache.encode(texts)


def worker_encoder(path: str) -> LibraryEncoder:
    """A worker's later tasks find the words of its earlier ones."""
    return worker_state(("tokens", path), lambda: LibraryEncoder(path))


def write(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """The written files: (shard, seq, n_docs, n_ids, file); shard, seq is the order of identifiers."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, seq = TaskContext.get().partitionId(), 0
        encoder = worker_encoder(path)
        bits = bits_for(encoder.vocabulary.size)
        docs, named, lengths, ids, n = [], [], [], [], 0

        def close() -> pa.RecordBatch:
            blob = write_file(np.concatenate(docs), np.concatenate(lengths), np.concatenate(ids), bits, named=np.concatenate(named))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([seq], pa.int32()), pa.array([sum(map(len, docs))], pa.int64()), pa.array([n], pa.int64()), pa.array([blob], pa.binary())], names=["shard", "seq", "n_docs", "n_ids", "file"])

        for batch in batches:
            numbers, valid = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for a, b, texts in wordbpe.portions(batch.column(1)):
                each = encoder.encode(texts)
                if end_id is not None:
                    each = [np.append(x, end_id) for x in each]
                docs.append(numbers[a:b])
                named.append(valid[a:b])
                lengths.append(np.array([len(x) for x in each], np.int64))
                ids += each
                n += int(lengths[-1].sum())
                if n >= FILE_IDS:
                    yield close()
                    docs, named, lengths, ids, n, seq = [], [], [], [], 0, seq + 1
        if docs:
            yield close()

    own = short_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    count = partitions(df)
    # the hash parts rows that repeat one identifier; texts would be too long for a sampled splitter
    ordered = own.repartitionByRange(count, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    return scratch.store(ordered.mapInArrow(run, "shard int, seq int, n_docs long, n_ids long, file binary"))


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document of the written files, from their bytes."""
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    counts = files.select("shard", "seq", "n_ids")
    shards = counts.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before.orderBy("shard")), F.lit(0)).alias("_shard_start"))
    inner = counts.select("shard", "seq", F.coalesce(F.sum("n_ids").over(before.partitionBy("shard").orderBy("seq")), F.lit(0)).alias("_file_start"))
    n = files.count()
    starts = inner.join(small(shards, n), "shard").select("shard", "seq", (F.col("_shard_start") + F.col("_file_start")).alias("_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, seq, raw in zip(*(batch.column(i) for i in range(3)), strict=True):
                f = TokenFile(raw.as_buffer())
                crc = np.empty(len(f.doc_ids), np.int64)
                flat = f.ids(0, f.n).astype("<u4") if f.n else np.zeros(0, "<u4")
                for i, (a, b) in enumerate(zip(f.starts.tolist(), f.starts.tolist()[1:], strict=False)):
                    crc[i] = zlib.crc32(flat[a:b])
                k = len(f.doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, shard.as_py(), np.int32)), pa.array(np.full(k, seq.as_py(), np.int32)), pa.array(f.doc_ids, mask=~f.named), pa.array(f.starts[:-1]), pa.array(np.diff(f.starts)), pa.array(crc)],
                    names=["shard", "seq", "doc_id", "_in_file", "n_tokens", "ids_crc32"],
                )

    rows = files.select("shard", "seq", "file").mapInArrow(run, "shard int, seq int, doc_id long, _in_file long, n_tokens long, ids_crc32 long")
    return rows.join(small(starts, n), ["shard", "seq"]).select("doc_id", (F.col("_start") + F.col("_in_file")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int | None = END_ID, scratch: Scratch | None = None) -> DataFrame:
    """Writes the files and gives what they hold: one row per row of df.

    Null text counts as empty and has the end id alone. Null identifiers come first and read back as null. Rows
    that repeat an identifier stand next to each other, in an order of their texts that reruns keep. An empty
    table gives no file and an empty result. Only the two columns are read.
    """
    out = read(write(df, scratch or Scratch(df.sparkSession, "tokens"), id_col, text_col, path, end_id))
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)


def export(files: DataFrame, folder: str) -> None:
    """Each file as part-<shard>-<seq>.vxt in a folder that every executor has mounted (a path, not a URL); a task that runs again writes the same bytes."""

    def put(rows) -> None:
        import os
        import uuid

        for r in rows:
            at = f"{folder}/part-{r.shard:05d}-{r.seq:05d}.vxt"
            with open(f"{at}.{uuid.uuid4().hex}", "wb") as f:
                f.write(r.file)
            os.replace(f.name, at)

    files.select("shard", "seq", "file").foreachPartition(put)
