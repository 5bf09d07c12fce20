"""BPE encoding and decoding with a lexicon automaton.

The most frequent words of the corpus are counted over all documents, their ids are found by exact merges,
and both are compiled into a minimal acyclic transducer (lexicon.py). Workers map it and look their
distinct words up; words it doesn't have are merged exactly (wordbpe.py). The lexicon only saves merges:
what it holds never changes an id.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wordbpe
from .common import Scratch, Shared, short_batches, stateless, worker_state
from .lexicon import Lexicon, build

#: Words in the lexicon: bounds what the driver collects and broadcasts (a few MB).
LEXICON_WORDS = 65_536
COUNTED_AT_ONCE = 150_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Splitter:
    """Words of texts that need the library's own normaliser and pre-tokenizer."""

    def __init__(self, vocabulary: wordbpe.Vocabulary):
        from tokenizers import Tokenizer

        self.tokenizer, self.special = Tokenizer.from_file(vocabulary.path), vocabulary.special
        self.raw = {c: b for b, c in enumerate(wordbpe.byte_alphabet())}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def __call__(self, text: str) -> Iterator[bytes | int]:
        """Bytes of each word; the id of each special token."""
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                yield self.special[part]
            elif part:
                for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(part)):
                    yield bytes(self.raw[c] for c in w)


class Codec:
    """Encodes as the tokenizers library does without added special tokens, and decodes as it does with special tokens kept."""

    def __init__(self, path: str, lexicon: bytes | None = None):
        self.vocabulary = wordbpe.Vocabulary(path)
        self.lexicon = Lexicon.mapped(lexicon) if lexicon else None
        self.splitter: Splitter | None = None  # made for the first text that needs it
        self.cache = wordbpe.CachedEncoder(self.vocabulary.special, lambda words: self.words([w.encode() for w in words]), self.odd)

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids): known words from the lexicon, the others merged."""
        if self.lexicon is None:
            return self.vocabulary.merge(words)
        place = self.lexicon.find(words)
        known, other = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        lengths = np.zeros(len(words), np.int64)
        rows = wordbpe.Rows()
        lengths[known], ids = self.lexicon.outputs(place[known])
        rows.append(lengths[known], ids)
        if len(other):
            rows.append(*self.vocabulary.merge([words[i] for i in other.tolist()]))
        number = np.empty(len(words), np.int64)
        number[known], number[other] = np.arange(len(known)), len(known) + np.arange(len(other))
        return rows.gather(number)

    def odd(self, text: str) -> np.ndarray:
        self.splitter = self.splitter or Splitter(self.vocabulary)
        items = list(self.splitter(text))
        words = [x for x in items if isinstance(x, bytes)]
        if not words:
            return np.array(items, np.int32)
        lengths, ids = self.words(words)
        pieces = iter(np.split(ids, np.cumsum(lengths)[:-1]))
        return np.concatenate([next(pieces) if isinstance(x, bytes) else np.array([x]) for x in items]).astype(np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.cache.encode(texts)

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(self.vocabulary.tokens[ids].tolist())


def worker_codec(path: str, blob: Shared) -> Codec:
    """A worker's later tasks find the words of its earlier ones."""
    return worker_state(("bpe", path, blob), lambda: Codec(path, blob.value))


def word_counts(df: DataFrame, text_col: str, path: str) -> DataFrame:
    """(word binary, n) over all texts: counted within partitions first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stateless()
        vocabulary, splitter = wordbpe.Vocabulary(path), None
        chunks, odd = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            words = Counter({k: v for k, v in odd.items()})
            for c, n in chunks.items():
                for w in wordbpe.LATIN_WORD.findall(c):
                    words[w.encode()] += n
            chunks.clear()
            odd.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for t in batch.column(0):
                t = t.as_py() or ""
                if wordbpe.is_latin(t, vocabulary.special):
                    chunks.update(t.lower().split())
                else:
                    splitter = splitter or Splitter(vocabulary)
                    odd.update(w for w in splitter(t) if isinstance(w, bytes))
                if len(chunks) + len(odd) > COUNTED_AT_ONCE:
                    yield flush()
        yield flush()

    counted = short_batches(df).select(F.col(text_col).cast("string")).mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(df: DataFrame, text_col: str = "text", path: str | None = None, words: int = LEXICON_WORDS) -> bytes:
    """The compiled lexicon of the most frequent words, `words` at most.

    How many words there are of each frequency (in steps of an eighth of a doubling) shows the frequency from which they
    fit, so no task sorts or gathers more words than go into the lexicon. A word met once is left to merging.
    """
    path = path or default_path()
    scratch = Scratch(df.sparkSession, "lexicon")
    level = F.floor(F.log2("n") * 8).cast("int")
    counts = scratch.store(word_counts(df, text_col, path).where("n > 1").select("word", level.alias("level")))
    least, fits = None, 0
    for r in sorted(counts.groupBy("level").count().collect(), reverse=True):
        fits += r["count"]
        if fits > words:
            break
        least = r["level"]
    known = [] if least is None else sorted(w for w in counts.where(F.col("level") >= least).select("word").toArrow().column(0).to_pylist() if w)
    scratch.free(counts)
    if not known:
        return build([], np.zeros(0), np.zeros(0))
    return build(known, *wordbpe.Vocabulary(path).merge(known))


def encoded(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, lexicon_words: int = LEXICON_WORDS, with_ids: bool = False) -> DataFrame:
    """One row per row of df: id, n_tokens, ids_sha256, decoded_sha256 (and ids, if asked for).

    Null text counts as empty and has no tokens; repeated rows and null identifiers are encoded like any other;
    an empty table gives an empty result. Only the two columns are read.
    """
    path = path or default_path()
    spark = df.sparkSession
    blob = Shared(spark.sparkContext.broadcast(lexicon(df, text_col, path, lexicon_words)))
    own = short_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())] + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(path, blob)
        for batch in batches:
            for a, b, texts in wordbpe.portions(batch.column(1)):
                ids = codec.encode(texts)
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(codec.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = own.mapInArrow(run, schema)
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)
