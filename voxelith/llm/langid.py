"""Language ID with word-first backoff.

A word seen in training is scored by its log frequency in each language. A word not seen is scored by its
longest known character n-grams: those of 5 characters if any is known, else those of 4, and so on. A text
is the language with the largest sum over its words.

The model is fitted on a bounded sample: of each language about DOCS_PER_LANGUAGE labelled documents, chosen by
a hash of the identifier, and knows all their words and all the n-grams of those. Every labelled language is
learned, and none takes room from another, so what is collected and broadcast is bounded by the samples, and not by
the corpus; every document is scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Shared, short_batches, worker_state
from .wordbpe import Numbers, portions

DOCS_PER_LANGUAGE = 1_000
GRAM = 5
SMOOTH = 0.5
UNKNOWN = "und"
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
CACHED_CHUNKS, CACHED_SCORES, SCORES_AT_ONCE = 200_000, 4_000_000, 1_000_000
COUNTED_AT_ONCE = 200_000


def grams(word: str, n: int) -> list[str]:
    """Its n-grams, with marks at both ends; single characters without."""
    marked = word if n == 1 else f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _counted(batches: Iterator[pa.RecordBatch], keys) -> Iterator[pa.RecordBatch]:
    """Sums keys(batch) -> (kind, lang, item, n) within the partition."""
    seen: Counter = Counter()

    def flush() -> pa.RecordBatch:
        kind, lang, item = zip(*seen, strict=True) if seen else ((), (), ())
        out = pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(lang, pa.string()), pa.array(item, pa.string()), pa.array(list(seen.values()), pa.int64())], names=["kind", "lang", "item", "n"])
        seen.clear()
        return out

    for batch in batches:
        for kind, lang, item, n in keys(batch):
            seen[kind, lang, item] += n
            if len(seen) > COUNTED_AT_ONCE:
                yield flush()
    yield flush()


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _counted(batches, lambda b: ((0, lang.as_py(), w, 1) for lang, t in zip(b.column(0), b.column(1), strict=True) for w in WORD.findall(t.as_py().lower())))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _counted(batches, lambda b: ((n, lang, g, k) for lang, w, k in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True) for n in range(1, GRAM + 1) for g in grams(w, n)))


_SCHEMA = "kind int, lang string, item string, n long"


class Model:
    """Log frequencies by language. tables[0]: word -> row, tables[n]: n-gram -> row; a row lists the languages that have the item.

    Any other language has the item's least score: floors. So a model takes room for what was counted, not for each
    item in each language.
    """

    def __init__(self, languages: list[str], counts: list[tuple[int, str, str, int]]):
        self.languages = languages
        place = {lang: i for i, lang in enumerate(languages)}
        self.tables: list[dict[str, int]] = [{} for _ in range(GRAM + 1)]
        cells: list[list[tuple[int, int, int]]] = [[] for _ in self.tables]
        for kind, lang, item, n in counts:
            if lang in place:
                cells[kind].append((self.tables[kind].setdefault(item, len(self.tables[kind])), place[lang], n))
        self.floors, self.starts, self.langs, self.above = [], [], [], []
        for table, rows in zip(self.tables, cells, strict=True):
            row, lang, n = np.array(sorted(rows), np.int64).reshape(-1, 3).T
            # one more item than is known stands for all others
            total = np.bincount(lang, weights=n, minlength=len(languages)) + SMOOTH * (len(table) + 1)
            self.floors.append((np.log(SMOOTH) - np.log(total)).astype(np.float32))
            self.starts.append(np.searchsorted(row, np.arange(len(table) + 1)))
            self.langs.append(lang.astype(np.int32))
            self.above.append((np.log(n + SMOOTH) - np.log(SMOOTH)).astype(np.float32))

    def items(self, word: str) -> tuple[int, list[int]]:
        """(kind, rows) that score a word: its own row, or those of its longest known n-grams; no rows without any."""
        row = self.tables[0].get(word)
        if row is not None:
            return 0, [row]
        for n in range(GRAM, 0, -1):
            table = self.tables[n]
            known = [row for g in grams(word, n) if (row := table.get(g)) is not None]
            if known:
                return n, known
        return 0, []

    def sums(self, words: list[list[str]]) -> np.ndarray:
        """The sum of the scores of each list of words, a row each; a word's score is the mean over its rows."""
        out, width = np.zeros((len(words), len(self.languages))), len(self.languages)
        met: list[tuple[list[int], list[int], list[int], list[float]]] = [([], [], [], []) for _ in self.tables]
        for i, own in enumerate(words):
            for w in own:
                kind, rows = self.items(w)
                if rows:
                    of, owner, row, weight = met[kind]
                    of.append(i)
                    owner += [i] * len(rows)
                    row += rows
                    weight += [1 / len(rows)] * len(rows)
        for kind, (of, owner, row, weight) in enumerate(met):
            if not of:
                continue
            out += np.bincount(of, minlength=len(words))[:, None] * self.floors[kind]
            start = self.starts[kind][row]
            each = self.starts[kind][np.array(row) + 1] - start
            at = np.repeat(start - np.cumsum(each) + each, each) + np.arange(each.sum())
            key = np.repeat(owner, each) * width + self.langs[kind][at]
            out += np.bincount(key, self.above[kind][at] * np.repeat(weight, each), out.size).reshape(out.shape)
        return out

    def word(self, word: str) -> np.ndarray:
        return self.sums([[word]])[0]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """docs: those to learn from. Null languages and texts teach nothing."""
    labelled = short_batches(docs).select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).cast("string").alias("_text")).where("_lang IS NOT NULL AND _text IS NOT NULL")
    sizes = labelled.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").collect()  # one row a language
    languages = [r["_lang"] for r in sizes]
    if not languages:
        return Model([], [])
    spark = docs.sparkSession
    rates = spark.createDataFrame([(r["_lang"], min(1.0, docs_per_language / r["count"])) for r in sizes], "_lang string, _rate double")
    draw = F.pmod(F.xxhash64(F.lit("langid"), "_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.withColumn("_draw", draw).join(F.broadcast(rates), "_lang").where("_draw < _rate").select("_lang", "_text")
    sums = lambda df: df.groupBy("kind", "lang", "item").agg(F.sum("n").alias("n"))
    words = sums(sample.mapInArrow(_words, _SCHEMA)).persist()
    try:
        pieces = sums(words.select("lang", "item", "n").mapInArrow(_grams, _SCHEMA))
        rows = []
        for df in (words, pieces):
            every = df.toArrow()  # the sample bounds it
            rows += list(zip(*(every.column(c).to_pylist() for c in ("kind", "lang", "item", "n")), strict=True))
    finally:
        words.unpersist()
    return Model(languages, rows)


class Scorer:
    """Sums of word scores of texts, each distinct chunk between spaces scored once."""

    def __init__(self, model: Model):
        self.model, self.width = model, max(1, len(model.languages))
        self.limit = max(20_000, min(CACHED_CHUNKS, CACHED_SCORES // self.width))
        self.forget()

    def forget(self) -> None:
        self.known = Numbers()
        self.scores, self.n_words = np.zeros((1024, self.width), np.float32), np.zeros(1024, np.int64)

    def _score(self, chunks: list[str], first: int) -> None:
        while first + len(chunks) > len(self.n_words):
            self.scores, self.n_words = np.concatenate([self.scores, np.zeros_like(self.scores)]), np.concatenate([self.n_words, np.zeros_like(self.n_words)])
        at_once = max(1, SCORES_AT_ONCE // self.width)
        for a in range(0, len(chunks), at_once):
            words = [WORD.findall(c) for c in chunks[a : a + at_once]]
            self.n_words[first + a : first + a + len(words)] = [len(w) for w in words]
            if self.model.languages:
                self.scores[first + a : first + a + len(words)] = self.model.sums(words)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if len(self.known) > self.limit:
            self.forget()
        before, number = len(self.known), self.known.__getitem__
        of = [np.array(list(map(number, t.lower().split())) if t else [], np.int64) for t in texts]
        self._score(list(self.known)[before:], before)
        labels, scores = [], []
        for x in of:
            if not len(x) or not self.model.languages or not self.n_words[x].sum():
                labels.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = self.scores[x].sum(axis=0, dtype=np.float64)
            best = int(total.argmax())  # of equals the most frequent language
            labels.append(self.model.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return labels, scores


def worker_scorer(model: Shared) -> Scorer:
    """A worker's later tasks find the words of its earlier ones."""
    return worker_state(("langid", model), lambda: Scorer(model.value))


def held_out(id_col: str | Column) -> Column:
    key = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(key.cast("string")) % 4 == 2


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: id, held_out, lang_pred, score.

    A text that is null or has no letter is `und` with score 0; so is every text if nothing was learned. score
    is the share of the language among all, 0 to 1. A null identifier is not held out, and not learned from.
    An empty table gives an empty result. No column but the two is read.
    """
    shared = Shared(df.sparkSession.sparkContext.broadcast(model))
    own = short_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_scorer(shared)
        for batch in batches:
            for a, b, texts in portions(batch.column(2)):
                labels, scores = scorer.predict(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    out = own.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the documents that aren't held out and predicts all."""
    return predict(df, train(df.where(~held_out(id_col)), text_col, lang_col, id_col), id_col, text_col)
