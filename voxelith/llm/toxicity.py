"""Toxicity by multiple-instance learning: documents have labels, sentences get scores.

A document is a bag of sentences (pieces of at most PIECE words of one sentence). A sentence is toxic with the
logistic of a bias and the weights of its words' features (the word and its beginnings); a document is toxic
unless all its sentences are harmless and a small leak, which stands for wrong labels, is closed: noisy-or. The
weights are fitted to document labels alone, and the gradient of the noisy-or gives the credit to those
sentences that can explain a label; so the sentences of a document that offend are found without a label of
their own.

Weights are not negative: a sentence can only speak for toxicity, and any length of harmless text adds next to
nothing. Only features that come with a label clearly more often than by chance are fitted. Fitting takes a
bounded sample of labelled documents; its rounds add gradients in fixed point, so they do not depend on the
partitioning.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, Shared, short_batches, small, stateless, worker_state
from .langid import held_out
from .wordbpe import Numbers, portions

#: Labelled documents that are learned from, at most about so many of each label, chosen by a hash of the identifier.
DOCS_PER_LABEL = 6_000
PIECE = 50
#: Characters of a word's beginnings that are features of their own.
BEGINNINGS = (4, 5, 6)
#: Of a feature's association with the label: twice the log likelihood ratio, and documents at least.
LEAST_RATIO, LEAST_DOCS = 12.0, 3
ROUNDS, STEP, SPARSITY, LEAK, MOST_WEIGHT = 40, 0.2, 0.1, 0.001, 12.0
THRESHOLD = 0.3
#: Of gradients in fixed point.
UNIT = float(1 << 24)
TOKEN = regex.compile(r"[\p{L}\p{M}]+|[.!?\n]")
NOT_IN_WORD = regex.compile(r"[^\p{L}\p{M}]")
ENDS = frozenset(".!?\n")
#: Bias of a model that has learned nothing, and where fitting begins.
NOTHING, FIRST_BIAS = -20.0, -7.0
CACHED, CHARS_AT_ONCE = 400_000, 1_000_000
#: Sampled documents of one task of a round.
DOCS_PER_TASK = 2_000
COUNTED_AT_ONCE = 300_000


def features(word: str) -> list[str]:
    """Of a word in lower case."""
    return [word, *["^" + word[:n] for n in BEGINNINGS if len(word) >= n]]


def cut(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the words, where each piece of theirs begins): ends marks the tokens that end a sentence."""
    words = np.flatnonzero(~ends)
    if not len(words):
        return words, words
    sentence = np.cumsum(ends)[words]
    fresh = np.r_[True, sentence[1:] != sentence[:-1]]
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(words)), 0))
    return words, np.flatnonzero((np.arange(len(words)) - first) % PIECE == 0)


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """(start, stop) of parts of bounded length, between words, so that no list of all tokens of a very long text is made."""
    start = 0
    while len(text) - start > CHARS_AT_ONCE and (m := NOT_IN_WORD.search(text, start + CHARS_AT_ONCE)):
        yield start, m.start()
        start = m.start()
    yield start, len(text)


class Model:
    """weights: feature -> weight; those of 0 are left out."""

    def __init__(self, weights: dict[str, float], bias: float, leak: float = LEAK):
        self.weights, self.bias, self.leak = weights, bias, leak

    def word(self, token: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(token.lower()))


class Scorer:
    """Scores of texts, each distinct word looked up once."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.number, self.value, self.ends = Numbers(), np.zeros(1024), np.zeros(1024, bool)

    def _tokens(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.number) > CACHED:
            self.forget()
        before, number = len(self.number), self.number.__getitem__
        out = [np.concatenate([np.fromiter(map(number, TOKEN.findall(t, a, b)), np.int64) for a, b in stretches(t)]) for t in texts]
        fresh = list(islice(reversed(self.number), len(self.number) - before))[::-1]
        while len(self.number) > len(self.value):
            self.value, self.ends = (np.concatenate([a, np.zeros_like(a)]) for a in (self.value, self.ends))
        self.value[before : len(self.number)] = [self.model.word(t) for t in fresh]
        self.ends[before : len(self.number)] = [t in ENDS for t in fresh]
        return out

    def pieces(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of the words among the tokens, where pieces begin among the words, the toxicity of each piece before the logistic)."""
        words, starts = cut(self.ends[tokens])
        return words, starts, self.model.bias + (np.add.reduceat(self.value[tokens[words]], starts) if len(starts) else np.zeros(0))

    def scores(self, texts: list[str]) -> Iterator[tuple[float, int, list[tuple[int, int, float]]]]:
        """Of each text: its score, the number of its pieces, and (start, end, score) of those at or above the threshold."""
        for text, tokens in zip(texts, self._tokens(texts), strict=True):
            words, starts, z = self.pieces(tokens)
            score = 1 - (1 - self.model.leak) * math.exp(-np.logaddexp(0, z).sum())
            own = 1 / (1 + np.exp(-z))
            where = np.flatnonzero(own >= THRESHOLD)
            spans = []
            if len(where):
                # the tokens of such pieces alone are looked for again
                last = np.r_[starts[1:], len(words)] - 1
                wanted = {int(words[i]) for i in (*starts[where], *last[where])}
                at = {i: m.span() for i, m in enumerate(TOKEN.finditer(text)) if i in wanted}
                spans = [(at[int(words[starts[i]])][0], at[int(words[last[i]])][1], float(own[i])) for i in where]
            yield score, len(starts), spans


def learned(labels: DataFrame, id_col: str, label_col: str, docs_per_label: int) -> tuple[DataFrame, dict[int, float]]:
    """(sample (_id, _label), how many documents one of each label stands for)."""
    own = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where("_id IS NOT NULL AND _label IN (0, 1)").where(~held_out("_id"))
    own = own.groupBy("_id").agg(F.max("_label").alias("_label"))
    each = {r["_label"]: max(1.0, r["count"] / docs_per_label) for r in own.groupBy("_label").count().collect()}  # two rows
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("_id")), F.lit(1 << 20)) / float(1 << 20)
    return own.where(draw * F.when(F.col("_label") == 1, each.get(1, 1.0)).otherwise(each.get(0, 1.0)) < 1), each


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, label) -> documents that have it, within the partition."""
    seen: Counter = Counter()

    def flush() -> pa.RecordBatch:
        names = [k[0] for k in seen], [k[1] for k in seen], list(seen.values())
        seen.clear()
        return pa.RecordBatch.from_arrays([pa.array(names[0], pa.string()), pa.array(names[1], pa.int32()), pa.array(names[2], pa.int64())], names=["feature", "label", "n"])

    stateless()
    for batch in batches:
        for a, b, texts in portions(batch.column(1)):
            for label, text in zip(batch.column(0).slice(a, b - a).to_pylist(), texts, strict=True):
                for f in {f for w in set(TOKEN.findall(text.lower())) if w not in ENDS for f in features(w)}:
                    seen[f, label] += 1
                if len(seen) > COUNTED_AT_ONCE:
                    yield flush()
    yield flush()


def associated(counts: DataFrame, toxic: int, clean: int) -> DataFrame:
    """(feature, toxic, clean): features that come with the label more often than by chance, by twice their log likelihood ratio."""
    one = lambda k, n: F.coalesce(F.sum(F.when(F.col("label") == k, F.col("n"))), F.lit(0)).alias(n)
    both = counts.groupBy("feature").agg(one(1, "toxic"), one(0, "clean")).where(F.col("toxic") + F.col("clean") >= LEAST_DOCS)
    part = lambda x, of, rows: F.when(x > 0, x * F.log(x * float(toxic + clean) / (of * float(rows)))).otherwise(0.0)
    of = F.col("toxic") + F.col("clean")
    rest = float(toxic + clean) - of
    ratio = 2 * (part(F.col("toxic"), of, toxic) + part(F.col("clean"), of, clean) + part(toxic - F.col("toxic"), rest, toxic) + part(clean - F.col("clean"), rest, clean))
    return both.where((F.col("toxic") * float(clean) > F.col("clean") * float(toxic)) & (ratio >= LEAST_RATIO))


def _bags(vocabulary: Shared):
    """Documents as (label, features of all pieces that have any, where each such piece ends, pieces without)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        stateless()
        for batch in batches:
            for a, b, texts in portions(batch.column(1)):
                rows, ends, without = [], [], []
                for text in texts:
                    tokens = TOKEN.findall(text.lower())
                    words, starts = cut(np.array([t in ENDS for t in tokens], bool))
                    own, stops, none = [], [], 0
                    for i, j in zip(starts, np.r_[starts[1:], len(words)], strict=True):
                        found = [known[f] for w in words[i:j] for f in features(tokens[w]) if f in known]
                        own += found
                        none += not found
                        if found:
                            stops.append(len(own))
                    rows.append(own)
                    ends.append(stops)
                    without.append(none)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(rows, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(without, pa.int64())], names=["label", "features", "ends", "without"])

    return run


def gradient(label: np.ndarray, lists: list[np.ndarray], ends: list[np.ndarray], without: np.ndarray, weights: np.ndarray, bias: float, each: dict[int, float], leak: float = LEAK) -> tuple[np.ndarray, float]:
    """Of minus the log likelihood of documents as _bags() has them, by weight and last by bias, in fixed point; and that itself.

    Each piece's share is rounded by itself and then summed in whole numbers, so that sums do not depend on the order of documents.
    """
    empty = [np.zeros(0, np.int64)]
    flat = np.concatenate(empty + lists).astype(np.int64)
    offset = np.cumsum([0, *map(len, lists)])[:-1]
    stops = np.concatenate(empty + [e + o for e, o in zip(ends, offset, strict=True)]).astype(np.int64)
    starts = np.r_[0, stops[:-1]].astype(np.int64)
    of = np.repeat(np.arange(len(label)), [len(e) for e in ends])
    z = bias + (np.add.reduceat(weights[flat], starts) if len(stops) else np.zeros(0))
    harmless = np.bincount(of, np.logaddexp(0, z), len(label)) + without * np.logaddexp(0, bias)
    q = 1 - (1 - leak) * np.exp(-harmless)
    stands = np.where(label == 1, each.get(1, 1.0), each.get(0, 1.0))
    slope = np.where(label == 1, -(1 - q) / q, 1.0) * stands
    by_piece = np.rint(slope[of] / (1 + np.exp(-z)) * UNIT)
    by_weight = np.bincount(flat, np.repeat(by_piece, stops - starts), len(weights))
    by_bias = by_piece.sum() + np.rint(slope * without / (1 + math.exp(-bias)) * UNIT).sum()
    loss = -(stands * np.where(label == 1, np.log(q), -harmless + math.log(1 - leak))).sum()
    return np.r_[by_weight, by_bias], float(loss)


def fitted(bags: DataFrame, weights: np.ndarray, bias: float, each: dict[int, float], rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Steps along the gradient with momentum, damped by past gradients and kept from going below 0.

    A round is one pass over bags, a written table; its sums, one row a feature, come to the driver.
    """
    m, v = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)
    for turn in range(1, rounds + 1):
        shared = bags.sparkSession.sparkContext.broadcast((weights, bias))

        def part(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(shared.value[0]) + 1)
            for batch in batches:
                lists, ends = ([np.asarray(x, np.int64) for x in batch.column(i).to_pylist()] for i in (1, 2))
                total += gradient(batch.column(0).to_numpy(), lists, ends, batch.column(3).to_numpy(), *shared.value, each)[0]
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at].astype(np.int64))], names=["feature", "g"])

        sums = bags.mapInArrow(part, "feature long, g long").groupBy("feature").agg(F.sum("g").alias("g")).toArrow()
        shared.unpersist()
        g = np.zeros(len(weights) + 1)
        g[sums.column("feature").to_numpy()] = sums.column("g").to_numpy() / UNIT
        g[:-1] += SPARSITY
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = STEP * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1)
        weights, bias = np.clip(weights - step[:-1], 0, MOST_WEIGHT), bias - float(step[-1])
    return weights, bias


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", docs_per_label: int = DOCS_PER_LABEL, rounds: int = ROUNDS) -> Model:
    """Learns from labelled documents that are not held out.

    A document with several labels has the largest; null labels and identifiers, labels other than 0 and 1, and labels
    without a document teach nothing. Without a feature that comes with the label nothing is learned.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    drawn, each = learned(labels, id_col, label_col, docs_per_label)
    drawn = scratch.store(drawn)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    # so many identifiers as are drawn at most, counted before they are broadcast
    sample = short_batches(scratch.store(texts.join(small(drawn, drawn.count()), "_id").select("_label", "_text")))
    sizes = {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}  # two rows
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    counts = sample.mapInArrow(_counts, "feature string, label int, n long")
    found = sorted(map(tuple, associated(counts, toxic, clean).collect())) if toxic and clean else []  # bounded by the sample
    if not found:
        return Model({}, NOTHING)
    names = [f for f, _, _ in found]
    shared = Shared(spark.sparkContext.broadcast({f: i for i, f in enumerate(names)}))
    bags = scratch.store(sample.mapInArrow(_bags(shared), "label int, features array<int>, ends array<int>, without long")).coalesce(1 + (toxic + clean) // DOCS_PER_TASK)
    t, c = (np.array([r[i] for r in found], float) for i in (1, 2))
    first = np.log((t + 0.5) / (toxic + 1)) - np.log((c * each.get(0, 1.0) + 0.5) / (clean * each.get(0, 1.0) + 1))
    weights, bias = fitted(bags, np.clip(first, 0, None) / 2, FIRST_BIAS, each, rounds)
    scratch.clear()
    return Model({f: float(w) for f, w in zip(names, weights, strict=True) if w > 0}, bias)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: id, held_out, score, predicted, n_pieces, offending.

    score is the probability, by noisy-or over the sentences, that the label is 1; a null or empty text, or one without
    letters, has that of the leak. predicted is 1 from THRESHOLD on. offending has the sentences (of a longer one the
    pieces of PIECE words) whose own score is as high: array of (start, end, score), in code points, end exclusive,
    from the first word to the last. A null identifier is not held out, and not learned from; repeated rows are scored
    alike; an empty table gives an empty result. No column but the two is read.
    """
    shared = Shared(df.sparkSession.sparkContext.broadcast(model))
    own = short_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_state(("toxicity", shared), lambda: Scorer(shared.value))
        for batch in batches:
            for a, b, texts in portions(batch.column(2)):
                scores, pieces, spans = zip(*scorer.scores(texts), strict=True)
                rows = [[dict(zip(("start", "end", "score"), s, strict=True)) for s in own] for own in spans]
                columns = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(scores, pa.float64()), pa.array([int(x >= THRESHOLD) for x in scores], pa.int32()), pa.array(pieces, pa.int64()), pa.array(rows, pa.list_(span))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted", "n_pieces", "offending"])

    out = own.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_pieces long, offending array<struct<start:long,end:long,score:double>>")
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Learns from the labelled documents that aren't held out and scores all."""
    return score(docs, train(docs, labels, id_col, text_col, label_col), id_col, text_col)


def spans(offending: str | Column = "offending") -> Column:
    """offending as text: start:end, joined by commas."""
    return F.concat_ws(",", F.transform(offending, lambda s: F.concat_ws(":", s["start"], s["end"])))
