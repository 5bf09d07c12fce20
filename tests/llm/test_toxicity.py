"""Multiple-instance learning of toxicity: the gradient, the scores in plain Python, what is caught and where."""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelith.llm import toxicity

DOCS = "doc_id long, text string, lang string, label int, _text string, score double"
LABELS = "doc_id long, quality int, toxic int, text string"
INSULTS = "grumblehead nastiling wormtongue".split()


def documents(n: int = 400) -> tuple[list[tuple], dict[int, int]]:
    rnd = random.Random(11)
    plain = ["".join(rnd.choice("aeioumnrst") for _ in range(rnd.randrange(2, 9))) for _ in range(900)]
    out, toxic = [], {}
    for i in range(n):
        sentences = [[rnd.choice(plain) for _ in range(rnd.randrange(1, 14))] for _ in range(rnd.randrange(1, 12))]
        toxic[i] = int(i % 5 == 0)
        if toxic[i]:
            rnd.choice(sentences).append(rnd.choice(INSULTS) + rnd.choice(["", "s", "ly"]))
        out.append((i, ". ".join(" ".join(s).capitalize() for s in sentences) + ".", "en", 3, "clash", 0.5))
    return out, toxic


@pytest.fixture(scope="module")
def tables(spark):
    docs, toxic = documents()
    more = [(1000, None, None, None, None, None), (1001, "", "", 0, "", 0.0), (1002, "12 %%% 34", "", 0, "", 0.0), (None, "grumblehead", "", 0, "", 0.0), docs[5], docs[5], (1003, "so " * 90_000 + "wormtongue " + "so " * 90_000, "", 0, "", 0.0)]
    marks = [(i, 1, t, "x") for i, t in toxic.items()] + [(None, 1, 1, ""), (7, 1, None, ""), (5000, 1, 1, ""), (8, 0, 0, ""), (9, 0, 5, "")]
    return spark.createDataFrame(docs + more, DOCS), spark.createDataFrame(marks, LABELS), docs + more, toxic


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.train(tables[0].repartition(3), tables[1])


def plain_score(model, text: str | None) -> tuple[float, int, list[tuple[int, int]]]:
    harmless, n, spans = 0.0, 0, []
    words = []

    def close():
        nonlocal harmless, n, words
        for a in range(0, len(words), toxicity.PIECE):
            piece = words[a : a + toxicity.PIECE]
            z = model.bias + sum(model.weights.get(f, 0.0) for w in piece for f in [w[0], *["^" + w[0][:k] for k in (4, 5, 6) if len(w[0]) >= k]])
            harmless += math.log1p(math.exp(z))
            n += 1
            if 1 / (1 + math.exp(-z)) >= 0.3:
                spans.append((piece[0][1], piece[-1][2]))
        words = []

    for m in re.finditer(r"[^\W\d_]+|[.!?\n]", text or ""):
        if m[0] in ".!?\n":
            close()
        else:
            words.append((m[0].lower(), m.start(), m.end()))
    close()
    return 1 - (1 - model.leak) * math.exp(-harmless), n, spans


def test_scores(tables, model):
    docs, _, rows, _ = tables
    got = toxicity.score(docs.repartition(4), model)
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "n_pieces", "offending"]
    out = sorted(got.collect(), key=lambda r: repr(r.doc_id))
    assert len(out) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in out:
        expected, n, spans = plain_score(model, text[r.doc_id])
        assert r.score == pytest.approx(expected, abs=1e-9) and r.n_pieces == n and [(s.start, s.end) for s in r.offending] == spans
        assert r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_catches_and_locates(tables, model):
    docs, _, rows, toxic = tables
    text = {r[0]: r[1] for r in rows}
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for i, t in toxic.items():
        assert found[i].predicted == t
        if t:  # the sentence with the insult, and no other
            assert [any(w in text[i][s.start : s.end].lower() for w in INSULTS) for s in found[i].offending] == [True]
    assert found[1003].predicted == 1 and len(found[1003].offending) == 1
    assert all(found[i].score == pytest.approx(model.leak) for i in (1000, 1001, 1002))


def test_same_under_another_partitioning(tables, model):
    docs, labels, _, _ = tables
    other = toxicity.train(docs.repartition(7), labels.repartition(2))
    assert other.weights == model.weights and other.bias == model.bias


def test_held_out_rows_teach_nothing(spark, tables, model):
    docs, labels, _, _ = tables
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = toxicity.train(docs, turned)
    assert other.weights == model.weights and other.bias == model.bias


def test_nothing_to_learn(spark, tables):
    docs, labels, _, _ = tables
    for marks in (labels.where("toxic = 0"), labels.where("false"), labels.where("toxic = 1")):
        out = toxicity.judge(docs, marks)
        assert out.where("predicted = 1").count() == 0 and out.count() == docs.count()
    assert toxicity.judge(docs.where("false"), labels).count() == 0


def test_gradient():
    rnd = np.random.default_rng(1)
    label = np.array([1, 0, 1, 0, 1])
    lists = [np.array([0, 1, 2, 1]), np.array([2, 2]), np.array([], np.int64), np.array([], np.int64), np.array([0, 3])]
    ends = [np.array([2, 4]), np.array([1, 2]), np.array([], np.int64), np.array([], np.int64), np.array([2])]
    without = np.array([3, 1, 2, 0, 0])
    w, b, each = rnd.normal(0.5, 1, 4), -1.5, {1: 1.0, 0: 2.5}
    g, loss = toxicity.gradient(label, lists, ends, without, w, b, each)
    for i in range(5):
        step = np.zeros(5)
        step[i] = 1e-5
        up = toxicity.gradient(label, lists, ends, without, w + step[:4], b + step[4], each)[1]
        assert g[i] / toxicity.UNIT == pytest.approx((up - loss) / 1e-5, rel=1e-3, abs=1e-4)
    # one document at a time gives the same sums
    parts = [toxicity.gradient(label[i : i + 1], lists[i : i + 1], ends[i : i + 1], without[i : i + 1], w, b, each)[0] for i in range(5)]
    assert (sum(parts) == g).all()


def test_stretches(monkeypatch):
    monkeypatch.setattr(toxicity, "CHARS_AT_ONCE", 7)
    text = "abc defgh ijklmnopqrst. uv"
    parts = [text[a:b] for a, b in toxicity.stretches(text)]
    assert "".join(parts) == text and [t for p in parts for t in toxicity.TOKEN.findall(p)] == toxicity.TOKEN.findall(text)
