"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest

from voxelith.llm import importance

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, weight double, rank string, _b array<int>, bucket int"
ITEMS = "item_id long, text string"


def rows() -> list[tuple]:
    rnd = random.Random(3)
    some = "alpha Beta gamma déjà 日本 x2 \U0001f600 İstanbul ÀB".split()
    texts = [" ".join(rnd.choice(some) + rnd.choice(["", ",", "\n", "\x00", "--"]) for _ in range(rnd.randrange(0, 60))) for _ in range(120)]
    texts += [None, "", " \t ", "!!", "one", "one two", "a" * 50_000, "w " * 30_000, texts[0], texts[1]]
    out = [(i, t, 1.0, "clash", [1], 2) for i, t in enumerate(texts)]
    return out + [out[5], out[5], (None, texts[7], None, None, None, None), (None, None, None, None, None, None), (700, texts[7], None, None, None, None)]


TARGET = [(1, "alpha beta gamma"), (2, "déjà vu alpha beta"), (3, None), (4, ""), (4, "x2")]


def buckets(text: str | None) -> tuple[int, list[int]]:
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    s, t = [0] * 10_000, [0] * 10_000
    for rows_, counts in ((docs, s), (items, t)):
        for r in rows_:
            for b in buckets(r[1])[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log(((t[b] + 1.0) * (sum(s) + 10_000.0)) / ((s[b] + 1.0) * (sum(t) + 10_000.0)))) for b in range(10_000)]
    out = []
    for r in docs:
        n, own = buckets(r[1])
        h = int(hashlib.sha256(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        out.append([r[0], len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("times", [1, 4])
def test_resample(spark, times):
    docs = rows() * times
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    got = importance.resample(df, spark.createDataFrame(TARGET, ITEMS))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, TARGET)


def test_without_rows(spark):
    docs, items = (spark.createDataFrame([], s) for s in (DOCS, ITEMS))
    full = spark.createDataFrame(rows(), DOCS)
    assert importance.resample(docs, spark.createDataFrame(TARGET, ITEMS)).count() == 0
    assert sorted(map(tuple, importance.resample(full, items).collect()), key=repr) == plain(rows(), [])
    assert importance.resample(docs, items).count() == 0


def test_no_feature_becomes_a_row_of_scoring(spark):
    plan = importance.scored(spark.createDataFrame([(1, [1, 2])], "_id long, _b array<int>"), list(range(10_000)))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan


def test_features_of():
    assert [importance.features_of(n) for n in (0, 1, 2, 3, 20)] == [0, 1, 3, 6, 57]
    assert len(importance.APART) == 128 - 26 - 26 - 10
