"""The mix where rows tie: as many of them are taken as the target needs, in allocation() as in SQL, and in mix()."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from voxelith.llm import common, mixing

SCHEMA = "doc_id long, text string, source string, other int"
TIED = {
    "one_id": [(7 if i < 900 else i, "five words are in it", "s0", i % 2) for i in range(1000)] + [(2000 + i, "two words", "s1", 0) for i in range(40)],
    "null_ids": [(None, "five words are in it", "s0", 0) for _ in range(700)] + [(None, None, "s0", 0)] * 30 + [(i, "a b c", None, 0) for i in range(300)],
    "one_id_many_texts": [(7, f"{i} word " + "x " * (i % 5), "s0", 0) for i in range(600)] + [(i, "a", "s2", 0) for i in range(90)],
    "no_words": [(7, " ", "s0", 0)] * 50 + [(None, None, None, 0)] * 20,
}


@pytest.mark.parametrize("case", sorted(TIED))
def test_ties(spark, case, monkeypatch):
    import duckdb

    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", 100)  # ties go over several lots
    df = spark.createDataFrame(TIED[case], SCHEMA).repartition(3)
    mine = mixing.allocation(df)
    rows = sorted(map(tuple, mine.collect()), key=repr)
    duck = duckdb.connect()
    duck.register("documents", df.toArrow())
    other = duck.execute(f"SELECT {', '.join(mine.columns)} FROM ({mixing.SQL})").fetchall()
    assert len(rows) == len(TIED[case]) and rows == sorted(other, key=repr)
    taken, longest = {}, max(r[1] for r in rows)
    for _, size, source_size, target, n, _ in rows:
        assert n <= 3 * size
        taken[source_size, target] = taken.get((source_size, target), 0) + n
    assert all(abs(n - target) <= longest for (_, target), n in taken.items())
    assert rows == sorted(map(tuple, mixing.allocation(df.repartition(5)).collect()), key=repr)


@pytest.mark.parametrize("case", sorted(TIED))
def test_mix_of_ties(spark, case):
    df = spark.createDataFrame(TIED[case], SCHEMA).repartition(3)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    words = lambda d: {r.source: r.n for r in d.groupBy("source").agg(F.sum(common.word_count("text")).alias("n")).collect()}
    sizes, taken = words(df), words(mixed)
    target = {r.source_size: r.target for r in mixing.allocation(df).select("source_size", "target").distinct().collect()}
    longest = df.agg(F.max(common.word_count("text"))).first()[0]
    for source, size in sizes.items():
        assert abs(taken.get(source, 0) - target[size]) <= longest
    # only rows that are there, each three times its number at most
    every, out = ({tuple(r)[:-1]: r[-1] for r in d.groupBy(*d.columns).count().collect()} for d in (df, mixed))
    assert set(out) <= set(every) and all(n <= 3 * every[r] for r, n in out.items())


def test_mix_keeps_columns_that_cannot_be_compared(spark):
    df = spark.createDataFrame([(1, "a b", "s0", {"k": i % 2}) for i in range(20)], "doc_id long, text string, source string, m map<string,int>")
    assert mixing.mix(df).count() == 20
