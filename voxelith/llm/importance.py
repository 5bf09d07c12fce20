"""Target-distribution importance resampling over hashed n-grams, in DataFrame functions.

A document's features are its runs of 1 to 3 words; each falls into one of a fixed number of buckets. How much
more often a bucket is met in the target than in the source is its gain, and a document's weight is the sum of
the gains of its features. Adding Gumbel noise seeded by the identifier and taking the highest scores draws
documents without replacement in proportion to exp(weight).

Scoring makes no row for a feature: higher-order functions give each document its array of buckets, written once,
and an aggregate adds element_at() of a literal array of gains. Counting the source combines within each task, so what
is shuffled is one row a bucket and task. Ranks come from the distinct scores, ranges of which have running sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelith.functions.numbers import running

from .common import Scratch

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Of gains and noise: thousandths.
SCALE = 1000
#: A word is a run of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z are lower-cased, so these part words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
APART = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def words(text: Column) -> Column:
    """Null as no words."""
    spaced = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER + APART, LOWER + " " * len(APART))
    return F.array_remove(F.split(spaced, " "), "")


def buckets(text: Column, longest: int = LONGEST, count: int = BUCKETS) -> Column:
    """The bucket, from 1 on, of each run of 1 to `longest` words."""

    def runs(w: Column, n: int) -> Column:
        gram = lambda x, i: F.concat(x, *[y for j in range(1, n) for y in (F.lit(" "), F.get(w, i + j))])
        begins = w if n == 1 else F.slice(w, F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(0)))
        return F.transform(begins, lambda x, i: (F.crc32(gram(x, i).cast("binary")) % count + 1).cast("int"))

    # the variable of an outer lambda holds the words: a column of them could be moved into the inner ones and made again for each
    return F.get(F.transform(F.array(words(text)), lambda w: F.concat(*[runs(w, n) for n in range(1, longest + 1)])), F.lit(0))


def features_of(n_words: int, longest: int = LONGEST) -> int:
    return sum(max(0, n_words - n) for n in range(longest))


def counted(found: DataFrame, name: str) -> DataFrame:
    """(bucket, name): features of all rows of found (_b) in each bucket that has any."""
    # explode() alone has Spark look first, in a filter of its own, whether there is anything to explode
    return found.select(F.explode_outer("_b").alias("bucket")).groupBy("bucket").agg(F.count("bucket").alias(name)).where("bucket IS NOT NULL")


def gains(source: DataFrame, target: DataFrame, count: int = BUCKETS) -> list[int]:
    """Of each bucket: 1000 times the logarithm of how much more of the target than of the source it holds, one added to each count. Rows have their buckets in _b."""
    s, t = counted(source, "s"), counted(target, "t")
    every = source.sparkSession.range(1, count + 1).select(F.col("id").cast("int").alias("bucket")).join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"])
    d = lambda c: c.cast("double")
    both = every.crossJoin(F.broadcast(every.agg(F.sum("s").alias("s_all"), F.sum("t").alias("t_all"))))  # one row
    ratio = (d(F.col("t") + 1) * d(F.col("s_all") + count)) / (d(F.col("s") + 1) * d(F.col("t_all") + count))
    rows = both.select("bucket", F.floor(SCALE * F.log(ratio)).cast("long").alias("gain")).collect()  # one row a bucket
    return [r["gain"] for r in sorted(rows)]


def noise(key: Column, seed: int = SEED) -> Column:
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def scored(found: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """(_id, n_features, weight, score) of each row of found (_id, _b)."""
    table = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<long>")  # folded into one literal
    both = F.get(F.transform(F.array("_b"), lambda b: F.struct(F.size(b).cast("long").alias("n_features"), F.aggregate(b, F.lit(0).cast("long"), lambda total, i: total + F.element_at(table, i)).alias("weight"))), F.lit(0))
    out = found.select("_id", both.alias("_s")).select("_id", "_s.n_features", "_s.weight")
    return out.withColumn("score", F.col("weight") + noise(F.col("_id"), seed))


def ranked(scores: DataFrame, draw: int) -> DataFrame:
    """scores with a rank, from 1 on, for the `draw` highest; of equals the smaller _id first, null last. scores: a written table.

    Equal scores are one row with their number; the running sum goes over ranges of scores, and rows are numbered within one score.
    """
    runs = running(scores.groupBy((-F.col("score")).alias("_minus")).agg(F.count("*").alias("_k")), "_minus", "_k", "_before").where(F.col("_before") < draw)
    last = runs.agg(F.min(-F.col("_minus"))).first()[0]  # one number
    none = F.lit(None).cast("long").alias("rank")
    if last is None:
        return scores.select("*", none)
    within = F.row_number().over(Window.partitionBy("score").orderBy(F.col("_id").asc_nulls_last()))
    top = scores.where(F.col("score") >= last).withColumn("_n", within).join(runs.select((-F.col("_minus")).alias("score"), "_before"), "score")
    place = (F.col("_before") + F.col("_n")).cast("long")
    return top.select(*scores.columns, F.when(place <= draw, place).alias("rank")).union(scores.where(F.col("score") < last).select("*", none))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", longest: int = LONGEST, count: int = BUCKETS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """One row per row of docs: id, n_features, weight, score, rank; rank is null where a row isn't drawn.

    Null and empty texts, of either table, have no features and weight 0; they and all texts of fewer than `least_words`
    words are not drawn. Rows that repeat an identifier are rows of their own; a null one has the noise of an empty
    identifier and comes last among equal scores. Without documents the result is empty; without a target each gain
    compares with even counts. No columns but these are read.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    found = scratch.store(docs.select(F.col(id_col).cast("long").alias("_id"), buckets(F.col(text_col), longest, count).alias("_b")))
    gain = gains(found, target.select(buckets(F.col(target_col), longest, count).alias("_b")), count)
    scores = scratch.store(scored(found, gain, seed))
    scratch.free(found)
    enough = F.col("n_features") >= features_of(least_words, longest)
    some = scores.where(enough)
    out = ranked(some, percent * some.count() // 100).union(scores.where(~enough).select("*", F.lit(None).cast("long")))
    return out.select(F.col("_id").alias(id_col), "n_features", "weight", "score", "rank")
