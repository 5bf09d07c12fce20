"""Mixing sources to target weights, in DataFrame functions only.

Capped water-filling: all weight is shared over the sources; a source whose share exceeds its size times
max_epochs is clamped there and its excess is reshared by weight, until none is above. With the sources in
ascending order of cap / weight this fixpoint is one pass of running sums: a source is clamped exactly if
the level left by those before it exceeds its own cap / weight.

Documents are then sampled: target / size of the source gives a number of whole repetitions for all its
documents, and one more for the first ones in a seeded order (md5 of seed, identifier and text) until the
rest of the target is reached. That order is never sorted as a whole: sums over 4096 ranges of the hash
show the range in which the target is reached, and only that one is looked at in order. Rows that tie in
the order are one row with their number there, and as many of them are taken as the target needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, small, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = "voxelith"
#: Columns by which a source's documents are ordered.
ORDER = ("_h", "_id", "_size", "_row")
#: Rows that one task makes of a row with a number.
COPIES_AT_ONCE = 10_000


def measures(id_col: str, text_col: str, source_col: str, seed: str, row: Column | None = None) -> dict[str, Column]:
    """_id, _source, _size, _h, _row: what the plan needs of each document. row: what tells rows of one identifier and text apart."""
    return {
        "_id": F.col(id_col).cast("long"), "_source": F.col(source_col).cast("string"), "_size": word_count(F.col(text_col)),
        "_h": seeded(F.col(id_col), F.col(text_col), seed), "_row": (F.lit(0) if row is None else row).cast("long"),
    }


def seeded(key: Column, text: Column, seed: str) -> Column:
    either = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), either(key), F.lit(":"), F.md5(either(text))))


def shares(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(_source, _total) -> with _target. One row a source; the weights repeat over the sources by code point, null last."""
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    every = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("_w", F.get(every, (F.row_number().over(order) - 1) % len(weights))).withColumn("_cap", F.col("_total") * max_epochs)
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_source").asc_nulls_last())
    before, whole = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (
        ranked.withColumn("_all", F.sum("_total").over(whole))
        .withColumn("_left", F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_open", F.sum("_w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_clamped", F.col("_left") / F.col("_open") >= F.col("_cap") / F.col("_w"))
        # of the first that isn't clamped: the level of all others
        .withColumn("_level", F.min(F.when(~F.col("_clamped"), F.struct(F.col("_cap") / F.col("_w"), F.col("_left") / F.col("_open")))).over(whole))
    )
    target = F.when(F.col("_clamped"), F.col("_cap").cast("double")).otherwise(F.col("_level.col2") * F.col("_w"))
    return level.select("_source", "_total", target.alias("_target"))


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, scratch: Scratch | None = None) -> tuple[DataFrame, int]:
    """One row a source with its target and the last document, in seeded order, that is taken once more; and the number of sources.

    docs: the measures(), as a written table.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mix")
    ranges = scratch.store(docs.groupBy("_source", F.substring("_h", 1, 3).alias("_range")).agg(F.sum("_size").alias("_n")))
    sources = written = scratch.store(shares(ranges.groupBy("_source").agg(F.sum("_n").alias("_total")), weights, max_epochs), 1)
    count = sources.count()
    whole = F.when(F.col("_total") > 0, F.floor(F.col("_target") / F.col("_total"))).otherwise(F.lit(0))
    sources = sources.withColumn("_whole", whole.cast("long")).withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_total")).withColumnRenamed("_source", "_of")
    own = F.col("_source").eqNullSafe(F.col("_of"))
    running = Window.partitionBy("_of").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    met = (
        ranges.join(small(sources, count), own)
        .withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
        .groupBy("_of", "_total", "_target", "_whole", "_rest")
        .agg(F.max(F.when(F.col("_before") <= F.col("_rest"), F.struct("_range", "_before"))).alias("_met"))
        .select("_of", "_total", "_target", "_whole", "_rest", F.col("_met._range").alias("_range"), F.col("_met._before").alias("_before"))
    )
    met = scratch.store(met, count)
    inside = Window.partitionBy("_of").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    # as far as the rest, or past it if that is nearer: of rows that tie, each in its turn
    room = 2 * F.col("_rest") - 2 * F.col("_sum") - F.col("_size")
    turns = F.floor(room / (2 * F.col("_size"))) + 1
    turns = turns - (2 * (turns - 1) * F.col("_size") > room).cast("int")
    last = (
        docs.join(small(met, count), own & (F.substring("_h", 1, 3) == F.col("_range")))
        .groupBy("_of", "_rest", "_before", *ORDER).agg(F.count("*").alias("_ties"))
        .withColumn("_sum", F.col("_before") + F.coalesce(F.sum(F.col("_size") * F.col("_ties")).over(inside), F.lit(0)))
        .where(room >= 0)
        .withColumn("_turns", F.when(F.col("_size") > 0, F.least(turns, "_ties")).otherwise(F.col("_ties")))
        .groupBy(F.col("_of").alias("_of2")).agg(F.max(F.struct(*ORDER, "_ties", "_turns")).alias("_l"))
        .select("_of2", F.struct(*[F.col(f"_l.{c}").alias(c) for c in ORDER]).alias("_last"), F.col("_l._ties").alias("_ties"), F.col("_l._turns").alias("_turns"))
    )
    out = met.join(small(last, count), F.col("_of").eqNullSafe(F.col("_of2")), "left").drop("_of2")
    out = scratch.store(out, count)
    scratch.free(ranges, written, met)
    return out, count


def repeated(rows: DataFrame, sources: DataFrame, count: int) -> DataFrame:
    """rows, with their measures(), and reps: how often the mix takes each."""
    at, met = F.struct(*ORDER), (F.substring("_h", 1, 3) == F.col("_range")) & (F.col("_rest") > 0)
    joined = rows.join(small(sources, count), F.col("_source").eqNullSafe(F.col("_of")))
    extra = (F.col("_rest") > 0) & ((F.substring("_h", 1, 3) < F.col("_range")) | (met & F.coalesce(at <= F.col("_last"), F.lit(False))))
    reps = lambda more: (F.col("_whole") + more.cast("int")).cast("long")
    part = F.col("_turns") < F.col("_ties")
    if not sources.where(part & (F.col("_rest") > 0)).limit(1).count():
        return joined.withColumn("reps", reps(extra))
    # ties of which only some are taken: one row with their number, and from it so many of either kind
    tied = F.coalesce(met & part & (at == F.col("_last")), F.lit(False))
    names = joined.columns
    one = joined.where(tied).groupBy(F.col("_of").alias("_key"), at.alias("_at")).agg(F.first(F.struct(*names)).alias("_r")).select("_r.*")
    lots = one.withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_ties") - 1) / COPIES_AT_ONCE)))).repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    first = F.col("_lot") * COPIES_AT_ONCE
    each = lots.withColumn("_i", F.explode(F.sequence(first + 1, F.least(first + COPIES_AT_ONCE, "_ties")))).withColumn("reps", reps(F.col("_i") <= F.col("_turns")))
    return joined.where(~tied).withColumn("reps", reps(extra)).union(each.select(*names, "reps"))


def allocation(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per row of df: id, size, source_size, target, taken, reps.

    size counts words, null text has none; a null source is a source of its own, last in order; rows without
    words take what their source does but add nothing. Rows that repeat an identifier and a text tie in the
    seeded order, and as many of them are taken once more as the target needs. An empty table gives an empty
    result. taken is reps * size and at most max_epochs * size.
    """
    scratch = Scratch(df.sparkSession, "mix")
    docs = scratch.store(df.select(*[c.alias(n) for n, c in measures(id_col, text_col, source_col, seed).items()]))
    sources, count = plan(docs, weights, max_epochs, scratch)
    return repeated(docs, sources, count).select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_total").alias("source_size"), F.col("_target").alias("target"), (F.col("reps") * F.col("_size")).alias("taken"), "reps")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed corpus: the rows of df with all their columns, each as often as allocation() takes it; nulls, ties and repeated rows as there."""
    scratch = Scratch(df.sparkSession, "mix")
    names = [f"c{i}" for i in range(len(df.columns))]
    flat = df.toDF(*names)
    own = dict(zip(df.columns, names, strict=True))
    # identical rows stand for each other, all others are told apart
    row = F.xxhash64(*[F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in flat.schema])
    every = measures(own[id_col], own[text_col], own[source_col], seed, row)
    whole = flat.withColumns(every)
    sources, count = plan(scratch.store(whole.select(*every)), weights, max_epochs, scratch)
    taken = repeated(whole, sources, count).where("reps > 0")
    return taken.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), F.col("reps"))).alias("_rep")).select(*names).toDF(*df.columns)


SQL = rf"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents),
ranked AS (
  SELECT source, total, 3 * total AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS total FROM docs GROUP BY source)),
filled AS (
  SELECT *, CAST(sum(total) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest_total,
         sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM ranked),
clamped AS (SELECT *, rest_total / open_w >= cap / w AS is_clamped FROM filled),
targets AS (
  SELECT source, total, CASE WHEN is_clamped THEN CAST(cap AS DOUBLE)
         ELSE (SELECT arg_min(rest_total / open_w, cap / w) FROM clamped WHERE NOT is_clamped) * w END AS target
  FROM clamped),
reps AS (
  SELECT *, CASE WHEN total > 0 THEN CAST(floor(target / total) AS BIGINT) ELSE 0 END AS whole FROM targets),
sums AS (
  SELECT d.doc_id, d.size, r.total, r.target, r.whole, r.target - r.whole * r.total AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN reps r ON d.source IS NOT DISTINCT FROM r.source),
taken AS (
  SELECT *, whole + CASE WHEN rest > 0 AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END AS n FROM sums)
SELECT doc_id, size, total AS source_size, target, CAST(n * size AS BIGINT) AS taken, CAST(n AS BIGINT) AS reps FROM taken
"""
