"""Evaluation of a labeling against a ground truth: statistics found by name, over one overlap frame, and the record they make.

Overlaps are rows (typename, sv, gt, seg, n): typename is what was compared, `voxels:labels` or `synapse:points`. A
statistic gives rows for the whole volume, for each subvolume, for bodies, or for closer inspection; it declares which
kinds of comparison it is for. All rows are long frames of one shape a section, so a record is a union of frames and
nothing is gathered to make it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelith.functions.grid import AXES
from voxelith.operators import overlap

VOXELS, SYNAPSE = "voxels", "synapse"
#: The shape of each section of a record.
SUMMARY = "name string, higher_better boolean, typename string, val double, description string"
SUBVOLUMES = "sv long, name string, higher_better boolean, typename string, val double, ignore boolean"
BODIES = "name string, typename string, largest2smallest boolean, isgt boolean, body long, vals array<double>"
DEBUG = "name string, typename string, body long, other long, n long"


@dataclass(frozen=True)
class Comparison:
    """What is compared: a kind, and which data of that kind. Two are the same if both agree."""

    kind: str
    instance: str = "labels"

    def __str__(self) -> str:
        return f"{self.kind}:{self.instance}"


def kind_of(typename: str | Column = "typename") -> Column:
    return F.split_part(F.col(typename) if isinstance(typename, str) else typename, F.lit(":"), F.lit(1))


def labelled(over: DataFrame, comparison: Comparison) -> DataFrame:
    return over.select(F.lit(str(comparison)).alias("typename"), "sv", "gt", "seg", "n")


def ignored_subvolumes(over: DataFrame, sizes: DataFrame, least: float, important: DataFrame | None = None) -> DataFrame:
    """(sv, ignore): subvolumes whose ground truth is less than a percentage of their voxels or, with important bodies, that have fewer of those.

    over: (sv, gt, seg, n); sizes: (sv, size). A least of 0 ignores none.
    """
    if important is None:
        held = over.groupBy("sv").agg(F.sum("n").alias("_n"))
        share = F.coalesce("_n", F.lit(0)) * 100 / F.col("size")
    else:
        held = over.join(important.select("gt").distinct(), "gt", "left_semi").groupBy("sv").agg(F.count("*").alias("_n"))
        share = F.coalesce("_n", F.lit(0))
    return sizes.join(held, "sv", "left").select("sv", (F.lit(least > 0) & (share < least)).alias("ignore"))


def boundary_bodies(df: DataFrame, side: str, roi: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, body) with a voxel on the surface of a region: one of its six neighbours is not in it. roi: (z, y, x) voxels."""
    faces = None
    for a in AXES:
        line = Window.partitionBy(*[o for o in AXES if o != a]).orderBy(a)
        gap = (F.coalesce(F.lead(a).over(line) - F.col(a), F.lit(0)) != 1) | (F.coalesce(F.col(a) - F.lag(a).over(line), F.lit(0)) != 1)
        part = roi.select(*AXES).withColumn("_gap", gap).where("_gap").select(*AXES)
        faces = part if faces is None else faces.union(part)
    return df.join(faces.distinct(), list(AXES), "left_semi").select(*keys, F.col(side).alias("body")).distinct()


def eroded(df: DataFrame, value: str, steps: int) -> DataFrame:
    """Without the voxels within `steps` of another label, along any axis; what lies at the volume's edge stays."""
    out = df
    for _ in range(steps):
        keep = F.lit(True)
        named = out
        for i, a in enumerate(AXES):
            line = Window.partitionBy(*[o for o in AXES if o != a]).orderBy(a)
            other = lambda shift, line=line, a=a: F.when(F.abs(shift(a).over(line) - F.col(a)) == 1, shift(value).over(line) != F.col(value))
            named = named.withColumn(f"_e{i}", F.coalesce(other(F.lead), F.lit(False)) | F.coalesce(other(F.lag), F.lit(False)))
            keep = keep & ~F.col(f"_e{i}")
        out = named.where(keep).select(*df.columns)
    return out


def merged(over: DataFrame, flags: DataFrame, boundary: DataFrame, to: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Subvolumes put together: overlaps are summed, boundary bodies united, and a whole is ignored only if all its parts are.

    over: (typename, sv, gt, seg, n); flags: (sv, ignore); boundary: (sv, body); to: the new number, of sv.
    """
    new = to.cast("long").alias("sv")
    return (
        over.groupBy("typename", new, "gt", "seg").agg(F.sum("n").alias("n")).select("typename", "sv", "gt", "seg", "n"),
        flags.groupBy(new).agg(F.bool_and("ignore").alias("ignore")),
        boundary.select(new, "body").distinct(),
    )


@dataclass(frozen=True)
class Evaluation:
    """What statistics are computed from."""

    over: DataFrame
    thresholds: dict[str, int] = field(default_factory=lambda: {VOXELS: 1000, SYNAPSE: 10})
    ignored: DataFrame | None = None
    display: int = 10
    important: DataFrame | None = None

    @cached_property
    def types(self) -> list[str]:
        """One a comparison."""
        return sorted(r[0] for r in self.over.select("typename").distinct().collect())

    def threshold(self, typename: str) -> int:
        return self.thresholds.get(typename.split(":")[0], 0)

    def whole(self, typename: str) -> DataFrame:
        return self.over.where(F.col("typename") == typename).groupBy("gt", "seg").agg(F.sum("n").alias("n"))

    def parts(self, typename: str) -> DataFrame:
        return self.over.where(F.col("typename") == typename).select("sv", "gt", "seg", "n")

    def counted(self, by_sv: DataFrame) -> DataFrame:
        """Without ignored subvolumes."""
        return by_sv if self.ignored is None else by_sv.join(self.ignored.where("ignore").select("sv"), "sv", "left_anti")


class Stat:
    """A statistic: override what it has. Each method gives a frame of the section's shape, for one comparison."""

    kinds: tuple[str, ...] = (VOXELS, SYNAPSE)

    def summary(self, e: Evaluation, typename: str) -> DataFrame | None:
        return None

    def subvolumes(self, e: Evaluation, typename: str) -> DataFrame | None:
        return None

    def bodies(self, e: Evaluation, typename: str) -> DataFrame | None:
        return None

    def debug(self, e: Evaluation, typename: str) -> DataFrame | None:
        return None


STATS: dict[str, type[Stat]] = {}


def stat(name: str) -> Callable[[type[Stat]], type[Stat]]:
    """Registers a statistic under the name that a configuration calls it by."""

    def put(c: type[Stat]) -> type[Stat]:
        STATS[name] = c
        return c

    return put


def _rows(df: DataFrame, typename: str, names: dict[str, tuple[str, bool, str]], carried: tuple[str, ...] = ()) -> DataFrame:
    """(carried, name, higher_better, typename, val, description) from a frame with a column a value. names: column -> (name, higher is better, description)."""
    quoted = ", ".join(f"'{n}', {str(h).lower()}, '{d}', CAST({c} AS DOUBLE)" for c, (n, h, d) in names.items())
    out = df.selectExpr(*carried, f"stack({len(names)}, {quoted}) AS (name, higher_better, description, val)")
    return out.withColumn("typename", F.lit(typename))


def _summary(df: DataFrame) -> DataFrame:
    return df.select("name", "higher_better", "typename", "val", "description")


def _by_subvolume(df: DataFrame, e: Evaluation) -> DataFrame:
    flags = df.withColumn("ignore", F.lit(False)) if e.ignored is None else df.join(e.ignored, "sv", "left").withColumn("ignore", F.coalesce("ignore", F.lit(False)))
    return flags.select("sv", "name", "higher_better", "typename", "val", "ignore")


def _over_subvolumes(e: Evaluation, by_sv: DataFrame, typename: str, value: str, name: str, higher: bool) -> DataFrame:
    """Best, worst and mean of a value over the subvolumes that count, the first two with their number."""
    some = overlap.over_subvolumes(e.counted(by_sv), value, higher).where("best_sv IS NOT NULL")
    ends = f"stack(3, 'S-BEST-{name}', best, concat('Subvolume=', best_sv), 'S-WRST-{name}', worst, concat('Subvolume=', worst_sv), 'S-AVE-{name}', average, 'Mean of the subvolumes') AS (name, val, description)"
    return some.selectExpr(ends).select("name", F.lit(higher).alias("higher_better"), F.lit(typename).alias("typename"), F.col("val").cast("double").alias("val"), "description")


def _top_bodies(df: DataFrame, typename: str, name: str, isgt: bool, vals: tuple[str, ...], k: int, ident: str = "body") -> DataFrame:
    """The k bodies of the largest first value, the larger identifier first among equals."""
    top = df.orderBy(F.desc(vals[0]), F.desc(ident)).limit(k)
    return top.select(F.lit(name).alias("name"), F.lit(typename).alias("typename"), F.lit(True).alias("largest2smallest"), F.lit(isgt).alias("isgt"), F.col(ident).alias("body"), F.array(*[F.col(v).cast("double") for v in vals]).alias("vals"))


@stat("vi")
class VariationOfInformation(Stat):
    """False merge and false split bits, of the volume, its subvolumes and its bodies."""

    def _whole(self, e: Evaluation, typename: str) -> DataFrame:
        over, least = e.whole(typename), e.threshold(typename)
        return overlap.vi(over, least) if e.important is None else overlap.vi_sparse(over, e.important, least)

    def summary(self, e, typename):
        names = {"fm_vi": ("FM-VI", False, "False merge bits"), "fs_vi": ("FS-VI", False, "False split bits"), "vi": ("VI", False, "Both")}
        by_sv = overlap.vi(e.parts(typename), 0, ("sv",))
        worst = overlap.vi_bodies(e.whole(typename), e.threshold(typename)).groupBy("side").agg(F.max(F.struct("bits", "body")).alias("w"))
        worst = worst.select(F.when(F.col("side") == "gt", "B-WRST-FS-VI").otherwise("B-WRST-FM-VI").alias("name"), F.lit(False).alias("higher_better"), F.lit(typename).alias("typename"), F.col("w.bits").alias("val"), F.concat(F.lit("Body="), F.col("w.body")).alias("description"))
        parts = [_over_subvolumes(e, by_sv, typename, c, n, False) for c, n in (("fm_vi", "FM-VI"), ("fs_vi", "FS-VI"), ("vi", "VI"))]
        return reduce(DataFrame.union, parts, _summary(_rows(self._whole(e, typename), typename, names))).union(worst)

    def subvolumes(self, e, typename):
        names = {"fm_vi": ("FM-VI", False, ""), "fs_vi": ("FS-VI", False, ""), "vi": ("VI", False, "")}
        return _by_subvolume(_rows(overlap.vi(e.parts(typename), 0, ("sv",)), typename, names, ("sv",)), e)

    def bodies(self, e, typename):
        of = overlap.vi_bodies(e.whole(typename), e.threshold(typename))
        side = lambda s: of.where(F.col("side") == s)
        return _top_bodies(side("gt"), typename, "Worst GT", True, ("bits", "size"), e.display).union(_top_bodies(side("seg"), typename, "Worst Test", False, ("bits", "size"), e.display))


@stat("rand")
class Rand(Stat):
    """Shares of pairs that stay together."""

    def summary(self, e, typename):
        names = {"merge": ("FM-RD", True, "Pairs of a test body that belong together"), "split": ("FS-RD", True, "Pairs of a true body that stay together"), "rand": ("RAND", True, "Harmonic mean")}
        by_sv = overlap.rand(e.parts(typename), 0, ("sv",))
        return _summary(_rows(overlap.rand(e.whole(typename), e.threshold(typename)), typename, names)).union(_over_subvolumes(e, by_sv, typename, "rand", "RAND", True))

    def subvolumes(self, e, typename):
        names = {"merge": ("FM-RD", True, ""), "split": ("FS-RD", True, ""), "rand": ("RAND", True, "")}
        return _by_subvolume(_rows(overlap.rand(e.parts(typename), 0, ("sv",)), typename, names, ("sv",)), e)


@stat("count")
class Counts(Stat):
    """Sizes and their distribution, the best test body of each true one, and the largest overlaps."""

    def summary(self, e, typename):
        whole = e.whole(typename)
        sizes = _rows(overlap.total_size(whole), typename, {"size": ("TOTAL-SIZE", True, "What is compared"), "gt_bodies": ("GT-BODIES", True, "True bodies"), "seg_bodies": ("TEST-BODIES", True, "Test bodies")})
        reach = overlap.bodies_to_reach(whole).select(F.format_string("HIST-%d", "percent").alias("name"), F.lit(False).alias("higher_better"), F.lit(typename).alias("typename"), F.col("diff").cast("double").alias("val"), F.lit("Difference of how many bodies hold that share").alias("description"))
        return _summary(sizes).union(reach)

    def subvolumes(self, e, typename):
        names = {"gt_bodies": ("GT-BODIES", True, ""), "seg_bodies": ("TEST-BODIES", True, ""), "size": ("TOTAL-SIZE", True, "")}
        return _by_subvolume(_rows(overlap.body_counts(e.parts(typename)), typename, names, ("sv",)), e)

    def bodies(self, e, typename):
        best = overlap.best_match(e.whole(typename), e.threshold(typename))
        return _top_bodies(best, typename, "Best Test", True, ("overlap", "seg", "seg_size"), e.display, "gt")

    def debug(self, e, typename):
        return overlap.top_overlaps(e.whole(typename)).select(F.lit("Overlaps").alias("name"), F.lit(typename).alias("typename"), F.col("gt").alias("body"), F.col("seg").alias("other"), "n")


@stat("edit")
class Edits(Stat):
    """Corrections until a share of the volume is right."""

    kinds = (VOXELS,)

    def summary(self, e, typename):
        from voxelith.operators import graph

        whole = e.whole(typename)
        rows = graph.edit_distance(overlap.edit_operations(whole), whole.agg(F.sum("n")).first()[0] or 0)
        named = rows.selectExpr("stack(2, concat('ED-SPLITS-', percent), splits, concat('ED-MERGES-', percent), merges) AS (name, val)")
        return named.select("name", F.lit(False).alias("higher_better"), F.lit(typename).alias("typename"), F.col("val").cast("double").alias("val"), F.lit("Corrections to reach that share").alias("description"))


def _section(e: Evaluation, stats: list[str], method: str, schema: str, spark) -> DataFrame:
    frames = [getattr(STATS[s](), method)(e, t) for s in stats for t in e.types if t.split(":")[0] in STATS[s].kinds]
    return reduce(DataFrame.union, [f for f in frames if f is not None], spark.createDataFrame([], schema))


def record(e: Evaluation, stats: list[str] | None = None) -> dict[str, DataFrame]:
    """The sections summarystats, subvolumes, bodystats, bodydebug and types of the named statistics (all, if none are named)."""
    spark, names = e.over.sparkSession, list(STATS) if stats is None else stats
    if unknown := [s for s in names if s not in STATS]:
        raise ValueError(f"no statistic {unknown}; there are {sorted(STATS)}")
    parts = {"summarystats": ("summary", SUMMARY), "subvolumes": ("subvolumes", SUBVOLUMES), "bodystats": ("bodies", BODIES), "bodydebug": ("debug", DEBUG)}
    out = {section: _section(e, names, method, schema, spark) for section, (method, schema) in parts.items()}
    return out | {"types": e.over.select("typename").distinct()}


#: Columns whose name in the JSON form is not their own.
_KEYS = {"higher_better": "higher-better"}


def to_json(section: DataFrame) -> DataFrame:
    """(value): a JSON object a row, keys as the record's readers know them."""
    return section.select(F.to_json(F.struct(*[F.col(c).alias(_KEYS.get(c, c)) for c in section.columns])).alias("value"))


def from_json(lines: DataFrame, schema: str) -> DataFrame:
    """A section from the lines of to_json()."""
    named = ", ".join(f"`{_KEYS.get(c.split()[0], c.split()[0])}` {c.split(' ', 1)[1]}" for c in schema.split(", "))
    parsed = lines.select(F.from_json("value", named).alias("r"))
    return parsed.select(*[F.col(f"r.`{_KEYS.get(c.split()[0], c.split()[0])}`").alias(c.split()[0]) for c in schema.split(", ")])


def write_record(sections: dict[str, DataFrame], path: str) -> None:
    """A folder of JSON lines for each section; writing again replaces them."""
    for name, df in sections.items():
        to_json(df).write.mode("overwrite").text(f"{path}/{name}")
