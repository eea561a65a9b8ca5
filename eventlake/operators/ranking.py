"""Positions, percentiles, tiers and histograms over whole tables, without a task that holds them.

A global window would gather all rows in one task. Here rows are range-partitioned and sorted, each partition numbers its
own rows as they stream by, and the partitions' sizes, one number each, give the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.session import broadcast_if_small, stored

# The weights of the composite score.
WEIGHTS = {"listeners": 0.4, "playcount": 0.15, "sitelinks": 0.25, "inbound": 0.05, "touring": 0.15}
PAGE = 500
SLICE = 10_000  # values whose running total one window takes


def indexed(df: DataFrame, *order: Column, name: str = "pos") -> DataFrame:
    """``df`` with each row's position in the order, from 0; ties get any order among them, so give one that is total."""
    number = F.monotonically_increasing_id()  # the partition in the upper 31 bits, the row's place in it in the lower 33
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", number))
    pid, at = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(pid.alias("_p")).agg((F.max(at) + 1).alias("_n"))  # one row a partition
    starts = sizes.select("_p", (F.sum("_n").over(_running(None, "_p")) - F.col("_n")).alias("_start"))
    return rows.withColumn("_pid", pid).join(F.broadcast(starts), F.col("_pid") == F.col("_p")).withColumn(name, F.col("_start") + at).drop("_id", "_pid", "_p", "_start")


def _running(part: str | None, order: str):
    w = Window.partitionBy(part) if part else Window.partitionBy()
    return w.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def value_positions(df: DataFrame, value: str, descending: bool = False) -> DataFrame:
    """(_v, _n, _first): each value, how often it is there, and the position of its first row in the order of values, nulls first.

    Values are counted before anything is ordered, so a frequent one is one row. Running totals are taken within slices of 10,000
    values, and over the slices in one task, which has a row for 10,000 values.
    """
    counts = df.groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    rows = indexed(counts, F.col("_v").desc() if descending else F.col("_v").asc_nulls_first())
    slices = rows.withColumn("_slice", F.floor(F.col("pos") / SLICE))
    within = slices.withColumn("_cum", F.sum("_n").over(_running("_slice", "pos")) - F.col("_n"))
    total = slices.groupBy(F.col("_slice").alias("_s")).agg(F.sum("_n").alias("_m"))
    starts = total.select("_s", (F.sum("_m").over(_running(None, "_s")) - F.col("_m")).alias("_start"))
    return stored(within.join(broadcast_if_small(starts), F.col("_slice") == F.col("_s")).select("_v", "_n", (F.col("_start") + F.col("_cum")).alias("_first")))


def percent_rank(df: DataFrame, value: str, name: str = "pr") -> DataFrame:
    """``df`` with (position of the first equal value) / (n - 1), 0 for a single row; null values come first."""
    first = value_positions(df, value)
    n = first.agg(F.sum("_n")).first()[0] or 0
    if n < 2:
        return df.withColumn(name, F.lit(0.0))
    return df.join(first.drop("_n"), df[value].eqNullSafe(first["_v"])).withColumn(name, F.col("_first") / F.lit(n - 1.0)).drop("_v", "_first")


def quantiles(df: DataFrame, value: str, shares: list[float]) -> DataFrame:
    """(share, value): exact quantiles by linear interpolation between the two nearest positions; null values are left out."""
    at = value_positions(df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v")), "v")
    n = at.agg(F.sum("_n")).first()[0]
    if not n:
        return df.sparkSession.createDataFrame([], "share double, value double")
    want = [(q, q * (n - 1)) for q in shares]
    asked = F.array(*[F.lit(p).cast("long") for p in sorted({int(x) for _, x in want} | {min(int(x) + 1, n - 1) for _, x in want})])
    hit = F.filter(asked, lambda p: (p >= F.col("_first")) & (p < F.col("_first") + F.col("_n")))
    found = {r["p"]: r["_v"] for r in at.select(F.explode(hit).alias("p"), "_v").collect()}  # two values a share
    out = [(q, found[int(x)] + (x - int(x)) * (found[min(int(x) + 1, n - 1)] - found[int(x)])) for q, x in want]
    return df.sparkSession.createDataFrame(out, "share double, value double")


def histogram(df: DataFrame, value: str, buckets: int = 12) -> DataFrame:
    """(bucket, lo, hi, n) of equal width, the last closed above; a width of 1 if all values are equal. Buckets without a value are given with 0."""
    v = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    span = v.agg(F.min("v").alias("a"), F.max("v").alias("b")).first()
    if span["a"] is None:
        return df.sparkSession.createDataFrame([], "bucket int, lo double, hi double, n long")
    a, width = span["a"], (span["b"] - span["a"]) / buckets or 1.0
    counts = v.groupBy(F.least(F.lit(buckets - 1), F.floor((F.col("v") - a) / width)).cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    grid = df.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), (F.lit(a) + F.col("id") * width).alias("lo"), (F.lit(a) + (F.col("id") + 1) * width).alias("hi"))
    return grid.join(counts, "bucket", "left").select("bucket", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def popularity(df: DataFrame) -> DataFrame:
    """(slug, score) of rows (slug, listeners, playcount, sitelinks, inbound, countries); null counts weigh nothing, null links rank first."""
    df = percent_rank(percent_rank(df, "sitelinks", "_ps"), "inbound", "_pi")
    touring = F.when(F.coalesce("countries", F.lit(0)) >= 2, 1.0).when(F.col("countries") == 1, 0.67).otherwise(0.0)
    w = WEIGHTS
    score = w["listeners"] * F.log1p(F.coalesce("listeners", F.lit(0))) + w["playcount"] * F.log1p(F.coalesce("playcount", F.lit(0))) + w["sitelinks"] * F.col("_ps") + w["inbound"] * F.col("_pi") + w["touring"] * touring
    return df.select("slug", score.alias("score"))


def selected(df: DataFrame, threshold: float, cap: int) -> DataFrame:
    """(slug) of the first ``cap`` distinct slugs, protected ones before others by score, that are protected or score at least ``threshold``."""
    best = df.groupBy("slug").agg(F.max(F.struct("protected", "score")).alias("b")).select("slug", "b.protected", "b.score")
    fit = best.where(F.col("protected") | (F.col("score") >= threshold))
    return indexed(fit, F.desc("protected"), F.desc("score"), F.col("slug")).where(F.col("pos") < cap).select("slug")


def knee(df: DataFrame, score: str) -> DataFrame:
    """(pos, score) at which the falling curve of scores bends most: the greatest distance of the scaled score from 1 - x, the first such."""
    at = value_positions(df.where(F.col(score).isNotNull()).select(F.col(score).cast("double").alias("score")), "score", descending=True)
    ends = at.agg(F.min("_v").alias("a"), F.max("_v").alias("b"), F.sum("_n").alias("n")).first()
    both = F.explode(F.array_distinct(F.array("_first", F.col("_first") + F.col("_n") - 1)))  # of equal scores the gap is greatest at an end
    rows = at.select(both.alias("pos"), F.col("_v").alias("score"))
    if not ends["n"] or ends["n"] < 2:
        return rows
    y = (F.col("score") - ends["a"]) / (ends["b"] - ends["a"] or 1.0)
    gap = F.abs(y - (1 - F.col("pos") / (ends["n"] - 1.0)))
    return rows.select("pos", "score", F.round(gap, 9).alias("gap")).agg(F.max_by(F.struct("pos", "score"), F.struct("gap", -F.col("pos"))).alias("m")).select("m.*")


def pages(df: DataFrame, *order: Column, size: int = PAGE) -> DataFrame:
    """``df`` with its page number from 1, in the given total order."""
    return indexed(df, *order).withColumn("page", (F.floor(F.col("pos") / size) + 1).cast("long"))
