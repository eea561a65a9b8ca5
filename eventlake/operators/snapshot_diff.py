"""What changed between consecutive full deliveries of a table (problem 1).

Deliveries are range-partitioned by key and sorted by (key, delivery). Each range is then merged in one
streaming pass in which a row only looks at its neighbours of the same key, the two pointers of the merge;
RangePartitioning(key) already satisfies the window's distribution and the sort its ordering, so the merge
adds neither an exchange nor a sort. Repeated rows are reduced before, with map-side combine, so that a key
has at most one row per delivery, however often it was repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.session import broadcast_if_small

BLANK = r"^[\s ]+|[\s ]+$"


def tidy(c: str | Column) -> Column:
    """Without blanks at the ends; an empty value is null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_replace(c.cast("string"), BLANK, ""), F.lit(""))


def delivery_numbers(*columns: DataFrame) -> list[int]:
    """The delivery numbers that exist, in order. There are as many as deliveries, never as many as rows."""
    found: set[int] = set()
    for df in columns:
        c = df.columns[0]
        found |= {r[0] for r in df.where(F.col(c).isNotNull()).distinct().collect()}
    return sorted(found)


def diff_deliveries(
    df: DataFrame,
    key: str,
    delivery: str,
    numbers: Sequence[int],
    compare: Sequence[Column] = (),
    latest: Sequence[str] = (),
    source: str | None = None,
    failed: DataFrame | None = None,
    carry: bool = False,
) -> DataFrame:
    """One row (record_key, snap_no, change_kind, changed_columns) per difference to the preceding delivery.

    ``compare`` are the compared values, null-safe; with none, only presence counts. Of several rows of a key in
    one delivery that with the greatest ``latest`` columns counts (ties: the greatest compared values).
    ``failed`` (source, delivery) names deliveries in which a source gave nothing: they are passed over, and the
    next is compared with the source's last good one. With ``carry``, null values mean "not delivered" and the
    last non-null ones are compared instead. Rows with a null key or delivery are left out; an empty table gives
    no rows; the first delivery reports nothing. Other columns of ``df`` are ignored.
    """
    out = "record_key string, snap_no int, change_kind string, changed_columns array<int>"
    if len(numbers) < 2:
        return df.sparkSession.createDataFrame([], out)
    order = F.array(*[F.lit(int(n)) for n in numbers])
    values = F.array(*[c.cast("string") for c in compare]) if compare else F.array().cast("array<string>")
    rows = df.where(F.col(key).isNotNull() & F.col(delivery).isNotNull()).select(
        F.col(key).cast("string").alias("_key"),
        F.array_position(order, F.col(delivery).cast("int")).cast("int").alias("_ord"),
        F.struct(*[F.col(c).alias(f"l{i}") for i, c in enumerate(latest)], values.alias("v"), (F.col(source) if source else F.lit(None)).cast("string").alias("s")).alias("_row"),
    )
    rows = rows.groupBy("_key", "_ord").agg(F.max("_row").alias("_row")).select("_key", "_ord", F.col("_row.v").alias("_v"), F.col("_row.s").alias("_s"))
    before, after = F.col("_ord") - 1, F.col("_ord") + 1
    if failed is not None:
        s, d = failed.columns[:2]
        gaps = failed.where(F.col(s).isNotNull()).groupBy(F.col(s).cast("string").alias("_s")).agg(F.collect_set(F.array_position(order, F.col(d).cast("int")).cast("int")).alias("_gaps"))
        rows = rows.join(broadcast_if_small(gaps), "_s", "left").withColumn("_gaps", F.coalesce("_gaps", F.array().cast("array<int>")))
        rows = rows.where(~F.array_contains("_gaps", F.col("_ord")))
        before = F.when(F.size("_gaps") == 0, before).otherwise(F.expr("coalesce(array_max(filter(sequence(0, _ord - 1), x -> not array_contains(_gaps, x))), 0)"))
        after = F.when(F.size("_gaps") == 0, after).otherwise(F.expr(f"array_min(filter(sequence(_ord + 1, {len(numbers) + 1}), x -> not array_contains(_gaps, x)))"))
    rows = rows.repartitionByRange("_key").sortWithinPartitions("_key", "_ord")
    w = Window.partitionBy("_key").orderBy("_ord")
    known = F.last(F.when(F.get("_v", F.lit(0)).isNotNull(), F.col("_v")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)) if carry else F.lag("_v").over(w)
    rows = rows.select("_key", "_ord", "_v", before.alias("_before"), after.alias("_after"), F.lag("_ord").over(w).alias("_last"), F.lead("_ord").over(w).alias("_next"), known.alias("_known"))
    differs = F.expr("filter(sequence(0, size(_v) - 1), i -> not (_v[i] <=> _known[i]))") if compare else F.array().cast("array<int>")
    if carry:
        differs = F.when(F.col("_known").isNull() | F.get("_v", F.lit(0)).isNull(), F.array().cast("array<int>")).otherwise(differs)
    none = F.array().cast("array<int>")
    change = lambda at, kind, which: F.struct(at.cast("int").alias("at"), F.lit(kind).alias("kind"), which.alias("which"))
    same = F.col("_last").eqNullSafe(F.col("_before"))
    found = F.array(
        F.when(~same & (F.col("_before") >= 1), change(F.col("_ord"), "added", none)),
        F.when(same & (F.size(differs) > 0), change(F.col("_ord"), "changed", differs)),
        F.when((F.col("_after") <= len(numbers)) & ~F.col("_next").eqNullSafe(F.col("_after")), change(F.col("_after"), "removed", none)),
    )
    return rows.select("_key", F.explode(F.array_compact(found)).alias("c")).select(
        F.col("_key").alias("record_key"), F.element_at(order, F.col("c.at")).alias("snap_no"), F.col("c.kind").alias("change_kind"), F.col("c.which").alias("changed_columns")
    )


def concert_changes(concerts: DataFrame, venue_cache: DataFrame) -> DataFrame:
    """Added, removed and changed concerts of concert_snapshot; scrapes that venue_cache calls failed deliver nothing."""
    numbers = delivery_numbers(concerts.select("snap_no"), venue_cache.select("snap_no"))
    failed = venue_cache.where(~F.col("success")).select("config_id", "snap_no").distinct()
    return diff_deliveries(
        concerts, "concert_id", "snap_no", numbers, compare=[tidy(c) for c in ("artist", "start_time", "venue", "city", "country", "ticket_url")],
        latest=["scraped_at", "loaded_at"], source="config_id", failed=failed,
    )


def venue_changes(venue_cache: DataFrame) -> DataFrame:
    """Venue sources that came, went or whose content hash, read as bare hexadecimal digits, is another than the last delivered."""
    unlabelled = F.regexp_replace(F.lower(F.trim("content_hash")), r"^.*[:=\s]", "")
    digits = F.when(F.col("success"), F.nullif(F.regexp_replace(F.regexp_replace(unlabelled, "^0x", ""), "[^0-9a-f]", ""), F.lit("")))
    return diff_deliveries(venue_cache, "config_id", "snap_no", delivery_numbers(venue_cache.select("snap_no")), compare=[digits], latest=["success", "scraped_at"], carry=True)


def known_key_changes(changelog: DataFrame) -> DataFrame:
    """Keys that are in only one of two neighbouring sets of known keys; a delivery whose arrays are null is an empty set."""
    numbers = delivery_numbers(changelog.select("snap_no"))
    keys = changelog.select("snap_no", F.explode("known_keys").alias("known_key"))
    return diff_deliveries(keys, "known_key", "snap_no", numbers)


def all_changes(concerts: DataFrame, venue_cache: DataFrame, changelog: DataFrame) -> DataFrame:
    kinds = {"concert": concert_changes(concerts, venue_cache), "venue": venue_changes(venue_cache), "known_key": known_key_changes(changelog)}
    parts = [df.select(F.lit(k).alias("record_kind"), "record_key", "snap_no", "change_kind") for k, df in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
