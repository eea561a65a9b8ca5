"""Timestamps of many formats and zones as one instant each (problem 6).

Distinct raw strings with their zone form a dictionary; each entry is parsed once, by JVM expressions only, and the
instants are joined back to the rows. :func:`refresh_dictionary` keeps the dictionary as a table between runs and
parses only strings it has not seen. All arithmetic is on whole seconds, so the session's time zone plays no part.
"""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.session import broadcast_if_small, shared_dir

# Zone abbreviations and their offsets in minutes.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120, "EET": 120, "EEST": 180, "MSK": 180, "SAST": 120, "CAT": 120, "EAT": 180, "WAT": 60,
    "IST": 330, "NPT": 345, "PKT": 300, "JST": 540, "KST": 540, "HKT": 480, "SGT": 480, "AWST": 480, "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
    "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "ART": -180, "BRT": -180, "BRST": -120, "CLT": -240, "CLST": -180,
}
# English month names by their first three letters.
MONTHS = {m: i for i, m in enumerate(("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"), 1)}

KEY = ("feed", "raw_date", "raw_time", "zone", "us")
ZONE = r"(?:\s*(?<off>Z|z|[+-]\d{2}(?::?\d{2})?|[A-Za-z]{2,4})(?![A-Za-z\d:]))?(?:\s*\[[A-Za-z_/+\-0-9]+\])?$"
CLOCK = r"(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:[.,]\d+)?)?"


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _part(text: Column, pattern: str, group: int) -> Column:
    """Group of a match, null where the pattern or the group does not match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _offset(text: Column) -> Column:
    """A stated offset in seconds; null if none is stated or its abbreviation is unknown."""
    hours, minutes = F.regexp_extract(text, r"^[+-](\d{2})", 1), F.regexp_extract(text, r"^[+-]\d{2}:?(\d{2})$", 1)
    size = F.try_cast(hours, "int") if hasattr(F, "try_cast") else hours.try_cast("int")
    size = size * 3600 + F.coalesce(minutes.try_cast("int"), F.lit(0)) * 60
    numeric = F.when(minutes.try_cast("int") >= 60, F.lit(None)).when((hours.try_cast("int") > 18), F.lit(None)).otherwise(F.when(text.startswith("-"), -size).otherwise(size))
    return F.when(text.rlike(r"^[+-]"), numeric).otherwise(F.try_element_at(_map(ABBREVIATIONS), F.upper(text)) * 60)


def _seconds(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column) -> Column:
    """Wall-clock seconds since 1970-01-01, or null if date or time of day does not exist; 24:00 ends the day."""
    y = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    day = F.try_to_date(F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(mo.cast("string"), 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    h, mi, s = h.try_cast("int"), mi.try_cast("int"), F.coalesce(s.try_cast("int"), F.lit(0))
    fits = (mi < 60) & (s < 60) & ((h < 24) | ((h == 24) & (mi == 0) & (s == 0)))
    return F.when(fits & y.isNotNull() & d.isNotNull(), F.unix_date(day).cast("long") * 86400 + h * 3600 + mi * 60 + s)


def _wall(**parts: Column) -> Column:
    """Struct (secs: wall clock or instant, off: offset text, zone_id: bracketed zone, instant: secs is UTC already)."""
    return F.struct(parts["secs"].cast("long").alias("secs"), parts.get("off", F.lit(None)).cast("string").alias("off"), parts.get("zone_id", F.lit(None)).cast("string").alias("zone_id"), F.lit("instant" in parts).alias("instant"))


def parse_stamp(text: Column) -> Column:
    """A combined date and time: ISO 8601 and its relaxations, compact, RFC 2822, seconds or milliseconds since 1970."""
    iso = r"^(\d{4})-(\d{1,2})-(\d{1,2})[T\s]+" + CLOCK + ZONE
    compact = r"^(\d{4})(\d{2})(\d{2})[T\s]?(\d{2})(\d{2})(\d{2})?(?:[.,]\d+)?" + ZONE
    mail = r"^(?:[A-Za-z]{3,9},?\s+)?(\d{1,2})\s+([A-Za-z]{3,9})\s+(\d{4})\s+" + CLOCK + ZONE
    zone_id = _part(text, r"\[([A-Za-z_/+\-0-9]+)\]$", 1)
    month = F.try_element_at(_map(MONTHS), F.lower(F.substring(F.regexp_extract(text, mail, 2), 1, 3)))
    g = lambda p, n: _part(text, p, n)
    number = text.try_cast("long")
    return (
        F.when(text.rlike(r"^-?\d{9,10}$"), _wall(secs=number, instant=F.lit(True)))
        .when(text.rlike(r"^-?\d{12,13}$"), _wall(secs=F.floor(number / 1000), instant=F.lit(True)))
        .when(text.rlike(iso), _wall(secs=_seconds(g(iso, 1), g(iso, 2), g(iso, 3), g(iso, 4), g(iso, 5), g(iso, 6)), off=g(iso, 7), zone_id=zone_id))
        .when(text.rlike(compact), _wall(secs=_seconds(g(compact, 1), g(compact, 2), g(compact, 3), g(compact, 4), g(compact, 5), g(compact, 6)), off=g(compact, 7), zone_id=zone_id))
        .when(text.rlike(mail), _wall(secs=_seconds(g(mail, 3), month, g(mail, 1), g(mail, 4), g(mail, 5), g(mail, 6)), off=g(mail, 7), zone_id=zone_id))
    )


def parse_date_time(date: Column, time: Column, us: Column) -> Column:
    """A date and a time of day in separate fields; slashes are month-first where ``us``."""
    iso, compact, dots, slash = r"^(\d{4})-(\d{1,2})-(\d{1,2})$", r"^(\d{4})(\d{2})(\d{2})$", r"^(\d{1,2})\.(\d{1,2})\.(\d{4}|\d{2})$", r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})$"
    named, dayname = r"^([A-Za-z]{3,9})\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})$", r"^(?:[A-Za-z]{3,9},? )?(\d{1,2})(?:st|nd|rd|th)?\.? ([A-Za-z]{3,9})\.?,? (\d{4})$"
    g = lambda p, n: _part(date, p, n)
    month = lambda p, n: F.try_element_at(_map(MONTHS), F.lower(F.substring(F.regexp_extract(date, p, n), 1, 3))).cast("string")
    ymd = lambda y, m, d: F.struct(y.alias("y"), m.alias("m"), d.alias("d"))
    day = (
        F.when(date.rlike(iso), ymd(g(iso, 1), g(iso, 2), g(iso, 3)))
        .when(date.rlike(compact), ymd(g(compact, 1), g(compact, 2), g(compact, 3)))
        .when(date.rlike(dots), ymd(g(dots, 3), g(dots, 2), g(dots, 1)))
        .when(date.rlike(slash) & us, ymd(g(slash, 3), g(slash, 1), g(slash, 2)))
        .when(date.rlike(slash), ymd(g(slash, 3), g(slash, 2), g(slash, 1)))
        .when(date.rlike(named), ymd(g(named, 3), month(named, 1), g(named, 2)))
        .when(date.rlike(dayname), ymd(g(dayname, 3), month(dayname, 2), g(dayname, 1)))
    )
    twelve, clock, hour_h, four = r"^(\d{1,2})(?:[:.](\d{2}))?\s*([AaPp])\.?[Mm]\.?$", r"^" + CLOCK + r"(?:\s*Uhr)?" + ZONE, r"^(\d{1,2})\s*[hH]\s*(\d{2})?$", r"^(\d{2})(\d{2})$"
    t = lambda p, n: _part(time, p, n)
    h12 = t(twelve, 1).try_cast("int")
    h24 = F.when(h12.between(1, 12), (h12 % 12) + F.when(F.lower(t(twelve, 3)) == "p", 12).otherwise(0)).cast("string")
    zero = F.lit("0")
    at = lambda h, m, s=zero, off=F.lit(None): F.struct(h.alias("h"), m.alias("m"), s.alias("s"), off.cast("string").alias("off"))
    clocks = (
        F.when(time.rlike(twelve), at(h24, F.coalesce(t(twelve, 2), zero)))
        .when(time.rlike(r"(?i)^\d{1,2}\s*uhr$"), at(_part(time, r"^(\d{1,2})", 1), zero))
        .when(time.rlike(hour_h), at(t(hour_h, 1), F.coalesce(t(hour_h, 2), zero)))
        .when(time.rlike(four), at(t(four, 1), t(four, 2)))
        .when(time.rlike(clock), at(t(clock, 1), t(clock, 2), F.coalesce(t(clock, 3), zero), t(clock, 4)))
    )
    return _wall(secs=_seconds(day["y"], day["m"], day["d"], clocks["h"], clocks["m"], clocks["s"]), off=clocks["off"], zone_id=F.lit(None))


def to_instant(wall: Column, zone: Column) -> Column:
    """UTC seconds of a parsed value: a stated offset, else a stated zone, else ``zone``.

    Java resolves a wall clock as asked for here: an hour that occurs twice is the first one, a skipped one is read with the offset before the change."""
    known = sorted(zoneinfo.available_timezones())
    own = F.coalesce(wall["zone_id"], zone)
    own = F.when(own.isin(known), own)
    offset = _offset(wall["off"])
    local = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(wall["secs"]), own))
    return F.when(wall["instant"], wall["secs"]).when(wall["off"].isNotNull(), wall["secs"] - offset).otherwise(local)


def raw_stamps(feed: DataFrame, cities: DataFrame) -> DataFrame:
    """event_id with the dictionary's key columns. Null and empty strings are no values; unknown cities have no zone."""
    clean = lambda c: F.nullif(F.trim(F.regexp_replace(c, r"[\s ]+", " ")), F.lit(""))
    bit = F.col("feed") == "bit"
    zones = cities.select(F.col("city_id").alias("_city"), F.col("zone_name").alias("zone"), (F.col("country") == "US").alias("us")).dropDuplicates(["_city"])
    rows = feed.select("event_id", "feed", "city_id", F.when(bit, F.coalesce(clean("starts_at"), clean("datetime_raw"))).otherwise(clean("start_date")).alias("raw_date"), F.when(~bit, clean("start_time")).alias("raw_time"))
    rows = rows.where(F.col("event_id").isNotNull() & F.col("raw_date").isNotNull() & (bit | F.col("raw_time").isNotNull()))
    return rows.join(broadcast_if_small(zones, 10_000), F.col("city_id") == F.col("_city"), "left").select("event_id", "feed", "raw_date", F.coalesce("raw_time", F.lit("")).alias("raw_time"), F.coalesce("zone", F.lit("")).alias("zone"), F.coalesce("us", F.lit(False)).alias("us"))


def parse_dictionary(keys: DataFrame) -> DataFrame:
    """The key columns and utc_epoch, null where unreadable."""
    wall = F.when(F.col("feed") == "bit", parse_stamp(F.col("raw_date"))).otherwise(parse_date_time(F.col("raw_date"), F.col("raw_time"), F.col("us")))
    return keys.select(*KEY, wall.alias("_wall")).select(*KEY, to_instant(F.col("_wall"), F.nullif(F.col("zone"), F.lit(""))).alias("utc_epoch"))


ENTRY = "feed string, raw_date string, raw_time string, zone string, us boolean, utc_epoch long"


def refresh_dictionary(keys: DataFrame, path: str) -> DataFrame:
    """Appends to the dictionary table at ``path`` what it lacks of ``keys`` and returns it whole; known strings are not parsed again.

    Files appear only when they are complete. Two runs at once may both add a string; as it means the same instant to both, each
    string is given once.
    """
    spark = keys.sparkSession
    fresh = keys.select(*KEY).distinct()
    try:
        fresh = fresh.join(spark.read.schema(ENTRY).parquet(path), list(KEY), "left_anti")
    except Exception as e:  # no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    parse_dictionary(fresh).write.mode("append").parquet(path)
    return spark.read.schema(ENTRY).parquet(path).groupBy(*KEY).agg(F.max("utc_epoch").alias("utc_epoch"))


def event_instants(feed: DataFrame, cities: DataFrame, path: str | None = None) -> DataFrame:
    """(event_id, utc_epoch) of each event with a readable date and time of day; repeated rows come once.

    The dictionary is kept at ``path``, or without one in the application's shared folder.
    """
    rows = raw_stamps(feed, cities)
    dictionary = refresh_dictionary(rows, path or f"{shared_dir(feed.sparkSession)}/instants")
    return rows.join(dictionary.where(F.col("utc_epoch").isNotNull()), list(KEY)).select("event_id", "utc_epoch").distinct()
