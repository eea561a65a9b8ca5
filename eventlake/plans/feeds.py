"""Queries on the feeds: bodies are written from raw listings and read back."""

from __future__ import annotations

import json
from urllib.parse import urlsplit

from pyspark.sql import functions as F

from eventlake.session import table
from eventlake.sources import feeds, sweep
from eventlake.sources.raw_event import ORACLE, raw_events

_COLUMNS = ("seq", "artist", "date", "start_time", "venue", "city", "country", "lat", "lng", "ticket_url")


def s09(spark, sf_dir):
    """Feed A, with a second act where there is a link, and towns missing from where there are no coordinates."""
    acts = F.array(F.struct(F.col("artist").alias("name")), F.when(F.col("ticket_url").isNotNull(), F.struct(F.lit("Support").alias("name"))))
    body = F.to_json(
        F.struct(
            F.lit("Fest").alias("name"), F.col("ticket_url").alias("url"), F.struct(F.struct(F.col("date").alias("localDate"), F.lit("19:30:00").alias("localTime")).alias("start")).alias("dates"),
            F.struct(
                F.array(F.struct(F.col("venue").alias("name"), F.struct(F.when(F.col("lat").isNotNull(), F.col("city")).alias("name")).alias("city"), F.struct(F.col("country").alias("countryCode")).alias("country"),
                                 F.struct(F.col("lat").cast("string").alias("latitude"), F.col("lng").cast("string").alias("longitude")).alias("location"))).alias("venues"),
                F.array_compact(acts).alias("attractions"),
            ).alias("_embedded"),
        )
    )
    got = feeds.from_feed_a(raw_events(spark, sf_dir).select("seq", body.alias("body")))
    return got.select(*_COLUMNS, F.col("festival.name").alias("festival"), F.array_join("lineup", ",").alias("lineup"))


def s12(spark, sf_dir):
    """Feed B; venues of every eleventh kind of title are templates."""
    venue = F.when(F.col("artist").endswith(" Keem"), F.concat(F.upper("artist"), F.lit(" in "), F.col("city"))).otherwise(F.col("venue"))
    body = F.to_json(
        F.struct(F.col("date").alias("datetime"), F.col("ticket_url").alias("url"), F.array(F.struct(F.lit(None).cast("string").alias("url"))).alias("offers"),
                 F.struct(venue.alias("name"), "city", "country", F.col("lat").cast("string").alias("latitude"), F.col("lng").cast("string").alias("longitude")).alias("venue"))
    )
    got = feeds.from_feed_b(raw_events(spark, sf_dir).select("seq", F.col("artist").alias("queried"), body.alias("body")))
    return got.select(*_COLUMNS)


def s16(spark, sf_dir):
    """Feed C, queried by each listing's act without its last word; what has no coordinates is online."""
    body = F.to_json(
        F.struct(F.concat(F.lit(" "), F.col("artist")).alias("name"), F.col("ticket_url").alias("url"), F.col("date").alias("start_date"), F.lit("18:00:00").alias("start_time"), F.col("lat").isNull().alias("is_online_event"),
                 F.struct(F.col("venue").alias("name"), F.struct("city", "country", F.col("lat").cast("string").alias("latitude"), F.col("lng").cast("string").alias("longitude")).alias("address")).alias("primary_venue"))
    )
    got = feeds.from_feed_c(raw_events(spark, sf_dir).select("seq", F.regexp_replace(F.lower("artist"), r" \S+$", "").alias("queried"), body.alias("body")))
    return got.select(*_COLUMNS)


QUERIES = {"S09_feed_a": s09, "S12_feed_b": s12, "S16_feed_c": s16}
_LAND = "CASE lower(country) WHEN 'germany' THEN 'DE' WHEN 'uk' THEN 'GB' WHEN 'the netherlands' THEN 'NL' ELSE upper(country) END"
SQL = {
    "S09_feed_a": f"""WITH {ORACLE} SELECT seq, artist, date, '19:30' AS start_time, venue, city, country, lat, lng, ticket_url, CASE WHEN ticket_url IS NOT NULL THEN 'Fest' END AS festival, CASE WHEN ticket_url IS NOT NULL THEN 'Support' END AS lineup FROM raw_event WHERE lat IS NOT NULL""",
    "S12_feed_b": f"""WITH {ORACLE} SELECT seq, artist, substr(date, 1, 10) AS date, CASE WHEN date LIKE '%T20:30%' THEN '20:30' END AS start_time, venue, city, {_LAND} AS country, lat, lng, ticket_url FROM raw_event WHERE artist NOT LIKE '% Keem'""",
    "S16_feed_c": f"""WITH {ORACLE} SELECT seq, artist, date, '18:00' AS start_time, venue, city, country, lat, lng, ticket_url FROM raw_event WHERE lat IS NOT NULL AND regexp_matches(artist, '[A-Za-z0-9_] \\S+$')""",
}


def served(url: str, headers: dict):
    """A service without a network: some targets are unknown, some fail, five in a row from 1,200 on; others have up to three pages."""
    parts = urlsplit(url).path.split("/")
    key, page = int(parts[1]), int(parts[2])
    if key % 13 == 0:
        return 404, None, None
    if key % 50 == 1 or 1200 <= key <= 1204:
        return 500, None, None
    return 200, json.dumps({"page": {"totalPages": key % 4}, "events": [] if key % 4 == 0 else [{"name": f"{key}-{page}"}]}), None


def s11(spark, sf_dir):
    """A sweep over customers; five failures in a row end it."""
    targets = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_custkey").alias("ord"))
    got = sweep.sweep(targets, "https://service.example/{key}/{page}", "eventlake.plans.feeds:served", pages=5, total="page.totalPages", items="events", misses=(404,))
    return got.select("key", "page", "status", "outcome", F.get_json_object("body", "$.events[0].name").alias("first"))


QUERIES["S11_sweep"] = s11
SQL["S11_sweep"] = """WITH c AS (SELECT c_custkey AS k FROM customer), a AS (SELECT k, CASE WHEN k > 1204 THEN 'stopped' WHEN k % 13 = 0 THEN 'miss' WHEN k % 50 = 1 OR k BETWEEN 1200 AND 1204 THEN 'failed' ELSE 'ok' END AS outcome FROM c),
 p AS (SELECT k, outcome, unnest(CASE WHEN outcome = 'ok' THEN range(greatest(k % 4, 1)) WHEN outcome = 'stopped' THEN [NULL::BIGINT] ELSE [0::BIGINT] END) AS page FROM a)
 SELECT CAST(k AS VARCHAR) AS key, CAST(page AS INT) AS page, CASE outcome WHEN 'ok' THEN 200 WHEN 'miss' THEN 404 WHEN 'failed' THEN 500 END AS status, outcome, CASE WHEN outcome = 'ok' AND k % 4 > 0 THEN k || '-' || page END AS first FROM p"""
