"""Events of three listing feeds as raw listings: one JSON text a row in, typed columns out, expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions import text
from eventlake.operators.pipeline import templated_venue

FEED_A = "name string, url string, dates struct<start:struct<localDate:string,localTime:string>>, _embedded struct<venues:array<struct<name:string,city:struct<name:string>,country:struct<countryCode:string>,location:struct<latitude:string,longitude:string>>>,attractions:array<struct<name:string>>>"
FEED_B = "starts_at string, datetime string, url string, offers array<struct<url:string>>, artist struct<name:string>, lineup array<string>, venue struct<name:string,city:string,country:string,latitude:string,longitude:string>"
FEED_C = "name string, url string, start_date string, start_time string, is_online_event boolean, primary_venue struct<name:string,address:struct<city:string,country:string,latitude:string,longitude:string>>"


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _number(c: Column) -> Column:
    """The number a text starts with, null if it starts with none."""
    return F.regexp_extract(c, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1).try_cast("double")


def _out(df: DataFrame, keep: Column, **columns: Column) -> DataFrame:
    return df.where(F.coalesce(keep, F.lit(False))).select(*[c for c in df.columns if c not in ("_e", "body")], *[c.alias(n) for n, c in columns.items()])


def from_feed_a(df: DataFrame, body: str = "body") -> DataFrame:
    """Feed A: the first attraction, else the event, is the act; with several the event is a festival and the others its line-up.

    Events without act, day, venue, town or country code, and bodies that are no JSON, are left out.
    """
    e = df.withColumn("_e", F.from_json(F.col(body), FEED_A))
    v, acts = F.get(F.col("_e._embedded.venues"), F.lit(0)), F.coalesce(F.col("_e._embedded.attractions"), F.array().cast("array<struct<name:string>>"))
    artist, many = F.coalesce(_filled(F.get(acts, F.lit(0))["name"]), _filled(F.col("_e.name"))), F.size(acts) > 1
    day, clock = _filled(F.col("_e.dates.start.localDate")), F.col("_e.dates.start.localTime")
    keep = artist.isNotNull() & day.isNotNull() & _filled(v["name"]).isNotNull() & _filled(v["city"]["name"]).isNotNull() & _filled(v["country"]["countryCode"]).isNotNull()
    rest = F.filter(F.transform(F.slice(acts, 2, F.greatest(F.size(acts), F.lit(1))), lambda a: a["name"]), lambda n: _filled(n).isNotNull())
    festival = F.when(many & _filled(F.col("_e.name")).isNotNull(), F.struct(F.col("_e.name").alias("name"), F.col("_e.url").alias("url")))
    return _out(
        e, keep, artist=artist, date=day, start_time=F.when(clock.rlike(r"^\d{2}:\d{2}"), F.substring(clock, 1, 5)), venue=v["name"], city=v["city"]["name"], country=v["country"]["countryCode"],
        lat=_number(v["location"]["latitude"]), lng=_number(v["location"]["longitude"]), festival=festival, lineup=F.when(many, rest), ticket_url=F.col("_e.url"),
    )


def from_feed_b(df: DataFrame, queried: str = "queried", body: str = "body") -> DataFrame:
    """Feed B: the queried name goes before the feed's; countries by name, unknown ones left out, as are venues that only say the act and a town."""
    e = df.withColumn("_e", F.from_json(F.col(body), FEED_B))
    artist = F.coalesce(_filled(F.col(queried)), _filled(F.col("_e.artist.name")), _filled(F.get(F.col("_e.lineup"), F.lit(0))))
    at, v = F.coalesce(_filled(F.col("_e.starts_at")), _filled(F.col("_e.datetime"))), F.col("_e.venue")
    land = text.country_or_null(v["country"])
    keep = artist.isNotNull() & at.isNotNull() & _filled(v["name"]).isNotNull() & _filled(v["city"]).isNotNull() & land.isNotNull() & ~templated_venue(text.trim(artist), text.trim(v["name"]))
    return _out(
        e, keep, artist=artist, date=F.substring(at, 1, 10), start_time=_filled(F.regexp_extract(at, r"T(\d{2}:\d{2})", 1)), venue=v["name"], city=v["city"], country=land,
        lat=_number(v["latitude"]), lng=_number(v["longitude"]), ticket_url=F.coalesce(_filled(F.get(F.col("_e.offers"), F.lit(0))["url"]), F.col("_e.url")),
    )


def from_feed_c(df: DataFrame, queried: str = "queried", body: str = "body") -> DataFrame:
    """Feed C: events on site whose title leads with the queried name as a whole word; the title stays the act."""
    e = df.withColumn("_e", F.from_json(F.col(body), FEED_C))
    title, name = text.trim("_e.name"), text.trim(queried)
    after = F.substring(title, F.length(name) + 1, F.lit(1))
    inner = F.substring(title, F.length(name), F.lit(1)).rlike("[A-Za-z0-9_]")
    leads = (F.lower(F.substring(title, F.lit(1), F.length(name))) == F.lower(name)) & (inner != after.rlike("[A-Za-z0-9_]"))
    v = F.col("_e.primary_venue")
    a = v["address"]
    keep = ~F.coalesce(F.col("_e.is_online_event"), F.lit(False)) & leads & _filled(title).isNotNull() & _filled(v["name"]).isNotNull() & _filled(a["city"]).isNotNull() & _filled(a["country"]).isNotNull() & _filled(F.col("_e.start_date")).isNotNull()
    return _out(
        e, keep, artist=title, date=F.col("_e.start_date"), start_time=F.substring(_filled(F.col("_e.start_time")), 1, 5), venue=v["name"], city=a["city"], country=a["country"],
        lat=_number(a["latitude"]), lng=_number(a["longitude"]), ticket_url=F.col("_e.url"),
    )
