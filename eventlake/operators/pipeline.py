"""Raw listings to concerts: validity, the first reason to drop a row, projection, the best row of a key, content hashes."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions import dates, text
from eventlake.operators import match, records

SOCIALS = "struct<" + ",".join(f"{n}:string" for n in records.NETWORKS) + ">"
REQUIRED = ("artist", "date", "venue", "city", "country", "original_source", "scraped_at")


def filled(*names: str) -> Column:
    """All of the columns are there and not empty."""
    out = F.lit(True)
    for n in names:
        out = out & (F.length(F.coalesce(F.col(n), F.lit(""))) > 0)
    return out


def templated_venue(artist: Column | str, venue: Column | str) -> Column:
    """A venue that only says the act and a town ("<act> in ..."), which no real venue is called."""
    a, v = text.col(artist), text.col(venue)
    starts = F.lower(F.substring(v, F.lit(1), F.length(a))) == F.lower(a)
    return (F.length(a) > 0) & starts & F.substring(v, F.length(a) + 1, F.length(v)).rlike(r"(?iu)^\s+(в|in)\s+\S")


def url_ok(c: Column | str) -> Column:
    """Null, empty, or an absolute address with a host."""
    c = text.col(c)
    return c.isNull() | (c == "") | F.expr("true") & F.try_parse_url(c, F.lit("HOST")).isNotNull()


def valid(date: str = "day") -> Column:
    """What a concert must fulfil: its text, codes, times, coordinates and addresses."""
    code = F.length(text.country("country")) == 2
    times = F.col("start_time").isNull() | F.col("start_time").rlike(r"^([01]\d|2[0-3]):[0-5]\d$")
    where = (F.col("lat").isNull() | F.col("lat").between(-90, 90)) & (F.col("lng").isNull() | F.col("lng").between(-180, 180))
    texts = (F.length(text.trim("venue")) > 0) & (F.length(text.trim("city")) > 0)
    return F.coalesce(code & times & where & texts & url_ok("link") & F.col(date).isNotNull(), F.lit(False))


def judge(raw: DataFrame, whitelist: DataFrame, base: Column) -> DataFrame:
    """``raw`` with matched entry, day, link, start_time and drop_reason, null for rows to keep.

    Each row has the first reason of: incomplete, not approved, bad date, past date, invalid.
    """
    df = match.resolve(dates.with_dates(raw, "date", base), whitelist).withColumn("start_time", text.embedded_time("date"))
    told = F.struct(records.field(whitelist, "website").alias("website"), (records.socials("socials") if "socials" in whitelist.columns else F.lit(None).cast(SOCIALS)).alias("socials"), records.field(whitelist, "mbid").alias("mbid"))
    sites = whitelist.groupBy(F.col("name").alias("_name")).agg(F.max_by(told, "ord").alias("_m")).select("_name", "_m.*")
    df = df.join(sites, F.col("matched") == F.col("_name"), "left").withColumn("link", F.coalesce(F.nullif("website", F.lit("")), text.trim("ticket_url")))
    reason = (
        F.when(~filled(*REQUIRED), "incomplete")
        .when(F.col("matched").isNull(), "not approved")
        .when(F.col("day").isNull(), "bad date")
        .when(F.col("day") < base, "past date")
        .when(~valid(), "invalid")
    )
    return df.withColumn("drop_reason", reason).drop("_name")


def concerts(judged: DataFrame) -> DataFrame:
    """The kept rows of :func:`judge` as concerts; festival and line-up as far as the listings have them."""
    return judged.where(F.col("drop_reason").isNull()).select(
        "seq", F.col("matched").alias("artist"), records.filled("website").alias("artist_website"), F.col("socials").alias("artist_socials"), records.spotify_id("socials.spotify").alias("spotify_id"), records.filled("mbid").alias("mbid"), F.col("day").alias("date"), "start_time", text.trim("venue").alias("venue"), text.venue_kind("venue").alias("venue_kind"),
        text.trim("city").alias("city"), text.country("country").alias("country"), "lat", "lng", records.field(judged, "festival", "struct<name:string,url:string>").alias("festival"), records.field(judged, "lineup", "array<string>").alias("lineup"), F.col("link").alias("ticket_url"), "original_source", "scraped_at",
    )


def concert_key() -> Column:
    return F.concat_ws("_", text.slug("artist"), F.date_format("date", "yyyy-MM-dd"), text.slug("city"))


def best_of_key(df: DataFrame, key: str = "key") -> DataFrame:
    """One row a key: the first by ``seq``, unless it has no ticket_url and a later one has, then the first such.

    One aggregate with map-side combine, so a hot key costs no more than others.
    """
    lacks = (F.length(F.coalesce(F.col("ticket_url"), F.lit(""))) == 0).cast("int")
    return df.groupBy(key).agg(F.min_by(F.struct(*[c for c in df.columns if c != key]), F.struct(lacks, "seq")).alias("_r")).select(key, "_r.*")


def content_hashes(df: DataFrame, source: str) -> DataFrame:
    """(source, n, content_hash): SHA-1 over a source's rows, sorted and joined by line breaks.

    Rows are sorted by the shuffle, which spills, and hashed as they stream by: no source is held in memory.
    """
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("artist", "date", "venue", "city", "ticket_url")])
    rows = df.select(F.col(source).alias("source"), line.alias("line")).repartition("source").sortWithinPartitions("source", "line")

    def f(batches):
        now, h, n = None, None, 0
        for b in batches:
            done = []
            for s, text_ in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if h is None or s != now:
                    if h is not None:
                        done.append((now, n, h.hexdigest()))
                    now, h, n = s, hashlib.sha1(), 0
                h.update((("\n" if n else "") + text_).encode())
                n += 1
            if done:
                yield _hashes(done)
        if h is not None:
            yield _hashes([(now, n, h.hexdigest())])

    return rows.mapInArrow(f, "source string, n long, content_hash string")


def _hashes(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=["source", "n", "content_hash"])
