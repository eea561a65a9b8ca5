"""Raw listings and a whitelist of performers derived from the order tables, as one text for Spark and for the SQL they are checked with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import spread, table

BASE = "1998-06-15"

RAW_SQL = """
SELECT seq,
  CASE seq % 13
    WHEN 0 THEN nm WHEN 1 THEN upper(nm) WHEN 2 THEN nm || ' - SOLD OUT'
    WHEN 3 THEN nm || ' (SOLD OUT)' WHEN 4 THEN nm || ' - Live at Arena'
    WHEN 5 THEN nm || ' live in Lima' WHEN 6 THEN nm || ' - Special Guest: X'
    WHEN 7 THEN nm || ' Tribute Band' WHEN 8 THEN substr(nm,1,2) || substr(nm,4)
    WHEN 9 THEN nm || ' at the O2' WHEN 10 THEN 'wall of ' || nm
    WHEN 11 THEN nm || ' Keem' ELSE 'unlisted act ' || CAST(seq AS STRING) END AS artist,
  CASE seq % 9
    WHEN 0 THEN CAST(y AS STRING) || '-' || lpad(CAST(m AS STRING),2,'0') || '-' || lpad(CAST(d AS STRING),2,'0')
    WHEN 1 THEN CAST(d AS STRING) || '.' || CAST(m AS STRING) || '.' || CAST(y AS STRING)
    WHEN 2 THEN CAST(d AS STRING) || '/' || CAST(m AS STRING) || '/' || CAST(y AS STRING)
    WHEN 3 THEN CAST(d AS STRING) || ' ' || split_part('Jan,Feb,Mar,Apr,May,Jun,Jul,Aug,Sep,Oct,Nov,Dec',',',m) || ' ' || CAST(y AS STRING)
    WHEN 4 THEN split_part('Januar,Februar,März,April,Mai,Juni,Juli,August,September,Oktober,November,Dezember',',',m) || ' ' || CAST(d AS STRING) || ', ' || CAST(y AS STRING)
    WHEN 5 THEN CAST(d AS STRING) || ' de ' || split_part('enero,febrero,marzo,abril,mayo,junio,julio,agosto,septiembre,octubre,noviembre,diciembre',',',m) || ' de ' || CAST(y AS STRING)
    WHEN 6 THEN CAST(y AS STRING) || '-' || lpad(CAST(m AS STRING),2,'0') || '-' || lpad(CAST(d AS STRING),2,'0') || 'T20:30:00'
    WHEN 7 THEN CAST(d AS STRING) || '. ' || split_part('Jan,Feb,Mrz,Apr,Mai,Jun,Jul,Aug,Sep,Okt,Nov,Dez',',',m)
    ELSE 'doors 8pm' END AS date,
  br || ' ' || split_part('Stadium,Arena,Club,Opera House,Hall,Room',',',CAST(seq % 6 AS INT) + 1) AS venue,
  'City ' || CAST(ck % 40 AS STRING) AS city,
  split_part('Germany,de,UK,The Netherlands,US',',',CAST(nk % 5 AS INT) + 1) AS country,
  CAST(CASE WHEN ck % 40 >= 30 THEN NULL ELSE (CASE WHEN nk % 5 <= 1 THEN 0 ELSE nk % 5 END) * 15.0 + (ck % 40) * 0.2 + floor((ck % 40) / 4.0) END AS DOUBLE) AS lat,
  CAST(CASE WHEN ck % 40 >= 30 THEN NULL ELSE (CASE WHEN nk % 5 <= 1 THEN 0 ELSE nk % 5 END) * 12.0 + (ck % 7) * 0.01 END AS DOUBLE) AS lng,
  CASE WHEN seq % 4 = 0 THEN NULL ELSE 'https://t.example/' || CAST(seq AS STRING) END AS ticket_url,
  CASE WHEN seq % 50 = 49 THEN '' ELSE split_part('venue.example,ticketmaster.com,bandsintown.com,eventbrite.com',',',CAST(seq % 4 AS INT) + 1) END AS original_source,
  '1998-06-15T00:00:00Z' AS scraped_at
FROM (
  SELECT o.o_orderkey AS seq, p.p_name AS nm, p.p_brand AS br, c.c_custkey AS ck, c.c_nationkey AS nk,
         CAST(extract(year FROM o.o_orderdate) AS INT) AS y,
         CAST(extract(month FROM o.o_orderdate) AS INT) AS m,
         CAST(extract(day FROM o.o_orderdate) AS INT) AS d
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
                JOIN {part} p ON p.p_partkey = o.o_orderkey % 200) t"""

ORACLE = "raw_event AS (" + RAW_SQL.format(orders="orders", customer="customer", part="part") + ")"
ECHO = """raw2 AS (SELECT seq, artist, date, venue, city, country, lat, lng, ticket_url, original_source FROM raw_event
UNION ALL SELECT seq + 1000000000, upper(artist), date, venue, city, country, lat, lng, coalesce(ticket_url, 'https://u.example/' || CAST(seq AS STRING)), 'bandsintown.com' FROM raw_event)"""
NAMES = "names AS (SELECT p_name AS name, min(p_partkey) AS ord FROM part GROUP BY p_name)"


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw listing an order, with free-text performer, date, venue and country."""
    tables = {"orders": spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")), "customer": table(spark, sf_dir, "customer"), "part": table(spark, sf_dir, "part")}
    return spark.sql(RAW_SQL, **tables)


def with_echo(raw: DataFrame) -> DataFrame:
    """Each listing and a later copy of it from another source, whose link is always there."""
    cols = ["seq", "artist", "date", "venue", "city", "country", "lat", "lng", "ticket_url", "original_source"]
    other = {
        "seq": F.col("seq") + 1000000000, "artist": F.upper("artist"), "original_source": F.lit("bandsintown.com"),
        "ticket_url": F.coalesce("ticket_url", F.concat(F.lit("https://u.example/"), F.col("seq").cast("string"))),
    }
    both = F.array(F.struct(*cols), F.struct(*[other.get(c, F.col(c)).alias(c) for c in cols]))
    return raw.select(F.explode(both).alias("_r")).select("_r.*")  # one scan for both


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, ord, website): the distinct part names in order of their first key."""
    names = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("ord"))
    return names.withColumn("website", F.when(F.col("ord") % 2 == 0, F.concat(F.lit("https://a.example/"), F.col("ord").cast("string"))))
