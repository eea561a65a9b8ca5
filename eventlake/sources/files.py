"""Files in and out: source configurations, the whitelist in its layouts, target lists; published lists, pages, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions import text
from eventlake.functions.urls import private_host
from eventlake.operators import ranking, state

SELECTORS = "eventBlock string, artist string, date string, venue string, city string, country string, link string, eventsPath string, artistPath string, datePath string, venueNameFallback string, cityNameFallback string, countryNameFallback string, datePattern string"
CONFIG = f"id string, domain string, url string, type string, maxRetries int, requestDelayMs int, allowEmpty boolean, selectors struct<{', '.join(p.replace(' ', ':', 1) for p in SELECTORS.split(', '))}>, _bad string"
# How a source is read.
TYPES = ("static_selectors", "json_api", "jsonld", "next_data", "playwright_render", "custom_js")
ACT = "name string, website string, tourUrl string, mbid string, tier string, genres array<string>, aliases array<string>, socials struct<spotify:string,instagram:string,facebook:string,youtube:string,telegram:string,vk:string>, popularity struct<listeners:bigint,playcount:bigint>"
SHARDS = 8


def read_configs(spark: SparkSession, folder: str) -> DataFrame:
    """Valid source configurations of a folder's JSON files; bad ones are left out, a missing folder is an error.

    Valid is one with an id of lower-case letters, digits and hyphens, a known type, an http(s) address on a public host and at most 5 retries.
    """
    df = spark.read.schema(CONFIG).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("pathGlobFilter", "*.json").json(folder, multiLine=True)
    host = F.regexp_extract(F.lower("url"), r"^https?://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]+)", 1)
    ok = F.col("_bad").isNull() & F.col("id").rlike(r"^[a-z0-9][a-z0-9-]*$") & F.col("type").isin(*TYPES) & (host != "") & ~private_host(host) & F.coalesce("maxRetries", F.lit(2)).between(0, 5)
    return df.where(F.coalesce(ok, F.lit(False))).drop("_bad")


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """Whitelist rows with ``ord``, from one JSON file or a folder of shards in order of their names; bare texts are rows with a name only.

    An absent place is an empty list.
    """
    try:
        files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json").select(F.col("_metadata.file_name").alias("file"), F.col("value"))
        files.limit(1).count()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        files = spark.createDataFrame([], "file string, value string")
    items = files.select("file", F.posexplode(F.from_json("value", "array<string>")).alias("at", "item"))
    row = F.when(F.col("item").startswith("{"), F.from_json("item", ACT)).otherwise(F.from_json(F.to_json(F.struct(F.col("item").alias("name"))), ACT))
    return ranking.indexed(items.select("file", "at", row.alias("r")).where(F.length("r.name") > 0), F.col("file"), F.col("at"), name="ord").select("ord", "r.*")


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """Distinct names of a text file with one a line; blank lines and lines after # are none."""
    lines = spark.read.text(path).select(text.trim("value").alias("name"))
    return lines.where((F.length("name") > 0) & ~F.col("name").startswith("#")).groupBy(text.norm_key("name").alias("key")).agg(F.min("name").alias("name"))


def shard_of(name: Column | str) -> Column:
    """The shard of a name: the UTF-16 unit of its first character in upper case, modulo the shards."""
    unit = F.conv(F.substring(F.hex(F.encode(F.upper(F.substring(text.col(name), 1, 1)), "utf-16be")), 1, 4), 16, 10).cast("int")
    return F.coalesce(unit, F.lit(0)) % SHARDS


def write_shards(new: DataFrame, old: DataFrame | None, path: str) -> DataFrame:
    """Writes the shards of ``new`` (with a ``name``) that differ from ``old``, sorted by name; returns their numbers."""
    new = new.withColumn("shard", shard_of("name"))
    columns = [c for c in new.columns if c != "shard"]
    as_text = lambda df: df.select("shard", F.to_json(F.struct(*columns)).alias("j"))
    todo = new.select("shard").distinct() if old is None else state.changed_shards(as_text(old.withColumn("shard", shard_of("name"))), as_text(new), "shard", ["j"])
    rows = new.join(F.broadcast(todo), "shard", "left_semi")  # one row a shard
    rows.repartition("shard").sortWithinPartitions("shard", "name").write.partitionBy("shard").option("partitionOverwriteMode", "dynamic").mode("overwrite").json(path)
    return todo


def index_of(concerts: DataFrame, run_at: Column, page: int = ranking.PAGE) -> DataFrame:
    """One row: counts, pages and when the run was."""
    return concerts.agg(F.count("*").alias("totalConcerts"), F.countDistinct("artist").alias("uniqueArtists"), F.countDistinct("city").alias("uniqueCities"), F.ceil(F.count("*") / page).alias("pageCount")).select(F.lit(1).alias("schemaVersion"), run_at.alias("lastRun"), F.struct("*").alias("stats"))


def publish(concerts: DataFrame, folder: str, run_at: Column, **more: DataFrame) -> None:
    """Writes the concerts as Parquet and as JSON lists by act, by town and by page, the index, and what else is given by name (status, changes, catalogue, failures). Each list is replaced as a whole, so what is gone leaves no orphan.

    Lists are partitions, not files of a driver: a partition's rows are sorted by date, act and town.
    """
    paged = ranking.pages(concerts, F.col("date"), F.col("artist"), F.col("city"), F.xxhash64(*concerts.columns)).drop("pos")
    order = ("date", "artist", "city")
    paged.write.mode("overwrite").parquet(f"{folder}/concerts")
    lists = {"artists": ("artist_slug", text.slug("artist")), "cities": ("city_slug", text.slug("city")), "pages": ("page", F.col("page"))}
    for name, (key, value) in lists.items():
        rows = paged.withColumn(key, value)
        rows.repartition(key).sortWithinPartitions(key, *order).write.mode("overwrite").partitionBy(key).json(f"{folder}/{name}")
    index_of(concerts, run_at).coalesce(1).write.mode("overwrite").json(f"{folder}/index")
    for name, df in more.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")


def healthy(previous: int | None, now: int) -> bool:
    """Whether a run may be published: it has rows, and no fewer than half of the run before."""
    return now > 0 and (not previous or now >= previous / 2)
