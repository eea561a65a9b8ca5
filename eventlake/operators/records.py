"""Records in the shapes they are published and exchanged in: catalogue and change entries, answers of lookups, run status."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from eventlake.functions import text
from eventlake.sources.html import without_scripts

NETWORKS = ("spotify", "instagram", "facebook", "youtube", "telegram", "vk")
SHOWN = 60_000  # characters of a page a model is shown
TAGS = 5
# Addresses an account of a network has.
ADDRESSES = {
    "spotify": "https://open.spotify.com/artist/", "instagram": "https://www.instagram.com/", "facebook": "https://www.facebook.com/",
    "youtube": "https://www.youtube.com/channel/", "telegram": "https://t.me/", "vk": "https://vk.com/",
}


def filled(c: Column | str) -> Column:
    """The text, null if it is empty."""
    return F.nullif(text.col(c), F.lit(""))


def field(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column of ``df``, null where it has none of that name."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def spotify_id(c: Column | str) -> Column:
    """The artist's id in an address of the network, whatever its language; null if it names none."""
    return filled(F.regexp_extract(text.col(c), r"open\.spotify\.com/(?:intl-[a-z]{2}/)?artist/([A-Za-z0-9]+)", 1))


def socials(c: Column | str) -> Column:
    """The known networks' addresses, empty ones null; null if none is left."""
    c = text.col(c)
    kept = [filled(c[n]).alias(n) for n in NETWORKS]
    return F.when(F.coalesce(*kept).isNotNull(), F.struct(*kept))


def probe_url(website: Column | str, suffix: Column | str) -> Column:
    """A page below a website: its scheme if none is given is https, its query and fragment are left out, the suffix follows a single slash."""
    base = text.trim(website)
    base = F.when(base.rlike("(?i)^https?://"), base).otherwise(F.concat(F.lit("https://"), base))
    root = F.regexp_replace(F.regexp_extract(base, r"(?i)^(https?://[^?#]*)", 1), "/+$", "")
    return F.concat(F.concat_ws("/", root, F.regexp_replace(text.col(suffix), "^/", "")))


def suspicious_name(c: Column | str, regions: list[str], words: list[str]) -> Column:
    """A name that ends in a comma and a region, or has one of the words as a whole one."""
    c = text.col(c)
    word = F.lit(False) if not words else c.rlike(rf"(?i){text.B0}(?:{'|'.join(words)}){text.B1}")
    return F.coalesce((c.contains(",") & text.after_last_comma(c).isin([r.lower() for r in regions])) | word, F.lit(False))


def noise_name(c: Column | str, seeds: list[str] = ()) -> Column:
    """A name no act has: it begins with no Latin or Cyrillic letter or digit and is no seed, or is a piece of an address or a page's markup."""
    c = text.col(c)
    begins = text.trim(c).rlike(r"^[A-Za-z0-9\x{C0}-\x{24F}\x{400}-\x{4FF}]") | F.lower(c).isin([s.lower() for s in seeds])
    return F.coalesce(~begins | c.rlike(r"(?i)wiki|https?:|category|[\[\]{}<>]"), F.lit(True))


def visible_text(html: Column | str, size: int = SHOWN) -> Column:
    """The first characters of a page without its scripts and styles."""
    return F.substring(without_scripts(html), 1, size)


def model_json(c: Column | str) -> Column:
    """The JSON object in a model's answer: of a fenced block what it holds, then from the first to the last brace; null if that is no JSON."""
    c = text.trim(c)
    body = F.coalesce(filled(F.regexp_extract(c, r"(?is)```(?:json)?\s*(.*?)\s*```", 1)), c)
    found = F.coalesce(filled(F.regexp_extract(body, r"(?s)(\{.*\})", 1)), body)
    return F.when(F.try_parse_json(found).isNotNull(), found)


def _stripped(v):
    if isinstance(v, list):
        return [_stripped(x) for x in v if x is not None]
    return {k: _stripped(x) for k, x in v.items() if x is not None} if isinstance(v, dict) else v


@F.pandas_udf(StringType())
def without_nulls(s: pd.Series) -> pd.Series:
    """A JSON text without null members and elements at any depth; a text that is no JSON is null."""

    def one(t):
        try:
            return json.dumps(_stripped(json.loads(t)), ensure_ascii=False, separators=(",", ":"))
        except (ValueError, TypeError):
            return None

    return s.map(one)


EXTRACTION = "concerts array<struct<artist:string,date:string,venue:string,city:string,country:string,ticketUrl:string>>"


def extracted_listings(df: DataFrame, answer: str = "answer") -> DataFrame:
    """Raw listings of models' answers about pages (domain, scraped_at and, as far as there are any, artist_fallback and the like); without an act or a date there is none."""
    rows = df.withColumn("_c", F.explode(F.from_json(model_json(answer), EXTRACTION)["concerts"]))
    told = lambda n: F.coalesce(filled(text.trim(F.col("_c")[n])), field(df, f"{n}_fallback"), F.lit(""))
    out = rows.select(*[c for c in df.columns if c != answer and not c.endswith("_fallback")], told("artist").alias("artist"), F.coalesce(text.trim("_c.date"), F.lit("")).alias("date"), *[told(n).alias(n) for n in ("venue", "city", "country")], filled(text.trim("_c.ticketUrl")).alias("ticket_url"))
    link = F.when(F.col("ticket_url").rlike("(?i)^https?://[^/?#]"), F.col("ticket_url"))
    return out.where("artist <> '' AND date <> ''").withColumn("ticket_url", link)


def catalog_entries(acts: DataFrame, order: str) -> DataFrame:
    """(slug, name, website, socials, spotify_id, mbid, genres, popularity, aliases): the first act of each slug, what is empty being null."""
    some = lambda c: F.when(F.size(c) > 0, c)
    links = socials("socials") if "socials" in acts.columns else F.lit(None).cast("struct<" + ",".join(f"{n}:string" for n in NETWORKS) + ">")
    rows = acts.where(filled("name").isNotNull()).select(
        text.slug("name").alias("slug"), "name", filled(field(acts, "website")).alias("website"), links.alias("socials"), filled(field(acts, "mbid")).alias("mbid"),
        some(field(acts, "genres", "array<string>")).alias("genres"), field(acts, "popularity", "struct<listeners:bigint,playcount:bigint>").alias("popularity"), some(field(acts, "aliases", "array<string>")).alias("aliases"), F.col(order).alias("_ord"),
    )
    rest = [c for c in rows.columns if c not in ("slug", "_ord")]
    first = rows.groupBy("slug").agg(F.min_by(F.struct(*rest), "_ord").alias("_r")).select("slug", "_r.*")
    return first.withColumn("spotify_id", spotify_id("socials.spotify")).withColumn("popularity", F.when(F.col("popularity.listeners").isNotNull(), F.col("popularity")))


def change_entries(concerts: DataFrame, key: Column, at: Column) -> DataFrame:
    """New concerts as entries of the change log."""
    return concerts.select(key.alias("concert_id"), "artist", "date", "venue", "city", "country", at.alias("detected_at"))


def bindings(rows: DataFrame, order: str) -> DataFrame:
    """(name, items, ambiguous, website, NETWORKS, mbid, sitelinks, aliases) of a knowledge base's rows (name, item, ...) by normalised name.

    Of a name that stands for one item the first value of each property counts, accounts as addresses; aliases are distinct and in
    order of the alphabet. A name that stands for several items is ambiguous and has no values.
    """
    keyed = rows.withColumn("name", text.norm_key("name")).where((filled("name").isNotNull()) & filled("item").isNotNull())
    first = lambda c: F.min_by(c, F.when(c.isNotNull(), F.col(order)))
    account = {n: F.concat(F.lit(a), F.regexp_replace(filled(field(rows, n)), "^@", "")) for n, a in ADDRESSES.items()}
    alias = text.trim(field(rows, "alias"))
    alias = F.when((alias != "") & (text.norm_key(alias) != F.col("name")), alias)
    out = keyed.groupBy("name").agg(
        F.countDistinct("item").alias("items"), first(filled(field(rows, "website"))).alias("website"), *[first(c).alias(n) for n, c in account.items()],
        first(filled(field(rows, "mbid"))).alias("mbid"), first(field(rows, "sitelinks").try_cast("bigint")).alias("sitelinks"), F.sort_array(F.collect_set(alias)).alias("aliases"),
    )
    values = [c for c in out.columns if c not in ("name", "items")]
    return out.select("name", "items", (F.col("items") > 1).alias("ambiguous"), *[F.when(F.col("items") == 1, F.col(c)).alias(c) for c in values])


def merge_filled(old: DataFrame, new: DataFrame, key: str, columns: list[str], source: str | None = None) -> DataFrame:
    """``old`` with what it lacks of ``columns`` filled from ``new`` (one row a key); ``source`` lists by plus who contributed, each once."""
    other = new.select(F.col(key).alias("_k"), *[filled(F.col(c)).alias(f"_n_{c}") for c in columns], *([F.col(source).alias("_s")] if source else []))
    j = old.join(other, old[key] == other["_k"], "left")
    gave = F.coalesce(*[F.when(filled(c).isNull() & F.col(f"_n_{c}").isNotNull(), True) for c in columns], F.lit(False))
    out = {c: F.coalesce(filled(c), F.col(f"_n_{c}")) for c in columns}
    if source:
        parts = F.filter(F.split(F.concat_ws("+", filled(source), F.when(gave, F.col("_s"))), r"\+"), lambda x: x != "")
        out[source] = filled(F.array_join(F.array_distinct(parts), "+"))
    return j.select(*[out.get(c, F.col(c)).alias(c) for c in old.columns])


def tag_answers(df: DataFrame, status: str = "status", body: str = "body") -> DataFrame:
    """``df`` with ok, genres (the first five tags) and popularity (only if both counts are numbers) of a tag service's answers.

    Status 400 and 404 and the body's error 6 are clean misses; other errors and bodies that are no JSON are to be asked again.
    """
    b = F.from_json(body, "error int, artist struct<tags:struct<tag:array<struct<name:string>>>,stats:struct<listeners:string,playcount:string>>")
    names = F.filter(F.transform(b["artist"]["tags"]["tag"], lambda t: text.trim(t["name"])), lambda n: n != "")
    count = lambda n: F.regexp_extract(b["artist"]["stats"][n], r"^\s*([+-]?\d+)", 1).try_cast("bigint")
    good = F.col(status).between(200, 299)
    ok = F.when(~good, F.col(status).isin(400, 404)).when(F.try_parse_json(body).isNull(), False).when(b["error"].isNotNull() & (b["error"] != 0), b["error"] == 6).otherwise(True)
    usable = good & F.coalesce(ok, F.lit(False)) & F.coalesce(b["error"] == 0, F.lit(True))
    both = count("listeners").isNotNull() & count("playcount").isNotNull()
    return df.select("*", F.coalesce(ok, F.lit(False)).alias("ok"), F.when(usable & (F.size(names) > 0), F.slice(names, 1, TAGS)).alias("genres"), F.when(usable & both, F.struct(count("listeners").alias("listeners"), count("playcount").alias("playcount"))).alias("popularity"))


def exact_image(name: Column | str, hit: Column | str, *images: Column | str) -> Column:
    """The first image of a search's top hit if that is the name but for case and blanks."""
    return F.when(text.norm_key(name) == text.norm_key(hit), F.coalesce(*[filled(i) for i in images]))


def first_match(*alternatives: tuple[Column, Column]) -> Column:
    """The value of the first condition that holds, null if none does; a null condition does not hold."""
    out = None
    for condition, value in alternatives:
        hit = F.coalesce(condition, F.lit(False))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out if out is not None else F.lit(None)


def utf16(c: Column | str) -> Column:
    """A sort key that orders texts by their UTF-16 units."""
    return F.encode(text.col(c), "utf-16be")


def progress(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: all rows, and those for which each condition holds."""
    return df.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def run_status(results: DataFrame, concerts: DataFrame | None, now: Column, stale_days: int = 7) -> DataFrame:
    """One row on a run's results (config_id, success, not_modified, scraped_at): counts, the failed and the stale sources by name, and the concerts published."""
    stale = F.col("scraped_at") < now - F.expr(f"INTERVAL {stale_days} DAYS")
    ids = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("config_id")))), ",")
    ok = F.coalesce("success", F.lit(False))
    out = results.agg(
        F.count("*").alias("total"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), F.count_if(ok & ~F.coalesce("not_modified", F.lit(False))).alias("changed"),
        F.count_if(ok & F.col("not_modified")).alias("unchanged"), ids(~ok).alias("failed_ids"), ids(stale).alias("stale_ids"),
    )
    return out if concerts is None else out.crossJoin(concerts.agg(F.count("*").alias("published")))  # one row each


def fail_log(results: DataFrame, size: int = SHOWN) -> DataFrame:
    """(id, error, reason, sample) of failed sources."""
    return results.where(~F.coalesce("success", F.lit(False))).select(F.col("config_id").alias("id"), field(results, "error").alias("error"), "reason", F.substring(field(results, "html"), 1, size).alias("sample"))


def two_pass(raw: DataFrame, whitelist: DataFrame, enrich, base: Column) -> DataFrame:
    """The concerts of ``raw`` after the whitelist has been enriched by what the first pass matched; both passes judge by the same day.

    ``enrich`` is a function of (whitelist, the first pass's concerts) that returns the whitelist to go by.
    """
    from eventlake.operators import pipeline

    first = pipeline.concerts(pipeline.judge(raw, whitelist, base))
    return pipeline.concerts(pipeline.judge(raw, enrich(whitelist, first), base))
