"""Queries on published and exchanged records, answers of lookups and fixed cases of the text functions; each with its SQL."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from eventlake.functions import dates, text, urls
from eventlake.operators import catalog, match, pipeline, ranking, records, state
from eventlake.session import spread, table
from eventlake.sources import http
from eventlake.sources.raw_event import ORACLE, raw_events

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("NULL" if v is None else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'" for v in r) + ")" for r in rows)


# ------------------------------------------------------------------ fixed cases
# A text and the day it means on 15 June 2026, one or more for each branch of the ladder.
LADDER = [
    ("today", "2026-06-15"), ("Heute", "2026-06-15"), ("tomorrow", "2026-06-16"), ("morgen", "2026-06-16"), ("3 de mayo de 2027", "2027-05-03"), ("3 de mayo", "2027-05-03"), ("20 de mayo", "2026-05-20"),
    ("2026-10-03", "2026-10-03"), ("2026-02-30", None), ("3.10.26", "2026-10-03"), ("3/10/2026", "2026-10-03"), ("10/25/2026", "2026-10-25"), ("3.10.", "2026-10-03"), ("3.2", "2027-02-03"), ("3. Oktober 2026", "2026-10-03"),
    ("Oct 3, 2026", "2026-10-03"), ("3 окт 2026", None), ("3 октября 2026", "2026-10-03"), ("3. Okt", "2026-10-03"), ("march 1", "2027-03-01"), ("2026-10-03T20:30:00", "2026-10-03"), ("Fri 3 Oct - 5 Oct 2026 doors 8pm", "2026-10-03"),
    ("from 3-5 October at night", "2026-10-03"), ("October 3rd 2026", "2026-10-03"), ("Friday October 3rd", "2026-10-03"), ("doors 8pm", None), ("31 april 2026", None), ("", None),
]
# What a feed calls a country, and its code.
LANDS = [
    ("Germany", "DE"), ("de", "DE"), ("Vietnam", "VN"), ("philippines", "PH"), ("Taiwan", "TW"), ("Pakistan", "PK"), ("Venezuela", "VE"), ("Bolivia", "BO"), ("North Korea", "KP"), ("台湾", "TW"), ("대한민국", "KR"), ("香港", "HK"), ("日本", "JP"),
    ("Czech Republic", "CZ"), ("Turkey", "TR"), ("USA", "US"), ("United States of America", "US"), ("UK", "GB"), ("Laos", "LA"), ("Syria", "SY"), ("Macau", "MO"), ("Ivory Coast", "CI"), ("Democratic Republic of the Congo", "CD"), ("Moldova", "MD"),
    ("ไทย", "TH"), ("РОССИЯ", "RU"), ("España", "ES"), ("México", "MX"), ("Brasil", "BR"), ("Afghanistan", "AF"), ("Fiji", "FJ"), ("Namibia", "NA"), ("Zimbabwe", "ZW"), ("Åland Islands", "AX"), ("Scotland", None), ("Wales", None), ("Nowhere", None), ("D1", None), ("  France ", "FR"), ("", None),
]


@query("D_ladder", f"SELECT t AS said, CAST(d AS DATE) AS day FROM (VALUES {_values(LADDER)}) v(t, d)")
def d_ladder(spark, sf_dir):
    """Every branch of the date ladder."""
    df = spark.createDataFrame([(t,) for t, _ in LADDER], "said string")
    return dates.with_dates(df, "said", F.lit(datetime.date(2026, 6, 15))).select("said", "day")


@query("F07_countries", f"SELECT t AS said, c AS code FROM (VALUES {_values(LANDS)}) v(t, c)")
def f07(spark, sf_dir):
    """Countries by their names in feeds."""
    return spark.createDataFrame([(t,) for t, _ in LANDS], "said string").select("said", text.country_or_null("said").alias("code"))


# ------------------------------------------------------------------ names and addresses
_LOOKUPS = "(SELECT DISTINCT lookup_id, slug, provider, ok, item, website, socials, mbid, sitelinks, fetched_at FROM artist_lookup)"


def _lookups(spark, sf_dir):
    return table(spark, sf_dir, "artist_lookup").distinct()


@query("F08_spotify_id", rf"SELECT lookup_id, nullif(regexp_extract(replace(socials.spotify, '.example', '.com'), 'open\.spotify\.com/(?:intl-[a-z]{{2}}/)?artist/([A-Za-z0-9]+)', 1), '') AS spotify_id FROM {_LOOKUPS}")
def f08(spark, sf_dir):
    return _lookups(spark, sf_dir).select("lookup_id", records.spotify_id(F.replace("socials.spotify", F.lit(".example"), F.lit(".com"))).alias("spotify_id"))


@query("F11_socials", f"SELECT lookup_id, {', '.join(f'''nullif(socials.{n}, '') AS {n}''' for n in records.NETWORKS)} FROM {_LOOKUPS} WHERE coalesce({', '.join(f'''nullif(socials.{n}, '')''' for n in records.NETWORKS)}) IS NOT NULL")
def f11(spark, sf_dir):
    """Rows with any account, empty ones null."""
    return _lookups(spark, sf_dir).select("lookup_id", records.socials("socials").alias("s")).where("s IS NOT NULL").select("lookup_id", "s.*")


@query("F18_probe_url", rf"""SELECT lookup_id, concat(regexp_replace(regexp_extract(CASE WHEN regexp_matches(w, '(?i)^https?://') THEN w ELSE 'https://' || w END, '(?i)^(https?://[^?#]*)', 1), '/+$', ''), '/tour') AS url
 FROM (SELECT lookup_id, regexp_replace(website, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g') AS w FROM {_LOOKUPS}) WHERE w <> ''""")
def f18(spark, sf_dir):
    return _lookups(spark, sf_dir).where(text.trim("website") != "").select("lookup_id", records.probe_url("website", F.lit("/tour")).alias("url"))


@query("F23_suspicious", r"SELECT gap_id, coalesce((contains(raw_name, ',') AND lower(trim(list_last(string_split(raw_name, ',')))) IN ('the', 'alexander')) OR regexp_matches(raw_name, '(?i)\b(ensemble|choir|karaoke)\b'), false) AS suspicious FROM gap_entry")
def f23(spark, sf_dir):
    return table(spark, sf_dir, "gap_entry").select("gap_id", records.suspicious_name("raw_name", ["The", "Alexander"], ["ensemble", "choir", "karaoke"]).alias("suspicious"))


@query("P12_noise", r"SELECT gap_id, coalesce(NOT regexp_matches(regexp_replace(raw_name, '^[\s\x{a0}]+', ''), '^[A-Za-z0-9\x{C0}-\x{24F}\x{400}-\x{4FF}]') OR regexp_matches(raw_name, '(?i)wiki|https?:|category|[\[\]{}<>]'), true) AS noise FROM gap_entry")
def p12(spark, sf_dir):
    return table(spark, sf_dir, "gap_entry").select("gap_id", records.noise_name("raw_name").alias("noise"))


@query("S13_templates", f"WITH {ORACLE} SELECT seq, CASE WHEN seq % 3 = 0 THEN artist <> '' AND city <> '' ELSE false END AS template FROM raw_event")
def s13(spark, sf_dir):
    """Venues that only say the act and a town, among venues that do not, or say the act alone."""
    venue = F.when(F.col("seq") % 3 == 0, F.concat(F.upper("artist"), F.lit(" in "), F.col("city"))).when(F.col("seq") % 3 == 1, F.col("artist")).otherwise(F.col("venue"))
    return raw_events(spark, sf_dir).select("seq", F.coalesce(pipeline.templated_venue("artist", venue), F.lit(False)).alias("template"))


@query("W08_first_match", "SELECT gap_id, CASE WHEN raw_name LIKE '%Tribute%' THEN 'tribute' WHEN seen_count > 5 THEN 'often' WHEN raw_name LIKE '%(%' THEN 'bracket' END AS kind FROM gap_entry")
def w08(spark, sf_dir):
    """The first of several alternatives that fits."""
    kind = records.first_match((F.col("raw_name").contains("Tribute"), F.lit("tribute")), (F.col("seen_count") > 5, F.lit("often")), (F.col("raw_name").contains("("), F.lit("bracket")))
    return table(spark, sf_dir, "gap_entry").select("gap_id", kind.alias("kind"))


# ------------------------------------------------------------------ models' and services' answers
@query("R05_extracted", f"WITH {ORACLE} SELECT seq, artist, date, 'Main Hall' AS venue, city, CASE WHEN seq % 2 = 0 THEN country ELSE 'DE' END AS country, CASE WHEN ticket_url IS NOT NULL THEN ticket_url END AS ticket_url FROM raw_event WHERE seq % 5 <> 0 AND artist <> ''")
def r05(spark, sf_dir):
    """Answers with talk and fences around their JSON; what a row lacks comes from the source's fallbacks."""
    row = F.struct(F.concat(F.lit(" "), F.col("artist")).alias("artist"), "date", F.lit("  ").alias("venue"), "city", F.when(F.col("seq") % 2 == 0, F.col("country")).alias("country"), F.coalesce("ticket_url", F.lit("javascript:x")).alias("ticketUrl"))
    body = F.to_json(F.struct(F.array(row).alias("concerts")))
    answer = F.when(F.col("seq") % 5 == 0, F.lit("I found {none")).when(F.col("seq") % 5 == 1, F.concat(F.lit("Sure!\n```json\n"), body, F.lit("\n```\n"))).otherwise(F.concat(F.lit("Result: "), body, F.lit(" done")))
    pages = raw_events(spark, sf_dir).select("seq", answer.alias("answer"), F.lit("Main Hall").alias("venue_fallback"), F.lit("DE").alias("country_fallback"))
    return records.extracted_listings(pages).select("seq", "artist", "date", "venue", "city", "country", "ticket_url")


@query("F26_without_nulls", f"SELECT lookup_id, CAST(json_merge_patch('{{}}', to_json({{'mbid': mbid, 'provider': provider, 'socials': {{'vk': socials.vk, 'telegram': socials.telegram}}}})) AS VARCHAR) AS j FROM {_LOOKUPS}")
def f26(spark, sf_dir):
    s = F.struct("mbid", "provider", F.struct("socials.vk", "socials.telegram").alias("socials"))
    return _lookups(spark, sf_dir).select("lookup_id", records.without_nulls(F.to_json(s, {"ignoreNullFields": "false"})).alias("j"))


@query("F24_visible", r"SELECT doc_id, length(substr(regexp_replace(regexp_replace(text, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), 1, 500)) AS n FROM documents")
def f24(spark, sf_dir):
    """What a model is shown of a page, at most 500 characters here."""
    return table(spark, sf_dir, "documents").select("doc_id", F.length(records.visible_text("text", 500)).cast("long").alias("n"))


@query("R09_tags", """WITH a AS (SELECT artist_id, artist_id % 5 AS k, genres, popularity FROM artist_catalog)
 SELECT artist_id, k <> 1 AND k <> 3 AS ok, CASE WHEN k IN (0, 4) AND len(genres) > 0 THEN array_to_string(genres[:5], ',') END AS genres, CASE WHEN k IN (0, 4) AND popularity.playcount IS NOT NULL THEN popularity.listeners END AS listeners FROM a""")
def r09(spark, sf_dir):
    """Answers of a tag service: found, failed, unknown, limited."""
    k = F.pmod("artist_id", F.lit(5))
    tags = F.transform(F.coalesce("genres", F.array().cast("array<string>")), lambda g: F.struct(F.concat(F.lit(" "), g).alias("name")))
    stats = F.struct(F.col("popularity.listeners").cast("string").alias("listeners"), F.col("popularity.playcount").cast("string").alias("playcount"))
    found = F.to_json(F.struct(F.struct(F.struct(tags.alias("tag")).alias("tags"), stats.alias("stats")).alias("artist")))
    body = F.when(k == 2, F.lit('{"error": 6, "message": "none"}')).when(k == 3, F.lit('{"error": 29}')).otherwise(found)
    df = table(spark, sf_dir, "artist_catalog").select("artist_id", F.when(k == 1, 503).otherwise(200).alias("status"), body.alias("body"))
    return records.tag_answers(df).select("artist_id", "ok", F.array_join("genres", ",").alias("genres"), F.col("popularity.listeners").alias("listeners"))


@query("R10_image", "SELECT artist_id, CASE WHEN artist_id % 2 = 0 THEN 'https://i.example/' || artist_id END AS image FROM artist_catalog WHERE coalesce(artist_name, '') <> ''")
def r10(spark, sf_dir):
    """An image only of a hit that is the name."""
    hit = F.when(F.col("artist_id") % 2 == 0, F.upper("artist_name")).otherwise(F.concat("artist_name", F.lit(" Jr")))
    c = table(spark, sf_dir, "artist_catalog").where("artist_name <> ''")
    return c.select("artist_id", records.exact_image("artist_name", hit, F.lit(""), F.concat(F.lit("https://i.example/"), F.col("artist_id").cast("string"))).alias("image"))


@query("R07_bindings", f"""WITH r AS (SELECT lower(trim(slug)) AS name, * EXCLUDE (slug) FROM {_LOOKUPS} WHERE trim(slug) <> '' AND item <> '')
 SELECT name, count(DISTINCT item) AS items, count(DISTINCT item) > 1 AS ambiguous, CASE WHEN count(DISTINCT item) = 1 THEN min_by(website, lookup_id) FILTER (WHERE website <> '') END AS website,
 CASE WHEN count(DISTINCT item) = 1 THEN 'https://t.me/' || regexp_replace(min_by(provider, lookup_id), '^@', '') END AS telegram, CASE WHEN count(DISTINCT item) = 1 THEN min_by(sitelinks, lookup_id) FILTER (WHERE sitelinks IS NOT NULL) END AS sitelinks,
 CASE WHEN count(DISTINCT item) = 1 THEN array_to_string(list_sort(list(DISTINCT provider)), ',') END AS aliases FROM r GROUP BY 1""")
def r07(spark, sf_dir):
    """R07 in full: one item a name, its first values, accounts as addresses, distinct aliases; several items are ambiguous."""
    df = _lookups(spark, sf_dir).withColumn("name", F.col("slug")).withColumn("telegram", F.concat(F.lit("@"), F.col("provider"))).withColumn("alias", F.col("provider"))
    b = records.bindings(df.select("name", "item", "website", "telegram", "mbid", "sitelinks", "alias", "lookup_id"), "lookup_id")
    return b.select("name", "items", "ambiguous", "website", "telegram", "sitelinks", F.array_join("aliases", ",").alias("aliases"))


@query("R08_merged", f"""WITH n AS (SELECT slug, min_by(nullif(website, ''), lookup_id) AS website, min_by(nullif(mbid, ''), lookup_id) AS mbid, min_by(provider, lookup_id) AS source FROM {_LOOKUPS} WHERE ok GROUP BY 1),
 j AS (SELECT c.slug, nullif(c.website, '') AS w, nullif(c.mbid, '') AS m, nullif(c.tier, '') AS t, n.* EXCLUDE (slug) FROM artist_catalog c LEFT JOIN n USING (slug))
 SELECT slug, coalesce(w, website) AS website, coalesce(m, mbid) AS mbid, CASE WHEN (w IS NULL AND website IS NOT NULL) OR (m IS NULL AND mbid IS NOT NULL) THEN CASE WHEN t IS NULL THEN source WHEN source IS NULL THEN t ELSE t || '+' || source END ELSE t END AS source FROM j""")
def r08(spark, sf_dir):
    """Empty fields filled from an answer, which is then named as a contributor."""
    first = lambda c: F.min_by(c, F.when(c.isNotNull(), F.col("lookup_id")))
    new = _lookups(spark, sf_dir).where("ok").groupBy("slug").agg(first(records.filled("website")).alias("website"), first(records.filled("mbid")).alias("mbid"), first(F.col("provider")).alias("source"))
    return records.merge_filled(table(spark, sf_dir, "artist_catalog").select("slug", "website", "mbid", F.col("tier").alias("source")), new, "slug", ["website", "mbid"], "source")


# ------------------------------------------------------------------ published records
_SLUG = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower({0})), '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g'), '[^\p{{L}}\p{{N}}\s\x{{a0}}-]', '', 'g'), '[\s\x{{a0}}_-]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query("R02_catalog", f"""WITH r AS (SELECT {_SLUG.format('artist_name')} AS slug, * EXCLUDE (slug) FROM artist_catalog WHERE artist_name <> ''),
 f AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY artist_id) AS rn FROM r)
 SELECT slug, artist_name AS name, nullif(website, '') AS website, nullif(mbid, '') AS mbid, nullif(socials.vk, '') AS vk, CASE WHEN len(genres) > 0 THEN array_to_string(genres, ',') END AS genres, CASE WHEN len(aliases) > 0 THEN array_to_string(aliases, ',') END AS aliases, popularity.listeners AS listeners FROM f WHERE rn = 1""")
def r02(spark, sf_dir):
    """The published catalogue: the first act of each slug, empty fields left out."""
    c = records.catalog_entries(table(spark, sf_dir, "artist_catalog").withColumn("name", F.col("artist_name")), "artist_id")
    return c.select("slug", "name", "website", "mbid", "socials.vk", F.array_join("genres", ",").alias("genres"), F.array_join("aliases", ",").alias("aliases"), "popularity.listeners")


@query("R03_changes", f"WITH {ORACLE} SELECT CAST(seq AS VARCHAR) AS concert_id, artist, date, venue, city, country, TIMESTAMP '1998-06-15' AS detected_at FROM raw_event")
def r03(spark, sf_dir):
    return records.change_entries(raw_events(spark, sf_dir), F.col("seq").cast("string"), F.lit("1998-06-15").cast("timestamp"))


@query("A08_status", """WITH v AS (SELECT DISTINCT * FROM venue_cache WHERE snap_no = (SELECT max(snap_no) FROM venue_cache)), m AS (SELECT max(scraped_at) AS now FROM v)
 SELECT count(*) AS total, count(*) FILTER (WHERE success) AS succeeded, count(*) FILTER (WHERE NOT coalesce(success, false)) AS failed, count(*) FILTER (WHERE success AND NOT coalesce(not_modified, false)) AS changed, count(*) FILTER (WHERE success AND not_modified) AS unchanged,
 coalesce(string_agg(DISTINCT CASE WHEN NOT coalesce(success, false) THEN config_id END, ',' ORDER BY CASE WHEN NOT coalesce(success, false) THEN config_id END), '') AS failed_ids,
 coalesce(string_agg(DISTINCT CASE WHEN scraped_at < now - INTERVAL 1 DAY THEN config_id END, ',' ORDER BY CASE WHEN scraped_at < now - INTERVAL 1 DAY THEN config_id END), '') AS stale_ids FROM v, m""")
def a08(spark, sf_dir):
    """The status of the last run: counts, failed and stale sources."""
    v = table(spark, sf_dir, "venue_cache")
    last = v.agg(F.max("snap_no").alias("n")).first()["n"]
    v = v.where(F.col("snap_no") == last).distinct()
    now = v.agg(F.max("scraped_at").alias("t")).first()["t"]
    return records.run_status(v, None, F.lit(now), stale_days=1)


@query("A16_progress", "SELECT count(*) AS total, count(*) FILTER (WHERE coalesce(website, '') <> '') AS with_website, count(*) FILTER (WHERE mbid IS NOT NULL) AS with_mbid, count(*) FILTER (WHERE len(aliases) > 0) AS with_aliases FROM artist_catalog")
def a16(spark, sf_dir):
    return records.progress(table(spark, sf_dir, "artist_catalog"), with_website=F.length("website") > 0, with_mbid=F.col("mbid").isNotNull(), with_aliases=F.size("aliases") > 0)


@query("K06_fail_log", "SELECT DISTINCT snap_no, config_id AS id, reason FROM venue_cache WHERE NOT coalesce(success, false)")
def k06(spark, sf_dir):
    v = table(spark, sf_dir, "venue_cache").select("snap_no", "config_id", "success", "reason").distinct()
    return v.join(records.fail_log(v).select(F.col("id").alias("config_id"), F.col("reason").alias("_r")).distinct(), "config_id", "left_semi").where("NOT coalesce(success, false)").select("snap_no", F.col("config_id").alias("id"), "reason")


@query("O03_name_list", "SELECT row_number() OVER (ORDER BY artist_name) - 1 AS pos, artist_name AS name FROM (SELECT DISTINCT artist_name FROM artist_catalog WHERE artist_name IS NOT NULL)")
def o03(spark, sf_dir):
    """Distinct names in order of their UTF-16 units, with their positions."""
    names = table(spark, sf_dir, "artist_catalog").where("artist_name IS NOT NULL").select(F.col("artist_name").alias("name")).distinct()
    return ranking.indexed(names, records.utf16("name")).select("pos", "name")


@query("O08_first_found", "SELECT artist_id FROM artist_catalog WHERE len(aliases) > 0 ORDER BY artist_id LIMIT 25")
def o08(spark, sf_dir):
    """The first 25 rows that fit, in the order of the scan."""
    return table(spark, sf_dir, "artist_catalog").where(F.size("aliases") > 0).select("artist_id").orderBy("artist_id").limit(25)


@query("S24_reason", """SELECT o_orderkey, CASE WHEN k = 0 THEN 'circuit_open' WHEN k = 1 THEN 'fetch_error' WHEN k = 2 THEN 'parse_error' WHEN k = 3 THEN NULL WHEN k = 4 AND o_custkey % 2 = 0 THEN 'empty_schedule' WHEN k = 5 THEN 'csr_detected' ELSE 'selectors_stale' END AS reason
 FROM (SELECT *, o_orderkey % 7 AS k FROM orders)""")
def s24(spark, sf_dir):
    """Why each source of a fetch log gave no rows."""
    k = F.pmod("o_orderkey", F.lit(7))
    log = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")).select(
        "o_orderkey", F.when(k == 0, "circuit_open").when(k <= 2, "broken").alias("error"), F.when(k == 5, '<div id="root"></div>').when(k > 1, "<p>No events</p>").alias("html"), F.when(k == 3, 4).otherwise(0).alias("n"), ((k == 4) & (F.col("o_custkey") % 2 == 0)).alias("allow"),
    )
    return log.select("o_orderkey", http.failure_reason("error", "html", "n", "allow").alias("reason"))


# ------------------------------------------------------------------ a whitelist of thousands of names
_CLEANED = "artist"
for _p in (r"\s+-\s*sold\s*out\b", r"\s*\(sold\s*out\)", r"\s+-\s*live\b.*", r"\s+live\s+in\s+.+$", r"\s+-\s*special\s*guest\b.*", r"\s+-\s*tour\b.*", r"\s*\(support\)", r"\s*\(live\)"):
    _CLEANED = f"regexp_replace({_CLEANED}, '{_p}', '', 'gi')"
_TRIMMED = r"regexp_replace({}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')"
_WORD = r"'[\p{L}\p{N}\p{M}_]'"
_JOINERS = "('of','the','and','&','vs','feat','feat.','featuring','ft','ft.','with','presents')"


@query("J05_catalog", rf"""WITH w AS (SELECT artist_name AS name, roster_id AS ord, NULL::VARCHAR[] AS aliases FROM artist_roster UNION ALL SELECT artist_name, artist_id + 1000000, aliases FROM artist_catalog),
 c AS (SELECT lower(name) AS found, max_by(name, ord) AS name, max(ord) AS ord FROM w WHERE name <> '' GROUP BY 1),
 a AS (SELECT lower(alias) AS found, max_by(name, ord) AS name, max(ord) AS ord FROM (SELECT name, ord, unnest(aliases) AS alias FROM w) WHERE alias <> '' GROUP BY 1 HAVING min(ord) = max(ord)),
 n AS (SELECT * FROM c UNION ALL SELECT * FROM a ANTI JOIN c USING (found)),
 t AS (SELECT DISTINCT {_TRIMMED.format(_CLEANED)} AS title FROM change_entry WHERE artist IS NOT NULL),
 e AS (SELECT title, name, 1 AS tier FROM t JOIN n ON lower(title) = found WHERE title <> ''),
 r AS (SELECT title, regexp_split_to_array(title, '[\s\x{{a0}}]-[\s\x{{a0}}]')[1] AS clause FROM t ANTI JOIN e USING (title) WHERE title <> '' AND NOT regexp_matches(title, '(?i)\b(cover|tribute)\b')),
 h AS (SELECT title, clause, name, ord, found, instr(lower(clause), found) AS pos FROM r, n WHERE length(found) > 3 AND length(found) >= 0.25 * length(clause) AND contains(lower(clause), found)),
 s AS (SELECT *, substr(clause, 1, pos - 1) AS b, substr(clause, pos + length(found)) AS z FROM h),
 k AS (SELECT title, min_by(name, (-length(found), ord)) AS name, 3 AS tier FROM s WHERE NOT (regexp_matches(right(b, 1), {_WORD}) AND regexp_matches(left(found, 1), {_WORD})) AND NOT (regexp_matches(left(z, 1), {_WORD}) AND regexp_matches(right(found, 1), {_WORD}))
  AND NOT regexp_matches(regexp_extract(b, '(\p{{L}}[\p{{L}}\p{{N}}\p{{M}}_'']*)[\s\x{{a0}}]$', 1), '^\p{{Lu}}') AND NOT regexp_matches(z, '^[\s\x{{a0}}]\p{{Lu}}')
  AND lower(regexp_extract(b, '([A-Za-z.&'']+)[\s\x{{a0}}]$', 1)) NOT IN {_JOINERS} AND lower(regexp_extract(z, '^[\s\x{{a0}}]([A-Za-z.&'']+)', 1)) NOT IN {_JOINERS} GROUP BY title),
 d AS (SELECT title, name, ord, length(p) AS size, levenshtein(q, p) AS d FROM (SELECT title, replace(strip_accents(lower({_TRIMMED.format('clause')})), chr(160), ' ') AS q FROM r ANTI JOIN k USING (title)), (SELECT *, replace(strip_accents(found), chr(160), ' ') AS p FROM n) WHERE abs(length(p) - length(q)) <= 2 AND length(q) > 1),
 m AS (SELECT title, min_by(name, (CASE WHEN size <= 7 THEN 0 ELSE 1 END, d, size, ord)) AS name, 4 AS tier FROM d WHERE size > 3 AND d <= CASE WHEN size <= 7 THEN 1 ELSE 2 END GROUP BY title)
 SELECT * FROM e UNION ALL SELECT * FROM k UNION ALL SELECT * FROM m""")
def j05_catalog(spark, sf_dir):
    """J01 to J05 on the domain's own names: typed acts against the roster and the catalogue with its aliases."""
    roster = table(spark, sf_dir, "artist_roster").select(F.col("artist_name").alias("name"), F.col("roster_id").alias("ord"), F.lit(None).cast("array<string>").alias("aliases"))
    acts = table(spark, sf_dir, "artist_catalog").select(F.col("artist_name").alias("name"), (F.col("artist_id") + 1_000_000).alias("ord"), "aliases")
    titles = spread(table(spark, sf_dir, "change_entry").select("artist")).select(text.clean_artist("artist").alias("title"))
    return match.match_titles(titles, roster.unionByName(acts)).select("title", "name", "tier")


# ------------------------------------------------------------------ runs, neighbours, hosts
@query("T04_run", """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id FROM events), n AS (SELECT max(day) AS last FROM d), k AS (SELECT user_id FROM d, n WHERE day < last AND day >= last - 1)
 SELECT user_id, CAST(day AS TIMESTAMP) AS detected_at FROM d, n WHERE day BETWEEN last - 3 AND last - 2 UNION ALL SELECT user_id, CAST(last AS TIMESTAMP) FROM d, n WHERE day = last AND user_id NOT IN (SELECT user_id FROM k)""")
def t04_run(spark, sf_dir):
    """The change log after the last day's run, which knows the day before; older entries are kept for three days."""
    d = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "user_id").distinct()
    last = d.agg(F.max("day")).first()[0]
    at = lambda n: F.lit(last - datetime.timedelta(days=n))
    prior = d.where(F.col("day") <= at(2)).select("user_id", F.col("day").cast("timestamp").alias("detected_at"))
    changes, _ = state.changelog(prior, d.where(F.col("day") == at(0)).select("user_id"), d.where(F.col("day") == at(1)), "user_id", at(0).cast("timestamp"), days=3)
    return changes


@query("T05_run", """WITH e AS (SELECT CAST(ts AS DATE) AS day, user_id FROM events WHERE event_type = 'error'), n AS (SELECT max(CAST(ts AS DATE)) AS last FROM events), h AS (SELECT user_id, count(*) AS f FROM e, n WHERE day < last GROUP BY 1)
 SELECT user_id, count(*) + coalesce(any_value(f), 0) AS failures, count(*) + coalesce(any_value(f), 0) >= 3 AS prune FROM e JOIN n ON day = last LEFT JOIN h USING (user_id) GROUP BY 1""")
def t05_run(spark, sf_dir):
    """The streaks after the last day's run."""
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    last = e.agg(F.max("day")).first()[0]
    bad = e.where("event_type = 'error'")
    health = bad.where(F.col("day") < F.lit(last)).groupBy("user_id").agg(F.count("*").alias("failures"))
    return state.streaks(health, bad.where(F.col("day") == F.lit(last)), "user_id", 3)


@query("J22_beside", """WITH l AS (SELECT c_custkey, c_nationkey AS page, c_acctbal AS at FROM customer), r AS (SELECT s_suppkey, s_nationkey AS page, s_acctbal AS at FROM supplier)
 SELECT c_custkey, min(s_suppkey) AS s_suppkey FROM l JOIN r ON l.page = r.page AND abs(l.at - r.at) < 60 GROUP BY 1""")
def j22(spark, sf_dir):
    """The first thing close by on the same page: suppliers beside customers of a nation by their balance."""
    left = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("page"), F.col("c_acctbal").alias("at"))
    right = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("page"), F.col("s_acctbal").alias("at"))
    return catalog.beside(left, right, "page", "at", 60, "s_suppkey").select("c_custkey", "match.s_suppkey")


@query("A14_suffixes", """WITH c AS (SELECT artist_id AS ord, artist_id % 3 AS k, regexp_replace(artist_name, '\\s+', ' ', 'g') AS n, mbid FROM artist_catalog WHERE artist_name IS NOT NULL),
 x AS (SELECT ord, CASE WHEN k = 0 THEN n || ' (band)' ELSE n END AS name, mbid FROM c UNION ALL SELECT ord + 0.5, n, NULL FROM c WHERE k = 0),
 g AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_replace(name, '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g')), '[\\s\\x{a0}]+', ' ', 'g'), '\\s*\\((band|singer|musician|group|rapper|dj|duo|artist)[^)]*\\)$', '') AS key FROM x)
 SELECT key, count(*) AS merged, max_by(mbid, ord) FILTER (WHERE mbid IS NOT NULL) AS mbid FROM g GROUP BY 1""")
def a14(spark, sf_dir):
    """Names that differ in a bracket only become one, with the last known mbid."""
    c = table(spark, sf_dir, "artist_catalog").where("artist_name IS NOT NULL").select(F.col("artist_id").cast("double").alias("ord"), F.pmod("artist_id", F.lit(3)).alias("k"), F.regexp_replace("artist_name", r"\s+", " ").alias("n"), "mbid")
    x = c.select("ord", F.when(F.col("k") == 0, F.concat("n", F.lit(" (band)"))).otherwise(F.col("n")).alias("name"), "mbid").unionByName(c.where("k = 0").select(F.col("ord") + 0.5, F.col("n"), F.lit(None).cast("string")).toDF("ord", "name", "mbid"))
    key = F.regexp_replace(text.norm_key("name"), r"\s*\((?:band|singer|musician|group|rapper|dj|duo|artist)[^)]*\)$", "")
    merged = catalog.merged_suffixes(x, "name", "ord", kept=("mbid",)).withColumn("key", key)
    sizes = x.groupBy(key.alias("key")).agg(F.count("*").alias("merged"))
    return merged.join(sizes, "key").select("key", "merged", "mbid")


HOSTS = [("localhost", True), ("x.localhost", True), ("127.0.0.1", True), ("10.0.0.8", True), ("172.20.1.1", True), ("172.32.1.1", False), ("192.168.1.1", True), ("169.254.169.254", True), ("8.8.8.8", False), ("[::1]", True), ("fe80::1", True), ("fd12::1", True), ("::ffff:10.0.0.1", True), ("0x7f000001", True), ("2130706433", True), ("a.example", False)]
PAGES = [("https://a.example/x", "https://b.example/", True), ("https://a.example/x", "https://b.example/x/", True), ("https://a.example/x", "https://b.example/y", False), ("https://a.example/x", "https://b.example/index.html", True), ("nothing", "https://b.example/y", True)]


@query("S28_private_hosts", "SELECT * FROM (VALUES " + ", ".join(f"('{h}', {str(b).lower()})" for h, b in HOSTS) + ") v(host, private)")
def s28(spark, sf_dir):
    return spark.createDataFrame([(h,) for h, _ in HOSTS], "host string").select("host", urls.private_host("host").alias("private"))


@query("F20_home_or_same", "SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', {str(c).lower()})" for a, b, c in PAGES) + ") v(a, b, same)")
def f20(spark, sf_dir):
    return spark.createDataFrame([p[:2] for p in PAGES], "a string, b string").select("a", "b", urls.home_or_same("a", "b").alias("same"))


@query("O04_catalogue_order", "SELECT row_number() OVER (ORDER BY popularity.listeners DESC NULLS LAST, artist_name, artist_id) - 1 AS pos, artist_id FROM artist_catalog WHERE artist_name IS NOT NULL")
def o04(spark, sf_dir):
    """The catalogue by score, greatest first, then by name."""
    c = table(spark, sf_dir, "artist_catalog").where("artist_name IS NOT NULL").select("artist_id", "artist_name", F.col("popularity.listeners").alias("n"))
    return ranking.indexed(c, F.desc_nulls_last("n"), F.col("artist_name"), F.col("artist_id")).select("pos", "artist_id")
