"""Queries on raw listings: text functions, dates, drop accounting, matching, de-duplication; each with its SQL."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from eventlake.functions import dates, text
from eventlake.operators import match, pipeline
from eventlake.sources.raw_event import BASE, ECHO, NAMES, ORACLE, raw_events, whitelist, with_echo


def day():
    """The day on which listings are read."""
    return F.lit(datetime.date.fromisoformat(BASE))


def _simple(name, column, sql):
    """A query that computes one column ``value`` of each raw listing."""
    QUERIES[name] = lambda spark, sf_dir: raw_events(spark, sf_dir).select("seq", column().alias("value"))
    SQL[name] = f"WITH {ORACLE} SELECT seq, {sql} AS value FROM raw_event"


QUERIES: dict = {}
SQL: dict = {}

_CLEAN = "artist"
for _p in (r"\s+-\s*sold\s*out\b", r"\s*\(sold\s*out\)", r"\s+-\s*live\b.*", r"\s+live\s+in\s+.+$", r"\s+-\s*special\s*guest\b.*", r"\s+-\s*tour\b.*", r"\s*\(support\)", r"\s*\(live\)"):
    _CLEAN = f"regexp_replace({_CLEAN}, '{_p}', '', 'gi')"
_CLEAN = f"trim({_CLEAN})"
_SLUG = lambda c: rf"regexp_replace(regexp_replace(regexp_replace(trim(lower({c})), '[^a-z0-9\s-]', '', 'g'), '[\s_-]+', '-', 'g'), '^-+|-+$', '', 'g')"
_COUNTRY = "CASE lower(country) WHEN 'germany' THEN 'DE' WHEN 'uk' THEN 'GB' WHEN 'the netherlands' THEN 'NL' WHEN 'united states' THEN 'US' ELSE upper(country) END"
_KIND = r"CASE WHEN regexp_matches(venue, '(?i)\bstadium\b') THEN 'stadium' WHEN regexp_matches(venue, '(?i)\b(arena|amphitheatre|amphitheater)\b') THEN 'arena' WHEN regexp_matches(venue, '(?i)\b(open\s*air|festival\s*ground|park|beach)\b') THEN 'open-air' WHEN regexp_matches(venue, '(?i)\b(theatre|theater|opera|philharmonic)\b') THEN 'theatre' WHEN regexp_matches(venue, '(?i)\b(club|bar|pub|lounge)\b') THEN 'club' WHEN regexp_matches(venue, '(?i)\b(hall|hangar|centre|center|saal)\b') THEN 'hall' END"

_simple("F01_slug", lambda: text.slug("artist"), _SLUG("artist"))
_simple("F03_clean_artist", lambda: text.clean_artist("artist"), _CLEAN)
_simple("F04_norm_key", lambda: text.norm_key("artist"), r"lower(regexp_replace(trim(artist), '\s+', ' ', 'g'))")
_simple("F05_word_key", lambda: text.word_key("artist"), r"trim(regexp_replace(lower(artist), '[^\p{L}\p{N}]+', ' ', 'g'))")
_simple("F06_country", lambda: text.country("country"), _COUNTRY)
_simple("F07_country_or_null", lambda: text.country_or_null("country"), "CASE lower(country) WHEN 'germany' THEN 'DE' WHEN 'uk' THEN 'GB' WHEN 'the netherlands' THEN 'NL' ELSE CASE WHEN length(country) = 2 THEN upper(country) END END")
_simple("F09_embedded_time", lambda: text.embedded_time("date"), "CASE WHEN date LIKE '%T20:30%' THEN '20:30' END")
_simple("F10_venue_kind", lambda: text.venue_kind("venue"), _KIND)
_simple("F12_place_key", lambda: text.place_key("venue", "city", "country"), "concat_ws('|', lower(trim(venue)), lower(trim(city)), lower(trim(country)))")
_simple("F13_concert_key", lambda: F.concat_ws("_", text.slug("artist"), F.date_format(dates.parse_date("date", day()), "yyyy-MM-dd"), text.slug("city")), f"concat_ws('_', {_SLUG('artist')}, strftime(({{DATE}}), '%Y-%m-%d'), {_SLUG('city')})")
_simple("F22_capitals", lambda: text.capitals("artist").cast("long"), "length(regexp_replace(artist, '[^A-Z]', '', 'g'))")
_simple("S13_spam_venue", lambda: pipeline.templated_venue("artist", F.concat("artist", F.lit(" in "), F.col("city"))), "artist <> '' AND city <> ''")

# The date ladder in SQL, for the shapes the raw listings have.
_M = {"jan": 1, "januar": 1, "feb": 2, "februar": 2, "mar": 3, "mrz": 3, "märz": 3, "apr": 4, "april": 4, "may": 5, "mai": 5, "jun": 6, "juni": 6, "jul": 7, "juli": 7, "aug": 8, "august": 8, "sep": 9, "september": 9, "oct": 10, "okt": 10, "oktober": 10, "nov": 11, "november": 11, "dec": 12, "dez": 12, "dezember": 12}
_M |= {"enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12}
_MONTH = lambda c: "CASE " + c + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _M.items()) + " END"
_MAKE = lambda y, m, d: f"try_cast(printf('%04d-%02d-%02d', ({y})::INT, ({m})::INT, ({d})::INT) AS DATE)"
_YEARLESS = lambda m, d: f"CASE WHEN {_MAKE('1998', m, d)} < DATE '1998-06-15' - 31 THEN {_MAKE('1999', m, d)} ELSE {_MAKE('1998', m, d)} END"
_S = "replace(replace(lower(trim(date)), ',', ''), '/', '.')"
_X = lambda p, g: f"regexp_extract({_S}, '{p}', {g})"
_ES, _DOTS, _DMY, _MDY, _DM = r"^(\d{1,2}) de ([a-z]+) de (\d{4})$", r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", r"^(\d{1,2})\.? ([a-zä]+) (\d{4})$", r"^([a-zä]+) (\d{1,2}) (\d{4})$", r"^(\d{1,2})\.? ([a-zä]+)$"
DATE = f"""CASE WHEN regexp_matches({_S}, '{_ES}') THEN {_MAKE(_X(_ES, 3), _MONTH(_X(_ES, 2)), _X(_ES, 1))}
 WHEN regexp_matches({_S}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_cast({_S} AS DATE)
 WHEN regexp_matches({_S}, '{_DOTS}') THEN CASE WHEN {_X(_DOTS, 2)}::INT > 12 AND {_X(_DOTS, 1)}::INT <= 12 THEN {_MAKE(_X(_DOTS, 3), _X(_DOTS, 1), _X(_DOTS, 2))} ELSE {_MAKE(_X(_DOTS, 3), _X(_DOTS, 2), _X(_DOTS, 1))} END
 WHEN regexp_matches({_S}, '{_DMY}') AND {_MONTH(_X(_DMY, 2))} IS NOT NULL THEN {_MAKE(_X(_DMY, 3), _MONTH(_X(_DMY, 2)), _X(_DMY, 1))}
 WHEN regexp_matches({_S}, '{_MDY}') AND {_MONTH(_X(_MDY, 1))} IS NOT NULL THEN {_MAKE(_X(_MDY, 3), _MONTH(_X(_MDY, 1)), _X(_MDY, 2))}
 WHEN regexp_matches({_S}, '{_DM}') AND {_MONTH(_X(_DM, 2))} IS NOT NULL THEN {_YEARLESS(_MONTH(_X(_DM, 2)), _X(_DM, 1))}
 WHEN regexp_matches(date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast(substr(date, 1, 10) AS DATE) END"""
SQL["F13_concert_key"] = SQL["F13_concert_key"].replace("{DATE}", DATE)
QUERIES["D_parse_date"] = lambda spark, sf_dir: dates.with_dates(raw_events(spark, sf_dir).select("seq", "date"), "date", day(), "value").select("seq", "value")
SQL["D_parse_date"] = f"WITH {ORACLE} SELECT seq, {DATE} AS value FROM raw_event"


def d_branches(spark, sf_dir):
    """How many listings each branch of the ladder decides."""
    return raw_events(spark, sf_dir).groupBy(F.coalesce(dates.date_branch("date", day()), F.lit("none")).alias("branch")).agg(F.count("*").alias("n"))


QUERIES["D_branches"] = d_branches
SQL["D_branches"] = f"""WITH {ORACLE} SELECT CASE seq % 9 WHEN 0 THEN 'iso' WHEN 1 THEN 'dots' WHEN 2 THEN 'dots' WHEN 3 THEN 'day month year' WHEN 4 THEN 'month day year'
 WHEN 5 THEN 'day de month de year' WHEN 6 THEN 'iso prefix' WHEN 7 THEN 'day month' ELSE 'none' END AS branch, count(*) AS n FROM raw_event GROUP BY 1"""


# ------------------------------------------------------------------ matching
_TITLE = f"titles AS (SELECT DISTINCT {_CLEAN} AS title FROM raw_event)"
_EXACT = "exact AS (SELECT title, max_by(name, ord) AS name FROM titles JOIN names ON lower(title) = lower(name) GROUP BY title)"
_REST = r"rest AS (SELECT title, regexp_split_to_array(title, '\s-\s')[1] AS clause FROM titles ANTI JOIN exact USING (title) WHERE NOT regexp_matches(title, '(?i)\b(cover|tribute)\b'))"
_JOINERS = "('of','the','and','&','vs','feat','feat.','featuring','ft','ft.','with','presents')"
_HOLDS = rf"""hits AS (SELECT title, clause, name, ord, instr(' ' || lower(clause) || ' ', ' ' || lower(name) || ' ') AS pos FROM rest, names
  WHERE length(name) > 3 AND length(name) >= 0.25 * length(clause)),
sides AS (SELECT *, substr(clause, 1, pos - 1) AS b, substr(clause, pos + length(name)) AS a FROM hits WHERE pos > 0),
contained AS (SELECT title, min_by(name, (-length(name), ord)) AS name FROM sides
  WHERE NOT regexp_matches(regexp_extract(b, '(\p{{L}}[\p{{L}}\p{{N}}\p{{M}}_'']*)\s$', 1), '^\p{{Lu}}') AND NOT regexp_matches(a, '^\s\p{{Lu}}')
  AND lower(regexp_extract(b, '([A-Za-z.&'']+)\s$', 1)) NOT IN {_JOINERS} AND lower(regexp_extract(a, '^\s([A-Za-z.&'']+)', 1)) NOT IN {_JOINERS} GROUP BY title)"""
_NEAR = """near AS (SELECT title, name, ord, length(name) AS n, levenshtein(lower(trim(clause)), lower(name)) AS d FROM rest ANTI JOIN contained USING (title), names),
misspelt AS (SELECT title, min_by(name, (CASE WHEN n <= 7 THEN 0 ELSE 1 END, d, n, ord)) AS name FROM near WHERE n > 3 AND d <= CASE WHEN n <= 7 THEN 1 ELSE 2 END GROUP BY title)"""
_ALL = f"{ORACLE}, {NAMES}, {_TITLE}, {_EXACT}, {_REST}, {_HOLDS}, {_NEAR}, matched AS (SELECT title, name, 1 AS tier FROM exact UNION ALL SELECT title, name, 3 FROM contained UNION ALL SELECT title, name, 4 FROM misspelt)"


def _titles(spark, sf_dir):
    return raw_events(spark, sf_dir).select(text.clean_artist("artist").alias("title")).distinct()


def j02_exact(spark, sf_dir):
    return match.exact(_titles(spark, sf_dir), match.searchable(whitelist(spark, sf_dir)))


def j05_match(spark, sf_dir):
    """Title, name and tier of all titles that resolve (J03 and J04 are its tiers 3 and 4)."""
    return match.match_titles(_titles(spark, sf_dir), whitelist(spark, sf_dir))


def j03_contained(spark, sf_dir):
    return j05_match(spark, sf_dir).where("tier = 3").drop("tier")


def j04_misspelt(spark, sf_dir):
    return j05_match(spark, sf_dir).where("tier = 4").drop("tier")


def j01_aliases(spark, sf_dir):
    """Names and unambiguous aliases: brands, in capitals, as aliases of their parts."""
    from eventlake.session import table

    part = table(spark, sf_dir, "part")
    listed = part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("ord"), F.array(F.upper(F.min("p_brand")), F.concat(F.lit("aka "), F.min("p_partkey").cast("string"))).alias("aliases"))
    return match.searchable(listed).select("found", "name")


for _n, _f, _s in (
    ("J02_exact", j02_exact, f"WITH {_ALL} SELECT title, name FROM exact"),
    ("J03_contained", j03_contained, f"WITH {_ALL} SELECT title, name FROM contained"),
    ("J04_misspelt", j04_misspelt, f"WITH {_ALL} SELECT title, name FROM misspelt"),
    ("J05_match", j05_match, f"WITH {_ALL} SELECT title, name, tier FROM matched"),
    ("J01_aliases", j01_aliases, """WITH l AS (SELECT p_name AS name, min(p_partkey) AS ord, upper(min(p_brand)) AS brand FROM part GROUP BY p_name),
 a AS (SELECT name, brand AS alias FROM l UNION ALL SELECT name, 'aka ' || ord FROM l)
 SELECT lower(name) AS found, name FROM l UNION ALL SELECT lower(alias), min(name) FROM a WHERE lower(alias) NOT IN (SELECT lower(name) FROM l) GROUP BY lower(alias) HAVING count(DISTINCT name) = 1"""),
):
    QUERIES[_n], SQL[_n] = _f, _s


# ------------------------------------------------------------------ the pipeline
_DONE = f"""{_ALL}, parsed AS (SELECT *, {_CLEAN} AS title, {DATE} AS day FROM raw_event),
judged AS (SELECT p.*, m.name AS matched, CASE WHEN ord % 2 = 0 THEN 'https://a.example/' || ord END AS website,
  CASE WHEN coalesce(artist, '') = '' OR coalesce(date, '') = '' OR coalesce(venue, '') = '' OR coalesce(city, '') = '' OR coalesce(country, '') = '' OR coalesce(original_source, '') = '' OR coalesce(scraped_at, '') = '' THEN 'incomplete'
   WHEN m.name IS NULL THEN 'not approved' WHEN day IS NULL THEN 'bad date' WHEN day < DATE '1998-06-15' THEN 'past date'
   WHEN length({_COUNTRY}) <> 2 THEN 'invalid' END AS drop_reason
  FROM parsed p LEFT JOIN matched m USING (title) LEFT JOIN names n ON n.name = m.name),
kept AS (SELECT seq, matched AS artist, day AS date, CASE WHEN date LIKE '%T20:30%' THEN '20:30' END AS start_time, trim(venue) AS venue, {_KIND} AS venue_kind, trim(city) AS city, {_COUNTRY} AS country, lat, lng, coalesce(website, ticket_url) AS ticket_url, original_source FROM judged WHERE drop_reason IS NULL)"""
_KEY = f"concat_ws('_', {_SLUG('artist')}, strftime(date, '%Y-%m-%d'), {_SLUG('city')})"


def _judged(spark, sf_dir):
    return pipeline.judge(raw_events(spark, sf_dir), whitelist(spark, sf_dir), day())


def p06_drops(spark, sf_dir):
    """Listings by the first reason to drop them."""
    return _judged(spark, sf_dir).groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def r01_concerts(spark, sf_dir):
    return pipeline.concerts(_judged(spark, sf_dir)).select("seq", "artist", "date", "start_time", "venue", "venue_kind", "city", "country", "lat", "lng", "ticket_url", "original_source")


def a01_dedup(spark, sf_dir):
    """One concert for each act, day and town: the first, unless it lacks a link and a later one has it."""
    return pipeline.best_of_key(r01_concerts(spark, sf_dir).withColumn("key", pipeline.concert_key())).select("key", "seq", "artist", "ticket_url")


def a01_echo(spark, sf_dir):
    """The same on raw listings with their echoes, keyed by cleaned name, date text and town."""
    raw = with_echo(raw_events(spark, sf_dir)).withColumn("key", F.concat_ws("_", text.slug(text.clean_artist("artist")), "date", text.slug("city")))
    return pipeline.best_of_key(raw).select("key", "seq", "ticket_url")


def upcoming_by_city(spark, sf_dir):
    """Upcoming concerts and acts by town, the flagship."""
    kept = pipeline.best_of_key(r01_concerts(spark, sf_dir).withColumn("key", pipeline.concert_key()))
    return kept.groupBy("city").agg(F.count("*").alias("concerts"), F.countDistinct("artist").alias("artists"))


_BEST = "min_by({0}, (CASE WHEN coalesce(ticket_url, '') = '' THEN 1 ELSE 0 END, seq))"
_DEDUP = f"SELECT {_KEY} AS key, {_BEST.format('seq')} AS seq, {_BEST.format('artist')} AS artist, nullif(min_by(coalesce(ticket_url, ''), (CASE WHEN coalesce(ticket_url, '') = '' THEN 1 ELSE 0 END, seq)), '') AS ticket_url FROM kept GROUP BY 1"
for _n, _f, _s in (
    ("P06_drops", p06_drops, f"WITH {_DONE} SELECT coalesce(drop_reason, 'kept') AS reason, count(*) AS n FROM judged GROUP BY 1"),
    ("R01_concerts", r01_concerts, f"WITH {_DONE} SELECT * FROM kept"),
    ("A01_dedup", a01_dedup, f"WITH {_DONE} {_DEDUP}"),
    ("A01_echo", a01_echo, f"""WITH {ORACLE}, {ECHO} SELECT concat_ws('_', {_SLUG(_CLEAN)}, date, {_SLUG('city')}) AS key, {_BEST.format('seq')} AS seq,
 nullif(min_by(coalesce(ticket_url, ''), (CASE WHEN coalesce(ticket_url, '') = '' THEN 1 ELSE 0 END, seq)), '') AS ticket_url FROM raw2 GROUP BY 1"""),
    ("upcoming_by_city", upcoming_by_city, f"WITH {_DONE}, best AS ({_DEDUP}), k AS (SELECT *, {_KEY} AS key FROM kept) SELECT city, count(*) AS concerts, count(DISTINCT k.artist) AS artists FROM best JOIN k USING (key, seq) GROUP BY city"),
):
    QUERIES[_n], SQL[_n] = _f, _s


def f14_content_hash(spark, sf_dir):
    """SHA-1 of each source's listings, in order of their text."""
    return pipeline.content_hashes(raw_events(spark, sf_dir), "original_source")


QUERIES["F14_content_hash"] = f14_content_hash
SQL["F14_content_hash"] = f"""WITH {ORACLE} SELECT original_source AS source, count(*) AS n, sha1(string_agg(k, chr(10) ORDER BY k)) AS content_hash
 FROM (SELECT original_source, concat_ws('|', artist, date, venue, city, coalesce(ticket_url, '')) AS k FROM raw_event) GROUP BY 1"""
