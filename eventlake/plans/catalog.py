"""Queries on the domain's own tables: towns, ranks, state between runs, catalogue folds; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.functions import text, urls
from eventlake.operators import catalog, places, ranking, state
from eventlake.operators.snapshot_diff import delivery_numbers, diff_deliveries
from eventlake.session import table
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


# ------------------------------------------------------------------ towns
_REPS = f"""{ORACLE}, reps AS (SELECT country, city, avg(lat) FILTER (WHERE lat IS NOT NULL AND lng IS NOT NULL) AS lat, avg(lng) FILTER (WHERE lat IS NOT NULL AND lng IS NOT NULL) AS lng, count(*) AS total,
 count(*) FILTER (WHERE lat IS NOT NULL AND lng IS NOT NULL) AS located FROM raw_event GROUP BY country, city)"""
_KM = "2 * 6371 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2))))"
_CLUSTERS = f"""edges AS (SELECT a.country, a.city AS x, b.city AS y FROM reps a JOIN reps b ON a.country = b.country AND a.city <> b.city WHERE a.lat IS NOT NULL AND b.lat IS NOT NULL AND {_KM} <= 35),
reach AS (SELECT country, city AS x, city AS y FROM reps UNION SELECT r.country, r.x, e.y FROM reach r JOIN edges e ON e.country = r.country AND e.x = r.y),
clusters AS (SELECT r.country, r.x AS city, min_by(r.y, (-p.total, -length(r.y), r.y)) AS canonical FROM reach r JOIN reps p ON p.country = r.country AND p.city = r.y GROUP BY r.country, r.x)"""


@query("F15_haversine", f"WITH {ORACLE} SELECT a.seq, round({_KM}, 6) AS km FROM raw_event a, (SELECT 52.52 AS lat, 13.405 AS lng) b")
def f15(spark, sf_dir):
    r = raw_events(spark, sf_dir)
    return r.select("seq", F.round(places.haversine(F.col("lat"), F.col("lng"), F.lit(52.52), F.lit(13.405)), 6).alias("km"))


@query("A03_representatives", f"WITH {_REPS} SELECT country, city, round(lat, 8) AS lat, round(lng, 8) AS lng, total, located FROM reps")
def a03(spark, sf_dir):
    return places.representatives(raw_events(spark, sf_dir)).withColumn("lat", F.round("lat", 8)).withColumn("lng", F.round("lng", 8))


@query("A04_clusters", f"WITH RECURSIVE {_REPS}, {_CLUSTERS} SELECT * FROM clusters")
def a04(spark, sf_dir):
    """Towns within 35 km of one another, transitively, and the name of their cluster."""
    return places.clusters(places.representatives(raw_events(spark, sf_dir)))


@query("A02_index", f"""WITH RECURSIVE {_REPS}, {_CLUSTERS} SELECT count(*) AS concerts, count(DISTINCT artist) AS artists, count(DISTINCT coalesce(canonical, city)) AS cities, CAST(ceil(count(*) / 500.0) AS BIGINT) AS pages
 FROM raw_event LEFT JOIN clusters USING (country, city)""")
def a02(spark, sf_dir):
    """Counts of the published index, towns by the names of their clusters."""
    c = places.canonical_cities(raw_events(spark, sf_dir))
    return c.agg(F.count("*").alias("concerts"), F.countDistinct("artist").alias("artists"), F.countDistinct("canonical").alias("cities"), F.ceil(F.count("*") / 500).alias("pages"))


@query("A07_counts", f"""WITH {ORACLE} SELECT CASE WHEN grouping(country) = 0 THEN 'country' ELSE 'source' END AS kind, coalesce(country, original_source) AS value, count(*) AS n, count(DISTINCT artist) AS artists
 FROM raw_event GROUP BY GROUPING SETS ((country), (original_source))""")
def a07(spark, sf_dir):
    """Concerts and acts by country and by source, from one scan."""
    return catalog.counted(raw_events(spark, sf_dir), {"country": "country", "source": "original_source"}, "artist").withColumnRenamed("names", "artists")


@query("R04_source_bucket", f"WITH {ORACLE} SELECT CASE original_source WHEN 'ticketmaster.com' THEN 'Ticketmaster' WHEN 'bandsintown.com' THEN 'Bandsintown' ELSE 'Direct' END AS bucket, count(*) AS n FROM raw_event GROUP BY 1")
def r04(spark, sf_dir):
    bucket = catalog.bucket("original_source", {"ticketmaster.com": "Ticketmaster", "bandsintown.com": "Bandsintown"})
    return raw_events(spark, sf_dir).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("O07_top_countries", f"WITH {ORACLE} SELECT country, count(*) AS n FROM raw_event GROUP BY 1 ORDER BY n DESC, country LIMIT 3")
def o07(spark, sf_dir):
    return raw_events(spark, sf_dir).groupBy("country").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country").limit(3)


@query("W07_pages", f"WITH {ORACLE} SELECT seq, CAST(floor((row_number() OVER (ORDER BY date, artist, city, seq) - 1) / 500) + 1 AS BIGINT) AS page FROM raw_event")
def w07(spark, sf_dir):
    """The page of each listing in the published order."""
    return ranking.pages(raw_events(spark, sf_dir), F.col("date"), F.col("artist"), F.col("city"), F.col("seq")).select("seq", "page")


@query("O02_lists", f"WITH {ORACLE} SELECT artist, string_agg(CAST(seq AS VARCHAR), ',' ORDER BY date, city, seq) AS seqs FROM raw_event GROUP BY 1")
def o02(spark, sf_dir):
    """Each act's listings by date."""
    r = raw_events(spark, sf_dir).groupBy("artist").agg(F.sort_array(F.collect_list(F.struct("date", "city", "seq"))).alias("l"))
    return r.select("artist", F.array_join(F.transform("l", lambda x: x["seq"].cast("string")), ",").alias("seqs"))


# ------------------------------------------------------------------ ranks
@query("W01_percent_rank", "SELECT p_partkey, round(percent_rank() OVER (ORDER BY p_size), 9) AS pr FROM part")
def w01(spark, sf_dir):
    return ranking.percent_rank(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size").select("p_partkey", F.round("pr", 9).alias("pr"))


_POP = """score AS (SELECT slug, 0.4 * ln(1 + coalesce(popularity.listeners, 0)) + 0.15 * ln(1 + coalesce(popularity.playcount, 0)) + 0.25 * percent_rank() OVER (ORDER BY sitelinks NULLS FIRST) + 0.05 * percent_rank() OVER (ORDER BY inbound NULLS FIRST)
 + 0.15 * CASE WHEN countries >= 2 THEN 1.0 WHEN countries = 1 THEN 0.67 ELSE 0 END AS score
 FROM (SELECT slug, popularity, (SELECT max(sitelinks) FROM artist_lookup l WHERE l.slug = c.slug) AS sitelinks, len(genres) AS inbound, length(coalesce(country, '')) // 2 + len(coalesce(genres, [])) // 3 AS countries FROM artist_catalog c))"""


def _scores(spark, sf_dir):
    links = table(spark, sf_dir, "artist_lookup").groupBy(F.col("slug").alias("_s")).agg(F.max("sitelinks").alias("sitelinks"))
    c = table(spark, sf_dir, "artist_catalog")
    c = c.join(links, F.col("slug") == F.col("_s"), "left")
    countries = F.floor(F.length(F.coalesce("country", F.lit(""))) / 2) + F.floor(F.size(F.coalesce("genres", F.array().cast("array<string>"))) / 3)
    return ranking.popularity(c.select("slug", "popularity.listeners", "popularity.playcount", "sitelinks", F.when(F.col("genres").isNotNull(), F.size("genres")).alias("inbound"), countries.alias("countries")))


@query("W02_popularity", f"WITH {_POP} SELECT slug, round(score, 6) AS score FROM score")
def w02(spark, sf_dir):
    """The composite score (J16's countries stand in as a count)."""
    return _scores(spark, sf_dir).select("slug", F.round("score", 6).alias("score"))


@query("W03_selected", f"WITH {_POP}, f AS (SELECT slug, score, score < 1 AS protected FROM score) SELECT slug FROM f WHERE protected OR score >= 5 ORDER BY protected DESC, score DESC, slug LIMIT 100")
def w03(spark, sf_dir):
    return ranking.selected(_scores(spark, sf_dir).withColumn("protected", F.col("score") < 1), 5.0, 100)


@query("W04_knee", """WITH r AS (SELECT row_number() OVER (ORDER BY c_acctbal DESC) - 1 AS pos, c_acctbal AS score, count(*) OVER () AS n, min(c_acctbal) OVER () AS a, max(c_acctbal) OVER () AS b FROM customer)
 SELECT pos, score FROM (SELECT pos, score, round(abs((score - a) / (b - a) - (1 - pos / (n - 1.0))), 9) AS gap FROM r) ORDER BY gap DESC, pos LIMIT 1""")
def w04(spark, sf_dir):
    return ranking.knee(table(spark, sf_dir, "customer"), "c_acctbal")


@query("A10_quantiles", "SELECT unnest([0.5, 0.75, 0.9, 0.95, 0.99]::DOUBLE[]) AS share, round(unnest(quantile_cont(c_acctbal, [0.5, 0.75, 0.9, 0.95, 0.99])), 6) AS value FROM customer")
def a10(spark, sf_dir):
    return ranking.quantiles(table(spark, sf_dir, "customer"), "c_acctbal", [0.5, 0.75, 0.9, 0.95, 0.99]).withColumn("value", F.round("value", 6))


@query("A11_histogram", """WITH s AS (SELECT min(c_acctbal) AS a, (max(c_acctbal) - min(c_acctbal)) / 12 AS w FROM customer)
 SELECT i::INT AS bucket, round(a + i * w, 6) AS lo, round(a + (i + 1) * w, 6) AS hi, (SELECT count(*) FROM customer WHERE least(11, floor((c_acctbal - a) / w)) = i) AS n FROM s, range(12) t(i)""")
def a11(spark, sf_dir):
    return ranking.histogram(table(spark, sf_dir, "customer"), "c_acctbal").withColumn("lo", F.round("lo", 6)).withColumn("hi", F.round("hi", 6))


@query("O05_ranked", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS listeners FROM customer ORDER BY listeners DESC NULLS LAST, c_custkey LIMIT 40")
def o05(spark, sf_dir):
    """Greatest first, unknown last, ties by name; the first 40."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("listeners"))
    return c.orderBy(F.desc_nulls_last("listeners"), "c_custkey").limit(40)


# ------------------------------------------------------------------ catalogue
@query("A05_in_degree", "WITH e AS (SELECT (7 * p_partkey + j) % (SELECT count(*) FROM part) AS t FROM part, range(1, 4) r(j)) SELECT p_partkey, (SELECT count(*) FROM e WHERE t = p_partkey) AS inbound FROM part")
def a05(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey")
    n = part.count()
    edges = part.select(F.explode(F.array(*[F.pmod(7 * F.col("p_partkey") + j, F.lit(n)) for j in (1, 2, 3)])).alias("target"))
    return catalog.in_degree(part, "p_partkey", edges, "target").withColumnRenamed("n", "inbound")


@query("J12_similar", """WITH p AS (SELECT p_partkey AS k, p_name AS name FROM part), e AS (SELECT k, j, (7 * k + j) % 2500 AS t FROM p, range(1, 12) r(j))
 SELECT k AS p_partkey, string_agg(CAST(t AS VARCHAR), ',' ORDER BY j) AS similar FROM (SELECT e.*, row_number() OVER (PARTITION BY e.k ORDER BY j) AS rn FROM e JOIN p ON p.k = e.t WHERE e.t <> e.k) WHERE rn <= 8 GROUP BY 1""")
def j12(spark, sf_dir):
    """Named neighbours that exist, themselves excluded, in their order, at most eight."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    said = part.select("k", F.array(*[F.pmod(7 * F.col("k") + j, F.lit(2500)) for j in range(1, 12)]).alias("names"))
    return catalog.resolved_neighbours(said, "k", "names", part, "k", 8).select(F.col("k").alias("p_partkey"), F.array_join(F.transform("found", lambda x: x.cast("string")), ",").alias("similar"))


@query("A06_gaps", f"""WITH {ORACLE} SELECT artist, count(*) AS n, string_agg(DISTINCT original_source, ',' ORDER BY original_source) AS sources, length(artist) <= 40 AS plausible FROM raw_event ANTI JOIN (SELECT DISTINCT p_name AS artist FROM part) USING (artist) WHERE artist IS NOT NULL GROUP BY 1""")
def a06(spark, sf_dir):
    from eventlake.sources.raw_event import whitelist

    return catalog.gaps(raw_events(spark, sf_dir), whitelist(spark, sf_dir).select(F.col("name").alias("artist")))


@query("O06_gap_ranking", f"""WITH {ORACLE} SELECT artist, count(*) AS n, count(DISTINCT original_source) AS n_sources FROM raw_event WHERE length(artist) <= 40 GROUP BY 1 HAVING count(DISTINCT original_source) > 1 ORDER BY n_sources DESC, n DESC, artist LIMIT 30""")
def o06(spark, sf_dir):
    g = raw_events(spark, sf_dir).where(F.length("artist") <= 40).groupBy("artist").agg(F.count("*").alias("n"), F.countDistinct("original_source").alias("n_sources"))
    return g.where("n_sources > 1").orderBy(F.desc("n_sources"), F.desc("n"), "artist").limit(30)


@query("A12_first_of_slug", "SELECT lower(p_brand) AS slug, min_by(p_name, p_partkey) AS name FROM part GROUP BY 1")
def a12(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.lower("p_brand").alias("slug"), F.col("p_name").alias("name"), F.col("p_partkey").alias("ord"))
    return catalog.first_of(p, "slug", "ord").select("slug", "name")


@query("A13_case_variants", f"""WITH {ORACLE} SELECT lower(trim(artist)) AS key, arg_max(artist, (length(regexp_replace(artist, '[^A-Z]', '', 'g')), -seq)) AS name FROM raw_event GROUP BY 1""")
def a13(spark, sf_dir):
    r = raw_events(spark, sf_dir).select(F.col("artist").alias("name"), F.col("seq").alias("ord"))
    return catalog.case_variants(r, "name", "ord").select("key", "name")


@query("A15_alias_union", r"""WITH k AS (SELECT artist_id, lower(trim(regexp_replace(artist_name, '\s+', ' ', 'g'))) AS own, unnest(list_concat(coalesce(aliases, []), [upper(artist_name), slug])) AS alias, generate_subscripts(list_concat(coalesce(aliases, []), [upper(artist_name), slug]), 1) AS i FROM artist_catalog),
 n AS (SELECT artist_id, own, alias, i, lower(trim(regexp_replace(alias, '\s+', ' ', 'g'))) AS key FROM k WHERE alias IS NOT NULL)
 SELECT artist_id, string_agg(alias, ';' ORDER BY i) AS aliases FROM (SELECT *, row_number() OVER (PARTITION BY artist_id, key ORDER BY i) AS rn FROM n WHERE key <> own AND key <> '') WHERE rn = 1 GROUP BY 1""")
def a15(spark, sf_dir):
    """Aliases joined by more of them; equal spellings keep the first, the name itself is none."""
    c = table(spark, sf_dir, "artist_catalog")
    both = F.concat(F.coalesce("aliases", F.array().cast("array<string>")), F.array(F.upper("artist_name"), "slug"))
    out = c.select("artist_id", catalog.union_aliases(F.col("artist_name"), both).alias("a")).where(F.size("a") > 0)
    return out.select("artist_id", F.array_join("a", ";").alias("aliases"))


@query("R07_fold", "SELECT slug AS name, count(DISTINCT item) AS items, count(DISTINCT item) > 1 AS ambiguous, min_by(website, lookup_id) FILTER (WHERE coalesce(website, '') <> '') AS website FROM artist_lookup GROUP BY 1")
def r07(spark, sf_dir):
    """One answer a name, ambiguous if it names several things."""
    return catalog.fold_bindings(table(spark, sf_dir, "artist_lookup").distinct(), "slug", "item", "website", "lookup_id").withColumnRenamed("slug", "name")


@query("F17_network", "SELECT lookup_id, CASE WHEN h LIKE '%instagram.%' THEN 'instagram' WHEN h LIKE '%facebook.%' THEN 'facebook' WHEN h LIKE '%spotify.%' THEN 'spotify' WHEN h LIKE '%youtube.%' THEN 'youtube' WHEN h LIKE '%t.me%' THEN 'telegram' WHEN h LIKE '%vk.%' THEN 'vk' ELSE 'website' END AS network FROM (SELECT DISTINCT lookup_id, lower(regexp_extract(website, '(?i)^https?://([^/?#]+)', 1)) AS h FROM artist_lookup WHERE regexp_matches(website, '(?i)^https?://[^/?#]+'))")
def f17(spark, sf_dir):
    r = table(spark, sf_dir, "artist_lookup").where(F.col("website").rlike("(?i)^https?://[^/?#]+")).select("lookup_id", "website").distinct()
    return r.select("lookup_id", urls.network("website").alias("network"))


@query("F19_same_site", r"""WITH w AS (SELECT DISTINCT a.lookup_id, lower(regexp_extract(a.website, '(?i)^https?://(?:www\.)?([a-z0-9.-]+)', 1)) AS x, lower(regexp_extract(b.website, '(?i)^https?://(?:www\.)?([a-z0-9.-]+)', 1)) AS y
 FROM artist_lookup a JOIN (SELECT slug, max(website) AS website FROM artist_lookup WHERE regexp_matches(website, '(?i)^https?://[a-z0-9]') GROUP BY 1) b USING (slug) WHERE regexp_matches(a.website, '(?i)^https?://[a-z0-9]'))
 SELECT lookup_id, x = y OR y LIKE '%.' || x OR x LIKE '%.' || y OR list_slice(string_split(x, '.'), -2, -1) = list_slice(string_split(y, '.'), -2, -1) AS same FROM w""")
def f19(spark, sf_dir):
    r = table(spark, sf_dir, "artist_lookup").where(F.col("website").rlike("(?i)^https?://[a-z0-9]"))
    top = r.groupBy(F.col("slug").alias("_s")).agg(F.max("website").alias("_w"))
    return r.join(top, F.col("slug") == F.col("_s")).select("lookup_id", urls.same_site("website", "_w").alias("same")).distinct()


_COUNT = lambda p: f"len(regexp_extract_all(t, '(?i)\\b(?:{p})\\b'))"
_PLAIN = r"regexp_replace(regexp_replace(regexp_replace(text, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '<[^>]+>', ' ', 'g')"
_SCORE = "2 * " + _COUNT("2026|2027|2028") + " + 2 * " + _COUNT(r"\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4}") + " + " + " + ".join((_COUNT("|".join(urls.MONTH_NAMES.split())), "0.5 * " + _COUNT("|".join(urls.DAY_NAMES.split())), "least(5, " + _COUNT("|".join(urls.KEYWORDS.split())) + ")"))


@query("F21_page_score", f"SELECT doc_id, CAST({_SCORE} + CASE WHEN regexp_matches(text, '(?i)widget\\.bandsintown\\.com|songkick\\.com/widget|ticketmaster\\.com/.*widget') THEN 8 ELSE 0 END AS DOUBLE) AS score FROM (SELECT doc_id, text, {_PLAIN} AS t FROM documents)")
def f21(spark, sf_dir):
    """How much a text looks like a list of dates."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", urls.page_score("text").alias("score"))


@query("F24_stripped", r"SELECT doc_id, length(regexp_replace(regexp_replace(text, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g')) AS n FROM documents")
def f24(spark, sf_dir):
    from eventlake.sources.html import without_scripts

    return table(spark, sf_dir, "documents").select("doc_id", F.length(without_scripts("text")).cast("long").alias("n"))


@query("F27_redacted", r"SELECT lookup_id, regexp_replace(website, '([?&](?:lang|key|token|api_key)=)[^&#]*', '\1***', 'g') AS website FROM (SELECT DISTINCT lookup_id, website FROM artist_lookup)")
def f27(spark, sf_dir):
    return table(spark, sf_dir, "artist_lookup").select("lookup_id", "website").distinct().select("lookup_id", urls.redacted("website", ("lang", "key", "token", "api_key")).alias("website"))


# ------------------------------------------------------------------ state between runs
_DAYS = "d AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id, event_type FROM events)"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))


@query("T04_changelog", f"""WITH {_DAYS}, days AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev FROM (SELECT DISTINCT day FROM d))
 SELECT concat(user_id, '|', event_type) AS key, d.day FROM d JOIN days USING (day) ANTI JOIN d p ON p.day = days.prev AND p.user_id = d.user_id AND p.event_type = d.event_type WHERE days.prev IS NOT NULL AND day >= (SELECT max(day) FROM d) - 30""")
def t04(spark, sf_dir):
    """Keys new against the run before, of the last 30 days; the first run reports nothing."""
    e = _events(spark, sf_dir).select(F.concat_ws("|", "user_id", "event_type").alias("key"), F.unix_date("day").alias("run"))
    numbers = delivery_numbers(e.select("run"))
    added = diff_deliveries(e, "key", "run", numbers).where("change_kind = 'added'")
    return added.where(F.col("snap_no") >= max(numbers, default=0) - 30).select(F.col("record_key").alias("key"), F.date_from_unix_date("snap_no").alias("day"))


@query("T05_streaks", f"""WITH {_DAYS}, days AS (SELECT DISTINCT day FROM d), e AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL),
 gap AS (SELECT u.user_id, max(days.day) AS last_gap FROM (SELECT DISTINCT user_id FROM e) u CROSS JOIN days ANTI JOIN e ON e.user_id = u.user_id AND e.day = days.day GROUP BY 1)
 SELECT user_id, CAST(sum(n) AS BIGINT) AS failures, sum(n) >= 5 AS prune FROM e LEFT JOIN gap USING (user_id) WHERE last_gap IS NULL OR day > last_gap GROUP BY 1""")
def t05(spark, sf_dir):
    """T05 over daily runs: failures since the last run without one."""
    e = _events(spark, sf_dir)
    days = e.select("day").distinct()
    bad = e.where("event_type = 'error'").groupBy("user_id", "day").agg(F.count("*").alias("n"))
    # Runs are few; a key's are at most as many, so its set of them is small.
    numbers = delivery_numbers(days.select(F.unix_date("day").alias("n")))
    placed = bad.withColumn("at", F.array_position(F.array(*[F.lit(n) for n in numbers]), F.unix_date("day")).cast("int"))
    last_gap = F.expr(f"coalesce(array_max(filter(sequence(1, {len(numbers)}), x -> not array_contains(ats, x))), 0)")
    gaps = placed.groupBy("user_id").agg(F.collect_set("at").alias("ats")).select("user_id", last_gap.alias("gap"))
    return placed.join(gaps, "user_id").where(F.col("at") > F.col("gap")).groupBy("user_id").agg(F.sum("n").alias("failures"), (F.sum("n") >= 5).alias("prune"))


@query("W06_current_streak", "SELECT e.user_id, count(*) AS streak FROM events e LEFT JOIN (SELECT user_id, max(ts) AS ok FROM events WHERE event_type <> 'error' GROUP BY 1) o ON o.user_id = e.user_id WHERE event_type = 'error' AND (ok IS NULL OR ts > ok) GROUP BY 1")
def w06(spark, sf_dir):
    """Failures in a row at the end of each log."""
    return state.current_streak(table(spark, sf_dir, "events"), "user_id", F.col("event_type") == "error", "ts")


_STATE = "SELECT concert_id, artist, start_time, venue FROM (SELECT *, row_number() OVER (PARTITION BY concert_id ORDER BY scraped_at DESC, loaded_at DESC) AS rn FROM concert_snapshot WHERE snap_no = (SELECT no FROM nos WHERE back = {})) WHERE rn = 1"
_THREE = f"nos AS (SELECT snap_no AS no, row_number() OVER (ORDER BY snap_no DESC) AS back FROM (SELECT DISTINCT snap_no FROM concert_snapshot)), b AS ({_STATE.format(3)}), a AS ({_STATE.format(2)}), c AS ({_STATE.format(1)})"


def _three(spark, sf_dir):
    """The last three deliveries of the concerts as the states before and after a change, and the current one."""
    s = table(spark, sf_dir, "concert_snapshot")
    last = lambda n: s.where(F.col("snap_no") == n).groupBy("concert_id").agg(F.max_by(F.struct("artist", "start_time", "venue"), F.struct("scraped_at", "loaded_at")).alias("r")).select("concert_id", "r.*")
    return tuple(map(last, delivery_numbers(s.select("snap_no"))[-3:]))


_ROW = lambda t: f"to_json([{t}.artist, {t}.start_time, {t}.venue])"


@query("T06_three_way", f"""WITH {_THREE}, j AS (SELECT coalesce(a.concert_id, b.concert_id, c.concert_id) AS concert_id, CASE WHEN a.concert_id IS NOT NULL THEN {_ROW('a')} END AS a, CASE WHEN b.concert_id IS NOT NULL THEN {_ROW('b')} END AS b, CASE WHEN c.concert_id IS NOT NULL THEN {_ROW('c')} END AS c
 FROM a FULL JOIN b USING (concert_id) FULL JOIN c ON c.concert_id = coalesce(a.concert_id, b.concert_id))
 SELECT concert_id, CASE WHEN a IS NOT NULL THEN CASE WHEN c IS NULL OR c IS NOT DISTINCT FROM b OR c = a THEN 'upsert' ELSE 'conflict' END ELSE CASE WHEN c = b THEN 'delete' ELSE 'conflict' END END AS action
 FROM j WHERE (a IS NOT NULL AND a IS DISTINCT FROM b) OR (a IS NULL AND b IS NOT NULL AND c IS NOT NULL)""")
def t06(spark, sf_dir):
    """J18 and T06."""
    return state.three_way(*_three(spark, sf_dir), "concert_id").select("concert_id", "action")


@query("J19_append", f"WITH {_THREE} SELECT * FROM c UNION ALL (SELECT * FROM a EXCEPT SELECT * FROM b EXCEPT SELECT * FROM c)")
def j19(spark, sf_dir):
    return state.append_new(*_three(spark, sf_dir))


@query("T02_upsert", """WITH f AS (SELECT user_id, max(ts) AS at, sum(value) AS v, bool_or(event_type = 'purchase') AS ok FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20' GROUP BY 1), o AS (SELECT user_id, max(ts) AS at, sum(value) AS v FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-20' GROUP BY 1)
 SELECT coalesce(f.user_id, o.user_id) AS user_id, CASE WHEN f.user_id IS NULL THEN o.at ELSE f.at END AS at, round(CASE WHEN f.user_id IS NULL THEN o.v ELSE f.v END, 4) AS v FROM (SELECT * FROM f WHERE ok) f FULL JOIN o ON o.user_id = f.user_id""")
def t02(spark, sf_dir):
    e = _events(spark, sf_dir)
    sums = lambda df: df.groupBy("user_id").agg(F.max("ts").alias("at"), F.sum("value").alias("v"), F.max(F.col("event_type") == "purchase").alias("ok"))
    return state.upsert(sums(e.where("day < '2024-01-20'")).drop("ok"), sums(e.where("day >= '2024-01-20'")), "user_id").withColumn("v", F.round("v", 4))


@query("J21_fallback", "SELECT user_id, count(*) AS n FROM (SELECT user_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20' UNION ALL SELECT user_id FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-20' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'error')) GROUP BY 1")
def j21(spark, sf_dir):
    e = _events(spark, sf_dir)
    return state.with_fallback(e.where("day >= '2024-01-20'"), e.where("event_type = 'error'"), e.where("day < '2024-01-20'"), "user_id").groupBy("user_id").agg(F.count("*").alias("n"))


@query("T03_stalest", """WITH f AS (SELECT user_id AS c_custkey, max(ts) AS fetched FROM events WHERE event_type = 'view' GROUP BY 1) SELECT c_custkey, fetched FROM customer LEFT JOIN f USING (c_custkey) WHERE (fetched IS NULL OR fetched < TIMESTAMP '2024-01-31' - INTERVAL 2 DAY) ORDER BY fetched NULLS FIRST, c_custkey LIMIT 200""")
def t03(spark, sf_dir):
    """What to refresh next; customers stand for the sweep's targets."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("ord"))
    f = table(spark, sf_dir, "events").where("event_type = 'view'").select(F.col("user_id").alias("c_custkey"), F.col("ts").alias("fetched"))
    return state.stalest(c, f, "c_custkey", "fetched", F.lit("2024-01-31").cast("timestamp"), 2, 200).select("c_custkey", "fetched")


@query("T08_lookup_queue", f"""WITH {ORACLE} SELECT key FROM (SELECT lower(venue) || '|' || lower(city) AS key, min(seq) AS ord FROM raw_event GROUP BY 1) WHERE key NOT IN (SELECT lower(venue) || '|' || lower(city) FROM raw_event WHERE lat > 20) ORDER BY ord LIMIT 400""")
def t08(spark, sf_dir):
    """Places to look up, by first appearance, at most 400 a run."""
    r = raw_events(spark, sf_dir).select(F.concat_ws("|", F.lower("venue"), F.lower("city")).alias("key"), F.col("seq").alias("ord"), "lat")
    return state.lookup_queue(r, r.where("lat > 20"), "key", 400).select("key")


@query("T09_retained", "SELECT count(*) AS n, count(*) > 3 AS alert FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY")
def t09(spark, sf_dir):
    """Failures of the last days, and whether they are too many."""
    log = state.retained(table(spark, sf_dir, "events").where("event_type = 'error'"), "ts", F.lit("2024-01-31").cast("timestamp"), 7)
    return log.agg(F.count("*").alias("n"), (F.count("*") > 3).alias("alert"))


@query("T01_changed", "WITH h AS (SELECT config_id, snap_no, max(content_hash) AS h FROM venue_cache GROUP BY ALL) SELECT n.config_id, o.h IS DISTINCT FROM n.h AS changed FROM h n LEFT JOIN h o ON o.config_id = n.config_id AND o.snap_no = (SELECT max(snap_no) FROM h WHERE snap_no < (SELECT max(snap_no) FROM h)) WHERE n.snap_no = (SELECT max(snap_no) FROM h)")
def t01(spark, sf_dir):
    """The last delivery against the one before."""
    v = table(spark, sf_dir, "venue_cache").groupBy("config_id", "snap_no").agg(F.max("content_hash").alias("content_hash"))
    before, last = delivery_numbers(v.select("snap_no"))[-2:]
    return state.unchanged(v.where(F.col("snap_no") == before), v.where(F.col("snap_no") == last), "config_id")


@query("A08_health", "SELECT snap_no, count(*) FILTER (WHERE success) AS ok, count(*) FILTER (WHERE NOT success) AS failed, count(*) FILTER (WHERE not_modified) AS unchanged, string_agg(CASE WHEN NOT success THEN config_id END, ',' ORDER BY config_id) AS failed_ids FROM (SELECT DISTINCT snap_no, config_id, success, not_modified FROM venue_cache) GROUP BY 1")
def a08(spark, sf_dir):
    """Health of each run: counts and the sources that failed."""
    v = table(spark, sf_dir, "venue_cache").select("snap_no", "config_id", "success", "not_modified").distinct()
    failed = F.array_join(F.sort_array(F.collect_list(F.when(~F.col("success"), F.col("config_id")))), ",")
    return v.groupBy("snap_no").agg(F.count_if("success").alias("ok"), F.count_if(~F.col("success")).alias("failed"), F.count_if("not_modified").alias("unchanged"), F.nullif(failed, F.lit("")).alias("failed_ids"))


# ------------------------------------------------------------------ sets
@query("P08_denied", "SELECT DISTINCT lower(p_name) AS term FROM part WHERE lower(p_name) IN (SELECT lower(p_name) FROM part WHERE p_size > 40) AND lower(p_name) NOT IN (SELECT lower(p_name) FROM part WHERE p_size < 2)")
def p08(spark, sf_dir):
    """Names on the deny list that are no targets."""
    p = table(spark, sf_dir, "part").select(F.lower("p_name").alias("term"), "p_size")
    return catalog.denied(p, p.where("p_size > 40"), p.where("p_size < 2"), "term")


@query("J14_candidates", "SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AND s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49 AND l_linenumber = 6)")
def j14(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    wanted = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("s_nationkey"))
    covered = table(spark, sf_dir, "lineitem").where("l_quantity > 49 AND l_linenumber = 6").select(F.col("l_suppkey").alias("s_suppkey"))
    return catalog.wanted_without(s, s.join(wanted, "s_nationkey", "left_semi"), covered, "s_suppkey").select("s_suppkey")


@query("J15_missing", "SELECT n_name AS name FROM nation UNION ALL (SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN (SELECT n_name FROM nation))")
def j15(spark, sf_dir):
    have = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    return catalog.with_missing(have, table(spark, sf_dir, "part").select(F.col("p_brand").alias("name")), "name")


@query("J16_touring", f"WITH {ORACLE} SELECT artist, count(DISTINCT upper(country)) AS countries FROM raw_event GROUP BY 1")
def j16(spark, sf_dir):
    return catalog.touring(raw_events(spark, sf_dir))


@query("J17_unique_owner", "SELECT artist_id FROM artist_catalog WHERE lower(artist_name) IN (SELECT lower(artist_name) FROM artist_catalog GROUP BY 1 HAVING count(*) = 1)")
def j17(spark, sf_dir):
    c = table(spark, sf_dir, "artist_catalog").select("artist_id", F.lower("artist_name").alias("k")).where(F.col("k").isNotNull())
    return state.unique_owner(c, "k").select("artist_id")


@query("J20_bulk_apply", """WITH r AS (SELECT slug, max(mbid) AS mbid, count(DISTINCT item) AS items FROM artist_lookup WHERE ok GROUP BY 1)
 SELECT artist_id, CASE WHEN coalesce(c.mbid, '') <> '' THEN c.mbid WHEN items <= 1 THEN nullif(r.mbid, '') END AS mbid FROM artist_catalog c LEFT JOIN r USING (slug)""")
def j20(spark, sf_dir):
    """An answer fills what is missing unless it is ambiguous."""
    r = table(spark, sf_dir, "artist_lookup").where("ok").groupBy(F.col("slug").alias("_s")).agg(F.max("mbid").alias("_m"), F.countDistinct("item").alias("_n"))
    c = table(spark, sf_dir, "artist_catalog").join(r, F.col("slug") == F.col("_s"), "left")
    return c.select("artist_id", F.coalesce(F.nullif("mbid", F.lit("")), F.when(F.col("_n") <= 1, F.nullif("_m", F.lit("")))).alias("mbid"))


@query("J07_last_seen", f"WITH {ORACLE} SELECT p_partkey, lower(p_name) IN (SELECT lower(trim(artist)) FROM raw_event) AS seen FROM part")
def j07(spark, sf_dir):
    """Entries stamped if a listing names them; all entries of a name are."""
    return catalog.seen(table(spark, sf_dir, "part"), "p_name", raw_events(spark, sf_dir), "artist").select("p_partkey", "seen")


@query("O09_union", "SELECT 1 AS source_rank, c_custkey AS id FROM customer UNION ALL SELECT 2, s_suppkey FROM supplier UNION ALL SELECT 3, p_partkey FROM part")
def o09(spark, sf_dir):
    parts = [table(spark, sf_dir, t).select(F.lit(i).alias("source_rank"), F.col(c).alias("id")) for i, (t, c) in enumerate((("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey")), 1)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("O10_targets", "SELECT lower(name) AS key, min_by(name, (r, name)) AS name FROM (SELECT DISTINCT upper(p_name) AS name, 1 AS r FROM part WHERE p_size < 5 UNION ALL SELECT DISTINCT p_name, 2 FROM part) GROUP BY 1")
def o10(spark, sf_dir):
    """Distinct targets of several lists, the first list's spelling."""
    p = table(spark, sf_dir, "part")
    return catalog.first_spelling([p.where("p_size < 5").select(F.upper("p_name").alias("name")), p.select(F.col("p_name").alias("name"))], "name")


@query("O11_except", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 250000")
def o11(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey").subtract(table(spark, sf_dir, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey")))


@query("O12_intersect", "SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders")
def o12(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey").intersect(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")))
