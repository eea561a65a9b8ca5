"""Queries on the core's training-data operators, with the SQL they are checked against."""

from __future__ import annotations

from eventlake.operators.snapshot_diff import all_changes
from eventlake.operators.spatial import nearby
from eventlake.operators.timestamps import event_instants
from eventlake.session import table


def p1_found(spark, sf_dir):
    return all_changes(table(spark, sf_dir, "concert_snapshot"), table(spark, sf_dir, "venue_cache"), table(spark, sf_dir, "changelog_cache"))


def p3_found(spark, sf_dir):
    return nearby(table(spark, sf_dir, "geocode_cache"), table(spark, sf_dir, "city_rep"))


def p6_found(spark, sf_dir):
    return event_instants(table(spark, sf_dir, "feed_event"), table(spark, sf_dir, "city_reference"))


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p6_found": p6_found}

_FIELDS = ("artist", "start_time", "venue", "city", "country", "ticket_url")
_TRIM = ", ".join(rf"nullif(regexp_replace({c}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g'), '') AS {c}" for c in _FIELDS)
_DIFF = " OR ".join(f"c.{c} IS DISTINCT FROM p.{c}" for c in _FIELDS)

SQL = {
    "p1_found": rf"""
WITH snaps AS (SELECT snap_no, row_number() OVER (ORDER BY snap_no) AS o FROM (SELECT snap_no FROM concert_snapshot UNION SELECT snap_no FROM venue_cache)),
best AS (SELECT concert_id, snap_no, config_id, {_TRIM}, row_number() OVER (PARTITION BY concert_id, snap_no ORDER BY scraped_at DESC, loaded_at DESC) AS rn FROM concert_snapshot),
failed AS (SELECT DISTINCT config_id, snap_no FROM venue_cache WHERE NOT success),
delivered AS (SELECT config_id, o, snap_no, lag(o) OVER (PARTITION BY config_id ORDER BY o) AS prev
  FROM (SELECT DISTINCT config_id FROM concert_snapshot) CROSS JOIN snaps ANTI JOIN failed USING (config_id, snap_no)),
cur AS (SELECT b.*, d.o, d.prev FROM best b JOIN delivered d USING (config_id, snap_no) WHERE rn = 1),
vs AS (SELECT snap_no, row_number() OVER (ORDER BY snap_no) AS o FROM (SELECT DISTINCT snap_no FROM venue_cache)),
v AS (SELECT DISTINCT config_id, o, snap_no, CASE WHEN success THEN nullif(regexp_replace(regexp_replace(lower(trim(content_hash)), '^.*[:=\s]', ''), '[^0-9a-f]', '', 'g'), '') END AS h FROM venue_cache JOIN vs USING (snap_no)),
vl AS (SELECT *, lag(o) OVER w AS prev, lead(o) OVER w AS nxt, last_value(h IGNORE NULLS) OVER (PARTITION BY config_id ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known FROM v WINDOW w AS (PARTITION BY config_id ORDER BY o)),
ks AS (SELECT snap_no, row_number() OVER (ORDER BY snap_no) AS o FROM (SELECT DISTINCT snap_no FROM changelog_cache)),
k AS (SELECT DISTINCT known_key, o FROM (SELECT snap_no, unnest(known_keys) AS known_key FROM changelog_cache) JOIN ks USING (snap_no) WHERE known_key IS NOT NULL)
SELECT 'concert' AS record_kind, c.concert_id AS record_key, c.snap_no, CASE WHEN p.concert_id IS NULL THEN 'added' ELSE 'changed' END AS change_kind
  FROM cur c LEFT JOIN cur p ON p.concert_id = c.concert_id AND p.o = c.prev WHERE c.prev IS NOT NULL AND (p.concert_id IS NULL OR {_DIFF})
UNION ALL SELECT 'concert', p.concert_id, d.snap_no, 'removed' FROM cur p JOIN delivered d ON d.config_id = p.config_id AND d.prev = p.o
  LEFT JOIN cur c ON c.concert_id = p.concert_id AND c.o = d.o WHERE c.concert_id IS NULL
UNION ALL SELECT 'venue', config_id, snap_no, 'added' FROM vl WHERE o > 1 AND prev IS DISTINCT FROM o - 1
UNION ALL SELECT 'venue', config_id, snap_no, 'changed' FROM vl WHERE prev = o - 1 AND h IS NOT NULL AND known IS NOT NULL AND h <> known
UNION ALL SELECT 'venue', config_id, vs.snap_no, 'removed' FROM vl JOIN vs ON vs.o = vl.o + 1 WHERE nxt IS DISTINCT FROM vl.o + 1
UNION ALL SELECT 'known_key', a.known_key, ks.snap_no, 'added' FROM k a JOIN ks ON ks.o = a.o ANTI JOIN k b ON b.known_key = a.known_key AND b.o = a.o - 1 WHERE a.o > 1
UNION ALL SELECT 'known_key', a.known_key, ks.snap_no, 'removed' FROM k a JOIN ks ON ks.o = a.o + 1 ANTI JOIN k b ON b.known_key = a.known_key AND b.o = a.o + 1""",
    "p3_found": """
WITH g AS (SELECT geo_id AS id, lat, lng FROM (SELECT *, row_number() OVER (PARTITION BY geo_key ORDER BY geocoded_at DESC NULLS LAST, geo_id DESC) AS rn FROM geocode_cache)
  WHERE rn = 1 AND NOT isnan(lat) AND NOT isnan(lng) AND lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180 AND NOT (lat = 0 AND lng = 0)),
c AS (SELECT rep_id AS id, country, lat_sum / geo_count AS lat, lng_sum / geo_count AS lng FROM city_rep WHERE geo_count > 0)
SELECT 'venue' AS place_kind, a.id AS a_id, b.id AS b_id FROM g a JOIN g b ON a.id < b.id AND abs(a.lat - b.lat) < 0.01
  WHERE 2 * 6371 * asin(sqrt(least(1, pow(sin(radians(a.lat - b.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(a.lng - b.lng) / 2), 2)))) <= 1
UNION ALL SELECT 'city', a.id, b.id FROM c a JOIN c b ON a.id < b.id AND a.country = b.country
  WHERE 2 * 6371 * asin(sqrt(least(1, pow(sin(radians(a.lat - b.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(a.lng - b.lng) / 2), 2)))) <= 35""",
}
