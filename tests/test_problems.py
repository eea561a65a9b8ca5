"""Snapshot changes, nearby points and timestamps against hand-made cases and brute force."""

import datetime as dt
import itertools
import math
import random

from pyspark.sql import functions as F

from eventlake.operators import snapshot_diff as sd
from eventlake.operators import spatial, timestamps

T0 = dt.datetime(2026, 3, 1, 4)
CONCERT = "snap_no int, config_id string, concert_id string, artist string, start_time string, venue string, city string, country string, ticket_url string, scraped_at timestamp, loaded_at timestamp, record_key string"
CACHE = "snap_no int, config_id string, content_hash string, scraped_at timestamp, success boolean"


def concert(snap, source, key, artist="A", at=0, **kw):
    return (snap, source, key, artist, kw.get("time"), kw.get("venue", "V"), "C", "DE", kw.get("url"), T0 + dt.timedelta(hours=at), T0, "clash")


def test_concert_changes(spark, rows):
    data = [
        concert(1, "s", "same"), concert(2, "s", "same", "  A "), concert(4, "s", "same"),
        concert(1, "s", "edit"), concert(2, "s", "edit", "B", at=1), concert(2, "s", "edit", "A", at=0), concert(4, "s", "edit", "B"),
        concert(1, "s", "gone"), concert(4, "s", "late"),
        concert(1, "f", "kept"), concert(4, "f", "kept"), concert(1, "f", "lost"), concert(2, "f", "ghost"),
        concert(1, "s", None), concert(1, "s", "same"),
    ]
    cache = [(n, s, "ab", T0, not (s == "f" and n == 2)) for n in (1, 2, 4) for s in "sf"]
    got = sd.concert_changes(spark.createDataFrame(data, CONCERT), spark.createDataFrame(cache, CACHE))
    assert rows(got, "record_key", "snap_no", "change_kind") == [("edit", 2, "changed"), ("gone", 2, "removed"), ("late", 4, "added"), ("lost", 4, "removed")]
    assert [r.changed_columns for r in got.where("record_key = 'edit'").collect()] == [[0]]


def test_concert_changes_empty(spark, rows):
    none, cache = spark.createDataFrame([], CONCERT), spark.createDataFrame([], CACHE)
    assert rows(sd.concert_changes(none, cache)) == []


def test_source_that_fails_first_has_nothing_to_compare(spark, rows):
    data = [concert(2, "f", "x"), concert(3, "f", "x"), concert(3, "f", "y")]
    cache = [(1, "f", None, T0, False), (2, "f", "a", T0, True), (3, "f", "a", T0, True)]
    got = sd.concert_changes(spark.createDataFrame(data, CONCERT), spark.createDataFrame(cache, CACHE))
    assert rows(got, "record_key", "snap_no", "change_kind") == [("y", 3, "added")]


def test_venue_changes(spark, rows):
    data = [
        (1, "a", "sha1:AB12", T0, True), (2, "a", "ab12", T0, True), (3, "a", None, T0, False), (4, "a", "cd", T0, True), (4, "a", "cd", T0, True),
        (1, "b", "11", T0, True), (3, "b", "22", T0, True), (2, "c", None, T0, False), (3, "c", "77", T0, True), (4, "c", "78", T0, True), (4, None, "1", T0, True),
    ]
    got = sd.venue_changes(spark.createDataFrame(data, CACHE))
    assert rows(got, "record_key", "snap_no", "change_kind") == [
        ("a", 4, "changed"), ("b", 2, "removed"), ("b", 3, "added"), ("b", 4, "removed"), ("c", 2, "added"), ("c", 4, "changed"),
    ]


def test_known_keys(spark, rows):
    df = spark.createDataFrame([(1, 0, ["a", "b"]), (1, 1, ["b", None]), (3, 0, ["b", "c"]), (3, 1, None), (5, 0, None)], "snap_no int, shard_no int, known_keys array<string>")
    assert rows(sd.known_key_changes(df), "record_key", "snap_no", "change_kind") == [("a", 3, "removed"), ("b", 5, "removed"), ("c", 3, "added"), ("c", 5, "removed")]


def test_merge_adds_no_shuffle_after_the_range_partitioning(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, k string")
    plan = sd.diff_deliveries(df, "k", "n", [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 2 and "rangepartitioning" in plan


def km(a, b):
    la, lb = math.radians(a[1]), math.radians(b[1])
    h = math.sin((la - lb) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(a[2] - b[2]) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


def test_pairs_within_equals_brute_force(spark, rows):
    rng = random.Random(5)
    points = [(i, rng.gauss(48, 0.4), rng.gauss(179.9, 0.5)) for i in range(500)]
    points = [(i, a, b - 360 if b > 180 else b) for i, a, b in points] + [(1000 + i, 89.9 + rng.random() / 11, rng.uniform(-180, 180)) for i in range(60)]
    points += [(2000 + i, 10.0, 10.0) for i in range(40)] + [(3000, None, 1.0), (3001, float("nan"), 1.0), (3002, 95.0, 1.0), (3003, 10.0, 190.0), (None, 10.0, 10.0)]
    good = [p for p in points if p[0] is not None and p[0] < 3000]
    for radius in (1.0, 12.0):
        want = sorted(((a[0], b[0]) for a, b in itertools.combinations(good, 2) if km(a, b) <= radius), key=repr)
        df = spark.createDataFrame(points, "id long, lat double, lng double")
        for target in (20_000, 50):  # one range; many ranges, some of a single code
            got = spatial.pairs_within(df, "id", F.col("lat"), F.col("lng"), radius, target=target)
            assert rows(got) == want


def test_pairs_within_groups_repeats_and_nothing(spark, rows):
    df = spark.createDataFrame([(1, 1.0, 1.0, "x", 0), (2, 1.0, 1.0, "y", 0), (3, 1.0, 1.0, "x", 0), (3, 1.0, 1.0, "x", 0), (4, 1.0, 1.0, None, 0)], "id long, lat double, lng double, g string, a_id int")
    assert rows(spatial.pairs_within(df, "id", F.col("lat"), F.col("lng"), 1.0, F.col("g"))) == [(1, 3)]
    assert rows(spatial.pairs_within(df.limit(0), "id", F.col("lat"), F.col("lng"), 1.0)) == []


def test_venue_pairs_take_the_latest_lookup(spark, rows):
    at = lambda h: T0 + dt.timedelta(hours=h)
    df = spark.createDataFrame([(1, "k", 5.0, 5.0, at(0)), (2, "k", None, None, at(1)), (3, "l", 5.0, 5.0, at(0)), (4, "m", 5.001, 5.0, at(0)), (5, "z", 0.0, 0.0, at(0)), (6, "y", 0.0, 0.0, at(0))], "geo_id long, geo_key string, lat double, lng double, geocoded_at timestamp")
    assert rows(spatial.venue_pairs(df)) == [(3, 4)]


FEED = "event_id long, feed string, starts_at string, datetime_raw string, start_date string, start_time string, city_id long, zone string"
CITIES = [(1, "DE", "Europe/Berlin"), (2, "US", "America/New_York"), (3, "GB", "Europe/London"), (4, "XX", "No/Where")]


def utc(*a):
    return int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp())


BIT = {
    "2026-05-14T17:00:00": utc(2026, 5, 14, 15), "2026-10-25T02:30:00": utc(2026, 10, 25, 0, 30), "2026-03-29T02:30:00": utc(2026, 3, 29, 1, 30), "1762200000999": 1762200000, "1759149000": 1759149000,
    "2027-03-03 23:45 GMT": utc(2027, 3, 3, 23, 45), "2027-02-21T22:00:00+01:00": utc(2027, 2, 21, 21), "2026-05-15T10:00:00+0530": utc(2026, 5, 15, 4, 30), "2026-12-21T21:00:23-02": utc(2026, 12, 21, 23, 0, 23),
    "2026-09-06T16:00:00.250Z": utc(2026, 9, 6, 16), "20270310T180000": utc(2027, 3, 10, 17), "2026-07-14 23:00:00.0": utc(2026, 7, 14, 21), "Sat, 25 Jul 2026 19:45:00 -0700": utc(2026, 7, 26, 2, 45),
    "2027-01-12T20:45:00[Asia/Kolkata]": utc(2027, 1, 12, 15, 15), "2026-06-01T24:00:00": utc(2026, 6, 1, 22), "2026-05-14": None, "TBA": None, "0000-00-00T00:00:00": None, "2026-02-30T10:00:00": None, "2026-05-14T25:00:00": None,
    "2026-05-14T10:00:00 QQQ": None, "2026-05-14T10:00:00[Mars/Base]": utc(2026, 5, 14, 8), " ": None,
}


def test_stamps(spark, rows):
    data = [(i, "bit", s, None, None, None, 1, "clash") for i, s in enumerate(BIT)]
    data += [(100, "bit", None, "2026-05-14T17:00:00", None, None, 1, ""), (101, "bit", "", "2026-05-14T17:00:00Z", None, None, None, ""), (102, "bit", "soon", "2026-05-14T17:00:00Z", None, None, 1, ""), (103, "bit", "2026-05-14T17:00:00", None, None, None, 4, "")]
    cities = spark.createDataFrame(CITIES, "city_id long, country string, zone_name string")
    got = dict(rows(timestamps.event_instants(spark.createDataFrame(data + data[:3], FEED), cities)))
    got_bit = {s: got.get(i) for i, s in enumerate(BIT)}
    want = BIT | {"2026-05-14T10:00:00[Mars/Base]": None}
    assert got_bit == want
    assert [got.get(i) for i in (100, 101, 102, 103)] == [utc(2026, 5, 14, 15), utc(2026, 5, 14, 17), None, None]


def test_dates_and_times(spark, rows):
    cases = [
        ("2026-11-17", "20:00", 1, utc(2026, 11, 17, 19)), ("21.07.2026", "7:30 PM", 1, utc(2026, 7, 21, 17, 30)), ("03/04/2026", "9pm", 2, utc(2026, 3, 5, 2)), ("03/04/2026", "9pm", 3, utc(2026, 4, 3, 20)),
        ("20261210", "19.30 Uhr", 1, utc(2026, 12, 10, 18, 30)), ("9.3.27", "17h05", 1, utc(2027, 3, 9, 16, 5)), ("March 11, 2026", "1900", 1, utc(2026, 3, 11, 18)), ("8 Feb 2026", "8.30pm", 1, utc(2026, 2, 8, 19, 30)),
        ("2026-01-01", "12:15 AM", 1, utc(2025, 12, 31, 23, 15)), ("2026-01-01", "18:00 UTC", 1, utc(2026, 1, 1, 18)), ("2026-01-01", "22:30+02:00", 1, utc(2026, 1, 1, 20, 30)), ("2026-01-01", "24:00", 1, utc(2026, 1, 1, 23)),
        ("2026-01-01", "25:99", 1, None), ("2026-01-01", "doors", 1, None), ("2026-01-01", None, 1, None), (None, "20:00", 1, None), ("13/13/2026", "20:00", 1, None), ("2026-01-01", "20:00", None, None), ("2026-01-01", "13 PM", 1, None),
    ]
    data = [(i, "eb", None, None, d, t, c, "") for i, (d, t, c, _) in enumerate(cases)]
    cities = spark.createDataFrame(CITIES, "city_id long, country string, zone_name string")
    got = dict(rows(timestamps.event_instants(spark.createDataFrame(data, FEED), cities)))
    assert [got.get(i) for i in range(len(cases))] == [c[3] for c in cases]


def test_dictionary_grows_by_unseen_strings_only(spark, tmp_path):
    cities = spark.createDataFrame(CITIES, "city_id long, country string, zone_name string")
    feed = lambda *s: spark.createDataFrame([(i, "bit", x, None, None, None, 1, "") for i, x in enumerate(s)], FEED)
    path = str(tmp_path / "dictionary")
    assert timestamps.event_instants(feed("2026-05-14T17:00:00Z", "TBA"), cities, path).count() == 1
    assert timestamps.event_instants(feed("2026-05-14T17:00:00Z", "TBA", "1759149000"), cities, path).count() == 2
    assert spark.read.parquet(path).count() == 3
    assert timestamps.event_instants(feed().limit(0), cities, path).count() == 0
