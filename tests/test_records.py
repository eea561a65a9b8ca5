"""Published and exchanged records, sites, sweeps, reasons of empty results."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventlake.functions import dates, text
from eventlake.operators import pipeline, ranking, records
from eventlake.operators.spatial import pairs_within
from eventlake.sources import http, sites, sweep

TODAY = dt.date(2026, 6, 15)


def test_names_and_addresses(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(records.spotify_id(F.lit("https://open.spotify.com/intl-de/artist/Ab9?x"))) == "Ab9" and one(records.spotify_id(F.lit("https://open.spotify.com/track/1"))) is None
    assert one(records.probe_url(F.lit(" act.example/a/?q#f"), F.lit("/tour"))) == "https://act.example/a/tour" and one(records.probe_url(F.lit("http://act.example"), F.lit("shows"))) == "http://act.example/shows"
    assert one(records.suspicious_name(F.lit("Hall, Bavaria"), ["bavaria"], [])) and one(records.suspicious_name(F.lit("City Museum"), [], ["museum"])) and not one(records.suspicious_name(F.lit(None).cast("string"), ["x"], ["y"]))
    assert one(records.noise_name(F.lit("[x]"))) and one(records.noise_name(F.lit(""))) and not one(records.noise_name(F.lit("Кино"))) and one(records.noise_name(F.lit("東京"))) and not one(records.noise_name(F.lit("東京"), ["東京"]))
    assert one(records.first_match((F.lit(None).cast("boolean"), F.lit("a")), (F.lit(True), F.lit("b")))) == "b"
    assert one(text.slug(F.lit("Beyoncé"))) == "beyonce" and one(text.slug(F.lit(None).cast("string"))) is None


def test_models_answers(spark, rows):
    answers = ['Sure\n```json\n{"concerts":[{"artist":" A ","date":"1.1.2027","venue":null},{"artist":"B","date":" "}]}\n```', '{"concerts":[{"date":"x"}]} bye', "nothing {here", None]
    df = spark.createDataFrame([(i, a, "Fallback") for i, a in enumerate(answers)], "id int, answer string, artist_fallback string")
    assert rows(records.extracted_listings(df), "id", "artist", "date", "venue", "ticket_url") == [(0, "A", "1.1.2027", "", None), (1, "Fallback", "x", "", None)]
    j = spark.createDataFrame([('{"a":null,"b":[1,null,{"c":null}]}',), ("no",), (None,)], "j string").select(records.without_nulls("j").alias("j")).collect()
    assert [r.j for r in j] == ['{"b":[1,{}]}', None, None]


def test_services_answers(spark):
    body = json.dumps({"artist": {"tags": {"tag": [{"name": f" t{i} "} for i in range(7)] + [{"name": " "}]}, "stats": {"listeners": "12", "playcount": "x"}}})
    df = spark.createDataFrame([(1, 200, body), (2, 404, None), (3, 500, None), (4, 200, '{"error":6}'), (5, 200, '{"error":29}'), (6, 200, "broken"), (7, 200, "{}")], "id int, status int, body string")
    got = {r.id: r for r in records.tag_answers(df).collect()}
    assert [got[i].ok for i in range(1, 8)] == [True, True, False, True, False, False, True]
    assert got[1].genres == [f"t{i}" for i in range(5)] and got[1].popularity is None and got[7].genres is None


def test_bindings(spark):
    data = [("A  b", "q1", None, "@x", "Alias", 2), ("a B", "q1", "https://w.example", "@y", " alias", 1), ("c", "q2", "u", None, "C", 3), ("c", "q3", "v", None, None, 4), (None, "q9", "v", None, None, 5), ("d", "", "v", None, None, 6)]
    got = {r["name"]: r for r in records.bindings(spark.createDataFrame(data, "name string, item string, website string, instagram string, alias string, ord int"), "ord").collect()}
    assert set(got) == {"a b", "c"} and got["a b"].website == "https://w.example" and got["a b"].instagram == "https://www.instagram.com/y" and got["a b"].aliases == ["Alias", "alias"]
    assert got["c"].ambiguous and got["c"].website is None


def test_merge_and_catalogue(spark, rows):
    old = spark.createDataFrame([("a", "", "m", "seed"), ("b", "w", None, None), ("c", None, None, "x+y")], "slug string, website string, mbid string, source string")
    new = spark.createDataFrame([("a", "n", "z", "bot"), ("c", "n", "", "y")], "slug string, website string, mbid string, source string")
    assert rows(records.merge_filled(old, new, "slug", ["website", "mbid"], "source")) == [("a", "n", "m", "seed+bot"), ("b", "w", None, None), ("c", "n", None, "x+y")]
    acts = spark.createDataFrame([("Ab", 2, "", ["x"]), ("AB", 1, "w", []), (None, 3, "w", None), ("", 4, "w", None)], "name string, ord int, website string, genres array<string>")
    assert rows(records.catalog_entries(acts, "ord"), "slug", "name", "website", "genres", "spotify_id") == [("ab", "AB", "w", None, None)]


def test_status_and_progress(spark):
    t = lambda d: dt.datetime(2026, 6, d)
    r = spark.createDataFrame([("a", True, False, t(15), None), ("b", True, True, t(1), None), ("c", False, None, t(15), "x"), ("d", None, None, None, "y")], "config_id string, success boolean, not_modified boolean, scraped_at timestamp, reason string")
    got = records.run_status(r, r.limit(2), F.lit(t(15))).first()
    assert (got.total, got.succeeded, got.failed, got.changed, got.unchanged, got.failed_ids, got.stale_ids, got.published) == (4, 2, 2, 1, 1, "c,d", "b", 2)
    assert {x.id for x in records.fail_log(r).collect()} == {"c", "d"} and records.progress(r, failed=F.col("success") == F.lit(False)).first().asDict() == {"total": 4, "failed": 1}


def test_two_passes(spark, rows):
    raw = spark.createDataFrame([(1, "One", "2026-10-03", "Hall", "Town", "de", 1.0, 2.0, None, "x.example", "t"), (2, "Two", "2026-10-03", "Hall", "Town", "de", None, None, " https://u.example ", "x.example", "t")], "seq int, artist string, date string, venue string, city string, country string, lat double, lng double, ticket_url string, original_source string, scraped_at string")
    acts = spark.createDataFrame([("One", 1, "https://one.example", ("https://open.spotify.com/artist/Q1", "")), ("Two", 2, None, None)], "name string, ord int, website string, socials struct<spotify:string,vk:string>").withColumn("socials", F.when(F.col("socials").isNotNull(), F.struct("socials.spotify", *[F.lit(None).cast("string").alias(n) for n in ("instagram", "facebook", "youtube", "telegram")], "socials.vk")))
    first = lambda w, _: w.where("name = 'One'").unionByName(acts)
    got = {r.artist: r for r in records.two_pass(raw, acts.where("name = 'One'"), first, F.lit(TODAY)).collect()}
    assert set(got) == {"One", "Two"} and got["One"].spotify_id == "Q1" and got["One"].ticket_url == got["One"].artist_website == "https://one.example" and got["Two"].ticket_url == "https://u.example" and got["Two"].artist_socials is None and got["Two"].festival is None


def test_dates_once_a_text(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["2026-10-03", "3. Oktober 2026", "2026-10-03", None, "", "soon"])], "i int, t string")
    got = {r.i: r.day for r in dates.with_dates(df, "t", F.lit(TODAY)).collect()}
    assert got == {0: dt.date(2026, 10, 3), 1: dt.date(2026, 10, 3), 2: dt.date(2026, 10, 3), 3: None, 4: None, 5: None}


@pytest.mark.parametrize("target", [3, 20_000])
def test_dense_points_are_split_on_both_sides(spark, target):
    """Half of the points on one spot, in ranges of three points: every pair once, none twice."""
    pts = [(i, 50.0, 8.0) for i in range(20)] + [(100 + i, 50.0 + i * 0.004, 8.0) for i in range(20)]
    df = spark.createDataFrame(pts, "id long, lat double, lng double")
    got = sorted(tuple(r) for r in pairs_within(df, "id", F.col("lat"), F.col("lng"), 1.0, target=target).collect())
    km = lambda a, b: abs(a[1] - b[1]) * 111.19492664
    assert got == sorted((a[0], b[0]) for a in pts for b in pts if a[0] < b[0] and km(a, b) <= 1.0)


def test_ranks_of_frequent_values(spark):
    df = spark.createDataFrame([(v,) for v in [5.0] * 40 + [1.0, 9.0, None]], "v double")
    assert {round(r.value, 6) for r in ranking.quantiles(df, "v", [0.5, 0.9]).collect()} == {5.0}
    assert {(r.v, round(r.pr, 6)) for r in ranking.percent_rank(df, "v").collect()} == {(None, 0.0), (1.0, round(1 / 42, 6)), (5.0, round(2 / 42, 6)), (9.0, 1.0)}
    assert ranking.knee(df, "v").first().pos == 1 and ranking.quantiles(df.limit(0), "v", [0.5]).count() == 0 and ranking.percent_rank(df.limit(0), "v").count() == 0


def test_reasons(spark):
    cases = [("circuit_open", None, 0, None), ("x", None, 0, True), ("x", "<p>", 0, None), (None, "<p>", 2, None), (None, "no events", 0, True), (None, '<div id="app"></div>', 0, None), (None, "no events", 0, False), (None, None, 0, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, error string, html string, n int, allow boolean")
    got = {r.i: r.why for r in df.select("i", http.failure_reason("error", "html", "n", "allow").alias("why")).collect()}
    assert [got[i] for i in range(8)] == ["circuit_open", "fetch_error", "parse_error", None, "empty_schedule", "csr_detected", "selectors_stale", "selectors_stale"]


def test_private_hosts():
    assert all(map(http.is_private, [None, "", "localhost", "a.localhost.", "127.0.0.1", "10.1.1.1", "169.254.1.1", "::1", "fe80::1", "2130706433", "0x7f.1", "::ffff:192.168.0.1"]))
    assert not any(map(http.is_private, ["a.example", "8.8.8.8", "1a.example"]))


def test_sweep(spark, tmp_path):
    (tmp_path / "fake_service.py").write_text("def get(url, headers):\n    k = url.split('/')[3]\n    if k == 'none': return 404, None, None\n    if k.startswith('bad'): raise OSError('x')\n    if k == 'denied': return 403, None, None\n    return 200, '{\"e\": [1], \"n\": 2}', None\n")
    spark.sparkContext.addPyFile(str(tmp_path / "fake_service.py"))
    go = lambda keys, **k: [(r.key, r.page, r.outcome) for r in sweep.sweep(spark.createDataFrame([(x, i) for i, x in enumerate(keys)], "key string, ord int"), "https://s.example/{key}/{page}", "fake_service:get", misses=(404,), **k).collect()]
    assert go(["a", "none", "bad1", None, "b"], pages=5, total="n", items="e") == [("a", 0, "ok"), ("a", 1, "ok"), ("none", 0, "miss"), ("bad1", 0, "failed"), ("b", 0, "ok"), ("b", 1, "ok")]
    assert [o for *_, o in go(["bad1", "bad2", "a"], streak=2)] == ["failed", "failed", "stopped"] and [o for *_, o in go(["bad1", "a", "b"], cap=1)] == ["failed", "ok", "later"]
    assert [o for *_, o in go(["denied", "a"], aborts=(403,))] == ["failed", "stopped"] and go([]) == []
    answers = spark.createDataFrame([("a", "ok"), ("b", "failed"), ("c", "stopped")], "key string, outcome string")
    events = lambda *ks: spark.createDataFrame([(k, v) for k, v in ks], "key string, v string")
    assert sorted(tuple(r) for r in sweep.swept_rows(answers, events(("a", "new")), events(("a", "old"), ("b", "old"), ("c", "old"))).collect()) == [("a", "new"), ("b", "old"), ("c", "old")]


def test_sites_of_other_shapes():
    read = lambda site, html: sites.by_site(site, html, "https://s.example/", TODAY)
    assert all(read(s, h) == [] for s in sites.SITES for h in ("", None, "<p>nothing</p>", "{}", "[", "<script id='__NEXT_DATA__'>x</script>")) and read("unknown", "<p>") == []
    drop = read("drugstore-belgrade", '<h2 class="entry-title"><a href="javascript:x">A <span>1/2/2027</span> B</a></h2>')
    assert [(r["artist"], r["date"], r["link"]) for r in drop] == [("A B", "1/2/2027", None)]
    near = '<div class="t396__artboard">АФИША' + "".join(f'<div class="tn-elem" data-elem-type="text" data-field-top-value="{t}" data-field-left-value="{l}">{x}</div>' for t, l, x in [(0, 0, "01.07"), (59, 0, "Кипр, Hall"), (100, 0, "02.07"), (161, 0, "Турция, Kemer Club"), (0, 600, "03.07")]) + "</div>"
    assert [(r["date"], r["city"], r["venue"], r["country"]) for r in read("vintazh-tour", near)] == [("01.07", "Кипр", "Hall", "CY"), ("02.07", "Кипр", "Hall", "CY")]
    flex = '<div class="ewpe-inner-wrapper"><p class="ewpe-event-title">A</p><p class="ewpe-events-schedule">Fr 3. {}</p></div>'
    assert [read("flex-vienna", flex.format(m))[0]["date"] for m in ("Juni", "Mai", "Jänner")] == ["2026-06-03", "2027-05-03", "2027-01-03"] and read("flex-vienna", flex.format("Foo")) == []


def test_templated_venues_and_valid_rows(spark):
    df = spark.createDataFrame([("Act", "ACT in Town"), ("Act", "Act в Omsk"), ("Act", "Act"), ("Act", "Active in Town"), ("", " in Town"), (None, "x in y"), ("Act", None)], "a string, v string")
    assert [bool(r.x) for r in df.select(pipeline.templated_venue("a", "v").alias("x")).collect()] == [True, True, False, False, False, False, False]
