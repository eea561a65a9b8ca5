"""Matching, extraction, ranking and state on small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventlake.operators import catalog, match, pipeline, places, ranking, state
from eventlake.sources import html

LIST = ["Owls", "Baby", "Fire", "Nine Grey Owls", "Against Them!", "abc", "Rammclaw", "Kestrel Street", "Coverdale", "alan", "Alan Heron"]
TITLES = {
    "OWLS": ("Owls", 1), "Owls at the Barn": ("Owls", 3), "xOwls": ("Owls", 4), "xyOwls": (None, None), "Baby Keem": (None, None), "Wall of Fire": (None, None), "Fire of Wall": (None, None), "Nine Grey Owls": ("Nine Grey Owls", 1), "the nine grey owls - Rome": (None, None), "Against Them! live": ("Against Them!", 3),
    "abc": ("abc", 1), "abc at night": (None, None), "Rammclwa": ("Rammclaw", 4), "Kestrel Stret": ("Kestrel Street", 4), "Owls Tribute": (None, None), "Coverdale": ("Coverdale", 1), "Owlz": ("Owls", 4), "Ow": (None, None), "alan heron in town": ("Alan Heron", 3), "Fire": ("Fire", 1),
    "an evening about owls and many other things of the wood": (None, None), "Kestrél Streets": ("Kestrel Street", 4),
}


def whitelist(spark):
    return spark.createDataFrame([(n, i, [f"aka{i}"] + (["shared"] if i < 2 else [])) for i, n in enumerate(LIST)], "name string, ord long, aliases array<string>")


def test_matching(spark):
    df = spark.createDataFrame([(t,) for t in TITLES] + [(None,), ("",), ("Owls at the Barn",)], "title string")
    got = {r.title: (r.name, r.tier) for r in match.match_titles(df, whitelist(spark)).collect()}
    assert {t: got.get(t, (None, None)) for t in TITLES} == TITLES


def test_aliases(spark):
    df = spark.createDataFrame([("AKA3",), ("shared",)], "title string")
    assert [(r.title, r.name) for r in match.match_titles(df, whitelist(spark)).collect()] == [("AKA3", "Nine Grey Owls")]
    assert match.match_titles(df, whitelist(spark).limit(0)).collect() == []


def test_edit_tier_equals_brute_force(spark):
    rng = random.Random(3)
    names = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(4, 10))) for _ in range(40)})
    titles = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(2, 11))) for _ in range(150)})
    n = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "name string, ord long").withColumn("found", F.col("name"))
    got = {r.title: r.name for r in match.misspelt(spark.createDataFrame([(t,) for t in titles], "title string"), n).collect()}

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    want = {}
    for t in titles:
        near = [(0 if len(x) <= 7 else 1, lev(t, x), len(x), i, x) for i, x in enumerate(names) if lev(t, x) <= (1 if len(x) <= 7 else 2)]
        if near:
            want[t] = min(near)[4]
    assert got == want


def test_best_of_key_and_validity(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 2, "u2"), ("k", 3, "u3"), ("l", 4, ""), ("l", 5, None), ("m", 6, "u6"), ("m", 7, "u7")], "key string, seq long, ticket_url string")
    assert sorted((r.key, r.seq) for r in pipeline.best_of_key(df).collect()) == [("k", 2), ("l", 4), ("m", 6)]
    assert sorted((r.key, r.seq) for r in pipeline.best_of_key(pipeline.best_of_key(df)).collect()) == [("k", 2), ("l", 4), ("m", 6)]
    assert pipeline.best_of_key(df.limit(0)).collect() == []
    u = spark.createDataFrame([(None,), ("",), ("https://a.example/x",), ("nonsense",)], "u string")
    assert [r[0] for r in u.select(pipeline.url_ok("u")).collect()] == [True, True, True, False]


def test_content_hashes(spark):
    import hashlib

    data = [("s", "A", "d", "v", "c", None), ("s", "B", "d", "v", "c", "u"), ("t", "A", "d", "v", "c", "u"), (None, "A", None, "v", "c", "u")]
    df = spark.createDataFrame(data, "source string, artist string, date string, venue string, city string, ticket_url string")
    got = {r.source: (r.n, r.content_hash) for r in pipeline.content_hashes(df, "source").collect()}
    lines = lambda s: "\n".join(sorted("|".join(x or "" for x in d[1:]) for d in data if d[0] == s))
    assert got == {s: (sum(d[0] == s for d in data), hashlib.sha1(lines(s).encode()).hexdigest()) for s in ("s", "t", None)}


PAGE = """<html><ul class="l"><li id=one class="ev big">A<a href="/x?y=1">go</a><p>p1<p>p2</li><li class=ev data-k="v1">B<span>b</span></ul>
<div><h2>t</h2><p>after</p><p>later</p></div><table><tr><td>1<td>2<tr><td>3</table><img src=z></html>"""


@pytest.mark.parametrize("css,want", [
    ("li", 2), ("li.ev.big", 1), ("#one", 1), ("ul > li", 2), ("html > li", 0), ("li:has(span)", 1), ("li:not(.big)", 1), ("li:contains(A)", 1), ("li:nth-child(2)", 1), ("li:nth-child(odd)", 1), ("p:first-of-type", 2), ("h2 + p", 1), ("h2 ~ p", 2), ("td", 3), ("tr:last-child td", 1),
    ("[data-k]", 1), ("[data-k=v1], #one", 2), ("[data-k*='1']", 1), ("[data-k^=v]", 1), ("[data-k$=\"1\"]", 1), ("li p:nth-of-type(2)", 1), ("img", 1), ("li:first-child a[href]", 1), ("*", 19),
])
def test_selectors(css, want):
    assert len(html.selector(css).select(html.parse(PAGE))) == want


def test_extraction_cases(spark):
    s = {"block": ".e", "artist": ".a", "date": ".d", "city_fallback": "Town"}
    pages = spark.createDataFrame([
        (1, '<div class=e><i class=a>X</i><i class=a>Y</i><b class=d> 1.1. </b></div><a class=e href="//h.example/q"><i class=a>Z</i><b class=d>2.2.</b></a><div class=e><i class=a>no date</i></div>', "https://p.example/a/"),
        (2, None, None), (3, "", None), (4, "<div class=e><i class=a>J</i><b class=d>3.3.</b><", None), (5, '<a class=e href="javascript:x"><i class=a>Q</i><b class=d>4.4.</b></a>', "https://p.example"),
    ], "page_id long, html string, url string")
    got = [(r.page_id, r.pos, r.artist, r.date, r.city, r.link) for r in html.extract(pages, "static_selectors", s).orderBy("page_id", "pos").collect()]
    assert got == [(1, 0, "XY", "1.1.", "Town", None), (1, 1, "Z", "2.2.", "Town", "https://h.example/q"), (4, 0, "J", "3.3.", "Town", None), (5, 0, "Q", "4.4.", "Town", None)]


def test_markup_and_paths():
    tree = {"@graph": [{"@type": "Organization", "events": {"@type": ["x", "MusicEvent"], "name": ["N"], "startDate": "D", "location": [{"name": "V", "address": {"addressLocality": "C", "addressCountry": "Germany"}}], "offers": [{}, {"url": "u"}], "subEvent": [{"@type": "event", "performers": {"@value": 7}, "doorTime": "E"}]}}]}
    import json

    page = f'<script type="application/ld+json">{json.dumps(tree)}</script>'
    got = html.by_markup(page, "https://p.example/a/b", {"country_fallback": "XX"})
    assert [(r["artist"], r["date"], r["venue"], r["city"], r["country"], r["link"]) for r in got] == [("N", "D", "V", "C", "XX", "https://p.example/a/u"), ("7", "E", "", "", "XX", None)]
    assert html.by_body('{"a": {"b": [{"x": 0, "y": "d"}, {"x": "n", "y": 5}]}}', None, {"block": "a.b", "artist": "x", "date": "y"})[0]["date"] == "5"
    assert html.by_body('{"a": {"x": "n", "y": "d"}}', None, {"block": "a", "artist": "x", "date": "y"})[0]["artist"] == "n"
    assert html.by_body("no json", None, {}) == [] and html.by_hydration("<p>", None, {}) == []


def test_ranks(spark, rows):
    rng = random.Random(1)
    data = [(i, rng.choice([None, 1.0, 2.0, 2.0, 5.5, float(rng.randint(0, 50))])) for i in range(300)]
    df = spark.createDataFrame(data, "i long, v double")
    order = sorted((x for _, x in data), key=lambda x: (x is not None, x or 0))
    first = {x: order.index(x) for x in set(order)}
    assert {r.i: round(r.pr, 9) for r in ranking.percent_rank(df, "v").collect()} == {i: round(first[x] / 299, 9) for i, x in data}
    assert [r.pr for r in ranking.percent_rank(df.limit(1), "v").collect()] == [0.0]
    assert ranking.percent_rank(df.limit(0), "v").collect() == []
    got = ranking.indexed(df, F.col("v").asc_nulls_first(), F.col("i")).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(300)) and [r.i for r in got] == [i for i, _ in sorted(data, key=lambda d: (d[1] is not None, d[1] or 0, d[0]))]
    assert ranking.histogram(df.limit(0), "v").collect() == [] and ranking.quantiles(df.limit(0), "v", [0.5]).collect() == []
    flat = ranking.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v")
    assert [r.n for r in flat.orderBy("bucket").collect()] == [2] + [0] * 11
    protected = spark.createDataFrame([("a", 1.0, True), ("b", 9.0, False), ("c", 8.0, False), ("d", 2.0, False), ("a", 0.5, True)], "slug string, score double, protected boolean")
    assert sorted(r.slug for r in ranking.selected(protected, 3.0, 2).collect()) == ["a", "b"]


def test_clusters(spark):
    data = [("DE", "A", 50.0, 8.0), ("DE", "B", 50.2, 8.0), ("DE", "Bb", 50.4, 8.0), ("DE", "Far", 55.0, 8.0), ("FR", "C", 50.0, 8.0), ("DE", "Nil", None, None), ("DE", "Bb", 50.4, 8.0)]
    got = {(r.country, r.city): r.canonical for r in places.clusters(places.representatives(spark.createDataFrame(data, "country string, city string, lat double, lng double"))).collect()}
    assert got == {("DE", "A"): "Bb", ("DE", "B"): "Bb", ("DE", "Bb"): "Bb", ("DE", "Far"): "Far", ("FR", "C"): "C", ("DE", "Nil"): "Nil"}


def test_three_way(spark):
    rows = lambda **kv: spark.createDataFrame([(k, v) for k, v in kv.items()], "k string, v string")
    before, after, current = rows(a="1", b="1", c="1", d="1", e="1"), rows(a="2", b="2", c="1", f="9", g="9"), rows(a="1", b="3", d="1", e="5", g="9", h="7")
    got = {r.k: r.action for r in state.three_way(before, after, current, "k").collect()}
    assert got == {"a": "upsert", "b": "conflict", "d": "delete", "e": "conflict", "f": "upsert", "g": "upsert"}


def test_change_log_and_streaks(spark):
    day = lambda n: dt.datetime(2026, 1, n)
    now, known = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a",)], "k string")
    prior = spark.createDataFrame([("x", day(1)), ("y", day(25))], "k string, detected_at timestamp")
    at = F.lit("2026-02-10").cast("timestamp")
    changes, keys = state.changelog(prior, now, known, "k", at)
    assert sorted(r.k for r in changes.collect()) == ["b", "y"] and sorted(r.k for r in keys.collect()) == ["a", "b"]
    cold, _ = state.changelog(prior.limit(0), now, known.limit(0), "k", at)
    assert cold.count() == 0
    health, failures = spark.createDataFrame([("p", 3), ("q", 4)], "id string, failures long"), spark.createDataFrame([("p",), ("p",), ("r",)], "id string")
    assert sorted(tuple(r) for r in state.streaks(health, failures, "id", 5).collect()) == [("p", 5, True), ("r", 1, False)]
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "s int, v string"), spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "s int, v string")
    assert sorted(r.s for r in state.changed_shards(old, new, "s", ["v"]).collect()) == [2, 3]
    cache = state.upsert(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), spark.createDataFrame([("a", 2, True), ("b", 2, False), ("c", 2, True)], "k string, v int, ok boolean"), "k")
    assert sorted(tuple(r) for r in cache.collect()) == [("a", 2), ("b", 1), ("c", 2)]


def test_catalogue(spark):
    df = spark.createDataFrame([("The Owls", 2), ("THE OWLS", 1), ("the  owls", 0), (None, 3)], "name string, ord long")
    assert [(r.key, r.name, r.ord) for r in catalog.case_variants(df, "name", "ord").collect()] == [("the owls", "THE OWLS", 0)]
    a = spark.createDataFrame([("N", ["n ", "A", None, "a", "B", ""])], "name string, aliases array<string>")
    assert a.select(catalog.union_aliases(F.col("name"), F.col("aliases"))).first()[0] == ["A", "B"]


def test_suffixes_and_stripes(spark):
    df = spark.createDataFrame([("Owl (band)", 0, "w", None), ("owl", 1, None, "a"), ("OWL", 2, "x", None), (None, 3, "y", "b")], "name string, ord int, site string, mbid string")
    assert [tuple(r) for r in catalog.merged_suffixes(df, "name", "ord", ("mbid",)).select("name", "ord", "site", "mbid").collect()] == [("OWL", 0, "x", "a")]
    left = spark.createDataFrame([(1, "d1", 10.0), (1, "d2", 300.0), (2, "d3", 10.0)], "page int, what string, top double")
    right = spark.createDataFrame([(1, 5, 69.9), (1, 2, 60.0), (1, 1, 70.0), (2, 9, 500.0)], "page int, n int, top double")
    assert [(r.what, r.match.n) for r in catalog.beside(left, right, "page", "top", 60.0, "n").collect()] == [("d1", 2)]


def test_own_extractor(spark):
    @html.register("upper")
    def upper(page, url, selectors):
        return [dict.fromkeys(html.FIELDS, page.upper())]

    df = spark.createDataFrame([(1, "x", None)], "page_id long, html string, url string")
    assert html.extract(df, "upper", {}).first().artist == "X"


def test_neighbours_are_not_broadcast(spark, rows):
    """A catalogue's rows are no matter of its estimated size: the driver must not gather them."""
    said = spark.createDataFrame([(1, [2, 1, 9, 3, 4]), (2, [None, 7])], "k long, names array<long>")
    got = catalog.resolved_neighbours(said, "k", "names", spark.range(1, 5).withColumnRenamed("id", "name"), "name", 2)
    assert rows(got) == [(1, [2, 3])]
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
