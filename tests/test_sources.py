"""Files, the page source and streams."""

import datetime as dt
import json

from pyspark.sql import functions as F

from eventlake.sources import files, http
from eventlake.streaming import runs


def test_configs(spark, tmp_path):
    good = {"id": "a-1", "domain": "a.example", "url": "https://a.example/list", "type": "jsonld", "selectors": {"eventBlock": ".x"}}
    bad = [good | {"id": "A!"}, good | {"id": "b", "type": "other"}, good | {"id": "c", "url": "http://10.0.0.1/"}, good | {"id": "d", "maxRetries": 9}, good | {"id": "e", "url": "ftp://a.example"}]
    for i, c in enumerate([good, *bad]):
        (tmp_path / f"{i}.json").write_text(json.dumps(c))
    (tmp_path / "broken.json").write_text("{no")
    (tmp_path / "note.txt").write_text("x")
    got = files.read_configs(spark, str(tmp_path)).collect()
    assert [(r.id, r.selectors.eventBlock) for r in got] == [("a-1", ".x")]


def test_whitelist_layouts(spark, tmp_path):
    (tmp_path / "shard-0.json").write_text(json.dumps(["Bare", {"name": "Full", "aliases": ["F"], "unknown": 1}, {"name": ""}]))
    (tmp_path / "shard-1.json").write_text(json.dumps([{"name": "Ünd", "popularity": {"listeners": 5}}]))
    got = files.read_whitelist(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.ord, r.name, r.aliases) for r in got] == [(0, "Bare", None), (1, "Full", ["F"]), (2, "Ünd", None)]
    assert files.read_whitelist(spark, str(tmp_path / "absent")).collect() == []
    one = tmp_path / "one.json"
    one.write_text(json.dumps(["X"]))
    assert [r.name for r in files.read_whitelist(spark, str(one)).collect()] == ["X"]


def test_targets(spark, tmp_path):
    p = tmp_path / "t.txt"
    p.write_text("Owl\n\n  # note\n owl \nBee\n")
    assert sorted(r.key for r in files.read_targets(spark, str(p)).collect()) == ["bee", "owl"]


def test_only_changed_shards_are_written(spark, tmp_path):
    old = spark.createDataFrame([("Ann", 1), ("Bob", 1), ("Åse", 1)], "name string, v int")
    new = old.withColumn("v", F.when(F.col("name") == "Bob", 2).otherwise(F.col("v")))
    path = str(tmp_path / "shards")
    assert files.write_shards(old, None, path).count() == 3
    assert [r.shard for r in files.write_shards(new, old, path).collect()] == [ord("B") % 8]
    assert sorted((r.name, r.v) for r in spark.read.json(path).collect()) == [("Ann", 1), ("Bob", 2), ("Åse", 1)]


def test_publishing(spark, tmp_path):
    data = [("Owl", dt.date(2026, 1, 1 + i % 28), "Town", i) for i in range(1100)] + [("Bee", dt.date(2026, 2, 1), "City", 0)]
    df = spark.createDataFrame(data, "artist string, date date, city string, n long")
    out = str(tmp_path / "out")
    files.publish(df, out, F.lit("2026-01-01").cast("timestamp"))
    assert spark.read.parquet(f"{out}/concerts").count() == 1101
    assert {r.page: r.n for r in spark.read.json(f"{out}/pages").groupBy("page").agg(F.count("*").alias("n")).collect()} == {1: 500, 2: 500, 3: 101}
    assert {r.artist_slug for r in spark.read.json(f"{out}/artists").select("artist_slug").distinct().collect()} == {"owl", "bee"}
    stats = spark.read.json(f"{out}/index").first().stats
    assert (stats.totalConcerts, stats.uniqueArtists, stats.uniqueCities, stats.pageCount) == (1101, 2, 2, 3)
    files.publish(df.where("artist = 'Bee'"), out, F.lit("2026-01-02").cast("timestamp"))
    assert {r.artist_slug for r in spark.read.json(f"{out}/artists").select("artist_slug").distinct().collect()} == {"bee"}


def test_health():
    assert files.healthy(None, 5) and files.healthy(10, 5) and not files.healthy(10, 4) and not files.healthy(None, 0)


def test_retries():
    waits, answers = [], iter([OSError("ECONNRESET"), (503, None, None), (200, "ok", "e")])

    def get(url, headers):
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a

    got = http.fetch_with(get, "u", {}, 2, sleep=waits.append, noise=lambda: 0)
    assert got == {"status": 200, "body": "ok", "etag": "e", "error": None, "attempts": 3} and waits == [0.5, 1.0]
    assert http.fetch_with(lambda *_: (404, "x", None), "u", {}, 2)["error"] == "HTTP 404"
    assert http.fetch_with(lambda *_: (304, None, None), "u", {}, 2)["error"] is None
    assert http.backoff_ms(9) == 15_000


def test_page_source(spark, tmp_path):
    (tmp_path / "fake_get.py").write_text("def get(url, headers):\n    if 'bad' in url:\n        return 404, None, None\n    return (304 if headers else 200), 'body ' + url, None\n")
    spark.sparkContext.addPyFile(str(tmp_path / "fake_get.py"))
    spark.dataSource.register(http.PageSource)
    items = [{"id": f"b{i}", "url": f"https://bad.example/{i}"} for i in range(5)] + [{"id": "a", "url": "https://a.example/"}, {"id": "c", "url": "https://a.example/2", "etag": "x"}]
    got = {r.id: (r.status, r.error) for r in spark.read.format("eventlake_pages").option("items", json.dumps(items)).option("getter", "fake_get:get").load().collect()}
    assert got["a"] == (200, None) and got["c"] == (304, None)
    assert [got[f"b{i}"][1] for i in range(5)] == ["HTTP 404"] * 3 + ["circuit_open"] * 2


def test_streams(spark, tmp_path):
    t = lambda m: dt.datetime(2026, 1, 1, 0, m)
    parts = [[("a", t(1), True), ("b", t(2), False)], [("a", t(3), True), ("c", t(4), False), ("a", t(5), True)], [("b", t(6), True), ("c", t(7), False)]]
    src = tmp_path / "in"
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "k string, at timestamp, failed boolean").coalesce(1).write.parquet(str(src / f"{i}"))
    schema = "k string, at timestamp, failed boolean"
    listed = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(src))
    q = runs.streaks(listed(), "k", "failed", 3).writeStream.outputMode("update").format("memory").queryName("streaks").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    last = {}
    for r in spark.sql("SELECT * FROM streaks").collect():
        last.setdefault(r.k, []).append((r.streak, r.prune))
    assert max(last["a"]) == (3, True) and last["c"] == [(0, False), (0, False)]
    runs.run_changelog(listed(), "k", "at", str(tmp_path / "log"), str(tmp_path / "c2")).awaitTermination()
    changes = spark.read.parquet(str(tmp_path / "log" / "changes"))
    assert changes.where("run = 0").count() == 0 and changes.count() >= 1
    once = runs.first_listings(listed(), "at", ["k"]).writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    once.awaitTermination()
    assert sorted(r.k for r in spark.sql("SELECT k FROM once").collect()) == ["a", "b", "c"]
