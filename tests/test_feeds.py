"""Edge cases of the feeds; ordinary rows are checked by the queries."""

import json

from eventlake.sources import feeds


def frame(spark, *bodies, queried="Nine Owls"):
    return spark.createDataFrame([(i, b if isinstance(b, str) else json.dumps(b), queried) for i, b in enumerate(bodies)], "seq int, body string, queried string")


def venue(**kw):
    return {"name": "Hall", "city": {"name": "T"}, "country": {"countryCode": "DE"}} | kw


def test_feed_a(spark):
    day = {"start": {"localDate": "2026-05-01"}}
    good = {"name": "Fest", "url": "u", "dates": {"start": {"localDate": "2026-05-01", "localTime": "7pm"}}, "_embedded": {"venues": [venue(location={"latitude": "5.5x", "longitude": "abc"})], "attractions": [{"name": "A"}, {"name": ""}, {"name": "B"}]}}
    got = feeds.from_feed_a(frame(spark, good, {"name": "Solo", "dates": day, "_embedded": {"venues": [venue()]}}, {"name": "x", "dates": day}, "no json", {"name": "x", "dates": day, "_embedded": {"venues": [venue(country={})]}})).orderBy("seq").collect()
    assert [(r.artist, r.start_time, r.lat, r.lng, r.lineup, r.festival.name if r.festival else None) for r in got] == [("A", None, 5.5, None, ["B"], "Fest"), ("Solo", None, None, None, None, None)]


def test_feed_b(spark):
    v = {"name": "Hall", "city": "T", "country": "Germany"}
    rows = frame(spark, {"starts_at": "2026-05-01T20:00:00", "venue": v, "offers": [{"url": "o"}], "url": "u"}, {"datetime": "2026-05-01", "venue": v | {"country": "Nowhere"}}, {"datetime": "2026-05-01", "venue": v | {"name": "nine owls в Town"}}, {"venue": v}, {"datetime": "2026-05-01", "venue": v | {"name": "Nine Owls in"}, "url": "u"})
    assert [(r.seq, r.artist, r.start_time, r.country, r.ticket_url) for r in feeds.from_feed_b(rows).orderBy("seq").collect()] == [(0, "Nine Owls", "20:00", "DE", "o"), (4, "Nine Owls", None, "DE", "u")]
    unnamed = frame(spark, {"datetime": "2026-05-01", "venue": v, "lineup": ["L"]}, queried="")
    assert feeds.from_feed_b(unnamed).first().artist == "L"


def test_feed_c(spark):
    v = {"name": "Hall", "address": {"city": "T", "country": "DE"}}
    base = {"start_date": "2026-05-01", "start_time": "8:00", "primary_venue": v}
    names = ["NINE OWLS: live", "Nine Owlets", "Tribute to Nine Owls", "nine owls", None, "Nine Owls"]
    rows = frame(spark, *[base | {"name": n, "is_online_event": i == 5} for i, n in enumerate(names)], base | {"name": "Nine Owls", "primary_venue": None})
    assert [(r.artist, r.start_time) for r in feeds.from_feed_c(rows).orderBy("seq").collect()] == [("NINE OWLS: live", "8:00"), ("nine owls", "8:00")]
