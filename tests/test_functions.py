"""Text, date and address functions, one case a line."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlake.functions import country, dates, text, urls

BASE = dt.date(2026, 7, 20)


def values(spark, column, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.v for r in df.select("i", column(F.col("x")).alias("v")).orderBy("i").collect()]


CASES = [
    (text.slug, {"The Owls": "the-owls", "Zürich_Two  Bees!": "zurichtwo-bees", "Ёлка": "елка", "A - B": "a-b", "": "artist-0", "!!!": "artist-pa9", None: None, "---": "artist-yh9"}),
    (text.clean_artist, {"Nine Owls - SOLD OUT": "Nine Owls", "Nine Owls (Sold Out)": "Nine Owls", "B-Live": "B-Live", "Nine Owls - Live at X": "Nine Owls", "Nine Owls live in Rome": "Nine Owls", "Live": "Live", "Owl - Special Guest: Z": "Owl", "Owl - Tour 26": "Owl", "Owl (support)": "Owl", "Owl (live)": "Owl", "Owl - Livery": "Owl - Livery"}),
    (text.norm_key, {"  A   b\tC ": "a b c", "": "", None: None}),
    (text.word_key, {"Éclair!": "e clair", "A.B-c": "a b c", "Ünal": "u nal"}),
    (text.country, {"Germany": "DE", "de": "DE", "UK": "GB", "Bulgaria, Plovdiv": "BG", "Slovakia (Slovak Republic)": "SK", "Atlantis": "ATLANTIS", "The Netherlands ": "NL", "Czech Republic": "CZ"}),
    (text.country_or_null, {"Deutschland": "DE", "zz": "ZZ", "Atlantis": None, "": None, "USA": "US"}),
    (text.venue_kind, {"City Stadium": "stadium", "Pub Arena": "arena", "Opera Bar": "theatre", "Barn": None, "Épub": "club", "Open Air Hall": "open-air", "Saal 3": "hall", "": None}),
    (text.embedded_time, {"2026-01-01T20:30:00": "20:30", "2026-01-01T24:30": None, "20:30": None, "T09:60": None}),
    (text.capitals, {"AbCÉ": 3, "": 0, "abc": 0}),
    (country.country_code, {"España": "ES", " gb ": "GB", "nowhere": None}),
    (urls.network, {"https://www.instagram.example/x": "instagram", "http://own.example": "website", "https://t.me/x": "telegram"}),
    (urls.host, {"HTTPS://WWW.A.example:80/x": "a.example", "ftp://a.example": None, "": None}),
    (urls.private_host, {"localhost": True, "10.1.2.3": True, "172.20.0.1": True, "172.32.0.1": False, "169.254.1.1": True, "::1": True, "[fe80::1]": True, "fd00::2": True, "2130706433": True, "0x7f000001": True, "0177.0.0.1": True, "::ffff:10.0.0.1": True, "a.example": False, "8.8.8.8": False, "fdx.example": False}),
]


@pytest.mark.parametrize("function,cases", CASES, ids=[c[0].__name__ for c in CASES])
def test_function(spark, function, cases):
    assert dict(zip(cases, values(spark, function, list(cases)))) == cases


DATES = {
    "today": "2026-07-20", "Heute": "2026-07-20", "tomorrow": "2026-07-21", "4 de mayo de 2027": "2027-05-04", "1 de enero": "2027-01-01", "2026-07-08": "2026-07-08", "17.9.26": "2026-09-17", "9/17/2026": "2026-09-17", "5.6.": "2027-06-05", "30.6": "2026-06-30",
    "12. Okt 2026": "2026-10-12", "March 5, 2027": "2027-03-05", "3 juli": "2026-07-03", "Jan 5": "2027-01-05", "2026-07-08T21:00:00Z": "2026-07-08", "Sat 12 July - 14 July 2026 doors": "2026-07-12", "Fr 24 Juli 20:00": "2026-07-24", "12 июля": "2026-07-12", "сб 12 июля 19:00": None,
    "30.2.2026": None, "2026-13-01": None, "12.7.026": None, "October 3rd 2026": "2026-10-03", "12 siječnja 2027": None, "doors 8pm": None, "": None, None: None, " 2026-07-08 20:00": None, "29 feb": None, "19 June": "2026-06-19", "18 June": "2027-06-18", "19. Juni 2026 ab 20 Uhr": "2026-06-19",
}


def test_dates(spark):
    got = values(spark, lambda c: dates.parse_date(c, F.lit(BASE)), list(DATES))
    assert {k: str(v) if v else None for k, v in zip(DATES, got)} == DATES


def test_same_site_and_paths(spark):
    pairs = {("https://www.a.example/x", "http://tour.a.example"): True, ("https://a.co.uk", "https://b.co.uk"): False, ("https://x.a.co.uk", "https://y.a.co.uk"): True, ("https://a.example", "none"): False}
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    rows = df.select("i", urls.same_site("a", "b").alias("s"), urls.home_or_same("a", "b").alias("h"), urls.path_has("b", ("tour", "live")).alias("p")).orderBy("i").collect()
    assert [r.s for r in rows] == list(pairs.values())
    assert [r.h for r in rows] == [True, True, True, True] and not any(r.p for r in rows)


def test_page_score(spark):
    page = "<style>2026 2027</style><p>Fri 12.05.2026 March tickets</p><script>2028</script>"
    assert values(spark, urls.page_score, [page, "", None]) == [2 * 1 + 2 * 1 + 1 + 0.5 + 1, 0.0, None]
