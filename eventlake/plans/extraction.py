"""Queries on extraction: pages and bodies are written from raw listings, and what is read back must be those listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.session import spread, table
from eventlake.sources import html, sites
from eventlake.sources.raw_event import ORACLE, raw_events

QUERIES: dict = {}
SQL: dict = {}
_WANT = f"WITH {ORACLE} SELECT seq, artist, date, venue, city, country, ticket_url AS link FROM raw_event"


def _rows(spark, sf_dir):
    return raw_events(spark, sf_dir).select("seq", "artist", "date", "venue", "city", "country", "ticket_url", F.lit("https://page.example/list").alias("url"))


def _read(pages, kind, selectors):
    return html.extract(pages, kind, selectors, page_col="seq").select("seq", "artist", "date", "venue", "city", "country", "link")


SELECTORS = {"block": "ul.list > li:has(a.t), ul.list > li.plain", "artist": ".a b", "date": "span[data-f=date]", "venue": "p:first-of-type", "city": "p:nth-of-type(2)", "country": "p + p + p", "link": "a.t"}
PATHS = {"block": "data.items", "artist": "who[0].name", "date": "when", "venue": "at.name", "city": "at.city", "country": "at.country", "link": "url"}


def s17(spark, sf_dir):
    """Selectors over a page for each listing."""
    link = F.when(F.col("ticket_url").isNotNull(), F.concat(F.lit('<a class="t x" href="'), F.col("ticket_url"), F.lit('">go</a>'))).otherwise(F.lit(""))
    page = F.concat(
        F.lit('<html><body><ul class="list"><li class="plain"><div class="a"> <b>'), F.col("artist"), F.lit('</b></div><span data-f="date">'), F.col("date"), F.lit("</span><p>"), F.col("venue"), F.lit("<p>"), F.col("city"),
        F.lit("<p>"), F.col("country"), F.lit("</p>"), link, F.lit("</ul><script>var li = '<li>';</script></body></html>"),
    )
    return _read(_rows(spark, sf_dir).withColumn("html", page), "static_selectors", SELECTORS)


def _body():
    return F.to_json(
        F.struct(F.struct(F.array(F.struct(F.array(F.struct(F.col("artist").alias("name"))).alias("who"), F.col("date").alias("when"), F.struct(F.col("venue").alias("name"), "city", "country").alias("at"), F.col("ticket_url").alias("url"))).alias("items")).alias("data"))
    )


def s18(spark, sf_dir):
    """Dotted paths into a JSON body for each listing."""
    return _read(_rows(spark, sf_dir).withColumn("html", _body()), "json_api", PATHS)


def s19(spark, sf_dir):
    """The same in a page's hydration data."""
    page = F.concat(F.lit('<div id="__next"></div><script id="__NEXT_DATA__" type="application/json">'), _body(), F.lit("</script>"))
    return _read(_rows(spark, sf_dir).withColumn("html", page), "next_data", PATHS)


def s20(spark, sf_dir):
    """schema.org markup for each listing, in a graph and after a block that does not parse; names of countries are not taken."""
    node = F.to_json(F.struct(F.array(F.struct(
        F.array(F.lit("Thing"), F.lit("MusicEvent")).alias("@type"), F.struct(F.col("artist").alias("name")).alias("performer"), F.col("date").alias("startDate"),
        F.struct(F.col("venue").alias("name"), F.struct(F.col("city").alias("addressLocality"), F.col("country").alias("addressCountry")).alias("address")).alias("location"), F.array(F.struct(F.col("ticket_url").alias("url"))).alias("offers"),
    )).alias("@graph")))
    page = F.concat(F.lit('<script type="application/ld+json">{broken</script><script type="application/ld+json"><![CDATA['), node, F.lit("]]></script>"))
    return _read(_rows(spark, sf_dir).withColumn("html", page), "jsonld", {"country_fallback": "ZZ"})


def s22(spark, sf_dir):
    """Selectors first, markup where they yield nothing: listings with a link are on pages of the first kind, others of the second."""
    rows = _rows(spark, sf_dir)
    first = F.concat(F.lit("<ul class='list'><li class='plain'><div class='a'><b>"), F.col("artist"), F.lit("</b></div><span data-f='date'>"), F.col("date"), F.lit("</span></li></ul>"))
    second = F.concat(F.lit('<script type="application/ld+json">'), F.to_json(F.struct(F.lit("Event").alias("@type"), F.col("artist").alias("name"), F.col("date").alias("startDate"))), F.lit("</script>"))
    pages = rows.withColumn("html", F.when(F.col("ticket_url").isNotNull(), first).otherwise(second))
    return html.cascade(pages, [("static_selectors", SELECTORS), ("jsonld", {})], page_col="seq").select("seq", "artist", "date", "strategy")


def s23(spark, sf_dir):
    """Pages that are empty until their scripts run, and the state a page carries."""
    rows = _rows(spark, sf_dir)
    page = F.when(F.col("ticket_url").isNull(), F.lit('<body><div class="c" id="root"> </div></body>')).otherwise(F.concat(F.lit("<p>x</p><script>window.__SERVER_DATA__ = "), _body(), F.lit(";\n</script>")))
    return rows.select("seq", html.client_rendered(page).alias("client"), F.get_json_object(html.embedded_state(page), "$.data.items[0].when").alias("day"))


for _f, _n in ((s17, "S17_selectors"), (s18, "S18_json_paths"), (s19, "S19_hydration")):
    QUERIES[_n], SQL[_n] = _f, _WANT
QUERIES |= {"S20_markup": s20, "S22_cascade": s22, "S23_client_rendered": s23}
SQL |= {
    "S20_markup": f"WITH {ORACLE} SELECT seq, artist, date, venue, city, CASE WHEN length(country) = 2 THEN country ELSE 'ZZ' END AS country, ticket_url AS link FROM raw_event",
    "S22_cascade": f"WITH {ORACLE} SELECT seq, artist, date, CASE WHEN ticket_url IS NULL THEN 1 ELSE 0 END AS strategy FROM raw_event",
    "S23_client_rendered": f"WITH {ORACLE} SELECT seq, ticket_url IS NULL AS client, CASE WHEN ticket_url IS NOT NULL THEN date END AS day FROM raw_event",
}


# ------------------------------------------------------------------ sites
def _pages():
    """(site, page, listed) with {a} for the act, {y}, {m}, {d} for the date, {w} for its German month and {n}, {p} for the year (20 years on) and month of the next page; ``listed`` is the date as it is read."""
    iso = "{y}-{m}-{d}"
    return [
        ("a38-ship-budapest", '<a class="eventCard x" href="/e/1"><p class="eventCard__details__title"> {a} </p><meta itemprop="startDate" content="{y}-{m}-{d}T20:00"></a><a class="eventCard" href="/e/2"><p class="eventCard__details__title">Hot Spot</p><meta itemprop="startDate" content="{y}-{m}-{d}"></a>', iso),
        ("akbank-sanat-istanbul", '<select id="cf-year"><option value="1">1</option><option selected value="{y}">x</option></select><div data-day="{d}.{m}"><div><div data-category="c"><p>k</p><p><span>s</span><span>{a}</span></p><p class="hour">20:30</p></div></div></div>', "{d}.{m}.{y} 20:30"),
        ("club-quattro-umeda-osaka", '<li class="list-item" data-event-date="{y}-{m}-{d}"><a class="event-box" href="/e/1"><p class="txt-01"><span class="hv-elm">{a}</span></p></a></li>', iso),
        ("drugstore-belgrade", '<h2 class="entry-title"><a href="/e/1">{a} <span>{d}/{m}/{y}</span></a></h2>', "{d}/{m}/{y}"),
        ("jazz-cafe-london", '<li class="event"><h2 class="event-title">{a}</h2><div class="event-date">Tue<span>{d}</span>Jul</div><a href="/e/1">go</a></li>', "Tue {d} Jul"),
        ("kolarac-concert-hall-belgrade", '<article class="post"><h3 class="entry-title"><a href="/e/1" title="{a} {d} {w} {y} at 20">t</a></h3></article>', "{d} {w} {y} at 20"),
        ("lacigale-paris", '<li class="artiste-event__item" data-date="{y}{m}{d}"><h3 class="artiste-event__title">{a}</h3><a class="artiste-event__link" href="/e/1">go</a></li><li class="artiste-event__item" data-date="?"><h3 class="artiste-event__title">x</h3></li>', iso),
        ("liquidroom-tokyo", '<article><a class="s_link" href="/e_{y}{m}{d}/"><h2>{a}</h2></a></article>', iso),
        ("lucerna-music-bar-prague", '<a class="program-item" href="/e/1"><span class="x timestamp">{d}.{m}.{y}</span><p>{a}</p></a>', iso),
        ("meetfactory-prague", '<div class="action-boxes"><div itemscope itemtype="http://schema.org/Event"><div class="abb-text"><h3><a href="/e/1"><span itemprop="name">{a}</span></a></h3></div><meta itemprop="startDate" content="{y}-{m}-{d}"></div></div>', iso),
        ("melkweg-amsterdam", '<script id="__NEXT_DATA__">{"props":{"pageProps":{"pageData":{"attributes":{"content":[{"attributes":{"layout":"hero"}},{"attributes":{"layout":"agenda","initialEvents":[{"attributes":{"name":"{a}","startDate":"{y}-{m}-{d}","url":"/e/1"}}]}}]}}}}}</script>', iso),
        ("sagres-campo-pequeno-lisbon", '<div class="event"><h5 class="card-title">{a}</h5><span class="date">{m}.{d}.{y}</span><a href="/e/1">go</a></div>', iso),
        ("sala-apolo-barcelona", '<div class="c-results__event"><a class="c-results__event__title" href="/e/{y}{m}{d}-77"> {a} </a></div>', iso),
        ("so36-berlin", '{"products":[{"supertitle":"Party","title":"x","valid_start_on":"y"},{"supertitle":"Konzert","title":" {a}","valid_start_on":"{y}-{m}-{d}","url":"/e/1"}]}', iso),
        ("tolhuistuin-amsterdam", "<agenda-filter-component :all-items='[{\"title\":\"{a}\",\"eventStartDate\":\"{y}-{m}-{d}\",\"eventType\":{\"label\":\"Muziek\"},\"url\":\"/e/1\"},{\"title\":\"x\",\"eventStartDate\":\"y\",\"eventType\":{\"label\":\"Film\"}}]'></agenda-filter-component>", iso),
        ("wuk-vienna", '<div class="event-list-item"><h2><a href="/e/1">{a}</a></h2><p class="event-list-item-meta-info">am {d}.{m}.{y}, 20 Uhr</p></div>', iso),
        ("www-shibuya-tokyo", '<a class="pageLink" href="/schedule/200001.php">p</a><div id="eventList"><article class="column"><h3 class="title">{a}</h3><p class="date"><span class="day">{d}</span></p><a class="pageLink" href="/e/1">go</a></article></div><a class="pageLink" href="/schedule/{n}{p}.php">n</a>', "{y}+20-{m}-{d}"),
        ("flex-vienna", '<div class="ewpe-inner-wrapper"><a class="event-link" href="/e/1"><p class="ewpe-event-title">{a}</p></a><p class="ewpe-events-schedule">Fr {d}. {w}</p></div>', "next-{m}-{d}"),
        ("akvarium-klub-budapest", '<a class="grid-item m-card" href="/e/1"><div class="m-card__description"><p class="h5">{a}</p></div><span class="date__month">{w}.</span><span class="date__day">{d}.</span></a>', "next-{m}-{d}"),
        ("kitty-su-bangalore", '<ul class="event-list"><li><div class="event-list-img"><a href="/e/1">i</a></div><div class="event-list-text"><h3>{a} | Bangalore</h3><p>x | y | {d} {w} - z</p></div></li><li><div class="event-list-text"><h3>o | Delhi</h3><p>x | y | 1 May</p></div></li></ul>', "{d} {w} 1998"),
        ("vintazh-tour", '<div class="t396__artboard">АФИША<div class="tn-elem" data-elem-type="text" data-field-top-value="100" data-field-left-value="20">{d}.{m}</div><div class="tn-elem" data-elem-type="text" data-field-top-value="150" data-field-left-value="20">Москва, {a}</div><div class="tn-elem" data-elem-type="text" data-field-top-value="101" data-field-left-value="600">nowhere near</div><div class="tn-elem" data-elem-type="button" data-field-top-value="170" data-field-left-value="20"><a href="/e/1">go</a></div></div>', "{d}.{m}"),
        ("zhenya-trofimov-tour", '<div class="t-rec"><div class="tn-elem" data-elem-id="1709639269253">{d}.{m}</div><div class="tn-elem" data-elem-id="1709639269261">Minsk, Беларусь</div><div class="tn-elem" data-elem-id="1709639269247">{a}</div><div class="tn-elem" data-elem-type="button"><a href="/e/1">go</a></div></div>', "{d}.{m}"),
        ("komnata-kultury-tour", '<div class="t-rec"><div class="tn-elem" data-elem-id="1709639269253">{d}.{m}</div><div class="tn-elem" data-elem-id="1709639269261">Omsk</div><div class="tn-elem" data-elem-id="1709639269247">{a}</div></div>', "{d}.{m}"),
    ]


_GERMAN = "januar,februar,märz,april,mai,juni,juli,august,september,oktober,november,dezember"
_ENGLISH = "january,february,march,april,may,june,july,august,september,october,november,december"


def s26(spark, sf_dir):
    """A page of each site's shape for every order, read by the site's rules on 15 June 1998."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("Act "), F.col("o_custkey").cast("string")).alias("act"), "o_orderdate"))
    day, pages = F.col("o_orderdate"), _pages()
    after = F.add_months(F.trunc(day, "month"), 1)
    site = F.pmod("o_orderkey", F.lit(len(pages))).cast("int")
    german = F.col("site").isin("flex-vienna")
    words = {"a": F.col("act"), "y": F.date_format(day, "yyyy"), "m": F.date_format(day, "MM"), "d": F.date_format(day, "dd"), "n": (F.year(after) + 20).cast("string"), "p": F.date_format(after, "MM")}
    words["w"] = F.when(german, F.split_part(F.lit(_GERMAN), F.lit(","), F.month(day))).otherwise(F.split_part(F.lit(_ENGLISH), F.lit(","), F.month(day)))
    html = F.element_at(F.array(*[F.lit(p) for _, p, _ in pages]), site + 1)
    df = o.withColumn("site", F.element_at(F.array(*[F.lit(n) for n, _, _ in pages]), site + 1)).withColumn("html", html)
    for k, v in words.items():
        df = df.withColumn("html", F.replace("html", F.lit("{" + k + "}"), v))
    got = sites.read_sites(df.withColumn("url", F.lit("https://site.example/list")), F.lit("1998-06-15"), "o_orderkey")
    return got.select("o_orderkey", "site", "artist", "date", "venue", "city", "country", "link")


def _s26_sql() -> str:
    pages = _pages()
    names, dates_ = (", ".join("'" + p[i].replace("'", "''") + "'" for p in pages) for i in (0, 2))
    date = f"[{dates_}][k + 1]"
    for key, value in {"y": "strftime(o_orderdate, '%Y')", "m": "strftime(o_orderdate, '%m')", "d": "strftime(o_orderdate, '%d')", "w": f"CASE WHEN site = 'kolarac-concert-hall-belgrade' OR site = 'kitty-su-bangalore' THEN split_part('{_ENGLISH}', ',', month(o_orderdate)::INT) END", "next": "CASE WHEN month(o_orderdate) < 6 THEN '1999' ELSE '1998' END"}.items():
        mark = "next" if key == "next" else "{" + key + "}"
        if key == "y":
            date = f"replace({date}, '{{y}}+20', CAST(year(o_orderdate) + 20 AS VARCHAR))"
        date = f"replace({date}, '{mark}', coalesce({value}, ''))"
    link = "CASE WHEN site IN ('akbank-sanat-istanbul', 'komnata-kultury-tour') THEN NULL WHEN site = 'liquidroom-tokyo' THEN 'https://site.example/e_' || strftime(o_orderdate, '%Y%m%d') || '/' WHEN site = 'sala-apolo-barcelona' THEN 'https://site.example/e/' || strftime(o_orderdate, '%Y%m%d') || '-77' ELSE 'https://site.example/e/1' END"
    return f"""WITH o AS (SELECT *, o_orderkey % {len(pages)} AS k, 'Act ' || o_custkey AS act FROM orders), s AS (SELECT *, [{names}][k + 1] AS site FROM o)
 SELECT o_orderkey, site, CASE site WHEN 'vintazh-tour' THEN 'Винтаж' WHEN 'zhenya-trofimov-tour' THEN 'Комната культуры' WHEN 'komnata-kultury-tour' THEN 'Комната культуры' ELSE act END AS artist, {date} AS date,
 CASE site WHEN 'vintazh-tour' THEN act WHEN 'zhenya-trofimov-tour' THEN act WHEN 'komnata-kultury-tour' THEN act ELSE '' END AS venue, CASE site WHEN 'vintazh-tour' THEN 'Москва' WHEN 'zhenya-trofimov-tour' THEN 'Minsk' WHEN 'komnata-kultury-tour' THEN 'Omsk' ELSE '' END AS city,
 CASE site WHEN 'vintazh-tour' THEN 'RU' WHEN 'zhenya-trofimov-tour' THEN 'BY' WHEN 'komnata-kultury-tour' THEN 'RU' ELSE '' END AS country, {link} AS link FROM s"""


QUERIES["S26_sites"], SQL["S26_sites"] = s26, _s26_sql()
