"""Sites whose listings need more than a selector a field: each is a set of rules for a common reader, not a program.

A field's rule is the text of nodes (``css``, ``first``), without or with blanks around child nodes (``drop``, ``part``), an
attribute of them (``attr``) or of the nearest ancestor that has it (``up``), cut to what a pattern finds (``find``). A date's
pattern names its day, month and year; a year that is missing is that of a node of the page, of the page's neighbours, or the
next in which the month comes. All sites are read in one narrow pass over pages that say which site they are of.
"""

from __future__ import annotations

import datetime
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.dates import MONTHS
from eventlake.sources.html import FIELDS, Node, absolute, dig, parse, selector

MONTH_WORDS = MONTHS | {"jänner": "01"}
YMD, DMY = r"(?P<y>\d{4})-?(?P<m>\d{2})-?(?P<d>\d{2})", r"(?P<d>\d{1,2})\.(?P<m>\d{1,2})\.(?P<y>\d{4})"
# Where the sites have what.
SITES = {
    "a38-ship-budapest": {"block": "a.eventCard", "artist": {"css": ".eventCard__details__title"}, "date": {"css": "meta[itemprop=startDate]", "attr": "content", "find": rf"^{YMD}"}, "skip": ["høt spøt", "hot spot", "every wednesday"]},
    "akbank-sanat-istanbul": {"block": "div[data-category]", "artist": {"css": "p:nth-of-type(2) span:nth-of-type(2)"}, "date": {"up": "data-day"}, "page_year": "select#cf-year option[selected]", "time": {"css": "p.hour"}, "link": None},
    "akvarium-klub-budapest": {"block": "a.grid-item.m-card", "artist": {"css": ".m-card__description .h5"}, "date": {"css": ".date__day, .date__month", "order": [".date__day", ".date__month"], "find": r"^(?P<d>\d{1,2})\.? (?P<m>\w+)"}},
    "club-quattro-umeda-osaka": {"block": "li.list-item", "artist": {"css": "p.txt-01 span.hv-elm"}, "date": {"attr": "data-event-date"}, "link": {"css": "a.event-box"}},
    "drugstore-belgrade": {"block": "h2.entry-title a", "artist": {"drop": "span"}, "date": {"css": "span"}},
    "flex-vienna": {"block": ".ewpe-inner-wrapper", "artist": {"css": ".ewpe-event-title", "first": True}, "date": {"css": ".ewpe-events-schedule", "first": True, "find": r"(?P<d>\d{1,2})\.\s+(?P<m>[a-zäöüß]+)"}, "link": {"css": "a.event-link"}},
    "jazz-cafe-london": {"block": "li.event", "artist": {"css": "h2.event-title"}, "date": {"css": ".event-date", "part": "span"}, "link": {"css": "a"}, "skip": ["soul city", "every saturday"]},
    "kitty-su-bangalore": {"block": "ul.event-list > li", "artist": {"css": ".event-list-text h3", "find": r"^\s*([^|]*[^|\s])"}, "only": {"css": ".event-list-text h3", "find": r"(?i)^[^|]*(?:\|\s*(?:bangalore\s*(?:\|.*)?)?)?$"}, "date": {"css": ".event-list-text p", "find": r"^[^|]*\|[^|]*\|[^|]*?(\d{1,2}\s+\w+)"}, "this_year": True, "link": {"css": ".event-list-img a"}},
    "kolarac-concert-hall-belgrade": {"block": "article.post", "artist": {"css": "h3.entry-title a", "first": True, "attr": "title", "or_text": True, "find": r"^\s*(.*?\S)\s*(?=\d{1,2}\s+\S+\s+\d{4}\s+at\s+\d)"}, "date": {"css": "h3.entry-title a", "first": True, "attr": "title", "or_text": True, "find": r"(\d{1,2}\s+\S+\s+\d{4}\s+at\s+\d{1,2})"}, "link": {"css": "h3.entry-title a"}},
    "lacigale-paris": {"block": "li.artiste-event__item", "artist": {"css": "h3.artiste-event__title"}, "date": {"attr": "data-date", "find": rf"^{YMD}$"}, "link": {"css": "a.artiste-event__link"}},
    "liquidroom-tokyo": {"block": "article", "artist": {"css": "h2", "first": True}, "date": {"css": "a.s_link", "first": True, "attr": "href", "find": rf"_{YMD}/?$"}, "link": {"css": "a.s_link"}},
    "lucerna-music-bar-prague": {"block": "a.program-item", "artist": {"css": "p", "first": True}, "date": {"css": "[class$=timestamp]", "first": True, "find": rf"^\s*{DMY}"}, "skip": ["video party"]},
    "meetfactory-prague": {"block": '.action-boxes [itemscope][itemtype="http://schema.org/Event"]', "artist": {"css": ".abb-text h3 [itemprop=name]", "first": True}, "date": {"css": "meta[itemprop=startDate]", "attr": "content", "find": rf"^{YMD}"}, "link": {"css": "a.abbl-detail, h3 a", "order": ["a.abbl-detail", "h3 a"]}},
    "melkweg-amsterdam": {"script": "script#__NEXT_DATA__", "path": "props.pageProps.pageData.attributes.content", "within": ("attributes.layout", "agenda", "attributes.initialEvents"), "artist": "attributes.name", "date": "attributes.startDate", "link": ["attributes.url"]},
    "sagres-campo-pequeno-lisbon": {"block": "div.event", "artist": {"css": ".card-title"}, "date": {"css": ".date", "find": r"^(?P<m>\d{1,2})\.(?P<d>\d{1,2})\.(?P<y>\d{4})$"}, "link": {"css": "a"}},
    "sala-apolo-barcelona": {"block": "div.c-results__event", "artist": {"css": "a.c-results__event__title"}, "date": {"css": "a.c-results__event__title", "first": True, "attr": "href", "find": rf"{YMD}-\d+$"}, "link": {"css": "a.c-results__event__title"}},
    "so36-berlin": {"path": "products", "artist": "title", "date": "valid_start_on", "link": ["url"], "only": [("supertitle", "Konzert")]},
    "tolhuistuin-amsterdam": {"script": "agenda-filter-component", "attr": ":all-items", "path": "", "artist": "title", "date": "eventStartDate", "link": ["ticketLink", "url"], "only": [("eventType.label", "Muziek"), ("eventType.value", "muziekPerformance")]},
    "vintazh-tour": {"board": ".t396__artboard", "title": "АФИША", "artist": "Винтаж", "half": 500, "place_within": 60, "button_within": 80},
    "wuk-vienna": {"block": ".event-list-item", "artist": {"css": "h2 a", "first": True}, "date": {"css": ".event-list-item-meta-info", "find": DMY}, "link": {"css": "h2 a"}},
    "www-shibuya-tokyo": {"block": "#eventList article.column", "artist": {"css": "h3.title", "first": True}, "date": {"css": ".date .day", "first": True, "find": r"^(?P<d>\d{1,2})"}, "neighbours": True, "link": {"css": "a.pageLink"}},
    "zhenya-trofimov-tour": {"block": ".t-rec", "artist": {"const": "Комната культуры"}, "date": {"css": '.tn-elem[data-elem-id="1709639269253"]'}, "city": {"css": '.tn-elem[data-elem-id="1709639269261"]'}, "venue": {"css": '.tn-elem[data-elem-id="1709639269247"]'}, "link": {"css": ".tn-elem[data-elem-type=button] a"}, "lands": True},
}
SITES["komnata-kultury-tour"] = SITES["zhenya-trofimov-tour"]
# Towns and countries by a word of a tour's place, in this order.
TOWNS = [("москва", "Москва", "RU"), ("санкт-петербург", "Санкт-Петербург", "RU"), ("спб", "Санкт-Петербург", "RU"), ("кишинев", "Кишинев", "MD"), ("кипр", "Кипр", "CY")]
LANDS = [("казахстан", "KZ"), ("беларусь", "BY")]


def _squeezed(text: str) -> str:
    return " ".join(text.split())


def _text(n: Node, drop: str | None = None, part: str | None = None) -> str:
    out, away, apart = [], {id(x) for x in selector(drop).select(n)} if drop else set(), {id(x) for x in selector(part).select(n)} if part else set()
    stack: list = [n]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif id(x) not in away:
            stack.extend([" ", *reversed(x.texts), " "] if id(x) in apart else reversed(x.texts))
    return _squeezed("".join(out))


def _nodes(block: Node, rule: dict) -> list[Node]:
    if "order" in rule:
        return [n for css in rule["order"] for n in selector(css).select(block)]
    found = selector(rule["css"]).select(block) if "css" in rule else [block]
    return found[:1] if rule.get("first") else found


def _read(block: Node, rule: dict) -> str:
    if "const" in rule:
        return rule["const"]
    if "up" in rule:
        n = block.parent
        while n is not None and not n.attrs.get(rule["up"]):
            n = n.parent
        return n.attrs[rule["up"]] if n is not None else ""
    nodes = _nodes(block, rule)
    if "attr" in rule:
        value = next((n.attrs[rule["attr"]] for n in nodes[:1] if n.attrs.get(rule["attr"])), "")
        if value or not rule.get("or_text"):
            return value.strip()
    return " ".join(t for n in nodes if (t := _text(n, rule.get("drop"), rule.get("part"))))


def _iso(text: str, pattern: str | None, today: datetime.date, page: tuple[int, int] | None) -> str:
    """What a pattern finds of a date: of named parts an ISO date, else its group; all of the text without a pattern."""
    if not pattern:
        return text
    m = re.search(pattern, text.lower())
    if not m:
        return ""
    parts = m.groupdict()
    if "d" not in parts:
        return re.search(pattern, text)[1] if re.search(pattern, text) else m[1]
    month = parts.get("m")
    month = (month if month.isdigit() else MONTH_WORDS.get(month)) if month else (str(page[1]) if page else None)
    if month is None:
        return ""
    year = parts.get("y") or (str(page[0]) if page and not parts.get("m") else str(today.year + (int(month) < today.month)))
    return f"{year}-{int(month):02}-{int(parts['d']):02}"


def _neighbours(root: Node) -> tuple[int, int] | None:
    """Year and month of a page: the month before that of its last link to another month's page."""
    months = [m for a in selector('a.pageLink[href*="/schedule/20"]').select(root) if (m := re.search(r"schedule/(\d{4})(\d{2})\.php", a.attrs["href"]))]
    at = int(months[-1][1]) * 12 + int(months[-1][2]) - 2 if months else None
    return None if at is None else (at // 12, at % 12 + 1)


def _by_rules(root: Node, url: str | None, s: dict, today: datetime.date) -> list[dict]:
    page = _neighbours(root) if s.get("neighbours") else None
    if s.get("neighbours") and page is None:
        return []
    year = next((n.attrs.get("value") or n.text().strip() for n in selector(s["page_year"]).select(root)), str(today.year)) if "page_year" in s else None
    out = []
    for block in selector(s["block"]).select(root):
        if "only" in s and not re.search(s["only"]["find"], _read(block, s["only"])):
            continue
        artist = _read(block, s["artist"])
        if "find" in s["artist"]:
            m = re.search(s["artist"]["find"], artist)
            artist = m[1].strip() if m else ""
        date = _iso(_read(block, s["date"]), s["date"].get("find"), today, page)
        if date and year:
            date = " ".join(filter(None, (f"{date}.{year}", _read(block, s["time"]))))
        if date and s.get("this_year"):
            date = f"{date} {today.year}"
        if not artist or not date or any(w in artist.lower() for w in s.get("skip", ())):
            continue
        row = dict.fromkeys(FIELDS, "") | {"artist": artist, "date": date, "link": None}
        for f in ("venue", "city"):
            if f in s:
                row[f] = _read(block, s[f])
        if s.get("lands"):
            row["country"] = "RU"
            for word, land in LANDS:
                if word in row["city"].lower():
                    row["country"], row["city"] = land, re.sub(rf",\s*{word}", "", row["city"], flags=re.I).strip()
        rule = s.get("link", {})
        if rule is not None:
            href = next((n.attrs["href"] for n in _nodes(block, rule) if n.attrs.get("href")), None)
            row["link"] = absolute(href, url)
        out.append(row)
    return out


def _by_json(root: Node | None, body: str, url: str | None, s: dict) -> list[dict]:
    if "script" in s:
        hits = selector(s["script"]).select(root)
        body = (hits[0].attrs.get(s["attr"], "") if "attr" in s else hits[0].text()) if hits else ""
    try:
        items = json.loads(body)
    except ValueError:
        return []
    items = dig(items, s["path"]) if s["path"] else items
    if "within" in s and isinstance(items, list):
        key, want, inner = s["within"]
        items = dig(next((b for b in items if dig(b, key) == want), items[0] if items else None), inner)
    out = []
    for i in items if isinstance(items, list) else []:
        if "only" in s and not any(dig(i, p) == v for p, v in s["only"]):
            continue
        artist, date = (str(dig(i, s[f]) or "").strip() for f in ("artist", "date"))
        if artist and date:
            out.append(dict.fromkeys(FIELDS, "") | {"artist": artist, "date": date, "link": absolute(next((str(v) for p in s["link"] if (v := dig(i, p))), None), url)})
    return out


def _by_place(root: Node, url: str | None, s: dict) -> list[dict]:
    """Rows of a board on which a date's place and button are those not far above or below it in the same column, the first of each."""
    out = []
    for board in selector(s["board"]).select(root):
        if s["title"] not in board.text():
            continue
        found = []
        for n in selector(".tn-elem").select(board):
            at = [int(m[0]) if (m := re.match(r"-?\d+", n.attrs.get(f"data-field-{side}-value", ""))) else 0 for side in ("top", "left")]
            found.append((n.attrs.get("data-elem-type", ""), at[0], at[1], _text(n, part="br"), next((a.attrs["href"] for a in selector("a").select(n) if a.attrs.get("href")), None)))
        for right in (False, True):
            column = [f for f in found if (f[2] >= s["half"]) == right]
            dated = re.compile(r"\d{2}\.\d{2}")
            places = [f for f in column if f[0] == "text" and f[3] and not dated.fullmatch(f[3]) and f[3] != s["title"]]
            for _, top, _, text, _ in (f for f in column if f[0] == "text" and dated.fullmatch(f[3])):
                place = next((p[3] for p in places if abs(p[1] - top) < s["place_within"]), None)
                if place is None:
                    continue
                link = next((f[4] for f in column if f[0] == "button" and f[4] and abs(f[1] - top) < s["button_within"]), None)
                city, venue, land = _place(place)
                out.append({"artist": s["artist"], "date": text, "venue": venue, "city": city, "country": land, "link": absolute(link, url)})
    return out


def _place(text: str) -> tuple[str, str, str]:
    """Town, venue and country of a tour's place."""
    for word, city, land in TOWNS:
        if word in text.lower():
            return city, re.sub(r"[\s,–-]+", " ", re.sub(word, "", text, count=1, flags=re.I)).strip(), land
    if "турция" in text.lower():
        m = re.search(r"турция,\s*(kemer|belek|side)?\s*(.*)", text, re.I)
        return ((m[1] or "Turkey").capitalize(), m[2].strip(), "TR") if m else ("Turkey", re.sub("турция", "", text, flags=re.I).strip(), "TR")
    return text, text, "RU"


def by_site(site: str, html: str | None, url: str | None, today: datetime.date) -> list[dict]:
    """Rows of a page of a site; a page that is empty, of an unknown site or of another shape has none."""
    s = SITES.get(site)
    if s is None or not html:
        return []
    if "path" in s:
        return _by_json(parse(html) if "script" in s else None, html, url, s)
    root = parse(html)
    return _by_place(root, url, s) if "board" in s else _by_rules(root, url, s, today)


def read_sites(pages: DataFrame, today: Column, page_col: str = "page_id") -> DataFrame:
    """(page_col, site, pos, FIELDS...) of the listings of pages (page_col, site, html, url), each by its site's rules.

    Null and empty pages and unknown sites yield none; what a site does not say of venue, town and country is empty.
    """

    def run(batches):
        for b in batches:
            keys, rows = [], []
            for key, site, html, url, day in zip(*[b.column(i).to_pylist() for i in range(5)]):
                got = by_site(site, html, url, day) if day is not None else []
                keys += [(key, site, i) for i in range(len(got))]
                rows += got
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], b.schema.field(0).type), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.int32()), *[pa.array([r[x] for r in rows], pa.string()) for x in FIELDS]], names=[page_col, "site", "pos", *FIELDS])

    kind = pages.schema[page_col].dataType.simpleString()
    return pages.select(page_col, "site", "html", "url", today.cast("date").alias("_today")).mapInArrow(run, f"`{page_col}` {kind}, site string, pos int, " + ", ".join(f"{x} string" for x in FIELDS))
