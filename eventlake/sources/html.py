"""Listings out of pages: CSS selectors, schema.org markup, hydration data and JSON bodies.

Pages are parsed in Arrow batches, one call a batch; every extractor is a narrow ``mapInArrow`` or a plain expression, so
extraction never shuffles. What a page yields are rows; a page that cannot be read yields none and stops nothing.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOID = set("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY = {"li": {"li"}, "p": {"p", "div", "ul", "ol", "table", "section", "article", "h1", "h2", "h3"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
# Types of schema.org that are events.
EVENT_TYPES = {"event", "musicevent", "festival", "musicfestival", "theaterevent", "danceevent", "comedyevent", "socialevent"}
FIELDS = ("artist", "date", "venue", "city", "country", "link")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "texts")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node] = []
        self.texts: list = []  # strings and nodes in order

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack.extend(reversed(n.texts))
        return "".join(out)

    def walk(self):
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            yield n
            stack.extend(reversed(n.children))


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        while self.at.tag in CLOSED_BY and tag in CLOSED_BY[self.at.tag]:
            self.at = self.at.parent
        n = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(n)
        self.at.texts.append(n)
        if tag not in VOID:
            self.at = n

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        n = self.at
        while n and n.tag != tag:
            n = n.parent
        if n and n.parent:
            self.at = n.parent

    def handle_data(self, data):
        self.at.texts.append(data)


def parse(html: str) -> Node:
    t = _Tree()
    t.feed(html or "")
    t.close()
    return t.root


_SIMPLE = re.compile(r"""(?P<tag>\*|[a-zA-Z][\w-]*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[*^$~|]?=)\s*(?:"(?P<v1>[^"]*)"|'(?P<v2>[^']*)'|(?P<v3>[^\]\s]+))\s*)?\]|:(?P<pseudo>[\w-]+)(?P<paren>\()?""")


def _closing(s: str, i: int) -> int:
    depth = 1
    while i < len(s) and depth:
        depth += {"(": 1, ")": -1}.get(s[i], 0)
        i += 1
    return i


def _top(s: str, sep: str) -> list[str]:
    """``s`` parted at a character outside of brackets and quotes."""
    out, depth, start, quote = [], 0, 0, ""
    for i, c in enumerate(s):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif c == sep and not depth:
            out.append(s[start:i])
            start = i + 1
    return [*out, s[start:]]


def _nth(n: int, formula: str) -> bool:
    f = {"odd": "2n+1", "even": "2n"}.get(formula.strip(), formula.strip()).replace(" ", "")
    if "n" not in f:
        return f.lstrip("+-").isdigit() and n == int(f)
    a, b = f.split("n", 1)
    step, off = int(a + "1" if a in ("", "+", "-") else a), int(b or 0)
    return (n - off) % step == 0 and (n - off) // step >= 0 if step else n == off


class Selector:
    """Descendant, child and sibling combinators; tags, ids, classes, attributes, :has, :not, :contains and the positional pseudo-classes."""

    def __init__(self, css: str):
        self.options = [self._chain(s.strip()) for s in _top(css, ",") if s.strip()]

    @staticmethod
    def _chain(s: str) -> list[tuple[str, list]]:
        chain, link, i = [], " ", 0
        while i < len(s):
            if m := re.match(r"\s*([>+~])\s*|\s+", s[i:]):
                link, i = (m.group(1) or " "), i + m.end()
            tests = []
            while m := _SIMPLE.match(s, i):
                i, d = m.end(), m.groupdict()
                if d["tag"]:
                    tests.append(("tag", d["tag"].lower()))
                elif d["id"]:
                    tests.append(("attr", "id", "=", d["id"]))
                elif d["cls"]:
                    tests.append(("attr", "class", "~=", d["cls"]))
                elif d["attr"]:
                    tests.append(("attr", d["attr"].lower(), d["op"], next((v for v in (d["v1"], d["v2"], d["v3"]) if v is not None), "")))
                else:
                    inner = ""
                    if d["paren"]:
                        end = _closing(s, i)
                        inner, i = s[i : end - 1], end
                    tests.append(("pseudo", d["pseudo"], Selector(inner) if d["pseudo"] in ("has", "not") else inner.strip().strip("\"'")))
            if not tests:
                raise ValueError(f"selector {s!r}")
            chain.append((link, tests))
            link = " "
        return chain

    def _fits(self, n: Node, tests: list) -> bool:
        for t in tests:
            if t[0] == "tag":
                if t[1] not in ("*", n.tag):
                    return False
            elif t[0] == "attr":
                v = n.attrs.get(t[1])
                if v is None:
                    return False
                ok = {None: True, "=": v == t[3], "*=": t[3] in v, "^=": v.startswith(t[3]), "$=": v.endswith(t[3]), "~=": t[3] in v.split(), "|=": v == t[3] or v.startswith(t[3] + "-")}[t[2]]
                if not ok:
                    return False
            else:
                same = n.parent.children if n.parent else [n]
                kind = [x for x in same if x.tag == n.tag]
                name, arg = t[1], t[2]
                ok = {
                    "has": lambda: bool(arg.select(n)), "not": lambda: not arg.matches(n), "contains": lambda: arg in n.text(), "first-child": lambda: same[0] is n, "last-child": lambda: same[-1] is n,
                    "first-of-type": lambda: kind[0] is n, "last-of-type": lambda: kind[-1] is n, "nth-child": lambda: _nth(same.index(n) + 1, arg), "nth-of-type": lambda: _nth(kind.index(n) + 1, arg),
                }.get(name, lambda: False)()
                if not ok:
                    return False
        return True

    def _ends(self, n: Node, chain: list, k: int) -> bool:
        link, tests = chain[k]
        if not self._fits(n, tests):
            return False
        if k == 0:
            return True
        if link == ">":
            return n.parent is not None and n.parent.tag != "#root" and self._ends(n.parent, chain, k - 1)
        if link in "+~":
            before = n.parent.children[: n.parent.children.index(n)] if n.parent else []
            return any(self._ends(x, chain, k - 1) for x in (before[-1:] if link == "+" else before))
        p = n.parent
        while p is not None and p.tag != "#root":
            if self._ends(p, chain, k - 1):
                return True
            p = p.parent
        return False

    def matches(self, n: Node) -> bool:
        return any(self._ends(n, c, len(c) - 1) for c in self.options)

    def select(self, root: Node) -> list[Node]:
        return [n for n in root.walk() if self.matches(n)]


@lru_cache(maxsize=4096)
def selector(css: str) -> Selector:
    return Selector(css)


def absolute(href: str | None, base: str | None) -> str | None:
    """An http(s) address, resolved against the page's; null for any other scheme."""
    if not href:
        return None
    try:
        url = urljoin(base or "", href.strip())
        parts = urlsplit(url)
    except ValueError:
        return None
    return url if parts.scheme in ("http", "https") and parts.hostname else None


def by_selectors(html: str, url: str | None, s: dict) -> list[dict]:
    """Rows of a page by selectors: ``block`` and one for each field; all matches' texts of a field are joined."""
    out = []
    for block in selector(s["block"]).select(parse(html)):
        def read(field: str, block: Node = block) -> str:
            return "".join(n.text() for n in selector(s[field]).select(block)).strip() if s.get(field) else ""

        row = {f: read(f) or (s.get(f"{f}_fallback") or "") for f in FIELDS[:5]}
        if not row["artist"] or not row["date"]:
            continue
        hits = selector(s["link"]).select(block) if s.get("link") else []
        href = hits[0].attrs.get("href") if hits else block.attrs.get("href") if block.tag == "a" else None
        out.append(row | {"link": absolute(href, url)})
    return out


def as_text(v) -> str:
    """A value of schema.org as text: the first of several, the name of an object, the digits of a number."""
    for _ in range(64):
        if isinstance(v, list):
            v = v[0] if v else None
        elif isinstance(v, dict):
            v = v.get("name") if v.get("name") is not None else v.get("@value")
        else:
            break
    if isinstance(v, str):
        return v.strip()
    return "" if v is None or isinstance(v, (bool, list, dict)) else f"{v:g}" if isinstance(v, float) else str(v)


def event_nodes(tree) -> list[dict]:
    """Nodes of an event type, found through lists, graphs and parts, parents before their parts."""
    out, stack = [], [tree]
    while stack:
        n = stack.pop()
        if isinstance(n, list):
            stack.extend(reversed(n))
        elif isinstance(n, dict):
            kind = n.get("@type")
            if any(isinstance(k, str) and k.lower() in EVENT_TYPES for k in (kind if isinstance(kind, list) else [kind])):
                out.append(n)
            stack.extend(reversed([p for p in (n.get("@graph") if isinstance(n.get("@graph"), list) else None, n.get("subEvent"), n.get("events")) if p]))
    return out


def by_markup(html: str, url: str | None, s: dict) -> list[dict]:
    """Rows of a page's schema.org blocks; blocks that are no JSON are passed over."""
    out = []
    for script in selector('script[type="application/ld+json"]').select(parse(html)):
        body = re.sub(r"^\s*<!\[CDATA\[|\]\]>\s*$", "", script.text()).strip()
        try:
            tree = json.loads(body)
        except ValueError:
            continue
        for n in event_nodes(tree):
            artist = as_text(n.get("performer") if n.get("performer") is not None else n.get("performers")) or as_text(n.get("name"))
            date = as_text(n.get("startDate")) or as_text(n.get("doorTime"))
            if not artist or not date:
                continue
            place = n.get("location")
            while isinstance(place, list):
                place = place[0] if place else None
            place = place if isinstance(place, dict) else {}
            address = place.get("address") if isinstance(place.get("address"), dict) else {}
            land = as_text(address.get("addressCountry"))
            offers = n.get("offers") if isinstance(n.get("offers"), list) else [n.get("offers")]
            href = next((as_text(o["url"]) for o in offers if isinstance(o, dict) and o.get("url")), "") or as_text(n.get("url"))
            out.append({
                "artist": artist, "date": date, "venue": as_text(place.get("name")) or s.get("venue_fallback") or "", "city": as_text(address.get("addressLocality")) or s.get("city_fallback") or "",
                "country": land if re.fullmatch("[A-Za-z]{2}", land) else s.get("country_fallback") or "", "link": absolute(href, url),
            })
    return out


def dig(tree, path: str | None):
    """The value at a dotted path with indexes in brackets, null if it is not there."""
    for key in re.findall(r"[^.\[\]]+", path or ""):
        if isinstance(tree, list) and key.isdigit() and int(key) < len(tree):
            tree = tree[int(key)]
        elif isinstance(tree, dict) and key in tree:
            tree = tree[key]
        else:
            return None
    return tree


def by_paths(tree, url: str | None, s: dict) -> list[dict]:
    """Rows of a JSON body: ``block`` leads to the events (one object counts as one), the fields' paths to texts; 0, false and null are no text."""
    events = dig(tree, s.get("block"))
    out = []
    for e in events if isinstance(events, list) else [] if events is None else [events]:
        read = lambda f, e=e: str(v).strip() if s.get(f) and (v := dig(e, s[f])) else s.get(f"{f}_fallback") or ""
        row = {f: read(f) for f in FIELDS[:5]}
        if row["artist"] and row["date"]:
            out.append(row | {"link": absolute(read("link"), url)})
    return out


def by_body(body: str, url: str | None, s: dict) -> list[dict]:
    try:
        return by_paths(json.loads(body or ""), url, s)
    except ValueError:
        return []


def by_hydration(html: str, url: str | None, s: dict) -> list[dict]:
    """Rows of the data a page carries for its scripts."""
    hits = selector("script#__NEXT_DATA__, script#__NUXT_DATA__").select(parse(html))
    return by_body(hits[0].text(), url, s) if hits else []


EXTRACTORS = {"static_selectors": by_selectors, "jsonld": by_markup, "json_api": by_body, "next_data": by_hydration}


def register(kind: str):
    """Adds an extractor, a function of (html, url, selectors) that returns rows of FIELDS, under a name of its own."""

    def keep(f):
        EXTRACTORS[kind] = f
        return f

    return keep


def extract(pages: DataFrame, kind: str, selectors: dict, page_col: str = "page_id", html_col: str = "html", url_col: str | None = "url") -> DataFrame:
    """(page_col, pos, FIELDS...) of the listings of each page by one kind of extractor; null and empty pages yield none."""
    f = EXTRACTORS[kind]

    def run(batches):
        for b in batches:
            keys, rows = [], []
            for key, html, url in zip(*[b.column(i).to_pylist() for i in range(3)]):
                got = f(html, url, selectors) if html else []
                keys += [(key, i) for i in range(len(got))]
                rows += got
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], b.schema.field(0).type), pa.array([i for _, i in keys], pa.int32()), *[pa.array([r[x] for r in rows], pa.string()) for x in FIELDS]], names=[page_col, "pos", *FIELDS])

    kind_ = pages.schema[page_col].dataType.simpleString()
    return pages.select(page_col, html_col, F.col(url_col) if url_col else F.lit(None).cast("string").alias("url")).mapInArrow(run, f"`{page_col}` {kind_}, pos int, " + ", ".join(f"{x} string" for x in FIELDS))


def cascade(pages: DataFrame, strategies: list[tuple[str, dict]], page_col: str = "page_id", **columns) -> DataFrame:
    """Rows of the first strategy that yields any, page by page, with its place in ``strategy``."""
    done = None
    for i, (kind, s) in enumerate(strategies):
        rest = pages if done is None else pages.join(done.select(page_col).distinct(), page_col, "left_anti")
        got = extract(rest, kind, s, page_col, **columns).withColumn("strategy", F.lit(i))
        done = got if done is None else done.unionByName(got)
    return done


def client_rendered(html: Column | str) -> Column:
    """A page that is empty until its scripts run: hydration data, or a root element without content."""
    h = F.col(html) if isinstance(html, str) else html
    return h.rlike(r"__NEXT_DATA__|__NUXT__|window\.__INITIAL_STATE__") | h.rlike(r"(?i)<div[^>]+id=[\"'](root|app|__next)[\"'][^>]*>\s*</div>")


def embedded_state(html: Column | str, name: str = "__SERVER_DATA__") -> Column:
    """The JSON text a page assigns to a window variable, null if there is none or it does not parse."""
    h = F.col(html) if isinstance(html, str) else html
    body = F.nullif(F.regexp_extract(h, rf"(?s)window\.{name}\s*=\s*(\{{.*?\}});?[^\S\n]*(?:\n|</script>)", 1), F.lit(""))
    return F.when(F.try_parse_json(body).isNotNull(), body)


def without_scripts(html: Column | str) -> Column:
    h = F.col(html) if isinstance(html, str) else html
    return F.regexp_replace(F.regexp_replace(h, r"(?is)<script[^>]*>.*?</script>", ""), r"(?is)<style[^>]*>.*?</style>", "")
