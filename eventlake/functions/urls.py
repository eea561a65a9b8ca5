"""Addresses and pages as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake.functions.text import B0, B1, col
from eventlake.sources.html import without_scripts

# The network a host belongs to, by what it contains, in this order.
NETWORKS = (("instagram", "instagram."), ("facebook", "facebook."), ("spotify", "spotify."), ("youtube", "youtube."), ("telegram", "t.me"), ("vk", "vk."))
SECOND_LEVEL = ("co", "com", "org", "net", "gov", "edu")
# Words that count on a page of dates.
MONTH_NAMES = "january february march april may june july august september october november december jan feb mar apr jun jul aug sept? oct nov dec janvier fevrier mars avril mai juin juillet aout septembre octobre novembre decembre januar februar marz m&auml;rz maerz juni juli september oktober dezember enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre"
DAY_NAMES = "monday tuesday wednesday thursday friday saturday sunday mon tue wed thu fri sat sun montag dienstag mittwoch donnerstag freitag samstag sonntag lunes martes miercoles jueves viernes sabado domingo lundi mardi mercredi jeudi vendredi samedi dimanche"
KEYWORDS = "ticket tickets buy venue tour gigs live show shows concert concerts event events performance performances termine schedule calendar konzert konzerte billet billets karten entradas agenda aktuellt"


def host(c: Column | str) -> Column:
    """The host of an http(s) address in lower case without www., else null."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(col(c), r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]+)", 1)), r"^www\.", ""), F.lit(""))


def network(c: Column | str) -> Column:
    """The social network an address belongs to, ``website`` if to none."""
    h, out = host(c), None
    for name, part in NETWORKS:
        hit = h.contains(part)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("website")


def registrable(h: Column) -> Column:
    parts = F.split(h, r"\.")
    n = F.when((F.size(parts) >= 3) & F.element_at(parts, -2).isin(*SECOND_LEVEL), 3).otherwise(2)
    return F.when(F.size(parts) < 2, h).otherwise(F.array_join(F.slice(parts, -F.least(n, F.size(parts)), n), "."))


def same_site(a: Column | str, b: Column | str) -> Column:
    """Equal hosts, one below the other, or both below the same registered name; false if one is no address."""
    x, y = host(a), host(b)
    dot = F.lit(".")
    return F.coalesce((x == y) | F.endswith(y, F.concat(dot, x)) | F.endswith(x, F.concat(dot, y)) | (registrable(x) == registrable(y)), F.lit(False))


def home_or_same(a: Column | str, b: Column | str) -> Column:
    """The second address is a home page, or has the path of the first; true if one is no address."""
    path = lambda c: F.regexp_replace(F.lower(F.regexp_extract(col(c), r"(?i)^https?://[^/?#]+([^?#]*)", 1)), "/+$", "")
    return host(a).isNull() | host(b).isNull() | path(b).isin("", "/index.html", "/index.php", "/home") | (path(a) == path(b))


def path_has(c: Column | str, words: tuple[str, ...]) -> Column:
    path = F.lower(F.regexp_extract(col(c), r"(?i)^https?://[^/?#]+([^?#]*)", 1))
    return F.coalesce(path.rlike("|".join(words)), F.lit(False))


def redacted(c: Column | str, keys: tuple[str, ...]) -> Column:
    return F.regexp_replace(col(c), rf"([?&](?:{'|'.join(keys)})=)[^&#]*", "$1***")


# The weights of a page's score, its years and the widgets that count as a list of dates.
YEARS, WIDGETS = "2026|2027|2028", r"(?i)widget\.bandsintown\.com|songkick\.com/widget|ticketmaster\.com/.*widget"


def page_score(html: Column | str, years: str = YEARS) -> Column:
    """How much a page looks like a list of dates; 8 and more is taken for one. Null pages score null."""
    h = col(html)
    t = F.regexp_replace(without_scripts(h), r"<[^>]+>", " ")
    n = lambda p: F.size(F.regexp_extract_all(t, F.lit(p), F.lit(0)))
    words = lambda w: n(rf"(?i){B0}(?:{'|'.join(w.split())}){B1}")
    widget = h.rlike(WIDGETS)
    return (
        2 * n(rf"{B0}(?:{years}){B1}") + 2 * n(rf"{B0}\d{{1,2}}[-/.]\d{{1,2}}[-/.]\d{{2,4}}{B1}") + words(MONTH_NAMES) + 0.5 * words(DAY_NAMES)
        + F.least(words(KEYWORDS), F.lit(5)) + F.when(widget, 8).otherwise(0)
    ).cast("double")


def private_host(c: Column | str) -> Column:
    """A host that must not be fetched: local and private names and numbers, in any spelling of them."""
    h = F.lower(F.regexp_replace(col(c), r"^\[|\]$", ""))
    v4 = F.regexp_extract(h, r"^(?:::ffff:)?(\d+\.\d+\.\d+\.\d+)$", 1)
    o = F.transform(F.split(v4, r"\."), lambda x: x.try_cast("int"))
    first, second = F.get(o, F.lit(0)), F.get(o, F.lit(1))
    private = first.isin(0, 10, 127) | ((first == 169) & (second == 254)) | ((first == 172) & second.between(16, 31)) | ((first == 192) & (second == 168))
    return (
        h.rlike(r"^localhost\.?$|\.localhost\.?$") | F.coalesce((v4 != "") & private, F.lit(False)) | h.rlike(r"^(0x[0-9a-f]+|\d+)$") | h.rlike(r"^(0[0-7x][0-9a-f]*\.){1,3}") | h.isin("::1", "::", "0:0:0:0:0:0:0:1")
        | h.rlike(r"^fe[89ab][0-9a-f]:|^f[cd][0-9a-f]{2}:") | h.rlike(r"^::ffff:[0-9a-f]{1,4}:[0-9a-f]{1,4}$")
    )
