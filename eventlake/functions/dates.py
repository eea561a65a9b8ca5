"""Free-text dates of several languages, by a ladder of patterns of which the first that yields a text decides.

A branch yields a text, not a date: what an early branch reads as 30 February is no date and must not fall through to
a later one. The whole ladder is one JVM expression next to the scan; branches after the deciding one are not evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.text import WS, lookup, trim
from eventlake.session import broadcast_if_small, cut, spread

GRACE_DAYS = 31  # a date without a year stays in the base year if it is no more days past
# Month words (English, German, Dutch, Serbian, Spanish, Croatian, Russian).
MONTHS = {
    "jan": "01", "januar": "01", "january": "01", "januari": "01", "ene": "01", "enero": "01", "январь": "01", "января": "01",
    "feb": "02", "februar": "02", "february": "02", "februari": "02", "febrero": "02", "февраль": "02", "февраля": "02",
    "mrz": "03", "märz": "03", "mar": "03", "march": "03", "mart": "03", "maart": "03", "marzo": "03", "март": "03", "марта": "03",
    "apr": "04", "april": "04", "abr": "04", "abril": "04", "travnja": "04", "апрель": "04", "апреля": "04",
    "mai": "05", "may": "05", "mei": "05", "maj": "05", "mayo": "05", "svibnja": "05", "май": "05", "мая": "05",
    "jun": "06", "juni": "06", "june": "06", "junio": "06", "lipnja": "06", "июнь": "06", "июня": "06",
    "jul": "07", "juli": "07", "july": "07", "julio": "07", "srpnja": "07", "июль": "07", "июля": "07",
    "aug": "08", "august": "08", "avgust": "08", "augustus": "08", "ago": "08", "agosto": "08", "kolovoza": "08", "август": "08", "августа": "08",
    "sep": "09", "september": "09", "septembar": "09", "septiembre": "09", "setiembre": "09", "rujna": "09", "сентябрь": "09", "сентября": "09",
    "okt": "10", "oktober": "10", "oct": "10", "october": "10", "oktobar": "10", "octubre": "10", "listopada": "10", "октябрь": "10", "октября": "10",
    "nov": "11", "november": "11", "novembar": "11", "noviembre": "11", "studenog": "11", "studenoga": "11", "ноябрь": "11", "ноября": "11",
    "dez": "12", "dezember": "12", "dec": "12", "december": "12", "decembar": "12", "dic": "12", "diciembre": "12", "prosinca": "12", "декабрь": "12", "декабря": "12",
}
LETTERS = "[a-zа-яёäöüß]"


def _once(raw: Column, use) -> Column:
    """``use`` of the raw and the two cleaned texts, each of which is computed once a row; written out they would outgrow a compiled method."""
    s = F.replace(F.regexp_replace(trim(F.lower(raw)), ",", ""), F.lit("/"), F.lit("."))
    spaced = F.regexp_replace(s, r"^(\d{1,2})\.", "$1")
    return F.get(F.transform(F.array(F.struct(raw.alias("raw"), s.alias("s"), spaced.alias("spaced"))), lambda x: use(x["raw"], x["s"], x["spaced"])), F.lit(0))


def _ladder(raw: Column, s: Column, spaced: Column, base: Column) -> list[tuple[str, Column]]:
    """(name, text) of the branches in order; a text is null where a branch does not apply."""
    w = WS

    def part(text: Column, pattern: str, *groups: int) -> list[Column]:
        return [F.when(text.rlike(pattern), F.regexp_extract(text, pattern, g)) for g in groups]

    two = lambda c: F.lpad(c, 2, "0")
    month = lambda c: lookup(MONTHS, c)
    full = lambda y, m, d: F.concat(y, F.lit("-"), m, F.lit("-"), two(d))

    def yearless(m: Column, d: Column) -> Column:
        this = F.concat(F.year(base).cast("string"), F.lit("-"), m, F.lit("-"), two(d))
        gone = F.datediff(base, F.try_to_date(this, "yyyy-MM-dd")) > GRACE_DAYS
        return F.when(F.coalesce(gone, F.lit(False)), F.concat((F.year(base) + 1).cast("string"), F.lit("-"), m, F.lit("-"), two(d))).otherwise(this)

    # The shapes of dates that are read, in this order.
    es3, es2 = rf"^(\d{{1,2}}){w}+de{w}+([a-zà-ÿ]+){w}+de{w}+(\d{{4}})$", rf"^(\d{{1,2}}){w}+de{w}+([a-zà-ÿ]+)$"
    dots, dots2 = r"^(\d{1,2})\.(\d{1,2})\.(\d{2,4})$", r"^(\d{1,2})\.(\d{1,2})\.?$"
    dmy, mdy = rf"^(\d{{1,2}}){w}+({LETTERS}+){w}+(\d{{4}})$", rf"^({LETTERS}+){w}+(\d{{1,2}}){w}+(\d{{4}})$"
    dm, md = rf"^(\d{{1,2}}){w}+({LETTERS}+)$", rf"^({LETTERS}+){w}+(\d{{1,2}})$"
    loose = rf"(\d{{1,2}})\.?{w}+({LETTERS}+)\.?(?:{w}*-{w}*\d{{1,2}}\.?{w}+{LETTERS}+\.?)?{w}+(\d{{4}})(?![A-Za-z0-9_])"
    # The word must end where an ASCII word does: after a letter of another script that is only before an ASCII one.
    loose2 = rf"(\d{{1,2}})(?:{w}*-{w}*\d{{1,2}})?\.?{w}+({LETTERS}+)(?:(?<=[a-z])(?![A-Za-z0-9_])|(?<=[^a-z])(?=[A-Za-z0-9_]))"
    ordinal = rf"^(?:{LETTERS}+\.?{w}+)?({LETTERS}+){w}+(\d{{1,2}})(?:st|nd|rd|th)(?:{w}+(\d{{4}}))?$"
    a, b, y = part(s, dots, 1, 2, 3)
    swap = (b.cast("int") > 12) & (a.cast("int") <= 12)
    day, mon = F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b)
    d3, m3, y3 = part(s, es3, 1, 2, 3)
    d2, m2 = part(s, es2, 1, 2)
    n1, n2 = part(s, dots2, 1, 2)
    d4, m4, y4 = part(spaced, dmy, 1, 2, 3)
    m5, d5, y5 = part(spaced, mdy, 1, 2, 3)
    d6, m6 = part(spaced, dm, 1, 2)
    m7, d7 = part(spaced, md, 1, 2)
    d9, m9, y9 = part(s, loose, 1, 2, 3)
    d10, m10 = part(s, loose2, 1, 2)
    m11, d11, y11 = part(s, ordinal, 1, 2, 3)
    return [
        ("today", F.when(s.isin("today", "heute"), F.date_format(base, "yyyy-MM-dd"))),
        ("tomorrow", F.when(s.isin("tomorrow", "morgen"), F.date_format(F.date_add(base, 1), "yyyy-MM-dd"))),
        ("day de month de year", full(y3, month(m3), d3)),
        ("day de month", yearless(month(m2), d2)),
        ("iso", F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), s)),
        ("dots", F.concat(F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y), F.lit("-"), two(mon), F.lit("-"), two(day))),
        ("dots, no year", yearless(two(n2), n1)),
        ("day month year", full(y4, month(m4), d4)),
        ("month day year", full(y5, month(m5), d5)),
        ("day month", yearless(month(m6), d6)),
        ("month day", yearless(month(m7), d7)),
        ("iso prefix", F.nullif(F.regexp_extract(raw, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit(""))),
        ("loose", full(y9, month(m9), d9)),
        ("loose, no year", F.when(~s.rlike(r"\d{4}"), yearless(month(m10), d10))),
        ("ordinal", F.when(F.nullif(y11, F.lit("")).isNotNull(), full(y11, month(m11), d11)).otherwise(yearless(month(m11), d11))),
    ]


def parse_date(raw: Column | str, base: Column) -> Column:
    """The date a free text means on the day ``base`` (a date); null if none of the branches applies or there is no such day.

    Day-first throughout, except where the second number of two cannot be a month. Of natural-language forms beyond the
    ladder only English ordinals ("October 3rd 2026") are read.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    text = _once(raw, lambda *t: F.coalesce(*[c for _, c in _ladder(*t, base)]))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def with_dates(df: DataFrame, raw: str, base: Column, name: str = "day") -> DataFrame:
    """``df`` with the date of its text ``raw``: each distinct text is read once, whatever its rows, and joined back.

    Texts are few beside rows; the join is a broadcast only if a count proves them few. Null texts have no date.
    """
    texts = df.where(F.col(raw).isNotNull()).select(F.col(raw).alias("_text")).distinct()
    known = cut(spread(cut(texts)).select("_text", parse_date("_text", base).alias(name)))
    return df.join(broadcast_if_small(known), F.col(raw) == F.col("_text"), "left").drop("_text")


def date_branch(raw: Column | str, base: Column) -> Column:
    """The name of the branch that decides, null if none applies."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return _once(raw, lambda *t: F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in _ladder(*t, base)]))
