"""Country names and codes."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# English and native country names and their two-letter codes.
NAMES = {
    "germany": "DE", "deutschland": "DE", "france": "FR", "frankreich": "FR", "italy": "IT", "italia": "IT", "italien": "IT", "spain": "ES", "españa": "ES", "spanien": "ES", "united kingdom": "GB", "great britain": "GB", "uk": "GB", "england": "GB", "scotland": "GB", "wales": "GB",
    "poland": "PL", "polska": "PL", "portugal": "PT", "sweden": "SE", "sverige": "SE", "greece": "GR", "ελλάδα": "GR", "hellas": "GR", "canada": "CA", "australia": "AU", "united states": "US", "united states of america": "US", "usa": "US", "south africa": "ZA", "finland": "FI", "suomi": "FI",
    "brazil": "BR", "brasil": "BR", "india": "IN", "new zealand": "NZ", "aotearoa": "NZ", "nepal": "NP", "japan": "JP", "日本": "JP", "argentina": "AR", "austria": "AT", "österreich": "AT", "switzerland": "CH", "schweiz": "CH", "suisse": "CH", "netherlands": "NL", "the netherlands": "NL", "nederland": "NL",
    "belgium": "BE", "belgique": "BE", "belgië": "BE", "denmark": "DK", "danmark": "DK", "norway": "NO", "norge": "NO", "iceland": "IS", "ireland": "IE", "czech republic": "CZ", "czechia": "CZ", "česko": "CZ", "slovakia": "SK", "hungary": "HU", "magyarország": "HU", "romania": "RO", "bulgaria": "BG", "serbia": "RS",
    "croatia": "HR", "hrvatska": "HR", "slovenia": "SI", "ukraine": "UA", "russia": "RU", "россия": "RU", "turkey": "TR", "türkiye": "TR", "israel": "IL", "mexico": "MX", "méxico": "MX", "chile": "CL", "colombia": "CO", "peru": "PE", "china": "CN", "south korea": "KR", "singapore": "SG", "thailand": "TH", "indonesia": "ID",
    "estonia": "EE", "latvia": "LV", "lithuania": "LT", "luxembourg": "LU", "georgia": "GE", "armenia": "AM", "kazakhstan": "KZ", "montenegro": "ME", "north macedonia": "MK", "bosnia and herzegovina": "BA", "albania": "AL", "cyprus": "CY", "malta": "MT", "belarus": "BY", "moldova": "MD", "united arab emirates": "AE", "morocco": "MA", "egypt": "EG", "kenya": "KE", "nigeria": "NG",
}

# Further names of countries in feeds, as they are written there.
ALIASES = {
    "turkey": "TR", "türkiye": "TR", "russia": "RU", "south korea": "KR", "north korea": "KP", "czech republic": "CZ", "czechia": "CZ", "usa": "US", "united states of america": "US", "uk": "GB", "vietnam": "VN", "laos": "LA", "syria": "SY", "taiwan": "TW", "macau": "MO",
    "ivory coast": "CI", "democratic republic of the congo": "CD", "republic of the congo": "CG", "bolivia": "BO", "venezuela": "VE", "tanzania": "TZ", "moldova": "MD",
    "日本": "JP", "中国": "CN", "中國": "CN", "대한민국": "KR", "한국": "KR", "台灣": "TW", "台湾": "TW", "香港": "HK", "ประเทศไทย": "TH", "ไทย": "TH", "россия": "RU", "deutschland": "DE", "españa": "ES", "méxico": "MX", "brasil": "BR",
}
OWN = {"the netherlands": "NL"}  # beyond those


@lru_cache(maxsize=1)
def feed_names() -> dict[str, str]:
    """Lower-case English names of all countries, as the JVM's locale data has them, and :data:`ALIASES`, with their codes."""
    locale = SparkSession.active()._jvm.java.util.Locale
    english = locale.ENGLISH
    return {locale("", c).getDisplayCountry(english).lower(): c for c in locale.getISOCountries()} | ALIASES | OWN


def code_of(name: str | None) -> str | None:
    """The two-letter code a country is written as or named by; null if it is neither."""
    if not name or not name.strip():
        return None
    n = name.strip()
    known = NAMES.get(n.lower())
    return known or (n.upper() if len(n) == 2 and n.isascii() and n.isalpha() else None)


def country_code(c: Column) -> Column:
    """:func:`code_of` as a column expression."""
    n = F.trim(c)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv]), F.lower(n)), F.when(n.rlike("^[A-Za-z]{2}$"), F.upper(n)))
