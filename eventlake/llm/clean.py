"""Repairs of damaged text that several operators share: doubly encoded UTF-8, look-alike letters, markup."""

from __future__ import annotations

import re

# Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = str.maketrans("аеорсухіјѕԁһАЕОРСХІЈВНКМТοανιΟΑΕΗΙΚΜΝΡΤΧ", "aeopcyxijsdhAEOPCXIJBHKMToaviOAEHIKMNPTX")
_MANGLED = re.compile("[Â-ô](?:[\u0080-¿]|[€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ])+")
_MARK = re.compile(r"<[A-Za-z/!][^<>]*>")
_MIXED = re.compile(r"(?:[A-Za-z][^\W\d_]*[Ͱ-ӿ]|[Ͱ-ӿ][^\W\d_]*[A-Za-z])[^\W\d_]*")
_FOREIGN = re.compile("[Ͱ-ԯ]")


def _again(m: re.Match) -> str:
    raw = bytearray()
    for ch in m.group():
        try:
            raw += ch.encode("latin-1") if ord(ch) < 256 else ch.encode("cp1252")
        except UnicodeEncodeError:
            return m.group()
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return m.group()


def unmangle(text: str) -> str:
    """UTF-8 read as Latin-1 or Windows-1252, read rightly."""
    return text if text.isascii() else _MANGLED.sub(_again, text)


def fold_lookalikes(text: str) -> str:
    """Latin letters for look-alikes in words that mix scripts; words wholly in another script stay."""
    return _MIXED.sub(lambda m: m.group().translate(LOOKALIKES), text) if _FOREIGN.search(text) else text


def plain(text: str) -> str:
    """``text`` without damage and markup."""
    text = fold_lookalikes(unmangle(text))
    return _MARK.sub(" ", text) if "<" in text else text
