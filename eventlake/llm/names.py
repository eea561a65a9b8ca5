"""Names as people type them: what decorates them is stripped, what is left becomes a signature.

A signature has the stems (the rare words that tell acts or towns apart), the role words (first names, band nouns,
articles of place: words that many names share, taken from the data), numbers and initials. Words are compared as
skeletons: case, accents, script, doubled letters and interchangeable spellings (f/ph, v/w, i/y/j, k/c/q) are folded.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

from eventlake.llm.clean import LOOKALIKES, unmangle

# Transliteration of Cyrillic and Greek letters.
CYRILLIC = dict(zip("абвгдезийклмнопрстуфхцчшщъыьэюяёіїєґўјљњћђџ", "a b v g d e z i i k l m n o p r s t u f h c ch sh sch  y  e iu ia e i i e g u i l n c d dz".split(" ")))
CYRILLIC["ж"] = "zh"
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a v g d e z i th i k l m n x o p r s s t i f h ps o".split()))
LETTERS = CYRILLIC | GREEK | {"ø": "o", "ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ð": "d", "þ": "th", "ı": "i"}
LEET = str.maketrans("013457", "oieast")
# Short forms of first names.
NICKNAMES = {
    "alexander": "alex sasha sandro xander sandy lex al alec", "anastasia": "stacy nastya ana stasia asya", "josefina": "josie fina pepa jo pepita", "robert": "rob bob bobby bert robbie", "nikolai": "nick kolya niko nik nico",
    "elisabeth": "betty liz beth elsa lisa lise eliza bess lizzy ella", "guadalupe": "lupe pita lupita", "michael": "mike mick misha micky mikey", "william": "will bill billy willy liam willie", "wilhelmina": "willa mina minnie vilma wilma helma",
    "margarethe": "greta gretchen rita maggie margo gretel grete meg peggy", "katarina": "katya kat kate katja rina kati kathy", "theodora": "thea dora theo teddy", "johannes": "hans jan johann hannes jo joe", "francisco": "paco pancho fran cisco kiko frank", "christopher": "chris kit topher christo",
}
# Abbreviations of words in names of acts and of places.
SHORT = {"bros": "brothers", "dept": "department", "ens": "ensemble", "orch": "orchestra", "phil": "philharmonic", "coll": "collective", "co": "company", "qt": "quartet", "qtt": "quartet", "mt": "mount", "st": "saint", "pt": "port", "n": "new", "b": "bad"}
JOINS = {"&", "+", "and", "y", "ы", "n'", "n’", "und", "et", "i", "анд", "и", "’n’", "'n'", "'n"}

# What surrounds the name of an act.
_LEAD = re.compile(r"^\s*(?:[\[(](?:postponed|cancelled|canceled|new date|verlegt|rescheduled|sold out)[\])]\s*|an evening with\s+|\((?:band|банд|live)\)\s*|live[:!]\s+|★+\s*|[*~•\"“”«»]+\s*|(?:presents|pres\.):?\s+)", re.I)
_TAIL = re.compile(
    r"(?:\s*[-–—|:(\[]*\s*sold\s*out\s*[)\]!]*|\s*[(\[](?:live|band|банд|official|support|dj set|solo|acoustic|[a-z]{2})[)\]]|\s+[|–—-]\s+(?:world\s+)?tour(?:\s+\d{4})?|\s+tour\s+\d{4}|\s+[-–—|]\s+live(?:\s+(?:at|in|@)\s+.*)?|\s+live\s+(?:at|in)\s+.*"
    r"|\s*[-–—|,(]*\s*(?:special\s+guests?|support|supported\s+by|guest)\s*:.*|\s+(?:w/|feat\.?|ft\.?|featuring)\s+.*|\s+[-–—]\s+(?:postponed|cancelled)\s*|\s*★+|\s*[*~•\"“”«»]+|[\s.,;!]+)$",
    re.I,
)
_TRIBUTE = re.compile(r"\btribute\b|\bcovers?\b|\bcover(?:ed)? (?:night|band|show|version)|^\s*(?:the\s+)?(?:fake|almost|ultimate|counterfeit|not quite|bootleg|faux)\s+\S|\bexperience\s*(?:\(|$)|\bplays? the music of\b|\bperform(?:s|ed by)\b|\bsalute to\b|\bhommage?\b|\bhomage\b|\bimpersonator", re.I)
_EVENT = re.compile(r"\b(?:vol|no)\.?\s*\d|#\s*\d|\s@\s|\b(?:open mic|karaoke|jam session|quiz night|silent disco|drag bingo|salsa class|film screening|record fair|vinyl market|techno brunch|kids matinee|ballroom lesson|stand-up special)\b", re.I)
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*\.?|[&+]")


class Name(NamedTuple):
    stems: tuple[str, ...]
    roles: tuple[str, ...]
    numbers: tuple[str, ...]
    initials: tuple[str, ...]
    tribute: bool = False

    @property
    def key(self) -> str:
        return " ".join((*self.stems, "|", *self.roles, "|", *self.numbers, "|", *self.initials, "!" if self.tribute else ""))

    @property
    def frame(self) -> str:
        """All but the stems: what must be equal exactly."""
        return f"{len(self.stems)}|{' '.join(self.roles)}|{' '.join(self.numbers)}|{' '.join(self.initials)}|{self.tribute}"


@lru_cache(maxsize=200_000)
def latin(word: str) -> str:
    """Lower-case Latin letters of a word; a digit among letters is the letter it looks like."""
    letters = [c for c in word if c.isalpha()]
    foreign = sum("Ͱ" <= c <= "ԯ" for c in letters)
    if foreign and 2 * foreign <= len(letters):
        word = word.translate(LOOKALIKES)
    word = "".join(LETTERS.get(c, c) for c in word.casefold())
    word = "".join(LETTERS.get(c, c) for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))
    return word.translate(LEET) if letters and not word.isalpha() else word


@lru_cache(maxsize=200_000)
def skeleton(word: str) -> str:
    """The letters of a word as far as spelling does not vary them."""
    s = "".join(c for c in latin(word) if c.isalnum())
    if s.isdigit():
        return s
    s = s.replace("sch", "s").replace("ph", "f").replace("th", "t").replace("ch", "!").replace("ck", "k").replace("qu", "ku")
    s = s.replace("c", "k").replace("q", "k").replace("x", "ks").replace("w", "v").replace("y", "i").replace("j", "i").replace("!", "c")
    return re.sub(r"(.)\1+", r"\1", s)


def edits(a: str, b: str, limit: int) -> int:
    """Unrestricted Damerau-Levenshtein distance (a swap of neighbours is one edit; a metric), or limit + 1 if it is more than ``limit``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    i, end = 0, min(len(a), len(b))
    while i < end and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    i, end = 0, min(len(a), len(b))
    while i < end and a[-1 - i] == b[-1 - i]:
        i += 1
    if i:
        a, b = a[:-i], b[:-i]
    if not a or not b:
        return max(len(a), len(b))
    n, m, far = len(a), len(b), limit + 1
    rows = [{j: j for j in range(min(m, limit) + 1)}]  # of each row only the columns within ``limit`` of the diagonal
    seen: dict[str, int] = {}
    for i in range(1, n + 1):
        row, before, met, x = {}, rows[-1], 0, a[i - 1]
        if i <= limit:
            row[0] = i
        for j in range(max(1, i - limit), min(m, i + limit) + 1):
            y = b[j - 1]
            d = min(before.get(j, far) + 1, row.get(j - 1, far) + 1, before.get(j - 1, far) + (x != y))
            up = seen.get(y, 0)
            if up and met:
                d = min(d, rows[up - 1].get(met - 1, far) + (i - up - 1) + 1 + (j - met - 1))
            if x == y:
                met = j
            row[j] = d
        seen[x] = i
        rows.append(row)
    return min(rows[-1].get(m, far), far)


def reach(n: int) -> int:
    """Edits within which two stems of about n letters are taken as one."""
    return 0 if n <= 3 else 1 if n <= 5 else 2


PIVOTS = "abcdefghijklmnopqrstuvwxyz"


def cells(stem: str, r: int) -> dict[str, str]:
    """The cells of a stem under pivots and, of each, the letters in which it is farther than the stem; any two stems at most r edits apart share a cell.

    A pivot is one letter repeated more often than any stem is long, or a class of six of the characters beyond a to z. The
    distance to it is its length less how often the stem has that letter, so no distance need be computed. A stem's own cell is
    its distances to all pivots, written as the letters it has, sorted. By the triangle inequality stems at most r apart differ
    by at most r from pivot to pivot; as the same holds of the pivots that mix several letters, the sum of what one stem is
    farther from the pivots than the other is at most r, in either direction. Both are therefore replicated to the cells at most
    r farther from the pivots, and meet in that of the greater distances. A stem has at most 561 cells for r = 2, however long.
    """
    s = "".join(sorted(c if c in PIVOTS else chr(48 + ord(c) % 6) for c in stem))
    out = last = {s: ""}
    for _ in range(r):
        last = {t[:i] + t[i + 1 :]: g + c for t, g in last.items() for i, c in enumerate(t) if not i or c != t[i - 1]}
        out = out | last
    return out


class Near:
    """Words within an edit distance of a word, by pivots."""

    def __init__(self, words, r: int = 2):
        self.at: dict[str, list[str]] = {}
        for w in sorted(set(words)):
            for c in cells(w, r):
                self.at.setdefault(c, []).append(w)

    def of(self, word: str, limit: int) -> list[tuple[int, str]]:
        """(edits, word) of the words at most ``limit`` (and at most the index's r) away, in order."""
        met = {w for c in cells(word, limit) for w in self.at.get(c, ())}
        return sorted((d, w) for w in met if (d := edits(word, w, limit)) <= limit)


def _uncased(word: str) -> str:
    body = word[1:]
    return word.swapcase() if word[:1].islower() and sum(c.isupper() for c in body) > max(1, len(body) // 2) else word


class Roles:
    """The words many names share, by skeleton, and their typed forms."""

    def __init__(self, words: list[str]):
        self.words: dict[str, str] = {}
        for w in [*(f for f in NICKNAMES if f in words), *sorted(words)]:  # of words with one skeleton a first name's usual form, else the first
            if len(skeleton(w)) > 1 and not skeleton(w).isdigit():
                self.words.setdefault(skeleton(w), latin(w))
        self.words.pop("te", None)
        self.short = {k: v for k, v in SHORT.items() if skeleton(v) in self.words}
        self.nick = {skeleton(n): f for f, ns in NICKNAMES.items() if skeleton(f) in self.words for n in ns.split()}
        self.near, self.typed, self.nicknames = Near(w for w in self.words if len(w) > 3), Near(w for w in self.words.values() if len(w) > 4), Near((n for n in self.nick if len(n) >= 4), 1)
        self.ends = sorted((x for x in self.words if len(x) >= 5), key=lambda x: (len(x), x))
        self.known: dict[str, str | None] = {}

    def role(self, word: str) -> str | None:
        """The shared word this one is, if it is one: as is, shortened, or with a typo."""
        key = word.rstrip(".").lower()
        if word in self.known:
            return self.known[word]
        s = skeleton(word)
        found = self.short.get(key) or self.nick.get(s) or self.words.get(s)
        if not found and len(s) >= 4:
            near = [(d, w) for d, w in self.near.of(s, 1 if len(s) <= 6 else 2) if d <= 1 or len(w) >= 6]
            found = self.words[near[0][1]] if near else None
            if not found:
                typed = latin(word.rstrip("."))
                near = self.typed.of(typed, 1 if len(typed) <= 6 else 2)
                found = near[0][1] if near else None
            if not found and len(s) <= 8:
                near = self.nicknames.of(s, 1)
                found = self.nick[min(w for _, w in near)] if near else None
        if len(self.known) > 500_000:
            self.known.clear()
        self.known[word] = found
        return found


def normal(text: str) -> str:
    """A text with its damage repaired, in compatibility form, underlines as blanks."""
    return unicodedata.normalize("NFKC", unmangle(text)).replace("_", " ").replace("‐", "-").strip()


def stripped(text: str) -> str:
    """A name without its decorations and additions."""
    text = normal(text)
    while True:
        cut = _LEAD.sub("", text)
        cut = _TAIL.sub("", cut).strip()
        if cut == text or not cut:
            return text
        text = cut


def place_core(text: str) -> tuple[str, str]:
    """A town as typed without what follows a comma, postal code, bracket or dash, and what followed the comma."""
    core = re.sub(r"\s*\(.*?\)\s*$|\s+-\s+[^-]*$|^\s*\d{4,6}\s+", "", unmangle(text))
    head, _, tail = core.partition(",")
    return (head, tail) if head.strip() else (core, "")


NOWHERE = re.compile(r"^\s*(?:online|virtual|live ?stream|secret location|tba|tbc|tbd|various(?: cities)?|n/?a|unknown|-+|\?+)?\s*$", re.I)


def split(text: str) -> list[str]:
    """The words of a stripped name; words run together are parted at a capital, short ones of typing mistakes are not."""
    out = []
    for w in WORD.findall(text):
        w = _uncased(w)
        at = [i for i in range(4, len(w) - 1) if w[i].isupper() and w[i - 1].islower()]
        out += [w[: at[0]], w[at[0] :]] if len(at) == 1 else [w]
    return out


def parse(text: str, roles: Roles, place: bool = False, strip: bool = True) -> Name:
    """The signature of a name, without its decorations or (not ``strip``) with all of its words."""
    tribute = bool(not place and _TRIBUTE.search(unmangle(text)))
    text = stripped(text) if strip else normal(text)
    if re.search(r"[\w]\s*-\s*\w", text):
        text = re.sub(r"(?<=\w)\s*-\s*(?=\w)", " ", text)
    words = split(text)
    stems, found, numbers, initials = [], set(), [], []
    for i, w in enumerate(words):
        low = w.lower()
        if low in JOINS or (low == "n" and i and len(words) > i + 1):
            if not place:
                found.add("and")
            continue
        if w.isdigit():
            numbers.append(w.lstrip("0") or "0")
            continue
        s = skeleton(w)
        if not s:
            continue
        if s == "te" or (s not in roles.nick and len(low.rstrip(".")) <= 4 and not w.endswith(".") and edits(latin(low), "the", 1) <= 1):
            continue
        if len(s) == 1 and s.isalpha():
            if w.endswith(".") and place and (r := [x for x in ("san", "saint") if low[0] == "s"]):
                found.add("s.")
            else:
                initials.append(latin(low)[0])
            continue
        r = roles.role(w)
        if r is None and len(s) >= 9:  # words run together without a capital
            r2 = next((x for x in roles.ends if s.endswith(x) and len(s) - len(x) >= 4), None)
            if r2:
                found.add(roles.words[r2])
                stems.append(s[: -len(r2)])
                continue
        if r is None and place and len(s) <= 3:  # a short word of place misspelt
            near = sorted((edits(s, x, 1), x) for x in roles.words if len(x) == 3 and x[0] == s[0] and edits(s, x, 1) <= 1)
            r = roles.words[near[0][1]] if near else None
        if r is not None:
            found.add(r)
        else:
            stems.append(s)
    if not stems and found:
        found |= {f"#{len(found)}"}
    return Name(tuple(sorted(stems)), tuple(sorted(found)), tuple(sorted(numbers)), tuple(sorted(initials)), tribute)


def stem_distance(a: Name, b: Name) -> int | None:
    """Edits between the stems of two names, None if they are too far apart or not as many."""
    if len(a.stems) != len(b.stems):
        return None
    total = 0
    for x, y in zip(a.stems, b.stems):
        limit = reach(max(len(x), len(y)))
        d = edits(x, y, limit)
        if d > limit:
            return None
        total += d
    return total if total <= 2 else None


def roles_agree(a: Name, b: Name) -> bool:
    """The same shared words, where an initial stands for a first name."""
    if a.roles == b.roles and a.initials == b.initials:
        return True
    for x, y in ((a, b), (b, a)):
        if len(x.initials) == 1 and not y.initials:
            extra = set(y.roles) - set(x.roles)
            if not set(x.roles) - set(y.roles) and len(extra) == 1 and next(iter(extra))[0] == x.initials[0]:
                return True
    return False
