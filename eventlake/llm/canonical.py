"""Free-entered values as entries of a reference list (problem 2).

The words of a value are first read as words of the reference list, misspelt ones by an edit metric. A multi-pattern
automaton over the canonical names, their aliases and the ways a person's name is given (family name first, an initial)
then finds what is mentioned anywhere in the value; of overlapping mentions the longest wins, and the one that heads the
value is what it means, if its surroundings show that it is not part of another name. Values without such a mention go to
token-set similarity: shared words must agree as a set, rare words may differ by typing mistakes. All of it is one narrow
pass, so nothing is shuffled; a worker keeps what it has resolved.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.country import code_of
from eventlake.llm import names as N

KEEP = 200_000  # values a worker remembers
SLICE = 500_000  # entries of a reference list that a worker holds at once; longer lists are gone through slice by slice
PLACE_WORDS = ("am", "see", "sur", "mer", "san", "saint", "bad", "new", "port", "mount")
# Words that name a part or the surroundings of a town.
DISTRICT = {N.skeleton(w) for w in "nord north ost east süd sud south west centro centre center city metro area old town bay downtown mitte zentrum altstadt greater district region county".split()}
# Words that follow an act's name without a sign between, words between acts of one billing, and words that make a name another act's.
ADDED = {N.skeleton(w) for w in "live band official support solo acoustic dj set tour sold out postponed cancelled rescheduled verlegt new date special guest guests show concert at in".split()}
BETWEEN = {N.skeleton(w) for w in (*N.JOINS, "x", "vs", "versus", "meets", "b2b")}
OTHER = {N.skeleton(w) for w in "youth junior jr senior kids children revival".split()}
# What may stand before an act that heads a value, and what may begin behind it.
_BEFORE = re.compile(r"(?:^|[\])}:!★•*~\"“«]|\b(?:with|presents?|pres\.))[\W_]*$", re.I)
_BEHIND = re.compile(r"^[\s.,;!★•*~\"”»'’]*$|^\.?\s*(?:[|:/@([{★•*~\"”»–—]|[-–—,]\s+|\s-\s?|[!;]|w/|feat|ft\b|featuring|with\b)", re.I)
_PAR = re.compile(r"^\s*(?:[/&+]|\b\w+\b)\s*$")
_BRACKET = re.compile(r"^\s*[(\[{]([^)\]}]*)")
_BEFORE_TOWN, _BEHIND_TOWN = re.compile(r"^[\W\d_]*$"), re.compile(r"^[\W\d_]*$|^\s*(?:[,(/|]|[-–—]\s|\s[-–—])")


class Entry(NamedTuple):
    ref_id: int
    name: str
    country: str | None = None
    weight: int = 0


class Word(NamedTuple):
    text: str  # as a word of the reference list, if it can be read as one
    start: int
    end: int
    edits: int


class Resolver:
    """Entries by mention and by similarity; built once in each worker."""

    def __init__(self, entries: list[Entry], place: bool):
        self.place, self.entries = place, entries
        words = Counter(w for e in entries for w in {N.latin(x.rstrip(".")) for x in N.split(N.stripped(e.name))})
        self.roles = N.Roles([w for w, n in words.items() if n >= 3] + (list(PLACE_WORDS) if place else []))
        self.names = [N.parse(e.name, self.roles, place) for e in entries]
        stems = {s for n in self.names for s in n.stems}
        self.exact, self.near, self.read_as = stems | set(self.roles.words), N.Near(s for s in stems if len(s) > 3), {}
        self.firsts = {N.skeleton(n) for n in N.NICKNAMES}
        self.index: dict[str, set[int]] = {}
        self.automaton = ahocorasick.Automaton()
        spoken: dict[str, dict[int, None]] = {}
        for i, (e, n) in enumerate(zip(entries, self.names)):
            for form in self.forms([w.text for w in self.words(e.name)]):
                spoken.setdefault(form, {})[i] = None
            if n.stems:
                s = max(n.stems, key=len)
                for c in N.cells(s, N.reach(len(s))):
                    self.index.setdefault(c, set()).add(i)
        for form, at in spoken.items():
            self.automaton.add_word(f" {form} ", (form, list(at)))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.held: dict[tuple[str, str | None], tuple] = {}

    def forms(self, words: list[str]) -> list[str]:
        """The ways an entry's words are given."""
        out = [" ".join(words)] if words else []
        if not self.place and len(words) > 1 and "and" not in words:
            out.append(" ".join((words[-1], *words[:-1])))
            if len(words) == 2 and words[0] in self.firsts:
                initials = {words[0][0], N.skeleton(self.roles.words.get(words[0], words[0])[0])}
                out += [form for i in sorted(initials) for form in (f"{i} {words[1]}", f"{words[1]} {i}")]
        return out

    def read(self, word: str) -> tuple[str, int]:
        """A typed word as a word of the reference list and the edits between them; a word equally near to several, or near to none, as it is."""
        if word not in self.read_as:
            s = N.skeleton(word)
            found = (s, 0)
            if s not in self.exact or (s in self.roles.nick and s not in self.roles.words):
                role = self.roles.role(word)
                if role is not None:
                    found = (N.skeleton(role), 0)
                elif s and not s.isdigit():
                    near = self.near.of(s, N.reach(len(s)))
                    if near and (len(near) == 1 or near[0][0] < near[1][0]):
                        found = (near[0][1], near[0][0])
            if len(self.read_as) >= KEEP:
                self.read_as.clear()
            self.read_as[word] = found
        return self.read_as[word]

    def words(self, text: str) -> list[Word]:
        """The words of a text; an article belongs to the word behind it, or after a comma to the one before. Words joined by a hyphen, a capital or nothing at all are apart."""
        typed = []
        for m in N.WORD.finditer(text):
            at = m.start()
            for part in N.split(m.group()):
                typed.append((part, at, at + len(part)))
                at += len(part)
        out, article = [], None
        for k, (part, start, end) in enumerate(typed):
            if part.lower() in N.JOINS or part.lower() == "n":
                if not self.place and 0 < k < len(typed) - 1:
                    out.append(Word("and", start, end, 0))
                    continue
                if part in "&+":
                    continue
            low = part.lower().rstrip(".")
            w, d = self.read(part)
            if not w or w == "te" or (w not in self.exact and len(low) <= 4 and not part.endswith(".") and N.edits(N.latin(low), "the", 1) <= 1):
                if out and text[out[-1].end : start].strip() == ",":
                    out[-1] = out[-1]._replace(end=end)
                else:
                    article = start if article is None else article
                continue
            if article is not None:
                start, article = article, None
            if w not in self.exact and len(w) >= 9 and (tail := next((x for x in self.roles.ends if w.endswith(x) and len(w) - len(x) >= 4), None)):
                head, d = self.read(w[: -len(tail)])
                out += [Word(head, start, end, d), Word(tail, start, end, 0)]
                continue
            out.append(Word(w, start, end, d))
        return out

    def mentions(self, words: list[Word]) -> list[tuple[int, int, list[int]]]:
        """(first word, word behind the last, entries) of the longest mentions that do not overlap, in order; of equals the first is taken."""
        if not len(self.automaton) or not words:
            return []
        text, at = " ", {}
        for i, w in enumerate(words):
            at[len(text) - 1] = i
            text += w.text + " "
        found = []
        for end, (form, entries) in self.automaton.iter(text):
            first = at[end - len(form) - 1]
            found.append((first, first + form.count(" ") + 1, entries))
        taken: list[tuple[int, int, list[int]]] = []
        for m in sorted(found, key=lambda m: (m[0] - m[1], m[0])):
            if all(m[1] <= t[0] or m[0] >= t[1] for t in taken):
                taken.append(m)
        return sorted(taken)

    def mention(self, text: str, code: str | None) -> list[tuple[int, int]]:
        """(edits, entry) of the entries of the mention that heads a value.

        Before an act there may be signs, a bracket, "with" or an article; behind it a sign, a bracket that is not for another
        act, words that are additions, or words between acts and another act. Before a town there may be a postal code, behind
        it a sign or words for a part of it. Any other word refuses the mention. Misspelt towns must be in the country.
        """
        words = self.words(text)
        found = self.mentions(words)
        if not found:
            return []
        first, last, entries = found[0]
        before, behind = text[: words[first].start], text[words[last - 1].end :]
        edits = sum(w.edits for w in words[first:last])
        if edits > 2:
            return []
        if self.place:
            rest = [w.text for w in words[last:]]
            if not _BEFORE_TOWN.match(before) or not (_BEHIND_TOWN.match(behind) or all(w in DISTRICT for w in rest)):
                return []
            if edits and code:
                entries = [i for i in entries if self.entries[i].country == code]
            return [(edits, i) for i in entries]
        if not _BEFORE.search(before):
            return []
        bracket = _BRACKET.match(behind)
        if bracket and any(N.skeleton(w) in OTHER for w in N.split(bracket[1])):
            return []
        if not _BEHIND.match(behind):
            nexts = {m[0] for m in found[1:] if any(self.names[i].stems for i in m[2])}
            k = last
            while k < len(words) and words[k].text in BETWEEN:
                k += 1
            if not (k > last and k in nexts) and not (last < len(words) and words[last].text in ADDED):
                return []
        if re.match(r"^\s*,", behind) and last < len(words) and last not in {m[0] for m in found[1:]}:
            return []
        # Acts billed on a par: of those the longest.
        par, k = [found[0]], last
        for m in found[1:]:
            if any(w.text not in BETWEEN for w in words[k : m[0]]) or not _PAR.match(text[words[k - 1].end : words[m[0]].start]):
                break
            par.append(m)
            k = m[1]
        first, last, entries = min(par, key=lambda m: (-sum(len(w.text) + 1 for w in words[m[0] : m[1]]), m[0]))
        edits = sum(w.edits for w in words[first:last])
        return [(edits, i) for i in entries] if edits <= 2 else []

    def similar(self, text: str, country: str | None) -> list[tuple[int, int]]:
        """(edits, entry) of the entries whose shared words agree with all of a value's and whose rare words are within reach."""
        n = N.parse(text, self.roles, self.place, strip=False)
        tries = [n]
        if self.place:
            stems = tuple(s for s in n.stems if s not in DISTRICT)
            tries = [n._replace(stems=stems, numbers=())] + [n._replace(stems=(s,), numbers=()) for s in stems if len(stems) > 1 and len(s) > 4]
        out = []
        for t in tries:
            near: set[int] = set()
            if t.stems:
                s = max(t.stems, key=len)
                for c in N.cells(s, N.reach(len(s))):
                    near |= self.index.get(c, set())
            for i in near:
                m = self.names[i]
                agree = N.roles_agree(t, m) or (self.place and self.abbreviated(t, m))
                if agree and (self.place or t.numbers == m.numbers) and (d := N.stem_distance(t, m)) is not None:
                    if d == 0 or not self.place or not country or country == self.entries[i].country:
                        out.append((d, i))
            if out:
                break
        return out

    def abbreviated(self, a: N.Name, b: N.Name) -> bool:
        """A place whose first word is shortened (S. for San or Saint, a. for am)."""
        missing, extra = set(b.roles) - set(a.roles), set(a.roles) - set(b.roles)
        letters = [x[0] for x in extra if x.endswith(".")] + list(a.initials)
        return len(extra - {x for x in extra if x.endswith(".")}) == 0 and len(letters) == len(missing) and sorted(letters) == sorted(x[0] for x in missing)

    def resolve(self, text: str, country: str | None = None) -> tuple | None:
        """(rank, ref_id) of the entry a value means, the least rank being the best; None if it means none."""
        if (text, country) in self.held:
            return self.held[text, country]
        code, out = code_of(country), None
        if not (self.place and N.NOWHERE.match(text) or not self.place and N._TRIBUTE.search(N.unmangle(text))):
            whole = N.normal(text)
            core, tail = N.place_core(whole) if self.place else (whole, "")
            code = code or code_of(tail)
            found = self.mention(whole, code)
            best = [(0, d, i) for d, i in found] or [(1, d, i) for d, i in self.similar(core, code)]
            ranked = [((d, how, code is not None and self.entries[i].country != code, -self.entries[i].weight), self.entries[i].ref_id) for how, d, i in best]
            out = min(ranked, default=None)
        if len(self.held) >= KEEP:
            self.held.clear()
        self.held[text, country] = out
        return out


_BUILT: dict[tuple, tuple] = {}  # of a worker: the resolvers and verbatim names of the reference lists in use


def _resolvers(shared, part: int, place: bool):
    key = (id(shared), part, place)
    if key not in _BUILT:
        if len(_BUILT) >= 4:
            _BUILT.clear()
        entries, verbatim = shared.value
        _BUILT[key] = (Resolver(entries[part : part + SLICE], place), set(verbatim), len(entries), shared)  # held, so that its id is no other's
    return _BUILT[key][:3]


class Reference(NamedTuple):
    shared: object
    place: bool


def reference_list(reference: DataFrame, place: bool = False) -> Reference:
    """A reference list (ref_id, name, aliases, country, weight) for the workers. The list itself goes to every worker; its size is that of a list of names, not of the data."""
    rows = reference.where(F.col("ref_id").isNotNull()).select("ref_id", "name", "aliases", "country", "weight").collect()
    verbatim = sorted({r["name"] for r in rows if r["name"]})
    entries = [Entry(r["ref_id"], n, r["country"], r["weight"] or 0) for r in sorted(rows, key=lambda r: r["ref_id"]) for n in (r["name"], *(r["aliases"] or [])) if n]
    return Reference(reference.sparkSession.sparkContext.broadcast((entries, verbatim)), place)


def resolve_fields(values: DataFrame, lists: dict[str, Reference]) -> DataFrame:
    """(field_name, row_id, ref_id) of rows (field_name, row_id, value, country), each field by its reference list, in one pass.

    ref_id is 0 if a value means no entry. Null values are left out, as are those that are verbatim a reference name; empty
    values mean no entry. Of entries with the same name the one in the row's country, then the heavier, then the smaller id
    is meant. An empty reference list resolves everything to 0. Lists longer than SLICE are gone through slice by slice, of
    which the best entry wins; a slice sees only its own words as shared ones.
    """

    def f(batches):
        for b in batches:
            fields, keys, texts, lands = (b.column(i).to_pylist() for i in range(4))
            out_f, out_k, out_r = [], [], []
            for field, k, v, c in zip(fields, keys, texts, lands):
                if v is None:
                    continue
                shared, place = lists[field]
                resolver, verbatim, n = _resolvers(shared, 0, place)
                if v in verbatim:
                    continue
                best = resolver.resolve(v, c)
                for part in range(SLICE, n, SLICE):
                    other = _resolvers(shared, part, place)[0].resolve(v, c)
                    best = min((x for x in (best, other) if x), default=None)
                out_f.append(field), out_k.append(k), out_r.append(best[1] if best else 0)
            yield pa.RecordBatch.from_arrays([pa.array(out_f, pa.string()), pa.array(out_k, pa.int64()), pa.array(out_r, pa.int64())], names=["field_name", "row_id", "ref_id"])

    return values.select("field_name", F.col("row_id").cast("long"), "value", F.col("country").cast("string")).mapInArrow(f, "field_name string, row_id long, ref_id long")


def resolve_values(values: DataFrame, reference: DataFrame, place: bool = False) -> DataFrame:
    """(row_id, ref_id) of the rows (row_id, value, country) of ``values``; otherwise as :func:`resolve_fields`."""
    return resolve_fields(values.select(F.lit("").alias("field_name"), "row_id", "value", "country"), {"": reference_list(reference, place)}).select("row_id", "ref_id")


def artist_reference(roster: DataFrame) -> DataFrame:
    return roster.select(F.col("roster_id").alias("ref_id"), F.col("artist_name").alias("name"), F.array().cast("array<string>").alias("aliases"), F.lit(None).cast("string").alias("country"), F.lit(0).alias("weight"))


def city_reference(cities: DataFrame) -> DataFrame:
    return cities.select(F.col("city_id").alias("ref_id"), F.col("city").alias("name"), F.col("alt_names").alias("aliases"), "country", F.col("population").alias("weight"))


def meant_entries(gaps: DataFrame, changes: DataFrame, roster: DataFrame, cities: DataFrame) -> DataFrame:
    """(field_name, row_id, ref_id) for the roster gaps' names and the change entries' artists and cities."""
    none = F.lit(None).cast("string").alias("country")
    field = lambda name: F.lit(name).alias("field_name")
    gap = gaps.where(F.col("audit") == "roster").select(field("gap"), F.col("gap_id").alias("row_id"), F.col("raw_name").alias("value"), none)
    both = F.array(F.struct(field("artist"), F.col("artist").alias("value"), none), F.struct(field("city"), F.col("city").alias("value"), "country"))
    change = changes.select(F.col("entry_id").alias("row_id"), F.explode(both).alias("v")).select("v.field_name", "row_id", "v.value", "v.country")
    acts = reference_list(artist_reference(roster))
    return resolve_fields(gap.unionByName(change), {"gap": acts, "artist": acts, "city": reference_list(city_reference(cities), place=True)}).distinct()
