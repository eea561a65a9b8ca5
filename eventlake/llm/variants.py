"""Variant spellings of the same name (problem 7) by metric-space partitioning.

Names become signatures (see :mod:`names`); what must be equal exactly, the shared words and numbers, splits the space
first. Within it the longest rare word is assigned to the cell of its distances to pivots and replicated to the cells beyond
its boundaries that the triangle inequality leaves possible (:func:`names.cells`); a cell is an exact radius join with a true
edit metric. Rules for what counts as a link come after it.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm import names as N
from eventlake.llm.canonical import DISTRICT, PLACE_WORDS
from eventlake.llm.components import components
from eventlake.session import cut, parallelism, stored

SHARE, LEAST = 0.001, 8  # a word can be shared if so large a share, and so many, of the distinct names have it,
PARTNERS = 5  # and is if it goes with so many different words; measured: words of one act 4 at most, shared ones 5 and more
FIXED = sorted({*N.NICKNAMES, *N.SHORT.values()} - {"new", "bad", "port", "mount", "saint"})


def _words(text: str) -> set[str]:
    return {N.latin(x.rstrip(".")) for x in N.split(N.stripped(text))}


def shared_words(distinct_names: DataFrame, place: bool = False) -> list[str]:
    """The words many of the names (name) share. At most 1 / SHARE times the words of a name come to the driver.

    A frequent act's own word is in many spellings, but with few different words, if misspelt frequent words count as what
    they are meant for. Different words are counted as the inverse of Simpson's index, so that stray ones do not add up.
    """

    def f(batches):
        for b in batches:
            c = Counter(w for t in b.column(0).to_pylist() for w in _words(t))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

    total = distinct_names.count()
    words = distinct_names.select("name").mapInArrow(f, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= max(LEAST, SHARE * total))
    often = sorted(r["word"] for r in words.collect())
    fixed = PLACE_WORDS if place else FIXED
    known = distinct_names.sparkSession.sparkContext.broadcast(sorted({s for w in (*often, *fixed) if len(s := N.skeleton(w)) > 1 and not s.isdigit()}))

    def g(batches):
        near, asked, met = N.Near(known.value), set(known.value), {}

        def meant(word):
            if word not in met:
                s = N.skeleton(word)
                met[word] = s if s in asked else next((w for _, w in near.of(s, N.reach(len(s)))), s)
            return met[word]

        for b in batches:
            c = Counter()
            for t in b.column(0).to_pylist():
                ws = {m for w in _words(t) if len(m := meant(w)) > 1 and m != "te"}
                c.update((x, y) for x in ws & asked for y in ws if x != y)
            if len(met) > 500_000:
                met.clear()
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in c], pa.string()), pa.array([y for _, y in c], pa.string()), pa.array(list(c.values()), pa.int64())], names=["word", "other", "n"])

    with_others = distinct_names.select("name").mapInArrow(g, "word string, other string, n long").groupBy("word", "other").agg(F.sum("n").cast("double").alias("n"))
    wide = with_others.groupBy("word").agg((F.pow(F.sum("n"), 2) / F.sum(F.col("n") * F.col("n"))).alias("partners")).where(F.col("partners") >= PARTNERS)
    shared = {r["word"] for r in wide.collect()}
    return sorted({w for w in often if N.skeleton(w) in shared} | set(fixed))


SIGNATURE = "name string, key string, frame string, stem string, rest string, initial boolean, initial_frame string, linkable boolean, others string"
_TYPES = (pa.string(),) * 5 + (pa.bool_(), pa.string(), pa.bool_(), pa.string())


def signatures(distinct_names: DataFrame, words: list[str], place: bool = False) -> DataFrame:
    """Each name's signature: key (equal for equal acts), frame (must be equal), stem (may be misspelt), rest (other rare words, exact), others (shared words, numbers and other long words)."""
    shared = distinct_names.sparkSession.sparkContext.broadcast(words)

    def f(batches):
        roles = N.Roles(shared.value)
        firsts = {N.latin(x) for x in N.NICKNAMES}
        for b in batches:
            rows = []
            for text in b.column(0).to_pylist():
                n = N.parse(N.place_core(text)[0] if place else text, roles, place)
                if place:
                    n = n._replace(stems=tuple(s for s in n.stems if s not in DISTRICT) or n.stems, numbers=())
                if n.tribute or (not place and N._EVENT.search(text)) or (place and N.NOWHERE.match(text)):
                    rows.append((text, "!" + " ".join(text.lower().split()), "", "", "", False, None, False, ""))
                    continue
                stem = max(n.stems, key=len, default="")
                rest = list(n.stems)
                if stem:
                    rest.remove(stem)
                first = [r for r in n.roles if r in firsts]
                own = tuple(r for r in n.roles if r[0] != "#")  # without a stem, the shared words tell the act: all must be equal
                as_initial = n._replace(roles=tuple(r for r in own if r not in first), initials=(first[0][0],)).frame if len(first) == 1 and not n.initials else None
                rows.append((text, n.key, n.frame, stem, " ".join(rest), bool(n.initials), n._replace(roles=own).frame if n.initials else as_initial, bool(stem or set(own) - set(first)), " ".join((*own, *n.numbers, *(w for w in rest if len(w) > 5)))))
            columns = zip(*rows) if rows else [()] * len(_TYPES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=[c.split()[0] for c in SIGNATURE.split(", ")])

    return distinct_names.select("name").mapInArrow(f, SIGNATURE)


def _cells(sigs: DataFrame, frame: str) -> DataFrame:
    """(cell, gone, frame, key, stem, initial): each signature once for each of its stem's cells, placed by cell."""

    def f(batches):
        for b in batches:
            at, names, gone = [], [], []
            for i, s in enumerate(b.column(1).to_pylist()):
                c = N.cells(s, N.reach(len(s)))
                at += [i] * len(c)
                names += c
                gone += c.values()
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(take) for i in range(4)), pa.array(names, pa.string()), pa.array(gone, pa.string())], names=["key", "stem", "frame", "initial", "at", "gone"])

    rows = sigs.select("key", "stem", F.concat_ws("|", F.col(frame), "rest").alias("frame"), "initial").mapInArrow(f, "key string, stem string, frame string, initial boolean, at string, gone string")
    return rows.select(F.xxhash64("frame", "at").alias("cell"), "gone", "frame", "key", "stem", "initial").repartition(parallelism(sigs.sparkSession), "cell")


def _meetings(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, x, y) of the signatures of two sides of one frame that share a cell, each pair in one cell only."""
    left = left.select("cell", F.col("gone").alias("g"), F.col("frame").alias("f"), F.col("key").alias("a"), F.col("stem").alias("x"))
    right = right.select("cell", "gone", "frame", F.col("key").alias("b"), F.col("stem").alias("y"))
    apart = "length(g) = 0 OR length(gone) = 0 OR (instr(gone, substr(g, 1, 1)) = 0 AND instr(gone, substr(g, -1, 1)) = 0)"
    # Never broadcast: Spark judges the cells by the size of the files they are made from, of which they are many times the rows.
    return left.join(right.hint("merge"), "cell").where("f = frame AND a <> b").where(apart).select("a", "b", "x", "y")


def within(pairs: DataFrame) -> DataFrame:
    """(a, b, x, y, d): the pairs whose stems are within reach of one another, by the metric."""

    def f(batches):
        for b in batches:
            x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
            limit = [N.reach(max(len(p), len(q))) for p, q in zip(x, y)]
            d = [N.edits(p, q, k) for p, q, k in zip(x, y, limit)]
            keep = pa.array([i for i, v in enumerate(d) if v <= limit[i]], pa.int32())
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(keep) for i in range(4)), pa.array(d, pa.int32()).take(keep)], names=["a", "b", "x", "y", "d"])

    return pairs.mapInArrow(f, "a string, b string, x string, y string, d int")


# Whether stems d edits apart are taken for one: chance likeness grows with the square of the names, so two edits count only between the same first and last letters.
LIKELY = "d <= 1 OR (substr(x, 1, 1) = substr(y, 1, 1) AND substr(x, -1, 1) = substr(y, -1, 1))"


def name_groups(names: DataFrame, place: bool = False, aliases: DataFrame | None = None) -> DataFrame:
    """(name, grp, stem, others): the group of each distinct non-null name of ``names`` (name); names of one group mean the same.
    stem is the name's longest rare word and others its shared words, numbers and other long words, both empty for tribute acts and events.

    ``aliases`` (name, alias) links a name with another one of its owner, if no other group of names claims that alias;
    an owner without an alias has a null one. Towns' shared words are those of the owners and aliases, or fixed ones: in
    the rows each of a few hundred towns is so frequent that its own words, and those for its parts, would be shared.
    Edits of two letters link only a signature that has no nearer one; an initial is resolved only if all full names it
    fits are of one group. Tribute acts and events are grouped with nothing but themselves. An empty table gives no rows.
    """
    known = None if aliases is None else aliases.select("name").unionByName(aliases.select(F.col("alias").alias("name"))).where(F.col("name").isNotNull()).distinct()
    every = names.select("name") if known is None else names.select("name").unionByName(known)
    n = parallelism(every.sparkSession)  # names are few bytes but dear to parse: without a number they would end up in few tasks
    distinct = stored(every.where(F.col("name").isNotNull()).distinct().repartition(n))
    words = shared_words(distinct) if not place else sorted(PLACE_WORDS) if known is None else shared_words(stored(known), place)
    named = stored(signatures(distinct, words, place))
    sigs = named.where("linkable").select("key", "frame", "stem", "rest", "initial", "initial_frame").distinct().repartition(n)
    cells = _cells(sigs.where(~F.col("initial")), "frame")
    near = cut(within(_meetings(cells, cells).where("a < b")).where(LIKELY).select("a", "b", "d"))
    least = near.select(F.col("a").alias("key"), "d").unionByName(near.select(F.col("b").alias("key"), "d")).groupBy("key").agg(F.min("d").alias("least"))
    edges = near.join(least.select(F.col("key").alias("a"), F.col("least").alias("la")), "a").join(least.select(F.col("key").alias("b"), F.col("least").alias("lb")), "b")
    edges = edges.where(F.col("d") <= F.greatest("la", "lb")).select("a", "b")
    groups = components(edges)
    grouped = lambda df, key: df.join(groups, F.col(key) == groups["node"], "left").withColumn("grp", F.coalesce("component", F.col(key))).drop("node", "component")
    extra = _initial_edges(sigs, grouped)
    if aliases is not None:
        extra = extra.unionByName(_alias_edges(aliases, named, grouped))
    merged = components(extra)
    out = grouped(named.select("name", "key", "stem", "others"), "key").join(merged, F.col("grp") == merged["node"], "left")
    return out.select("name", F.coalesce("component", "grp").alias("grp"), "stem", "others")


def _initial_edges(sigs: DataFrame, grouped) -> DataFrame:
    """(a, b): the group of an abbreviated first name and the one group of full names it fits."""
    named = sigs.where(F.col("initial_frame").isNotNull())
    shortened = named.where("initial").select("initial_frame").distinct()
    cells = _cells(named.join(shortened, "initial_frame", "left_semi"), "initial_frame")
    near = grouped(within(_meetings(cells.where("initial"), cells.where("not initial"))).where(LIKELY).select("a", "b", "d"), "b")
    best = near.groupBy("a", "d").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"))
    one = best.groupBy("a").agg(F.min_by(F.struct("lo", "hi"), "d").alias("m")).where("m.lo = m.hi")
    return one.select("a", F.col("m.lo").alias("b"))


def _alias_edges(aliases: DataFrame, named: DataFrame, grouped) -> DataFrame:
    """(a, b): groups of a name and its alias, if only one group of names claims the alias's group and the alias is no acronym."""
    keys = grouped(named.where(F.col("key").rlike(r"^[^!]*[^|! ]")).select("name", "key"), "key")  # none of a tribute, an event or no word
    own = aliases.where(F.length(F.regexp_replace("alias", r"[\W_]", "")) > 4)
    pairs = own.join(keys.select("name", F.col("grp").alias("a")), "name").join(keys.select(F.col("name").alias("alias"), F.col("grp").alias("b")), "alias").where("a <> b").select("a", "b").distinct()
    single = pairs.groupBy("b").agg(F.min("a").alias("a"), F.count("*").alias("n")).where("n = 1").select("a", "b")
    owners = aliases.select("name").distinct().join(keys, "name").select(F.col("grp").alias("b")).distinct()
    return single.join(owners, "b", "left_anti").select("a", "b")


def act_groups(catalog: DataFrame, gaps: DataFrame) -> DataFrame:
    """(id, grp) of artist_catalog rows (name, aliases) and the catalog audit's gap_entry rows."""
    found = gaps.where(F.col("audit") == "catalog").select(F.col("gap_id").alias("id"), F.col("raw_name").alias("name"))
    acts = catalog.select(F.col("artist_id").alias("id"), F.col("artist_name").alias("name"), "aliases")
    owned = acts.where(F.col("name").isNotNull()).select("name", F.explode("aliases").alias("alias")).where(F.col("alias").isNotNull())
    rows = stored(acts.select("id", "name").unionByName(found).where(F.col("id").isNotNull() & F.col("name").isNotNull()))
    groups = name_groups(rows, aliases=owned)
    return rows.join(groups, "name").select("id", "grp").distinct()


def same_act_groups(catalog: DataFrame, gaps: DataFrame) -> DataFrame:
    """(id, group_id, n_rows, n_links) of every row with a name: the least id of its group, how many rows that has and how many of them name the same act as this one."""
    ids = cut(act_groups(catalog, gaps))
    sizes = ids.groupBy("grp").agg(F.min("id").alias("group_id"), F.count("*").alias("n_rows"))
    return ids.join(sizes, "grp").select("id", "group_id", "n_rows", (F.col("n_rows") - 1).alias("n_links"))


def same_act_pairs(catalog: DataFrame, gaps: DataFrame) -> DataFrame:
    """(a_id, b_id), a_id < b_id: all pairs of rows that name the same act. Rows without a name are in no pair."""
    ids = cut(act_groups(catalog, gaps))
    a, b = ids.select("grp", F.col("id").alias("a_id")), ids.select("grp", F.col("id").alias("b_id"))
    return a.join(b, "grp").where(F.col("a_id") < F.col("b_id")).select("a_id", "b_id").distinct()
