"""Performers of listings resolved against a whitelist, tier by tier (exact, contained, misspelt).

Titles are resolved once each, whatever their number of listings, and every tier is an equi-join: containment joins the
spans of a title with the names, edit distance joins pieces of both (of k + 1 pieces of a name one is unharmed by k
edits), so no tier compares each title with each name. A tier only sees what earlier ones left over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.text import B0, B1, WS, clean_artist, nfkd, trim
from eventlake.session import cut

SHORT_MAX = 3  # names of no more characters match only exactly
COVERAGE = 0.25  # least share of a clause that a contained name must make up
CLOSE_MAX, CLOSE_EDITS, EDITS = 7, 1, 2  # names of no more characters allow fewer edits
WORD = r"[\p{L}\p{N}\p{M}_]"
# Words that join a name to a longer phrase.
CONNECTORS = "of the and & vs feat feat. featuring ft ft. with presents".split()
TRIBUTE = rf"(?i){B0}(cover|tribute){B1}"


def searchable(whitelist: DataFrame) -> DataFrame:
    """(found, name, ord): lower-case names and aliases with the entry they stand for.

    Canonical names beat aliases; of equal names the last counts; an alias that several entries claim, or that is some
    entry's name, stands for none.
    """
    names = whitelist.where(F.length(F.coalesce("name", F.lit(""))) > 0).groupBy(F.lower("name").alias("found")).agg(F.max_by("name", "ord").alias("name"), F.max("ord").alias("ord"))
    if "aliases" not in whitelist.columns:
        return names
    said = whitelist.select("name", "ord", F.explode("aliases").alias("alias")).where(F.length("alias") > 0)
    alias = said.groupBy(F.lower("alias").alias("found")).agg(F.max_by("name", "ord").alias("name"), F.max("ord").alias("ord"), F.min("ord").alias("_first")).where(F.col("_first") == F.col("ord")).drop("_first")
    return names.unionByName(alias.join(names.select("found"), "found", "left_anti"))


def first_clause(c: Column) -> Column:
    return F.element_at(F.split(c, rf"{WS}-{WS}"), 1)


def exact(titles: DataFrame, names: DataFrame) -> DataFrame:
    """(title, name) of titles that are a name, but for case."""
    return titles.join(names, F.lower("title") == F.col("found")).select("title", "name")


def spans(titles: DataFrame, longest: int) -> DataFrame:
    """(title, clause, at, span) of every part of a clause a name may fill: its ends are no inner ends of words."""
    t = titles.select("title", first_clause(F.col("title")).alias("clause")).withColumn("_n", F.length("clause")).where(F.col("_n") > SHORT_MAX)
    inner = lambda i: F.substring("clause", i - 1, F.lit(1)).rlike(f"^{WORD}$") & F.substring("clause", i, F.lit(1)).rlike(f"^{WORD}$")
    every = F.sequence(F.lit(1), F.col("_n") + 1)
    # Ends of words, once a clause; a start meets only the ends that the shortest share and the longest name leave it, so a title of n words has at most n times as many spans as the longest name has words.
    t = t.withColumn("_b", F.filter(every, lambda i: (i == 1) | (i == F.col("_n") + 1) | ~inner(i)))
    least = F.greatest(F.lit(SHORT_MAX + 1), F.ceil(COVERAGE * F.col("_n")).cast("int"))
    t = t.select("title", "clause", "_n", F.explode("_b").alias("at"), "_b", least.alias("_least"))
    t = t.select("title", "clause", "_n", "at", F.explode(F.filter("_b", lambda i: (i - F.col("at")).between(F.col("_least"), F.lit(longest)))).alias("to"))
    size = F.col("to") - F.col("at")
    return t.select("title", "clause", "at", F.substring("clause", F.col("at"), size).alias("span"))


def contained(titles: DataFrame, names: DataFrame) -> DataFrame:
    """(title, name) of titles whose first clause holds a name as whole words; the longest, then the earliest entry, wins.

    Only a name's first occurrence counts. It is refused if a capitalised word or a connector touches it.
    """
    fit = names.where(F.length("found") > SHORT_MAX)
    longest = fit.agg(F.max(F.length("found"))).first()[0] or 0
    hits = spans(titles, longest).join(fit, F.lower("span") == F.col("found")).groupBy("title", "clause", "name", "ord", "found").agg(F.min("at").alias("at"))
    before, after = F.substring("clause", F.lit(1), F.col("at") - 1), F.substring("clause", F.col("at") + F.length("found"), F.length("clause"))
    word_before, word_after = F.regexp_extract(before, rf"(\p{{L}}(?:{WORD}|')*){WS}$", 1), after.rlike(rf"^{WS}\p{{Lu}}")
    joins = [F.lower(F.regexp_extract(before, rf"([A-Za-z.&']+){WS}$", 1)).isin(CONNECTORS), F.lower(F.regexp_extract(after, rf"^{WS}([A-Za-z.&']+)", 1)).isin(CONNECTORS)]
    kept = hits.where(~(word_before.rlike(r"^\p{Lu}") | word_after | joins[0] | joins[1]))
    best = kept.groupBy("title").agg(F.min_by("name", F.struct(-F.length("found"), "ord")).alias("name"))
    return best


def _pieces(k: int, name: Column) -> Column:
    """Keys of a name: its length and each of its k + 1 pieces."""
    n = F.length(name)
    start = lambda j: F.floor(F.lit(j) * n / (k + 1)).cast("int")
    return F.array(*[F.concat_ws(":", n.cast("string"), F.lit(str(j)), F.substring(name, start(j) + 1, start(j + 1) - start(j))) for j in range(k + 1)])


def _probes(k: int, text: str, least: int, most: int) -> Column:
    """Keys under which names within k edits of a text are found: each length and each place a piece may have moved to."""
    size, lo, hi = "(n + d)", f"cast(floor(j * (n + d) / {k + 1}) as int)", f"cast(floor((j + 1) * (n + d) / {k + 1}) as int)"
    key = f"concat_ws(':', {size}, j, substring(t, {lo} + h + 1, {hi} - {lo}))"
    fits = f"{size} between {least} and {most} and {lo} + h >= 0 and {hi} + h <= n"
    every = f"flatten(transform(sequence(-{k}, {k}), d -> flatten(transform(sequence(0, {k}), j -> transform(sequence(-{k}, {k}), h -> case when {fits} then {key} end)))))"
    return F.array_distinct(F.array_compact(F.expr(every.replace("substring(t,", f"substring({text},").replace("(n + d)", f"(length({text}) + d)").replace("<= n ", f"<= length({text}) "))))


def plain(c: Column) -> Column:
    """Lower case without accents, as names are compared by edits."""
    return F.lower(F.regexp_replace(nfkd(trim(c)), r"\p{M}", ""))


def misspelt(titles: DataFrame, names: DataFrame) -> DataFrame:
    """(title, name) of titles whose first clause is at most 1 edit (names of 4 to 7 characters, tried first) or 2 (longer ones) from a name; the nearest, then the shortest, then the earliest."""
    t = titles.select("title", plain(first_clause(F.col("title"))).alias("text")).where(F.length("text") > 1)
    n = names.withColumn("plain", plain(F.col("found")))
    found = None
    for rank, (k, least, most) in enumerate(((CLOSE_EDITS, SHORT_MAX + 1, CLOSE_MAX), (EDITS, CLOSE_MAX + 1, 10_000))):
        left = t.select("title", "text", F.explode(_probes(k, "text", least, most)).alias("key"))
        right = n.where(F.length("plain").between(least, most)).select("name", "ord", "plain", F.explode(_pieces(k, F.col("plain"))).alias("key"))
        pairs = left.join(right, "key").select("title", "name", "ord", F.length("plain").alias("size"), F.levenshtein("text", "plain", k).alias("d")).where("d >= 0").withColumn("rank", F.lit(rank))
        found = pairs if found is None else found.unionByName(pairs)
    return found.groupBy("title").agg(F.min_by("name", F.struct("rank", "d", "size", "ord")).alias("name"))


def match_titles(titles: DataFrame, whitelist: DataFrame) -> DataFrame:
    """(title, name, tier) of the distinct cleaned titles that a tier resolves: 1 exact, 3 contained, 4 misspelt; tribute acts only exactly.

    Empty and null titles match nothing; an empty whitelist gives no rows.
    """
    names = searchable(whitelist)
    names = cut(names)
    titles = cut(titles.select("title").where(F.length("title") > 0).distinct())  # each tier starts from what is left, not from the listings
    one = cut(exact(titles, names).withColumn("tier", F.lit(1)))
    rest = cut(titles.join(one, "title", "left_anti").where(~F.col("title").rlike(TRIBUTE)))
    three = cut(contained(rest, names).withColumn("tier", F.lit(3)))
    four = misspelt(rest.join(three, "title", "left_anti"), names).withColumn("tier", F.lit(4))
    return one.unionByName(three).unionByName(four)


def resolve(raw: DataFrame, whitelist: DataFrame, artist: str = "artist") -> DataFrame:
    """``raw`` with ``title`` (the cleaned name), ``matched`` (the entry's name) and ``tier``, both null where nothing matches."""
    cleaned = raw.withColumn("title", clean_artist(artist))
    hits = match_titles(cleaned.select("title"), whitelist).withColumnRenamed("name", "matched")
    return cleaned.join(hits, "title", "left")
