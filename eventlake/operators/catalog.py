"""Folds over a catalogue of acts: first of a key, spelling variants, aliases, neighbours, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions import text


def first_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in ``order``: one aggregate, no window."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(key, "_r.*")


def case_variants(df: DataFrame, name: str, order: str) -> DataFrame:
    """(key, name, ord): of spellings that differ in case and blanks only the one with most capitals, then the first; ord is the key's first."""
    keyed = df.where(F.col(name).isNotNull()).withColumn("key", text.norm_key(name))
    return keyed.groupBy("key").agg(F.max_by(name, F.struct(text.capitals(name), -F.col(order))).alias("name"), F.min(order).alias("ord"))


def union_aliases(name: Column, aliases: Column) -> Column:
    """Aliases in order without those equal to the name or to an earlier one but for case and blanks."""
    own = text.norm_key(name)
    kept = F.filter(aliases, lambda a: a.isNotNull() & (text.norm_key(a) != own) & (text.norm_key(a) != ""))
    return F.filter(kept, lambda a, i: F.array_position(F.transform(kept, text.norm_key), text.norm_key(a)) == i + 1)


def in_degree(nodes: DataFrame, key: str, edges: DataFrame, target: str) -> DataFrame:
    """(key, n): how many edges lead to each node, 0 for none."""
    n = edges.groupBy(F.col(target).alias("_t")).agg(F.count("*").alias("n"))
    return nodes.join(n, F.col(key) == F.col("_t"), "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def resolved_neighbours(rows: DataFrame, key: str, names: str, catalog: DataFrame, name: str, cap: int) -> DataFrame:
    """(key, found): the first ``cap`` of a row's named neighbours that are in the catalogue, itself left out, in its order.

    The catalogue is shuffled, never broadcast: by the size of its files, compressed and by columns, Spark takes one of a million rows for small.
    """
    said = rows.select(F.col(key), F.posexplode(names).alias("_i", "_n"))
    known = catalog.select(F.col(name).alias("_n")).distinct()
    hits = said.join(known.hint("merge"), "_n").where(F.col("_n") != F.col(key))
    w = Window.partitionBy(key).orderBy("_i")
    first = hits.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap)
    return first.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_n"))), lambda x: x["_n"]).alias("found"))


def gaps(listings: DataFrame, known: DataFrame) -> DataFrame:
    """(artist, n, sources, plausible): names that are not known, how often and by which sources they were listed."""
    rest = listings.where(F.col("artist").isNotNull()).join(known.select("artist").distinct(), "artist", "left_anti")
    return rest.groupBy("artist").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("original_source")), ",").alias("sources")).withColumn("plausible", F.length("artist") <= 40)


def fold_bindings(rows: DataFrame, name: str, item: str, value: str, order: str) -> DataFrame:
    """(name, items, ambiguous, value): how many things a name stands for and its first non-empty value."""
    there = F.length(F.coalesce(F.col(value), F.lit(""))) > 0
    return rows.groupBy(name).agg(F.countDistinct(item).alias("items"), (F.countDistinct(item) > 1).alias("ambiguous"), F.min_by(F.when(there, F.col(value)), F.when(there, F.col(order))).alias(value))


def merged_suffixes(df: DataFrame, name: str, order: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """One row for names that differ only in a bracket such as "(band)": the name without one, then with most capitals, then the first.

    Of other columns the last row's value counts, of those in ``kept`` the last that is not null. Rows without a name are left out.
    """
    key = F.regexp_replace(text.norm_key(name), r"\s*\((?:band|singer|musician|group|rapper|dj|duo|artist)[^)]*\)$", "")
    rows = df.where(F.col(name).isNotNull()).withColumn("key", key)
    bare = (text.norm_key(name) == F.col("key")).cast("int")
    best = F.max_by(name, F.struct(bare, text.capitals(name), -F.col(order))).alias(name)
    rest = [c for c in df.columns if c not in (name, order)]
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order)) if c in kept else F.col(order)).alias(c) for c in rest]
    return rows.groupBy("key").agg(best, F.min(order).alias(order), *last).drop("key")


def beside(left: DataFrame, right: DataFrame, page: str, at: str, limit: float, order: str) -> DataFrame:
    """Each row of ``left`` with the first row (by ``order``) of ``right`` on its page less than ``limit`` away, if there is one.

    A range join by equal stripes of width ``limit``: a row meets its own stripe and the two beside it, never the whole page.
    """
    stripe = F.floor(F.col(at) / limit).cast("long")
    near = left.withColumn("_s", F.explode(F.array(stripe - 1, stripe, stripe + 1)))
    other = right.select(F.col(page).alias("_p"), stripe.alias("_t"), F.struct(*right.columns).alias("_r"))
    hits = near.join(other, (F.col(page) == F.col("_p")) & (F.col("_s") == F.col("_t"))).where(F.abs(F.col(at) - F.col(f"_r.{at}")) < limit)
    first = hits.groupBy(*left.columns).agg(F.min_by("_r", F.col(f"_r.{order}")).alias("match"))
    return first


def denied(terms: DataFrame, deny: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Distinct terms that are on the deny list and no target. Null terms are none."""
    return wanted_without(terms.where(F.col(key).isNotNull()).select(key).distinct(), deny, targets, key)


def wanted_without(rows: DataFrame, wanted: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """Rows whose key is wanted and not covered yet, once each as in ``rows``."""
    return rows.join(wanted.select(key).distinct(), key, "left_semi").join(covered.select(key).distinct(), key, "left_anti")


def with_missing(have: DataFrame, said: DataFrame, key: str) -> DataFrame:
    """(key) of what is there, as it is, and the distinct names it lacks."""
    return have.select(key).unionByName(said.select(key).where(F.col(key).isNotNull()).distinct().join(have.select(key), key, "left_anti"))


def touring(concerts: DataFrame, artist: str = "artist", country: str = "country") -> DataFrame:
    """(artist, countries): in how many countries each act plays, codes compared without case."""
    return concerts.groupBy(artist).agg(F.countDistinct(F.upper(country)).alias("countries"))


def seen(entries: DataFrame, name: str, heard: DataFrame, artist: str) -> DataFrame:
    """``entries`` with ``seen``: whether a listing names them, but for case and blanks; all entries of a name are."""
    keys = heard.select(text.norm_key(artist).alias("_k")).where(F.col("_k").isNotNull()).distinct().withColumn("seen", F.lit(True))
    return entries.join(keys, text.norm_key(name) == F.col("_k"), "left").drop("_k").withColumn("seen", F.coalesce("seen", F.lit(False)))


def bucket(source: Column | str, buckets: dict[str, str], other: str = "Direct") -> Column:
    """The label of a source, ``other`` for any that has none."""
    return F.coalesce(text.lookup(buckets, text.col(source)), F.lit(other))


def first_spelling(lists: list[DataFrame], name: str) -> DataFrame:
    """(key, name): the distinct names of several lists, each in the spelling of the first list that has it."""
    both = None
    for i, df in enumerate(lists):
        part = df.select(F.col(name).alias("name"), F.lit(i).alias("_r"))
        both = part if both is None else both.unionByName(part)
    return both.where(F.col("name").isNotNull()).groupBy(text.norm_key("name").alias("key")).agg(F.min_by("name", F.struct("_r", "name")).alias("name"))


def counted(df: DataFrame, kinds: dict[str, str], distinct: str) -> DataFrame:
    """(kind, value, n, names): rows and distinct names by each of several columns, from one scan."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in kinds.items()])
    return df.select(F.col(distinct).alias("_d"), F.explode(pairs).alias("p")).groupBy("p.kind", "p.value").agg(F.count("*").alias("n"), F.countDistinct("_d").alias("names"))
