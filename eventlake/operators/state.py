"""State carried from run to run as tables: upserts, three-way merges, change logs, streaks, queues, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, fresh: DataFrame, key: str, ok: str = "ok") -> DataFrame:
    """A cache after a run: rows whose fetch was ok replace those of their key, failed ones keep what was there."""
    good = fresh.where(F.coalesce(F.col(ok), F.lit(False))).drop(ok)
    return good.select(*old.columns).unionByName(old.join(good.select(key).distinct(), key, "left_anti").select(*old.columns))


def with_fallback(fresh: DataFrame, failed: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Fresh rows and, of sources that failed, the cached ones."""
    return fresh.unionByName(cache.join(failed.select(key).distinct(), key, "left_semi").select(*fresh.columns))


def text_of(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name): a row as JSON in schema order; absent and null are the same."""
    return df.select(F.col(key).alias("_k"), F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(name))


def three_way(before: DataFrame, after: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """(key, action, row) of each key that is to change in ``current``: upsert, delete, or conflict, row being the new JSON.

    A change from before to after is applied if current lacks the key, or still has the old or already the new row; a
    removal if current still has the old row. Everything else that changed is a conflict and leaves current as it is.
    """
    b, a, c = text_of(before, key, "b"), text_of(after, key, "a"), text_of(current, key, "c")
    j = b.join(a, "_k", "full_outer").join(c, "_k", "full_outer")
    upserts = F.col("a").isNotNull() & ~F.col("a").eqNullSafe(F.col("b"))
    deletes = F.col("a").isNull() & F.col("b").isNotNull() & F.col("c").isNotNull()
    action = (
        F.when(upserts & (F.col("c").isNull() | F.col("c").eqNullSafe(F.col("b")) | F.col("c").eqNullSafe(F.col("a"))), "upsert")
        .when(upserts, "conflict")
        .when(deletes & (F.col("c") == F.col("b")), "delete")
        .when(deletes, "conflict")
    )
    return j.withColumn("action", action).where(F.col("action").isNotNull()).select(F.col("_k").alias(key), "action", F.when(F.col("action") == "upsert", F.col("a")).alias("row"))


def append_new(before: DataFrame, after: DataFrame, current: DataFrame) -> DataFrame:
    """``current`` and the distinct rows of ``after`` that neither ``before`` nor ``current`` has."""
    cols = current.columns
    fresh = after.select(*cols).exceptAll(before.select(*cols)).distinct()
    return current.unionByName(fresh.subtract(current.select(*cols)))


def new_keys(now: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not known; none at all if nothing is known yet."""
    cold = known.limit(1).count() == 0
    return now.limit(0) if cold else now.join(known.select(key).distinct(), key, "left_anti")


def changelog(prior: DataFrame, now: DataFrame, known: DataFrame, key: str, at: Column, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """(changes, keys) after a run: prior changes no older than ``days`` with the new ones, and the run's keys in place of the known."""
    fresh = new_keys(now, known, key).withColumn("detected_at", at)
    kept = prior.where(F.col("detected_at") >= at - F.expr(f"INTERVAL {days} DAYS"))
    return kept.unionByName(fresh.select(*kept.columns)), now.select(key).distinct()


def streaks(health: DataFrame, failures: DataFrame, key: str, limit: int) -> DataFrame:
    """(key, failures, prune): each failure record adds one to its key's streak; keys without one in this run lose theirs."""
    now = failures.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    joined = now.join(health.select(key, F.col("failures").alias("_old")), key, "left")
    n = F.col("_n") + F.coalesce("_old", F.lit(0))
    return joined.select(key, n.alias("failures"), (n >= limit).alias("prune"))


def current_streak(log: DataFrame, key: str, failed: Column, at: str) -> DataFrame:
    """(key, streak): failures after the last success. Two aggregates; no key's history is held or sorted."""
    last = log.where(~failed).groupBy(key).agg(F.max(at).alias("_ok"))
    bad = log.where(failed).join(last, key, "left").where(F.col("_ok").isNull() | (F.col(at) > F.col("_ok")))
    return bad.groupBy(key).agg(F.count("*").alias("streak"))


def stalest(items: DataFrame, fetched: DataFrame, key: str, at: str, now: Column, fresh_days: int, cap: int, order: str = "ord") -> DataFrame:
    """The first ``cap`` items not fetched within ``fresh_days``: never fetched first, then the longest ago, then by ``order``."""
    j = items.join(fetched.groupBy(key).agg(F.max(at).alias(at)), key, "left")
    due = j.where(F.col(at).isNull() | (F.col(at) < now - F.expr(f"INTERVAL {fresh_days} DAYS")))
    return due.orderBy(F.col(at).asc_nulls_first(), F.col(order)).limit(cap)


def retained(log: DataFrame, at: str, now: Column, days: int) -> DataFrame:
    """Entries no older than ``days``."""
    return log.where(F.col(at) >= now - F.expr(f"INTERVAL {days} DAYS"))


def lookup_queue(wanted: DataFrame, cache: DataFrame, key: str, cap: int, order: str = "ord") -> DataFrame:
    """Distinct keys no cache row has, by first appearance, at most ``cap``; a cached miss counts as known."""
    return wanted.groupBy(key).agg(F.min(order).alias(order)).join(cache.select(key).distinct(), key, "left_anti").orderBy(order).limit(cap)


def unchanged(old: DataFrame, fresh: DataFrame, key: str, hash_col: str = "content_hash") -> DataFrame:
    """(key, changed): whether a source's content hash is another than the stored one; new sources are changed."""
    o = old.select(F.col(key).alias("_k"), F.col(hash_col).alias("_h"))
    return fresh.join(o, fresh[key] == o["_k"], "left").select(key, (~F.col(hash_col).eqNullSafe(F.col("_h"))).alias("changed"))


def unique_owner(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key no other row has."""
    one = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n = 1").select(key)
    return rows.join(one, key, "left_semi")


def changed_shards(old: DataFrame, new: DataFrame, shard: str, columns: Sequence[str]) -> DataFrame:
    """The shards whose content differs: only they need be written again."""
    sums = lambda df, n: df.groupBy(shard).agg(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias(n), F.count("*").alias(f"{n}_n"))
    j = sums(old, "o").join(sums(new, "f"), shard, "full_outer")
    return j.where(~(F.col("o").eqNullSafe(F.col("f")) & F.col("o_n").eqNullSafe(F.col("f_n")))).select(shard)
