"""One surviving record per group of duplicate answers (problem 4), on a latent two-sided quality model of the sources.

A claim is a valid value of a field of an entity; each source that spoke about the field either asserts the claim or
withholds it. Expectation-maximisation infers each source's sensitivity (share of true values it asserts) and specificity
(share of false values it withholds), and with them every claim's log-odds of being true, so that a field may keep several
true values. Claims with the same asserting and silent sources are one row with a count in that loop, and only one row a
source comes back to the driver from a round.

A survivor takes, field by field, the value with the greatest log-odds, stated trust entering as the prior: a source asserts
what it said last, and each step of the best asserting source's trust adds ``trust_weight`` to the odds. By default that is
more than all sources' evidence together, so that trust is never outvoted and evidence decides between sources of one rank.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.session import broadcast_if_small, stored

# The networks' hosts.
NETWORKS = {
    "spotify": ("open.spotify.example", "open.spotify.com"),
    "instagram": ("instagram.example", "instagram.com"),
    "facebook": ("facebook.example", "facebook.com"),
    "youtube": ("youtube.example", "youtube.com"),
    "telegram": ("t-me.example", "telegram.example", "t.me"),
    "vk": ("vk.example", "vk.com"),
}
SOCIAL_HOST = r"(?i)(^|\.)(spotify|instagram|facebook|youtube|t-me|telegram|vk)\.(example|com|me|org)$|^t\.me$"
START = (0.7, 0.9, 0.5)  # sensitivity, specificity, share of true claims
FLOOR = 1e-3


def slug_key(c: Column) -> Column:
    return F.nullif(F.replace(F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")), F.lit("_"), F.lit("-")), F.lit(""))


def _trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")


def website_host(c: Column) -> Column:
    """The bare host of an http(s) address with a full host that is no social network's; else null."""
    host = F.lower(F.regexp_extract(_trimmed(c), r"(?i)^https?://(?:[^/?#@\s]*@)?([a-z0-9\p{L}](?:[a-z0-9\p{L}-]*[a-z0-9\p{L}])?(?:\.[a-z0-9\p{L}](?:[a-z0-9\p{L}-]*[a-z0-9\p{L}])?)+)\.?(?::\d+)?(?:[/?#]\S*)?$", 1))
    bare = F.regexp_replace(host, r"^www\.", "")
    return F.when(bare.contains(".") & ~bare.rlike(SOCIAL_HOST) & ~bare.rlike(r"^[\d.]+$"), bare)


def mbid_value(c: Column) -> Column:
    """A complete UUID that is not all zeros; else null."""
    v = F.lower(_trimmed(c))
    return F.when(v.rlike(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$") & v.rlike("[1-9a-f]"), v)


def account(c: Column, network: str) -> Column:
    """The account named by an address on the network; else null."""
    hosts = "|".join(h.replace(".", r"\.") for h in NETWORKS[network])
    path = r"(?:intl-[a-z]{2}(?:-[a-z]{2})?/)?artist/" if network == "spotify" else r"(?:c/|channel/|user/)?" if network == "youtube" else ""
    return F.nullif(F.lower(F.regexp_extract(_trimmed(c), rf"(?i)^https?://(?:www\.|m\.)?(?:{hosts})(?::\d+)?/{path}@?([^/?#@\s]+)/?(?:[?#]\S*)?$", 1)), F.lit(""))


def lookup_claims(lookups: DataFrame) -> DataFrame:
    """(entity, field, value, source, at): each valid value of a good answer; nothing else of the row is kept."""
    values = {"website": website_host(F.col("website")), "mbid": mbid_value(F.col("mbid"))} | {n: account(F.col("socials")[n], n) for n in NETWORKS}
    pairs = F.array(*[F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in values.items()])
    rows = lookups.where(F.col("ok")).select(slug_key(F.col("slug")).alias("entity"), F.coalesce("provider", F.lit("")).alias("source"), F.col("fetched_at").alias("at"), F.explode(pairs).alias("p"))
    return rows.where(F.col("entity").isNotNull() & F.col("p.value").isNotNull()).select("entity", "p.field", "p.value", "source", "at")


LIMIT = math.log((1 - FLOOR) / FLOOR)  # a source's greatest evidence


def _said(rows: pa.Table | pa.RecordBatch, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, source, whether it asserts) of all sources that spoke about the rows' claims; sources the model lacks are left out."""
    parts = []
    for column, said in (("asserts", True), ("silent", False)):
        c = rows.column(column)
        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        c = c if isinstance(c, pa.Array) else pa.concat_arrays(c)
        at, which = pc.list_parent_indices(c).to_numpy(zero_copy_only=False), np.array([index.get(s, -1) for s in pc.list_flatten(c).to_pylist()], dtype=np.int64)
        parts.append((at[which >= 0].astype(np.int64), which[which >= 0], np.full((which >= 0).sum(), said)))
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


def _evidence(n: int, at: np.ndarray, which: np.ndarray, said: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Each row's log-likelihood ratio of true to false, without the prior."""
    m = np.clip(model, FLOOR, 1 - FLOOR)
    yes, no = np.log(m[:, 0] / (1 - m[:, 1])), np.log((1 - m[:, 0]) / m[:, 1])
    return np.bincount(at, np.where(said, yes[which], no[which]), n) if len(at) else np.zeros(n)


def scored(facts: DataFrame, model: dict[str, tuple[float, float]], prior: float) -> DataFrame:
    """``facts`` with the log-odds ``odds`` of each claim and its probability ``p_true``."""
    shared = facts.sparkSession.sparkContext.broadcast(model)  # one row a source and field

    def f(batches):
        index, table = {s: i for i, s in enumerate(shared.value)}, np.array(list(shared.value.values()), dtype=float).reshape(-1, 2)
        base = math.log(prior / (1 - prior))
        for b in batches:
            odds = base + _evidence(b.num_rows, *_said(b, index), table)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(odds), pa.array(1 / (1 + np.exp(-np.clip(odds, -700, 700))))], names=[*b.schema.names, "odds", "p_true"])

    return facts.mapInArrow(f, T.StructType([*facts.schema.fields, T.StructField("odds", T.DoubleType()), T.StructField("p_true", T.DoubleType())]))


def _round(rows: pa.Table | pa.RecordBatch, names: list[str], model: np.ndarray, prior: float) -> np.ndarray:
    """One E-step over patterns and its sums for the M-step: a row a source of (true, true asserted, false, false withheld), and one of (true, all)."""
    n, k = rows.column("count").to_numpy().astype(float), len(names)
    at, which, said = _said(rows, {s: i for i, s in enumerate(names)})
    p = 1 / (1 + np.exp(-np.clip(math.log(prior / (1 - prior)) + _evidence(len(n), at, which, said, model), -700, 700)))
    t, f = n * p, n * (1 - p)
    sums = np.stack([np.bincount(which, t[at], k), np.bincount(which, t[at] * said, k), np.bincount(which, f[at], k), np.bincount(which, f[at] * ~said, k)], axis=1)
    return np.vstack([sums, [t.sum(), n.sum(), 0, 0]])


def source_quality(facts: DataFrame, rounds: int = 50, tolerance: float = 1e-4, held: int = 20_000) -> tuple[dict[str, tuple[float, float]], float]:
    """Sensitivity and specificity of every source (named ``field:source``) and the share of true claims.

    Up to ``held`` patterns, which is counted first, one process goes over them; beyond, each round is a pass of the executors.
    Both take all patterns and give the same.
    """
    patterns = stored(facts.groupBy("asserts", "silent").count())
    names = sorted(r[0] for r in patterns.select(F.explode(F.concat("asserts", "silent")).alias("s")).distinct().collect())  # one row a source and field
    model, prior = np.tile(np.array(START[:2]), (len(names), 1)), START[2]
    local = patterns.toArrow() if names and patterns.count() <= held else None

    def everywhere(model: np.ndarray, prior: float) -> np.ndarray:
        def f(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"sums": [_round(b, names, model, prior).ravel().tolist()]})

        total = np.zeros((len(names) + 1) * 4)
        for r in patterns.mapInArrow(f, "sums array<double>").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col")).collect():
            total[r[0]] = r[1]
        return total.reshape(-1, 4)

    for _ in range(rounds if names else 0):
        sums = _round(local, names, model, prior) if local is not None else everywhere(model, prior)
        t, ta, f, fs = sums[:-1].T
        new = np.stack([(ta + START[0]) / (t + 1), (fs + START[1]) / (f + 1)], axis=1)  # one pseudo-observation of the start values each way
        step, model = float(np.abs(new - model).max()), new
        prior = float(np.clip(sums[-1, 0] / max(sums[-1, 1], 1), 0.01, 0.99))
        if step < tolerance:
            break
    return {s: (float(a), float(b)) for s, (a, b) in zip(names, model)}, prior


def facts_of(claims: DataFrame, trust: DataFrame, last_only: bool = False) -> DataFrame:
    """One row per (entity, field, value): asserting and silent sources and its best source's trust; with ``last_only`` a source asserts only what it said last."""
    name = F.concat_ws(":", "field", "source")
    spoke = claims.groupBy("entity", "field").agg(F.collect_set(name).alias("spoke"))  # at most one name a source
    if last_only:
        last = claims.groupBy("entity", "field", "source").agg(F.max("at").alias("last"))
        claims = claims.join(last, ["entity", "field", "source"]).where(F.col("at").eqNullSafe(F.col("last"))).drop("last")
    ranks = trust.groupBy(F.col("provider").alias("_p")).agg(F.max("trust").alias("trust"))
    ranked = claims.join(broadcast_if_small(ranks), F.col("source") == F.col("_p"), "left").withColumn("trust", F.coalesce("trust", F.lit(-1)))
    facts = ranked.groupBy("entity", "field", "value").agg(F.sort_array(F.collect_set(name)).alias("asserts"), F.max("trust").alias("trust"))
    return facts.join(spoke, ["entity", "field"]).withColumn("silent", F.sort_array(F.array_except("spoke", "asserts"))).drop("spoke")


def fused(claims: DataFrame, trust: DataFrame, last_only: bool = False) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """Every claim with its log-odds and probability of being true, and the sources' quality."""
    once = stored(claims.groupBy("entity", "field", "value", "source").agg(F.max("at").alias("at")))  # repeats are combined, and values validated, once for all that follows
    facts = stored(facts_of(once, trust, last_only))
    model, prior = source_quality(facts)
    return scored(facts, model, prior), model


def survivors(claims: DataFrame, trust: DataFrame, trust_weight: float | None = None) -> DataFrame:
    """(entity, field, value): of each entity and field with a claim the value with the greatest log-odds of being true, of equals the greatest.

    A source asserts what it said last (null times first; of one time all). ``trust_weight`` is the prior's log-odds for one step
    of trust; without one it exceeds all evidence, so that the most trusted source's last value survives whatever others say.
    Sources without a trust rank come last; repeated rows change nothing; no claims, no rows.
    """
    facts, model = fused(claims, trust, last_only=True)
    weight = 2 * LIMIT * len(model) + 1 if trust_weight is None else trust_weight
    order = F.struct((F.col("trust") * weight + F.col("odds")).alias("odds"), "value")
    return facts.groupBy("entity", "field").agg(F.max(order).alias("o")).select("entity", "field", F.col("o.value").alias("value"))


def true_values(claims: DataFrame, trust: DataFrame, least: float = 0.5) -> DataFrame:
    """(entity, field, value, p_true, n_sources) of every value judged true; a field may keep several."""
    facts, _ = fused(claims, trust)
    return facts.where(F.col("p_true") >= least).select("entity", "field", "value", F.round("p_true", 6).alias("p_true"), F.size("asserts").alias("n_sources"))


def quality_table(claims: DataFrame, trust: DataFrame) -> DataFrame:
    """(field_name, provider, sensitivity, specificity): one row per source and field it speaks about."""
    _, model = fused(claims, trust)
    rows = [(*s.split(":", 1), round(a, 6), round(b, 6)) for s, (a, b) in sorted(model.items())]
    schema = T.StructType([T.StructField("field_name", T.StringType()), T.StructField("provider", T.StringType()), T.StructField("sensitivity", T.DoubleType()), T.StructField("specificity", T.DoubleType())])
    return claims.sparkSession.createDataFrame(rows, schema)


def surviving_artists(lookups: DataFrame, providers: DataFrame) -> DataFrame:
    return survivors(lookup_claims(lookups), providers).select(F.col("entity").alias("slug"), F.col("field").alias("field_name"), F.col("value").alias("field_value"))
