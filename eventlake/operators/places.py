"""Towns: representatives, proximity clusters and the name a cluster goes by."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators.spatial import EARTH_KM, pairs_within
from eventlake.session import cut

RADIUS_KM = 35.0
HELD = 500_000  # distinct edges that one task joins; a larger graph goes by rounds


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Kilometres on the sphere."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def representatives(concerts: DataFrame) -> DataFrame:
    """(country, city, lat, lng, total, located): the centroid of a town's located concerts, null if none is."""
    there = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    return concerts.groupBy("country", "city").agg(F.avg(F.when(there, F.col("lat"))).alias("lat"), F.avg(F.when(there, F.col("lng"))).alias("lng"), F.count("*").alias("total"), F.count(F.when(there, 1)).alias("located"))


def spread_labels(edges: DataFrame, held: int = HELD) -> DataFrame:
    """(node, label): the least node of each component of edges (a, b).

    Up to ``held`` distinct edges one task joins them as they stream by: it holds their nodes alone, and the driver is spared
    the rounds' plans. A larger graph goes by rounds until nothing changes. A round takes the least label of a node's
    neighbours, writes it to the node's label as well (so whole trees are hooked on one another), and goes on to the label of
    the label. Simulated, chains of 5,000 nodes take 16 rounds in random and 14 in the worst order tried. Each round is cut off
    by a checkpoint; minima are combined on the map side, so hubs are no hot group.
    """
    once = cut(edges.select("a", "b").distinct())
    if once.limit(held + 1).count() <= held:
        return cut(_joined_labels(once))
    both = cut(once.unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    changed = True
    while changed:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "label", "near")
        hook = step.groupBy(F.col("label").alias("_root")).agg(F.min("near").alias("_hook"))
        up = labels.select(F.col("node").alias("_n"), F.col("label").alias("_up"))
        step = step.join(hook, step["node"] == hook["_root"], "left").select("node", F.least("label", "near", "_hook").alias("new"), F.col("label").alias("old"))
        step = cut(step.join(up, step["new"] == up["_n"], "left").select("node", F.least("new", "_up").alias("label"), "old"))
        labels = step.select("node", "label")
        changed = step.where("label <> old").limit(1).count() > 0
    return labels


def _joined_labels(edges: DataFrame) -> DataFrame:
    """(node, label) of edges that one task can hold."""
    kind = edges.schema["a"].dataType.simpleString()

    def f(batches):
        up, node = {}, pa.string()

        def top(x):
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for b in batches:
            node = b.schema.field(0).type
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x, y = top(up.setdefault(x, x)), top(up.setdefault(y, y))
                up[max(x, y)] = min(x, y)
        nodes = list(up)
        for i in range(0, len(nodes), 50_000):
            part = nodes[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, node), pa.array([top(x) for x in part], node)], names=["node", "label"])

    return edges.coalesce(1).mapInArrow(f, f"node {kind}, label {kind}")


def clusters(reps: DataFrame, radius_km: float = RADIUS_KM) -> DataFrame:
    """(country, city, canonical): towns of a country that hang together by steps of at most ``radius_km``, and the name of
    the one with most concerts (then the longest, then the first by the alphabet). Towns without a place stand alone."""
    numbered = cut(reps.withColumn("id", F.xxhash64("country", "city")))
    near = pairs_within(numbered, "id", F.col("lat"), F.col("lng"), radius_km, F.col("country"))
    labels = spread_labels(near.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")))
    joined = numbered.join(labels, numbered["id"] == labels["node"], "left").withColumn("label", F.coalesce("label", "id"))
    names = joined.groupBy("label").agg(F.min_by("city", F.struct(-F.col("total"), -F.length("city"), "city")).alias("canonical"))
    return joined.join(names, "label").select("country", "city", "canonical")


def canonical_cities(concerts: DataFrame, radius_km: float = RADIUS_KM) -> DataFrame:
    """``concerts`` with the name of their town's cluster, or the town's own where it has none."""
    map_ = clusters(representatives(concerts), radius_km).select(F.col("country").alias("_k"), F.col("city").alias("_c"), "canonical")
    on = concerts["country"].eqNullSafe(map_["_k"]) & concerts["city"].eqNullSafe(map_["_c"])
    return concerts.join(map_, on, "left").drop("_k", "_c").withColumn("canonical", F.coalesce("canonical", "city"))
