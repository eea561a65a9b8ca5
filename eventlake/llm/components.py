"""Connected components of an edge table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.places import spread_labels


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node of each node's component, for all nodes of edges (a, b).

    Edges with a null end are ignored; an empty table gives no rows.
    """
    return spread_labels(edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())).withColumnRenamed("label", "component")
