"""Items of varying length into containers of fixed capacity (problem 9) by sum-of-squares online packing.

Items are dealt into groups of bounded size by a hash; in each group an array holds how many open containers have each
fill level, and an item goes to the level, or the new container, after which the sum of the squared counts is least. A
second round packs the containers left open by all groups, whole, in the same way.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.session import stored

GROUP = 50_000  # items a task packs


def sum_of_squares(sizes, capacity: int) -> list[int]:
    """The container number of each item, in the order given; 0 < size <= capacity."""
    count = np.zeros(capacity + 1, dtype=np.int64)
    level: list[list[int]] = [[] for _ in range(capacity + 1)]
    at, total = [], 0
    for s in sizes:
        if s == capacity:
            at.append(total)
            total += 1
            continue
        here, then = count[1 : capacity - s + 1], count[s + 1 :]
        change = np.where(here > 0, 2 * (then - here) + 2, 1 << 60)
        if here[-1] > 0:
            change[-1] = 1 - 2 * here[-1]  # the container is closed
        k = len(change) - 1 - int(np.argmin(change[::-1]))  # of equal ones the fullest
        if change[k] <= 2 * count[s] + 1:
            fill = k + 1
            c = level[fill].pop()
            count[fill] -= 1
        else:
            fill, c, total = 0, total, total + 1
        at.append(c)
        fill += s
        if fill < capacity:
            level[fill].append(c)
            count[fill] += 1
    return at


def _round(items: DataFrame, capacity: int, n_groups: int, base: int) -> DataFrame:
    """(item, size, container): each item of (item, size) in a container of its group."""

    def f(t: pa.Table) -> pa.Table:
        order = np.lexsort((t.column("tie").to_numpy(), t.column("h").to_numpy()))
        sizes = t.column("size").to_numpy()[order]
        at = np.array(sum_of_squares(sizes.tolist(), capacity), dtype=np.int64)
        take = t.take(pa.array(order))
        group = take.column("g")[0].as_py()
        return pa.table({"item": take.column("item"), "size": take.column("size"), "container": pa.array(at + (np.int64(base + group) << np.int64(32)))})

    dealt = items.withColumn("h", F.xxhash64("item")).withColumn("tie", F.xxhash64("item", F.lit(1))).withColumn("g", F.pmod("h", F.lit(n_groups)).cast("int"))
    kind = items.schema["item"].dataType.simpleString()
    return dealt.groupBy("g").applyInArrow(f, f"item {kind}, size long, container long")


def pack(df: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", capacity: int = 2048, group: int = GROUP) -> DataFrame:
    """(id_col, piece_no, n_tokens, container_id): every row of ``df`` in containers of at most ``capacity``.

    Only an item larger than a container is split, into full pieces and one rest, numbered from 0. A size of 0 or null
    takes no room: one row with container_id null. ``id_col`` must be unique and not null (rows without an id are left
    out). The result is the same at every run: it depends on ids and sizes alone. An empty table gives no rows.
    """
    size = F.coalesce(F.col(size_col).cast("long"), F.lit(0))
    rows = stored(df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), size.alias("n")))  # sizes may be dear to compute
    pieces = rows.where("n > 0").select("id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / capacity))).alias("k"))
    items = stored(pieces.select(F.struct("id", "k").alias("item"), F.least(F.lit(capacity).cast("long"), F.col("n") - F.col("k") * capacity).alias("size")))
    n = max(math.ceil(items.count() / group), 1)
    first = _round(items, capacity, n, 0)
    if n > 1:
        first = stored(first)
        fills = first.groupBy("container").agg(F.sum("size").alias("size")).where(F.col("size") < capacity)
        open_ = stored(fills.select(F.col("container").alias("item"), "size"))
        again = _round(open_, capacity, max(math.ceil(open_.count() / group), 1), n).select(F.col("item").alias("container"), F.col("container").alias("moved"))
        first = first.join(again.hint("merge"), "container", "left").withColumn("container", F.coalesce("moved", "container"))  # merged, never broadcast: there are as many rows as containers
    packed = first.select(F.col("item.id").alias(id_col), F.col("item.k").cast("int").alias("piece_no"), F.col("size").alias("n_tokens"), F.col("container").alias("container_id"))
    empty = rows.where("n <= 0").select(F.col("id").alias(id_col), F.lit(0).alias("piece_no"), F.lit(0).cast("long").alias("n_tokens"), F.lit(None).cast("long").alias("container_id"))
    return packed.unionByName(empty)
