"""Points near other points (problem 3): Morton cells, discs covered by cell ranges, a range join on sorted codes, exact refinement.

Points lie on the unit sphere, whose three axes are cut into cells as wide as the radius' chord, so that poles and
the antimeridian need no special case. The interleaved cell numbers (a Z-order code) sort the points. Quantiles of
the codes split them into code ranges of equal size; a point is sent to the range that holds its own code, and as a
query to those that its disc's cells reach into. There a sorted array of codes answers each cell range by binary
search. A code that by itself fills several ranges (a dense town) is split on both sides, each part of its queries meeting each
part of its points in a task of its own, so that no task holds more than a range's worth of either.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0
TARGET = 20_000  # points a task compares
CHUNK = 1_000_000  # candidate pairs held at once
PAIRS = pa.schema([("a_id", pa.int64()), ("b_id", pa.int64())])


def valid_point(lat: Column, lng: Column) -> Column:
    """Coordinates that are there, finite and in range (NaN compares as greater than any number)."""
    return F.coalesce(lat.between(-90.0, 90.0) & lng.between(-180.0, 180.0), F.lit(False))


def spread(v: np.ndarray) -> np.ndarray:
    """Bits of 21-bit numbers moved three apart."""
    v = v.astype(np.uint64) & np.uint64(0x1FFFFF)
    for s, m in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        v = (v | (v << np.uint64(s))) & np.uint64(m)
    return v


def morton(cells: np.ndarray) -> np.ndarray:
    return (spread(cells[..., 0]) | (spread(cells[..., 1]) << np.uint64(1)) | (spread(cells[..., 2]) << np.uint64(2))).astype(np.int64)


def sphere(lat: np.ndarray, lng: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat), np.radians(lng)
    return np.stack([np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)], axis=-1)


def edge_of(radius_km: float) -> float:
    """Width of a cell: the chord of the radius, and at least what 20 bits an axis can tell apart."""
    return max(2 * math.sin(min(radius_km / EARTH_KM, math.pi) / 2) * (1 + 1e-9), 2.0 / (1 << 20) * 1.0001)


def cells_of(xyz: np.ndarray, edge: float) -> np.ndarray:
    return np.floor((xyz + 1.0) / edge).astype(np.int64) + 1  # never negative after a step to a neighbour


STEPS = np.array([(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)], dtype=np.int64)


def cover(cells: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges [lo, hi] of codes covering each disc from its own cell upwards (a pair is found from its lower end), one row a point; neighbouring codes are merged into one range and the unused slots are empty."""
    near = np.sort(np.where((c := morton(cells[:, None, :] + STEPS)) >= code[:, None], c, np.iinfo(np.int64).max), axis=1)
    hi = near.copy()
    for k in range(near.shape[1] - 2, -1, -1):
        joined = near[:, k + 1] == near[:, k] + 1
        hi[:, k] = np.where(joined, hi[:, k + 1], near[:, k])
    starts = np.ones_like(near, dtype=bool)
    starts[:, 1:] = near[:, 1:] != near[:, :-1] + 1
    starts &= near != np.iinfo(np.int64).max
    return np.where(starts, near, 1), np.where(starts, hi, 0)


def _codes(edge: float):
    def f(batches):
        for b in batches:
            xyz = sphere(b.column("lat").to_numpy(zero_copy_only=False), b.column("lng").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("lat"), b.column("lng"), b.column("grp"), pa.array(morton(cells_of(xyz, edge)))], names=["id", "lat", "lng", "grp", "code"])

    return f


def _route(edge: float, bounds: np.ndarray, salts: np.ndarray):
    """Each point to its home range and, as a query, to the ranges its disc reaches. A range of n parts has a grid of n times n tasks: a point goes to its row of it, a query to its column."""

    def f(batches):
        for b in batches:
            lat, lng, code = (b.column(c).to_numpy(zero_copy_only=False) for c in ("lat", "lng", "code"))
            home = np.searchsorted(bounds, code, side="right")
            lo, hi = cover(cells_of(sphere(lat, lng), edge), code)
            first, last = np.searchsorted(bounds, lo, side="right"), np.searchsorted(bounds, hi, side="right")
            last = np.where(hi < lo, first - 1, last)
            row, pid, salt, query = [], [], [], []
            n = salts[home]
            at = np.repeat(np.arange(len(code)), n)
            own = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            part = (b.column("id").to_numpy(zero_copy_only=False).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            row.append(at), pid.append(home[at]), salt.append(own * salts[home[at]] + part[at] % salts[home[at]]), query.append(np.zeros(len(at), dtype=np.int8))
            width = np.clip(last - first + 1, 0, None)
            at = np.repeat(np.arange(len(code)), width.sum(axis=1))
            flat = np.repeat(first.ravel(), width.ravel()) + np.arange(width.sum()) - np.repeat(np.cumsum(width.ravel()) - width.ravel(), width.ravel())
            pairs = np.unique(at.astype(np.int64) * (len(salts) + 1) + flat) if len(at) else np.empty(0, dtype=np.int64)
            at, to = pairs // (len(salts) + 1), pairs % (len(salts) + 1)
            n = salts[to]
            own = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at, to = np.repeat(at, n), np.repeat(to, n)
            row.append(at), pid.append(to), salt.append(part[at] % salts[to] * salts[to] + own), query.append(np.ones(len(at), dtype=np.int8))
            take = pa.array(np.concatenate(row))
            kept = [b.column(c).take(take) for c in ("id", "lat", "lng", "grp", "code")]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(pid).astype(np.int32)), pa.array(np.concatenate(salt).astype(np.int32)), pa.array(np.concatenate(query)), *kept], names=["pid", "salt", "query", "id", "lat", "lng", "grp", "code"])

    return f


def _refine(radius_km: float, edge: float):
    """Within one code range: binary search of every query's ranges in the sorted codes, then the exact distance."""

    def f(t: pa.Table) -> pa.Table:
        order = np.lexsort((t.column("id").to_numpy(), t.column("code").to_numpy()))
        lat, lng, code, ids, query = (t.column(c).to_numpy()[order] for c in ("lat", "lng", "code", "id", "query"))
        grp = t.column("grp").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)[order]
        p, q = np.flatnonzero(query == 0), np.flatnonzero(query == 1)
        out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        la, lo_ = np.radians(lat), np.radians(lng)
        per = 50_000
        for start in range(0, len(q) if len(p) else 0, per):
            mine = q[start : start + per]
            lo, hi = cover(cells_of(sphere(lat[mine], lng[mine]), edge), code[mine])
            first, last = np.searchsorted(code[p], lo, "left"), np.searchsorted(code[p], hi, "right")
            n = np.where(hi < lo, 0, last - first).ravel()
            src, first = np.repeat(mine, lo.shape[1])[n > 0], first.ravel()[n > 0]
            n = n[n > 0]
            ends = np.cumsum(n)
            cut = 0
            while cut < len(n):
                base = ends[cut - 1] if cut else 0
                stop = max(int(np.searchsorted(ends, base + CHUNK, "right")), cut + 1)
                m = n[cut:stop]
                i = np.repeat(src[cut:stop], m)
                j = p[np.repeat(first[cut:stop], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)]
                keep = ((code[i] < code[j]) | (ids[i] < ids[j])) & (ids[i] != ids[j]) & (grp[i] == grp[j])
                i, j = i[keep], j[keep]
                h = np.sin((la[i] - la[j]) / 2) ** 2 + np.cos(la[i]) * np.cos(la[j]) * np.sin((lo_[i] - lo_[j]) / 2) ** 2
                near = 2 * EARTH_KM * np.arcsin(np.sqrt(np.clip(h, 0, 1))) <= radius_km
                out_a.append(np.minimum(ids[i], ids[j])[near]), out_b.append(np.maximum(ids[i], ids[j])[near])
                cut = stop
        return pa.table([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], schema=PAIRS)

    return f


def pairs_within(df: DataFrame, id_col: str, lat: Column, lng: Column, radius_km: float, group: Column | None = None, target: int = TARGET) -> DataFrame:
    """All pairs (a_id < b_id) of rows of ``df`` at most ``radius_km`` apart on the sphere, and of the same non-null ``group`` if given.

    Rows without an id, without a valid point or (with ``group``) without a group are in no pair; repeated rows of an
    id count once for each distinct point but yield no pair with themselves, and each pair comes once. An empty table
    gives no rows. Columns of ``df`` other than those used are ignored, so their names cannot clash.
    """
    points = df.select(F.col(id_col).cast("long").alias("id"), lat.cast("double").alias("lat"), lng.cast("double").alias("lng"), (F.lit("") if group is None else group.cast("string")).alias("grp"))
    points = points.where(F.col("id").isNotNull() & F.col("grp").isNotNull() & valid_point(F.col("lat"), F.col("lng"))).distinct()
    edge = edge_of(radius_km)
    coded = points.mapInArrow(_codes(edge), "id long, lat double, lng double, grp string, code long")
    total = coded.count()
    n = max(math.ceil(total / target), 1)
    cuts = coded.agg(F.percentile_approx("code", [k / n for k in range(1, n)], F.lit(max(10_000, 4 * n)))).first()[0] if n > 1 else []
    bounds, often = np.unique(np.array(cuts, dtype=np.int64), return_counts=True)
    salts = np.ones(len(bounds) + 1, dtype=np.int64)  # searchsorted(right): the range after a bound starts with the bound's own code
    salts[1:] = np.maximum(often, 1)
    routed = coded.mapInArrow(_route(edge, bounds, salts), "pid int, salt int, query byte, id long, lat double, lng double, grp string, code long")
    found = routed.groupBy("pid", "salt").applyInArrow(_refine(radius_km, edge), "a_id long, b_id long")
    return found.distinct()


def venue_pairs(geocode: DataFrame, radius_km: float = 1.0) -> DataFrame:
    """Pairs of geocode_cache rows close by; of a geo_key only its latest lookup counts (ties: the greatest geo_id), and none at 0/0. Rows without a key count one by one."""
    last = geocode.groupBy(F.coalesce("geo_key", F.concat(F.lit("\u0000"), F.col("geo_id").cast("string"))).alias("k")).agg(F.max(F.struct("geocoded_at", "geo_id", "lat", "lng")).alias("r")).select("r.*")
    there = last.where(~((F.col("lat") == 0) & (F.col("lng") == 0)))
    return pairs_within(there, "geo_id", F.col("lat"), F.col("lng"), radius_km)


def city_pairs(city_rep: DataFrame, radius_km: float = 35.0) -> DataFrame:
    """Pairs of city_rep rows of one country whose centroids are close by; only rows with located concerts."""
    there = city_rep.where(F.col("geo_count") > 0)
    return pairs_within(there, "rep_id", F.col("lat_sum") / F.col("geo_count"), F.col("lng_sum") / F.col("geo_count"), radius_km, F.col("country"))


def nearby(geocode: DataFrame, city_rep: DataFrame) -> DataFrame:
    return venue_pairs(geocode).select(F.lit("venue").alias("place_kind"), "a_id", "b_id").unionByName(city_pairs(city_rep).select(F.lit("city").alias("place_kind"), "a_id", "b_id"))
