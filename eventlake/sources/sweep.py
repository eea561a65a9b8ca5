"""Sweeps of a service: targets are asked for one after another, page by page, until a rule ends them.

A service's key allows so many requests a second, so a sweep is one task on purpose: its rows are answers, few beside what
they hold, and everything after it (reading the bodies, the cache) is distributed again. Whoever fetches is passed in.
"""

from __future__ import annotations

import json
import time

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.sources.html import dig
from eventlake.sources.http import _getter, is_private, urlsplit

ANSWERS = "key string, page int, status int, body string, outcome string"


def sweep(targets: DataFrame, url: str, getter: str = "urllib", pages: int = 1, total: str | None = None, items: str | None = None, misses: tuple[int, ...] = (), aborts: tuple[int, ...] = (), streak: int = 5, cap: int | None = None, spacing: float = 0.0) -> DataFrame:
    """(key, page, status, body, outcome) of the targets (key, ord) in order; ``url`` has {key} and {page}, pages counted from 0.

    outcome is ``ok``; ``miss`` for a status of ``misses``, which counts as an answer without events; ``failed`` for any other
    status or error, or a body without ``items`` where that path is given. ``streak`` failed targets in a row, or a status of
    ``aborts``, end the sweep: all further targets are ``stopped``, so that their cached rows can stand in. After ``cap`` targets
    with an answer further ones are ``later``; failed ones cost nothing. A target's pages end with the number at the path
    ``total``, with a page of no items, with a failure (what came before is kept) or at ``pages``. Null keys are left out.
    """

    def run(batches):
        get, bad, done, over = _getter(getter), 0, 0, False
        for b in batches:
            rows = []
            for key in b.column(0).to_pylist():
                if over or (cap is not None and done >= cap):
                    rows.append((key, None, None, None, "stopped" if over else "later"))
                    continue
                outcome = "failed"
                for page in range(pages):
                    if spacing and (done or bad or page):
                        time.sleep(spacing)
                    address = url.replace("{key}", key).replace("{page}", str(page))
                    try:
                        status, body, _ = (None, None, None) if is_private(urlsplit(address).hostname) else get(address, {})
                        tree = json.loads(body) if body and (total or items) else None
                    except Exception:
                        status, body, tree = None, None, None
                    good = status is not None and 200 <= status < 300 and (not items or isinstance(dig(tree, items), list))
                    outcome = "ok" if good else "miss" if status in misses else "failed"
                    rows.append((key, page, status, body if good else None, outcome))
                    over = over or status in aborts
                    if not good or (items and not dig(tree, items)) or (total and page + 1 >= int(dig(tree, total) or 0)):
                        break
                bad = bad + 1 if outcome == "failed" else 0
                done += outcome != "failed"
                over = over or bad >= streak
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["key", "page", "status", "body", "outcome"])

    wanted = targets.where(F.col("key").isNotNull()).select(F.col("key").cast("string").alias("key"), "ord")
    return wanted.repartition(1).sortWithinPartitions("ord", "key").mapInArrow(run, ANSWERS)


def swept_rows(answers: DataFrame, fresh: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """Events after a sweep: fresh ones, and the cached ones of targets that failed before they yielded any or were not asked."""
    whole = answers.groupBy("key").agg(F.max(F.col("outcome").isin("ok", "miss")).alias("_ok")).where("NOT _ok").select(F.col("key").alias(key))
    return fresh.unionByName(cache.join(whole, key, "left_semi").select(*fresh.columns))
