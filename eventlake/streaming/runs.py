"""The batch operators over streams: deduplicated listings, failure streaks and a change log, one micro-batch a run."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from eventlake.operators import state


def read_tables(spark: SparkSession, path: str, schema, glob: str = "*.parquet", files_per_run: int = 1) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_run).option("pathGlobFilter", glob).parquet(path)


def first_listings(listings: DataFrame, at: str, keys: list[str], late: str = "2 hours") -> DataFrame:
    """The first listing of each key within the watermark; state older than that is dropped."""
    return listings.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def counts_by_window(events: DataFrame, at: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, key, n) of event-time windows; late rows within the watermark count."""
    return events.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def streaks(outcomes: DataFrame, key: str, failed: str, limit: int) -> DataFrame:
    """(key, streak, prune) after each micro-batch: failures in a row, by rows in order of ``at``. One small state a key."""

    def f(k, batches, s: GroupState):
        n = s.get[0] if s.exists else 0
        for bad in pd.concat(list(batches)).sort_values("at")["failed"]:
            n = n + 1 if bad else 0
        s.update((n,))
        yield pd.DataFrame({"k": [k[0]], "streak": [n], "prune": [n >= limit]})

    rows = outcomes.select(F.col(key).cast("string").alias("k"), "at", F.col(failed).alias("failed"))
    return rows.groupBy("k").applyInPandasWithState(f, "k string, streak long, prune boolean", "n long", "update", GroupStateTimeout.NoTimeout)


def run_changelog(listings: DataFrame, key: str, at: str, folder: str, checkpoint: str):
    """Starts a query that, a micro-batch a run, appends keys the run before lacked to ``folder``/changes and keeps the run's keys.

    A batch that is run again overwrites its own files only, so nothing is counted twice.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = spark.read.parquet(f"{folder}/keys/run={number - 1}") if number else spark.createDataFrame([], f"{key} string")
        batch = batch.groupBy(F.col(key).cast("string").alias(key)).agg(F.max(at).alias("detected_at"))
        state.new_keys(batch, known, key).write.mode("overwrite").parquet(f"{folder}/changes/run={number}")
        batch.select(key).write.mode("overwrite").parquet(f"{folder}/keys/run={number}")

    return listings.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
