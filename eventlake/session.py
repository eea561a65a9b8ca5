"""Session factory, the shared checkpoint folder and measured broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(cores: int = 8, partitions: int = 8, app: str = "eventlake") -> SparkSession:
    """A local session with the settings every query is written for (UTC, AQE, skew joins)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session. Where that is unset a temporary one is made, but only
    if all runs in one process; a cluster's nodes would each have another."""
    sc = spark.sparkContext
    here = sc.getCheckpointDir()
    if here:
        return here
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="eventlake-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared folder, so that its lineage ends there and lost executors can read it again."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like :func:`cut`, but as a Parquet table: columns can be pruned and filters pushed when it is read again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # its schema is known: no job has to look for it


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """A broadcast hint only if a count, which stops after ``max_rows``, proves ``df`` small; else Spark's own choice."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than there are cores, dealt out to all: for rows that are few bytes but dear to work on. A large table, of many splits, stays as it is."""
    n = parallelism(df.sparkSession)
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
