"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "qaspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by the cluster; where none is named, one beside the session's own stored tables.

    On a cluster that folder has to be one that all machines see: a local one is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a shared folder; {warehouse} is local to a machine")
    return f"{warehouse}/_intermediate"


def delete_table(spark: SparkSession, path: str) -> None:
    """Remove a superseded intermediate table from whatever file system holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_through(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the checkpoint folder and return the table read back. Runs a job at once.

    The result has no lineage, survives the loss of executors and has an exact size on
    disk, so Spark's own ``autoBroadcastJoinThreshold`` can decide on a broadcast.
    """
    return measured_write(df, name)[0]


def measured_write(df: DataFrame, name: str = "table", **metrics: Column) -> tuple[DataFrame, dict]:
    """``write_through`` and aggregates over the written rows, all from the same job."""
    return _write(df, name, metrics)[:2]


def _write(df: DataFrame, name: str, metrics: dict[str, Column], by: str | None = None) -> tuple[DataFrame, dict, str]:
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/qaspark/{name}-{uuid.uuid4().hex}"
    seen = Observation()
    watched = df.observe(seen, *[c.alias(n) for n, c in metrics.items()]) if metrics else df
    (watched.write.partitionBy(by) if by else watched.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path), (seen.get if metrics else {}), path


class Scratch:
    """Tables that are deleted together when the block ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *problem) -> None:
        for path in self.paths:
            delete_table(self.spark, path)

    def write(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        table, seen, path = _write(df, name, metrics)
        self.paths.append(path)
        return table, seen


class Rounds:
    """The tables of a loop: each round is written, and the round it was made from is deleted once it is."""

    def __init__(self, name: str):
        self.name = name
        self.last: str | None = None

    def write(self, df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
        table, seen, path = _write(df, self.name, metrics)
        if self.last:
            delete_table(df.sparkSession, self.last)
        self.last = path
        return table, seen


def few_files(df: DataFrame, rows: int, per_file: int = 100_000) -> DataFrame:
    """``df`` in no more partitions, so files, than its ``rows`` (counted, or the most there can be) need.

    Each local file costs its writer processes that set its permissions; a small table spread over all shuffle partitions is
    mostly that. A large table keeps its partitions.
    """
    return df.coalesce(max(1, -(-rows // per_file)))


def broadcast_if_small(df: DataFrame, rows: int, most: int = 200_000) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` (of a few short columns) are at most ``most``; else as it is."""
    return F.broadcast(df) if rows <= most else df
