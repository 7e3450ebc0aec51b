"""What all operators need of a session: tables, and a checkpoint in the folder that the cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Small rows dealt by their keys over the session's shuffle partitions, before they grow: neither a file of one row group nor Spark's joining of small partitions leaves the work to one task."""
    return df.repartition(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to spark.checkpoint.dir; without one a session on one machine (tests) gets a local folder, any other an error."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="maskwright-"))
    return df.checkpoint()
