"""Keys that grow from batch to batch with their numbers kept, and a watch on new texts.

The reference behaviour is a key carried from run to run; doing it for each micro-batch of a stream is an extension.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import detect
from ..operators.identity import extended_key

KEY = "identity string, n long"


def current_key(spark: SparkSession, folder: str) -> DataFrame:
    """The key of the last whole version below a folder; empty at first."""
    version = _last(spark, folder)
    return spark.createDataFrame([], KEY) if version is None else spark.read.schema(KEY).parquet(f"{folder}/v={version}")


def _last(spark: SparkSession, folder: str) -> int | None:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    done = [int(s.getPath().getName()[2:]) for s in fs.listStatus(path) if s.getPath().getName().startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return max(done, default=None)


def carry_forward(folder: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: adds a batch's identities to the key. A batch that is run again finds its version done, so numbers never change."""

    def add(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        last = _last(spark, folder)
        if last is not None and last >= epoch:
            return
        extended_key(current_key(spark, folder), batch.select("identity").filter("identity is not null")).write.mode("overwrite").parquet(f"{folder}/v={epoch}")

    return add


def watched_findings(stream: DataFrame) -> DataFrame:
    """Card numbers and credentials of each new text (doc_id, text, ts) as it comes; stateless."""
    return stream.select("doc_id", "ts", F.size(detect.card_numbers(F.col("text"))).alias("cards"), F.size(detect.quoted_credentials(F.col("text"))).alias("credentials")).filter("cards + credentials > 0")


def windowed_findings(found: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    return found.withWatermark("ts", late).groupBy(F.window("ts", width)).agg(F.sum("cards").alias("cards"), F.sum("credentials").alias("credentials"))
