"""Sinks. Each writes what Spark's writers can write, in parts, and nothing goes through the driver. Encoders of pictures and of binary DICOM files are outside of this engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import media
from ..operators.delivery import masked_paths
from ..operators.identity import labelled, mailmap
from ..operators.records import delivered_path


def write_mailmap(key: DataFrame, path: str) -> None:
    """Lines in the order of numbers."""
    mailmap(key).orderBy("n").select("line").write.mode("overwrite").text(path)


def write_persona_key(key: DataFrame, path: str) -> None:
    """The table that leads back to people, in a folder that its owner alone may open."""
    labelled(key).select("identity", "label").write.mode("overwrite").json(path)
    restrict(key.sparkSession, path)


def restrict(spark: SparkSession, path: str) -> None:
    """Take a folder from all but its owner."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).setPermission(at, jvm.org.apache.hadoop.fs.permission.FsPermission("700"))


def write_rules(rules: DataFrame, path: str) -> None:
    """rules: ordinal, lhs, rhs; lines in their order."""
    rules.orderBy("ordinal").select(F.concat("lhs", F.lit("==>"), "rhs").alias("line")).write.mode("overwrite").text(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("overwrite").option("header", True).csv(path)


def write_spans(spans: DataFrame, path: str) -> None:
    """One JSON row for each file, its spans in order."""
    own = F.array_sort(F.collect_list(F.struct("start", "end", "reason", "heard")))
    spans.groupBy("file").agg(own.alias("spans")).write.mode("overwrite").json(path)


def archives(entries: DataFrame) -> DataFrame:
    """archive, content of rebuilt archives from archive, ordinal, entry, content. An archive is one task's work, as it must fit in one file."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", F.col("entry").alias("name"), "content"))), lambda e: F.struct(e["name"].alias("name"), e["content"].alias("content")))
    return entries.groupBy("archive").agg(listed.alias("_e")).select("archive", media.zip_of("_e").alias("content"))


def file_digests(files: DataFrame) -> DataFrame:
    return files.select("path", "size", F.sha2("content", 256).alias("sha256"))


def write_masked(texts: DataFrame, mask: Callable[[Column], Column], path: str) -> None:
    """Texts (path, text) with both masked alike; path is the one below the delivery's folder."""
    masked_paths(texts, mask).select("path", "text").write.mode("overwrite").parquet(path)


def write_survivors(transcripts: DataFrame, path: str) -> None:
    """One JSON row for each finished recording: its segments and what is still heard in it."""
    transcripts.write.mode("overwrite").json(path)


def write_elements(elements: DataFrame, key: DataFrame, path: str) -> None:
    """Finished records, each file below its patient's pseudonym; files of patients without a key aren't written."""
    placed = elements.join(key.select("patient", "pseudo_id"), "patient").withColumn("file", delivered_path(F.col("file"), F.col("pseudo_id")))
    placed.drop("patient", "pseudo_id").write.mode("overwrite").parquet(path)
