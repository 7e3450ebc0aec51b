"""Readers with declared schemas; a file that can't be parsed gives no row, and nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import media, patterns as P
from ..functions.detect import is_read_source, one_of, path_suffix
from ..operators.records import flattened
from ..operators.speech import TRANSCRIPT

OBJECTS = "repo string, sha string, type string, size long, content binary"
SECRETS = "Secret string"


def files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Binary files below a folder: path, length, content. Filters on path and length reach the scan; content is read only where selected."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", F.col("length").alias("size"), "content")


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """Texts of source trees, without pruned folders, other suffixes and large files."""
    return files(spark, path).filter(is_read_source(F.col("path"), F.col("size"))).withColumn("text", F.make_valid_utf8(F.col("content").cast("string"))).drop("content")


def text_exports(spark: SparkSession, path: str) -> DataFrame:
    return files(spark, path).filter(one_of(path_suffix(F.col("path")), P.TEXT_SUFFIXES)).withColumn("text", F.make_valid_utf8(F.col("content").cast("string"))).drop("content")


def images(spark: SparkSession, path: str) -> DataFrame:
    return files(spark, path).filter(one_of(path_suffix(F.col("path")), P.IMAGE_SUFFIXES))


def zip_contents(spark: SparkSession, path: str) -> DataFrame:
    """archive, entry, content of all archives below a folder."""
    return files(spark, path, "*.zip").select(F.col("path").alias("archive"), F.explode(media.zip_entries("content")).alias("_e")).select("archive", F.col("_e.name").alias("entry"), F.col("_e.content").alias("content"))


def objects(spark: SparkSession, path: str) -> DataFrame:
    """Exported objects of a history, as Parquet."""
    return spark.read.schema(OBJECTS).parquet(path)


def secret_reports(spark: SparkSession, path: str) -> DataFrame:
    """Different secrets of all JSON reports, each an array of objects."""
    return spark.read.schema(SECRETS).option("multiLine", True).option("mode", "DROPMALFORMED").json(path).filter("Secret is not null").distinct()


def rules(spark: SparkSession, path: str) -> DataFrame:
    """ordinal-free rules of a replacement file: kind (literal, regex, glob), lhs, rhs."""
    line = F.col("value")
    kind = F.when(line.startswith("regex:"), "regex").when(line.startswith("glob:"), "glob").otherwise("literal")
    bare = F.regexp_replace(line, "^(regex:|glob:)", "")
    cut = F.instr(bare, "==>")
    lhs = F.when(cut > 0, F.substring(bare, F.lit(1), cut - 1)).otherwise(bare)
    return spark.read.text(path).filter(line != "").select(kind.alias("kind"), lhs.alias("lhs"), F.when(cut > 0, F.substring(bare, cut + 3, F.length(bare))).otherwise("***REMOVED***").alias("rhs"))


def tokens(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """Tokens, one a line; blank lines and those with # don't count. A required list that is empty is an error, as nothing would be looked for."""
    out = spark.read.text(path).select(F.trim("value").alias("token")).filter((F.col("token") != "") & ~F.col("token").startswith("#"))
    if required and out.isEmpty():
        raise ValueError(f"no tokens in {path}")
    return out


def mapping(spark: SparkSession, path: str) -> DataFrame:
    """original, replacement of a JSON object, or the originals of a JSON array."""
    whole = spark.read.text(path, wholetext=True)
    pairs = whole.select(F.explode_outer(F.from_json("value", "map<string,string>")).alias("original", "replacement")).filter("original is not null")
    listed = whole.select(F.explode_outer(F.from_json("value", "array<string>")).alias("original")).filter("original is not null")
    return pairs.unionByName(listed.withColumn("replacement", F.lit(None).cast("string")))


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRANSCRIPT).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def recordings(spark: SparkSession, path: str) -> DataFrame:
    """file, sr, samples of 16-bit mono sound; other recordings are left out."""

    @F.pandas_udf("struct<sr: int, samples: array<short>>")
    def parse(content):
        import pandas as pd

        found = [media.wav_samples(c) for c in content]
        return pd.DataFrame({"sr": [f and f[0] for f in found], "samples": [f and f[1] for f in found]})

    return files(spark, path, "*.wav").select(F.col("path").alias("file"), parse("content").alias("_s")).select("file", "_s.sr", "_s.samples").filter("sr is not null")


def dicom_json(spark: SparkSession, path: str) -> DataFrame:
    """Elements of records in the JSON model of the DICOM standard, one file each, in a folder for each patient: file, patient and what records.flattened gives. The
    decoder of binary files is outside of this engine; what can't be read gives no rows."""
    whole = files(spark, path).select(F.col("path").alias("file"), F.element_at(F.split("path", "/"), -2).alias("patient"), F.col("content").cast("string").alias("content"))
    return flattened(whole, "content", "file", "patient")
