"""Documents to packed sequences: quality rules, near-duplicates, repeated passages, benchmark passages, packing."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.llm import decontaminate, minhash, packing, quality, substring
from maskwright.llm._common import delete_folder, shared_folder, table
from maskwright.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules: null, empty and short texts go, as they have too few words. Each row is judged where it is read, repeated ones alike; an empty table gives no rows."""
    return quality.quality_rules(docs, carry=tuple(COLUMNS)).filter("kept").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group at a similarity of 0.8 or more. Rows without an id and texts without words all stay; of rows with one id but different texts
    each is judged by its own text; rows that are repeated whole stay or go together."""
    gone = minhash.near_duplicates(docs, rule=minhash.Near(num=80, den=100, words=5)).filter("not kept").select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_text")).distinct()
    return docs.join(gone.hint("shuffle_hash"), (F.col("doc_id") == F.col("_gone")) & (F.xxhash64("text") == F.col("_text")), "left_anti").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words in windows of 13 that also start in a document with a smaller id; a text may be left empty. Rows without an id stay as they are,
    equal rows are one document, and a null text stays null with n_chars 0."""
    found = substring.remove_repeats(docs.select(*COLUMNS), window=13, period=7)
    return found.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.coalesce(F.length("kept_text"), F.lit(0)).cast("long").alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, whole and unchanged; null and empty texts hold none. An empty benchmark keeps all."""
    return decontaminate.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1024 tokens; a null or empty text is its end token alone, and repeated rows are packed each."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeats),
    ("benchmark_passages", drop_contaminated),
    ("packing", pack_sequences),
]

#: Near-duplicates, edit distances and tokens are beyond SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last returns is written to the shared folder and read again. The last of these tables stays, as the result reads it; those before it go."""
    docs = table(spark, sf_dir, "documents")
    folder, last = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last:
            delete_folder(spark, f"{folder}/{last}")
        last = name
    return STAGES[-1][1](spark, docs, sf_dir)
