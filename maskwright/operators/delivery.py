"""Operators on what is delivered: same columns, reconciled halves, positions that pair, digests that hold."""

from __future__ import annotations

import hashlib
import json

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import detect, patterns as P
from . import gates
from .ranking import numbered


def projected(df: DataFrame, header: list[str]) -> DataFrame:
    """The columns of an earlier delivery in their order; those that df lacks are empty strings."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in header))


def constant(df: DataFrame, values: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def not_constant(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the number of different values of each column; each must be 1."""
    return df.agg(*(F.count_distinct(F.col(c)).alias(c) for c in columns))


def reconciled(whole: DataFrame, parts: list[DataFrame], key: str, measure: str) -> DataFrame:
    """Whether parts are disjoint and make up the whole, each key once: counts of violations, and the sums of a measure on both sides."""
    both = whole.select(key, F.col(measure).alias("_m"), F.lit(1).alias("_w"), F.lit(0).alias("_p"))
    for p in parts:
        both = both.unionByName(p.select(key, F.col(measure).alias("_m"), F.lit(0).alias("_w"), F.lit(1).alias("_p")))
    each = both.groupBy(key).agg(F.sum("_w").alias("_w"), F.sum("_p").alias("_p"), F.sum(F.col("_m") * F.col("_w")).alias("_a"), F.sum(F.col("_m") * F.col("_p")).alias("_b"))
    return each.agg(
        F.count_if((F.col("_w") > 0) & (F.col("_p") == 0)).alias("missing"),
        F.count_if((F.col("_w") == 0) & (F.col("_p") > 0)).alias("extra"),
        F.count_if(F.col("_p") > 1).alias("repeated"),
        F.round(F.sum("_a"), 2).alias("whole_sum"),
        F.round(F.sum("_b"), 2).alias("parts_sum"),
    )


def ledger_overlap(deliveries: DataFrame) -> DataFrame:
    """Items that went to several recipients, with the sorted list of them. A group's list is as long as there are recipients, not deliveries."""
    once = deliveries.select("item", "recipient").distinct()
    return once.groupBy("item").agg(F.array_join(F.array_sort(F.collect_list("recipient")), ",").alias("recipients"), F.count(F.lit(1)).alias("n")).filter("n > 1")


def match_rate(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many rows of left find their key in right; a rate of nothing means that the join is wrong."""
    marked = left.select(key).join(right.select(key).distinct().withColumn("_there", F.lit(1)), key, "left")
    return marked.agg(F.count(F.lit(1)).alias("checked"), F.count("_there").alias("matched"))


def first_by_basename(files: DataFrame, path: str) -> DataFrame:
    """The first path of each base name, and how many share it; a count above 1 is a collision that must be told."""
    name = F.substring_index(F.col(path), "/", -1)
    return files.withColumn("basename", name).groupBy("basename").agg(F.min(path).alias(path), F.count(F.lit(1)).alias("n"))


def pages_of(df: DataFrame, group: str, order: str, each: int = 12) -> DataFrame:
    """df with the number of its contact sheet in each group, and the place on it. Rows are numbered over all groups at once, so a large group is no one task's work."""
    dense = numbered(df, [group, order], "_n")
    first = dense.groupBy(group).agg(F.min("_n").alias("_first"))
    row = F.col("_n") - F.col("_first")
    placed = dense.join(first, dense[group].eqNullSafe(first[group])).drop(first[group])
    return placed.withColumn("sheet", (F.floor(row / each) + 1).cast("long")).withColumn("place", F.pmod(row, F.lit(each)).cast("long")).drop("_n", "_first")


def with_masked_images(entries: DataFrame, masked: DataFrame) -> DataFrame:
    """Entries of archives (archive, ordinal, entry, content) with each image's content from the masked images (path, content) of the same base name, the first by path.

    Adds status: swapped, missing (an image without a masked version, which must not be delivered) or kept (no image).
    """
    name = F.substring_index("path", "/", -1)
    by_name = masked.groupBy(name.alias("_name")).agg(F.min_by("content", "path").alias("_masked"))
    is_image = detect.one_of(detect.path_suffix(F.col("entry")), P.IMAGE_SUFFIXES)
    joined = entries.withColumn("_image", is_image).withColumn("_key", F.when(is_image, F.substring_index("entry", "/", -1))).join(by_name, F.col("_key") == F.col("_name"), "left")
    status = F.when(~F.col("_image"), "kept").when(F.col("_masked").isNull(), "missing").otherwise("swapped")
    content = F.when(status == "swapped", F.col("_masked")).otherwise(F.col("content"))
    return joined.select("archive", "ordinal", "entry", content.alias("content"), status.alias("status"))


def still_original(entries: DataFrame, originals: DataFrame, content: str = "content") -> DataFrame:
    """Entries whose bytes are those of an original file, by digest."""
    digest = originals.select(F.md5(content).alias("_md5")).distinct()
    return entries.withColumn("_md5", F.md5(content)).join(digest, "_md5", "left_semi").drop("_md5")


def archive_gate(rebuilt: DataFrame, originals: DataFrame) -> DataFrame:
    """Verdicts on rebuilt archives: images without a masked version, and entries that are still an original."""
    same = still_original(rebuilt, originals)
    n = rebuilt.agg(F.count(F.lit(1)).alias("checked"))
    return gates.gate("masked images", rebuilt.filter("status <> 'kept'"), F.col("status") == "missing").union(gates.counted("identical entries", n.crossJoin(same.agg(F.count(F.lit(1)).alias("violations")))))  # one row each


def manifest(commits: DataFrame, residual: DataFrame, remotes: DataFrame) -> DataFrame:
    """repo, commits, authors, residual, remotes, status of commits (repo, author), names that are no label (repo, name) and remotes (repo)."""
    by = lambda df, n: df.groupBy("repo").agg(n)
    out = commits.groupBy("repo").agg(F.count(F.lit(1)).alias("commits"), F.count_distinct("author").alias("authors"))
    out = out.join(by(residual, F.count_distinct("name").alias("residual")), "repo", "left").join(by(remotes, F.count(F.lit(1)).alias("remotes")), "repo", "left")
    return gates.package_status(out.fillna(0, ["residual", "remotes"]))


def encoded_path(path: Column) -> Column:
    """A path as one part of a URL: all but letters, digits and -._~ escaped."""
    return F.replace(F.replace(F.replace(F.url_encode(path), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def masked_paths(texts: DataFrame, mask: Callable[[Column], Column]) -> DataFrame:
    """Texts (path, text) with path and text masked alike; a path is the one below the delivery's folder."""
    return texts.withColumn("path", mask(F.col("path"))).withColumn("text", mask(F.col("text")))


@F.pandas_udf(T.StringType())
def sealed_digest(bundles: pd.Series) -> pd.Series:
    """sha256 of a JSON object without its `integrity` block, in canonical form: sorted keys, compact, ASCII. Null for what is no object."""

    def one(text: str | None) -> str | None:
        try:
            bundle = json.loads(text)
        except (TypeError, ValueError):
            return None
        if not isinstance(bundle, dict):
            return None
        bundle.pop("integrity", None)
        return hashlib.sha256(json.dumps(bundle, sort_keys=True, separators=(",", ":"), ensure_ascii=True).encode()).hexdigest()

    return bundles.map(one)
