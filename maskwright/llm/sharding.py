"""Contiguous shards of equal bytes from a global prefix sum. DataFrame functions only.

The prefix sum is taken in two levels. Rows are range-partitioned by their order column and the
partition number is frozen by a checkpoint; every partition then has a running sum of its own, and
the totals of the partitions (one row each) give what lies before it. Nothing but those totals meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut_lineage, partitions

#: What each row costs besides its text, in bytes.
ROW_OVERHEAD = 8


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, order: list[str], size: str, parts: int | None = None) -> DataFrame:
    """df with `before` (sizes of all earlier rows), `position` (number of earlier rows) and `total`.

    Ties in `order` are taken in any fixed order; nulls come first. `df` should be narrow: it is checkpointed.
    """
    parts = parts or partitions(df.sparkSession)
    dealt = cut_lineage(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    # one row per partition: its number is bounded by `parts`, so it may meet in one task and be broadcast
    totals = dealt.groupBy("_part").agg(F.sum(size).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    totals = totals.select(
        "_part",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_sum").over(everything).alias("total"),
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        dealt.withColumn("_run", F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_row", F.row_number().over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(F.broadcast(totals), "_part")
        .withColumn("before", F.col("_sum_before") + F.col("_run") - F.col(size))
        .withColumn("position", F.col("_rows_before") + F.col("_row") - 1)
        .drop("_part", "_run", "_row", "_sum_before", "_rows_before")
    )


def shard_by_bytes(df: DataFrame, shards: int = 24, order: str = "doc_id", text: str = "text") -> DataFrame:
    """Deal rows, in `order`, into contiguous shards whose bytes differ by about one row.

    A row's size is the UTF-8 length of its text (null: none) plus 8; it goes where its middle byte lies
    among equal cuts of the total. Returns `order`, size, text_crc32 (null text: that of no bytes), shard and
    slot (place in the shard, from 0). Rows with a null order value come first; ties and repeated rows
    get places of their own in a fixed order; an empty table gives no rows; other columns are ignored.
    """
    narrow = df.select(
        F.col(order),
        (text_bytes(F.col(text)) + ROW_OVERHEAD).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = prefix_sums(narrow, [order, "text_crc32", "size"], "size").withColumn(
        "shard", F.expr(f"cast(least({shards - 1}, ((2 * before + size) * {shards}) div (2 * total)) as int)")
    )
    # one row per shard
    first = placed.groupBy("shard").agg(F.min("position").alias("_first"))
    return (
        placed.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("position") - F.col("_first"))
        .select(order, "size", "text_crc32", "shard", "slot")
    )
