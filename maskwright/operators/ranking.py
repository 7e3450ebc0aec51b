"""Dense numbers over a whole table without one task that sees it all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def numbered(df: DataFrame, order: list[str], name: str = "n", first: int = 1) -> DataFrame:
    """df with consecutive numbers in the given order, from `first` on.

    Rows are range-partitioned and the partition number is frozen by a checkpoint; each partition numbers its own rows, and one row
    for each partition says how many come before. Rows that tie are numbered in a fixed but arbitrary order.
    """
    dealt = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_part").orderBy(*order)
    return dealt.withColumn("_row", F.row_number().over(own)).join(F.broadcast(sizes), "_part").withColumn(name, (F.col("_before") + F.col("_row") + (first - 1)).cast("long")).drop("_part", "_row", "_before")
