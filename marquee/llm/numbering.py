"""Consecutive numbers in an order, over any number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import sent_if_small, stored


def numbered(rows: DataFrame, group: str, order: list[str | Column], name: str) -> DataFrame:
    """`rows` with the place of each, 0 for the first, in the order of its group; nulls come first.

    Rows are range-partitioned by group and order, so that no group has to fit into a task, and
    written with their place in their partition. What came before a partition is a sum over one row
    for each partition and group. End `order` with a column that differs in all rows: equal rows
    cannot be divided.
    """
    by = [group, *order]
    placed = stored(
        rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.select(
        F.col(group).alias("_group"), F.col("_part").alias("_of"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_base"),
    )
    same = (F.col("_part") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group"))
    return placed.join(sent_if_small(bases), same).withColumn(name, F.col("_at") + F.col("_base")).drop(
        "_at", "_part", "_of", "_group", "_base"
    )
