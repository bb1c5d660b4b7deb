"""Unions of intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interval_union(df: DataFrame, keys: list[str], first: str = "first", last: str = "last") -> DataFrame:
    """Merge overlapping or touching intervals within each key."""
    order = Window.partitionBy(*keys).orderBy(first, last)
    reach = F.max(last).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = df.withColumn("_new", F.when(F.col(first) <= reach, 0).otherwise(1))
    group = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return new.withColumn("_group", group).groupBy(*keys, "_group").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("_group")
