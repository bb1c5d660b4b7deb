"""Places in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.sources.shared import ensure_checkpoints


def with_place(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """Place of each row in the given order, from 0; checkpointed, so that several uses share one sort.

    One distributed sort, which cuts ranges by quantiles of all order columns
    (so crowded values are dealt out too); a place is the one in its sorted
    partition plus the sizes of the partitions before, one number for each task.
    """
    ensure_checkpoints(df.sparkSession)
    placed = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_at", 33)
    ahead, before = [], 0
    for number, n in sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect()):
        ahead += [F.lit(number), F.lit(before)]
        before += n
    start = F.element_at(F.create_map(*ahead), part) if ahead else F.lit(0)
    return placed.withColumn(name, (start + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")).drop("_at")


def count_below(points: DataFrame, queries: DataFrame, name: str) -> DataFrame:
    """For each query the number of points whose ``v`` is below its own; ``v`` goes, other columns stay.

    Both are sorted together once, in ranges; a count is the one within a
    range plus the points of the ranges before, one number for each task.
    """
    ensure_checkpoints(points.sparkSession)
    columns = [c for c in queries.columns if c != "v"]
    both = queries.select("v", F.lit(0).alias("_point"), F.struct(*columns).alias("_q")).unionByName(points.select("v", F.lit(1).alias("_point")), allowMissingColumns=True)
    placed = both.orderBy("v", "_point", "_q").withColumn("_at", F.monotonically_increasing_id()).checkpoint().withColumn("_part", F.shiftright("_at", 33))
    ahead, before = [], 0
    for number, n in sorted(tuple(r) for r in placed.groupBy("_part").agg(F.sum("_point")).collect()):
        ahead += [F.lit(number), F.lit(before)]
        before += n
    start = F.element_at(F.create_map(*ahead), F.col("_part")) if ahead else F.lit(0)
    own = F.sum("_point").over(Window.partitionBy("_part").orderBy("_at"))
    return placed.withColumn("_own", own).filter("_point = 0").select("_q.*", (start + F.col("_own")).cast("long").alias(name))


def steps_down(df: DataFrame, x: str, y: str, cell: int = 4096) -> DataFrame:
    """Rows by falling ``x`` (distinct) with ``x1``, the ``x`` ahead, and ``y1``, the least ``y`` of all ahead; the first row has none.

    Only one row for each ``cell`` rows is ordered as a whole.
    """
    placed = with_place(df, F.desc(x), name="_r").withColumn("_cell", F.floor(F.col("_r") / cell))
    whole = Window.orderBy("_cell")
    cells = placed.groupBy("_cell").agg(F.min(y).alias("_y"), F.min(x).alias("_x"))
    cells = cells.select("_cell", F.lag("_x").over(whole).alias("_x"), F.min("_y").over(whole.rowsBetween(Window.unboundedPreceding, -1)).alias("_y"))
    w = Window.partitionBy("_cell").orderBy("_r")
    rows = placed.join(cells, "_cell")
    ahead = F.least(F.min(y).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("_y"))
    return rows.withColumns({"x1": F.coalesce(F.lag(x).over(w), F.col("_x")), "y1": ahead}).drop("_r", "_cell", "_x", "_y")
