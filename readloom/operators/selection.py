"""Exact order statistics of columns of any size."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells that a pass counts, and values that are sorted outright.
CELLS = 4096
SORTED = 10_000


def _counts(values: DataFrame, low: float, high: float) -> list[tuple[int, float, float]]:
    """Size, least and greatest value of each cell of ``[low, high]``, in order; rows outside are left out."""
    inside = values.filter(F.col("v").between(F.lit(low), F.lit(high)))
    # halves, so that a range of the largest numbers doesn't overflow
    share = (F.col("v") / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
    cell = F.least(F.floor(share * CELLS), F.lit(CELLS - 1)) if high / 2 > low / 2 else F.col("v")
    found = inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
    return sorted(((r["n"], r["low"], r["high"]) for r in found), key=lambda c: c[1])


def _select(values: DataFrame, ranks: Iterable[int], low: float, high: float, before: int, out: dict[int, float]) -> None:
    """Values at ``ranks`` (from 0) of all rows, which lie in ``[low, high]`` behind ``before`` smaller rows."""
    open_: dict[tuple[int, int, float, float], list[int]] = {}
    cells = _counts(values, low, high)
    for rank in ranks:
        ahead = before
        for n, first, last in cells:
            if rank < ahead + n:
                break
            ahead += n
        if first == last:
            out[rank] = first
        else:
            open_.setdefault((ahead, n, first, last), []).append(rank)
    for (ahead, n, first, last), own in open_.items():
        if n <= SORTED:
            kept = sorted(r["v"] for r in values.filter(F.col("v").between(F.lit(first), F.lit(last))).collect())
            out |= {rank: kept[rank - ahead] for rank in own}
        else:
            _select(values, own, first, last, ahead, out)


def exact_quantiles(df: DataFrame, col: Column | str, shares: Iterable[float]) -> list[float | None]:
    """Quantiles between neighbouring values, as ``percentile`` gives them, in bounded memory.

    A pass counts ``CELLS`` cells between the least and the greatest value, and
    the next looks only into the cell that holds the rank, from its own least to
    its greatest value, until the cell is one value or has at most ``SORTED``
    rows, which are sorted.  The number of passes follows the logarithm of the
    rows; no aggregate holds more than ``CELLS`` entries.  Nulls, NaN and
    infinite values don't count; without any other value quantiles are None.
    """
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    values = df.select(value.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < F.lit(float("inf"))))
    n, low, high = values.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    shares = list(shares)
    if not n:
        return [None] * len(shares)
    places = [share * (n - 1) for share in shares]
    out: dict[int, float] = {}
    _select(values, sorted({f(p) for p in places for f in (math.floor, math.ceil)}), low, high, 0, out)
    return [out[math.floor(p)] if p == math.floor(p) else (math.ceil(p) - p) * out[math.floor(p)] + (p - math.floor(p)) * out[math.ceil(p)] for p in places]
