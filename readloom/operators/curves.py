"""Local-linear smoothing of a curve of any number of points.

Tricube weights are piecewise polynomials of the distance, so all that a point
needs of its neighbours are moments: of those below it and of those above it.
Points are dealt into blocks by rank, blocks into blocks of blocks, and each
carries its moments about its own middle; a neighbourhood is a few blocks of
every level and the points at its two edges.  Moments are moved from a block's
middle to the point over a distance of the neighbourhood's own size, so nothing
cancels as it would in sums from one origin.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.operators.ranks import count_below, with_place

#: Points of a block, and blocks of a block of the next level.
POINTS, FAN = 64, 8
#: Blocks of a level up to which it is sent to every task (some 1 kB each at most).
SENT = 4096
POWERS = 12
_CHOOSE = np.array([[math.comb(p, q) for q in range(POWERS)] for p in range(POWERS)], float)
_BLOCK = "struct<low:double,high:double,m:array<double>,n:array<double>>"
_SUMS = ("sw", "sx", "sxx", "sy", "sxy")


def _rows(array: pa.Array) -> np.ndarray:
    return np.asarray(array.flatten(), float).reshape(-1, POWERS)


def _moved(moments: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Moments about a point that lies ``-by`` from the present one."""
    powers = np.power(by[:, None], np.arange(POWERS))
    return np.stack([sum(_CHOOSE[p, q] * powers[:, p - q] * moments[:, q] for q in range(p + 1)) for p in range(POWERS)], axis=1)


def _packed(low: np.ndarray, high: np.ndarray, m: np.ndarray, n: np.ndarray) -> pa.Array:
    lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * POWERS, pa.int32()), pa.array(v.reshape(-1))) for v in (m, n)]
    return pa.StructArray.from_arrays([pa.array(low), pa.array(high), *lists], ["low", "high", "m", "n"])


def _of_points(points: pa.Array) -> pa.Array:
    """Moments of sorted points ``x, y`` about the middle between the first and the last."""
    x, y = (np.asarray(c, float) for c in points.flatten().flatten()[:2])
    starts = np.concatenate(([0], np.cumsum(np.asarray(points.value_lengths()))))
    row = np.repeat(np.arange(len(points)), np.diff(starts))
    low, high = x[starts[:-1]], x[starts[1:] - 1]
    powers = np.power((x - (low + (high - low) / 2)[row])[:, None], np.arange(POWERS))
    return _packed(low, high, *(np.add.reduceat(v, starts[:-1]) for v in (powers, powers * y[:, None])))


def _of_blocks(blocks: pa.Array) -> pa.Array:
    low, high, m, n = blocks.flatten().flatten()
    low, high = np.asarray(low, float), np.asarray(high, float)
    starts = np.concatenate(([0], np.cumsum(np.asarray(blocks.value_lengths()))))
    least, most = np.minimum.reduceat(low, starts[:-1]), np.maximum.reduceat(high, starts[:-1])
    row = np.repeat(np.arange(len(blocks)), np.diff(starts))
    by = low + (high - low) / 2 - (least + (most - least) / 2)[row]
    return _packed(least, most, *(np.add.reduceat(_moved(_rows(v), by), starts[:-1]) for v in (m, n)))


def _pieces(levels: int):
    """Blocks that make up the ranks ``a`` to ``z`` (exclusive): level -1 are blocks of which some points are used."""

    @F.arrow_udf("array<struct<level:int,block:long>>")
    def run(a: pa.Array, z: pa.Array) -> pa.Array:
        a, z = np.asarray(a, np.int64), np.asarray(z, np.int64)
        some = a < z
        found = []

        def add(rows: np.ndarray, level: int, first: np.ndarray, end: np.ndarray) -> None:
            n = np.maximum(end - first, 0)
            at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            found.append((np.repeat(rows, n), np.full(len(at), level), at))

        head = np.flatnonzero(some & (a % POINTS > 0))
        add(head, -1, a[head] // POINTS, a[head] // POINTS + 1)
        tail = np.flatnonzero(some & (z % POINTS > 0) & ((a % POINTS == 0) | (z // POINTS > a // POINTS)))
        add(tail, -1, z[tail] // POINTS, z[tail] // POINTS + 1)
        rows, first, end = np.flatnonzero(some), -(-a[some] // POINTS), z[some] // POINTS
        for level in range(levels):
            above, below = -(-first // FAN), end // FAN
            on = (above < below) if level + 1 < levels else np.zeros(len(rows), bool)
            add(rows[~on], level, first[~on], end[~on])
            add(rows[on], level, first[on], above[on] * FAN)
            add(rows[on], level, below[on] * FAN, end[on])
            rows, first, end = rows[on], above[on], below[on]
        row, level, block = (np.concatenate(c) for c in zip(*found, strict=True))
        by = np.argsort(row, kind="stable")
        parts = pa.StructArray.from_arrays([pa.array(level[by], pa.int32()), pa.array(block[by], pa.int64())], ["level", "block"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[by], np.arange(len(a) + 1)), pa.int32()), parts)

    return run


def _weighed(m: np.ndarray, n: np.ndarray, h: np.ndarray, sign: np.ndarray) -> pa.Array:
    """Weighted sums from moments of ``distance / h``; ``(1 - |u|^3)^3`` written out for the side ``sign``."""
    w = np.stack((np.ones(len(h)), -3.0 * sign, np.full(len(h), 3.0), -1.0 * sign), axis=1)
    total = lambda v, p: (w * v[:, p : p + 10 : 3]).sum(axis=1)
    sums = total(m, 0), total(m, 1) * h, total(m, 2) * h * h, total(n, 0), total(n, 1) * h
    return pa.StructArray.from_arrays([pa.array(s) for s in sums], list(_SUMS))


_WEIGHED = "struct<" + ",".join(f"{s}:double" for s in _SUMS) + ">"


def _from_block(x: pa.Array, h: pa.Array, sign: pa.Array, low: pa.Array, high: pa.Array, m: pa.Array, n: pa.Array) -> pa.Array:
    x, h, sign, low, high = (np.asarray(v, float) for v in (x, h, sign, low, high))
    by, shrink = (low + (high - low) / 2 - x) / h, np.power(h[:, None], -np.arange(float(POWERS)))
    return _weighed(*(_moved(_rows(v) * shrink, by) for v in (m, n)), h, sign)


def _from_points(x: pa.Array, h: pa.Array, sign: pa.Array, points: pa.Array) -> pa.Array:
    x, h, sign = (np.asarray(v, float) for v in (x, h, sign))
    px, py = (np.asarray(c, float) for c in points.flatten().flatten()[:2])
    row = np.repeat(np.arange(len(x)), np.asarray(points.value_lengths()))
    powers = np.power(((px - x[row]) / h[row])[:, None], np.arange(POWERS))
    sums = []
    for v in (powers, powers * py[:, None]):
        out = np.zeros((len(x), POWERS))
        np.add.at(out, row, v)
        sums.append(out)
    return _weighed(*sums, h, sign)


def local_lines(df: DataFrame, x: str, y: str, span: float, name: str = "smooth") -> DataFrame:
    """Height at each distinct ``x`` of the line through the nearest share ``span`` of points, with tricube weights.

    The distance to the k-th nearest point is the least, over stretches of k
    neighbours, of the greater distance to an end; the two stretches to look at
    are found by counting sums of ends below ``2 x``.  Where a line isn't
    determined, the weighted mean stands for it.  Work grows with n log n; null
    values are left out.
    """
    points = with_place(df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter("x is not null and y is not null"), "x", "y", name="r")
    n = points.count()
    k = max(math.ceil(n * span), 2)
    own = points.groupBy("x").agg(F.min("r").alias("g"))
    if k > n:
        wide = own.withColumn("h", F.lit(0.0))
    else:
        ends = points.alias("a").join(points.alias("b"), F.col("b.r") == F.col("a.r") + (k - 1)).select(F.col("a.r").alias("l"), F.col("a.x").alias("left"), F.col("b.x").alias("right"))
        near = count_below(ends.select((F.col("left") + F.col("right")).alias("v")), own.withColumn("v", F.col("x") * 2), "l")
        both = near.select("x", "g", F.explode(F.array(F.col("l") - 1, "l")).alias("l")).join(ends, "l")
        wide = both.groupBy("x", "g").agg(F.min(F.greatest(F.col("x") - F.col("left"), F.col("right") - F.col("x"))).alias("h"))
    wide = wide.withColumn("h", F.greatest("h", F.lit(1e-12)) * (1 + 1e-9))
    limits = wide.select("x", "g", "h", F.explode(F.array(F.col("x") - F.col("h"), F.col("x") + F.col("h"))).alias("v"))
    ranges = count_below(points.select(F.col("x").alias("v")), limits, "at").groupBy("x", "g", "h").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    sides = ranges.select("x", "h", F.inline(F.array(F.struct(F.lit(-1.0).alias("sign"), F.col("lo").alias("a"), F.col("g").alias("z")), F.struct(F.lit(1.0).alias("sign"), F.col("g").alias("a"), F.col("hi").alias("z")))))

    of_points, of_blocks = (F.arrow_udf(f, _BLOCK) for f in (_of_points, _of_blocks))
    from_points, from_block = (F.arrow_udf(f, _WEIGHED) for f in (_from_points, _from_block))
    blocks = points.groupBy(F.floor(F.col("r") / POINTS).alias("block")).agg(F.array_sort(F.collect_list(F.struct("x", "y", "r"))).alias("p"))
    table, counts = [blocks.select("block", of_points("p").alias("b"))], [-(-n // POINTS)]
    while counts[-1] > FAN:
        up = table[-1].groupBy(F.floor(F.col("block") / FAN).alias("block")).agg(F.array_sort(F.collect_list("b")).alias("c"))
        table.append(up.select("block", of_blocks("c").alias("b")))
        counts.append(-(-counts[-1] // FAN))
    pieces = sides.withColumn("_p", F.explode(_pieces(len(table))("a", "z"))).select("x", "h", "sign", "a", "z", "_p.*")

    def sent(side: DataFrame, count: int) -> DataFrame:
        return F.broadcast(side) if count <= SENT else side

    met = pieces.filter("level = -1").join(sent(blocks, counts[0]), "block")
    met = met.withColumn("p", F.filter("p", lambda p: (p["r"] >= F.col("a")) & (p["r"] < F.col("z"))))
    parts = [met.select("x", from_points("x", "h", "sign", "p").alias("s"))]
    for level, (side, count) in enumerate(zip(table, counts, strict=True)):
        met = pieces.filter(F.col("level") == level).join(sent(side, count), "block")
        parts.append(met.select("x", from_block("x", "h", "sign", "b.low", "b.high", "b.m", "b.n").alias("s")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    s = whole.groupBy("x").agg(*(F.sum(f"s.{c}").alias(c) for c in _SUMS))
    det = F.col("sw") * F.col("sxx") - F.col("sx") * F.col("sx")
    line = F.when(det > 1e-18, (F.col("sxx") * F.col("sy") - F.col("sx") * F.col("sxy")) / det).otherwise(F.col("sy") / F.col("sw"))
    return s.select(F.col("x").alias(x), line.alias(name))
