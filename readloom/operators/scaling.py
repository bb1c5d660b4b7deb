"""Jobs that prepare and judge training data of the signal scaler."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.operators.selection import exact_quantiles
from readloom.operators.training import global_rank, hash_ranked


def _hash(id_col: str, seed: int):
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))


def task_split(df: DataFrame, tasks: int, id_col: str = "read_id", seed: int = 1) -> DataFrame:
    """Row position modulo ``tasks``, in a reproducible order."""
    return global_rank(df, [_hash(id_col, seed), F.col(id_col)]).withColumn("task", (F.col("rank") - 1) % tasks)


def kmer_levels(events: DataFrame, model: DataFrame, least: int = 30) -> DataFrame:
    """Observed and model level per position: ``read_id, pos, kmer, observed, level_mean``.

    Positions whose k-mer holds ``_`` and positions just before and at a move
    of more than one are left out; reads with fewer than ``least`` positions too.
    """
    w = Window.partitionBy("read_id").orderBy("k")
    placed = events.withColumn("pos", F.sum("move").over(w))
    jumps = placed.filter("move > 1").select("read_id", F.explode(F.array(F.col("pos") - 1, F.col("pos"))).alias("pos")).distinct()
    per = placed.groupBy("read_id", "pos").agg(F.min_by("kmer", "k").alias("kmer"), F.median("mean").alias("observed"))
    clean = per.filter(~F.col("kmer").contains("_")).join(jumps, ["read_id", "pos"], "left_anti")
    enough = clean.groupBy("read_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).select("read_id")
    return clean.join(enough, "read_id", "left_semi").join(model.select("kmer", "level_mean"), "kmer")


#: Points up to which all slopes are made at once.
PAIRED = 1500


def _inversions(z: np.ndarray) -> int:
    """Pairs ``i < j`` with ``z[j] <= z[i]``, by merging sorted halves level by level."""
    n, total, width = len(z), 0, 1
    rank = np.searchsorted(np.sort(z), z)  # equal values get equal ranks
    while width < n:
        block = np.arange(n) // (2 * width)
        right = np.arange(n) // width % 2 == 1
        key = block * (n + 1) + rank
        left = np.sort(key[~right])
        # left members of the own block that are not below: all of the block less those below
        ends = np.searchsorted(left, (block[right] + 1) * (n + 1))
        total += int((ends - np.searchsorted(left, key[right], side="left")).sum())
        width *= 2
    return total


def median_slope(x: np.ndarray, y: np.ndarray) -> float | None:
    """Median of the slopes between all points of different ``x``; None if there is none."""
    by = np.lexsort((y, x))
    x, y = x[by], y[by]
    n = len(x)
    if n <= PAIRED:
        a, b = np.triu_indices(n, 1)
        dx = x[b] - x[a]
        slopes = (y[b] - y[a])[dx != 0] / dx[dx != 0]
        return float(np.median(slopes)) if len(slopes) else None
    _, same_x = np.unique(x, return_counts=True)
    _, same = np.unique(np.column_stack((x, y)), axis=0, return_counts=True)
    pairs = lambda k: int((k * (k - 1) // 2).sum())
    total, equal = n * (n - 1) // 2 - pairs(same_x), pairs(same)  # points of one x ascend in y, so only equal ones count as inversions
    if not total:
        return None

    def upto(m: float) -> int:
        return _inversions(y - m * x) - equal

    gap = np.diff(np.unique(x)).min()
    bound = 2.0 * (y.max() - y.min() + 1e-300) / gap

    def kth(k: int) -> float:
        low, high = -bound, bound  # at most k slopes are low or less, more than k are high or less
        while True:
            mid = (low + high) / 2
            if not low < mid < high or high - low < 1e-13 * max(1.0, abs(mid)):
                return high
            low, high = (low, mid) if upto(mid) > k else (mid, high)

    return (kth((total - 1) // 2) + kth(total // 2)) / 2


def theil_sen(pairs: DataFrame, x: str = "observed", y: str = "level_mean", order: str = "pos") -> DataFrame:
    """Robust line per read: the median of all pairwise slopes, then the median of ``y - slope * x``.

    A read's points are one group, bounded by its length.  Few points are paired
    outright; of more, the middle slopes are found by counting the slopes below
    a value, so memory stays in proportion to the points.
    """

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        slope = median_slope(group[x].to_numpy(float), group[y].to_numpy(float))
        cut = float(np.median(group[y] - slope * group[x])) if slope is not None else None
        return pd.DataFrame({"read_id": [key[0]], "slope": [slope], "intercept": [cut]}).astype({"slope": float, "intercept": float}).dropna()

    return pairs.select("read_id", x, y).groupBy("read_id").applyInPandas(run, "read_id string, slope double, intercept double")


def balanced_subsample(df: DataFrame, run: str = "run_id", id_col: str = "read_id", seed: int = 922) -> DataFrame:
    """As many random rows of every run as the smallest run has."""
    least = df.groupBy(run).agg(F.count(F.lit(1)).alias("_n")).agg(F.min("_n").alias("_least"))
    return hash_ranked(df, [run], id_col, seed, "_r").join(F.broadcast(least)).filter(F.col("_r") <= F.col("_least")).drop("_r", "_least")


def outlier_filter(df: DataFrame, a: str, b: str, keep: float = 0.98) -> DataFrame:
    """Leave out the pairs farthest (Mahalanobis) from the medians, beyond the ``keep`` quantile of distances.

    Medians and the quantile are selected exactly by counting cells; rows with a
    null or non-finite value have no distance and are left out.
    """
    usable = df
    for c in (a, b):
        usable = usable.filter(F.col(c).isNotNull() & (F.abs(F.col(c).cast("double")) < float("inf")))
    va, vb, c = usable.agg(F.var_pop(a), F.var_pop(b), F.covar_pop(a, b)).first()
    (ma,), (mb,) = exact_quantiles(usable, a, [0.5]), exact_quantiles(usable, b, [0.5])
    va, vb, c, ma, mb = (F.lit(v).cast("double") for v in (va, vb, c, ma, mb))
    da, db = F.col(a) - ma, F.col(b) - mb
    scored = usable.withColumn("distance", (da * da * vb - 2 * da * db * c + db * db * va) / (va * vb - c * c))
    (cut,) = exact_quantiles(scored, "distance", [keep])
    return scored.filter(F.col("distance") <= F.lit(cut).cast("double"))


def train_test_split(df: DataFrame, share: float, id_col: str = "read_id", seed: int = 7) -> DataFrame:
    """``is_train`` for exactly ``int(n * share)`` random rows."""
    ranked = global_rank(df, [_hash(id_col, seed), F.col(id_col)])
    n = df.agg(F.floor(F.count(F.lit(1)) * share).alias("_n"))
    return ranked.join(F.broadcast(n)).withColumn("is_train", F.col("rank") <= F.col("_n")).drop("_n", "rank")


def redisperse(df: DataFrame, spread: float = 1.8, seed: int = 922, signal: str = "signal", id_col: str = "read_id") -> DataFrame:
    """Undo each signal's own scaling and apply newly drawn parameters from the population, widened by ``spread``.

    Normal draws come from hashes of id and seed, so partitioning doesn't change them.
    """
    one = df.agg(*(f(c).alias(f"_{n}{c}") for c in ("scale", "shift") for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    unit = lambda k: (F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed), F.lit(k)), 11).cast("double") + 0.5) / float(1 << 53)
    normal = lambda k: F.sqrt(-2 * F.log(unit(2 * k))) * F.cos(2 * math.pi * unit(2 * k + 1))
    drawn = df.join(F.broadcast(one)).withColumns({"new_scale": F.col("_mscale") + F.col("_sscale") * spread * normal(0), "new_shift": F.col("_mshift") + F.col("_sshift") * spread * normal(1)})
    moved = F.transform(signal, lambda x: (F.col("scale") * x + F.col("shift") - F.col("new_shift")) / F.col("new_scale"))
    return drawn.withColumn(signal, moved).drop("_mscale", "_sscale", "_mshift", "_sshift")


def standardise(df: DataFrame, columns: list[str], boost: float = 1.0) -> DataFrame:
    """z-scores with mean and (boosted) population deviation; the constants stay as columns."""
    one = df.agg(*(F.avg(c).alias(f"{c}_mean") for c in columns), *((F.stddev_pop(c) * boost).alias(f"{c}_std") for c in columns))
    return df.join(F.broadcast(one)).withColumns({f"{c}_z": (F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_std") for c in columns})


def evaluate(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Pearson r and root-mean-square deviation of expected against predicted, one row per output."""
    out = None
    for name, (want, got) in pairs.items():
        one = df.agg(F.lit(name).alias("output"), F.corr(want, got).alias("r"), F.sqrt(F.avg(F.pow(F.col(want) - F.col(got), 2))).alias("rmsd"))
        out = one if out is None else out.unionByName(one)
    return out


def mini_dataset(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)
