"""Calibration of prediction scores to error rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.operators.curves import local_lines
from readloom.operators.ranks import steps_down, with_place

#: Window size, least width and interval of each scale, coarse to fine.
SCALES = ((10_000, 2_500, 3_300), (2_000, 1_000, 1_000), (1_000, 500, 500))
STEADY = 0.02


def ranked_predictions(pred: DataFrame) -> DataFrame:
    """Predictions without decoys, ranked from 0 by falling score; several scales share one ranking."""
    real = pred.filter((F.col("prior_label") != 0) & (F.col("pred_label") != 0))
    return with_place(real, F.desc("pred_prob"), "read_id", "prior_label", "pred_label")


def row_windows(pred: DataFrame, size: int, least: int, step: int) -> DataFrame:
    """Error rate and score statistics of row windows: ``start, n, error_rate, high, low, mean, std``."""
    return ranked_windows(ranked_predictions(pred), size, least, step)


def ranked_windows(ranked: DataFrame, size: int, least: int, step: int) -> DataFrame:
    """``row_windows`` of predictions ranked before: every row is exploded into the windows that cover it and grouped."""
    n = ranked.agg(F.count(F.lit(1)).alias("_total"))
    low = F.greatest(F.ceil((F.col("rank") - size + 1) / step), F.lit(0))
    high = F.least(F.floor(F.col("rank") / step), F.floor((F.col("_total") - least) / step))
    rows = ranked.join(F.broadcast(n)).filter(low <= high).withColumn("_w", F.explode(F.sequence(low, high)))
    stats = rows.groupBy("_w").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("prior_label") != F.col("pred_label")).cast("double")).alias("error_rate"), F.max("pred_prob").alias("high"), F.min("pred_prob").alias("low"), F.avg("pred_prob").alias("mean"), F.stddev_samp("pred_prob").alias("std"))
    return stats.select((F.col("_w") * step).alias("start"), "n", "error_rate", "high", "low", "mean", "std")


def multiscale_errors(pred: DataFrame, scales: tuple[tuple[int, int, int], ...] = SCALES, steady: float = STEADY) -> DataFrame:
    """Coarse windows with a steady score, and finer ones below the mean scores the coarser scales reach."""
    out, ranked = None, ranked_predictions(pred)
    for i, (size, least, step) in enumerate(scales):
        rows = ranked_windows(ranked, size, least, step).withColumn("scale", F.lit(i).cast("long"))
        if i + 1 < len(scales):
            rows = rows.filter(F.col("std") < steady)
        if out is None:
            out = rows
        else:
            floor = out.agg(F.min("mean").alias("_floor"))
            out = out.unionByName(rows.join(F.broadcast(floor)).filter(F.col("_floor").isNull() | (F.col("mean") < F.col("_floor"))).drop("_floor"))
    return out


def extrapolated_table(errors: DataFrame) -> DataFrame:
    """Scores of low phred values from the line through the three lowest windows: ``phred, pred_score``; phred 0 has score 0."""
    last = errors.orderBy("mean").limit(3)
    line = last.agg(F.regr_slope("error_rate", "mean").alias("b"), F.regr_intercept("error_rate", "mean").alias("a"), F.max_by("error_rate", -F.col("mean")).alias("worst"))
    top = F.greatest(F.floor(-10 * F.log10("worst")), F.lit(0)).cast("int")
    rows = line.select("a", "b", F.explode(F.sequence(F.lit(0), top)).alias("phred"))
    score = (F.pow(F.lit(10.0), -F.col("phred") / 10.0) - F.col("a")) / F.col("b")
    return rows.select(F.col("phred").cast("long").alias("phred"), F.when(F.col("phred") == 0, 0.0).otherwise(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))).alias("pred_score"))


def smoothed_errors(errors: DataFrame, span: float = 0.3) -> DataFrame:
    """Local-linear smoothing with tricube weights over the nearest share ``span`` of all windows: ``mean, smooth``."""
    return local_lines(errors, "mean", "error_rate", span)


def interpolated_table(errors: DataFrame, low: DataFrame) -> DataFrame:
    """Scores of the phred values above ``low`` by inverting the smoothed error curve between neighbouring windows."""
    curve = smoothed_errors(errors).checkpoint()
    steps = steps_down(curve, "mean", "smooth").filter("x1 is not null and smooth > y1")
    best = errors.agg(F.max_by("error_rate", "mean").alias("_e"))
    top = best.select(F.when(F.col("_e") > 0, F.floor(-10 * F.log10("_e"))).otherwise(40).cast("int").alias("top"))
    start = low.agg((F.max("phred") + 1).cast("int").alias("from"))
    want = start.join(F.broadcast(top)).filter("from <= top").select(F.explode(F.sequence("from", "top")).alias("phred"))
    want = want.withColumn("error", F.pow(F.lit(10.0), -F.col("phred") / 10.0))
    hit = F.broadcast(want).join(steps, (F.col("error") <= F.col("smooth")) & (F.col("error") >= F.col("y1")))
    score = F.col("x1") + (F.col("mean") - F.col("x1")) * (F.col("error") - F.col("y1")) / (F.col("smooth") - F.col("y1"))
    per = want.select("phred").join(hit.groupBy("phred").agg(F.max(score).alias("s")), "phred", "left")
    ceiling = curve.agg(F.max("mean").alias("_top"))
    out = per.join(F.broadcast(ceiling)).select(F.col("phred").cast("long").alias("phred"), F.coalesce("s", "_top").alias("pred_score"))
    return out.withColumn("pred_score", F.max("pred_score").over(Window.orderBy("phred")))


def calibration_table(errors: DataFrame) -> DataFrame:
    """``phred, pred_score``, continuous from 0, with scores that never fall."""
    low = extrapolated_table(errors)
    both = low.unionByName(interpolated_table(errors, low))
    ranked = both.withColumns({"pred_score": F.max("pred_score").over(Window.orderBy("phred")), "_n": F.row_number().over(Window.orderBy("phred")) - 1})
    return ranked.select(F.col("phred"), F.when(F.col("_n") == F.col("phred"), F.col("pred_score")).otherwise(F.raise_error(F.lit("calibration table has a gap"))).alias("pred_score"))
