"""Demultiplexing and scaling of signals with pluggable models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from readloom import functions as fn
from readloom.operators.events import _samples
from readloom.params import PRESET

#: A model maps a matrix (one signal per row) to a matrix (one row of outputs each).
Model = Callable[[np.ndarray], np.ndarray]


def prepare_adapters(df: DataFrame, least: int = PRESET.adapter_minimum, most: int = PRESET.adapter_maximum, keep: int = PRESET.adapter_keep, filler: float = PRESET.adapter_filler, signal: str = "signal") -> DataFrame:
    """Adapters of fitting length, tail cut to ``keep``, MAD-normalised, padded on the left."""
    fits = df.filter(F.size(signal).between(least, most))
    tail = F.slice(signal, F.greatest(F.size(signal) - keep, F.lit(0)) + 1, keep)
    return fits.withColumn(signal, fn.pad_left(fn.mad_normalize(tail), keep, filler))


def predict(df: DataFrame, model: Model, signal: str = "signal", output: str = "probs") -> DataFrame:
    """Apply a user model batch by batch; it is shipped to the workers once."""

    @F.pandas_udf("array<double>")
    def apply(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(list(np.asarray(model(np.stack([np.asarray(s, float) for s in part])), float))) if len(part) else pd.Series([], dtype=object)

    return df.withColumn(output, apply(F.col(signal)))


def centroids(df: DataFrame, signal: str = "signal", label: str = "label") -> DataFrame:
    """Mean signal of each class: ``label, center``.

    Sums by class and position are made where the signals are, an Arrow batch
    at a time; only those are shuffled.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, known, edges = _samples(batch.column(1))
            sizes = np.diff(edges)
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            width, classes = max(1, int(sizes.max(initial=0))), len(coded.dictionary)
            at = np.repeat(np.asarray(coded.indices, np.int64) * width - edges[:-1], sizes) + np.arange(edges[-1])
            total, n = np.bincount(at[known], x[known], classes * width), np.bincount(at[known], minlength=classes * width)
            seen = np.flatnonzero(np.bincount(at, minlength=classes * width))
            columns = [coded.dictionary.take(pa.array(seen // width)), pa.array(seen % width, pa.int32()), pa.array(total[seen], pa.float64()), pa.array(n[seen], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["label", "i", "s", "n"])

    part = df.select(F.col(label).alias("label"), F.col(signal).cast("array<double>").alias("x"))
    schema = StructType([part.schema["label"], StructField("i", IntegerType()), StructField("s", DoubleType()), StructField("n", LongType())])
    rows = part.mapInArrow(sums, schema).groupBy("label", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    means = rows.select(F.col("label").alias(label), "i", F.when(F.col("n") > 0, F.col("s") / F.col("n")).alias("x"))
    return means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("center"))


def centroid_predict(df: DataFrame, classes: DataFrame, signal: str = "signal") -> DataFrame:
    """Default model: softmax over the negated root-mean-square distances to the class centres.

    The centres (one row per class) are fetched and ordered by label; signals
    meet them where they are, an Arrow batch at a time.  A signal that is null,
    holds a null or has another length than a centre has null probabilities.
    """
    centers = [r["center"] for r in sorted(classes.select("label", "center").collect(), key=lambda r: (r["label"] is not None, r["label"]))]
    k, lengths = len(centers), {len(c) for c in centers}
    width = lengths.pop() if len(lengths) == 1 and not any(v is None for c in centers for v in c) else -1

    @F.arrow_udf("array<double>")
    def run(arrays: pa.Array) -> pa.Array:
        x, known, edges = _samples(arrays)
        sizes, gaps = np.diff(edges), np.concatenate(([0], np.cumsum(~known)))
        good = (sizes == width) & (gaps[edges[1:]] == gaps[edges[:-1]]) & (width > 0)
        probs = np.zeros((len(sizes), k))
        if good.any():
            own = x[np.repeat(good, sizes)].reshape(-1, width)
            with np.errstate(invalid="ignore", over="ignore"):
                away = np.column_stack([np.sqrt(np.square(own - np.array(c)).sum(axis=1) / width) for c in centers])
                near = np.exp(np.fmin.reduce(away, axis=1)[:, None] - away)
                probs[good] = near / near.sum(axis=1, keepdims=True)
        edges = np.arange(len(sizes) + 1) * k
        return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(probs.reshape(-1), mask=np.repeat(~good, k)))

    return df.withColumn("probs", run(F.col(signal).cast("array<double>")))


def phred_lookup(score: Column, table: Column) -> Column:
    """Number of table entries up to the score; 0 for scores of 0 or less."""
    return F.when(score <= 0, 0).otherwise(F.size(F.filter(table, lambda t: t <= score))).cast("long")


def decide(df: DataFrame, table: list[float], quality: int = PRESET.phred_cut, decoys: int = PRESET.decoys, probs: str = "probs") -> DataFrame:
    """Best class (ties: the first), accepted barcode (null if a decoy or below the table's score at ``quality``) and its phred score."""
    if quality >= len(table):
        raise ValueError(f"quality {quality} is beyond the calibration table")
    known = F.array(*map(F.lit, table))
    best = F.array_max(probs)
    guess = (F.array_position(probs, best) - 1 - decoys).cast("long")
    ok = (guess >= 0) & (best >= table[quality])
    return df.withColumns({"best_score": best, "guess": guess, "barcode": F.when(ok, guess), "barcode_score": F.when(ok, phred_lookup(best, known)).otherwise(0).cast("long")})


def unstandardise(df: DataFrame, constants: dict[str, tuple[float, float]]) -> DataFrame:
    """``std * y + mean`` for each output."""
    return df.withColumns({name: std * F.col(name) + mean for name, (mean, std) in constants.items()})


def scaler_predict(df: DataFrame, model: Model, constants: dict[str, tuple[float, float]], signal: str = "head") -> DataFrame:
    """Scale and shift of every padded head from a user model."""
    out = predict(df, model, signal, "_y")
    named = out.withColumns({name: F.get("_y", i) for i, name in enumerate(constants)}).drop("_y")
    return unstandardise(named, constants)


def scaling_status(df: DataFrame, constants: dict[str, tuple[float, float]], z: float = PRESET.scale_quantile) -> DataFrame:
    """``scaling_qc_fail`` unless every parameter lies in its training distribution's central range (both ends included)."""
    ok = F.lit(True)
    for name, (mean, std) in constants.items():
        ok = ok & F.col(name).between(mean - z * std, mean + z * std)
    return df.withColumn("status", F.when(ok, "okay").otherwise("scaling_qc_fail"))
