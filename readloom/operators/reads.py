"""Read status, trimming, de-duplication and result assembly."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.params import PRESET


def status_label(df: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    """Status of the first failing check (``okay`` if none) and the label that follows from it."""
    status = F.coalesce(*(F.when(failed, F.lit(name)) for name, failed in checks), F.lit("okay"))
    return label_of(df.withColumn("status", status))


def label_of(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.when(F.col("status") == "okay", "pass").when(F.col("status") == "unsplit_read", "artifact").otherwise("fail"))


def capture_errors(df: DataFrame, f: Callable[[dict], dict], schema: str) -> DataFrame:
    """Apply ``f`` to every row; a row that raises becomes ``unknown_error`` with its message, the others go on.

    ``schema`` names the columns of ``f``'s results and must start with
    ``read_id``; ``status`` and ``error`` are added.
    """
    names = [part.strip().split()[0] for part in schema.split(",")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for row in part.to_dict("records"):
                try:
                    out.append(f(row) | {"status": "okay", "error": None})
                except Exception as e:  # noqa: BLE001
                    out.append({n: None for n in names} | {"read_id": row["read_id"], "status": "unknown_error", "error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(out, columns=[*names, "status", "error"])

    return df.mapInPandas(run, schema + ", status string, error string")


def too_short(length: Column, trim: Column, minimum: int = PRESET.minimum_length) -> Column:
    return length - trim < minimum


def adapter_trim_length(events: DataFrame, ends: DataFrame, lengths: DataFrame, stride: int, k: int = 5) -> DataFrame:
    """Bases of the adapter: moves of events up to its end, plus half a k-mer; more than the sequence has: ``basecall_table_incomplete``.

    ``ends`` has ``read_id, adapter_end`` in strides, ``lengths`` ``read_id, sequence_length``.
    """
    upto = events.join(ends, "read_id").filter(F.col("start") <= F.col("adapter_end") * stride)
    sums = upto.groupBy("read_id").agg((F.sum("move") + k // 2).alias("trim"))
    out = lengths.join(ends.select("read_id"), "read_id").join(sums, "read_id", "left").withColumn("trim", F.coalesce("trim", F.lit(k // 2).cast("long")))
    return out.select("read_id", "trim", F.when(F.col("trim") > F.col("sequence_length"), "basecall_table_incomplete").otherwise("okay").alias("status"))


def apply_trim(df: DataFrame, trim: str = "trim") -> DataFrame:
    """Cut ``trim`` characters off the end of sequence and qualities."""
    keep = F.greatest(F.length("seq") - F.coalesce(F.col(trim), F.lit(0)), F.lit(0)).cast("int")
    cut = {c: F.when(F.col(trim) > 0, F.col(c).substr(F.lit(1), keep)).otherwise(F.col(c)) for c in ("seq", "qual")}
    return df.withColumns(cut)


def dedup_okay(df: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """Drop every row that comes after an ``okay`` row of its key; failing rows before that may repeat."""
    before = Window.partitionBy(*keys).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    done = F.coalesce(F.max(F.when(F.col("status") == "okay", 1).otherwise(0)).over(before), F.lit(0))
    return df.withColumn("_done", done).filter("_done = 0").drop("_done")


def early_stop(df: DataFrame, limit: int = 1000) -> DataFrame:
    """One row: whether nothing succeeded and ``limit`` reads or more were never basecalled (duplicates count)."""
    sums = df.agg(F.count_if(F.col("status") == "okay").alias("okay"), F.count_if(F.col("status") == "not_basecalled").alias("not_basecalled"))
    return sums.withColumn("stop", (F.col("okay") == 0) & (F.col("not_basecalled") >= limit))


def assemble(reads: DataFrame, *parts: DataFrame) -> DataFrame:
    """Left-join optional results to the reads; what a read lacks is null."""
    for part in parts:
        reads = reads.join(part, "read_id", "left")
    return reads
