"""Counts and reports over classified reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions import barcode_name

#: What a report says for each status.
STATUS_TEXT = {
    "okay": "Fine",
    "scaler_signal_too_short": "Too few samples to fit a scale",
    "sequence_too_short": "Fewer bases than asked for",
    "irregular_fast5": "Container can't be read",
    "basecall_table_incomplete": "Events end before the sequence does",
    "adapter_not_detected": "Nothing looks like an adapter",
    "not_basecalled": "No basecall in the container",
    "scaling_qc_fail": "Fitted scale is out of range",
    "disappeared": "File has gone away",
    "unknown_error": "Stopped by an error",
    "unsplit_read": "Several molecules in one read",
}
LABELS = ("pass", "artifact", "fail")


def final_counts(df: DataFrame) -> DataFrame:
    """Reads by label (``fail`` if none), barcode and status."""
    return df.groupBy(F.coalesce("label", F.lit("fail")).alias("label"), "barcode", "status").agg(F.count(F.lit(1)).alias("n"))


def final_report(counts: DataFrame, barcodes: list[int | None]) -> DataFrame:
    """One row per label and status, one column per barcode (undetermined last), in reading order with ``place``."""
    names = [f"BC{x + 1}" for x in barcodes if x is not None] + ["undetermined"]
    wide = counts.withColumn("name", barcode_name(F.col("barcode"))).groupBy("label", "status").pivot("name", names).agg(F.sum("n")).na.fill(0)
    text = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in STATUS_TEXT.items() for x in kv)), F.col("status")), F.col("status"))
    most = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    place = F.when(F.col("label") == "pass", 0).when(F.col("label") == "artifact", 1).otherwise(2)
    order = Window.orderBy(place, F.desc(most), "status")
    return wide.withColumns({"text": text, "place": F.row_number().over(order).cast("long")}).orderBy("place")


def group_stats(df: DataFrame) -> DataFrame:
    """Per group and in all: ``total, failed, unmapped, mapped``. Needs ``grp, failed, unmapped`` (booleans)."""
    sums = [F.count(F.lit(1)).alias("total"), F.count_if("failed").alias("failed"), F.count_if("unmapped").alias("unmapped")]
    out = df.rollup("grp").agg(F.grouping("grp").alias("_all"), *sums)
    return out.select(F.when(F.col("_all") == 1, "overall").otherwise(F.coalesce("grp", F.lit("undetermined"))).alias("grp"), "total", "failed", "unmapped", (F.col("total") - F.col("failed") - F.col("unmapped")).alias("mapped"))


def top_contigs(mapped: DataFrame, aliases: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` most frequent names per group and in all, with their alias: ``grp, place, name, alias, n``."""
    per = mapped.groupBy("grp", "name").agg(F.count(F.lit(1)).alias("n"))
    both = per.unionByName(per.groupBy("name").agg(F.sum("n").alias("n")).withColumn("grp", F.lit("overall")))
    place = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("n"), "name"))
    best = both.withColumn("place", place).filter(F.col("place") <= k)
    return best.join(aliases, best["name"] == aliases["contig"], "left").select("grp", F.col("place").cast("long").alias("place"), "name", F.coalesce("alias", "name").alias("alias"), "n")


def rates(df: DataFrame, found: int) -> DataFrame:
    """One row: demultiplexed share, mapped share (failed reads count as mapped), and progress in per cent of ``found``."""
    sums = df.agg(F.count(F.lit(1)).alias("total"), F.count("barcode").alias("assigned"), F.count_if("unmapped").alias("unmapped"))
    total = F.nullif(F.col("total"), F.lit(0))
    return sums.select(
        F.coalesce(F.col("assigned") / total, F.lit(0.0)).alias("demux_rate"),
        F.coalesce((F.col("total") - F.col("unmapped")) / total, F.lit(0.0)).alias("mapped_rate"),
        F.coalesce(F.floor(F.col("total") * 100 / F.nullif(F.lit(found), F.lit(0))), F.lit(0)).cast("long").alias("progress"),
    )


def map_outcome(df: DataFrame) -> DataFrame:
    """Per barcode: distinct names with their counts, unmapped (``*``) and failed (null name) reads. Needs ``barcode, name``."""
    ok = F.col("name").isNotNull() & (F.col("name") != "*")
    per = df.groupBy("barcode", "name").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("barcode").agg(
        F.array_sort(F.collect_list(F.when(ok, F.struct("name", "n")))).alias("mapped"),
        F.coalesce(F.sum(F.when(F.col("name") == "*", F.col("n"))), F.lit(0)).alias("unmapped"),
        F.coalesce(F.sum(F.when(F.col("name").isNull(), F.col("n"))), F.lit(0)).alias("failed"),
    )
