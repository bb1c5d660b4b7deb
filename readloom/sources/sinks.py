"""Sinks: grouped FASTQ and FASTA, read containers, summaries, alignments, inventories.

Every sink has a part that renders rows (plain expressions) and a part that
writes them partitioned by group; null barcodes go to ``undetermined``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom import functions as fn
from readloom.operators.ranks import with_place
from readloom.operators.reads import apply_trim

SUMMARY = ["filename", "read_id", "run_id", "channel", "start_time", "duration", "num_events", "sequence_length", "mean_qscore", "sample_id", "status", "label"]


def grouped(df: DataFrame) -> DataFrame:
    """``label`` (``fail`` if none) and barcode name as group columns."""
    return df.withColumns({"label": F.coalesce("label", F.lit("fail")), "barcode": fn.barcode_name(F.col("barcode"))})


def fastq_rows(reads: DataFrame) -> DataFrame:
    """Trimmed four-line records of reads with a sequence: ``label, barcode, value``."""
    t = grouped(apply_trim(reads.filter("seq is not null")))
    return t.select("label", "barcode", F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value"))


def fasta_rows(reads: DataFrame) -> DataFrame:
    """Untrimmed FASTA records with their group."""
    return grouped(reads.filter("seq is not null")).select("label", "barcode", F.concat(F.lit(">"), "read_id", F.lit("\n"), "seq").alias("value"))


def read_index(reads: DataFrame) -> DataFrame:
    """``read_id`` and the path of its container, with the group."""
    return grouped(reads.filter("seq is not null")).select("label", "barcode", "read_id", "filename")


def write_text(rows: DataFrame, path: str) -> None:
    """One gzip text folder per group; groups are not gathered in one task."""
    rows.write.partitionBy("label", "barcode").option("compression", "gzip").mode("overwrite").text(path)


def regrouped(reads: DataFrame, per_file: int = 4000) -> DataFrame:
    """Reads with their group and file number in the order of ids; of ids repeated in a group one stays.

    Places come from one distributed sort, so a large group is no one task's;
    groups are few (labels by barcodes), and so are their first places.
    """
    once = with_place(grouped(reads).dropDuplicates(["label", "barcode", "read_id"]), "label", "barcode", "read_id", name="_place")
    first = once.groupBy("label", "barcode").agg(F.min("_place").alias("_first"))
    return once.join(first, ["label", "barcode"]).withColumn("file_no", F.floor((F.col("_place") - F.col("_first")) / per_file)).drop("_place", "_first")


def write_regrouped(reads: DataFrame, path: str, per_file: int = 4000) -> None:
    """Containers by group, each with the reads of one file number; small groups make small files, others full ones."""
    files = regrouped(reads, per_file).repartition("label", "barcode", "file_no").sortWithinPartitions("label", "barcode", "file_no")
    files.write.partitionBy("label", "barcode").option("maxRecordsPerFile", per_file).mode("overwrite").parquet(path)


def summary_rows(reads: DataFrame, barcodes: bool = True, polya: bool = True) -> DataFrame:
    """Summary columns of labelled reads, all text; absent numbers are empty."""
    out = reads.filter("label is not null")
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in reads.columns else F.lit("") for c in SUMMARY}
    text["mean_qscore"] = F.coalesce(F.format_string("%.3f", F.col("mean_qscore")), F.lit(""))
    if barcodes:
        text |= {"barcode": fn.barcode_name(F.col("barcode")), "barcode_score": F.coalesce(F.format_string("%.4f", F.col("barcode_score").cast("double")), F.lit(""))}
    if polya:
        text["polya_dwell"] = F.when(F.col("polya_dwell").isNull(), "").otherwise(F.format_string("%.4f", F.col("polya_dwell").cast("double")))
    return out.select(*(v.alias(k) for k, v in text.items()))


def write_summary(rows: DataFrame, path: str) -> None:
    """Tab-separated files with a header; empty texts stay empty."""
    rows.write.option("sep", "\t").option("header", "true").option("emptyValue", "").mode("overwrite").csv(path)


def sam_rows(reads: DataFrame, hits: DataFrame) -> DataFrame:
    """Alignment rows: ``read_id, flag, ref, pos, mapq, cigar, nm`` and the rank of the hit.

    ``hits`` has ``read_id, rank`` (from 0), ``primary, reverse`` (booleans),
    ``ref, start, mapq, cigar, lead, trail`` (clipped bases) and ``nm``.
    """
    secondary = F.when(F.col("rank") > 0, 256).otherwise(0)
    supplementary = F.when((F.col("rank") == 0) & ~F.col("primary"), 2048).otherwise(0)
    flag = secondary.bitwiseOR(supplementary).bitwiseOR(F.when(F.col("reverse"), 16).otherwise(0))
    a, z = F.when(F.col("reverse"), F.col("trail")).otherwise(F.col("lead")), F.when(F.col("reverse"), F.col("lead")).otherwise(F.col("trail"))
    clip = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("S"))).otherwise("")
    j = reads.select("read_id").join(hits, "read_id", "left")
    none = F.col("ref").isNull()
    return j.select(
        "read_id",
        F.when(none, 4).otherwise(flag).cast("long").alias("flag"),
        F.coalesce("ref", F.lit("*")).alias("ref"),
        F.when(none, 0).otherwise(F.col("start") + 1).cast("long").alias("pos"),
        F.coalesce("mapq", F.lit(0).cast("long")).alias("mapq"),
        F.when(none, "*").otherwise(F.concat(clip(a), "cigar", clip(z))).alias("cigar"),
        F.when(none, "").otherwise(F.concat(F.lit("NM:i:"), F.col("nm").cast("string"))).alias("nm"),
    )


def adapter_inventory(fragments: list[DataFrame]) -> DataFrame:
    """Catalogue fragments merged by id (the earliest fragment wins) with their bucket."""
    out = None
    for i, df in enumerate(fragments):
        one = df.withColumn("_i", F.lit(i))
        out = one if out is None else out.unionByName(one)
    first = out.groupBy("read_id").agg(F.min(F.struct("_i", "start", "end")).alias("m"))
    return first.select("read_id", "m.start", "m.end", fn.prefix_bucket(F.col("read_id")).alias("bucket")).orderBy("read_id")


def event_inventory(events: DataFrame) -> DataFrame:
    """Reads of an event dump by bucket with their number of events."""
    return events.groupBy(fn.prefix_bucket(F.col("read_id")).alias("bucket"), "read_id").agg(F.count(F.lit(1)).alias("n_events"))
