"""Scans: read containers, basecalls, event tables, summaries and small reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom import functions as fn

CONTAINER = "filename string, reads array<struct<read_id string, channel string, start_time bigint, run_id string, stored_id string>>"
SUMMARY = "filename string, read_id string, run_id string, channel string, start_time bigint"


def scan_containers(spark: SparkSession, path: str, schema: str = CONTAINER, suffix: str = ".parquet") -> DataFrame:
    """Containers below a folder, recursively; hidden files are left out by Spark's listing."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").parquet(path)


def read_catalog(containers: DataFrame, suffix: str = ".parquet") -> DataFrame:
    """``filename, read_id`` of every read; containers without reads give none, hidden or foreign names are skipped."""
    base = F.element_at(F.split("filename", "/"), -1)
    seen = containers.filter(~base.startswith(".") & base.endswith(suffix))
    return seen.select("filename", F.explode("reads").alias("r")).select("filename", "r.read_id")


def read_metadata(reads: DataFrame, sampling_rate: float) -> tuple[DataFrame, DataFrame]:
    """Metadata with the start in seconds, and the quarantine of rows whose stored id differs from the requested one."""
    same = F.col("stored_id").eqNullSafe(F.col("read_id"))
    good = reads.filter(same).select("filename", "read_id", "run_id", "channel", F.round(F.col("start_time") / sampling_rate, 3).alias("start_seconds"))
    return good, reads.filter(~same)


def latest_basecall(reads: DataFrame, groups: DataFrame, segments: DataFrame, stride: int = 15) -> DataFrame:
    """The greatest ``Basecall_1D*`` group per read with its segmentation row (same suffix); none: ``not_basecalled``."""
    last = groups.filter(F.col("group").startswith("Basecall_1D")).groupBy("read_id").agg(F.max("group").alias("group"))
    last = last.withColumn("suffix", F.element_at(F.split("group", "_"), -1))
    out = reads.select("read_id").join(last, "read_id", "left").join(segments, ["read_id", "suffix"], "left")
    return out.select("read_id", "group", "first_sample", F.coalesce("block_stride", F.lit(stride).cast("long")).alias("block_stride"), F.when(F.col("group").isNull(), "not_basecalled").otherwise("okay").alias("status"))


def fastq_record(df: DataFrame, col: str = "fastq") -> DataFrame:
    """Sequence and qualities of a four-line record."""
    lines = F.split(col, "\n")
    return df.withColumns({"seq": F.get(lines, 1), "qual": F.get(lines, 3)})


def event_variants(full: DataFrame, block: DataFrame) -> DataFrame:
    """Both event encodings in one schema; what the block form lacks is null."""
    return full.unionByName(block, allowMissingColumns=True)


def moves_to_events(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Expand ``read_id, seq, qual, moves``: one row per block with position, 5-mer and probability; and the status rows.

    The sequence is reversed but the qualities are not, as the tables expect.
    Reads whose k (sequence length less the moves, plus one) is neither 1 nor 5
    are an error: they give no events but a row ``read_id, k, status``.
    """
    total = F.aggregate("moves", F.lit(0).cast("long"), lambda s, m: s + m)
    k = (F.length("seq") - total + 1).cast("int")
    dna = F.reverse(fn.to_dna(F.col("seq")))
    shift = F.when(k == 5, 2).when(k == 1, 0)
    wide = reads.withColumns({"klen": k, "padded": F.when(k == 1, F.concat(F.lit("__"), dna, F.lit("__"))).otherwise(dna), "shift": shift})
    wrong = wide.filter("shift is null").select("read_id", F.col("klen").alias("k"), F.lit("irregular_moves").alias("status"))
    rows = wide.filter("shift is not null").select("read_id", "padded", "qual", "shift", F.posexplode("moves").alias("i", "move"))
    pos = F.sum("move").over(Window.partitionBy("read_id").orderBy("i")) - 1
    rows = rows.withColumn("pos", pos)
    q = F.ascii(F.expr("substring(qual, pos + shift + 1, 1)")) - 33
    events = rows.select("read_id", F.col("i").cast("long").alias("i"), F.col("pos").cast("long").alias("pos"), F.expr("substring(padded, pos + 1, 5)").alias("kmer"), (1 - F.pow(F.lit(10.0), -q / 10.0)).alias("p"))
    return events, wrong


def block_events(df: DataFrame, first: int, stride: int, signal: str = "signal") -> DataFrame:
    """Fixed blocks after ``first``: mean and population deviation of the median-5-filtered samples."""
    n = F.floor((F.size(signal) - first) / stride).cast("int")
    part = F.slice(fn.median_filter(F.col(signal), 5), F.lit(first + 1), n * stride)
    rows = df.select("read_id", F.posexplode(part).alias("i", "x")).withColumn("block", F.floor(F.col("i") / stride))
    return rows.groupBy("read_id", "block").agg((F.lit(first) + F.first("block") * stride).alias("start"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("stdv"), F.lit(stride).cast("long").alias("length"))


def summary_catalog(summaries: dict[str, DataFrame]) -> DataFrame:
    """Summaries of several runs stacked with ``run_name``, ordered by run, start and channel."""
    out = None
    for name, df in summaries.items():
        one = df.withColumn("run_name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.orderBy("run_name", "start_time", "channel", "read_id")


def read_summary(spark: SparkSession, path: str, schema: str = SUMMARY) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=schema)


def kmer_model(lines: DataFrame) -> DataFrame:
    """``kmer, level_mean, k`` from tab-separated lines."""
    parts = F.split("value", "\t")
    return lines.select(parts[0].alias("kmer"), parts[1].cast("double").alias("level_mean"), F.length(parts[0]).cast("long").alias("k"))


def contig_aliases(lines: DataFrame) -> DataFrame:
    """``contig, alias`` from two-column lines without a header."""
    parts = F.split("value", "\t")
    return lines.select(parts[0].alias("contig"), parts[1].alias("alias"))


def reference_lengths(refs: DataFrame) -> DataFrame:
    return refs.select("name", F.length("seq").cast("long").alias("length"))


def fastq_to_fasta(df: DataFrame) -> DataFrame:
    """One FASTA record per read, as DNA."""
    return df.select("read_id", F.concat(F.lit(">"), "read_id", F.lit("\n"), fn.to_dna(F.col("seq"))).alias("fasta"))
