"""Queries that run a stream over files to its end and return what its sinks hold."""

from __future__ import annotations

import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from readloom import bindings as b
from readloom import streaming
from readloom.operators.reports import final_counts
from readloom.plans.registry import query
from readloom.sources.shared import new_path


def _arrivals(spark, sf, repeats: bool = False) -> tuple[str, object]:
    """Reads spread over six files, some of them twice."""
    path = new_path(spark, "arrivals")
    r = b.reads(spark, sf).select("read_id", "filename", "label", "barcode", "status")
    parts = r.withColumn("part", F.col("read_id").cast("long") % 4)
    if repeats:
        parts = parts.unionByName(parts.filter("part < 2").withColumn("part", F.col("part") + 4))
    parts.repartition(6, "part").write.partitionBy("part").parquet(path)
    return path, r.schema


def _collected(spark, stream, name: str):
    """Run a stream to its end with an idempotent append of each micro-batch, and read the result."""
    out = new_path(spark, name)
    streaming.run_available(stream, lambda batch, i: batch.write.mode("overwrite").parquet(f"{out}/batch={i}"), new_path(spark, f"{name}-checkpoint"))
    return spark.read.parquet(out)


def _with_file(stream):
    return stream.withColumn("file", F.col("_metadata.file_path"))


@query("select read_id, filename, label, barcode, status from v_reads")
def st_live_scan(spark, sf):
    path, schema = _arrivals(spark, sf)
    return _collected(spark, streaming.live_scan(spark, path, schema), "live").drop("batch")


def _aged(spark, path: str, parts: set[int], seconds: int) -> None:
    """Set back the times of the files of some parts, as if they had arrived earlier."""
    jvm = spark.sparkContext._jvm
    for part in parts:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/part={part}")
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for file in fs.listStatus(folder) if fs.exists(folder) else []:
            fs.setTimes(file.getPath(), int((time.time() - seconds) * 1000), -1)


@query("select read_id, status, cast(read_id as bigint) % 4 < 2 as old, true as waited, true as alone from v_reads")
def st_start_delay(spark, sf):
    """Two files are an hour old, two have just arrived: the old ones come out while the young ones still wait, each of these once it is old enough."""
    path, schema = _arrivals(spark, sf)
    rows = spark.read.parquet(path).count()
    _aged(spark, path, {0, 1}, 3600)
    _aged(spark, path, {2, 3}, 0)  # however long the files took to write
    out, delay = new_path(spark, "delayed"), 5.0
    stamped = lambda batch, i: batch.withColumn("at", F.lit(time.time())).write.mode("overwrite").parquet(f"{out}/batch={i}")
    stream = _with_file(streaming.with_file_time(streaming.live_scan(spark, path, schema)))
    streaming.run_until(streaming.hold_young(stream, delay, pieces=streaming.size_pieces()), stamped, new_path(spark, "delayed-checkpoint"), rows)
    old = F.col("read_id").cast("long") % 4 < 2
    got = spark.read.parquet(out).withColumn("old", old)
    first = got.filter("not old").agg(F.coalesce(F.min("batch"), F.lit(1 << 30)).alias("first"))  # one row
    age = F.col("at") - F.unix_micros("file_time") / 1e6
    return got.crossJoin(F.broadcast(first)).select("read_id", "status", "old", (age >= delay - 0.001).alias("waited"), (~F.col("old") | (F.col("batch") < F.col("first"))).alias("alone"))


@query("""with t as (select read_id, status, case when cast(read_id as bigint) % 4 < 2 then 2 else 1 end c from v_reads)
  select read_id, status from t union all select read_id, status from t where c = 2 and status <> 'okay'""")
def st_dedup(spark, sf):
    path, schema = _arrivals(spark, sf, repeats=True)
    stream = streaming.dedup_stream(streaming.live_scan(spark, path, schema), ["filename", "read_id"])
    return _collected(spark, stream, "dedup").select("read_id", "status")


def _batches(spark, sf, size: int, name: str):
    """Reads of six files, some of them twice, in batches of ``size`` rows, collected in lanes."""
    path, schema = _arrivals(spark, sf, repeats=True)
    out = new_path(spark, name)
    stream = streaming.in_batches(streaming.live_scan(spark, path, schema, files_per_trigger=1), size, idle=3.0, lanes=64, keys=["read_id"])
    rows = spark.read.parquet(path).count()
    streaming.run_until(stream, lambda batch, i: batch.write.mode("overwrite").parquet(f"{out}/trigger={i}"), new_path(spark, f"{name}-checkpoint"), rows)
    return streaming.merge_lanes(spark.read.parquet(out), size)


_ARRIVED = "a as (select read_id, status from v_reads union all select read_id, status from v_reads where cast(read_id as bigint) % 4 < 2), t as (select count(*) as n from a)"


@query(f"""with {_ARRIVED} select b as batch, least(128, n - 128 * b) as n from t, (select unnest(range(0, (select n // 128 + 1 from t))) b) where n > 128 * b""")
def st_microbatch(spark, sf):
    """Batches of 128 reads, whatever files they come from; only the last one is smaller."""
    return _batches(spark, sf, 128, "micro").groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {_ARRIVED} select read_id, count(*) as n, (select n % 100 from t) as flushed_rows, (select n // 100 from t) as full_batches from a group by read_id""")
def st_stall_flush(spark, sf):
    """Batches of 100 reads; the rest comes out once the stream has been idle.  No read is lost or doubled."""
    got = _batches(spark, sf, 100, "flush")
    ends = got.agg(F.coalesce(F.sum(F.col("flushed").cast("long")), F.lit(0)).alias("flushed_rows"), F.count_distinct(F.when(~F.col("flushed"), F.col("batch"))).alias("full_batches"))
    return got.groupBy("read_id").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(ends))  # one row


@query("""select coalesce(label, 'fail') as label, barcode, status, count(*) as n from v_reads group by 1, 2, 3""")
def st_live_counts(spark, sf):
    path, schema = _arrivals(spark, sf)
    out = new_path(spark, "counts")
    counts = streaming.live_counts(streaming.live_scan(spark, path, schema, files_per_trigger=2))
    q = counts.writeStream.outputMode("complete").foreachBatch(lambda batch, i: batch.write.mode("overwrite").parquet(out)).option("checkpointLocation", new_path(spark, "counts-checkpoint")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)


@query("""select 'summary' as sink, count(*) as n from v_reads union all select 'pass', count(*) from v_reads where label = 'pass' union all select 'groups', count(*) from (select distinct label, barcode, status from v_reads)""")
def st_fanout(spark, sf):
    path, schema = _arrivals(spark, sf)
    out = new_path(spark, "fan")
    sinks = {
        "summary": lambda batch, i: batch.write.mode("overwrite").parquet(f"{out}/summary/batch={i}"),
        "pass": lambda batch, i: batch.filter("label = 'pass'").write.mode("overwrite").parquet(f"{out}/pass/batch={i}"),
        "counts": lambda batch, i: final_counts(batch).write.mode("overwrite").parquet(f"{out}/counts/batch={i}"),
    }
    streaming.run_available(streaming.live_scan(spark, path, schema, files_per_trigger=2), streaming.fan_out(sinks), new_path(spark, "fan-checkpoint"))
    one = lambda name, df: df.agg(F.lit(name).alias("sink"), F.count(F.lit(1)).alias("n"))
    groups = spark.read.parquet(f"{out}/counts").select("label", "barcode", "status").distinct()
    return one("summary", spark.read.parquet(f"{out}/summary")).unionByName(one("pass", spark.read.parquet(f"{out}/pass"))).unionByName(one("groups", groups))
