"""Queries over sinks: what is written, read back or rendered."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom import bindings as b
from readloom.plans.registry import query
from readloom.sources import sinks
from readloom.sources.shared import new_path


def _reads(spark, sf):
    """Reads that have a sequence, with label, barcode and trim."""
    r = b.reads(spark, sf).select("read_id", "label", "barcode", "filename")
    return b.sequences(spark, sf).join(r, "read_id").selectExpr("*", "repeat('I', length(seq)) qual", "cast(read_id as bigint) % 30 trim")


_JOIN = """rd as (select s.read_id, seq, label, case when barcode is null then 'undetermined' else concat('BC', barcode + 1) end barcode, filename, cast(s.read_id as bigint) % 30 as trim from v_seq s join v_reads r on s.read_id = r.read_id),
  tr as (select *, case when trim > 0 then substr(seq, 1, greatest(length(seq) - trim, 0)) else seq end ts from rd)"""


@query(f"with {_JOIN} select label, barcode, concat('@', read_id, chr(10), ts, chr(10), '+', chr(10), repeat('I', length(ts))) as value from tr")
def snk_fastq(spark, sf):
    return sinks.fastq_rows(_reads(spark, sf))


@query(f"with {_JOIN} select label, barcode, read_id, filename, length(seq) + length(read_id) + 2 as fasta_length from rd")
def snk_fasta_readdb(spark, sf):
    fasta = sinks.fasta_rows(_reads(spark, sf)).select(F.regexp_extract("value", "^>([^\n]*)", 1).alias("read_id"), F.length("value").cast("long").alias("fasta_length"))
    return sinks.read_index(_reads(spark, sf)).join(fasta, "read_id")


@query("""with g as (select distinct label, case when barcode is null then 'undetermined' else concat('BC', barcode + 1) end barcode, read_id from v_reads)
  select label, barcode, read_id, (row_number() over (partition by label, barcode order by read_id) - 1) // 400 as file_no from g""")
def snk_regroup_reads(spark, sf):
    r = b.reads(spark, sf)
    path = new_path(spark, "containers")
    sinks.write_regrouped(r.union(r.filter("cast(read_id as bigint) % 9 = 0")), path, 400)
    return spark.read.parquet(path).select("label", "barcode", "read_id", "file_no")


@query("""select read_id, filename, channel, cast(start_time as varchar) as start_time, status, label, case when barcode is null then 'undetermined' else concat('BC', barcode + 1) end as barcode,
  case when barcode is null then '0.0000' else concat(12 + barcode, '.0000') end as barcode_score, case when label = 'pass' then printf('%.4f', sequence_length / 8.0) else '' end as polya_dwell from v_reads""")
def snk_summary(spark, sf):
    r = b.reads(spark, sf).selectExpr("*", "coalesce(12 + barcode, 0) barcode_score", "case when label = 'pass' then sequence_length / 8.0D end polya_dwell")
    path = new_path(spark, "summary")
    sinks.write_summary(sinks.summary_rows(r), path)
    return spark.read.csv(path, sep="\t", header=True).na.fill("").select("read_id", "filename", "channel", "start_time", "status", "label", "barcode", "barcode_score", "polya_dwell")


@query("""with h as (select *, row_number() over (partition by read_id order by mapq desc, ref, line, cigar) - 1 as rank from v_hits where flag = 0)
  select r.read_id, case when h.ref is null then 4 else (case when rank > 0 then 256 else 0 end) + (case when rank = 0 and h.ref % 10 = 3 then 2048 else 0 end) + (case when h.ref % 2 = 1 then 16 else 0 end) end as flag,
    case when h.ref is null then '*' else concat('c', h.ref) end as ref, case when h.ref is null then 0 else h.ref * 3 + 1 end as pos, coalesce(h.mapq, 0) as mapq,
    case when h.ref is null then '*' else concat(case when (case when h.ref % 2 = 1 then h.line - 1 else h.ref % 4 end) > 0 then concat(case when h.ref % 2 = 1 then h.line - 1 else h.ref % 4 end, 'S') else '' end, cigar,
      case when (case when h.ref % 2 = 1 then h.ref % 4 else h.line - 1 end) > 0 then concat(case when h.ref % 2 = 1 then h.ref % 4 else h.line - 1 end, 'S') else '' end) end as cigar,
    case when h.ref is null then '' else concat('NM:i:', h.line) end as nm from v_reads r left join h using (read_id)""")
def snk_sam(spark, sf):
    h = b.hits(spark, sf).filter("flag = 0").selectExpr("read_id", "row_number() over (partition by read_id order by mapq desc, ref, line, cigar) - 1 rank", "ref % 10 <> 3 primary", "ref % 2 = 1 reverse", "concat('c', ref) ref", "ref * 3 start", "mapq", "cigar", "ref % 4 lead", "line - 1 trail", "line nm")
    return sinks.sam_rows(b.reads(spark, sf), h)


@query("select read_id, adapter_length % 100 as start, adapter_length as \"end\", substr(read_id, 1, 3) as bucket from v_reads")
def snk_adapter_inventory(spark, sf):
    r = b.reads(spark, sf).selectExpr("read_id", "adapter_length % 100 start", "adapter_length end")
    odd = "cast(read_id as bigint) % 2 = 1"
    return sinks.adapter_inventory([r.filter(odd), r.filter(f"not {odd}"), r.filter("cast(read_id as bigint) % 5 = 0").selectExpr("read_id", "start + 1 start", "end")])


@query("select substr(read_id, 1, 3) as bucket, read_id, count(*) as n_events from v_evt group by 1, 2")
def snk_event_inventory(spark, sf):
    """Written by bucket and read back from the files."""
    path = new_path(spark, "event-inventory")
    e = b.events(spark, sf)
    e.withColumn("bucket", F.substring("read_id", 1, 3)).write.partitionBy("bucket").parquet(path)
    return sinks.event_inventory(spark.read.schema(e.schema).parquet(path))
