"""Queries over sources and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom import bindings as b
from readloom import sources as src
from readloom.plans.registry import query

_HIDE = "case when cast(read_id as bigint) % 50 = 7 then concat(run_id, '/.part7.parquet') else filename end"


@query(f"select filename, read_id from (select {_HIDE} as filename, read_id from v_reads) where filename not like '%/.%'")
def src_read_catalog(spark, sf):
    reads = b.reads(spark, sf).withColumn("filename", F.expr(_HIDE))
    containers = reads.groupBy("filename").agg(F.collect_list(F.struct("read_id")).alias("reads"))
    return src.read_catalog(containers)


@query("select filename, read_id, run_id, channel, round(start_time / 3012.0, 3) as start_seconds from v_reads where cast(read_id as bigint) % 97 <> 0")
def src_read_metadata(spark, sf):
    reads = b.reads(spark, sf).withColumn("stored_id", F.expr("case when cast(read_id as bigint) % 97 = 0 then 'other' else read_id end"))
    return src.read_metadata(reads, 3012.0)[0]


@query("""with g as (select distinct read_id, concat('Basecall_1D_', lpad(cast(line as varchar), 3, '0')) grp from v_hits),
  l as (select read_id, max(grp) grp from g group by 1),
  s as (select read_id, lpad(cast(line as varchar), 3, '0') suffix, max(ref) first_sample, max(case when mapq > 30 then 10 end) block_stride from v_hits where flag = 0 group by 1, 2)
  select r.read_id, l.grp as "group", s.first_sample, coalesce(cast(s.block_stride as bigint), 15) as block_stride,
    case when l.grp is null then 'not_basecalled' else 'okay' end as status
  from v_reads r left join l using (read_id) left join s on s.read_id = r.read_id and s.suffix = split_part(l.grp, '_', 3)""")
def src_latest_basecall(spark, sf):
    hits = b.hits(spark, sf).withColumn("suffix", F.lpad(F.col("line").cast("string"), 3, "0"))
    groups = hits.select("read_id", F.concat(F.lit("Basecall_1D_"), "suffix").alias("group"))
    segments = hits.filter("flag = 0").groupBy("read_id", "suffix").agg(F.max("ref").alias("first_sample"), F.max(F.expr("case when mapq > 30 then 10l end")).alias("block_stride"))
    return src.latest_basecall(b.reads(spark, sf), groups, segments)


@query("select read_id, seq, repeat('I', length(seq)) as qual from v_seq")
def src_fastq_record(spark, sf):
    text = F.expr("concat('@', read_id, '\\n', seq, '\\n+\\n', repeat('I', length(seq)))")
    return src.fastq_record(b.sequences(spark, sf).select("read_id", text.alias("fastq"))).select("read_id", "seq", "qual")


@query("""select read_id, k, state, p_model_state, move, mean, stdv, length from v_evt where cast(read_id as bigint) % 2 = 1
  union all select read_id, k, state, p_model_state, move, null, null, null from v_evt where cast(read_id as bigint) % 2 = 0""")
def src_event_variant(spark, sf):
    e = b.events(spark, sf)
    odd = F.col("read_id").cast("long") % 2 == 1
    full = e.filter(odd).select("read_id", "k", "state", "p_model_state", "move", "mean", "stdv", "length")
    return src.event_variants(full, e.filter(~odd).select("read_id", "k", "state", "p_model_state", "move"))


@query("""with m as (select read_id, k - 1 as i, case when k = 1 then 1 else move end as move from v_evt),
  t as (select read_id, sum(move) total from m group by 1),
  p as (select m.read_id, i, sum(move) over (partition by m.read_id order by i) - 1 as pos, total,
    reverse(translate(substr(repeat('ACGUUGCAGU', 1000), 1, cast(total + 4 as int)), 'U', 'T')) s, substr(repeat('5?I+#', 2000), 1, cast(total + 4 as int)) q from m join t using (read_id))
  select read_id, i, cast(pos as bigint) as pos, substr(s, cast(pos as int) + 1, 5) as kmer, round(1 - pow(10.0, -(ascii(substr(q, cast(pos as int) + 3, 1)) - 33) / 10.0), 9) as p from p""")
def src_moves_to_events(spark, sf):
    e = b.events(spark, sf).withColumn("move", F.expr("case when k = 1 then 1 else move end"))
    reads = e.groupBy("read_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "move"))), lambda x: x["move"].cast("long")).alias("moves"))
    total = "aggregate(moves, 0l, (s, m) -> s + m)"
    reads = reads.withColumns({"seq": F.expr(f"substring(repeat('ACGUUGCAGU', cast(ceil(({total} + 4) / 10) as int)), 1, cast({total} + 4 as int))"), "qual": F.expr(f"substring(repeat('5?I+#', cast(ceil(({total} + 4) / 5) as int)), 1, cast({total} + 4 as int))")})
    return src.moves_to_events(reads)[0].withColumn("p", F.round("p", 9))


@query("""with f as (select read_id, i, list_sort([coalesce(lag(x, 2) over w, 0), coalesce(lag(x) over w, 0), x, coalesce(lead(x) over w, 0), coalesce(lead(x, 2) over w, 0)])[3] m
    from v_long window w as (partition by read_id order by i))
  select read_id, (i - 4) // 8 as block, 4 + (i - 4) // 8 * 8 as start, round(avg(m), 6) as mean, round(stddev_pop(m), 6) as stdv, cast(8 as bigint) as length
  from f where i >= 4 and (i - 4) // 8 < 7 group by 1, 2, 3""")
def src_block_events(spark, sf):
    out = src.block_events(b.signals(spark, sf), 4, 8)
    return out.withColumns({"mean": F.round("mean", 6), "stdv": F.round("stdv", 6)})


@query("select filename, read_id, channel, start_time, run_id as run_name from v_reads")
def src_summary_catalog(spark, sf):
    r = b.reads(spark, sf).select("filename", "read_id", "channel", "start_time", "run_id")
    return src.summary_catalog({f"run{i}": r.filter(F.col("run_id") == f"run{i}").drop("run_id") for i in range(4)})


@query("""with k as (select distinct substr(seq, cast(i as int), 5) kmer from (select seq, unnest(range(1, length(seq) - 3)) i from v_refs))
  select kmer, 60.0 + ascii(substr(kmer, 1, 1)) * 0.25 + ascii(substr(kmer, 3, 1)) * 0.5 as level_mean, cast(5 as bigint) as k from k""")
def src_kmer_model(spark, sf):
    kmers = b.references(spark, sf).filter("length(seq) > 4").select("seq", F.explode(F.expr("sequence(1, length(seq) - 4)")).alias("i")).select(F.expr("substring(seq, i, 5)").alias("kmer")).distinct()
    lines = kmers.select(F.expr("concat(kmer, '\\t', 60.0D + ascii(substring(kmer, 1, 1)) * 0.25D + ascii(substring(kmer, 3, 1)) * 0.5D)").alias("value"))
    return src.kmer_model(lines)


@query("select split_part(name, '|', 1) as contig, concat('alias of ', name) as alias from v_refs")
def src_contig_alias(spark, sf):
    return src.contig_aliases(b.references(spark, sf).select(F.expr("concat(split(name, '[|]')[0], '\\t', 'alias of ', name)").alias("value")))


@query("select name, length(seq) as length from v_refs")
def src_reference_sequences(spark, sf):
    return src.reference_lengths(b.references(spark, sf))


@query("select read_id, concat('>', read_id, chr(10), translate(seq, 'U', 'T')) as fasta from v_seq")
def src_fastq_to_fasta(spark, sf):
    return src.fastq_to_fasta(b.sequences(spark, sf))
