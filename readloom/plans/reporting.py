"""Queries over read status and run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom import bindings as b
from readloom.operators import reads, reports
from readloom.operators.segmentation import segment_map
from readloom.plans.registry import query


@query("""select read_id, st as status, case st when 'okay' then 'pass' when 'unsplit_read' then 'artifact' else 'fail' end as label from (select read_id,
  case when adapter_length < 5000 then 'adapter_not_detected' when cast(read_id as bigint) % 7 = 0 then 'not_basecalled' when label = 'artifact' then 'unsplit_read'
    when sequence_length < 270 then 'sequence_too_short' else 'okay' end st from v_reads)""")
def rd_status_label(spark, sf):
    checks = [
        ("adapter_not_detected", F.col("adapter_length") < 5000),
        ("not_basecalled", F.col("read_id").cast("long") % 7 == 0),
        ("unsplit_read", F.col("label") == "artifact"),
        ("sequence_too_short", reads.too_short(F.col("sequence_length"), F.lit(260))),
    ]
    return reads.status_label(b.reads(spark, sf), checks).select("read_id", "status", "label")


@query("select read_id, case when sequence_length - adapter_length // 100 < 10 then 'sequence_too_short' else 'okay' end as status from v_reads")
def rd_min_length(spark, sf):
    short = reads.too_short(F.col("sequence_length"), F.expr("adapter_length div 100"))
    return b.reads(spark, sf).select("read_id", F.when(short, "sequence_too_short").otherwise("okay").alias("status"))


@query("""with s as (select read_id, k - 1 as p0, case when state is not distinct from lag(state) over (partition by read_id order by k) and k > 1 then 0 else 1 end turn, state from v_evt),
  g as (select *, sum(turn) over (partition by read_id order by p0) run from s), a as (select read_id, run, max(p0) l from g where state = 'click' group by 1, 2),
  m as (select read_id, arg_max(l, run) e from a group by 1), t as (select m.read_id, 2 + coalesce(sum(move), 0) trim from m left join v_evt v on v.read_id = m.read_id and v.start <= e * 15 group by 1)
  select read_id, cast(trim as bigint) as trim, case when trim > 20 + cast(read_id as bigint) % 40 then 'basecall_table_incomplete' else 'okay' end as status from t""")
def rd_adapter_trim_len(spark, sf):
    e = b.events(spark, sf)
    ends = segment_map(e).filter("state = 'click'").select("read_id", F.col("last").alias("adapter_end"))
    lengths = e.select("read_id").distinct().withColumn("sequence_length", F.expr("20 + cast(read_id as bigint) % 40"))
    return reads.adapter_trim_length(e, ends, lengths, 15)


@query("""select read_id, case when cast(read_id as bigint) % 30 > 0 then substr(seq, 1, greatest(length(seq) - cast(read_id as bigint) % 30, 0)) else seq end as seq,
  repeat('I', case when cast(read_id as bigint) % 30 > 0 then greatest(length(seq) - cast(read_id as bigint) % 30, 0) else length(seq) end) as qual from v_seq""")
def rd_trim_apply(spark, sf):
    df = b.sequences(spark, sf).selectExpr("read_id", "seq", "repeat('I', length(seq)) qual", "cast(read_id as bigint) % 30 trim")
    return reads.apply_trim(df).select("read_id", "seq", "qual")


_TWICE = "tw as (select *, 1 as arrival from v_reads union all select *, 2 from v_reads where cast(read_id as bigint) % 3 = 0)"


@query(f"""with {_TWICE}, o as (select *, coalesce(max(case when status = 'okay' then 1 else 0 end) over (partition by filename, read_id order by arrival rows between unbounded preceding and 1 preceding), 0) done from tw)
  select filename, read_id, status, cast(arrival as bigint) as arrival from o where done = 0""")
def rd_dedup(spark, sf):
    r = b.reads(spark, sf)
    twice = r.withColumn("arrival", F.lit(1).cast("long")).unionByName(r.filter("cast(read_id as bigint) % 3 = 0").withColumn("arrival", F.lit(2).cast("long")))
    return reads.dedup_okay(twice, ["filename", "read_id"], "arrival").select("filename", "read_id", "status", "arrival")


@query("""select count(case when status = 'okay' then 1 end) as okay, count(case when status = 'not_basecalled' then 1 end) as not_basecalled,
  count(case when status = 'okay' then 1 end) = 0 and count(case when status = 'not_basecalled' then 1 end) >= 1000 as stop from v_reads where status <> 'okay'""")
def rd_early_stop(spark, sf):
    return reads.early_stop(b.reads(spark, sf).filter("status <> 'okay'"))


@query("""with p as (select read_id, sum(length) as polya from v_evt where mean between 103.85 and 114.05 group by 1)
  select r.read_id, r.label, r.barcode, h.n as n_hits, p.polya from v_reads r left join (select read_id, count(*) n from v_hits where flag = 0 group by 1) h using (read_id) left join p using (read_id)""")
def rd_result_assemble(spark, sf):
    hits = b.hits(spark, sf).filter("flag = 0").groupBy("read_id").agg(F.count("ref").alias("n_hits"))
    tails = b.events(spark, sf).filter("mean between 103.85 and 114.05").groupBy("read_id").agg(F.sum("length").alias("polya"))
    return reads.assemble(b.reads(spark, sf).select("read_id", "label", "barcode"), hits, tails)


@query("select coalesce(label, 'fail') as label, barcode, status, count(*) as n from v_reads group by 1, 2, 3")
def agg_final_counts(spark, sf):
    return reports.final_counts(b.reads(spark, sf))


_TEXTS = "case status " + " ".join(f"when '{k}' then '{v.replace(chr(39), chr(39) * 2)}'" for k, v in reports.STATUS_TEXT.items()) + " end"


@query(f"""with w as (select coalesce(label, 'fail') as label, status, count(case when barcode = 0 then 1 end) as "BC1", count(case when barcode = 1 then 1 end) as "BC2",
    count(case when barcode = 2 then 1 end) as "BC3", count(case when barcode = 3 then 1 end) as "BC4", count(case when barcode is null then 1 end) as undetermined from v_reads group by 1, 2)
  select *, {_TEXTS} as text, row_number() over (order by case label when 'pass' then 0 when 'artifact' then 1 else 2 end, greatest("BC1", "BC2", "BC3", "BC4", undetermined) desc, status) as place from w""")
def agg_final_report(spark, sf):
    return reports.final_report(reports.final_counts(b.reads(spark, sf)), [0, 1, 2, 3, None])


def _mapped(spark, sf):
    """Reads with group, outcome and best reference."""
    best = b.hits(spark, sf).filter("flag = 0").groupBy("read_id").agg(F.concat(F.lit("c"), F.max_by(F.col("ref") % 200, F.struct("mapq", "ref")).cast("string")).alias("name"))
    return b.reads(spark, sf).join(best, "read_id", "left").withColumns({"grp": F.concat(F.lit("BC"), (F.col("barcode") + 1).cast("string")), "failed": F.col("label") == "fail", "unmapped": (F.col("label") != "fail") & F.col("name").isNull()})


_MAPPED = """bs as (select read_id, concat('c', arg_max(ref % 200, struct_pack(m := mapq, r := ref))) as name from v_hits where flag = 0 group by 1),
  mp as (select r.*, b.name, case when barcode is null then null else concat('BC', barcode + 1) end grp, label = 'fail' as failed, label <> 'fail' and b.name is null as unmapped from v_reads r left join bs b using (read_id))"""


@query(f"""with {_MAPPED} select case when grouping(grp) = 1 then 'overall' else coalesce(grp, 'undetermined') end as grp, count(*) as total, count(case when failed then 1 end) as failed,
  count(case when unmapped then 1 end) as unmapped, count(*) - count(case when failed then 1 end) - count(case when unmapped then 1 end) as mapped from mp group by rollup(mp.grp)""")
def agg_group_stats(spark, sf):
    return reports.group_stats(_mapped(spark, sf))


@query(f"""with {_MAPPED}, c as (select coalesce(grp, 'undetermined') g, name, count(*) n from mp where name is not null group by 1, 2 union all select 'overall', name, count(*) from mp where name is not null group by 2),
  r as (select *, row_number() over (partition by g order by n desc, name) place from c)
  select g as grp, place, name, case when cast(substr(name, 2) as int) % 2 = 0 then concat('gene ', name) else name end as alias, n from r where place <= 50""")
def agg_top_contigs(spark, sf):
    m = _mapped(spark, sf).filter("name is not null").withColumn("grp", F.coalesce("grp", F.lit("undetermined")))
    aliases = m.select(F.col("name").alias("contig")).distinct().filter("cast(substring(contig, 2) as int) % 2 = 0").withColumn("alias", F.concat(F.lit("gene "), "contig"))
    return reports.top_contigs(m, aliases)


@query(f"""with {_MAPPED} select round(count(barcode) / count(*), 9) as demux_rate, round((count(*) - count(case when unmapped then 1 end)) / count(*), 9) as mapped_rate,
  cast(floor(count(*) * 100 / 20000) as bigint) as progress from mp""")
def agg_rates(spark, sf):
    return reports.rates(_mapped(spark, sf), 20000).withColumns({"demux_rate": F.round("demux_rate", 9), "mapped_rate": F.round("mapped_rate", 9)})


@query(f"""with {_MAPPED}, o as (select barcode, case when failed then null else coalesce(name, '*') end nm from mp)
  select barcode, count(distinct case when nm <> '*' then nm end) as names, count(case when nm <> '*' then 1 end) as mapped, count(case when nm = '*' then 1 end) as unmapped, count(case when nm is null then 1 end) as failed from o group by 1""")
def agg_map_outcome(spark, sf):
    m = _mapped(spark, sf).withColumn("name", F.expr("case when failed then null else coalesce(name, '*') end"))
    out = reports.map_outcome(m)
    return out.select("barcode", F.size("mapped").cast("long").alias("names"), F.aggregate("mapped", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("mapped"), F.col("unmapped").cast("long").alias("unmapped"), F.col("failed").cast("long").alias("failed"))
