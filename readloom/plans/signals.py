"""Queries over signal arrays, sequences and small scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom import bindings as b
from readloom import functions as fn
from readloom.plans.registry import query


def _long(df, value, digits=6):
    """An array column as rounded rows, so that results compare value by value."""
    return df.select("read_id", F.posexplode(value).alias("i", "x")).select("read_id", F.col("i").cast("long").alias("i"), F.round("x", digits).alias("x"))


def _norm(df, value):
    return _long(df.select("read_id", value.alias("v")), "v")


@query("select read_id, i - 5 as i, round(1400.0 / 8192 * (x + 3), 6) as x from v_long where i >= 5 and i < 40")
def sig_calibrate(spark, sf):
    return _norm(b.signals(spark, sf), fn.calibrate(F.col("signal"), 1400.0, 8192.0, 3.0, 5, 40))


@query("select read_id, i // 5 as i, round(avg(x), 6) as x from v_long where i // 5 < 12 group by 1, 2")
def sig_pool_mean(spark, sf):
    return _norm(b.signals(spark, sf), fn.pool_mean(F.col("signal"), 5))


@query("""with p as (select read_id, i // 4 as j, avg(x) x from v_long where i < 60 group by 1, 2), s as (select distinct read_id, unnest(range(20)) i from v_sig)
  select s.read_id, s.i, round(coalesce(p.x, 0.0), 6) as x from s left join p on p.read_id = s.read_id and p.j = s.i - 5""")
def sig_head_pad(spark, sf):
    return _norm(b.signals(spark, sf), fn.head_pad(F.col("signal"), 61, 4, 20))


@query("""with s as (select read_id, unnest(range(16)) i, len(list_filter(signal, lambda x: x > 88.5)) n from v_sig), v as (select read_id, row_number() over (partition by read_id order by i) - 1 j, x from v_long where x > 88.5)
  select s.read_id, s.i, round(coalesce(v.x, -1000.0), 6) as x from s left join v on v.read_id = s.read_id and v.j = s.i - 16 + s.n""")
def sig_tail_fit(spark, sf):
    return _norm(b.signals(spark, sf), fn.tail_fit(F.filter("signal", lambda x: x > 88.5), 16, -1000.0))


@query("select read_id, i, round((1 + label * 0.01) * x + (label - 3), 6) as x from v_long join v_sig using (read_id)")
def sig_affine_scale(spark, sf):
    return _norm(b.signals(spark, sf), fn.affine(F.col("signal"), 1 + F.col("label") * 0.01, F.col("label") - 3))


@query("""select read_id, i, round(list_sort([coalesce(lag(x, 3) over w, 0), coalesce(lag(x, 2) over w, 0), coalesce(lag(x) over w, 0), x,
    coalesce(lead(x) over w, 0), coalesce(lead(x, 2) over w, 0), coalesce(lead(x, 3) over w, 0)])[4], 6) as x from v_long window w as (partition by read_id order by i)""")
def sig_median_filter(spark, sf):
    return _norm(b.signals(spark, sf), fn.median_filter(F.col("signal"), 7))


@query("""with m as (select read_id, median(x) m from v_long group by 1), d as (select read_id, median(abs(x - m)) d from v_long join m using (read_id) group by 1)
  select read_id, i, round((x - m) / greatest(0.01, 1.4826 * d), 6) as x from v_long join m using (read_id) join d using (read_id)""")
def sig_mad_normalize(spark, sf):
    return _norm(b.signals(spark, sf), fn.mad_normalize(F.col("signal")))


@query("""with q as (select read_id, seq s from v_seq) select read_id, i - 1 as i, round(1 - pow(10.0, -(ascii(substr(s, cast(i as int), 1)) - 33) / 10.0), 6) as x
  from (select read_id, s, unnest(range(1, length(s) + 1)) i from q)""")
def sig_quality_decode(spark, sf):
    p = b.sequences(spark, sf).select("read_id", F.posexplode(fn.quality_decode(F.col("seq"), 6)).alias("i", "x"))
    return p.select("read_id", F.col("i").cast("long").alias("i"), "x")


@query("select read_id, translate(seq, 'U', 'T') as dna, reverse(seq) as reversed, reverse(translate(seq, 'ACGTU', 'TGCAA')) as revcomp from v_seq")
def seq_rna_transform(spark, sf):
    return b.sequences(spark, sf).select("read_id", fn.to_dna(F.col("seq")).alias("dna"), F.reverse("seq").alias("reversed"), fn.reverse_complement(F.col("seq")).alias("revcomp"))


@query("select read_id, substr(read_id, 1, 3) as bucket from v_reads")
def seq_prefix_bucket(spark, sf):
    return b.reads(spark, sf).select("read_id", fn.prefix_bucket(F.col("read_id")).alias("bucket"))


@query("select read_id, cigar, cast(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)M', 1), lambda x: cast(x as bigint))) as bigint) as m_length from v_hits")
def cigar_match_length(spark, sf):
    return b.hits(spark, sf).select("read_id", "cigar", fn.match_length(F.col("cigar")).alias("m_length"))


@query("""select name, case when name like '|%' then name else split_part(name, '|', 1) end as primary_name
  from (select name from v_refs union all select concat('|', name) from v_refs)""")
def name_primary_part(spark, sf):
    refs = b.references(spark, sf).select("name")
    names = refs.union(refs.select(F.concat(F.lit("|"), "name")))
    return names.select("name", fn.primary_part(F.col("name")).alias("primary_name"))


@query("""select distinct label, barcode, concat('fastq/', label, '/', case when barcode is null then 'undetermined' else concat('BC', barcode + 1) end, '.fastq.gz') as path,
  concat('fastq/', label, '.fastq.gz') as plain_path from v_reads""")
def layout_path(spark, sf):
    groups = b.reads(spark, sf).select("label", "barcode").distinct()
    return groups.select("label", "barcode", fn.layout_path(F.col("label"), F.col("barcode")).alias("path"), fn.layout_path(F.col("label")).alias("plain_path"))
