"""Queries over training-set preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom import bindings as b
from readloom.functions import match_length, pool_mean
from readloom.operators import scaling, training
from readloom.operators.demux import prepare_adapters
from readloom.plans.registry import query

SAMPLES = ["ath", "hsa", "sce", "cel"]
_M = "cast(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)M', 1), lambda x: cast(x as bigint))) as bigint)"
_SCORES = f"""sc as (select read_id, sample, max({_M}) score from v_hits where flag = 0 group by 1, 2),
  mx as (select read_id, coalesce(max(case when sample = 'ath' then score end), 0) ath, coalesce(max(case when sample = 'hsa' then score end), 0) hsa,
    coalesce(max(case when sample = 'sce' then score end), 0) sce, coalesce(max(case when sample = 'cel' then score end), 0) cel from sc group by 1),
  bd as (select distinct read_id from v_hits where ref % 200 = 7), cl as (select * from mx where read_id not in (select read_id from bd)),
  bs as (select *, greatest(ath, hsa, sce, cel) best, list_sort([ath, hsa, sce, cel], 'desc')[2] as second, list_position([ath, hsa, sce, cel], greatest(ath, hsa, sce, cel)) - 1 as ix from cl)"""


def _scores(spark, sf):
    return training.best_scores(b.hits(spark, sf))


def _clean(spark, sf):
    hits = b.hits(spark, sf)
    bad = hits.select("ref").distinct().filter("ref % 200 = 7")
    return training.drop_ambiguous(training.score_matrix(_scores(spark, sf), SAMPLES), hits, bad)


def _best(spark, sf):
    return training.best_and_second(_clean(spark, sf), SAMPLES)


@query(f"""with m as (select concat('t', ref % 97) q, concat('t', (ref * 7 + line) % 97) t, {_M} m from v_hits)
  select distinct name from (select q as name from m where m >= 700 and q <> t union all select t from m where m >= 700 and q <> t union all select concat('t', ref % 5 + 200) from v_hits)""")
def trn_ref_blacklist(spark, sf):
    h = b.hits(spark, sf)
    m = h.select(F.expr("concat('t', ref % 97)").alias("query"), F.expr("concat('t', (ref * 7 + line) % 97)").alias("target"), match_length(F.col("cigar")).alias("m_length"))
    return training.reference_blacklist(m, h.select(F.expr("concat('t', ref % 5 + 200)").alias("name")), 700)


@query("select read_id, max(mapq) as mapq from v_hits where flag = 0 group by 1")
def trn_control_mapq(spark, sf):
    return training.control_mapq(b.hits(spark, sf))


@query(f"with {_SCORES} select read_id, sample, score from sc")
def trn_best_m_per_sample(spark, sf):
    return _scores(spark, sf)


@query(f"with {_SCORES} select * from mx")
def trn_score_matrix(spark, sf):
    return training.score_matrix(_scores(spark, sf), SAMPLES)


@query(f"with {_SCORES} select * from cl")
def trn_ambiguous_antijoin(spark, sf):
    return _clean(spark, sf)


@query(f"with {_SCORES} select read_id, best, second, round(best / (best + second), 9) as ratio, ['ath', 'hsa', 'sce', 'cel'][cast(ix + 1 as int)] as sample, ix as sample_index from bs")
def trn_best_second(spark, sf):
    return _best(spark, sf).select("read_id", "best", "second", F.round("ratio", 9).alias("ratio"), "sample", "sample_index")


@query(f"""with {_SCORES}, j as (select bs.*, best / (best + second) ratio, r.adapter_length, r.mean_qscore, r.sequence_length, r.status from bs join v_reads r using (read_id))
  select read_id, ix as sample_index, best, second, adapter_length from j where adapter_length between 5000 and 28000 and best >= 200 and second <= 400 and ratio >= 0.6 and mean_qscore >= 3 and sequence_length >= 260 and status = 'okay'""")
def trn_select_reads(spark, sf):
    r = b.reads(spark, sf)
    adapters = r.select("read_id", F.lit(0).alias("start"), F.col("adapter_length").alias("end"))
    limits = {"adapter_min": 5000, "adapter_max": 28000, "best_min": 200, "second_max": 400, "ratio_min": 0.6, "quality_min": 3, "length_min": 260}
    out = training.select_reads(_best(spark, sf), adapters, r.select("read_id", "mean_qscore", "sequence_length", "status"), limits)
    return out.select("read_id", "sample_index", "best", "second", "adapter_length")


_RANK = "row_number() over (partition by {p} order by md5(concat(read_id, '|', '{s}')), read_id)"


@query(f"""with ch as (select read_id from (select read_id, {_RANK.format(p='label', s=923)} r, count(*) over (partition by label) n from v_sig) where r <= floor(n * 0.4)),
  s as (select read_id, i - 48 as i, x from v_long join ch using (read_id) where i >= 48), m as (select read_id, median(x) m from s group by 1), d as (select read_id, median(abs(x - m)) d from s join m using (read_id) group by 1)
  select read_id, label, i, round((x - m) / greatest(0.01, 1.4826 * d), 6) as x from s join m using (read_id) join d using (read_id) join v_sig using (read_id)""")
def trn_signal_matrix(spark, sf):
    s = b.signals(spark, sf)
    chosen = training.stratified_split(s.select("read_id", "label"), 0.4).filter("is_test").select("read_id")
    m = prepare_adapters(s.join(chosen, "read_id"), 8, 1000, 16)
    return m.select("read_id", "label", F.posexplode("signal").alias("i", "x")).select("read_id", "label", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


@query(f"select read_id, label from (select read_id, label, {_RANK.format(p='label', s=922)} r from v_reads) where r <= 3000")
def trn_class_cap_sample(spark, sf):
    return training.class_cap_sample(b.reads(spark, sf).select("read_id", "label"), 3000)


@query(f"select read_id, label, r <= floor(n * 0.2) as is_test from (select read_id, label, {_RANK.format(p='label', s=923)} r, count(*) over (partition by label) n from v_reads)")
def trn_stratified_split(spark, sf):
    return training.stratified_split(b.reads(spark, sf).select("read_id", "label"), 0.2)


@query("""select read_id, prior_label + 1 as label, pred_prob from v_pred where prior_label > 0 union all select '00000000-0000-0000-0000-000000000000', 0, pred_prob from v_pred where prior_label = 0""")
def trn_decoy_union(spark, sf):
    p = b.predictions(spark, sf).select("read_id", F.col("prior_label").alias("label"), "pred_prob")
    return training.with_decoys(p.filter("label > 0"), p.filter("label = 0"))


@query("select read_id, row_number() over (order by md5(concat(read_id, '|', '11')), read_id) as rank from v_reads")
def trn_shuffle(spark, sf):
    return training.shuffled(b.reads(spark, sf).select("read_id"), 11)


@query("select read_id, label, unnest(range(10)) as i, case when unnest(range(10)) = label then 1.0 else 0.0 end as x from v_sig")
def trn_onehot(spark, sf):
    out = b.signals(spark, sf).select("read_id", "label", training.one_hot(F.col("label"), 10).alias("v"))
    return out.select("read_id", "label", F.posexplode("v").alias("i", "x")).withColumn("i", F.col("i").cast("long"))


@query("with c as (select run_id, label, count(*) n from v_reads group by 1, 2) select run_id, label, n, round(sum(n) over (partition by run_id) / (count(*) over (partition by run_id) * n), 9) as weight from c")
def trn_class_weights(spark, sf):
    return training.class_weights(b.reads(spark, sf), ["run_id"]).withColumn("weight", F.round("weight", 9))


_HIST = """h as (select least(cast(floor((adapter_length // 15 - 90) / (2910 / 97.0)) as bigint), 96) b, count(*) n from v_reads where adapter_length // 15 between 90 and 3000 group by 1),
  hs as (select s.b as bin, coalesce(n, 0) as n from (select unnest(range(97)) b) s left join h using (b))"""


def _histogram(spark, sf):
    return training.length_histogram(b.reads(spark, sf).withColumn("pooled_length", F.expr("adapter_length div 15")), 90, 3000, 97)


@query(f"with {_HIST} select bin, n from hs")
def trn_length_histogram(spark, sf):
    return _histogram(spark, sf)


_QUOTA = _HIST + """, q as (select bin, n, n * 5000 / sum(n) over () s from hs), w as (select *, cast(floor(s) as bigint) w, round(s - floor(s), 9) rest from q),
  qt as (select bin, n, w + case when row_number() over (order by rest desc, bin) <= 5000 - sum(w) over () then 1 else 0 end as quota from w)"""


@query(f"with {_QUOTA} select bin, n, cast(quota as bigint) as quota from qt")
def trn_quota_apportion(spark, sf):
    return training.apportion(_histogram(spark, sf), 5000)


@query("""with o as (select read_id, signal, len(signal) n, cast('0x' || substr(md5(concat(read_id, '|', '5')), 1, 7) as bigint) own from v_sig),
  p as (select read_id, n, signal, own, unnest(range(0, n + 1)) i from o), q as (select *, (own + i) % 2147483647 g from p),
  c as (select read_id, signal, i as start, lead(i) over (partition by read_id order by i) - i as length from q where i = 0 or i = n or ((g * g % 2147483647) * g + i) % 2147483647 % 8 = 0)
  select read_id, start, length, round(list_sum(signal[start + 1 : start + length]), 6) as total from c where length between 4 and 24""")
def trn_fragment_slices(spark, sf):
    out = training.fragment_slices(b.signals(spark, sf), 8, 4, 24, 5)
    return out.select("read_id", F.col("start").cast("long").alias("start"), F.col("length").cast("long").alias("length"), F.round(F.aggregate("fragment", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@query("""with l as (select read_id, label, round(signal[64], 6) as k from v_sig), r as (select read_id as rid, label, round(signal[1], 6) as s from v_sig),
  j as (select l.read_id, l.label, l.k, r.rid, row_number() over (partition by l.read_id order by r.s, r.rid) n from l left join r on l.label = r.label and r.s >= l.k)
  select read_id, label, k, rid as next_rid from j where n = 1""")
def trn_next_fragment_asof(spark, sf):
    s = b.signals(spark, sf)
    left = s.select("label", "read_id", F.round(F.element_at("signal", 64), 6).alias("k"))
    right = s.select("label", F.col("read_id").alias("rid"), F.round(F.element_at("signal", 1), 6).alias("s"))
    return training.next_at_least(left, right, ["label"], "k", "s", ["rid"])


@query(f"""with {_QUOTA}, c as (select read_id, least(cast(floor((adapter_length // 15 - 90) / (2910 / 97.0)) as bigint), 96) as bin from v_reads where adapter_length // 15 between 90 and 3000),
  r as (select *, row_number() over (partition by bin order by md5(read_id), read_id) n from c) select r.read_id, r.bin from r join qt using (bin) where r.n <= quota""")
def trn_quota_fill(spark, sf):
    c = b.reads(spark, sf).withColumn("p", F.expr("adapter_length div 15")).filter("p between 90 and 3000").select("read_id", F.least(F.floor((F.col("p") - 90) / (2910 / 97.0)), F.lit(96)).alias("bin"), F.md5("read_id").alias("h"))
    return training.quota_fill(c, training.apportion(_histogram(spark, sf), 5000), "bin", ["h", "read_id"]).select("read_id", "bin")


@query()
def trn_demux_model(spark, sf):
    s = training.stratified_split(b.signals(spark, sf).withColumn("signal", pool_mean(F.col("signal"), 4)), 0.2)
    weights = training.class_weights(s.filter("not is_test"), [])
    model = training.fit_demux(s.filter("not is_test").join(F.broadcast(weights.select("label", "weight")), "label"))
    out = training.prediction_table(training.predict_demux(model, s.filter("is_test")))
    return out.withColumn("pred_prob", F.round("pred_prob", 4))


_PROBS = "pb as (select read_id, label, list_transform(signal[1:10], lambda x: exp((x - 90) / 10)) e from v_sig), pn as (select read_id, label, list_transform(e, lambda v: v / list_sum(e)) p from pb)"


def _probs(spark, sf):
    e = b.signals(spark, sf).withColumn("e", F.transform(F.slice("signal", 1, 10), lambda x: F.exp((x - 90) / 10)))
    return e.withColumn("probs", F.transform("e", lambda v: v / F.aggregate("e", F.lit(0.0), lambda s, x: s + x)))


@query(f"with {_PROBS} select read_id, label as prior_label, list_position(p, list_max(p)) - 1 as pred_label, round(list_max(p), 9) as pred_prob from pn")
def trn_prediction_table(spark, sf):
    return training.prediction_table(_probs(spark, sf)).withColumn("pred_prob", F.round("pred_prob", 9))


@query(f"""with {_PROBS}, r as (select label, list_position(p, list_max(p)) - 1 pl, greatest(p[cast(label + 1 as int)], 1e-7) own from pn),
  w as (select *, case when label <> pl and label > 0 and pl > 0 then 2.0 else 1.0 end wt from r) select round(sum(wt * -ln(own)) / sum(wt), 6) as loss, round(sum(case when label = pl then wt else 0 end) / sum(wt), 6) as accuracy from w""")
def trn_weighted_metrics(spark, sf):
    out = training.weighted_metrics(_probs(spark, sf), training.cost_matrix(spark, 10))
    return out.select(F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"))


@query("select read_id, row_number() over (order by md5(concat(read_id, '|', '1')), read_id) as rank, (row_number() over (order by md5(concat(read_id, '|', '1')), read_id) - 1) % 300 as task from v_reads")
def scl_task_split(spark, sf):
    return scaling.task_split(b.reads(spark, sf).select("read_id"), 300)


_KM = """ev as (select read_id, k, mean, move, case when event_type_id = 7 then 'AC_GU' else substr('ACGUACGUUGCA', cast(1 + k % 8 as int), 5) end kmer from (select *, length % 11 as event_type_id from v_evt)),
  ps as (select *, sum(move) over (partition by read_id order by k) pos from ev), jm as (select distinct read_id, unnest([pos - 1, pos]) pos from ps where move > 1),
  pr as (select read_id, pos, arg_min(kmer, k) kmer, median(mean) observed from ps group by 1, 2),
  cn as (select pr.* from pr anti join jm on pr.read_id = jm.read_id and pr.pos = jm.pos where kmer not like '%\\_%' escape '\\'),
  en as (select read_id from cn group by 1 having count(*) >= 5), mo as (select distinct kmer, 80.0 + ascii(substr(kmer, 1, 1)) * 0.2 + ascii(substr(kmer, 2, 1)) * 0.05 as level_mean from ev),
  lv as (select cn.read_id, cn.pos, cn.kmer, observed, level_mean from cn join en using (read_id) join mo using (kmer))"""


def _levels(spark, sf):
    e = b.events(spark, sf).withColumn("kmer", F.expr("case when length % 11 = 7 then 'AC_GU' else substring('ACGUACGUUGCA', cast(1 + k % 8 as int), 5) end"))
    model = e.select("kmer").distinct().withColumn("level_mean", F.expr("80.0D + ascii(substring(kmer, 1, 1)) * 0.2D + ascii(substring(kmer, 2, 1)) * 0.05D"))
    return scaling.kmer_levels(e, model, 5)


@query(f"with {_KM} select read_id, cast(pos as bigint) as pos, kmer, round(observed, 6) as observed, round(level_mean, 6) as level_mean from lv")
def scl_kmer_levels(spark, sf):
    return _levels(spark, sf).select("read_id", "pos", "kmer", F.round("observed", 6).alias("observed"), F.round("level_mean", 6).alias("level_mean"))


@query(f"""with {_KM}, sl as (select a.read_id, median((b.level_mean - a.level_mean) / (b.observed - a.observed)) slope from lv a join lv b on a.read_id = b.read_id and a.pos < b.pos and a.observed <> b.observed group by 1)
  select lv.read_id, round(any_value(slope), 6) as slope, round(median(level_mean - slope * observed), 6) as intercept from lv join sl using (read_id) group by 1""")
def scl_theil_sen(spark, sf):
    out = scaling.theil_sen(_levels(spark, sf))
    return out.select("read_id", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query(f"with c as (select min(n) n from (select run_id, count(*) n from v_reads group by 1)) select read_id, run_id from (select read_id, run_id, {_RANK.format(p='run_id', s=922)} r from v_reads), c where r <= c.n")
def scl_balanced_subsample(spark, sf):
    return scaling.balanced_subsample(b.reads(spark, sf).select("read_id", "run_id"))


_PAIRS = "select read_id, mean_qscore as a, sequence_length / 100.0 + mean_qscore * 0.3 as b from v_reads"


@query(f"""with p as ({_PAIRS}), o as (select median(a) ma, median(b) mb, var_pop(a) va, var_pop(b) vb, covar_pop(a, b) c from p),
  d as (select read_id, ((a - ma) * (a - ma) * vb - 2 * (a - ma) * (b - mb) * c + (b - mb) * (b - mb) * va) / (va * vb - c * c) as distance from p, o)
  select read_id, round(distance, 6) as distance from d where distance <= (select quantile_cont(distance, 0.98) from d)""")
def scl_outlier_filter(spark, sf):
    p = b.reads(spark, sf).selectExpr("read_id", "mean_qscore a", "sequence_length / 100.0D + mean_qscore * 0.3D b")
    return scaling.outlier_filter(p, "a", "b").select("read_id", F.round("distance", 6).alias("distance"))


@query("select read_id, row_number() over (order by md5(concat(read_id, '|', '7')), read_id) <= floor((select count(*) from v_reads) * 0.8) as is_train from v_reads")
def scl_train_test_split(spark, sf):
    return scaling.train_test_split(b.reads(spark, sf).select("read_id"), 0.8)


@query()
def scl_redisperse(spark, sf):
    df = b.signals(spark, sf).withColumns({"scale": 1 + F.col("label") * 0.01, "shift": F.col("label") - 4.5})
    return scaling.redisperse(df).select("read_id", F.size("signal").alias("n"), F.round("new_scale", 6).alias("new_scale"))


@query("""select read_id, round((mean_qscore - (select avg(mean_qscore) from v_reads)) / ((select stddev_pop(mean_qscore) from v_reads) * 1.8), 6) as scale_z,
  round((sequence_length - (select avg(sequence_length) from v_reads)) / ((select stddev_pop(sequence_length) from v_reads) * 1.8), 6) as shift_z from v_reads""")
def scl_standardize(spark, sf):
    df = b.reads(spark, sf).selectExpr("read_id", "mean_qscore scale", "cast(sequence_length as double) shift")
    return scaling.standardise(df, ["scale", "shift"], 1.8).select("read_id", F.round("scale_z", 6).alias("scale_z"), F.round("shift_z", 6).alias("shift_z"))


@query("""select 'scale' as output, round(corr(prior_label, pred_label), 6) as r, round(sqrt(avg(pow(prior_label - pred_label, 2))), 6) as rmsd from v_pred
  union all select 'shift', round(corr(pred_prob, prior_label), 6), round(sqrt(avg(pow(pred_prob - prior_label, 2))), 6) from v_pred""")
def scl_evaluate(spark, sf):
    out = scaling.evaluate(b.predictions(spark, sf), {"scale": ("prior_label", "pred_label"), "shift": ("pred_prob", "prior_label")})
    return out.select("output", F.round("r", 6).alias("r"), F.round("rmsd", 6).alias("rmsd"))


@query("select read_id, run_id from v_reads order by run_id, cast(read_id as bigint) limit 500")
def scl_mini_dataset(spark, sf):
    df = b.reads(spark, sf).select("read_id", "run_id", F.col("read_id").cast("long").alias("o"))
    return scaling.mini_dataset(df, 500, ["run_id", "o"]).drop("o")
