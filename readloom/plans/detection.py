"""Queries over events, segments, poly(A) tails and fused reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom import bindings as b
from readloom.operators import chimera, events, polya, reports, segmentation, tails
from readloom.operators.intervals import interval_union as union_of
from readloom.plans.registry import query
from readloom.sources.shared import ensure_checkpoints

_RATE = 100.0  # samples a second of the bound events


@query("""select read_id, k, start, mean, sum(move) over w as pos, coalesce(lead(start) over w, start + 1) as "end", round(1.1 * mean - 3, 6) as scaled_mean
  from v_evt window w as (partition by read_id order by k)""")
def evt_derived_columns(spark, sf):
    out = events.derived_columns(b.events(spark, sf), 1.1, -3.0)
    return out.select("read_id", "k", "start", "mean", "pos", "end", F.round("scaled_mean", 6).alias("scaled_mean"))


@query("""with s as (select *, sum(x) over l sl, sum(x * x) over l ql, count(x) over l nl, sum(x) over r sr, sum(x * x) over r qr, count(x) over r nr from v_long
    window l as (partition by read_id order by i rows between 3 preceding and 1 preceding), r as (partition by read_id order by i rows between current row and 2 following))
  select read_id, i, round(case when nl = 3 and nr = 3 then abs(sr / 3 - sl / 3) / sqrt(greatest(ql / 3 - sl / 3 * sl / 3 + qr / 3 - sr / 3 * sr / 3, 1.1754943508222875e-38) / 3) else 0 end, 4) as t from s""")
def evt_window_tstat(spark, sf):
    out = events.window_tstat(b.signals(spark, sf), 3).select("read_id", F.posexplode("t").alias("i", "t"))
    return out.select("read_id", F.col("i").cast("long").alias("i"), F.round("t", 4).alias("t"))


def _stats(spark, sf):
    return events.window_tstat(events.window_tstat(b.signals(spark, sf), 3, "t_short"), 6, "t_long")


@query()
def evt_peak_boundaries(spark, sf):
    return events.peak_boundaries(_stats(spark, sf), (3, 6), (1.0, 2.0), 0.5)


@query("""with c as (select *, sum(case when i > 0 and i % 7 = 3 then 1 else 0 end) over (partition by read_id order by i) e from v_long)
  select read_id, min(i) as start, count(*) as length, round(avg(x), 6) as mean, round(stddev_pop(x), 6) as stdv from c group by read_id, e""")
def evt_from_boundaries(spark, sf):
    marked = b.signals(spark, sf).withColumn("boundaries", F.expr("filter(sequence(0, size(signal)), i -> i % 7 = 3)"))
    return events.events_from_boundaries(marked).withColumns({"mean": F.round("mean", 6), "stdv": F.round("stdv", 6)})


@query()
def evt_detect(spark, sf):
    found = events.detect_events(b.signals(spark, sf), (3, 6), (1.0, 2.0), 0.5)
    return found.withColumns({"mean": F.round("mean", 6), "stdv": F.round("stdv", 6)})


@query("""with d as (select *, sum(move) over w as pos, coalesce(lead(start) over w, start + 1) as "end" from v_evt window w as (partition by read_id order by k)),
  a as (select read_id, count(*) as n_events, max(start + length) as samples from v_evt group by 1)
  select read_id, k, mean, start, stdv, length, state, move, pos, "end", n_events, samples, substr(read_id, 1, 3) as bucket from d join a using (read_id)""")
def evt_dump(spark, sf):
    e = b.events(spark, sf)
    attributes = e.groupBy("read_id").agg(F.count("k").alias("n_events"), F.max(F.col("start") + F.col("length")).alias("samples"))
    return events.event_dump(events.derived_columns(e, 1.0, 0.0), attributes)


@query()
def seg_viterbi(spark, sf):
    path = b.signals(spark, sf).select("read_id", segmentation.viterbi(F.col("signal")).alias("path"))
    return path.select("read_id", F.posexplode("path").alias("i", "state"))


_RUNS = """with s as (select read_id, k, state, k - 1 as p0, case when state is not distinct from lag(state) over w and k > 1 then 0 else 1 end turn from v_evt window w as (partition by read_id order by k)),
  g as (select *, sum(turn) over (partition by read_id order by k) run from s), r as (select read_id, run, any_value(state) state, min(p0) f, max(p0) l from g group by 1, 2),
  m as (select read_id, state, arg_max(f, run) as "first", arg_max(l, run) as "last" from r group by 1, 2)"""


@query(_RUNS + ' select read_id, state, "first", "last" from m')
def seg_runs(spark, sf):
    return segmentation.segment_map(b.events(spark, sf))


@query("""select read_id, 'adapter_not_detected' as status, 'fail' as label from (select distinct read_id from v_evt) where read_id not in (select read_id from v_evt where state = 'click' and k <= 3)""")
def seg_adapter_present(spark, sf):
    e = b.events(spark, sf)
    reads = e.select("read_id").distinct()
    return segmentation.adapter_missing(reads, segmentation.segment_map(e, limit=3), "click")


@query("""with s as (select read_id, i, case when x >= 90 then 'adapter' else 'other' end state from v_long),
  t as (select *, case when state is not distinct from lag(state) over (partition by read_id order by i) and i > 0 then 0 else 1 end turn from s),
  g as (select *, sum(turn) over (partition by read_id order by i) run from t), r as (select read_id, run, min(i) f, max(i) l from g where state = 'adapter' group by 1, 2),
  m as (select read_id, arg_max(f, run) f, arg_max(l, run) l from r group by 1)
  select read_id, l - f + 1 as n, round(list_sum(signal[cast(f + 1 as int):cast(l + 1 as int)]), 6) as total, f * 15 as start, (l + 1) * 15 as "end" from m join v_sig using (read_id)""")
def seg_adapter_slice(spark, sf):
    sig = b.signals(spark, sf)
    states = b.sampled_long(sig).withColumn("state", F.expr("case when x >= 90 then 'adapter' else 'other' end"))
    out = segmentation.adapter_slice(sig, segmentation.segment_map(states, order="i"), 15)
    total = F.round(F.aggregate("adapter", F.lit(0.0), lambda s, x: s + x), 6)
    return out.select("read_id", F.size("adapter").cast("long").alias("n"), total.alias("total"), "start", "end")


def _segments(spark, sf):
    """Event types stand in for states: clicks for the adapter, views for the tail."""
    s = segmentation.segment_map(b.events(spark, sf))
    return s.withColumn("state", F.expr("case state when 'click' then 'adapter' when 'view' then 'polya-tail' else state end"))


@query(_RUNS + """, o as (select read_id, max(case when state = 'click' then "last" end) ad, max(case when state = 'view' then "first" end) tf, max(case when state = 'view' then "last" end) tl from m group by 1),
  n as (select read_id, max(start + length) samples from v_evt group by 1), f as (select *, coalesce(tf, ad + 1) f from o where tf is not null or ad is not null),
  e as (select *, greatest(coalesce(tl, f), f + 66) l from f)
  select read_id, greatest(0, f * 15 - 200) as begin, least(samples, (l + 1) * 15 + 200) as "end", tf is not null as has_tail from e join n using (read_id)""")
def pa_inspect_window(spark, sf):
    lengths = b.events(spark, sf).groupBy("read_id").agg(F.max(F.col("start") + F.col("length")).alias("samples"))
    return polya.inspect_window(_segments(spark, sf), lengths)


@query("select read_id, k, mean between cast(108.95 as double) - 2 * cast(2.55 as double) and cast(108.95 as double) + 2 * cast(2.55 as double) as is_a from v_evt")
def pa_classify(spark, sf):
    return polya.classify(b.events(spark, sf)).select("read_id", "k", "is_a")


# The definition, evaluated over all pairs of poly(A) events of a read: the query itself uses prefix sums.
_BEST = """, v as (select *, case when is_a then length else cast(trunc(length * -1.5) as bigint) end v, sum(case when is_a then 1 else 0 end) over (partition by read_id order by k) r from e),
  g as (select *, sum(v) over (partition by read_id order by k) s, sum(case when is_a then 0 else length end) over (partition by read_id, r) away from v),
  t as (select *, sum(c) over (partition by read_id order by k) island from (select *, case when coalesce(lag(away) over (partition by read_id order by k), 0) > 110 then 1 else 0 end c from g where is_a)),
  p as (select a.read_id, b.s - a.s + a.v as score, a.k as "first", b.k as "last" from t a join t b on a.read_id = b.read_id and a.island = b.island and a.k <= b.k),
  best as (select read_id, score, "first", "last" from (select *, row_number() over (partition by read_id order by score desc, "first", "last") n from p) where n = 1 and score > 0)"""
_A = "with e as (select *, mean between cast(108.95 as double) - 2 * cast(2.55 as double) and cast(108.95 as double) + 2 * cast(2.55 as double) as is_a from v_evt)"


@query(_A + _BEST + ' select read_id, cast(score as bigint) as score, "first", "last" from best')
def pa_best_interval(spark, sf):
    return polya.best_interval(polya.classify(b.events(spark, sf)))


def _tail(spark, sf):
    e = polya.classify(b.events(spark, sf))
    return e, polya.best_interval(e)


@query()
def pa_extend_open(spark, sf):
    """Signals that follow the event table, searched from the first 1,000 samples on."""
    pieces = b.events(spark, sf).select("read_id", F.struct("k", F.expr("transform(sequence(start, start + length - 1), i -> mean + (i * 7919 % 1009) / 504.5D - 1)").alias("x")).alias("p"))
    signals = pieces.groupBy("read_id").agg(F.array_sort(F.collect_list("p")).alias("p")).select("read_id", F.expr("flatten(transform(p, q -> q.x))").alias("signal"))
    windows = signals.select("*", F.lit(0).alias("begin"), F.lit(1000).alias("upto"))
    return tails.extend_open(windows, 990).select("read_id", "upto", "rounds", "score", "first", "last", F.size("events").cast("long").alias("n_events"))


@query(_A + _BEST + """, lv as (select e.read_id, sum(mean * length) / sum(length) lev from e join best using (read_id) where k between "first" and "last" group by 1),
  fine as (select read_id from lv where abs(lev - 108.95) <= 1.7 * 2.55 and cast(read_id as bigint) % 3 <> 0),
  ad as (select read_id, max(start + length) adapter_end from v_evt where k <= 20 group by 1),
  nr as (select e.read_id, sum(mean * length) / sum(length) c from e join ad using (read_id) where start + length > adapter_end and start <= adapter_end + 100 and stdv < 5 group by 1),
  e1 as (select e.* exclude (is_a), mean between c - 2 * cast(2.55 as double) and c + 2 * cast(2.55 as double) as is_a from e join nr using (read_id) where read_id not in (select read_id from fine)),
  e2 as (select * from e1 where read_id in (select read_id from e1 where is_a group by 1 having sum(length) >= 750))"""
  + _BEST.replace("from e)", "from e2)").replace("v as (", "v2 as (").replace("from v)", "from v2)").replace("g as (", "g2 as (").replace("from g where", "from g2 where").replace("t as (", "t2 as (").replace("t a join t b", "t2 a join t2 b").replace("p as (", "p2 as (").replace("from p)", "from p2)").replace("best as (", "best2 as (")
  + """ select read_id, cast(score as bigint) as score, "first", "last", false as recalibrated from best where read_id in (select read_id from fine)
  union all select read_id, cast(score as bigint), "first", "last", true from best2""")
def pa_recalibrate(spark, sf):
    e, best = _tail(spark, sf)
    ends = e.filter("k <= 20").groupBy("read_id").agg(F.max(F.col("start") + F.col("length")).alias("adapter_end"))
    tails = e.select("read_id").distinct().filter(F.col("read_id").cast("long") % 3 != 0)
    return polya.recalibrate(e, best, ends, tails)


@query(_A + _BEST + """, w as (select e.read_id, arg_max(struct_pack(s := start, n := length), struct_pack(l := length, z := -k)) m from e join best using (read_id) where k between "first" and "last" group by 1),
  x as (select read_id, unnest(range(m.s, m.s + m.n)) i, m.s s, m.n n from w),
  y as (select read_id, 100 + (i * 7919 % 1009) / 100.0 as x from x where i >= s + floor(n * 0.05) and i < s + floor(n * 0.95)),
  z as (select read_id, stddev_pop(x) sd, count(*) c from y group by 1)
  select w.read_id, round(case when c > 2 then sd end, 6) as stdev, coalesce(c > 2 and sd < 5, false) as steady from w left join z using (read_id)""")
def pa_stdev_qc(spark, sf):
    e, best = _tail(spark, sf)
    x = F.expr("transform(sequence(start, start + length - 1), i -> 100 + (i * 7919 % 1009) / 100.0D)")
    return polya.stdev_check(e, best, e.select("read_id", "start", "length"), x).withColumn("stdev", F.round("stdev", 6))


@query()
def pa_steady_tails(spark, sf):
    """The whole chain from a first search to checked tails, over signals whose noise differs by event."""
    ensure_checkpoints(spark)
    e, best = _tail(spark, sf)
    e, best = e.checkpoint(), best.checkpoint()
    ends = e.filter("k <= 20").groupBy("read_id").agg(F.max(F.col("start") + F.col("length")).alias("adapter_end"))
    noise = F.expr("transform(sequence(start, start + length - 1), i -> if(k % 3 = 0, 2D, 1D) * (i * 7919 % 1009) / 100D)")
    return polya.steady_intervals(e, polya.recalibrate(e, best, ends, e.select("read_id").distinct()), e.select("read_id", "k", "start", "length"), ends, noise)


@query(_A + _BEST + """, n as (select *, lag(mean) over (partition by read_id order by k) b, lead(mean) over (partition by read_id order by k) a from e)
  select read_id, min(start) as begin, max(start + length) as "end", round(sum(case when is_a then length else 0 end) / 100.0, 6) as dwell, count(case when not is_a then 1 end) as n_spikes,
    round(coalesce(sum(case when not is_a then length + b + mean + a end), 0), 6) as spike_sum from n join best using (read_id) where k between "first" and "last" group by 1""")
def pa_dwell_spikes(spark, sf):
    e, best = _tail(spark, sf)
    out = polya.dwell_and_spikes(e, best, _RATE)
    total = F.aggregate("spikes", F.lit(0.0), lambda s, x: s + (x["length"] + x["before"] + x["mean"] + x["after"]))
    return out.select("read_id", "begin", "end", F.round("dwell", 6).alias("dwell"), F.size("spikes").cast("long").alias("n_spikes"), F.round(total, 6).alias("spike_sum"))


def _bounds(spark, sf):
    return b.events(spark, sf).groupBy("read_id").agg(F.max(F.when(F.col("k") <= 3, F.col("start") + F.col("length"))).alias("begin"), F.max(F.col("start") + F.col("length")).alias("finish"))


_BOUNDS = "bd as (select read_id, max(case when k <= 3 then start + length end) begin, max(start + length) finish from v_evt group by 1)"


@query(f"""with {_BOUNDS}, w as (select read_id, begin, finish, unnest(range(0, greatest(finish - begin, 1), 300)) // 300 as win from bd),
  j as (select w.read_id, win, begin + win * 300 as "left", e.k, e.start from w join v_evt e on e.read_id = w.read_id and e.start between begin + win * 300 and begin + win * 300 + 800),
  d as (select read_id, win, row_number() over (partition by read_id order by win) - 1 n from (select distinct read_id, win from j))
  select j.read_id, j.win as "window", "left", k, start from j join d on j.read_id = d.read_id and j.win = d.win and d.n = d.win""")
def chi_sliding_windows(spark, sf):
    return chimera.sliding_windows(b.events(spark, sf), _bounds(spark, sf), 800, 300).select("read_id", "window", "left", "k", "start")


@query()
def chi_leader_adapter(spark, sf):
    rows = chimera.sliding_windows(b.events(spark, sf), _bounds(spark, sf), 800, 300)
    wide = rows.groupBy("read_id", "window").agg(F.first("begin").alias("begin"), F.array_sort(F.collect_list(F.struct("k", "start", "length", "mean"))).alias("e"))
    parts = wide.select("read_id", "window", "begin", F.col("e.start").alias("starts"), F.expr("transform(e, x -> x.start + x.length - 1)").alias("ends"), F.expr("transform(e, x -> x.mean - 20)").alias("means"))
    return chimera.leader_adapters(parts, _RATE)


@query("""with i as (select state, read_id, start f, start + length * 2 l from v_evt), m as (select *, max(l) over (partition by read_id, state order by f, l rows between unbounded preceding and 1 preceding) r from i),
  g as (select *, sum(case when f <= r then 0 else 1 end) over (partition by read_id, state order by f, l rows unbounded preceding) n from m)
  select read_id, state, min(f) as "first", max(l) as "last" from g group by read_id, state, n""")
def interval_union(spark, sf):
    iv = b.events(spark, sf).selectExpr("read_id", "state", "start first", "start + length * 2 last")
    return union_of(iv, ["read_id", "state"])


_ADAPTERS = "ad as (select read_id, start a, start + length z, row_number() over (partition by read_id order by start) n from v_evt where k in (15, 30, 45))"
_COUNTS = f"""with {_BOUNDS}, ev as (select e.*, sum(move) over (partition by e.read_id order by k) pos from v_evt e), {_ADAPTERS},
  gp as (select bd.read_id, 0 as gap, begin as lo, coalesce((select min(a) from ad where ad.read_id = bd.read_id), finish) as hi from bd
    union all select ad.read_id, n, z, coalesce(lead(a) over (partition by ad.read_id order by a), finish) from ad join bd using (read_id)),
  t as (select gp.read_id, gap, pos, max(p_model_state) p from gp join ev on ev.read_id = gp.read_id and ev.start between lo and hi group by 1, 2, 3),
  c as (select gp.read_id, cast(gap as bigint) as gap, count(case when p > 0.4 then 1 end) as positions from gp left join t using (read_id, gap) group by 1, 2)"""


def _counts(spark, sf):
    e = events.derived_columns(b.events(spark, sf), 1.0, 0.0)
    adapters = e.filter("k in (15, 30, 45)").selectExpr("read_id", "start first", "start + length last")
    return chimera.subread_counts(e, _bounds(spark, sf), adapters)


@query(_COUNTS + " select read_id, gap, positions from c")
def chi_subread_counts(spark, sf):
    return _counts(spark, sf)


@query(_COUNTS + """, s as (select read_id, sum(case when gap > 0 then positions else 0 end) later, sum(case when gap = 0 then positions else 0 end) head, bool_or(gap > 0) found from c group by 1)
  select read_id, cast(later as bigint) as later, cast(head as bigint) as head, found and (later > 30 or (later + 1) / (head + 1) > 0.1) as unsplit from s""")
def chi_flag(spark, sf):
    return chimera.chimera_flag(_counts(spark, sf))


def flagship(spark, sf):
    """Events to poly(A) intervals, dwell and status counts, end to end."""
    e, best = _tail(spark, sf)
    tails = polya.dwell_and_spikes(e, best, _RATE).select("read_id", "dwell")
    status = e.select("read_id").distinct().join(tails, "read_id", "left").select(F.when(F.col("dwell").isNull(), "fail").otherwise("pass").alias("label"), F.lit(None).cast("long").alias("barcode"), F.when(F.col("dwell").isNull(), "adapter_not_detected").otherwise("okay").alias("status"))
    return reports.final_report(reports.final_counts(status), [None])
