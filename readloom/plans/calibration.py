"""Queries over score calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom import bindings as b
from readloom.operators import calibration as cal
from readloom.plans.registry import query
from readloom.sources.shared import ensure_checkpoints

_RANKED = "rk as (select *, row_number() over (order by pred_prob desc, read_id, prior_label, pred_label) - 1 as rank from v_pred where prior_label <> 0 and pred_label <> 0), tn as (select count(*) t from rk)"


def _windows(size: int, least: int, step: int, name: str) -> str:
    return f"""{name} as (select s.st as start, count(*) as n, avg(case when prior_label <> pred_label then 1.0 else 0.0 end) error_rate, max(pred_prob) high, min(pred_prob) low, avg(pred_prob) mean, stddev_samp(pred_prob) std
      from (select unnest(range(0, t - {least} + 1, {step})) st from tn where t >= {least}) s join rk on rk.rank >= s.st and rk.rank < s.st + {size} group by 1)"""


_COLS = "start, n, round(error_rate, 6) as error_rate, round(high, 9) as high, round(low, 9) as low, round(mean, 6) as mean, round(std, 6) as std"


def _rounded(df):
    return df.withColumns({"error_rate": F.round("error_rate", 6), "high": F.round("high", 9), "low": F.round("low", 9), "mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(f"with {_RANKED}, {_windows(2000, 1000, 1000, 'w')} select {_COLS} from w")
def cal_row_windows(spark, sf):
    return _rounded(cal.row_windows(b.predictions(spark, sf), 2000, 1000, 1000))


_MULTI = f"""{_RANKED}, {_windows(10000, 2500, 3300, 'w0')}, {_windows(2000, 1000, 1000, 'w1')}, {_windows(1000, 500, 500, 'w2')},
  m0 as (select *, 0 as scale from w0 where std < 0.02),
  m1 as (select *, 1 as scale from w1 where std < 0.02 and ((select min(mean) from m0) is null or mean < (select min(mean) from m0))), m01 as (select * from m0 union all select * from m1),
  m2 as (select *, 2 as scale from w2 where (select min(mean) from m01) is null or mean < (select min(mean) from m01)), ml as (select * from m01 union all select * from m2)"""


def _errors(spark, sf):
    return cal.multiscale_errors(b.predictions(spark, sf))


def _kept(spark, sf):
    """The few windows, computed once."""
    ensure_checkpoints(spark)
    return _errors(spark, sf).checkpoint()


@query(f"with {_MULTI} select cast(scale as bigint) as scale, {_COLS} from ml")
def cal_multiscale(spark, sf):
    return _rounded(_errors(spark, sf))


@query(f"""with {_MULTI}, l3 as (select mean, error_rate from ml order by mean limit 3), ln as (select regr_slope(error_rate, mean) b, regr_intercept(error_rate, mean) a, arg_min(error_rate, mean) worst from l3),
  q as (select a, b, unnest(range(0, greatest(cast(floor(-10 * log10(worst)) as int), 0) + 1)) phred from ln)
  select phred, round(case when phred = 0 then 0 else least(greatest((pow(10.0, -phred / 10.0) - a) / b, 0), 1) end, 6) as pred_score from q""")
def cal_extrapolate(spark, sf):
    return cal.extrapolated_table(_kept(spark, sf)).withColumn("pred_score", F.round("pred_score", 6))


_LOW = """l3 as (select mean, error_rate from ml order by mean limit 3), ln as (select regr_slope(error_rate, mean) b, regr_intercept(error_rate, mean) a, arg_min(error_rate, mean) worst from l3),
  q as (select a, b, unnest(range(0, greatest(cast(floor(-10 * log10(worst)) as int), 0) + 1)) phred from ln),
  low as (select phred, case when phred = 0 then 0 else least(greatest((pow(10.0, -phred / 10.0) - a) / b, 0), 1) end as pred_score from q)"""

# The definition, over all pairs of windows: the query itself adds up moments of blocks.
_CURVE = """kk as (select greatest(cast(ceil(count(*) * 0.3) as int), 2) k from ml),
  dd as (select m.mean as m, p.mean as x, p.error_rate as y, abs(p.mean - m.mean) d, row_number() over (partition by m.mean order by abs(p.mean - m.mean)) rn from (select distinct mean from ml) m cross join ml p),
  hh as (select m, greatest(coalesce(max(case when rn = k then d end), 0), 1e-12) * (1 + 1e-9) h from dd cross join kk group by 1),
  ww as (select m, x - m as x, y, pow(1 - pow(d / h, 3), 3) w from dd join hh using (m) where d < h),
  ss as (select m as mean, sum(w) sw, sum(w * x) sx, sum(w * y) sy, sum(w * x * x) sxx, sum(w * x * y) sxy from ww group by 1),
  cv as (select mean, case when sw * sxx - sx * sx > 1e-18 then (sxx * sy - sx * sxy) / (sw * sxx - sx * sx) else sy / sw end as smooth from ss),
  st as (select * from (select *, lag(mean) over (order by mean desc) x1, min(smooth) over (order by mean desc rows between unbounded preceding and 1 preceding) y1 from cv) where x1 is not null and smooth > y1),
  wt as (select phred, pow(10.0, -phred / 10.0) err from (select unnest(range((select max(phred) + 1 from low), 1 + (select cast(case when e > 0 then floor(-10 * log10(e)) else 40 end as int) from (select arg_max(error_rate, mean) e from ml)))) phred)),
  pp as (select phred, max(x1 + (mean - x1) * (err - y1) / (smooth - y1)) s from wt left join st on err <= smooth and err >= y1 group by 1),
  hg as (select phred, max(coalesce(s, (select max(mean) from cv))) over (order by phred) as pred_score from pp)"""


@query(f"with {_MULTI}, {_LOW}, {_CURVE} select phred, round(pred_score, 6) as pred_score from hg")
def cal_interpolate(spark, sf):
    e = _kept(spark, sf)
    return cal.interpolated_table(e, cal.extrapolated_table(e)).withColumn("pred_score", F.round("pred_score", 6))


@query(f"with {_MULTI}, {_LOW}, {_CURVE} select phred, round(max(pred_score) over (order by phred), 6) as pred_score from (select * from low union all select * from hg)")
def cal_table(spark, sf):
    return cal.calibration_table(_kept(spark, sf)).withColumn("pred_score", F.round("pred_score", 6))
