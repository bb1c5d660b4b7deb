"""Queries over scoring, demultiplexing, scaling checks and user models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from readloom import bindings as b
from readloom import functions as fn
from readloom.operators import demux, reads
from readloom.operators.assign import seed_assign
from readloom.plans.registry import query

_TABLE = [round(0.09 + 0.006 * i, 6) for i in range(40)]
_TABLE_SQL = "[" + ", ".join(map(str, _TABLE)) + "]"
_CONSTANTS = {"scale": (1.0, 0.05), "shift": (0.0, 2.0)}


def _rows(df, col):
    return df.select("read_id", F.posexplode(col).alias("i", "x")).select("read_id", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


_NORMAL = """t as (select read_id, i - 48 as i, x from v_long where i >= 48), m as (select read_id, median(x) m from t group by 1), d as (select read_id, median(abs(x - m)) d from t join m using (read_id) group by 1),
  p as (select read_id, i + 4 as i, (x - m) / greatest(0.01, 1.4826 * d) x from t join m using (read_id) join d using (read_id) union all select read_id, unnest(range(4)), -1000.0 from v_sig)"""


@query(f"with {_NORMAL} select read_id, i, round(x, 6) as x from p")
def dmx_prepare(spark, sf):
    out = demux.prepare_adapters(b.signals(spark, sf), 8, 1000, 16, -1000.0)
    return _rows(out.withColumn("signal", fn.pad_left(F.col("signal"), 20, -1000.0)), "signal")


def _predicted(spark, sf):
    s = b.signals(spark, sf)
    return demux.centroid_predict(s, demux.centroids(s.filter("cast(read_id as bigint) % 2 = 0")))


_PROBS = """c as (select label, i, avg(x) cx from v_long join v_sig using (read_id) where cast(read_id as bigint) % 2 = 0 group by 1, 2),
  ds as (select l.read_id, c.label, sqrt(avg((x - cx) * (x - cx))) dist from v_long l join c using (i) group by 1, 2),
  mn as (select read_id, min(dist) lo from ds group by 1), ex as (select ds.read_id, label, exp(lo - dist) e from ds join mn using (read_id)),
  pr as (select read_id, label, row_number() over (partition by read_id order by label) - 1 as idx, e / sum(e) over (partition by read_id) p from ex)"""


@query(f"with {_PROBS} select read_id, idx as i, round(p, 6) as x from pr")
def dmx_predict(spark, sf):
    return _rows(_predicted(spark, sf), "probs")


@query(f"""with {_PROBS}, r as (select read_id, arg_max(idx, struct_pack(p := p, i := -idx)) g, max(p) best from pr group by 1)
  select read_id, g - 1 as guess, case when g - 1 >= 0 and best >= {_TABLE[6]} then g - 1 end as barcode, round(best, 6) as best_score,
    case when g - 1 >= 0 and best >= {_TABLE[6]} then len(list_filter({_TABLE_SQL}, lambda t: t <= best)) else 0 end as barcode_score from r""")
def dmx_decide(spark, sf):
    out = demux.decide(_predicted(spark, sf), _TABLE, quality=6)
    return out.select("read_id", "guess", "barcode", F.round("best_score", 6).alias("best_score"), "barcode_score")


@query(f"select read_id, prior_label, pred_prob, case when pred_prob <= 0 then 0 else len(list_filter({_TABLE_SQL}, lambda t: t * 3 <= pred_prob)) end as phred from v_pred")
def dmx_phred_lookup(spark, sf):
    table = F.array(*(F.lit(t * 3) for t in _TABLE))
    return b.predictions(spark, sf).select("read_id", "prior_label", "pred_prob", demux.phred_lookup(F.col("pred_prob"), table).alias("phred"))


def _levels(x: np.ndarray) -> np.ndarray:
    """A stand-in scaler: how far a head's spread and mean lie from their usual values."""
    return np.column_stack((x.std(axis=1) - 11.0, x.mean(axis=1) - 90.0))


@query()
def scl_fit_predict(spark, sf):
    heads = b.signals(spark, sf).select("read_id", fn.head_pad(F.col("signal"), 64, 4, 16).alias("head"))
    out = demux.scaler_predict(heads, _levels, _CONSTANTS)
    return out.select("read_id", F.round("scale", 6).alias("scale"), F.round("shift", 6).alias("shift"))


@query("""select read_id, label, case when 1 + (label - 5) * 0.03 between 1.0 - 2.053748910631823 * 0.05 and 1.0 + 2.053748910631823 * 0.05
  and list_sum(signal) / len(signal) - 90 between -2.053748910631823 * 2.0 and 2.053748910631823 * 2.0 then 'okay' else 'scaling_qc_fail' end as status from v_sig""")
def scl_qc_range(spark, sf):
    p = b.signals(spark, sf).select("read_id", "label", (1 + (F.col("label") - 5) * 0.03).alias("scale"), F.expr("aggregate(signal, 0D, (s, x) -> s + x) / size(signal) - 90").alias("shift"))
    return demux.scaling_status(p, _CONSTANTS).select("read_id", "label", "status")


@query("""with k as (select distinct read_id, substr(seq, cast(i as int), 13) km from (select read_id, seq, unnest(range(1, length(seq) - 11)) i from v_seq)),
  r as (select distinct name, substr(seq, cast(i as int), 13) km from (select name, seq, unnest(range(1, length(seq) - 11)) i from v_refs)),
  s as (select read_id, name, count(*) n, row_number() over (partition by read_id order by count(*) desc, name) rn from k join r using (km) group by 1, 2)
  select v.read_id, coalesce(name, '*') as name, coalesce(n, 0) as shared from v_seq v left join s on s.read_id = v.read_id and rn = 1""")
def aln_seed_assign(spark, sf):
    return seed_assign(b.sequences(spark, sf), b.references(spark, sf))


@query()
def udf_batch_process(spark, sf):
    def one(row):
        if row["label"] == 3:
            raise ValueError("label 3 is not processed")
        return {"read_id": row["read_id"], "mean": round(float(np.mean(row["signal"])), 6)}

    return reads.capture_errors(b.signals(spark, sf), one, "read_id string, mean double")


@query()
def udf_model_plug(spark, sf):
    def steep(x: np.ndarray) -> np.ndarray:
        e = np.exp((x[:, :4] - x[:, :4].max(axis=1, keepdims=True)) / 5)
        return e / e.sum(axis=1, keepdims=True)

    return _rows(demux.predict(b.signals(spark, sf), steep), "probs")


@query("""select read_id, case when label = 3 then 'unknown_error' else 'okay' end as status,
  case when label = 3 then 'ValueError: label 3 is not processed' end as error from v_sig""")
def rd_error_capture(spark, sf):
    return udf_batch_process(spark, sf).select("read_id", "status", "error")
