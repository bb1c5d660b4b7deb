"""Fused reads: sliding windows, leader and adapter search, subread counts, flag."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.operators.segmentation import WINDOW_MODEL, StateModel, viterbi_batch
from readloom.params import PRESET


def sliding_windows(events: DataFrame, bounds: DataFrame, width: int, step: int) -> DataFrame:
    """Events of each window ``[left, left + width]`` (both ends included), up to the first empty window.

    ``bounds`` has ``read_id, begin, finish``.  Every event is exploded into
    the windows that cover it, so this is an equi-join, and a window is empty
    iff its number is missing.
    """
    e = events.join(bounds, "read_id").filter((F.col("start") >= F.col("begin")))
    at = F.col("start") - F.col("begin")
    high = F.least(F.floor(at / step), F.floor(F.greatest(F.col("finish") - F.col("begin") - 1, F.lit(0)) / step))
    low = F.greatest(F.ceil((at - width) / step), F.lit(0))
    rows = e.filter(low <= high).withColumn("window", F.explode(F.sequence(low, high)))
    rows = rows.withColumn("left", F.col("begin") + F.col("window") * step)
    present = rows.select("read_id", "window").distinct()
    order = Window.partitionBy("read_id").orderBy("window")
    good = present.filter("window >= 0").withColumn("_n", F.row_number().over(order) - 1).filter("_n = window").select("read_id", "window")
    return rows.join(good, ["read_id", "window"])


def leader_adapters(windows: DataFrame, sampling_rate: float, model: StateModel = WINDOW_MODEL) -> DataFrame:
    """Leader and adapter stretches inside windows: ``read_id, window, first, last`` in samples.

    ``windows`` has ``read_id, window, begin`` (payload start) and the arrays
    ``starts, ends, means`` of its events.  A stretch is a run of leader states
    with the adapter right behind it, or an adapter alone; both must last as
    long as the limits (whole samples) or longer.  Limits are lower near the
    payload start.
    """
    head = int(PRESET.chimera_head * sampling_rate)
    limits = {near: tuple(int(x * sampling_rate) for x in cut) for near, cut in ((True, PRESET.chimera_cut_head), (False, PRESET.chimera_cut))}
    leader = {model.names.index("leader-low"), model.names.index("leader-high")}
    adapter = model.names.index("adapter")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            paths = viterbi_batch(model, [np.asarray(m, float) for m in part["means"]])
            out = []
            for (rid, window, begin, starts, ends), path in zip(part[["read_id", "window", "begin", "starts", "ends"]].itertuples(index=False), paths, strict=True):
                turns = np.flatnonzero(np.diff(path)) + 1
                edges = [0, *turns.tolist(), len(path)]
                runs = [(int(path[a]), a, b - 1) for a, b in zip(edges, edges[1:], strict=False) if b > a]
                for j, (state, a, b) in enumerate(runs):
                    if state != adapter:
                        continue
                    i = j
                    while i and runs[i - 1][0] in leader:
                        i -= 1
                    first, last = int(starts[runs[i][1]]), int(ends[b])
                    cut_all, cut_adapter = limits[first - begin <= head]
                    if last - first >= cut_all and last - int(starts[a]) >= cut_adapter:
                        out.append((rid, window, first, last + 1))
            yield pd.DataFrame(out, columns=["read_id", "window", "first", "last"]).astype({"window": "int64", "first": "int64", "last": "int64"})

    return windows.select("read_id", "window", "begin", "starts", "ends", "means").mapInPandas(run, "read_id string, window long, first long, last long")


def subread_counts(events: DataFrame, bounds: DataFrame, adapters: DataFrame) -> DataFrame:
    """Confident positions in each gap between merged adapters: ``read_id, gap, positions``.

    Gap 0 reaches from the payload start to the first adapter.  Each event is
    dealt to its gap by a running count of adapter starts over events and
    adapters sorted together, so no range join is needed; an event on a
    boundary belongs to both gaps (both ends count).
    """
    w = Window.partitionBy("read_id").orderBy("first")
    cuts = adapters.withColumn("n", F.row_number().over(w))
    marks = cuts.select("read_id", F.col("first").alias("at"), F.lit(1).alias("opens"), F.lit(None).cast("long").alias("pos"), F.lit(None).cast("double").alias("p"), F.col("first").alias("a"), F.col("last").alias("z"))
    seen = events.join(bounds, "read_id").filter((F.col("start") >= F.col("begin")) & (F.col("start") <= F.col("finish")))
    rows = seen.select("read_id", F.col("start").alias("at"), F.lit(0).alias("opens"), "pos", F.col("p_model_state").alias("p"), F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("z"))
    order = Window.partitionBy("read_id").orderBy("at", F.desc("opens"))
    both = marks.unionByName(rows).withColumns({"gap": F.sum("opens").over(order), "open_at": F.last("a", True).over(order), "open_to": F.last("z", True).over(order)}).filter("opens = 0")
    behind = both.filter("gap = 0 or at >= open_to").select("read_id", "gap", "pos", "p")
    edge = both.filter("gap > 0 and at = open_at").select("read_id", (F.col("gap") - 1).alias("gap"), "pos", "p")
    top = behind.unionByName(edge).groupBy("read_id", "gap", "pos").agg(F.max("p").alias("p"))
    found = top.groupBy("read_id", "gap").agg(F.count_if(F.col("p") > PRESET.chimera_p).alias("positions"))
    gaps = bounds.select("read_id", F.lit(0).cast("long").alias("gap")).unionByName(cuts.select("read_id", F.col("n").cast("long").alias("gap")))
    return gaps.join(found, ["read_id", "gap"], "left").select("read_id", "gap", F.coalesce("positions", F.lit(0).cast("long")).alias("positions"))


def chimera_flag(counts: DataFrame) -> DataFrame:
    """``read_id, later, head, unsplit``: whether an adapter was found and the subreads behind it hold enough positions, in number or beside the first one."""
    found = F.max("gap") > 0
    sums = counts.groupBy("read_id").agg(found.alias("found"), F.sum(F.when(F.col("gap") > 0, F.col("positions")).otherwise(0)).alias("later"), F.sum(F.when(F.col("gap") == 0, F.col("positions")).otherwise(0)).alias("head"))
    flag = F.col("found") & ((F.col("later") > PRESET.chimera_count) | ((F.col("later") + 1) / (F.col("head") + 1) > PRESET.chimera_ratio))
    return sums.withColumn("unsplit", flag).drop("found")
