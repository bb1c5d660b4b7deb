"""Poly(A) tails from event tables: search windows, best intervals, recalibration, checks, dwell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.params import PRESET
from readloom.sources.shared import ensure_checkpoints


def inspect_window(segments: DataFrame, lengths: DataFrame, stride: int = PRESET.stride) -> DataFrame:
    """Sample range to search: the poly(A) run, or what follows the adapter; widened, and clipped to the read.

    ``segments`` has ``read_id, state, first, last``; ``lengths`` has ``read_id, samples``.
    """
    strides = PRESET.polya_widen // stride
    one = segments.groupBy("read_id").agg(F.max(F.when(F.col("state") == "adapter", F.col("last"))).alias("adapter"), F.max(F.when(F.col("state") == "polya-tail", F.struct("first", "last"))).alias("tail"))
    first = F.coalesce(F.col("tail.first"), F.col("adapter") + 1)
    last = F.greatest(F.coalesce(F.col("tail.last"), first), first + strides)
    out = one.filter(F.col("tail").isNotNull() | F.col("adapter").isNotNull()).join(lengths, "read_id")
    begin = F.greatest(F.lit(0), first * stride - PRESET.polya_flank)
    end = F.least(F.col("samples"), (last + 1) * stride + PRESET.polya_flank)
    return out.select("read_id", begin.cast("long").alias("begin"), end.cast("long").alias("end"), F.col("tail").isNotNull().alias("has_tail"))


def level_range(center: Column | float = PRESET.polya_level) -> tuple[Column, Column]:
    center = center if isinstance(center, Column) else F.lit(center)
    half = PRESET.polya_band * PRESET.polya_sd
    return center - half, center + half


def classify(events: DataFrame, low: Column | None = None, high: Column | None = None) -> DataFrame:
    """``is_a``: whether an event's mean lies in the poly(A) range (both ends included)."""
    lo, hi = level_range()
    return events.withColumn("is_a", F.col("mean").between(lo if low is None else low, hi if high is None else high))


def best_interval(events: DataFrame, gap: int = PRESET.polya_gap, penalty: float = PRESET.polya_penalty) -> DataFrame:
    """Best-scoring interval of events per read: ``read_id, score, first, last``.

    A poly(A) event scores its length, another ``-penalty`` times its length
    (truncated), and a run of others longer than ``gap`` ends an interval.  The
    best interval starts and ends on poly(A) events, so within an island between
    such runs it is a difference of two prefix sums: the smallest before, the
    largest after.  Ties: earliest start, then earliest end.
    """
    w = Window.partitionBy("read_id").orderBy("k")
    value = F.when(F.col("is_a"), F.col("length")).otherwise((F.col("length") * -penalty).cast("long"))
    run = F.sum(F.when(F.col("is_a"), 1).otherwise(0)).over(w)
    other = events.withColumns({"_v": value, "_run": run})
    within = F.sum(F.when(F.col("is_a"), 0).otherwise(F.col("length"))).over(Window.partitionBy("read_id", "_run"))
    sums = other.withColumns({"_sum": F.sum("_v").over(w), "_away": within})
    tail = sums.filter("is_a").withColumn("_cut", F.when(F.coalesce(F.lag("_away").over(w), F.lit(0)) > gap, 1).otherwise(0))
    island = tail.withColumn("_island", F.sum("_cut").over(w))
    low = F.min(F.struct((F.col("_sum") - F.col("_v")).alias("s"), F.col("k").alias("k"))).over(Window.partitionBy("read_id", "_island").orderBy("k"))
    ranked = island.withColumn("_low", low).select("read_id", F.struct((F.col("_sum") - F.col("_low.s")).alias("score"), (-F.col("_low.k")).alias("a"), (-F.col("k")).alias("b")).alias("r"))
    best = ranked.groupBy("read_id").agg(F.max("r").alias("r")).filter("r.score > 0")
    return best.select("read_id", F.col("r.score").alias("score"), (-F.col("r.a")).alias("first"), (-F.col("r.b")).alias("last"))


def recalibrated_range(events: DataFrame, adapter_end: DataFrame) -> DataFrame:
    """``read_id, low, high`` around the length-weighted mean of the quiet events just behind the adapter."""
    near = events.join(adapter_end, "read_id").filter((F.col("start") + F.col("length") > F.col("adapter_end")) & (F.col("start") <= F.col("adapter_end") + PRESET.polya_anchor_reach) & (F.col("stdv") < PRESET.polya_stdev))
    sums = near.groupBy("read_id").agg((F.sum(F.col("mean") * F.col("length")) / F.sum("length")).alias("center"))
    low, high = level_range(F.col("center"))
    return sums.select("read_id", low.alias("low"), high.alias("high"))


def second_pass(events: DataFrame, adapter_end: DataFrame) -> DataFrame:
    """Best intervals in each read's own range, for reads with enough samples of events in that range."""
    again = classify(events.drop("is_a").join(recalibrated_range(events, adapter_end), "read_id"), F.col("low"), F.col("high"))
    within = F.sum(F.when(F.col("is_a"), F.col("length")).otherwise(0)).over(Window.partitionBy("read_id"))
    return best_interval(again.withColumn("_within", within).filter(F.col("_within") >= PRESET.polya_anchor_samples))


def recalibrate(events: DataFrame, intervals: DataFrame, adapter_end: DataFrame, has_tail: DataFrame) -> DataFrame:
    """Second pass with a shifted range, for reads without a poly(A) run, without an interval or with an interval off level.

    ``has_tail`` lists the reads with a poly(A) run.  Returns ``read_id, score, first, last, recalibrated``.
    """
    inside = events.join(intervals, "read_id").filter(F.col("k").between(F.col("first"), F.col("last")))
    level = inside.groupBy("read_id").agg((F.sum(F.col("mean") * F.col("length")) / F.sum("length")).alias("level"))
    fine = level.filter(F.abs(F.col("level") - PRESET.polya_level) <= PRESET.polya_shift * PRESET.polya_sd).join(has_tail.select("read_id"), "read_id", "left_semi").select("read_id")
    second = second_pass(events.join(fine, "read_id", "left_anti"), adapter_end)
    first = intervals.join(fine, "read_id", "left_semi")
    return first.withColumn("recalibrated", F.lit(False)).unionByName(second.withColumn("recalibrated", F.lit(True)))


def stdev_check(events: DataFrame, intervals: DataFrame, samples: DataFrame, x: Column | None = None) -> DataFrame:
    """Deviation of the middle of each interval's longest event: ``read_id, stdev, steady``.

    ``samples`` has a row for each sample (``read_id, i, x``) or, with ``x``,
    one for each piece of a signal (``read_id, start, length``), disjoint within
    a read; ``x`` is the array of a piece's samples.  Pieces meet the middles
    first and are cut down to them, so ``x`` is evaluated for what is measured
    alone and no sample is shuffled.  The join is a merge: sizes estimated for
    rows of samples are too small to broadcast by.
    """
    inside = events.join(intervals, "read_id").filter(F.col("k").between(F.col("first"), F.col("last")))
    longest = inside.groupBy("read_id").agg(F.max_by(F.struct("start", "length"), F.struct("length", -F.col("k"))).alias("e"))
    middle = longest.select("read_id", (F.col("e.start") + F.floor(F.col("e.length") * 0.05)).alias("_low"), (F.col("e.start") + F.floor(F.col("e.length") * 0.95)).alias("_high"))
    near = samples.join(middle.hint("merge"), "read_id")
    if x is None:
        part = near.filter((F.col("i") >= F.col("_low")) & (F.col("i") < F.col("_high")))
    else:
        begin, end = F.greatest("_low", "start"), F.least(F.col("_high"), F.col("start") + F.col("length"))
        own = F.slice(x, (begin - F.col("start") + 1).cast("int"), (end - begin).cast("int"))
        part = near.filter(begin < end).select("read_id", F.explode(own).alias("x"))
    found = part.groupBy("read_id").agg(F.stddev_pop("x").alias("stdev"), F.count("x").alias("n"))
    return middle.select("read_id").join(found, "read_id", "left").select("read_id", F.when(F.col("n") > 2, F.col("stdev")).alias("stdev"), F.coalesce((F.col("n") > 2) & (F.col("stdev") < PRESET.polya_stdev), F.lit(False)).alias("steady"))


def steady_intervals(events: DataFrame, found: DataFrame, samples: DataFrame, adapter_end: DataFrame, x: Column | None = None) -> DataFrame:
    """Intervals of ``recalibrate`` that pass the deviation check; ``samples`` and ``x`` as for ``stdev_check``.

    A read that fails it in the first pass gets one second pass in a shifted
    range, whose interval has to pass as well.  What is used several times is
    checkpointed, so that the searches run once.
    """
    ensure_checkpoints(events.sparkSession)
    found = found.checkpoint()
    steady = stdev_check(events, found, samples, x).filter("steady").select("read_id").checkpoint()
    failed = found.filter("not recalibrated").join(steady, "read_id", "left_anti").select("read_id")
    second = second_pass(events.join(failed, "read_id", "left_semi"), adapter_end).withColumn("recalibrated", F.lit(True)).checkpoint()
    fine = stdev_check(events, second, samples, x).filter("steady").select("read_id")
    return found.join(steady, "read_id", "left_semi").unionByName(second.join(fine, "read_id", "left_semi"))


def dwell_and_spikes(events: DataFrame, intervals: DataFrame, sampling_rate: float) -> DataFrame:
    """``read_id, begin, end, dwell, spikes``: tail in samples, poly(A) time in seconds, and the other events inside with their neighbours."""
    w = Window.partitionBy("read_id").orderBy("k")
    near = events.withColumns({"_before": F.lag("mean").over(w), "_after": F.lead("mean").over(w)})
    inside = near.join(intervals, "read_id").filter(F.col("k").between(F.col("first"), F.col("last")))
    spike = F.when(~F.col("is_a"), F.struct("k", "length", F.col("_before").alias("before"), "mean", F.col("_after").alias("after")))
    return inside.groupBy("read_id").agg(
        F.min("start").alias("begin"),
        F.max(F.col("start") + F.col("length")).alias("end"),
        (F.sum(F.when(F.col("is_a"), F.col("length")).otherwise(0)) / sampling_rate).alias("dwell"),
        F.array_sort(F.collect_list(spike)).alias("spikes"),
    )
