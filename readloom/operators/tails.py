"""Poly(A) windows that grow with their interval.

An interval that reaches the last event of its window may go on behind it, so
the window is widened and its events are detected again: boundaries near the
old end move, and a running median sees other neighbours.  All reads of an
Arrow batch take a step together where their signals are; no round goes through
the driver and no sample is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.operators import events as ev
from readloom.operators.polya import level_range
from readloom.params import PRESET

#: Samples of signals that are looked at together.
AT_ONCE = 1 << 22
_GROWN = "struct<upto:long,rounds:long,score:long,first:long,last:long,events:array<struct<start:long,length:long,mean:double,stdv:double>>>"


def best_runs(row: np.ndarray, length: np.ndarray, is_a: np.ndarray, reads: int, gap: int = PRESET.polya_gap, penalty: float = PRESET.polya_penalty) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``polya.best_interval`` for events of several reads that lie end to end: scores, and places of the first and last event.

    ``row`` is the read of each event.  Reads without an interval have score 0
    and places -1.
    """
    score, first, last = np.zeros(reads, np.int64), np.full(reads, -1), np.full(reads, -1)
    tail = np.flatnonzero(is_a)
    if not len(tail):
        return score, first, last
    value = np.where(is_a, length, np.trunc(-penalty * length).astype(np.int64))
    total, away = np.cumsum(value), np.cumsum(np.where(is_a, 0, length))
    island = np.cumsum((np.diff(row[tail], prepend=-1) != 0) | (np.diff(away[tail], prepend=0) > gap))
    before = total[tail] - value[tail]
    # every island lies below the one before, so one running minimum starts anew in each
    sunk = before - before.min() - island * (np.ptp(before) + 1)
    low = np.minimum.accumulate(sunk)
    at = np.maximum.accumulate(np.where(np.diff(low, prepend=low[0] + 1) < 0, np.arange(len(tail)), 0))
    gain = total[tail] - before[at]
    order = np.lexsort((np.arange(len(tail)), at, -gain, row[tail]))
    owner, lead = np.unique(row[tail][order], return_index=True)
    best = order[lead]
    good = gain[best] > 0
    owner, best = owner[good], best[good]
    score[owner], first[owner], last[owner] = gain[best], tail[at[best]], tail[best]
    return score, first, last


def extend_open(
    signals: DataFrame,
    step: int,
    rounds: int = PRESET.polya_rounds,
    low: Column | None = None,
    high: Column | None = None,
    median: int | None = None,
    windows: tuple[int, int] = (PRESET.window_short, PRESET.window_long),
    thresholds: tuple[float, float] = (PRESET.threshold_short, PRESET.threshold_long),
    height: float = PRESET.peak_height,
    signal: str = "signal",
) -> DataFrame:
    """Events and best interval in the window at which the search ends: ``read_id, upto, rounds, score, first, last, events``.

    ``signals`` has ``read_id, begin, upto`` (samples, ``upto`` exclusive) and
    the signal.  While the interval reaches the last event and the read goes on,
    ``upto`` grows by ``step`` and events are detected again, ``rounds`` times at
    most; then the interval counts as it is.  ``low`` and ``high`` are the
    poly(A) range, a read's own if given as columns.  ``first`` and ``last``
    number the events from 1, ``start`` counts from the start of the read.

    Bounds outside the read are clipped, a null ``begin`` is 0 and a null
    ``upto`` is ``begin``; a null or empty signal has no events, a null range no
    interval; without an interval ``score``, ``first`` and ``last`` are null.
    """
    if step < 1:
        raise ValueError("a window grows by one sample or more")

    def search(arrays: pa.Array, begin: np.ndarray, upto: np.ndarray, least: np.ndarray, most: np.ndarray) -> pa.Array:
        x, known, edges = ev._samples(arrays)
        sizes = np.diff(edges)
        begin = np.clip(begin, 0, sizes)
        upto = np.clip(upto, begin, sizes)
        todo, order, parts = np.arange(len(sizes)), [], []
        for done in range(rounds + 1):
            n = upto[todo] - begin[todo]
            cuts = np.concatenate(([0], np.cumsum(n)))
            places = np.repeat(edges[todo] + begin[todo] - cuts[:-1], n) + np.arange(cuts[-1])
            part, sure = x[places], known[places]
            if median and median > 1:
                part = ev.running_median(part, cuts, median)
            short, long = (ev.tstats(part, sure, cuts, w) for w in windows)
            lists = ev.cut_arrays(part, sure, cuts, *ev.peaks(short, long, cuts, windows, thresholds, height))
            flat, ends = ev._joined(lists)
            start, length, mean, stdv = flat.flatten()
            row = np.repeat(np.arange(len(todo)), np.diff(ends))
            level = np.asarray(pc.fill_null(mean, np.nan), float)
            inside = (level >= least[todo][row]) & (level <= most[todo][row])
            score, first, last = best_runs(row, np.asarray(length), inside, len(todo))
            more = (score > 0) & (last == ends[1:] - 1) & (upto[todo] < sizes[todo]) & (done < rounds)
            shut = np.flatnonzero(~more)
            whole = pa.StructArray.from_arrays([pa.array(np.asarray(start) + begin[todo][row], pa.int64()), length, mean, stdv], ["start", "length", "mean", "stdv"])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), whole)
            none = score[shut] == 0
            numbers = [pa.array(v, pa.int64(), mask=none) for v in (score[shut], (first - ends[:-1])[shut] + 1, (last - ends[:-1])[shut] + 1)]
            columns = [pa.array(upto[todo][shut], pa.int64()), pa.array(np.full(len(shut), done), pa.int64()), *numbers, lists.take(pa.array(shut))]
            parts.append(pa.StructArray.from_arrays(columns, ["upto", "rounds", "score", "first", "last", "events"]))
            order.append(todo[shut])
            todo = todo[more]
            if not len(todo):
                break
            upto[todo] = np.minimum(upto[todo] + step, sizes[todo])
        return pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(order))))

    @F.arrow_udf(_GROWN)
    def run(arrays: pa.Array, begin: pa.Array, upto: pa.Array, least: pa.Array, most: pa.Array) -> pa.Array:
        numbers = [np.array(v, t) for v, t in ((begin, np.int64), (upto, np.int64), (least, float), (most, float))]
        size = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(arrays), 0), np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(size // AT_ONCE)) + 1).tolist(), len(arrays)]
        return pa.concat_arrays([search(arrays.slice(a, z - a), *(v[a:z] for v in numbers)) for a, z in zip(cuts, cuts[1:], strict=False)])

    begin = F.coalesce(F.col("begin").cast("long"), F.lit(0).cast("long"))
    upto = F.coalesce(F.col("upto").cast("long"), begin)
    own = [F.coalesce((b if c is None else c).cast("double"), F.lit(float("nan"))) for b, c in zip(level_range(), (low, high), strict=True)]
    grown = signals.select("read_id", run(F.col(signal).cast("array<double>"), begin, upto, *own).alias("_g"))
    return grown.select("read_id", "_g.*")


def grown_events(found: DataFrame) -> DataFrame:
    """The event table of ``extend_open``'s final windows: ``read_id, k, start, length, mean, stdv``."""
    return found.select("read_id", F.posexplode("events").alias("k", "e")).select("read_id", (F.col("k") + 1).cast("long").alias("k"), "e.*")
