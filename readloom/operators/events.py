"""Event tables: derived columns, change-point statistics, boundaries, events, dumps.

Signals stay one array for each read.  Statistics, boundaries and events are
made from the arrays where they are, an Arrow batch of reads at a time, so raw
samples are never shuffled.  A null sample belongs to no event and silences the
statistic of the windows that hold it; a null signal is an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions import prefix_bucket
from readloom.params import PRESET

TINY = 1.1754943508222875e-38  # smallest normal single-precision number
_EVENTS = "array<struct<start:long,length:long,mean:double,stdv:double>>"


def derived_columns(events: DataFrame, scale: float, shift: float) -> DataFrame:
    """``pos`` (moves so far), ``end`` (start of the next event, or start + 1) and ``scaled_mean``."""
    w = Window.partitionBy("read_id").orderBy("k")
    return events.withColumns({"pos": F.sum("move").over(w), "end": F.coalesce(F.lead("start").over(w), F.col("start") + 1), "scaled_mean": scale * F.col("mean") + shift})


def _joined(arrays: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Elements of all arrays of a batch end to end, and the edges of the arrays among them."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(arrays), 0), np.int64)
    return arrays.flatten(), np.concatenate(([0], np.cumsum(sizes)))


def _samples(arrays: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Samples end to end with 0 for nulls, which ones are known, and the edges."""
    flat, edges = _joined(arrays)
    return np.array(pc.fill_null(flat, 0.0), float), np.array(flat.is_valid(), bool), edges


def tstats(x: np.ndarray, known: np.ndarray, edges: np.ndarray, width: int) -> np.ndarray:
    """Change statistic at every sample of arrays that lie end to end."""
    out, n = np.zeros(len(x)), len(x)
    if width < 2 or n < 2 * width:
        return out
    total, square = np.zeros(n - width + 1), np.zeros(n - width + 1)
    for j in range(width):
        part = x[j : n - width + 1 + j]
        total += part
        square += part * part
    row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    gaps = np.concatenate(([0], np.cumsum(~known)))
    first, last = np.arange(n - 2 * width + 1), np.arange(2 * width, n + 1)  # both windows together
    whole = (row[first] == row[last - 1]) & (gaps[first] == gaps[last])
    left, right = total[: len(first)] / width, total[width:] / width
    with np.errstate(invalid="ignore", over="ignore"):
        var = np.maximum((square[: len(first)] / width - left * left) + (square[width:] / width - right * right), TINY)
        out[width : n - width + 1] = np.where(whole, np.abs(right - left) / np.sqrt(var / width), 0.0)
    return out


def running_median(x: np.ndarray, edges: np.ndarray, width: int) -> np.ndarray:
    """Median of the ``width`` (odd) samples around each one of arrays that lie end to end; zeros beyond the ends of an array."""
    if width % 2 == 0:
        raise ValueError("the width of a running median is odd")
    half = width // 2
    row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    first, last = edges[:-1][row], edges[1:][row]
    out = np.zeros(len(x))
    for low in range(0, len(x), 1 << 18):  # bounded memory, however long the batch
        at = np.arange(low, min(len(x), low + (1 << 18)))
        near = at[:, None] + np.arange(-half, half + 1)
        inside = (near >= first[at, None]) & (near < last[at, None])
        out[at] = np.partition(np.where(inside, x[np.clip(near, 0, len(x) - 1)], 0.0), half, axis=1)[:, half]
    return out


def window_tstat(signals: DataFrame, width: int, name: str = "t", signal: str = "signal") -> DataFrame:
    """Array of the change statistic between the ``width`` samples before each sample and those from it on; 0 where a window is cut off."""

    @F.arrow_udf("array<double>")
    def run(arrays: pa.Array) -> pa.Array:
        x, known, edges = _samples(arrays)
        return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(tstats(x, known, edges, width)))

    return signals.withColumn(name, run(F.col(signal).cast("array<double>")))


class PeakTrackers:
    """Follow one statistic of many reads: each rises from its lowest value, crests, and fires once it fell back far enough."""

    def __init__(self, n: int, width: int, threshold: float, height: float):
        self.width, self.threshold, self.height = width, threshold, height
        self.crest, self.level, self.sure = np.full(n, -1), np.full(n, np.inf), np.zeros(n, bool)

    def reset(self, rows: np.ndarray, level: np.ndarray | float) -> None:
        self.crest[rows], self.level[rows], self.sure[rows] = -1, level, False

    def step(self, i: int, value: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Take in a value of each of the first reads that is live; whether its crest is above the threshold."""
        crest, level, sure = (a[: len(value)] for a in (self.crest, self.level, self.sure))
        calm = live & (crest < 0)
        lower = calm & (value < level)
        crests = calm & ~lower & (value - level > self.height) | live & ~calm & (value > level)
        np.copyto(level, value, where=lower | crests)
        crest[crests] = i
        high = live & ~calm & (level > self.threshold)
        sure |= high & (level - value > self.height)
        return high

    def fire(self, i: int, value: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        crest, sure = self.crest[: len(value)], self.sure[: len(value)]
        rows = np.flatnonzero(live & sure & (crest >= 0) & (i - crest > self.width // 2))
        at = crest[rows]
        self.reset(rows, value[rows])
        return rows, at


def peaks(short: np.ndarray, long: np.ndarray, edges: np.ndarray, windows: tuple[int, int], thresholds: tuple[float, float], height: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and position of boundaries, from a short and a long window's statistic of arrays end to end.

    All reads take a step together, the longest first so that those still going
    on lie at the front.  A high short crest silences the long one around it.
    """
    sizes = np.diff(edges)
    order = np.argsort(-sizes, kind="stable")
    starts, falling = edges[:-1][order], -sizes[order]
    fast, slow = (PeakTrackers(len(sizes), w, t, height) for w, t in zip(windows, thresholds, strict=True))
    blind, found = np.full(len(sizes), -1), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    with np.errstate(invalid="ignore"):
        for i in range(int(sizes.max(initial=0))):
            here = starts[: np.searchsorted(falling, -i)] + i
            a, b = short[here], long[here]
            everyone = np.ones(len(here), bool)
            high = np.flatnonzero(fast.step(i, a, everyone))
            blind[high] = fast.crest[high] + fast.width
            slow.reset(high, np.inf)
            found.append(fast.fire(i, a, everyone))
            live = i > blind[: len(here)]
            slow.step(i, b, live)
            found.append(slow.fire(i, b, live))
    rows, at = (np.concatenate(c) for c in zip(*found, strict=True))
    pairs = np.unique(np.stack((order[rows], at)), axis=1)
    return pairs[0], pairs[1]


def peak_boundaries(stats: DataFrame, windows: tuple[int, int] = (PRESET.window_short, PRESET.window_long), thresholds: tuple[float, float] = (PRESET.threshold_short, PRESET.threshold_long), height: float = PRESET.peak_height) -> DataFrame:
    """``read_id, boundary`` from the arrays ``t_short`` and ``t_long``, which are of one length."""

    @F.arrow_udf("array<long>")
    def run(short: pa.Array, long: pa.Array) -> pa.Array:
        (a, _, edges), (b, _, _) = _samples(short), _samples(long)
        rows, at = peaks(a, b, edges, windows, thresholds, height)
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(len(edges))), pa.int32()), pa.array(at, pa.int64()))

    return stats.select("read_id", F.explode(run("t_short", "t_long")).alias("boundary"))


def cut_arrays(x: np.ndarray, known: np.ndarray, edges: np.ndarray, rows: np.ndarray, at: np.ndarray) -> pa.Array:
    """Events of each array between its boundaries (row and position); none in arrays without a boundary inside."""
    inside = (at > 0) & (at < np.diff(edges)[rows])
    cut = np.unique(rows[inside])
    begin = np.unique(np.concatenate((edges[cut], edges[rows[inside]] + at[inside])))
    row = np.searchsorted(edges, begin, side="right") - 1
    end = np.minimum(np.append(begin[1:], len(x)), edges[row + 1])
    bounds = np.stack((begin, end), axis=1).reshape(-1)

    def total(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.append(values, values.dtype.type(0)), bounds)[::2] if len(begin) else np.zeros(0, values.dtype)

    n = total(known.astype(np.int64))
    some = np.maximum(n, 1)
    mean = total(np.where(known, x, 0.0)) / some
    size = end - begin
    places = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    away = np.zeros(len(x))
    away[places] = np.where(known[places], (x[places] - np.repeat(mean, size)) ** 2, 0.0)
    stdv = np.sqrt(total(away) / some)
    columns = [pa.array(begin - edges[row], pa.int64()), pa.array(n, pa.int64()), *(pa.array(v, pa.float64(), mask=n == 0) for v in (mean, stdv))]
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(edges))), pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "mean", "stdv"]))


def events_from_boundaries(signals: DataFrame, signal: str = "signal", boundaries: str = "boundaries") -> DataFrame:
    """Cut each read at its array of boundaries: ``read_id, start, length, mean, stdv``; reads without boundaries give no event."""

    @F.arrow_udf(_EVENTS)
    def run(arrays: pa.Array, marks: pa.Array) -> pa.Array:
        x, known, edges = _samples(arrays)
        at, ends = _joined(marks)
        rows = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        return cut_arrays(x, known, edges, rows, np.asarray(pc.fill_null(at, 0), np.int64))

    events = run(F.col(signal).cast("array<double>"), F.col(boundaries).cast("array<long>"))
    return signals.select("read_id", F.inline(events))


def detect_events(signals: DataFrame, windows: tuple[int, int] = (PRESET.window_short, PRESET.window_long), thresholds: tuple[float, float] = (PRESET.threshold_short, PRESET.threshold_long), height: float = PRESET.peak_height, signal: str = "signal", median: int | None = None) -> DataFrame:
    """The whole chain from signals to events: ``read_id, start, length, mean, stdv``.

    ``median`` is the width of a running median that smooths each signal first
    (null samples count as zeros there, and stay unknown themselves).
    """

    @F.arrow_udf(_EVENTS)
    def run(arrays: pa.Array) -> pa.Array:
        x, known, edges = _samples(arrays)
        if median:
            x = running_median(x, edges, median)
        short, long = (tstats(x, known, edges, w) for w in windows)
        return cut_arrays(x, known, edges, *peaks(short, long, edges, windows, thresholds, height))

    return signals.select("read_id", F.inline(run(F.col(signal).cast("array<double>"))))


def event_dump(events: DataFrame, attributes: DataFrame) -> DataFrame:
    """Event rows with their read's attributes and bucket; of repeated events one stays."""
    columns = ["read_id", "k", "mean", "start", "stdv", "length", "state", "move", "pos", "end"]
    return events.select(*columns).dropDuplicates(["read_id", "k"]).join(attributes, "read_id").withColumn("bucket", prefix_bucket(F.col("read_id")))
