"""State decoding of pooled signals and work on the runs it gives."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StateModel:
    """States with start probabilities, Gaussian mixtures ``(mean, sd, weight)`` and sparse transitions."""

    names: tuple[str, ...]
    start: tuple[float, ...]
    emission: tuple[tuple[tuple[float, float, float], ...], ...]
    moves: tuple[tuple[tuple[int, float], ...], ...]

    def log_moves(self) -> np.ndarray:
        out = np.full((len(self.names),) * 2, -np.inf)
        for a, row in enumerate(self.moves):
            for b, p in row:
                out[a, b] = np.log(p)
        return out

    def log_emission(self, x: np.ndarray) -> np.ndarray:
        """Log density of every value under every state (last axis)."""
        parts = [np.logaddexp.reduce([np.log(w) - np.log(sd) - 0.5 * np.log(2 * np.pi) - 0.5 * ((x - m) / sd) ** 2 for m, sd, w in mix], axis=0) for mix in self.emission]
        return np.stack(parts, axis=-1)


_STATES = ("pre-leader", "leader-low", "leader-high", "adapter", "polya-tail", "transcript")
# Fixed values of the trained segment models: means, deviations, weights.
_EMISSION = (
    ((71.50333676145819, 3.661488091442809, 1.0),),
    ((102.06822592375592, 3.906628405239109, 1.0),),
    ((112.02391752604612, 4.798575215964485, 1.0),),
    ((80.49361662338703, 7.40645452440055, 0.8480750651871221), (65.30177304787502, 3.305209545883456, 0.15192493481287794)),
    ((108.95443922911944, 2.549021552095772, 1.0),),
    ((81.90432308474264, 7.760903146911895, 0.49045594516210067), (109.72965574809056, 12.733734156887294, 0.5095440548378992)),
)
#: Decodes a read from its beginning.
READ_MODEL = StateModel(
    _STATES,
    (0.99, 0.01, 0.0, 0.0, 0.0, 0.0),
    _EMISSION,
    (((0, 0.95), (1, 0.05)), ((1, 0.99), (2, 0.01)), ((2, 0.99), (3, 0.01)), ((3, 0.98), (4, 0.01), (5, 0.01)), ((4, 0.99), (5, 0.01)), ((5, 1.0),)),
)
#: Decodes a window anywhere in a read and may fall back to a leader.
WINDOW_MODEL = StateModel(
    _STATES,
    (0.01, 0.07, 0.01, 0.01, 0.8, 0.1),
    _EMISSION,
    (((0, 0.95), (1, 0.05)), ((1, 0.99), (2, 0.01)), ((2, 0.99), (3, 0.01)), ((3, 0.97), (1, 0.01), (4, 0.01), (5, 0.01)), ((4, 0.98), (1, 0.01), (5, 0.01)), ((5, 0.98), (1, 0.01), (2, 0.01))),
)


def viterbi_batch(model: StateModel, signals: list[np.ndarray]) -> list[np.ndarray]:
    """Most likely state paths of several signals, one time step for all at once; ties go to the lower state."""
    if not signals:
        return []
    sizes = np.array([len(s) for s in signals])
    n, t_max, k = len(signals), int(sizes.max()), len(model.names)
    if t_max == 0:
        return [np.zeros(0, np.int64) for _ in signals]
    x = np.zeros((n, t_max))
    for i, s in enumerate(signals):
        x[i, : len(s)] = s
    emit, moves = model.log_emission(x), model.log_moves()
    with np.errstate(divide="ignore"):
        score = np.log(np.array(model.start)) + emit[:, 0]
    back = np.zeros((t_max, n, k), np.int8)
    final = score.copy()
    for t in range(1, t_max):
        step = score[:, :, None] + moves
        back[t] = step.argmax(axis=1)
        score = step.max(axis=1) + emit[:, t]
        live = sizes > t
        final[live] = score[live]
    paths = np.zeros((n, t_max), np.int64)
    state = np.zeros(n, np.int64)
    for t in range(t_max - 1, -1, -1):
        state = np.where(sizes == t + 1, final.argmax(axis=1), state)
        paths[:, t] = state
        if t:
            live = sizes > t
            state = np.where(live, back[t][np.arange(n), state], state)
    return [paths[i, :s] for i, s in enumerate(sizes.tolist())]


def viterbi(signal: Column, model: StateModel = READ_MODEL, batch: int = 256) -> Column:
    """``array<int>`` of states for an array column, Arrow batch by Arrow batch."""

    @F.pandas_udf("array<int>")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out: list = []
            for at in range(0, len(part), batch):
                out += viterbi_batch(model, [np.asarray(s if s is not None else [], float) for s in part.iloc[at : at + batch]])
            yield pd.Series([p.tolist() for p in out])

    return decode(signal)


def state_runs(long: DataFrame, order: str = "k", state: str = "state") -> DataFrame:
    """Runs of equal neighbouring states: ``read_id, run, state, first, last`` (both inclusive, positions from 0)."""
    w = Window.partitionBy("read_id").orderBy(order)
    steps = long.select("read_id", F.col(state).alias("state"), (F.row_number().over(w) - 1).cast("long").alias("at"), F.lag(state).over(w).alias("before"))
    turn = F.sum(F.when(F.col("state").eqNullSafe(F.col("before")) & (F.col("at") > 0), 0).otherwise(1)).over(Window.partitionBy("read_id").orderBy("at"))
    return steps.withColumn("run", turn).groupBy("read_id", "run").agg(F.first("state").alias("state"), F.min("at").alias("first"), F.max("at").alias("last"))


def segment_map(long: DataFrame, limit: int | None = None, order: str = "k", state: str = "state") -> DataFrame:
    """The last run of every state per read; positions from ``limit`` on are not looked at."""
    runs = state_runs(long, order, state) if limit is None else state_runs(long.filter(F.col(order) <= limit), order, state)
    return runs.groupBy("read_id", "state").agg(F.max_by(F.struct("first", "last"), "run").alias("r")).select("read_id", "state", "r.first", "r.last")


def adapter_missing(reads: DataFrame, segments: DataFrame, adapter: str = "adapter") -> DataFrame:
    """Reads without an adapter segment, with status and label."""
    return reads.join(segments.filter(F.col("state") == adapter).select("read_id"), "read_id", "left_anti").withColumns({"status": F.lit("adapter_not_detected"), "label": F.lit("fail")})


def adapter_slice(signals: DataFrame, segments: DataFrame, stride: int, adapter: str = "adapter", signal: str = "signal") -> DataFrame:
    """Adapter part of the signal and its catalogue positions; empty ones are dropped."""
    own = segments.filter(F.col("state") == adapter).select("read_id", "first", "last")
    part = F.slice(signal, (F.col("first") + 1).cast("int"), (F.col("last") - F.col("first") + 1).cast("int"))
    out = signals.join(own, "read_id").select("read_id", part.alias("adapter"), (F.col("first") * stride).alias("start"), ((F.col("last") + 1) * stride).alias("end"))
    return out.filter(F.size("adapter") > 0)
