"""Exact top-k inner products: norm-sorted blocks, rotated partial sums, Cauchy-Schwarz bounds.

Vectors become integers (``floor(scale * x)``), so scores are exact.  They are
sorted by descending length and packed into blocks.  Queries are dealt into
parts that a task can hold, blocks are dealt over lanes; each pair of a part and
a lane is one task, which reads its queries once and then its blocks, one after
the other, longest vectors first.  A query's k-th score so far is its floor.  Then

* a block is skipped by the queries whose length times the block's largest
  length stays below their floor;
* inside a block a vector is skipped when, for all queries, the partial sum over
  the leading dimensions plus the product of the residual lengths stays below the
  floor.  Dimensions are rotated by the singular vectors of the whole table (from
  its d x d moment matrix), which puts most of every inner product into the
  first ones.  Where that leaves most vectors of a block, the next blocks go
  without it for a while.

All that survive get their exact integer score.  Bounds are strict and have slack
for rounding, so ties are never lost; ties go to the smaller ``vec_id``.  Every
sixteenth block (of those every sixteenth, and so on) is searched in a pass of its
own before; the floors found there hold for the next pass, so the number of
candidates of a query doesn't grow with the number of lanes.

Only counts and the d x d matrix reach the driver.  Copies of the queries grow
with the number of lanes (of ``MEETS`` blocks), copies of the vectors with the
number of parts (of ``QUERY_BYTES``); neither is ever broadcast.

Vectors that are null or hold null or non-finite components take no part.
Shorter vectors count as padded by zeros.  A query is not compared with rows of
its own ``vec_id``; a null ``vec_id`` takes no part.  Rows that repeat an id
are candidates each.  An empty table gives an empty one.  Further columns are not
read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.shared import stored

#: Rows in a block, queries whose scores are made at once (they stay in a core's cache), leading dimensions of the partial sums, blocks in a range of lengths.
BLOCK, STRIP, LEAD, RANGE = 1024, 256, 16, 64
#: Bytes of queries in a part; blocks in a lane, at least (else there are fewer lanes than cores want) and at most; of how many blocks the pass before takes one.
QUERY_BYTES, LEAST, MEETS, THIN = 16 << 20, 8, 256, 16

_ROWS = "vec_id long, size int, width int, norm double, v binary"
_PACKED = "part long, no long, width int, ids binary, rows binary"
_CELLS = "cell long, kind int, no long, width int, ids binary, rows binary"
_FOUND = "part long, query_id long, vec_id long, score long"
_INT = {2: np.int16, 4: np.int32, 8: np.int64}
_NONE, _LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _width(x: np.ndarray) -> int:
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    return next(w for w in (2, 4, 8) if -(2 ** (8 * w - 1)) <= low and high < 2 ** (8 * w - 1))


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, size, width, norm, v`` of the vectors that take part; ``v`` has ``size`` integers of ``width`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            ends = np.cumsum(sizes)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(float)  # a null is nan
            odd = ~np.isfinite(values)
            fine = np.ones(len(ids), bool)
            fine[np.searchsorted(ends, np.flatnonzero(odd), side="right")] = False
            with np.errstate(over="ignore"):
                values = np.floor(float(scale) * np.where(odd, 0.0, values))
            ints = np.clip(values, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
            ints[values >= 2.0**63] = _LAST
            for size in np.unique(sizes[fine]).tolist():
                own = np.flatnonzero(fine & (sizes == size))
                x = ints[(ends - sizes)[own][:, None] + np.arange(size)]
                width, n = _width(x), len(own)
                norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
                offsets = np.arange(n + 1, dtype=np.int32) * (size * width)
                v = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(x.astype(_INT[width]).tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(ids[own], pa.int64()), pa.array([size] * n, pa.int32()), pa.array([width] * n, pa.int32()), pa.array(norm), v], ["vec_id", "size", "width", "norm", "v"])

    v = F.col(vec_col) if vectors.schema[vec_col].dataType.simpleString() in ("array<float>", "array<double>") else F.col(vec_col).cast("array<double>")
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).mapInArrow(run, _ROWS)


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """Vectors of a batch with ``size, width, v`` as rows of integers, padded by zeros."""
    sizes, widths, v = batch.column("size").to_numpy(), batch.column("width").to_numpy(), batch.column("v")
    n = len(v)
    if n and (sizes == sizes[0]).all() and (widths == widths[0]).all():
        first = np.frombuffer(v.buffers()[1], np.int32, 1, 4 * v.offset)[0] if sizes[0] else 0
        rows = np.frombuffer(v.buffers()[2], _INT[int(widths[0])], n * int(sizes[0]), first).reshape(n, -1) if sizes[0] else np.zeros((n, 0), np.int16)
        return rows if sizes[0] == d else np.pad(rows, ((0, 0), (0, d - int(sizes[0]))))
    out = np.zeros((n, d), np.int64)
    for i in range(n):
        out[i, : sizes[i]] = np.frombuffer(v[i].as_py(), _INT[int(widths[i])])
    return out


def moment_matrix(ints: DataFrame, d: int) -> np.ndarray:
    """Sum of outer products over all vectors: sums of each task, added up row by row of the matrix."""
    step = max(1, (8 << 20) // (8 * d))

    def sums(rows: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        held = list(rows)
        for at in range(0, len(held), step):
            yield pa.RecordBatch.from_arrays([pa.array([j for j, _ in held[at : at + step]], pa.int64()), pa.array([m.tobytes() for _, m in held[at : at + step]], pa.binary())], ["j", "m"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch, d).astype(float)
            total += x.T @ x
        yield from sums(enumerate(total))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for j, m in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total[j] = total.get(j, 0.0) + np.frombuffer(m.as_buffer())
        yield from sums(iter(total.items()))

    out = np.zeros((d, d))
    for j, m in ints.select("size", "width", "v").mapInArrow(run, "j long, m binary").repartition(min(d, 16), "j").mapInArrow(add, "j long, m binary").collect():
        out[j] = np.frombuffer(m)
    return out


def _packer(d: int, size: int):
    """Rows of a partition, in their order, in blocks of ``size``; ``no`` counts them over all partitions, nearly without gaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        ids, rows = np.zeros(0, np.int64), np.zeros((0, d), np.int16)

        def block(at: int) -> pa.RecordBatch:
            x = rows[at : at + size]
            width = _width(x)
            cells = ((part, pa.int64()), (part * RANGE + no, pa.int64()), (width, pa.int32()), (ids[at : at + size].tobytes(), pa.binary()), (x.astype(_INT[width]).tobytes(), pa.binary()))
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in cells], ["part", "no", "width", "ids", "rows"])

        for batch in batches:
            ids, rows = np.concatenate([ids, batch.column("vec_id").to_numpy()]), np.concatenate([rows, _matrix(batch, d)])
            whole = len(ids) - len(ids) % size
            for at in range(0, whole, size):
                yield block(at)
                no += 1
            ids, rows = ids[whole:], rows[whole:]
        if len(ids):
            yield block(0)

    return run


class Rows:
    """Integer vectors of a block with what bounds and products need of them."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, turn: np.ndarray):
        self.ids, self.rows, self.turn = ids, rows, turn
        self.length = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
        self.top = float(self.length.max(initial=0.0))
        self._kinds: dict[type, np.ndarray] = {}
        self._lead: np.ndarray | None = None

    def kind(self, kind: type) -> np.ndarray:
        if kind not in self._kinds:
            self._kinds[kind] = np.ascontiguousarray(self.rows.astype(kind))
        return self._kinds[kind]

    def lead(self) -> np.ndarray:
        """Leading rotated dimensions, and behind them the length of the others."""
        if self._lead is None:
            turned = self.rows.astype(float) @ self.turn
            self._lead = np.hstack([turned[:, :LEAD], np.sqrt((turned[:, LEAD:] ** 2).sum(axis=1))[:, None]])
        return self._lead


def exact_kind(a: float, b: float) -> type:
    """Numbers in which inner products of integer vectors up to these lengths are exact.

    Every partial sum, in whatever order, is at most the product of the lengths.
    """
    most = max(a, 1.0) * max(b, 1.0) * (1 + 1e-6)
    return np.float32 if most < 2.0**24 else np.float64 if most < 2.0**53 else np.int64


class Searcher(Rows):
    """Running top-k of one block of queries over blocks of vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, turn: np.ndarray, k: int, room: dict[type, np.ndarray] | None = None):
        super().__init__(ids, rows, turn)
        self.k, n = k, len(ids)
        self.room = {} if room is None else room  # for scores, shared by the searchers of a task
        self.by_id = np.sort(ids)
        #: score and id of the k-th candidate so far; only what comes before it in order is a candidate
        self.floor, self.floor_id = np.full(n, _NONE), np.full(n, _LAST)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.fresh, self.wait, self.pause = 0, 0, 0

    def raise_floors(self, ids: np.ndarray, floors: np.ndarray, floor_ids: np.ndarray) -> None:
        """Floors found elsewhere, in candidates that are kept elsewhere; at most one for each id."""
        by = np.argsort(ids)
        at = np.minimum(np.searchsorted(ids[by], self.ids), len(ids) - 1)
        own = ids[by][at] == self.ids
        self.floor[own], self.floor_id[own] = floors[by][at][own], floor_ids[by][at][own]

    def feed(self, block: Rows) -> None:
        floor = np.where(self.floor == _NONE, -np.inf, self.floor.astype(float))
        bound = self.length * block.top
        open_ = bound + 1e-9 * (1 + bound) >= floor
        if not open_.any():
            return
        q = slice(None) if open_.mean() > 0.8 else np.flatnonzero(open_)
        v: slice | np.ndarray = slice(None)
        if self.pause:
            self.pause -= 1
        else:
            part = self.lead()[q] @ block.lead().T
            cols = np.flatnonzero((part >= (floor - 1e-9 * (1 + bound))[q][:, None]).any(axis=0))
            if not len(cols):
                return
            self.wait = 0 if len(cols) < 0.5 * len(block.ids) else min(2 * self.wait + 1, 63)
            self.pause = self.wait
            v = cols if not self.wait else v
        kind = exact_kind(self.top, block.top)
        mine, others = self.kind(kind)[q], block.kind(kind)[v].T
        own, ids = np.arange(len(self.ids))[q], block.ids[v]
        least = np.iinfo(np.int64).min + 1 if kind is np.int64 else np.finfo(kind).min
        below = _NONE if kind is np.int64 else -np.inf
        same = np.flatnonzero(self.by_id[np.minimum(np.searchsorted(self.by_id, ids), len(self.by_id) - 1)] == ids).tolist()
        limit = np.where(self.floor == _NONE, least, self.floor + (self.floor_id < ids.min())).astype(kind)[own]  # equal scores count only below the k-th's id
        size = min(STRIP, len(own)) * len(ids)
        if len(self.room.get(kind, ())) < size:
            self.room[kind] = np.empty(size, kind)
        for at in range(0, len(own), STRIP):
            r = own[at : at + STRIP]
            scores = np.matmul(mine[at : at + STRIP], others, out=self.room[kind][: len(r) * len(ids)].reshape(len(r), -1))
            for c in same:
                scores[self.ids[r] == ids[c], c] = below  # a query and rows of its id
            some = np.flatnonzero(scores.max(axis=1) >= limit[at : at + STRIP])
            if len(some):
                self.take(r[some], ids, scores[some], limit[at : at + STRIP][some])

    def take(self, own: np.ndarray, ids: np.ndarray, scores: np.ndarray, limit: np.ndarray) -> None:
        mask = scores >= limit[:, None]
        if len(ids) > self.k and np.count_nonzero(mask) > 8 * self.k * len(own):
            mask = scores >= np.maximum(limit, np.partition(scores, len(ids) - self.k, axis=1)[:, len(ids) - self.k])[:, None]
        r, c = np.divmod(np.flatnonzero(mask), len(ids))
        s, i, r = scores[r, c].astype(np.int64), ids[c], own[r]
        better = (s > self.floor[r]) | ((s == self.floor[r]) & (i < self.floor_id[r]))
        if better.any():
            self.held.append((r[better], i[better], s[better]))
            self.fresh += int(np.count_nonzero(better))
            if self.fresh >= self.k * len(self.ids):
                self.prune()

    def prune(self) -> None:
        """Only the k best of each query are held; the k-th becomes the floor."""
        r, i, s = (np.concatenate(x) for x in zip(*self.held, strict=True))
        by = np.lexsort((i, ~s, r))
        r, i, s = r[by], i[by], s[by]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        last = rank == self.k - 1
        self.floor[r[last]], self.floor_id[r[last]] = s[last], i[last]
        best = rank < self.k
        self.held, self.fresh = [(r[best], i[best], s[best])], 0

    def found(self, part: int) -> pa.RecordBatch:
        if self.held:
            self.prune()
        r, i, s = self.held[0] if self.held else (np.zeros(0, np.int64),) * 3
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(r), part), pa.int64()), pa.array(self.ids[r]), pa.array(i, pa.int64()), pa.array(s, pa.int64())], ["part", "query_id", "vec_id", "score"])


def _search(turn: np.ndarray, k: int, lanes: int):
    """Cells, each with its queries (kind 0), their floors (1) and blocks of vectors (2), in this order."""
    d = len(turn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, searchers, room = None, [], {}
        for batch in batches:
            for i in range(batch.num_rows):
                cell, kind, width = (batch.column(c)[i].as_py() for c in ("cell", "kind", "width"))
                ids, rows = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("ids", np.int64), ("rows", _INT[width])))
                if cell != now:
                    yield from (s.found(now // lanes) for s in searchers)
                    now, searchers = cell, []
                if kind == 0:
                    searchers.append(Searcher(ids.copy(), rows.reshape(-1, d).copy(), turn, k, room))  # they outlive the batch
                elif kind == 1:
                    for s in searchers:
                        s.raise_floors(ids, rows[: len(ids)], rows[len(ids) :])
                else:
                    block = Rows(ids, rows.reshape(-1, d), turn)
                    for s in searchers:
                        s.feed(block)
        yield from (s.found(now // lanes) for s in searchers)

    return run


def _floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts, *cols = (c.to_numpy() for c in batch.columns)
        for part in np.unique(parts).tolist():
            ids, s, v = (c[parts == part] for c in cols)
            cells = ((part, pa.int64()), (0, pa.int64()), (8, pa.int32()), (ids.tobytes(), pa.binary()), (s.tobytes() + v.tobytes(), pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in cells], ["part", "no", "width", "ids", "rows"])


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best candidates of every query row (all, if fewer).

    ``is_query`` is a condition on ``vec_id``.
    """
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    ints = stored(integer_vectors(vectors, scale, id_col, vec_col), "topk-vectors")
    n, d = ints.agg(F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).first()
    d = max(int(d), 1)
    values, axes = np.linalg.eigh(moment_matrix(ints, d))
    turn = np.ascontiguousarray(axes[:, np.argsort(-values)])
    size = max(16, min(BLOCK, (1 << 20) // d))
    ranges = max(1, math.ceil(n / (size * RANGE)), min(2 * cores, math.ceil(n / size)))
    # equal rows can be cut apart too
    ranged = ints.repartitionByRange(ranges, F.desc("norm"), F.col("vec_id"), F.rand(0)).sortWithinPartitions(F.desc("norm"), "vec_id")
    blocks = stored(ranged.mapInArrow(_packer(d, size), _PACKED), "topk-blocks")
    asked = ints.filter(is_query)
    parts = max(1, math.ceil(asked.count() * d * 4 / QUERY_BYTES))
    queries = stored(asked.repartition(parts).sortWithinPartitions(F.desc("norm"), "vec_id").mapInArrow(_packer(d, size), _PACKED), "topk-queries")

    total = blocks.count()
    passes = max(0, int(math.log(max(total, 1) / 32, THIN)))
    best = floors = None
    for nth in range(passes, -1, -1):
        here = F.col("no") % THIN**nth == 0
        if nth < passes:
            here &= F.col("no") % THIN ** (nth + 1) != 0
        met = max(1, math.ceil(total / THIN**nth))
        lanes = max(math.ceil(met / MEETS), min(math.ceil(met / LEAST), math.ceil(4 * cores / parts))) | 1  # odd, as numbers of blocks have gaps up to a power of two
        lane, part = F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long")), F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
        rest = ("no", "width", "ids", "rows")
        sides = [(0, queries, F.explode(lane), F.col("part")), (2, blocks.filter(here).withColumn("lane", F.col("no") % lanes), F.col("lane"), F.explode(part))]
        if floors is not None:
            sides.insert(1, (1, floors, F.explode(lane), F.col("part")))
        cells = None
        for kind, side, in_lane, in_part in sides:
            one = side.select(in_lane.alias("at"), in_part.alias("of"), *rest).select((F.col("of") * lanes + F.col("at")).alias("cell"), F.lit(kind).alias("kind"), *rest)
            cells = one if cells is None else cells.unionByName(one)
        found = cells.repartitionById(lanes * parts, F.col("cell").cast("int")).sortWithinPartitions("cell", "kind", "no").mapInArrow(_search(turn, k, lanes), _FOUND)
        best = found if best is None else best.unionByName(found)
        if nth:
            order = Window.partitionBy("part", "query_id").orderBy(F.desc("score"), "vec_id")
            ranked = stored(best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "topk-found")
            best = ranked.drop("rank")
            floors = ranked.filter(F.col("rank") == k).select("part", "query_id", "score", "vec_id").mapInArrow(_floors, _PACKED)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
