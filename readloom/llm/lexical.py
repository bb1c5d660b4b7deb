"""Ranked lexical search: documents grouped by the mask of item terms that they hold.

Terms are maximal runs of ASCII letters (A-Z lower-cased), digits and non-ASCII
characters.  One pass turns every document into the items' terms it holds with
their counts; Spark sums the statistics of the whole corpus from that table.

The search takes the documents in blocks of like length.  In a block each term
has a bitmap of its documents and a greatest gain.  For an item, the block's
documents are split by the bitmaps, the term of greatest gain first, so that a
group is a set of documents of one presence mask.  Groups wait in a queue by the
greatest score that their mask still allows; the highest is split further, and
once its mask is whole (or one document is left, which has one mask) its
documents are scored exactly.  The search of a block
ends safely when the next group can't reach the item's k-th best score so far
(a group that can equal it is still looked at, for the sake of ties).  The k best
of a task go on to the next block, and those of all tasks to one ranking.

Items are taken in blocks of ``ITEMS``, each with its own pass, so what a task
holds is bounded by them, however many items there are.

Results: a null text has no terms, and a document without terms counts nowhere.
Equal scores are ordered by ``doc_id``, null as the largest.  Documents that
repeat are ranked each; items that repeat an id and text are answered once, and
items that share an id but not the text are one item, of all their terms; a null
item id is an id like others.  Items without terms, empty tables and items that
no document matches give no rows.  Texts of any length are taken whole.  Further
columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.bytesops import lower_ascii, same_spans, slices, span_hashes, text_bytes, word_spans
from readloom.llm.shared import stored

#: Items answered in one pass over the documents.
ITEMS = 1024
#: Documents in a block, and documents and pairs (document, term) that a task sorts by length at a time.
BLOCK, HELD, PAIRS = 8192, 65_536, 6_000_000
#: Documents of groups that can't be excluded are scored so many at a time.
TOGETHER = 32

_NOT_TERM = np.ones(256, bool)
_NOT_TERM[0x80:] = False
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _NOT_TERM[_low:_high] = False
_KIND = "doc_id long, n long, terms array<int>, counts array<int>"


def text_terms(text: str | None) -> list[bytes]:
    """Terms of one text, in order."""
    data, at = text_bytes(pa.array([text], pa.string()))
    data = lower_ascii(data)
    start, end, _ = word_spans(data, at, _NOT_TERM)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]


class Vocabulary:
    """The items' distinct terms, found in texts by hash; bytes decide."""

    def __init__(self, terms: list[bytes]):
        self.data = np.frombuffer(b"".join(terms), np.uint8)
        size = np.array([len(t) for t in terms], np.int64)
        end = np.cumsum(size)
        seed = 1
        while True:  # a seed under which no two terms meet
            hashes = span_hashes(self.data, end - size, end, seed)
            if len(np.unique(hashes)) == len(hashes):
                break
            seed += 1
        self.seed, self.order = seed, np.argsort(hashes)
        self.hashes, self.start, self.size = hashes[self.order], (end - size)[self.order], size[self.order]

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the spans that are terms of the vocabulary, and which terms they are."""
        h = span_hashes(data, start, end, self.seed)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        near = np.flatnonzero(self.hashes[at] == h)
        at = at[near]
        same = same_spans(data, start[near], (end - start)[near], self.data, self.start[at], self.size[at])
        return near[same], self.order[at[same]]


def matched_terms(docs: DataFrame, terms: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with a term: ``doc_id, n`` (its terms with repeats), and the given terms it holds with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(terms)
        for whole in batches:
            for batch in slices(whole, 1):
                data, at = text_bytes(batch.column(1))
                data = lower_ascii(data)
                start, end, row = word_spans(data, at, _NOT_TERM)
                n = np.bincount(row, minlength=batch.num_rows)
                place, term = words.find(data, start, end)
                pair, count = np.unique(row[place] * len(terms) + term, return_counts=True)
                edges = pa.array(np.searchsorted(pair // len(terms), np.arange(batch.num_rows + 1)), pa.int32())
                lists = (pa.ListArray.from_arrays(edges, pa.array(v, pa.int32())) for v in (pair % len(terms), count))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"]).filter(pa.array(n > 0))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _KIND)


class MaskBlock:
    """Documents of like length: bitmaps and gains of their terms, and the search by presence masks."""

    def __init__(self, ids: np.ndarray, row: np.ndarray, term: np.ndarray, gain: np.ndarray, terms: int):
        self.ids, self.row, self.term, self.gain = ids, row, term, gain
        self.edges = np.searchsorted(row, np.arange(len(ids) + 1))
        by = np.argsort(term, kind="stable")
        self.by_term, self.term_edges = row[by], np.searchsorted(term[by], np.arange(terms + 1))
        self.most = np.zeros(terms, np.int64)
        np.maximum.at(self.most, term, gain)
        self.bits: dict[int, int] = {}
        self.wanted = np.zeros(terms, bool)

    def bitmap(self, term: int) -> int:
        """The documents that hold a term, one bit each."""
        found = self.bits.get(term)
        if found is None:
            flags = np.zeros(len(self.ids), np.uint8)
            flags[self.by_term[self.term_edges[term] : self.term_edges[term + 1]]] = 1
            found = self.bits[term] = int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")
        return found

    def scores(self, group: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a bitmap and their exact scores for the wanted terms."""
        rows = np.flatnonzero(np.unpackbits(np.frombuffer(group.to_bytes((len(self.ids) + 7) // 8, "little"), np.uint8), bitorder="little"))
        first, size = self.edges[rows], self.edges[rows + 1] - self.edges[rows]
        ends = np.cumsum(size)
        at = np.repeat(first - ends + size, size) + np.arange(int(ends[-1]))
        return rows, np.add.reduceat(np.where(self.wanted[self.term[at]], self.gain[at], 0), ends - size)  # every document here holds a term

    def _taken(self, group: int, floor: int, best: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
        """``best`` with the documents of a bitmap that reach the floor."""
        rows, scores = self.scores(group)
        fine = scores >= floor
        ids, scores = self.ids[rows[fine]], scores[fine]
        if len(ids) > k:
            pick = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[pick], scores[pick]
        return sorted(best + list(zip((-scores).tolist(), ids.tolist(), strict=True)))[:k]

    def search(self, terms: np.ndarray, best: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
        """The ``k`` best ``(-score, id)`` of the block and of those found before."""
        most = self.most[terms]
        order = np.argsort(-most, kind="stable")
        order = order[most[order] > 0].tolist()
        if not order:
            return best
        own = [int(terms[i]) for i in order]
        rest = np.append(np.cumsum(most[order][::-1])[::-1], 0).tolist()
        self.wanted[terms] = True
        floor = -best[-1][0] if len(best) == k else 1
        queue = [(-rest[0], 0, 0, (1 << len(self.ids)) - 1)]  # greatest score left, terms decided, gains so far, documents
        ready, waiting = 0, 0  # documents to be scored, together
        while True:
            if waiting >= TOGETHER or ready and (not queue or -queue[0][0] < floor):
                best = self._taken(ready, floor, best, k)
                floor = -best[-1][0] if len(best) == k else 1
                ready, waiting = 0, 0
            if not queue or -queue[0][0] < floor:
                break
            _, depth, got, group = heapq.heappop(queue)
            depth = -depth
            while depth < len(own):
                held = group & self.bitmap(own[depth])
                gain = rest[depth] - rest[depth + 1]
                depth += 1
                if held == group:
                    got += gain
                    continue
                without = got + rest[depth]
                if held:
                    if without >= floor:
                        heapq.heappush(queue, (-without, -depth, got, group ^ held))
                    group, got = held, got + gain
                    if held & (held - 1) == 0:  # one document has one mask
                        break
                elif without < floor or queue and without < -queue[0][0]:
                    if without >= floor:
                        heapq.heappush(queue, (-without, -depth, got, group))
                    group = 0
                    break
            if group and got:
                n = group.bit_count()
                if ready and n > TOGETHER:  # those that wait may exclude it
                    heapq.heappush(queue, (-(got + rest[depth]), -depth, got, group))
                    waiting = TOGETHER
                else:
                    ready, waiting = ready | group, waiting + n
        self.wanted[terms] = False
        return best


_LAST = (1 << 63) - 1  # a null id


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents (id, null id or not, terms in all) and their pairs (terms, counts), as many at a time as a task sorts by length."""

    def joined(held: list) -> tuple:
        return tuple(np.concatenate(c) for c in zip(*held, strict=True))

    held, docs, pairs = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            size = np.asarray(part.column(2).value_lengths()).astype(np.int64)
            held.append((np.asarray(part.column(0).fill_null(_LAST)), np.asarray(part.column(1)), size, np.asarray(part.column(2).flatten()), np.asarray(part.column(3).flatten())))
            docs, pairs = docs + part.num_rows, pairs + int(size.sum())
            if docs >= HELD or pairs >= PAIRS:
                yield joined(held)
                held, docs, pairs = [], 0, 0
    if held:
        yield joined(held)


def _search(items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    """The k best documents of every item among those of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        for ids, n, size, term, count in _blocks(batches):
            damp = 10 + 90 * n * n_docs // n_terms
            by = np.lexsort((ids, damp))
            first = np.cumsum(size) - size
            for at in range(0, len(by), BLOCK):
                own = by[at : at + BLOCK]
                m = size[own]
                row = np.repeat(np.arange(len(own)), m)
                pick = np.repeat(first[own] - np.cumsum(m) + m, m) + np.arange(int(m.sum()))
                t, tf = term[pick], count[pick].astype(np.int64)
                gain = weights[t] * (1_000_000_000 * tf // (1000 * tf + 8 * damp[own][row]))
                block = MaskBlock(ids[own], row, t, gain, len(weights))
                best = [block.search(terms, found, k) for terms, found in zip(items, best, strict=True)]
        rows = [(i, d, -s) for i, found in enumerate(best) for s, d in found]
        cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
        ids = np.array(cols[1], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(ids, mask=ids == _LAST), pa.array(cols[2], pa.int64())], ["item", "doc_id", "score"])

    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of every item."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    span = F.when(F.col("item_id").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("item_id"), F.lit(max(1, -(-2 * asked.count() // ITEMS)))))
    asked = stored(asked.withColumn("block", span), "lexical-items")  # half full on average, so that a block is hardly ever above ITEMS
    found = None
    for block in [r[0] for r in asked.select("block").distinct().orderBy("block").collect()]:
        own: dict[int | None, set[bytes]] = {}
        for r in asked.filter(F.col("block") == block).collect():
            own.setdefault(r["item_id"], set()).update(text_terms(r["text"]))
        names = [i for i, t in own.items() if t]
        terms = sorted(set().union(*own.values()))
        if not terms:
            continue
        table = stored(matched_terms(docs, terms, id_col, text_col), "lexical-terms")
        n_docs, n_terms = table.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = np.zeros(len(terms), np.int64)
        for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row for each term of the block's items
            df[r["t"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        index = {t: i for i, t in enumerate(terms)}
        lists = [np.array(sorted(index[t] for t in own[i]), np.int64) for i in names]
        best = table.filter(F.size("terms") > 0).mapInArrow(_search(lists, weights, n_docs, n_terms, k), "item long, doc_id long, score long")
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).filter(F.col("rank") <= k)
        ids = F.array(*(F.lit(i).cast("long") for i in names))
        part = best.select(F.element_at(ids, (F.col("item") + 1).cast("int")).alias("item_id"), "rank", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found
