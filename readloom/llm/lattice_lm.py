"""Language-model scores from a lattice over an existing subword vocabulary.

A word's lattice has an edge for every vocabulary piece that matches a stretch
of it; the forward recursion in log space adds up all segmentations, so a word
gets its marginal probability rather than that of one best split.  Any
character can also be spelled by its UTF-8 bytes, one edge probability for each
byte, so all words together never get more than one.  Edges are weighted by the
vocabulary's scores.  The vocabulary is a BPE model, whose scores are merge
ranks and no log probabilities, so a piece starts at 1 / (rank + 10) and
``STEPS`` steps of expectation maximisation over all distinct training words,
of any length, turn the scores into unigram probabilities (one distributed pass
for each step; only one number for each piece comes back).

The lattice weighs every word.  Whole training words are further edges of it: a
word seen ``c`` times in ``N`` training tokens gets

    (c - D) / N + D * V / N * lattice(word),

absolute discounting with the lattice as the lower order; so each distinct word
hands the lattice the same mass D and counts once in the expectations.  D is
estimated from the words seen once and twice.  The end of a document is a token
that is always known.

Words move in packs.  A block of documents is reduced to its distinct words,
dealt to groups by a hash; a group adds up its words' counts over all blocks,
scores each distinct word once, and sends a block one pack of answers.  So a
word moves once for each block instead of once for each occurrence, no table is
sent to all executors, and a frequent word weighs no more than its blocks.

Results: null and empty texts are one end token.  Rows that repeat, and equal
ids on several texts, are scored each; a null id is a training document.  An
empty table gives an empty one.  Texts and words of any length are scored
whole.  Further columns are not read.
"""

from __future__ import annotations

import itertools
import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.bytesops import distinct_spans, lower_ascii, slices, text_bytes, word_spans
from readloom.llm.shared import stored

#: Bytes of text in a block and behind a group of words; steps of re-estimation; longest word in vectorised groups.
BLOCK_BYTES, GROUP_BYTES, STEPS, WIDE = 8 << 20, 16 << 20, 4, 32
#: Groups of words at least.
LEAST_GROUPS = 24
#: Word probability under which plain products lose digits.
TINY = 1e-200
_LATTICES: dict[str, Lattice] = {}


class Lattice:
    """Vocabulary pieces and forward/backward sums over words."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        found: dict[str, float] = {}
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            piece = sp.id_to_piece(i)
            piece = "".join(c.lower() if "A" <= c <= "Z" else c for c in piece)
            found[piece] = max(found.get(piece, -1e9), sp.get_score(i))
        self.pieces = [p for p in found if p.count("▁") == p.startswith("▁") and p != "▁"]
        self.index = {p: i for i, p in enumerate(self.pieces)}
        self.longest = max(map(len, self.pieces))
        rank = np.argsort(np.argsort([-found[p] for p in self.pieces]))
        self.n = len(self.pieces)
        # numbering: pieces, then word start alone, 256 bytes, word end
        self.start, self.byte, self.stop = self.n, self.n + 1, self.n + 257
        #: fills rows of byte numbers up; costs nothing
        self.none = self.n + 258
        first = np.array([p.startswith("▁") for p in self.pieces] + [True] + [False] * 257)
        weight = np.concatenate((1.0 / (rank + 10.0), [0.05], np.full(256, 1e-5), [0.5]))
        self.first = first
        self.initial = self.normal(weight)
        rng = np.random.default_rng(11)
        self._code = np.full(0x110000, 0x5851F42D4C957F2D, np.uint64)
        chars = sorted({c for p in self.pieces for c in p})
        self._code[[ord(c) for c in chars]] = rng.integers(1, 1 << 63, len(chars), dtype=np.uint64) | np.uint64(1)
        keys = np.array([self._hash(p) for p in self.pieces], np.uint64)
        by = np.argsort(keys)
        self._keys, self._ids = keys[by], by
        self._some = np.zeros(1 << 20, bool)
        self._some[(keys >> np.uint64(44)).astype(np.int64)] = True

    _BASE = np.uint64(0x9E3779B97F4A7C15)

    def _hash(self, s: str) -> np.uint64:
        h = 0
        for c in s:
            h = (h * int(self._BASE) + int(self._code[ord(c)])) & 0xFFFFFFFFFFFFFFFF
        return np.uint64(h)

    def normal(self, weight: np.ndarray) -> np.ndarray:
        """Log probabilities: pieces that open a word add up to one, the others and the word end too."""
        weight = weight + 1e-7
        return np.log(np.where(self.first, weight / weight[self.first].sum(), weight / weight[~self.first].sum()))

    def _spelled(self, c: np.ndarray) -> np.ndarray:
        """Numbers of the UTF-8 bytes of characters: one each if all are ASCII, else rows of four, filled up with ``none``."""
        c = c.astype(np.int64)
        if (c < 128).all():
            return self.byte + c
        size = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        lead = np.where(size == 1, 0, (0xF00 >> size) & 0xFF) | c >> 6 * (size - 1)
        tail = [np.where(size > k, self.byte + (0x80 | c >> 6 * (k - 1) & 63), self.none) for k in (3, 2, 1)]
        return np.column_stack((self.byte + lead, *tail))

    def _edges(self, words: list[str], size: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """Edges of words of one length (with their start mark): from, to, rows, piece (or the bytes of a character)."""
        n = len(words)
        points = np.frombuffer("".join("▁" + w for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size + 1)
        code = self._code[points]
        prefix = np.zeros((size + 2, n), np.uint64)
        for i in range(size + 1):
            prefix[i + 1] = prefix[i] * self._BASE + code[:, i]
        power = np.full(self.longest + 1, self._BASE, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        all_rows = np.arange(n)
        edges = [(0, 1, all_rows, np.full(n, self.start))]
        for i in range(1, size + 2):
            for length in range(1, min(i, self.longest) + 1):
                key = prefix[i] - prefix[i - length] * power[length]
                rows = np.flatnonzero(self._some[(key >> np.uint64(44)).astype(np.int64)])
                at = np.searchsorted(self._keys, key[rows])
                at[at == len(self._keys)] = 0
                real = self._keys[at] == key[rows]
                if real.any():
                    edges.append((i - length, i, rows[real], self._ids[at[real]]))
            if i > 1:  # any character can be spelled in bytes
                edges.append((i - 1, i, all_rows, self._spelled(points[:, i - 1])))
        return edges

    def _run(self, words: list[str], size: int, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        edges, cost = self._edges(words, size), np.append(logp, 0.0)
        alpha = np.full((size + 2, len(words)), -np.inf)
        alpha[0] = 0
        for a, b, rows, ids in edges:
            alpha[b, rows] = np.logaddexp(alpha[b, rows], alpha[a, rows] + (cost[ids] if ids.ndim == 1 else cost[ids].sum(axis=1)))
        return alpha[size + 1] + logp[self.stop], alpha, edges

    def _groups(self, words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            step = max(1, 150_000 // (size + 1))
            for k in range(0, len(rows), step):
                yield size, rows[k : k + step]

    def log_prob(self, words: list[str], logp: np.ndarray) -> np.ndarray:
        """Natural log of the marginal probability of every word."""
        out, cost = np.zeros(len(words)), logp.tolist()
        for size, rows in self._groups(words):
            own = [words[i] for i in rows.tolist()]
            out[rows] = [self._long(w, cost) for w in own] if size > WIDE else self._run(own, size, logp)[0]
        return out

    def _into(self, s: str, i: int, cost: list[float]) -> list[tuple[int, tuple[int, ...], float]]:
        """Edges into position ``i`` of one marked word: from, pieces (or the bytes of a character), log probability."""
        edges = []
        for length in range(1, min(i, self.longest) + 1):
            t = self.index.get(s[i - length : i])
            if t is not None:
                edges.append((i - length, (t,), cost[t]))
        spelled = (self.start,) if i == 1 else tuple(self.byte + c for c in s[i - 1].encode("utf-8", "surrogatepass"))
        edges.append((i - 1, spelled, sum(cost[t] for t in spelled)))
        return edges

    def _forward(self, s: str, cost: list[float]) -> array:
        alpha = array("d", [0.0])
        for i in range(1, len(s) + 1):
            sums = [alpha[a] + w for a, _, w in self._into(s, i, cost)]
            top = max(sums)
            alpha.append(top + math.log(sum(math.exp(x - top) for x in sums)))
        return alpha

    def _long(self, word: str, logp: np.ndarray | list[float]) -> float:
        """The same recursion for one long word."""
        return float(self._forward("▁" + word, logp)[-1] + logp[self.stop])

    def _long_expected(self, word: str, cost: list[float], out: np.ndarray) -> None:
        """Add one word's expected uses, in log space, so for any length."""
        s = "▁" + word
        alpha = self._forward(s, cost)
        total = alpha[-1] + cost[self.stop]
        beta = array("d", [-math.inf]) * (len(s) + 1)
        beta[-1] = cost[self.stop]
        for i in range(len(s), 0, -1):
            for a, ids, w in self._into(s, i, cost):
                back = w + beta[i]
                top = max(beta[a], back)
                beta[a] = top + math.log(math.exp(beta[a] - top) + math.exp(back - top))
                use = math.exp(min(alpha[a] + back - total, 0.0))
                for t in ids:
                    out[t] += use
        out[self.stop] += 1

    def expected(self, words: list[str], logp: np.ndarray) -> np.ndarray:
        """Expected uses of every piece over all segmentations: plain products up to ``WIDE`` characters, log space for longer words and where products vanish."""
        out, prob, cost = np.zeros(len(logp) + 1), np.append(np.exp(logp), 1.0), logp.tolist()
        for size, rows in self._groups(words):
            if size > WIDE:
                for i in rows.tolist():
                    self._long_expected(words[i], cost, out)
                continue
            edges = self._edges([words[i] for i in rows.tolist()], size)
            alpha, beta = np.zeros((size + 2, len(rows))), np.zeros((size + 2, len(rows)))
            alpha[0], beta[size + 1] = 1, prob[self.stop]
            for a, b, r, ids in edges:
                alpha[b, r] += alpha[a, r] * (prob[ids] if ids.ndim == 1 else prob[ids].prod(axis=1))
            total = alpha[size + 1] * prob[self.stop]
            tiny = total < TINY
            for i in rows[tiny].tolist():
                self._long_expected(words[i], cost, out)
            share = np.where(tiny, 0.0, 1.0 / np.where(tiny, 1.0, total))
            for a, b, r, ids in reversed(edges):
                back = (prob[ids] if ids.ndim == 1 else prob[ids].prod(axis=1)) * beta[b, r]
                beta[a, r] += back
                uses = alpha[a, r] * back * share[r]
                out += np.bincount(ids.ravel(), uses if ids.ndim == 1 else np.repeat(uses, ids.shape[1]), len(out))
            out[self.stop] += len(rows) - tiny.sum()
        return out[:-1]


def lattice(path: str) -> Lattice:
    if path not in _LATTICES:
        _LATTICES[path] = Lattice(path)
    return _LATTICES[path]


def _in_training(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1


_BLOCK = "block long, part int, docs int, train int, ids binary, held binary, sizes binary, words binary, raw binary, lengths binary, counts binary, at binary"
_WORDS = "distinct long, known long, total long, once long, twice long, raw binary, lengths binary, counts binary, blocks binary, at binary, refs binary"
_ANSWERS = "block long, at binary, counts binary, lp binary"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def packed(x: np.ndarray) -> bytes:
    """Numbers from 0 on in planes of bytes: the lowest bytes of all, then the next, as many as the largest needs."""
    size = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = np.frombuffer(raw, np.uint8).reshape(-1, n)
        out[:, : len(planes)] = planes.T
    return out.reshape(-1).view("<i8")


def _take(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> bytes:
    """The bytes of several spans, one after the other."""
    return data[np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))].tobytes()


def _blocks(groups: int):
    """Documents as indexes into their block's distinct words (one row), and those words by group with their counts in training documents."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()] + [pa.binary()] * 8
    names = [c.split()[0] for c in _BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, "text", BLOCK_BYTES):
                data, offsets = text_bytes(batch.column(1))
                data = lower_ascii(data)
                start, end, row = word_spans(data, offsets)
                first, index, hashes = distinct_spans(data, start, end)
                often = np.argsort(-np.bincount(index, minlength=len(first)), kind="stable")  # frequent words get small numbers
                first, hashes = first[often], hashes[often]
                place = np.empty(len(often), np.int64)
                place[often] = np.arange(len(often))
                index = place[index]
                ids = batch.column(0)
                train = np.array([_in_training(i) for i in ids.to_pylist()], bool)
                counts = np.bincount(index[train[row]], minlength=len(first))
                known = np.asarray(ids.fill_null(0)).astype(np.int64).tobytes() + np.asarray(ids.is_valid()).tobytes()
                rows: list[tuple] = [(number, -1, len(train), int(train.sum()), known, train.tobytes(), packed(np.bincount(row, minlength=batch.num_rows)), packed(index), None, None, None, None)]
                group = ((hashes >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
                by = np.argsort(group, kind="stable")
                edges = np.searchsorted(group[by], np.arange(groups + 1))
                size = end[first] - start[first]
                for g in np.flatnonzero(np.diff(edges)).tolist():
                    own = by[edges[g] : edges[g + 1]]
                    rows.append((number, g, len(own), 0, None, None, None, None, _take(data, start[first[own]], size[own]), packed(size[own]), packed(counts[own]), packed(np.diff(own, prepend=0))))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                number += 1
            pa.default_memory_pool().release_unused()

    return run


def _merge_group(table: pa.Table) -> pa.Table:
    """One group's words over all blocks: distinct words with their counts, and where each block wants them."""
    sizes, counts, at, blocks, raw = [], [], [], [], []
    for block, n, data, lengths, c, own in zip(*(table[x].to_pylist() for x in ("block", "docs", "raw", "lengths", "counts", "at")), strict=True):
        raw.append(data)
        sizes.append(unpacked(lengths, n))
        counts.append(unpacked(c, n))
        at.append(np.cumsum(unpacked(own, n)))
        blocks.append(np.full(n, block))
    data, size = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(sizes)
    start = np.cumsum(size) - size
    first, refs, _ = distinct_spans(data, start, start + size)
    total = np.zeros(len(first), np.int64)
    np.add.at(total, refs, np.concatenate(counts))
    row = [len(first), int((total > 0).sum()), int(total.sum()), int((total == 1).sum()), int((total == 2).sum())]
    row += [_take(data, start[first], size[first]), packed(size[first]), packed(total), np.concatenate(blocks).tobytes(), packed(np.concatenate(at)), packed(refs)]
    return pa.table({c.split()[0]: pa.array([v], pa.int64() if c.endswith("long") else pa.binary()) for c, v in zip(_WORDS.split(", "), row, strict=True)})


def _group_words(row: dict) -> tuple[list[str], np.ndarray]:
    """Words of a group and their counts."""
    n = row["distinct"]
    size = unpacked(row["lengths"], n)
    ends = np.cumsum(size).tolist()
    words = [row["raw"][a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends[:-1]], ends, strict=True)] if n else []
    return words, unpacked(row["counts"], n)


def lm_scores(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held = plain.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = max(LEAST_GROUPS, -(-held // GROUP_BYTES))
    blocks = stored(plain.mapInArrow(_blocks(groups), _BLOCK), "lm-blocks", compression="zstd")
    merged = blocks.filter("part >= 0").select("part", "block", "docs", "raw", "lengths", "counts", "at").groupBy("part").applyInArrow(_merge_group, _WORDS)
    words = stored(merged, "lm-words", compression="zstd")
    ends = blocks.agg(F.coalesce(F.sum("train"), F.lit(0))).first()[0]
    known, total, once, twice = words.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("known", "total", "once", "twice"))).first()
    discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
    n, v = total + ends, known + (ends > 0)

    logp = lattice(model_path).initial
    for _ in range(STEPS if known else 0):
        now = logp

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            lat = lattice(model_path)
            out = np.zeros(len(now))
            for batch in batches:
                for row in batch.to_pylist():
                    own, c = _group_words(row)
                    out += lat.expected([own[i] for i in np.flatnonzero(c).tolist()], now)
            used = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(out[used])], ["piece", "e"])

        weight = np.zeros(len(now))
        for piece, e in words.select("distinct", "raw", "lengths", "counts").mapInArrow(expect, "piece int, e double").groupBy("piece").agg(F.sum("e")).collect():
            weight[piece] = e
        logp = lattice(model_path).normal(weight)
    final = logp

    def word_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattice(model_path)
        for batch in batches:
            for row in batch.to_pylist():
                own, c = _group_words(row)
                seen = np.maximum(c - discount, 0) / max(n, 1)
                novel = np.log(max(discount * v, 1) / max(n, 1)) + lat.log_prob(own, final)
                lp = np.logaddexp(np.log(seen, out=np.full(len(seen), -np.inf), where=seen > 0), novel) / np.log(10)
                block = np.frombuffer(row["blocks"], np.int64)
                at, refs = unpacked(row["at"], len(block)), unpacked(row["refs"], len(block))
                for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]):
                    r = refs[a:b]
                    yield pa.RecordBatch.from_arrays([pa.array([int(block[a])]), *(pa.array([x], pa.binary()) for x in (packed(at[a:b]), packed(c[r]), lp[r].tobytes()))], ["block", "at", "counts", "lp"])

    answers = words.select("distinct", "raw", "lengths", "counts", "blocks", "at", "refs").mapInArrow(word_scores, _ANSWERS)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        lps = [np.frombuffer(x) for x in right["lp"].to_pylist()]
        at = [unpacked(x, len(y)) for x, y in zip(right["at"].to_pylist(), lps, strict=True)]
        top = max((int(x.max()) + 1 for x in at), default=0)
        c, lp = np.zeros(top, np.int64), np.zeros(top)
        for x, y, z in zip(at, lps, right["counts"].to_pylist(), strict=True):
            c[x], lp[x] = unpacked(z, len(y)), y
        base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        end_base, end = np.log10((ends + 0.5) / (n + 0.5 * (v + 1))), np.log10(max(ends, 0.5) / max(n, 1))
        out = []
        for docs, raw, train, sizes, index in zip(*(left[x].to_pylist() for x in ("docs", "ids", "held", "sizes", "words")), strict=True):
            sizes = unpacked(sizes, docs)
            index = unpacked(index, int(sizes.sum()))
            row = np.repeat(np.arange(docs), sizes)
            ids, real = np.frombuffer(raw[: 8 * docs], np.int64), np.frombuffer(raw[8 * docs :], bool)
            sums = [np.bincount(row, x[index], docs) if len(index) else np.zeros(docs) for x in (base, lp, (c > 0).astype(float))]
            values = [pa.array(ids, mask=~real), ~np.frombuffer(train, bool), sizes + 1, sums[2].astype(np.int64) + int(ends > 0), np.full(docs, n, np.int64), sums[0] + end_base, sums[1] + end]
            out.append(pa.table(dict(zip([x.split()[0] for x in _SCORES.split(", ")], map(pa.array, values), strict=True))))
        return pa.concat_tables(out)

    texts = blocks.filter("part < 0").select("block", "docs", "ids", "held", "sizes", "words")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, _SCORES)
