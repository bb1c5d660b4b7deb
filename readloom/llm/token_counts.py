"""Exact token counts by prefix dynamic programming over a BPE piece model.

For byte-pair merges ordered by piece score, two pieces ``s t`` may stand side
by side iff merging the string ``st`` gives just ``s, t``; a sequence whose
neighbours all may stand side by side is the encoding.  So the last piece of a
prefix ending at ``i`` is the one piece ``t`` that ends there and may follow the
last piece of the prefix before it, and

    count[i] = count[i - len(t)] + 1

gives the exact number of tokens of *every* prefix in one pass.  Truncation
("how much of this text fits into k tokens?") and budgets ("how many tokens are
in the first n characters?") are read off the array without encoding again.

No piece reaches over the start of a run of spaces or a character outside the
vocabulary (checked when the model is loaded), so texts are cut there and the
arrays of equal stretches are computed once per worker and added up.

Results: null and empty texts have no tokens.  Rows that repeat, or share an id
(null too), are counted each.  An empty table gives an empty one.  Texts of any
length are counted whole; very long stretches one character after the other.
Only the id and text columns are read, whatever others are named.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from readloom.llm.bytesops import slices

MARK = "▁"
#: Stretches whose counts a worker remembers before it starts afresh.
MEMO = 700_000
PAIR_MEMO = 600_000
#: Longest stretch that is handled in vectorised groups.
WIDE = 40
_MODELS: dict[str, PieceModel] = {}


class PieceModel:
    """Pieces and scores of a SentencePiece BPE model; prefix counts of any text."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.pieces = {sp.id_to_piece(i): i for i in normal}
        self.names = {i: p for p, i in self.pieces.items()}
        self.rank = {p: -sp.get_score(i) for p, i in self.pieces.items()}
        self.chars = {c for p in self.pieces for c in p}
        if any(c not in self.pieces for c in self.chars) or any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("the model has pieces that reach over word starts or unknown characters")
        self.longest = max(map(len, self.pieces))
        self._memo: dict[str, int] = {}
        self._pairs: dict[int, bool] = {}
        self._seen, self._seen_ok = np.full(1, -1, np.int64), np.zeros(1, bool)
        # hashes of all pieces, for looking up many substrings at once
        self._code = np.full(0x110000, 0x5851F42D4C957F2D, np.uint64)  # of characters in no piece
        rng = np.random.default_rng(7)
        order = sorted(self.chars)
        self._code[[ord(c) for c in order]] = rng.integers(1, 1 << 63, len(order), dtype=np.uint64) | np.uint64(1)
        keys = np.array([self._hash(p) for p in self.pieces], np.uint64)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("piece hashes collide")
        by = np.argsort(keys)
        self._some = np.zeros(1 << 20, bool)  # whether any piece has these leading hash bits
        self._some[(keys >> np.uint64(44)).astype(np.int64)] = True
        self._keys, self._ids = keys[by], np.fromiter(self.pieces.values(), np.int64)[by]

    _BASE = np.uint64(0x9E3779B97F4A7C15)

    def _hash(self, s: str) -> np.uint64:
        h = 0
        for c in s:
            h = (h * int(self._BASE) + int(self._code[ord(c)])) & 0xFFFFFFFFFFFFFFFF
        return np.uint64(h)

    def merge(self, s: str) -> list[str]:
        """Plain merging, best score first and leftmost on ties: the definition, for pairs of pieces."""
        out = list(s)
        while len(out) > 1:
            best = min(((self.rank[a + b], i) for i, (a, b) in enumerate(zip(out, out[1:], strict=False)) if a + b in self.rank), default=None)
            if best is None:
                break
            i = best[1]
            out[i : i + 2] = [out[i] + out[i + 1]]
        return out

    def may_follow(self, s: int, t: int) -> bool:
        """Whether piece t may stand right after piece s (-1: nothing stands before)."""
        key = (s + 1) << 20 | t
        found = self._pairs.get(key)
        if found is None:
            if len(self._pairs) > PAIR_MEMO:
                self._pairs.clear()
            b = self.names[t]
            found = self._pairs[key] = self.merge(b) == [b] if s < 0 else self.merge(self.names[s] + b) == [self.names[s], b]
        return found

    def _may_follow_all(self, pairs: np.ndarray) -> np.ndarray:
        """may_follow for an array of pairs; answers given before are looked up at once."""
        at = np.searchsorted(self._seen, pairs)
        at[at == len(self._seen)] = 0
        new = self._seen[at] != pairs
        ok = self._seen_ok[at]
        if new.any():
            own, back = np.unique(pairs[new], return_inverse=True)
            ok[new] = np.fromiter((self.may_follow((k >> 20) - 1, k & 0xFFFFF) for k in own.tolist()), bool, len(own))[back]
        return ok

    def _sort_pairs(self) -> None:
        if len(self._pairs) > len(self._seen) * 1.02 or len(self._pairs) < len(self._seen) // 2:
            keys = np.fromiter(self._pairs.keys(), np.int64, len(self._pairs))
            by = np.argsort(keys)
            self._seen, self._seen_ok = keys[by], np.fromiter(self._pairs.values(), bool, len(keys))[by]

    def stretch_prefixes(self, s: str) -> list[int]:
        """count[i] for every prefix of one stretch (count[0] is 0)."""
        count, last = [0] * (len(s) + 1), [-1] * (len(s) + 1)
        for i in range(1, len(s) + 1):
            if s[i - 1] not in self.chars:
                count[i], last[i] = count[i - 1] + len(s[i - 1].encode("utf-8", "surrogatepass")), -1
                continue
            for size in range(1, min(i, self.longest) + 1):
                t = self.pieces.get(s[i - size : i])
                if t is not None and self.may_follow(last[i - size], t):
                    count[i], last[i] = count[i - size] + 1, t
                    break
            else:
                raise ValueError(f"no piece ends at {i} of {s!r}")
        return count

    def _same_length(self, words: list[str], size: int) -> np.ndarray:
        """stretch_prefixes for many stretches of one length, a column at a time."""
        n = len(words)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, size)
        code = self._code[points]
        known = code != self._code[-1]
        utf8 = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        prefix = np.zeros((size + 1, n), np.uint64)
        for i in range(size):
            prefix[i + 1] = prefix[i] * self._BASE + code[:, i]
        power = np.full(self.longest + 1, self._BASE, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        count, last = np.zeros((size + 1, n), np.int32), np.full((size + 1, n), -1, np.int64)
        for i in range(1, size + 1):
            rest = np.flatnonzero(known[:, i - 1])
            odd = np.flatnonzero(~known[:, i - 1])
            count[i, odd] = count[i - 1, odd] + utf8[odd, i - 1]
            for length in range(min(i, self.longest), 0, -1):
                if not len(rest):
                    break
                key = prefix[i, rest] - prefix[i - length, rest] * power[length]
                hit = np.flatnonzero(self._some[(key >> np.uint64(44)).astype(np.int64)])
                at = np.searchsorted(self._keys, key[hit])
                at[at == len(self._keys)] = 0
                real = self._keys[at] == key[hit]
                hit, at = hit[real], at[real]
                if not len(hit):
                    continue
                rows, t = rest[hit], self._ids[at]
                ok = self._may_follow_all((last[i - length, rows] + 1) << 20 | t)
                rows, t = rows[ok], t[ok]
                count[i, rows], last[i, rows] = count[i - length, rows] + 1, t
                rest = np.delete(rest, hit[ok])
            if len(rest):
                raise ValueError(f"no piece ends at {i} of {words[rest[0]]!r}")
        return count

    def learn(self, stretches: set[str]) -> None:
        """Remember the counts of stretches not seen before."""
        if len(self._memo) + len(stretches) > MEMO:
            self._memo.clear()
        by: dict[int, list[str]] = {}
        for s in stretches:
            by.setdefault(len(s), []).append(s)
        for size, words in by.items():
            self._sort_pairs()
            if size > WIDE or len(words) < 8:
                self._memo.update((w, self.stretch_prefixes(w)[-1]) for w in words)
            else:
                self._memo.update(zip(words, self._same_length(words, size)[-1].tolist(), strict=True))

    def stretches(self, text: str) -> list[str]:
        """The text, marked as the model marks it, cut where no piece can reach over."""
        return _STRETCH.findall((MARK + text).replace(" ", MARK)) if text else []

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of every text."""
        cut = [_fast(t) or self.stretches(t) for t in texts]
        need: set[str] = set().union(*cut)
        memo = self._memo
        new = need - memo.keys()
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = need
        self.learn(new)
        return [sum(map(memo.__getitem__, words)) for words in cut]

    def prefix_counts(self, text: str) -> np.ndarray:
        """count[i]: tokens of the first i characters, for every i from 0 to len(text)."""
        out, total = [np.zeros(1, np.int64)], 0
        for k, s in enumerate(self.stretches(text)):
            own = self.stretch_prefixes(s)
            out.append(total + np.array(own[1 + (k == 0) :], np.int64))
            total += own[-1]
        return np.concatenate(out)

    def fits(self, text: str, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens."""
        total, chars = 0, -1
        for s in self.stretches(text):
            whole = self._memo.get(s) if s in self._memo else self.stretch_prefixes(s)[-1]
            if total + whole > budget:
                own = self.stretch_prefixes(s)
                inside = max(i for i, n in enumerate(own) if total + n <= budget)
                return max(0, chars + inside)
            total, chars = total + whole, chars + len(s)
        return max(0, chars)


# A stretch is a line break with what follows up to a space, or a run of spaces with what follows.
_STRETCH = re.compile(f"\n[^{MARK}\n]*|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


def _fast(text: str) -> list[str] | None:
    """The same cut for texts of singly spaced words, by C string splitting; None for others."""
    if not text or "  " in text or " \n" in text or text[0] in " \n" or text[-1] == " " or MARK in text:
        return None
    words = text.replace("\n", " \n").split(" ")
    return [w if w[0] == "\n" else MARK + w for w in words]


def model(path: str) -> PieceModel:
    """The model of a file, loaded once per worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def count_tokens(docs: DataFrame, model_path: str, budget: int = 4096, id_col: str = "doc_id", text_col: str = "text", with_prefix_counts: bool = False) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_tokens, over_limit, limit_chars`` (characters that fit into ``budget``).

    ``with_prefix_counts`` adds ``prefix_tokens``, the count at every prefix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for batch in (part for whole in batches for part in slices(whole, "text", 4 << 20)):
            ids, texts = batch.column(0).cast(pa.int64()), [t or "" for t in batch.column(1).to_pylist()]
            counts: list[int] = []
            for at in range(0, len(texts), 1000):
                counts += m.count_all(texts[at : at + 1000])
            cols = [
                ids,
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array([n > budget for n in counts], pa.bool_()),
                pa.array([len(t) if n <= budget else m.fits(t, budget) for t, n in zip(texts, counts, strict=True)], pa.int64()),
            ]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "limit_chars"]
            if with_prefix_counts:
                cols.append(pa.array([m.prefix_counts(t) for t in texts], pa.list_(pa.int64())))
                names.append("prefix_tokens")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, limit_chars long" + ", prefix_tokens array<long>" * with_prefix_counts
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, schema)
