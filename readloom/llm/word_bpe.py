"""Byte-pair encoding with word ends, through a minimal acyclic transducer of frequent words.

``Lexicon`` is the transducer: the frequent words of the whole corpus are
compiled, in sorted order, into the smallest acyclic automaton that accepts
them (equal suffixes are shared).  Every edge carries the number of words that
sort before it, so walking a word adds up its own number, and the number leads
to its token ids: outputs don't hinder the sharing.  The automaton is a few
flat arrays in one file that Spark hands to every executor and that workers
map into memory.  Words outside it are merged exactly, many at a time.

The encoder reproduces the ``tokenizers`` library for a BPE file with NFC,
white-space and lower-case normalisers, a word pattern, byte-level symbols and
``</w>`` word ends; special strings inside texts become their ids, as is that
library's default.

Results: null and empty texts have no ids and decode to an empty text.  Rows
that repeat, or share an id (null too), are encoded each.  An empty table gives
an empty one.  Texts and words of any length are encoded whole; words above
``WIDE`` bytes are merged one by one.  Further columns are not read, whatever
their names; ``encode_columns`` keeps them.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.llm.bytesops import distinct_spans, same_spans, slices
from readloom.llm.shared import new_path, stored

#: Words of the lexicon; it only saves time, results don't depend on it.
LEXICON_WORDS = 60_000
#: Stretches that a worker remembers before it starts afresh (about 80 bytes each); bytes of texts encoded at once.
MEMO, AT_ONCE = 600_000, 1 << 20
#: Different stretches that a worker counts before it passes the counts on.
COUNTED = 200_000
WIDE = 48
_ENCODERS: dict[tuple, WordEncoder] = {}


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of the stretches ``starts[i] .. starts[i] + sizes[i]``, one after the other."""
    ahead = np.cumsum(sizes) - sizes
    return np.repeat(starts - ahead, sizes) + np.arange(int(sizes.sum()))


class Lexicon:
    """Minimal acyclic automaton over byte strings, with a row of token ids for each word."""

    FIELDS = ("first", "label", "target", "before", "final", "starts", "ids")

    def __init__(self, path: str):
        head = np.fromfile(path, np.int64, 1 + len(self.FIELDS))
        at = 8 * (1 + len(self.FIELDS))
        for name, n in zip(self.FIELDS, head[1:].tolist(), strict=True):
            setattr(self, name, np.memmap(path, np.int32, "r", at, (n,)) if n else np.zeros(0, np.int32))
            at += 4 * n
        # one key per edge: node and label; edges are sorted by it
        self._key = np.repeat(np.arange(len(self.first) - 1, dtype=np.int64), np.diff(self.first)) << 8 | self.label

    @staticmethod
    def build(words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> bytes:
        """The file of sorted, distinct words: each state is registered by its edges once it can't change any more."""
        nodes: list[tuple[int, tuple]] = []
        register: dict[tuple, int] = {}

        def freeze(open_node: list) -> int:
            final, edges = open_node
            key = (final, tuple(edges))
            found = register.get(key)
            if found is None:
                found = register[key] = len(nodes)
                nodes.append(key)
            return found

        spine: list[list] = [[0, []]]  # open states along the last word; each but the last lacks its edge to the next
        last = b""
        for word in [*words, b""]:
            shared = len(os.path.commonprefix([last, word]))
            while len(spine) > shared + 1:
                target = freeze(spine.pop())
                spine[-1][1].append((last[len(spine) - 1], target))
            spine += [[0, []] for _ in word[shared:]]
            if word:
                spine[-1][0] = 1
            last = word
        root = freeze(spine[0])
        words_below = np.zeros(len(nodes), np.int64)
        first, label, target, before = [0], [], [], []
        for i, (final, edges) in enumerate(nodes):  # targets come before their sources
            n = final
            for c, to in edges:
                label.append(c)
                target.append(to)
                before.append(n)
                n += words_below[to]
            words_below[i] = n
            first.append(len(label))
        arrays = [first, label, target, before, [f for f, _ in nodes], np.concatenate(([0], np.cumsum(sizes))), ids]
        return np.array([root, *map(len, arrays)], np.int64).tobytes() + b"".join(np.asarray(a, np.int32).tobytes() for a in arrays)

    def numbers(self, data: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number in sorted order of the word at each place of ``data``, -1 for words it lacks; all words walk one byte a step."""
        out = np.full(len(at), -1, np.int64)
        if not len(self._key) or not len(at):
            return out
        rows, node, number = np.arange(len(at)), np.full(len(at), len(self.first) - 2), np.zeros(len(at), np.int64)
        for step in range(int(sizes.max()) + 1):
            end = sizes[rows] == step
            if end.any():
                ok = end & (self.final[node] == 1)
                out[rows[ok]] = number[ok]
                rows, node, number = rows[~end], node[~end], number[~end]
            if not len(rows):
                break
            key = node << 8 | data[at[rows] + step].astype(np.int64)
            edge = np.searchsorted(self._key, key)
            edge[edge == len(self._key)] = 0
            ok = self._key[edge] == key
            rows, edge, number = rows[ok], edge[ok], number[ok]
            node, number = self.target[edge].astype(np.int64), number + self.before[edge]
        return out

    def outputs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of several words, one after the other, and how many each has."""
        starts, sizes = self.starts[numbers].astype(np.int64), (self.starts[numbers + 1] - self.starts[numbers]).astype(np.int64)
        return self.ids[spread(starts, sizes)].astype(np.uint32), sizes


class WordEncoder:
    """Encodes and decodes texts as the ``tokenizers`` library does with one vocabulary file."""

    def __init__(self, path: str, lexicon: str | None = None):
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or spec["model"]["end_of_word_suffix"] != "</w>" or spec["decoder"]:
            raise ValueError("a BPE file with NFC, white-space and lower-case normalisers, word ends and no decoder is needed")
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self._words = regex.compile(pattern).findall
        self._specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._space = regex.compile(r"\s+")
        # byte symbols: printable bytes stand for themselves, the others for characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        symbol = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in plain)}
        self._inner = np.array([vocab[symbol[b]] for b in range(256)], np.int64)
        self._outer = np.array([vocab[symbol[b] + "</w>"] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        key = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        by = np.argsort(key)
        self._key, self._rank, self._made = key[by], np.arange(len(key))[by], made[by]
        self._some = np.zeros(1 << 20, bool)  # whether any merge has this hash
        self._some[self._slot(key)] = True
        self._pair: dict[int, tuple[int, int]] | None = None
        self.lexicon = Lexicon(lexicon) if lexicon else None
        names = [(self.names.get(i, "") + " ").encode() for i in range(max(self.names) + 1)]
        self._name_size = np.fromiter(map(len, names), np.int64, len(names))
        self._name_at = np.cumsum(self._name_size) - self._name_size
        self._name_bytes = np.frombuffer(b"".join(names), np.uint8)
        self._forget()

    def _forget(self) -> None:
        """Stretches known so far: sorted hashes with their entry, and every entry's bytes and ids."""
        self._hash, self._entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._at, self._size, self._ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self._raw, self._raw_at, self._raw_size = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    # exact merging

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (a huge one if there is no merge) and result of many pairs."""
        key = a << 20 | b
        rank, made = np.full(len(key), 1 << 40), np.zeros(len(key), np.int64)
        hit = np.flatnonzero(self._some[self._slot(key)])
        at = np.searchsorted(self._key, key[hit])
        at[at == len(self._key)] = 0
        real = self._key[at] == key[hit]
        hit, at = hit[real], at[real]
        rank[hit], made[hit] = self._rank[at], self._made[at]
        return rank, made

    def _merge_same_length(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge words of one byte length (rows of ``data``) side by side: each step does every word's best merge, leftmost on ties.

        Returns the ids of all words, one after the other, and how many each has.
        """
        n, size = data.shape
        ids = self._inner[data]
        ids[:, -1] = self._outer[data[:, -1]]
        out, sizes = np.zeros((n, size), np.uint32), np.zeros(n, np.int64)
        rows = np.arange(n)
        if size > 1:
            rank, made = (x.reshape(n, size - 1) for x in self._lookup(ids[:, :-1].ravel(), ids[:, 1:].ravel()))
        while size > 1 and len(rows):
            j = rank.argmin(axis=1)
            each = np.arange(len(rows))
            done = rank[each, j] >= 1 << 40
            if done.any():
                out[rows[done], :size], sizes[rows[done]] = ids[done], size
                rows, ids, rank, made, j = rows[~done], ids[~done], rank[~done], made[~done], j[~done]
                each = np.arange(len(rows))
            if not len(rows):
                break
            ids[each, j] = made[each, j]
            size -= 1
            keep = np.arange(size)[None, :]
            keep = keep + (keep > j[:, None])
            ids = np.take_along_axis(ids, keep, 1)
            if size == 1:
                break
            keep = np.arange(size - 1)[None, :]
            keep = keep + (keep >= j[:, None])
            keep = np.minimum(keep, size - 1)
            rank, made = np.take_along_axis(rank, keep, 1), np.take_along_axis(made, keep, 1)
            left = np.flatnonzero(j > 0)
            rank[left, j[left] - 1], made[left, j[left] - 1] = self._lookup(ids[left, j[left] - 1], ids[left, j[left]])
            right = np.flatnonzero(j < size - 1)
            rank[right, j[right]], made[right, j[right]] = self._lookup(ids[right, j[right]], ids[right, j[right] + 1])
        out[rows, : ids.shape[1]], sizes[rows] = ids, ids.shape[1]
        return out[np.arange(out.shape[1]) < sizes[:, None]], sizes

    def _merge_long(self, word: bytes) -> np.ndarray:
        """The same for one long word, with a heap and linked symbols."""
        if self._pair is None:
            self._pair = dict(zip(self._key.tolist(), zip(self._rank.tolist(), self._made.tolist(), strict=True), strict=True))
        ids = self._inner[np.frombuffer(word, np.uint8)].tolist()
        ids[-1] = int(self._outer[word[-1]])
        after, ahead = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(ids) and (found := self._pair.get(ids[i] << 20 | ids[j])):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = self._pair[a << 20 | b][1], -1
            after[i] = after[j]
            if after[j] < len(ids):
                ahead[after[j]] = i
            offer(i)
            if ahead[i] >= 0:
                offer(ahead[i])
        return np.array([x for x in ids if x >= 0], np.uint32)

    def word_ids(self, data: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words at places of ``data``: from the lexicon, or merged exactly; with the number of each."""
        n = len(at)
        number = self.lexicon.numbers(data, at, sizes) if self.lexicon else np.full(n, -1)
        groups, parts, counts = [np.flatnonzero(number >= 0)], [], []
        if len(groups[0]):
            ids, count = self.lexicon.outputs(number[groups[0]])
            parts.append(ids)
            counts.append(count)
        else:
            groups = []
        unseen = np.flatnonzero(number < 0)
        for size in np.unique(sizes[unseen]).tolist():
            own = unseen[sizes[unseen] == size]
            if size > WIDE:
                each = [self._merge_long(data[a : a + size].tobytes()) for a in at[own].tolist()]
                ids, count = np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
            else:
                ids, count = self._merge_same_length(data[at[own][:, None] + np.arange(size)])
            groups.append(own)
            parts.append(ids)
            counts.append(count)
        if not groups:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        order, ids, count = np.concatenate(groups), np.concatenate(parts), np.concatenate(counts)
        starts = np.cumsum(count) - count
        back = np.empty(n, np.int64)
        back[order] = np.arange(n)
        return ids[spread(starts[back], count[back])], count[back]

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``word_ids`` of a list of words."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        return self.word_ids(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes, sizes)

    # texts

    def pieces(self, stretch: str) -> list[str]:
        """Split a normalised stretch without white space into words."""
        return [stretch] if stretch.isalpha() else self._words(stretch)

    def _learn(self, data: np.ndarray, alpha: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Remember stretches and give their entries: words of plain letters as they are, others split first."""
        others = np.concatenate(([0], np.cumsum(~alpha)))
        plain = others[end] == others[start]
        one, many = np.flatnonzero(plain), np.flatnonzero(~plain)
        ids, sizes = self.word_ids(data, start[one], end[one] - start[one])
        parts: list[list[bytes]] = []
        marked: dict[int, int] = {}
        for k, (a, b) in enumerate(zip(start[many].tolist(), end[many].tolist(), strict=True)):
            raw = data[a:b].tobytes()
            if raw[0] == 0xFF:
                marked[k] = int(raw[1:])
                parts.append([])
            else:
                parts.append([w.encode("utf-8", "surrogatepass") for w in self.pieces(raw.decode("utf-8", "surrogatepass"))])
        words = list({w for p in parts for w in p})
        flat, count = self.merge_words(words)
        at = dict(zip(words, range(len(words)), strict=True))
        index = np.fromiter((at[w] for p in parts for w in p), np.int64)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        more = flat[spread((np.cumsum(count) - count)[index], count[index])] if len(index) else np.zeros(0, np.uint32)
        each = np.bincount(owner, count[index], len(parts)).astype(np.int64) if len(index) else np.zeros(len(parts), np.int64)
        base = np.cumsum(each) - each
        special = np.fromiter(marked.values(), np.uint32, len(marked))
        spot = np.fromiter(marked.keys(), np.int64, len(marked))
        begin, size = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
        begin[one], size[one] = len(self._ids) + np.cumsum(sizes) - sizes, sizes
        begin[many], size[many] = len(self._ids) + len(ids) + base, each
        begin[many[spot]], size[many[spot]] = len(self._ids) + len(ids) + len(more) + np.arange(len(spot)), 1
        entries = len(self._at) + np.arange(len(start))
        self._at, self._size = np.concatenate((self._at, begin)), np.concatenate((self._size, size))
        self._ids = np.concatenate((self._ids, ids, more, special))
        length = end - start
        self._raw_at = np.concatenate((self._raw_at, len(self._raw) + np.cumsum(length) - length))
        self._raw_size = np.concatenate((self._raw_size, length))
        self._raw = np.concatenate((self._raw, data[spread(start, length)]))
        return entries

    def _normal(self, text: str) -> str:
        """NFC and lower case, character by character."""
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return "".join(c.lower() for c in text) if "\u03a3" in text else text.lower()

    def _flat(self, text: str) -> bytes:
        """Normalised text; special strings become marks that no UTF-8 text can hold."""
        if self._specials is not None and "<|" in text and self._specials.search(text):
            return b" ".join(b"\xff%d" % self.special[part] if k % 2 else self._flat(part) for k, part in enumerate(self._specials.split(text)))
        text = self._normal(text)
        if not text.isascii():
            odd = any(c in text for c in "\x1c\x1d\x1e\x1f")  # split() takes these for white space, the library doesn't
            text = " ".join(self._space.split(text) if odd else text.split())
        return text.encode("utf-8", "surrogatepass")

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one after the other, and the offset of each text in them."""
        raw = [self._flat(t) for t in texts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        row_at = np.cumsum(sizes) - sizes
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8) if raw else np.zeros(0, np.uint8)
        kind, alpha, body = _CLASS[data], _ALPHA[data], ~_SPACE[data]
        letter = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF are letters, but for two signs
        letter = letter[(data[letter + 1] != 0x97) & (data[letter + 1] != 0xB7)]
        for at in (letter, letter + 1):
            kind[at], alpha[at] = 0, True
        # a full stop or comma beside no symbol is a word of its own; so it stands apart in texts where all are such
        mark = kind == 2
        sign = kind > 0
        beside = np.flatnonzero((mark[1:] & sign[:-1]) | (mark[:-1] & sign[1:]))
        tight = np.zeros(len(raw), bool)
        tight[np.searchsorted(row_at, beside, side="right") - 1] = True
        lone = np.flatnonzero(mark)
        lone = lone[~tight[np.searchsorted(row_at, lone, side="right") - 1]]
        apart = np.zeros(len(data), bool)
        apart[lone] = True
        first, last = body.copy(), body.copy()
        first[1:] &= ~body[:-1] | apart[:-1] | apart[1:]
        last[:-1] &= ~body[1:] | apart[1:] | apart[:-1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        where, index, hashes = distinct_spans(data, start, end)
        begin, length = start[where], end[where] - start[where]
        if len(self._at) + len(where) > MEMO:
            self._forget()
        at = np.searchsorted(self._hash, hashes)
        at[at == len(self._hash)] = 0
        met = self._hash[at] == hashes if len(self._hash) else np.zeros(len(hashes), bool)
        entry = np.full(len(hashes), -1)
        entry[met] = self._entry[at[met]]
        # a hash only finds the entry; its bytes tell whether it is the stretch
        own = np.flatnonzero(met)
        entry[own[~same_spans(data, begin[own], length[own], self._raw, self._raw_at[entry[own]], self._raw_size[entry[own]])]] = -1
        new = np.flatnonzero(entry < 0)
        if len(new):
            entry[new] = self._learn(data, alpha, begin[new], begin[new] + length[new])
            fresh = new[~met[new]]
            keep, first = np.unique(hashes[fresh], return_index=True)
            place = np.searchsorted(self._hash, keep)
            self._hash, self._entry = np.insert(self._hash, place, keep), np.insert(self._entry, place, entry[fresh[first]])
        entry = entry[index] if len(index) else np.zeros(0, np.int64)
        size = self._size[entry]
        ids = self._ids[spread(self._at[entry], size)]
        per = np.bincount(np.searchsorted(row_at, start, side="right") - 1, size, len(raw)).astype(np.int64)
        return ids, np.concatenate(([0], np.cumsum(per)))

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The texts of encoded rows in UTF-8: without a decoder in the file the library joins the tokens by spaces."""
        size = self._name_size[ids]
        raw = self._name_bytes[spread(self._name_at[ids], size)].tobytes()
        at = np.concatenate(([0], np.cumsum(size)))[offsets].tolist()
        return [raw[a : max(a, b - 1)] for a, b in zip(at[:-1], at[1:], strict=True)]


# 1: symbols and bytes of characters that may be symbols, 2: full stop and comma
_CLASS = np.ones(256, np.uint8)
_CLASS[[*b"abcdefghijklmnopqrstuvwxyz0123456789 \t\n\x0b\x0c\r"]] = 0
_CLASS[[*b".,"]] = 2
_ALPHA = np.zeros(256, bool)
_ALPHA[[*b"abcdefghijklmnopqrstuvwxyz"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[*b" \t\n\x0b\x0c\r"]] = True


def encoder(path: str, lexicon: str | None = None) -> WordEncoder:
    """The encoder of a file, loaded once per worker."""
    key = (path, lexicon)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(path, lexicon)
    return _ENCODERS[key]


def release() -> None:
    """Let go of a worker's encoder before work that doesn't need it."""
    _ENCODERS.clear()


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def frequent_words(docs: DataFrame, tokenizer_path: str, most: int = LEXICON_WORDS, text_col: str = "text") -> list[str]:
    """The most frequent words of all texts (counted over all of them; ``most`` bounds what comes back)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer_path)
        seen: Counter[str] = Counter()

        def pack() -> pa.RecordBatch:
            words: Counter[str] = Counter()
            for stretch, n in seen.items():
                for w in e.pieces(stretch) if len(stretch) <= 256 else ():
                    words[w] += n
            return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    seen.update(e._flat(text.as_py()).decode("utf-8", "replace").split())
            if len(seen) > COUNTED:
                yield pack()
                seen.clear()
        yield pack()

    counts = docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # a histogram of counts gives the least count that at most so many words reach; only those come to the driver
    counts = stored(counts.filter("n > 1").withColumn("level", F.floor(F.log2("n") * 16).cast("int")), "word-counts")
    total, level = 0, None
    for r in sorted(counts.groupBy("level").count().collect(), reverse=True):
        if total + r["count"] > most:
            break
        total, level = total + r["count"], r["level"]
    return [] if level is None else [r[0] for r in counts.filter(F.col("level") >= level).select("word").collect()]


def compile_lexicon(docs: DataFrame, tokenizer_path: str, most: int = LEXICON_WORDS, text_col: str = "text") -> str:
    """Build the transducer of the frequent words as a file in the shared folder, from which Spark hands it to all executors; returns the file's name.

    The driver holds ``most`` words.  ``SparkContext.addFile`` also serves
    executors that join later.
    """
    words = sorted({w.encode("utf-8", "surrogatepass") for w in frequent_words(docs, tokenizer_path, most, text_col)})
    ids, sizes = encoder(tokenizer_path).merge_words(words)
    sc = docs.sparkSession.sparkContext
    path = new_path(docs.sparkSession, "lexicon") + ".bin"
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(Lexicon.build(words, ids, sizes)))
    out.close()
    sc.addFile(path)
    return path.rsplit("/", 1)[1]


def encode_documents(docs: DataFrame, tokenizer_path: str, lexicon: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Per document ``doc_id, n_tokens, ids_sha256, decoded_sha256``; ``keep`` adds ``ids`` (binary) and ``decoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer_path, SparkFiles.get(lexicon) if lexicon else None)
        for batch in batches:
            for part in slices(batch, "text", AT_ONCE):
                ids, offsets = e.encode_all([t or "" for t in part.column(1).to_pylist()])
                texts = e.decode_all(ids, offsets)
                whole, places = ids.astype("<u4").tobytes(), (4 * offsets).tolist()
                raw = [whole[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]
                cols = [part.column(0), pa.array(np.diff(offsets)), pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep:
                    cols += [pa.array(raw, pa.binary()), pa.array(texts, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)
            pa.default_memory_pool().release_unused()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * keep
    return texts_of(docs, id_col, text_col).mapInArrow(run, schema)


def encode_columns(docs: DataFrame, tokenizer_path: str, lexicon: str | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``token_ids`` (little-endian unsigned 32-bit, binary), ``n_tokens`` and ``decoded`` put in place of columns of these names."""
    own = [c for c in docs.columns if c not in ("token_ids", "n_tokens", "decoded")]
    at = own.index(text_col)
    kept = docs.select(*own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer_path, SparkFiles.get(lexicon) if lexicon else None)
        for batch in batches:
            for part in slices(batch, at, AT_ONCE):
                ids, offsets = e.encode_all([t or "" for t in part.column(at).to_pylist()])
                whole, places = ids.astype("<u4").tobytes(), (4 * offsets).tolist()
                new = [pa.array([whole[a:b] for a, b in zip(places[:-1], places[1:], strict=True)], pa.binary()), pa.array(np.diff(offsets)), pa.array(e.decode_all(ids, offsets), pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*own, "token_ids", "n_tokens", "decoded"])
            pa.default_memory_pool().release_unused()

    added = [T.StructField("token_ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType())]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))
