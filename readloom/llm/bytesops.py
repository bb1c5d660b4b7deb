"""Vectorised byte work on whole Arrow batches of texts (numpy inside Spark tasks)."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
SPACES = b" \t\n\x0b\x0c\r"


def slices(batch: pa.RecordBatch, column: str | int, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no piece holds more than ``max_bytes`` of text (one row at least)."""
    sizes = np.diff(text_offsets(batch.column(column)))
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield batch.slice(start)


def text_offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each row's offsets in them; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    at = text_offsets(column)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, at: np.ndarray, outside: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes that aren't ``outside`` (spaces); rows never share a word."""
    body = ~outside[data]
    first = body.copy()
    first[1:] &= ~body[:-1]
    edge = at[1:-1][at[1:-1] < len(data)]
    first[edge] = body[edge]
    start = np.flatnonzero(first)
    last = body.copy()
    last[:-1] &= ~body[1:] | first[1:]
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(at, start, side="right") - 1


def single_spaced(text: bytes) -> bytes:
    """Replace each run of the six ASCII spaces by one space."""
    if not any(c in text for c in (b"  ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")):
        return text
    data = np.frombuffer(text, np.uint8)
    space = _IS_SPACE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    return np.where(space, np.uint8(32), data)[keep].tobytes()


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Spans above this size are hashed one by one.
_LONG = 512
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one integer each; zeros behind the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0x51) -> np.ndarray:
    """64-bit hash of each byte span: eight bytes at a time are mixed into a state, one step after the other.

    A step is no polynomial of the bytes, so spans that differ by a pattern
    don't meet.  Where a hash stands for a span, compare bytes (``same_spans``).
    """
    size = (end - start).astype(np.int64)
    state = mix64(size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    if not len(start):
        return state
    window = _windows(data)
    rows = np.flatnonzero(size <= _LONG)
    at, left, own = start[rows], size[rows], state[rows]
    while len(rows):
        own = mix64((own ^ (window[at] & _MASK[np.minimum(left, 8)])) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x7F4A7C15))
        more = left > 8
        state[rows] = own
        rows, at, left, own = rows[more], at[more] + 8, left[more] - 8, own[more]
    for i in np.flatnonzero(size > _LONG).tolist():
        state[i] = int.from_bytes(blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, salt=seed.to_bytes(16, "little")).digest(), "little")
    return state


def same_spans(a: np.ndarray, a_start: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Whether each span of ``a`` holds the same bytes as its partner in ``b``."""
    out = a_size == b_size
    rows = np.flatnonzero(out)
    if not len(rows):
        return out
    wa, wb = _windows(a), _windows(b)
    short = rows[a_size[rows] <= _LONG]
    done = 0
    while len(short):
        mask = _MASK[np.minimum(a_size[short] - done, 8)]
        ok = (wa[a_start[short] + done] ^ wb[b_start[short] + done]) & mask == 0
        out[short[~ok]] = False
        done += 8
        short = short[ok & (a_size[short] > done)]
    for i in rows[a_size[rows] > _LONG].tolist():
        n = int(a_size[i])
        out[i] = bool((a[a_start[i] : a_start[i] + n] == b[b_start[i] : b_start[i] + n]).all())
    return out


def distinct_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of one span for each distinct content, each span's index into them, and their hashes; bytes decide, not hashes.

    Hashes ascend, but for spans at the end that share theirs with another.
    """
    hashes, first, index = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
    rep, size = first[index], end - start
    odd = np.flatnonzero(~same_spans(data, start, size, data, start[rep], size[rep])) if len(start) else np.zeros(0, np.int64)
    if len(odd):  # different spans under one hash
        more: dict[bytes, int] = {}
        extra = []
        for i in odd.tolist():
            word = data[start[i] : end[i]].tobytes()
            if word not in more:
                more[word] = len(first) + len(extra)
                extra.append(i)
            index[i] = more[word]
        first, hashes = np.concatenate((first, np.array(extra, first.dtype))), np.concatenate((hashes, span_hashes(data, start[extra], end[extra])))
    return first, index, hashes
