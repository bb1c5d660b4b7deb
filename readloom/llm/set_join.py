"""Exact Jaccard join of shingle sets by PartEnum signatures.

Sets (distinct shingles of ``width`` words, A-Z lower-cased) whose similarity is
``per_cent`` or more differ in at most ``k`` shingles, and their sizes lie in one
band or in two that follow each other: a band ends where its first size divided
by the similarity does.  Every set takes part in two instances, its own band's
and the next one's, each with the ``k`` of the band's largest size.

1. The domain of shingles is dealt by hashing into ``k // 2 + 1`` partitions, each
   of ``PARTS`` parts.  With at most ``k`` differing shingles one partition has at
   most one, so two sets agree in that partition without the one part that holds
   it.  The subsets of all parts but one of every partition are the signatures:
   similar sets share one for certain, and nothing is lost to chance.  Small
   subsets, which unrelated sets share (of large sets some parts are empty), are
   left out as far as one is still shared for certain (``left_out``); for that
   there is one partition more for every ``SPARE``.
2. Documents with equal sets form a class; signatures are made for classes.
3. A sorted pass over the signatures drops those of one class only.  A second one
   cuts the other buckets into groups of members that may be linked (see 5); most
   buckets have none.  Buckets of more than ``BLOCK`` members stay whole.
4. In a part of the groups members are compared with a pivot, which connects most
   copies; classes already connected are not compared again.  Then the pairs of
   different components that may be linked are compared, once each, however many
   groups they share.  Buckets that stayed whole are searched in blocks, each pair
   in the least signature that it shares.  A subset that few
   shingles fall into (``WEAK`` or less) is shared by unrelated sets; where more
   than ``SPLIT`` members of a whole bucket of such a subset are outside the main
   component, it is first split by signatures of another partition of the domain,
   of which similar sets share one as well.
5. A pair is dropped only if sizes, or the counts of shingles in ``CELLS`` parts of
   the domain, prove it to be too far apart (each differing shingle changes one
   count by one), or profiles do, which are such counts in as many parts as a set
   has shingles or half of that; members of groups that still span components carry
   theirs, so a pair is written only if it passes both.  What is left is compared on
   full sets, made from texts.

A shingle stands as two 64-bit hashes under different seeds: among m shingles two
different ones meet with a probability below m**2 / 2**129, 1e-14 for 1e12.

Results: null and empty texts, and texts without words, have an empty set and are
linked with nothing.  Fewer words than ``width`` are one shingle.  Texts of any
length are taken whole.  Rows are told apart by id and text, so one id may stand
on several texts; rows that repeat both are treated alike.  A null ``doc_id``
takes part and counts as larger than any other; where a component has no other
id, ``component_id`` is null.  An empty table gives an empty one.  Further columns
are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.bytesops import mix64, slices
from readloom.llm.components import components
from readloom.llm.near_dedup import _NO_ID, _blocks, _sets_of, linked, shingle_sets
from readloom.llm.shared import discard, new_path, stored

#: Parts of a partition; a signature leaves one out.
PARTS = 3
#: One partition in so many is spare: sets leave small subsets out for it.
SPARE = 5
#: Shingles in the largest subsets that may be left out.
SMALL = 6
#: Parts of the domain whose counts bound the distance of two sets.
CELLS = 64
#: Thirty-seconds of the buckets whose pivots are compared in one round.
ROUNDS = ((0, 2), (2, 8))
#: Members outside a bucket's main component from which it is split, and how often.
SPLIT, LEVELS = 1024, 3
#: Shingles in a subset up to which its signature is weak.
WEAK = 2
#: Members of a bucket in one block of the search over counts, and of the search over texts.
BLOCK, TEXT_BLOCK = 1024, 512
_GOLD, _ALL = np.uint64(0x9E3779B97F4A7C15), (1 << 64) - 1


def size_bands(per_cent: int, largest: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """First size of every band, and how many shingles similar sets of its instance may differ in."""
    first = [1]
    while first[-1] <= largest:
        first.append(100 * first[-1] // per_cent + 1)
    last = np.array(first[1:]) - 1
    return np.array(first[:-1]), 2 * last * (100 - per_cent) // (100 + per_cent)


def signatures(rows: np.ndarray, hashes: np.ndarray, n: int, per_cent: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Row and signature of ``n`` sets, sorted by row; equal sets have equal ones.  The lowest bit tells whether a subset is weak."""
    sizes = np.bincount(rows, minlength=n)
    some = np.flatnonzero(sizes)
    first, far = size_bands(per_cent, 200 * int(sizes.max(initial=1)) // per_cent)  # one band more than the sizes need
    found_rows, found = [], []
    value = mix64(hashes + np.uint64((seed + 1) * 0xD6E8FEB86659FD93 & _ALL))
    for step in (0, 1):
        band = np.zeros(n, np.int64)
        band[some] = np.searchsorted(first, sizes[some], side="right") - 1 + step
        cuts = np.zeros(n, np.int64)
        cuts[some] = far[band[some]] // 2 + 1
        cuts += cuts // SPARE
        last = 100 * np.minimum(first[band], sizes) // per_cent  # the largest partner
        differ = (100 - per_cent) * (sizes + last) // (100 + per_cent)
        begin = np.concatenate(([0], np.cumsum(cuts * PARTS)))
        draw = mix64(value + (band[rows] + 1).astype(np.uint64) * _GOLD)
        low = draw & np.uint64(0xFFFFFFFF)
        part = (low * cuts[rows].astype(np.uint64) * np.uint64(PARTS)) >> np.uint64(32)
        cell = begin[rows] + part.astype(np.int64)
        sums = np.zeros(int(begin[-1]), np.uint64)
        np.add.at(sums, cell, mix64(draw ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        left, held = (x.sum(axis=1, dtype=x.dtype)[:, None] - x for x in (sums.reshape(-1, PARTS), np.bincount(cell, minlength=len(sums)).reshape(-1, PARTS)))
        keep = ~left_out(held, np.repeat(np.arange(n), cuts), 2 * cuts - differ - 1).reshape(-1)
        left, held = left.reshape(-1), held.reshape(-1)
        row = np.repeat(np.arange(n), np.diff(begin))
        place = (np.arange(len(row)) - begin[row]).astype(np.uint64)
        key = mix64(left + mix64(place + (band[row] + 1).astype(np.uint64) * _GOLD + np.uint64(seed * 0xC2B2AE3D27D4EB4F & _ALL)))
        key = key >> np.uint64(1) << np.uint64(1) | (held <= WEAK).astype(np.uint64)
        keep &= (differ > 0)[row]  # equal sets are one class already
        found_rows.append(row[keep])
        found.append(key[keep])
    row, key = np.concatenate(found_rows), np.concatenate(found)
    order = np.argsort(row, kind="stable")
    return row[order], key[order].view(np.int64)


def left_out(held: np.ndarray, rows: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Which subsets (``PARTS`` for each partition, with ``held`` shingles) a set does without: its smallest ones, at equal size the first ones.

    A set that differs in ``k`` shingles and shares none of the others has two of
    them in a partition, or one where one subset or more are left out, or none
    where all are.  So with ``2 * partitions - k - 1`` to spare, the first subset
    left out of a partition takes one, and so does the last one.  Subsets that two
    sets share have one size and place, and the set that leaves more out is right
    by itself; the other one has what that one keeps.
    """
    takes = np.zeros(PARTS + 1, np.int64)
    takes[[1, PARTS]] = 1
    total = np.cumsum(takes)
    level, used = np.full(len(spare), -1), np.zeros(len(spare), np.int64)  # subsets up to this size all go
    for size in range(SMALL):
        now = np.bincount(rows, total[(held <= size).sum(axis=1)], minlength=len(spare)).astype(np.int64)
        fits = now <= spare
        if not fits.any():
            break
        level[fits], used[fits] = size, now[fits]
    limit = level[rows][:, None]
    below, at = held <= limit, held == limit + 1
    cost = np.where(at, takes[below.sum(axis=1)[:, None] + np.cumsum(at, axis=1)], 0).reshape(-1)
    done = np.cumsum(cost).reshape(held.shape)
    begin = np.searchsorted(rows, np.arange(len(spare)))
    before = np.concatenate(([0], done[:, -1]))[begin]
    return below | at & (done - before[rows][:, None] + used[rows][:, None] <= spare[rows][:, None])


def cell_counts(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Shingles of each set in ``CELLS`` parts of the domain, 255 at most."""
    cell = (mix64(hashes ^ np.uint64(0x5DEECE66D)) >> np.uint64(40)) % np.uint64(CELLS)
    counts = np.bincount(rows * CELLS + cell.astype(np.int64), minlength=n * CELLS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(n, CELLS)


def _described(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                rows, one, two = shingle_sets(batch, 1, width)
                n = batch.num_rows
                size = np.bincount(rows, minlength=n)
                ends = np.concatenate(([0], np.cumsum(size)))
                prints = []
                for hashes in (one, two):
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(hashes + np.uint64(0x1234567)))))
                    prints.append(pa.array((total[ends[1:]] - total[ends[:-1]]).view(np.int64)))
                cells = pa.array([c.tobytes() for c in cell_counts(rows, one, n)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(size, pa.int64()), *prints, cells], ["id", "sha", "n", "f1", "f2", "cells"])

    return run


def _signed(width: int, per_cent: int, seed: int):
    """Signatures of texts: (key, path, cls), the key of one that splits a bucket being that of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows, one, _ = shingle_sets(batch, batch.schema.get_field_index("text"), width)
                row, sig = signatures(rows, one, batch.num_rows, per_cent, seed)
                pick = pa.array(row)
                cls = batch.column("cls").take(pick)
                if not seed:
                    yield pa.RecordBatch.from_arrays([pa.array(sig), cls], ["key", "cls"])
                    continue
                above = np.asarray(batch.column("key"))[row].view(np.uint64)
                key = mix64(above * _GOLD + sig.view(np.uint64)).view(np.int64) & ~1 | sig & 1
                path = np.column_stack((_paths(batch.column("path"), seed)[row], sig))
                paths = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * (seed + 1), pa.int32()), pa.array(path.reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(key), paths, cls], ["key", "path", "cls"])

    return run


def _paths(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), n)


def _with_mates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose key has others, from rows sorted by key."""
    held, alone = None, True  # the last row, and whether it is the first of its key
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = np.asarray(rows.column("key"))
        same = key[1:] == key[:-1]
        first = np.append(True, ~same)
        if held is not None:
            first[0] = alone
        yield rows.slice(0, len(key) - 1).filter(pa.array((~first[:-1]) | same))
        held, alone = rows.slice(len(key) - 1), bool(first[-1])
    if held is not None and not alone:
        yield held


def mates(keys: DataFrame) -> DataFrame:
    """The rows of keys that several classes share."""
    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(_with_mates, keys.schema)


def may_link(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, per_cent: int) -> np.ndarray:
    """Whether sizes and counts leave room for the similarity, pair by pair."""
    fits = 100 * np.minimum(na, nb) >= per_cent * np.maximum(na, nb)
    apart = (np.maximum(a, b) - np.minimum(a, b)).sum(axis=1, dtype=np.int64)
    return fits & ((100 + per_cent) * apart <= (100 - per_cent) * (na + nb))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), CELLS)


def profiles(rows: np.ndarray, hashes: np.ndarray, n: int) -> list[bytes]:
    """Shingles of each set in parts of the domain by the hash's first bits, 15 at most, two counts to a byte.

    The parts are a power of two, about one for each shingle or half of that, so two
    profiles compare at the shorter one's parts (see ``profile_distance``).
    """
    size = np.bincount(rows, minlength=n)
    bits = np.maximum(6, np.ceil(np.log2(np.maximum(size, 2) / 2)).astype(np.uint64))
    begin = np.concatenate(([0], np.cumsum(1 << bits.astype(np.int64))))
    part = begin[rows] + (hashes >> (np.uint64(64) - bits[rows])).astype(np.int64)
    counts = np.minimum(np.bincount(part, minlength=begin[-1]), 15).astype(np.uint8)
    packed = (counts[::2] | counts[1::2] << 4).tobytes()
    return [packed[x // 2 : y // 2] for x, y in itertools.pairwise(begin.tolist())]


def profile_distance(a: bytes, b: bytes) -> int:
    """No more than the number of shingles that two sets differ in.

    Counts of 15 stand for any larger ones, also after neighbours were added up.
    """
    to = 2 * min(len(a), len(b))
    return int(np.abs(_profile_counts(a, to) - _profile_counts(b, to)).sum())


def _profile_counts(profile: bytes, parts: int) -> np.ndarray:
    """The counts of a profile in so many parts, its own number or fewer."""
    packed = np.frombuffer(profile, np.uint8)
    return np.minimum(np.stack((packed & 15, packed >> 4), axis=1).reshape(parts, -1).sum(axis=1, dtype=np.int64), 15)


def profiles_fit(found: list[bytes], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, per_cent: int) -> np.ndarray:
    """Whether profiles leave room for the similarity of the pairs at these places, some million counts at a time."""
    ok = np.zeros(len(left), bool)
    parts = np.array([2 * len(x) for x in found], np.int64)
    to = np.minimum(parts[left], parts[right])
    for n in np.unique(to).tolist():
        same = np.flatnonzero(to == n)
        for pick in np.split(same, range(max(1, (1 << 22) // n), len(same), max(1, (1 << 22) // n))):
            own, place = np.unique(np.concatenate((left[pick], right[pick])), return_inverse=True)
            counts = np.stack([_profile_counts(found[i], n).astype(np.uint8) for i in own.tolist()])
            x, y = counts[place[: len(pick)]], counts[place[len(pick) :]]
            apart = (np.maximum(x, y) - np.minimum(x, y)).sum(axis=1, dtype=np.int64)
            ok[pick] = (100 + per_cent) * apart <= (100 - per_cent) * (sizes[left[pick]] + sizes[right[pick]])
    return ok


def _profiled(width: int):
    """Texts as ``cls, n, p``: size and profile of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                rows, one, _ = shingle_sets(batch, 1, width)
                size = np.bincount(rows, minlength=batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(profiles(rows, one, batch.num_rows), pa.binary())], ["cls", "n", "p"])

    return run


def _possible(per_cent: int):
    """Pairs that sizes and profiles leave room for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, na, nb = batch.column("pa"), batch.column("pb"), np.asarray(batch.column("na")), np.asarray(batch.column("nb"))
                ok = 100 * np.minimum(na, nb) >= per_cent * np.maximum(na, nb)
                for i in np.flatnonzero(ok).tolist():
                    ok[i] = (100 + per_cent) * profile_distance(a[i].as_py(), b[i].as_py()) <= (100 - per_cent) * (na[i] + nb[i])
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok))

    return run


def near_pairs(starts: np.ndarray, cells: np.ndarray, sizes: np.ndarray, per_cent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs that may be linked, in buckets that lie one after the other (some hundred thousand pairs are looked at together)."""
    todo = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(sizes)) - 1
    done = np.concatenate(([0], np.cumsum(todo)))
    at = 0
    while at < len(sizes):  # members, each with all that follow it
        to = max(at + 1, int(np.searchsorted(done, done[at] + 200_000, side="right")) - 1)
        left = np.repeat(np.arange(at, to), todo[at:to])
        right = left + 1 + np.arange(len(left)) - (done[left] - done[at])
        fits = 100 * np.minimum(sizes[left], sizes[right]) >= per_cent * np.maximum(sizes[left], sizes[right])
        left, right = left[fits], right[fits]
        near = may_link(cells[left], cells[right], sizes[left], sizes[right], per_cent)
        yield left[near], right[near]
        at = to


def near_groups(starts: np.ndarray, cells: np.ndarray, sizes: np.ndarray, per_cent: int) -> np.ndarray:
    """For members of buckets that lie one after the other: the first one that each may be linked with, over others too."""
    group = np.arange(len(sizes))
    for left, right in near_pairs(starts, cells, sizes, per_cent):
        while (group[left] != group[right]).any():
            low = np.minimum(group[left], group[right])
            for side in (left, right):
                np.minimum.at(group, group[side], low)
            group = group[group]
    while (group[group] != group).any():
        group = group[group]
    return group


def _paired(per_cent: int):
    """Pairs ``a, b`` of different components that counts and profiles leave room for, from near groups sorted by key."""

    def pairs(rows: pa.RecordBatch) -> pa.RecordBatch:
        key, cls, comp = (np.asarray(rows.column(c)) for c in ("key", "cls", "comp"))
        starts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
        ids, first, place = np.unique(cls, return_index=True, return_inverse=True)
        sizes, found = np.asarray(rows.column("n")), [np.zeros(0, np.int64)]
        for left, right in near_pairs(starts, _matrix(rows.column("cells")), sizes, per_cent):
            apart = comp[left] != comp[right]
            a, b = place[left[apart]], place[right[apart]]
            found.append(np.unique(np.minimum(a, b) * len(ids) + np.maximum(a, b)))
        a, b = np.divmod(np.unique(np.concatenate(found)), len(ids))  # a pair that shares several groups is looked at once
        ok = profiles_fit(rows.column("p").take(pa.array(first)).to_pylist(), sizes[first], a, b, per_cent)
        return pa.RecordBatch.from_arrays([pa.array(ids[a[ok]]), pa.array(ids[b[ok]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
                key = np.asarray(rows.column("key"))
                last = int(np.flatnonzero(key != key[-1]).max(initial=-1)) + 1  # the last group may go on
                held = rows.slice(last)
                if last:
                    yield pairs(rows.slice(0, last))
        if held is not None:
            yield pairs(held)

    return run


def _grouped(per_cent: int):
    """Buckets (sorted by key) cut into near groups: (key, path, cls, pivot, whole, two); a group's key is made of the bucket's and its first class."""

    def out(rows: pa.RecordBatch, key: np.ndarray, pivot: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
        if "path" in rows.schema.names:
            path = rows.column("path")
        else:
            path = pa.ListArray.from_arrays(pa.array(np.arange(rows.num_rows + 1), pa.int32()), rows.column("key"))
        return pa.RecordBatch.from_arrays([pa.array(key), path, rows.column("cls"), pa.array(pivot), pa.array(kind == 0), pa.array(kind == 2)], ["key", "path", "cls", "pivot", "whole", "two"])

    def cut(rows: pa.RecordBatch) -> pa.RecordBatch:
        key, cls = np.asarray(rows.column("key")), np.asarray(rows.column("cls"))
        starts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
        group = near_groups(starts, _matrix(rows.column("cells")), np.asarray(rows.column("n")), per_cent)
        size = np.bincount(group, minlength=len(group))[group]
        several = size > 1
        own = (mix64(key.view(np.uint64) + mix64(cls[group].view(np.uint64)) * _GOLD).view(np.int64) & ~1) | (key & 1)
        pick = pa.array(np.flatnonzero(several))
        return out(rows.take(pick), own[several], cls[group][several], size[several])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = None, None  # rows of the last bucket so far, or its key and pivot if it is kept whole
        for batch in batches:
            if not batch.num_rows:
                continue
            if large:
                n = int((np.asarray(batch.column("key")) == large[0]).sum())  # the first ones, by the sort
                if n:
                    yield out(batch.slice(0, n), np.full(n, large[0]), np.full(n, large[1]), np.zeros(n))
                batch = batch.slice(n)
                if not batch.num_rows:
                    continue
                large = None
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            key = np.asarray(rows.column("key"))
            starts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
            few = np.diff(starts) <= BLOCK
            small = np.repeat(few, np.diff(starts))
            small[starts[-2] :] = False  # the last one may go on
            yield cut(rows.filter(pa.array(small)))
            for i in np.flatnonzero(~few).tolist():
                part = rows.slice(starts[i], starts[i + 1] - starts[i])
                pivot = part.column("cls")[0].as_py()
                yield out(part, np.full(part.num_rows, key[starts[i]]), np.full(part.num_rows, pivot), np.zeros(part.num_rows))
                if i == len(few) - 1:
                    large = (key[-1], pivot)
            held = None if large else rows.slice(starts[-2])
        if held is not None:
            yield cut(held)

    return run


def _linked(width: int, per_cent: int):
    """The pairs (a, b and their texts) that full sets confirm; a class's set is made once for a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "tb"):
                a, b = (np.asarray(batch.column(c)) for c in ("a", "b"))
                n = len(a)
                _, first, place = np.unique(np.concatenate((a, b)), return_index=True, return_inverse=True)
                texts = pa.concat_arrays([batch.column("ta"), batch.column("tb")]).take(pa.array(first))
                sets = [s for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text") for s in _sets_of(part, 0, width)]
                ok = [linked(sets[x], sets[y], per_cent) for x, y in zip(place[:n].tolist(), place[n:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _search(width: int, per_cent: int, texts: bool, every: bool = False):
    """A block of a bucket's outsiders against a block of its members.

    Without texts the result names the members that may have a partner in
    another component; with them it is the links that full sets confirm, each
    pair in its least common signature: all of them (``every``), or those
    between components that the block has not joined yet.
    """

    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        out, rest = block[block["side"] == 0], block[block["side"] == 1]
        a, b = (np.frombuffer(b"".join(x["cells"]), np.uint8).reshape(len(x), CELLS) for x in (out, rest))
        comp, ids, sizes = rest["comp"].to_numpy(), rest["cls"].to_numpy(), rest["n"].to_numpy()
        own_text, their_text = (x["text"].tolist() if texts else None for x in (out, rest))
        path = block["path"].iloc[0] if texts and len(block) else []
        root: dict[int, int] = {}
        made: dict[int, tuple] = {}
        met = np.zeros(len(rest), bool)
        links = []

        def top(c: int) -> int:
            while c in root:
                c = root[c]
            return c

        def described(text: str) -> tuple:
            batch = pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"])
            own = _sets_of(batch, 0, width)[0]
            return own, [signatures(np.zeros(len(own[0]), np.int64), own[0], 1, per_cent, seed)[1] for seed in range(len(path))]

        for i, (cls, own, n) in enumerate(zip(out["cls"].tolist(), out["comp"].tolist(), out["n"].tolist(), strict=True)):
            near = np.flatnonzero((comp != own) & (100 * np.minimum(sizes, n) >= per_cent * np.maximum(sizes, n)))
            near = near[may_link(a[i][None, :], b[near], np.int64(n), sizes[near], per_cent)]
            if not len(near):
                continue
            if not texts:
                met[near] = True
                links.append(cls)
                continue
            x = None
            for j in near.tolist():
                u, v = top(own), top(int(comp[j]))
                if u == v and not every:
                    continue
                x = described(own_text[i]) if x is None else x
                if j not in made:
                    made[j] = described(their_text[j])
                y = made[j]
                if all(np.intersect1d(s, t).min(initial=step) == step for s, t, step in zip(x[1], y[1], path, strict=True)) and linked(x[0], y[0], per_cent):
                    if u != v:
                        root[max(u, v)] = min(u, v)
                    links.append((min(cls, int(ids[j])), max(cls, int(ids[j]))))
        if not texts:
            return pd.DataFrame({"key": key[0], "cls": np.unique(np.concatenate((np.array(links, np.int64), ids[met])))})
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


class SetJoin:
    """Classes of equal sets of a table, their texts and signatures, and the links between them."""

    def __init__(self, docs: DataFrame, width: int, per_cent: int, id_col: str, text_col: str):
        self.width, self.per_cent = width, per_cent
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        plain = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("sha"))
        self.rows = stored(plain.mapInArrow(_described(width), "id long, sha binary, n long, f1 long, f2 long, cells binary"), "join-rows")
        least = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "sha")).alias("low")
        classes = self.rows.filter("n > 0").groupBy("n", "f1", "f2").agg(least, F.count(F.lit(1)).alias("size"), F.min("cells").alias("cells"))
        self.classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "join-classes")
        of = self.classes.select("cls", F.coalesce("low.id", F.lit(_NO_ID)).alias("k"), "low.sha")
        key = F.coalesce("id", F.lit(_NO_ID)).alias("k")
        texts_at, shared_at = (new_path(docs.sparkSession, name) for name in ("join-texts", "join-shared"))
        texts = stored(plain.select(key, "sha", "text").join(of, ["k", "sha"]).dropDuplicates(["k", "sha"]).select("cls", "text"), "join-texts", texts_at, compression="zstd")
        self.sizes = self.classes.select("cls", "n", "cells")
        shared = stored(mates(texts.mapInArrow(_signed(width, per_cent, 0), "key long, cls long")), "join-shared", shared_at, compression="zstd")
        self.buckets = stored(self.grouped(shared), "join-buckets", compression="zstd")
        discard(docs.sparkSession, shared_at)
        self.texts = stored(texts.join(self.buckets.select("cls").distinct(), "cls", "left_semi").select("cls", "text"), "join-met", compression="zstd")
        discard(docs.sparkSession, texts_at)
        self.profiles = stored(self.texts.mapInArrow(_profiled(width), "cls long, n long, p binary"), "join-profiles", compression="zstd")

    def grouped(self, shared: DataFrame) -> DataFrame:
        """Buckets (``key, cls``, and ``path`` if they were split) as near groups; ``two`` marks pairs."""
        dealt = shared.join(self.sizes, "cls").repartition("key").sortWithinPartitions("key", F.xxhash64("cls", "key"))
        return dealt.mapInArrow(_grouped(self.per_cent), "key long, path array<long>, cls long, pivot long, whole boolean, two boolean")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``a, b`` that are links; each step is written, so that one's shuffles go before the next."""
        pa_, pb = (self.profiles.withColumnsRenamed({"cls": x, "p": "p" + x, "n": "n" + x}) for x in "ab")
        pairs = stored(pairs, "join-pairs")
        near = stored(pairs.join(pa_, "a").join(pb, "b").mapInArrow(_possible(self.per_cent), "a long, b long"), "join-possible")
        ta, tb = (self.texts.select(F.col("cls").alias(x), F.col("text").alias("t" + x)) for x in "ab")
        return near.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(_linked(self.width, self.per_cent), "a long, b long")

    def apart(self, rows: DataFrame, comp: DataFrame) -> DataFrame:
        """Rows of groups whose members are in several components, with their components, sizes and counts."""
        members = rows.join(comp, "cls")
        span = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
        return members.join(span, "key").join(self.sizes, "cls")

    def grouped_links(self, rows: DataFrame, comp: DataFrame, tested: DataFrame | None = None) -> DataFrame:
        """Links between members of different components of near groups, each pair looked at once."""
        live = self.apart(rows.filter("not whole and not two").select("key", "cls"), comp).join(self.profiles.select("cls", "p"), "cls")
        live = live.repartition("key").sortWithinPartitions("key")
        pairs = live.mapInArrow(_paired(self.per_cent), "a long, b long")
        two = rows.filter("two and cls <> pivot").select("cls", "pivot").distinct()
        two = two.join(comp, "cls").join(comp.withColumnsRenamed({"cls": "pivot", "comp": "pcomp"}), "pivot").filter("comp <> pcomp")
        pairs = pairs.unionByName(two.select(F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b"))).distinct()
        return self.confirmed(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))

    def whole_links(self, comp: DataFrame, every: bool = False) -> DataFrame:
        """Links between members of different components of the buckets that stay whole."""
        found, rows = None, self.buckets.filter("whole").select("key", "path", "cls")
        for level in range(1, LEVELS + 1):
            live = stored(self.apart(rows, comp), "join-live")
            if live.isEmpty():
                break
            per = live.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("key").agg((F.sum("k") - F.max("k")).alias("outs"))
            per = stored(per.withColumn("split", (F.col("outs") > SPLIT) & (F.col("key").bitwiseAND(F.lit(1)) == 1) & F.lit(level < LEVELS)), "join-large")
            kept, split = (live.join(per.filter(c).select("key"), "key") for c in ("not split", "split"))
            near = _blocks(kept.withColumn("bytes", F.lit(CELLS).cast("long")), BLOCK, ["cls", "comp", "n", "cells"])
            near = stored(near.applyInPandas(_search(self.width, self.per_cent, False), "key long, cls long").distinct(), "join-near")
            close = kept.join(near, ["key", "cls"]).join(self.texts, "cls").withColumn("bytes", F.octet_length("text").cast("long"))
            links = _blocks(close, TEXT_BLOCK, ["cls", "comp", "n", "cells", "path", "text"]).applyInPandas(_search(self.width, self.per_cent, True, every), "a long, b long")
            if per.filter("split").isEmpty():
                found = links if found is None else found.unionByName(links)
                break
            parts = split.select("key", "path", "cls").join(self.texts, "cls").select("key", "path", "cls", "text")
            parts = stored(self.grouped(mates(parts.mapInArrow(_signed(self.width, self.per_cent, level), "key long, path array<long>, cls long"))), "join-split")
            links = links.unionByName(self.grouped_links(parts, comp))
            found, rows = links if found is None else found.unionByName(links), parts.filter("whole").select("key", "path", "cls")
        return self.texts.limit(0).select(F.col("cls").alias("a"), F.col("cls").alias("b")) if found is None else found

    def connected(self) -> DataFrame:
        """``cls, comp``: the component of every class that shares a group."""
        comp = stored(self.buckets.select("cls").distinct().withColumn("comp", F.col("cls")), "join-comp")

        def merged(comp: DataFrame, links: DataFrame) -> DataFrame:
            links = stored(links, "join-links")
            if links.isEmpty():
                return comp
            edges = links.join(comp.withColumnsRenamed({"cls": "a", "comp": "ca"}), "a").join(comp.withColumnsRenamed({"cls": "b", "comp": "cb"}), "b")
            new = components(edges.select(F.col("ca").alias("a"), F.col("cb").alias("b")), "join-components").withColumnRenamed("comp", "low")
            return stored(comp.join(new, comp["comp"] == new["node"], "left").select("cls", F.coalesce("low", "comp").alias("comp")), "join-comp")

        tested = None
        for low, high in ROUNDS:
            share = F.shiftrightunsigned("key", 7).bitwiseAND(F.lit(31))
            pairs = self.buckets.filter((share >= low) & (share < high) & (F.col("cls") != F.col("pivot"))).select("cls", "pivot").distinct()
            if tested is not None:
                pairs = pairs.join(comp, "cls").join(comp.withColumnsRenamed({"cls": "pivot", "comp": "pcomp"}), "pivot").filter("comp <> pcomp")
            pairs = pairs.select(F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b")).distinct()
            pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "join-pairs")
            comp = merged(comp, self.confirmed(pairs))
            tested = pairs if tested is None else tested.unionByName(pairs)
        comp = merged(comp, self.grouped_links(self.buckets, comp, tested))
        return comp if self.buckets.filter("whole").isEmpty() else merged(comp, self.whole_links(comp))


def joined_classes(docs: DataFrame, width: int = 5, per_cent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    join = SetJoin(docs, width, per_cent, id_col, text_col)
    own = join.classes.select("cls", "n", "f1", "f2", "low").join(join.connected(), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    of = own.join(own.groupBy("comp").agg(F.min("low").alias("least")), "comp").select("n", "f1", "f2", F.col("least.id").alias("component_id"))
    some = join.rows.filter("n > 0").select("id", "n", "f1", "f2").join(of, ["n", "f1", "f2"])
    none = join.rows.filter("n = 0").withColumn("component_id", F.col("id"))
    return some.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id").unionByName(none.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id"))


def linked_classes(docs: DataFrame, width: int = 5, per_cent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every link between different sets as ``a, b`` (classes), and the membership ``doc_id, cls, size`` of documents with words.

    A class stands for all documents of one set (``size``), so copies aren't expanded into pairs.
    """
    join = SetJoin(docs, width, per_cent, id_col, text_col)
    alone = stored(join.buckets.select("cls").distinct().withColumn("comp", F.col("cls")), "join-comp")
    rows = join.rows.filter("n > 0").join(join.classes.select("n", "f1", "f2", "cls", "size"), ["n", "f1", "f2"])
    return join.grouped_links(join.buckets, alone).unionByName(join.whole_links(alone, every=True)).distinct(), rows.select(F.col("id").alias("doc_id"), "cls", "size")
