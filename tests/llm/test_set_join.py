import numpy as np
import pytest

from readloom.llm import set_join as sj
from tests.llm.helpers import awkward, documents
from tests.llm.helpers import test_tables as tables_of
from tests.llm.test_dedup import brute, edited, shingles


def _rows(groups=8):
    rng = np.random.default_rng(4)
    rows = awkward()
    for g in range(groups):  # groups of copies with few to many edits, chains among them
        words = [f"g{g}w{rng.integers(300)}" for _ in range(20 + 45 * g)]
        for k in range(14):
            rows.append((100 + g * 20 + k, edited(rng, words, int(rng.integers(0, 2 + g)))))
            if k % 4 == 3:
                words = edited(rng, words, 2 + g // 2).split(" ")
    return rows


@pytest.mark.parametrize("per_cent", [80, 90, 65])
def test_similar_sets_share_a_signature(per_cent):
    rng = np.random.default_rng(per_cent)
    tried = 0
    for size in [*range(1, 40), 77, 150, 400, 3000]:
        for _ in range(12):
            whole = rng.integers(0, 1 << 63, 2 * size).astype(np.uint64)
            shared = int(np.ceil(size * per_cent / 100))
            a, b = whole[:size], np.concatenate((whole[:shared], whole[size : size + rng.integers(0, size - shared + 1)]))
            both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            if 100 * both < per_cent * union or both == union:
                continue
            tried += 1
            hashes, rows = np.concatenate((a, b)), np.repeat([0, 1], [len(a), len(b)])
            for seed in (0, 2):
                row, key = sj.signatures(rows, hashes, 2, per_cent, seed)
                assert len(np.intersect1d(key[row == 0], key[row == 1]))
            cells = sj.cell_counts(rows, hashes, 2)
            assert sj.may_link(cells[:1], cells[1:], np.array([len(a)]), np.array([len(b)]), per_cent).all()
    assert tried > 100


def test_profiles_never_exceed_the_distance():
    rng = np.random.default_rng(5)
    crowd = np.arange(40, dtype=np.uint64)  # all in one part, more than a count holds
    for n, m, both in [(1, 1, 0), (1, 1, 1), (40, 50, 40), (1000, 1030, 900), (1024, 1100, 1000), (5000, 6000, 10), (3, 4000, 3)]:
        a = rng.integers(0, 2**64, n, np.uint64)
        b = np.concatenate((a[:both], rng.integers(0, 2**64, m - both, np.uint64)))
        for x, y in ((a, b), (np.append(a, crowd), b), (np.append(a, crowd), np.append(b, crowd[:20]))):
            p, q = sj.profiles(np.repeat([0, 2], [len(x), len(y)]), np.concatenate((x, y)), 3)[::2]
            assert sj.profile_distance(p, q) == sj.profile_distance(q, p) <= len(np.setxor1d(x, y))
            assert sj.profile_distance(p, p) == 0
    assert sj.profile_distance(*sj.profiles(np.repeat([0, 1], 2000), rng.integers(0, 2**64, 4000, np.uint64), 2)) > 1500  # strangers are told apart


def test_bands_hold_all_similar_sizes():
    for per_cent in (80, 50, 95):
        first, far = sj.size_bands(per_cent, 5000)
        band = lambda n: int(np.searchsorted(first, n, side="right")) - 1
        for n in range(1, 4000):
            least = -(-per_cent * n // 100)
            assert band(n) - band(least) <= 1
            assert far[band(n)] >= 2 * n * (100 - per_cent) // (100 + per_cent)


@pytest.mark.parametrize(("width", "split"), [(5, 1024), (2, 4)])
def test_components_equal_brute_force(spark, monkeypatch, width, split):
    if split < 1024:  # buckets stay whole, and weak ones are split
        monkeypatch.setattr(sj, "BLOCK", split)
        monkeypatch.setattr(sj, "SPLIT", 1)
    rows = _rows()
    got = sorted(map(tuple, sj.joined_classes(documents(spark, rows), width=width).collect()))
    assert got == [r[:3] for r in brute(rows, width)]
    _, empty, null = tables_of(spark)
    assert sj.joined_classes(empty).count() == 0
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in sj.joined_classes(null).collect()) == [(-1, 1, None), (1, 0, 1)]


def test_split_buckets_lose_no_link(spark, monkeypatch):
    """Without pivots, with buckets that stay whole and weak ones that are split, every link is found."""
    monkeypatch.setattr(sj, "SPLIT", 1)
    monkeypatch.setattr(sj, "BLOCK", 4)
    rows = _rows(2)
    links, members = sj.linked_classes(documents(spark, rows), width=2)
    of = {}
    for r in members.collect():
        of.setdefault(r["cls"], []).append(r["doc_id"])
    text = dict(rows)
    sets = {c: shingles(text[ids[0]]) for c, ids in of.items()}
    assert all(shingles(text[i]) == sets[c] for c, ids in of.items() for i in ids)
    classes = sorted(of)
    want = {(a, b) for k, b in enumerate(classes) for a in classes[:k] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert {(r["a"], r["b"]) for r in links.collect()} == want and len(want) > 20


def test_hot_group_of_near_copies(spark):
    rng = np.random.default_rng(9)
    words = [f"w{rng.integers(4000)}" for _ in range(300)]
    rows = [(i, edited(rng, words, 6)) for i in range(300)] + [(1000 + i, "one and the same text of more than five words") for i in range(300)]
    rows += [(3000 + i, edited(rng, [f"v{rng.integers(9000)}" for _ in range(60)], 1)) for i in range(300)]
    got = {r["doc_id"]: r["component_id"] for r in sj.joined_classes(documents(spark, rows)).collect()}
    assert got == {r[0]: r[2] for r in brute(rows, 5)} and len(got) == 900


@pytest.mark.parametrize("per_cent", [80, 90, 65])
def test_small_subsets_are_left_out_without_loss(per_cent):
    """Shingles are taken away where that destroys most signatures; the rest still shares one."""
    rng = np.random.default_rng(per_cent + 1)
    for size in [5, 9, 14, 20, 33, 77, 150, 400, 1300, 2000]:
        for _ in range(6):
            whole = rng.integers(0, 1 << 63, size).astype(np.uint64)
            first, far = sj.size_bands(per_cent, 4 * size)
            band = int(np.searchsorted(first, size, side="right")) - 1
            cuts = int(far[band]) // 2 + 1
            cuts += cuts // sj.SPARE
            draw = sj.mix64(sj.mix64(whole + np.uint64(0xD6E8FEB86659FD93)) + np.array([band + 1], np.uint64) * sj._GOLD)
            part = ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(cuts * sj.PARTS) >> np.uint64(32)).astype(np.int64)
            count = np.bincount(part, minlength=cuts * sj.PARTS).reshape(-1, sj.PARTS)
            room = size - -(-per_cent * size // 100)
            gone = []
            for cut in np.argsort(count.sum(axis=1) - count.max(axis=1), kind="stable").tolist():  # those with the smallest subsets first
                for p in np.argsort(-count[cut], kind="stable")[:2].tolist():  # one shingle of each of two parts
                    gone += np.flatnonzero(part == cut * sj.PARTS + p)[:1].tolist()
            rest = np.delete(whole, gone[:room])
            if len(rest) == size:
                continue
            assert 100 * len(rest) >= per_cent * size
            row, key = sj.signatures(np.repeat([0, 1], [size, len(rest)]), np.concatenate((whole, rest)), 2, per_cent)
            assert len(np.intersect1d(key[row == 0], key[row == 1]))


def test_unrelated_large_sets_share_no_signature():
    rng = np.random.default_rng(12)
    row, key = sj.signatures(np.repeat(np.arange(120), 1500), rng.integers(0, 1 << 63, 120 * 1500).astype(np.uint64), 120, 80)
    assert len(np.unique(key)) == len(key) > 120 * 600


def test_profiles_fit_as_pair_by_pair():
    rng = np.random.default_rng(6)
    sizes = np.array([40, 50, 300, 310, 1000, 1100, 1100])
    found = sj.profiles(np.repeat(np.arange(7), sizes), rng.integers(0, 2**40, sizes.sum()).astype(np.uint64) << np.uint64(24), 7)
    found[6] = found[5]
    left, right = np.triu_indices(7, 1)
    for per_cent in (20, 80):
        want = [(100 + per_cent) * sj.profile_distance(found[i], found[j]) <= (100 - per_cent) * (sizes[i] + sizes[j]) for i, j in zip(left, right, strict=True)]
        assert sj.profiles_fit(found, sizes, left, right, per_cent).tolist() == want and any(want) and not all(want)
    assert not len(sj.profiles_fit([], sizes[:0], left[:0], right[:0], 80))


def test_like_sets_below_the_limit_make_no_pairs():
    """Groups of sets of similarity 0.6 used to leave all their pairs, once for each group."""
    rng = np.random.default_rng(7)
    base, n = rng.integers(0, 2**63, 300).astype(np.uint64), 40
    sets = [np.concatenate((base[rng.permutation(300)[:255]], rng.integers(0, 2**63, 45).astype(np.uint64))) for _ in range(n)]
    sets[1] = np.append(sets[0][:290], sets[1][-10:])
    rows, hashes = np.repeat(np.arange(n), [len(x) for x in sets]), np.concatenate(sets)
    one = {"cls": np.arange(n), "comp": np.arange(n), "n": [len(x) for x in sets], "cells": [c.tobytes() for c in sj.cell_counts(rows, hashes, n)], "p": sj.profiles(rows, hashes, n)}
    batch = sj.pa.RecordBatch.from_pydict({"key": np.repeat([3, 5], n)} | {k: [*v, *v] for k, v in one.items()})
    assert [b.to_pydict() for b in sj._paired(80)(iter([batch.slice(0, 50), batch.slice(50)])) if b.num_rows] == [{"a": [0], "b": [1]}] * 2
