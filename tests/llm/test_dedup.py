import hashlib

import numpy as np
import pytest

from readloom.llm import exact_dedup as ex
from readloom.llm import near_dedup as near
from readloom.llm.components import components
from tests.llm.helpers import SPACE, WORD, ascii_lower, awkward, documents
from tests.llm.helpers import test_tables as tables_of


def norm(t):
    return SPACE.sub(" ", t or "")


def test_directory_doubles_until_no_bucket_is_overfull():
    cells = {0: 50, 1: 3, 2: 1, 7: 60}
    d = ex.grow_directory(cells, 3, 55)
    assert len(d) == 8 and d[7] != d[0] and (np.diff(d) >= 0).all()
    assert ex.grow_directory({}, 0, 10).tolist() == [0]


@pytest.mark.parametrize("capacity", [2, None])
def test_exact(spark, capacity):
    docs, empty, odd = tables_of(spark)
    groups = {}
    for i, t in awkward():
        groups.setdefault(norm(t), []).append(i)
    want = sorted((i, min(g := groups[norm(t)]), len(g), i == min(g), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in awkward())
    assert sorted(map(tuple, ex.exact_dedup(docs, capacity=capacity).collect())) == want
    assert ex.exact_dedup(empty).count() == 0
    assert sorted((r["doc_id"] or -1, r["kept"]) for r in ex.exact_dedup(odd).collect()) == [(-1, True), (1, True)]
    kept = ex.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {w[0] for w in want if w[3]}


def test_buckets_are_owned_by_key_ranges(spark, tmp_path):
    docs = documents(spark, [(i, f"text {i % 1500}") for i in range(2000)])
    plain = docs.select("doc_id", "text")
    path = f"file://{tmp_path}/index"
    ex.build_index(plain, plain.mapInArrow(ex._keys, "doc_id long, h long, sha binary"), path, 50)
    directory = spark.read.parquet(f"{path}/directory").orderBy("cell").collect()
    depth = len(directory).bit_length() - 1
    index = spark.read.parquet(f"{path}/buckets").collect()
    assert len(index) == 1500 and sum(r["group_size"] for r in index) == 2000
    held = {}
    for r in index:
        assert directory[(r["h"] & 0xFFFFFFFFFFFFFFFF) >> (64 - depth)]["bucket"] == r["bucket"]
        held[r["bucket"]] = held.get(r["bucket"], 0) + 1
    assert max(held.values()) <= 50
    owners = [r["owner"] for r in directory]
    assert owners == sorted(owners) and len(set(owners)) > 1


def test_hot_groups_are_joined_by_broadcast(spark):
    rows = [(i, "the same" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    got = {r["doc_id"]: r for r in ex.exact_dedup(documents(spark, rows)).collect()}
    assert len(got) == 3000 and all(got[i]["keep_id"] == (0 if i % 3 == 0 else i) and got[i]["group_size"] == (1000 if i % 3 == 0 else 1) for i in got)


def test_chains_compare_bytes():
    import pyarrow as pa

    rows = [(7, 0, bytes([k]), t, d, n) for k, t, d, n in ((1, b"a", 5, 1), (2, b"b", 3, 2), (1, b"a", 1, 4))]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["h", "bucket", "sha", "norm", "keep_id", "n"])
    out = [r for b in ex._chains(iter([batch])) for r in b.to_pylist()]
    assert [(r["chain"], r["keep_id"], r["group_size"]) for r in out] == [(0, 1, 5), (1, 3, 2)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (7, 8), (8, 6), (3, 10), (20, 21), (21, 22), (22, 23), (23, 24)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {2: 1, 3: 1, 10: 1, 5: 4, 7: 6, 8: 6, 21: 20, 22: 20, 23: 20, 24: 20}


def shingles(t, width=2):
    w = WORD.findall(ascii_lower(t or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width=2):
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), top(i), top(i) == i) for i, s in sets)


def edited(rng, words, n):
    out = list(words)
    for at in rng.choice(len(out), n, replace=False):
        out[at] = f"new{rng.integers(1000)}"
    return " ".join(out)


def test_near_classes_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = awkward()
    for g in range(8):  # groups of copies with few to many edits, chains among them
        words = [f"g{g}w{rng.integers(300)}" for _ in range(120)]
        for k in range(14):
            rows.append((100 + g * 20 + k, edited(rng, words, int(rng.integers(0, 9)))))
            if k % 4 == 3:
                words = edited(rng, words, 6).split(" ")
    docs = documents(spark, rows)
    got = sorted(map(tuple, near.near_classes(docs, width=2).collect()))
    assert got == brute(rows)
    kept = near.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted({r["doc_id"] for r in kept.collect()}) == [w[0] for w in dict.fromkeys(brute(rows, 5)) if w[3]]


def test_blocks_of_the_search_miss_nothing(spark, monkeypatch):
    """Without pivots and in tiny blocks the complete search alone finds every link."""
    monkeypatch.setattr(near, "ROUNDS", ())
    monkeypatch.setattr(near, "BLOCK", 3)
    monkeypatch.setattr(near, "TEXT_BLOCK", 2)
    monkeypatch.setattr(near, "TEXT_BYTES", 2000)
    rng = np.random.default_rng(9)
    rows = []
    for g in range(3):
        words = [f"g{g}w{rng.integers(300)}" for _ in range(100)]
        rows += [(g * 20 + k, edited(rng, words, int(rng.integers(0, 9)))) for k in range(9)]
    assert sorted(map(tuple, near.near_classes(documents(spark, rows), width=2).collect())) == brute(rows)


def test_ids_that_are_null_or_stand_on_several_texts(spark):
    base = " ".join(f"w{i}" for i in range(100))
    other = " ".join(f"v{i}" for i in range(100))
    rows = [(None, base + " more"), (1, base), (7, base + " tail"), (7, other), (9, other + " end"), (None, "quite alone here"), (None, "quite alone here"), (3, None), (None, "")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near.near_classes(documents(spark, rows), width=2).collect()), key=str)
    want = [(None, 100, 1, False), (1, 99, 1, True), (7, 100, 1, False), (7, 99, 7, True), (9, 100, 7, False), (None, 2, None, True), (None, 2, None, True), (3, 0, 3, True), (None, 0, None, True)]
    assert got == sorted(want, key=str)
    kept = sorted((str(r["doc_id"]), r["text"]) for r in near.drop_near_copies(documents(spark, rows), width=2).collect())
    assert kept == sorted((str(i), t) for i, t in (rows[1], rows[3], *rows[5:]))


@pytest.mark.parametrize("n", [1024, 2048])
def test_complementary_words_share_nothing(spark, n):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    rows = [(0, one + " x"), (5, one.translate({97: "b", 98: "a"}) + " x")]
    got = sorted(map(tuple, near.near_classes(documents(spark, rows), width=2).collect()))
    assert got == [(0, 1, 0, True), (5, 1, 5, True)]


def test_second_hash_tells_shingles_apart(monkeypatch):
    import pyarrow as pa

    real = near.span_hashes
    monkeypatch.setattr(near, "span_hashes", lambda d, s, e, seed: np.full(len(s), 5, np.uint64) if seed == near._SEEDS[0] else real(d, s, e, seed))
    batch = pa.RecordBatch.from_arrays([pa.array(["a b c d", "a b x d", "a b c d e"])], ["text"])
    x, y, z = near._sets_of(batch, 0, 2)
    assert [len(s[0]) for s in (x, y, z)] == [3, 3, 4]
    assert not near.linked(x, y) and near.linked(x, z, 75) and not near.linked(x, z, 76)


def test_near_on_empty_and_null(spark):
    _, empty, odd = tables_of(spark)
    assert near.near_classes(empty).count() == 0
    assert near.near_classes(odd).count() == 2
    assert near.drop_near_copies(empty).columns == empty.columns and near.drop_near_copies(empty).count() == 0


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    for share in (0.5, 0.8, 0.95):
        both = int(4000 * 2 * share / (1 + share))
        b = np.concatenate((a[:both], rng.integers(0, 2**63, 4000 - both, dtype=np.uint64)))
        s = near.set_sketches(np.repeat([0, 1], 4000), np.concatenate((a, b)), 2)
        same = (s[0] == s[1]).mean()
        assert abs(same - share) < 5 * (share * (1 - share) / near.REGISTERS) ** 0.5 + 0.01
        ok = near.maybe_linked(s[:1], s[1:], np.array([4000]), np.array([4000]))[0]
        assert ok or share < 0.8
    merged = near.set_sketches(np.zeros(8000, np.int64), np.unique(np.concatenate((a, b)))[np.arange(8000) % len(np.unique(np.concatenate((a, b))))], 1)
    assert (merged[0] == np.maximum(s[0], s[1])).all()
