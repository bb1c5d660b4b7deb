import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from readloom.llm import token_counts, token_shards, word_bpe
from readloom.llm.shared import new_path
from tests.llm.helpers import awkward, documents
from tests.llm.helpers import test_tables as tables_of

PIECES, WORDS = P.path("piece_bpe_32k.model"), P.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(WORDS)
SP = sentencepiece.SentencePieceProcessor(model_file=PIECES)
TEXTS = [t or "" for _, t in awkward()]
LETTERS = st.text(alphabet=st.sampled_from(list("abeinorst THE.,!'\n\t▁é日Σ́😀<|>\x1c")), max_size=40)


def lib_ids(texts):
    return [e.ids for e in LIB.encode_batch(texts, add_special_tokens=False)]


def test_counts_of_all_prefixes():
    m = token_counts.model(PIECES)
    for t in [*TEXTS, " " * 30 + "x", "a" * 50]:
        if len(t) < 300:
            assert m.prefix_counts(t).tolist() == [len(SP.encode(t[:i])) for i in range(len(t) + 1)]
    assert m.count_all(TEXTS) == [len(SP.encode(t)) for t in TEXTS]


@settings(max_examples=200, deadline=None)
@given(LETTERS)
def test_counts_of_any_text(t):
    assert token_counts.model(PIECES).count_all([t]) == [len(SP.encode(t))]


def test_budget_cuts():
    m = token_counts.model(PIECES)
    for budget in (0, 1, 7, 100):
        for t in TEXTS:
            n = m.fits(t, budget)
            assert len(SP.encode(t[:n])) <= budget
            assert n == len(t) or len(t) > 300 or all(len(SP.encode(t[:i])) > budget for i in range(n + 1, len(t) + 1))


def test_count_operator(spark):
    docs, empty, odd = tables_of(spark)
    got = sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.count_tokens(docs, PIECES).collect())
    want = sorted((i, len((t or "").encode()), n := len(SP.encode(t or "")), n > 4096) for i, t in awkward())
    assert got == want
    assert token_counts.count_tokens(empty, PIECES).count() == 0
    assert token_counts.count_tokens(odd, PIECES, with_prefix_counts=True).count() == 2


@settings(max_examples=200, deadline=None)
@given(LETTERS)
def test_encoding_of_any_text(t):
    ids, offsets = word_bpe.encoder(WORDS).encode_all([t, t + "."])
    assert ids[: offsets[1]].tolist() == lib_ids([t])[0] and ids[offsets[1] :].tolist() == lib_ids([t + "."])[0]
    assert word_bpe.encoder(WORDS).decode_all(ids, offsets)[0].decode() == LIB.decode(lib_ids([t])[0], skip_special_tokens=False)


def test_transducer(tmp_path):
    e = word_bpe.WordEncoder(WORDS)
    words = sorted({w.encode() for w in "the then them other mother brother a ab abc tion nation ration".split()})
    ids, sizes = e.merge_words(words)
    (tmp_path / "lex").write_bytes(word_bpe.Lexicon.build(words, ids, sizes))
    lex = word_bpe.Lexicon(str(tmp_path / "lex"))

    def numbers(words):
        n = np.array([len(w) for w in words])
        return lex.numbers(np.frombuffer(b"".join(words), np.uint8), np.cumsum(n) - n, n)

    assert numbers(words).tolist() == list(range(len(words)))
    got, count = lex.outputs(np.arange(len(words)))
    assert got.tolist() == ids.tolist() and count.tolist() == sizes.tolist()
    assert numbers([b"", b"th", b"thee", b"zzz", b"\xff"]).tolist() == [-1] * 5
    assert len(lex.first) - 1 < sum(map(len, words))  # suffixes are shared
    long = b"ab" * 300
    assert e._merge_long(long).tolist() == e._merge_same_length(np.frombuffer(long, np.uint8)[None])[0].tolist()


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(word_bpe, "MEMO", 5)
    e = word_bpe.WordEncoder(WORDS)
    for t in TEXTS * 2:
        assert e.encode_all([t])[0].tolist() == lib_ids([t])[0]


@pytest.mark.parametrize("most", [0, 50])
def test_encode_operator(spark, most):
    docs, empty, odd = tables_of(spark)
    lexicon = word_bpe.compile_lexicon(docs, WORDS, most)
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in word_bpe.encode_documents(docs, WORDS, lexicon).collect())
    want = []
    for (i, _), ids in zip(awkward(), lib_ids(TEXTS), strict=True):
        text = LIB.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    assert word_bpe.encode_documents(empty, WORDS, word_bpe.compile_lexicon(empty, WORDS)).count() == 0
    assert word_bpe.encode_documents(odd, WORDS).count() == 2


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 5000))
    h = token_shards.PerfectHash.build(keys)
    assert sorted(h.values(keys).tolist()) == list(range(len(keys)))
    assert token_shards.PerfectHash.build(np.zeros(0, np.int64)).values(np.array([1])).tolist() == [-1]


@pytest.mark.parametrize("size", [64, 1 << 20])
def test_shards(spark, monkeypatch, size):
    monkeypatch.setattr(token_shards, "SHARD_BYTES", size)
    monkeypatch.setattr(token_shards, "RANGE_DOCS", 4)
    monkeypatch.setattr(token_shards, "LEAST_DOCS", 3)
    docs, empty, odd = tables_of(spark)
    path = new_path(spark, "t")
    token_shards.write_shards(docs, WORDS, path)
    got = [tuple(r) for r in token_shards.read_shards(spark, path).orderBy("start", "doc_id").collect()]
    rows = sorted(zip([i for i, _ in awkward()], lib_ids(TEXTS), strict=True))
    start, want = 0, []
    for i, ids in rows:
        raw = np.array([*ids, 1], "<u4").tobytes()
        want.append((i, start, len(ids) + 1, zlib.crc32(raw)))
        start += len(ids) + 1
    assert got == want
    keys = spark.createDataFrame([(15,), (6,), (99,), (-5,), (None,)], "doc_id long")
    found = sorted((r["doc_id"], len(r["ids"]) // 4) for r in token_shards.lookup(spark, path, keys).collect())
    n15 = next(len(ids) + 1 for i, ids in rows if i == 15)
    assert found == [(6, 1), (15, n15), (15, n15)]
    assert token_shards.shard_round_trip(empty, WORDS).count() == 0
    back = [tuple(r)[:3] for r in token_shards.shard_round_trip(odd, WORDS).orderBy("start").collect()]
    assert back[0][:2] == (None, 0) and back[1] == (1, back[0][2], 1)


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [8, 1024, 4096])
def test_complementary_words_stay_apart(spark, n):
    one = thue_morse(n)
    two = one.translate({97: "b", 98: "a"})
    texts = [f"{one} x", f"{two} x", f"{one} {two}"]
    ids, offsets = word_bpe.WordEncoder(WORDS).encode_all(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == lib_ids(texts)
    docs = documents(spark, list(enumerate(texts)))
    back = [r["ids_crc32"] for r in token_shards.shard_round_trip(docs, WORDS).orderBy("start").collect()]
    assert back == [zlib.crc32(np.array([*i, 1], "<u4").tobytes()) for i in lib_ids(texts)]


def test_hashes_only_find_words(monkeypatch):
    """All spans under one hash: bytes must decide."""
    from readloom.llm import bytesops

    monkeypatch.setattr(bytesops, "span_hashes", lambda data, start, end, seed=0: np.full(len(start), 7, np.uint64))
    e = word_bpe.WordEncoder(WORDS)
    for _ in range(2):
        ids, offsets = e.encode_all(TEXTS)
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == lib_ids(TEXTS)


def test_one_id_on_ten_thousand_rows(spark, monkeypatch):
    monkeypatch.setattr(token_shards, "RANGE_DOCS", 1000)
    monkeypatch.setattr(token_shards, "SHARD_BYTES", 2000)
    rows = [(None if i % 3 == 0 else 7, f"w{i % 500} and {i % 7}") for i in range(10_000)] + [(8, "last one"), (1, "first")]
    docs = documents(spark, rows)
    path = new_path(spark, "hot")
    token_shards.write_shards(docs, WORDS, path)
    heads = spark.read.parquet(path).select("range", "docs").collect()
    held = {}
    for r in heads:
        held[r["range"]] = held.get(r["range"], 0) + r["docs"]
    assert len(held) > 4 and max(held.values()) < 3000
    got = token_shards.read_shards(spark, path).orderBy("start").collect()
    ids = lib_ids([t for _, t in rows])
    assert sorted((r["doc_id"] or -1, r["ids_crc32"]) for r in got) == sorted((d or -1, zlib.crc32(np.array([*i, 1], "<u4").tobytes())) for (d, _), i in zip(rows, ids, strict=True))
    total, keys = 0, []
    for r in got:
        assert r["start"] == total
        total += r["n_tokens"]
        keys.append(-1 if r["doc_id"] is None else r["doc_id"])
    assert keys == sorted(keys)
    want = spark.createDataFrame([(7,), (8,), (3,), (None,)], "doc_id long")
    found = token_shards.lookup(spark, path, want).groupBy("doc_id").count().collect()
    assert {tuple(r) for r in found} == {(7, sum(d == 7 for d, _ in rows)), (8, 1)}
