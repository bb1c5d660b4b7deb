import zlib

import numpy as np
import public_tokenizers as P

from readloom.llm import lattice_lm
from tests.llm.helpers import documents

PIECES = P.path("piece_bpe_32k.model")


def _uneven(lat):
    return lat.normal(np.random.default_rng(4).uniform(0.1, 1.0, lat.n + 258))


def test_characters_outside_the_pieces_cost_all_their_bytes():
    lat = lattice_lm.Lattice(PIECES)
    logp = _uneven(lat)
    known = {c for p in lat.pieces for c in p}
    odd = [chr(c) for c in (*range(0x80, 0x800, 7), *range(0x3000, 0xD000, 331), 0xD800, 0xFFFF, *range(0x10000, 0x110000, 9973)) if chr(c) not in known]
    assert {len(c.encode("utf-8", "surrogatepass")) for c in odd} == {2, 3, 4}
    want = [logp[lat.start] + sum(logp[lat.byte + b] for b in c.encode("utf-8", "surrogatepass")) + logp[lat.stop] for c in odd]
    assert np.allclose(lat.log_prob(odd, logp), want)
    assert np.allclose([lat._long(c, logp) for c in odd], want)
    uses = lat.expected([odd[0]], logp)
    assert all(np.isclose(uses[lat.byte + b], 1.0) for b in odd[0].encode())


def test_price_of_an_unseen_word_grows_with_its_length(spark):
    rng = np.random.default_rng(6)
    odd = lambda n: "".join(chr(c) for c in rng.integers(0xA000, 0xA400, n))
    out = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    rows = [(i, "some plain words to learn from") for i in range(50) if i != out] + [(out, odd(300)), (out, odd(600)), (out, odd(1200))]
    got = sorted(-r["score"] for r in lattice_lm.lm_scores(documents(spark, rows), PIECES).filter(f"doc_id = {out}").collect())
    assert 1.8 < got[1] / got[0] < 2.2 and 1.8 < got[2] / got[1] < 2.2


def test_long_training_words_count():
    lat = lattice_lm.Lattice(PIECES)
    logp = lat.initial
    short, long = "tion" * 8, "tion" * 60
    assert len(short) <= lattice_lm.WIDE < len(long)
    one, want = np.zeros(len(logp) + 1), lat.expected([short], logp)
    lat._long_expected(short, logp.tolist(), one)
    assert np.allclose(one[:-1], want)
    uses = lat.expected([long, "the"], logp)
    assert np.isclose(uses[lat.stop], 2.0)
    covered = sum(n * len(p) for p, n in zip(lat.pieces, uses, strict=False)) + uses[lat.start] + uses[lat.byte : lat.stop].sum()
    assert np.isclose(covered, len(long) + len("the") + 2)  # every character and both start marks once


def test_expected_uses_where_products_vanish():
    lat = lattice_lm.Lattice(PIECES)
    weight = np.ones(lat.n + 258)
    weight[lat.byte : lat.stop] = 0
    weight[lat.n - 1] = 1e9
    logp = lat.normal(weight)
    word = "\ua015" * 32
    assert np.isclose(lat.expected([word, "the"], logp)[lat.stop], 2.0)
    assert np.isclose(lat.expected([word], logp)[lat.byte + 0xEA], 32.0)


def test_training_learns_from_long_words_only(spark):
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 != 1][:20]
    out = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    word = "ququqaquq"
    score = lambda size: lattice_lm.lm_scores(documents(spark, [(i, word * size + str(i)) for i in ids] + [(out, word)]), PIECES).filter(f"doc_id = {out}").first()["score"]
    assert abs(score(3) - score(12)) < 3.0
