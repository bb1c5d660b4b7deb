import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from readloom.llm import lattice_lm, mixing, pii, topk, toxicity
from readloom.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import WORD, ascii_lower, awkward, documents
from tests.llm.helpers import test_tables as tables_of
from tests.oracle import same

PIECES = P.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, sf_dir, name):
    same(spark, sf_dir, QUERIES[name], ORACLES[name])


# search


def test_top_k_with_ties_nulls_and_floods(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 1, 8).tolist()) for i in range(300)] + [(1000 + i, [0.5] * 8) for i in range(1500)]
    rows += [(5000, None), (5100, [1.0, None] + [0.0] * 6), (5200, [float("nan")] * 8), (5300, [float("inf")] * 8), (5400, [3.0]), (200, [0.1] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = sorted(map(tuple, topk.exact_top_k(df, F.col("vec_id") % 100 == 0).collect()))
    fine = [(i, [math.floor(1024 * x) for x in v] + [0] * (8 - len(v))) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for i, q in sorted(set((i, tuple(v)) for i, v in fine if i % 100 == 0)):
        if i == 200:
            continue
        best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in fine if j != i)[:10]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert [g for g in got if g[0] != 200] == sorted(want)
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.exact_top_k(few, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1024 * 3072 + 2048 * 4096)]
    assert topk.exact_top_k(few.limit(0), F.col("vec_id") == 0).count() == 0


# language model


def test_lattice_sums_all_segmentations():
    lat = lattice_lm.Lattice(PIECES)
    logp = lat.initial

    def brute(s, i):
        if i == len(s):
            return [logp[lat.stop]]
        out = []
        for j in range(i + 1, len(s) + 1):
            piece = s[i:j]
            if piece in lat.index:
                out += [logp[lat.index[piece]] + r for r in brute(s, j)]
        if i == 0:
            out += [logp[lat.start] + r for r in brute(s, 1)]
        else:
            c = s[i]
            out += [sum(logp[lat.byte + b] for b in c.encode()) + r for r in brute(s, i + 1)]
        return out

    words = ["the", "in", "qx", "été", "tion"]
    want = [np.logaddexp.reduce(brute("▁" + w, 0)) for w in words]
    assert np.allclose(lat.log_prob(words, logp), want)
    assert np.allclose([lat._long(w, logp) for w in words], want)
    assert np.isclose(lat.expected(["the"], logp)[lat.stop], 1.0)


def test_scores_and_base(spark):
    docs, empty, odd = tables_of(spark)
    rows = awkward()
    words = [WORD.findall(ascii_lower(t or "")) for _, t in rows]
    train = [zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    c = Counter(w for ws, k in zip(words, train, strict=True) if k for w in ws)
    ends = sum(train)
    n, v = sum(c.values()) + ends, len(c) + 1
    p = lambda x: math.log10((x + 0.5) / (n + 0.5 * (v + 1)))
    want = sorted((i, not k, len(ws) + 1, sum(c[w] > 0 for w in ws) + 1, n, round(sum(p(c[w]) for w in ws) + p(ends), 6)) for (i, _), ws, k in zip(rows, words, train, strict=True))
    got = lattice_lm.lm_scores(docs, PIECES).collect()
    assert sorted((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert lattice_lm.lm_scores(empty, PIECES).count() == 0
    assert lattice_lm.lm_scores(odd, PIECES).count() == 2


def segmentations(lat, logp, s, i=0):
    """Log probabilities of all ways to spell a marked word from ``i`` on."""
    if i == len(s):
        return [logp[lat.stop]]
    out = []
    for j in range(i + 1, len(s) + 1):
        if s[i:j] in lat.index:
            out += [logp[lat.index[s[i:j]]] + r for r in segmentations(lat, logp, s, j)]
    own = logp[lat.start] if i == 0 else sum(logp[lat.byte + b] for b in s[i].encode())
    return out + [own + r for r in segmentations(lat, logp, s, i + 1)]


def test_scores_are_sums_over_all_segmentations(spark):
    """The whole score written out: counts, discount, two re-estimations by all segmentations, mixture."""
    rows = [(i, t) for i, t in enumerate(["the cat sat on a mat", "A cat, the été", "on on the hat", "nice tion x", "", None, "the unseen zq Té", "cat"] * 2)]
    train = [zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    words = [WORD.findall(ascii_lower(t or "")) for _, t in rows]
    c = Counter(w for ws, k in zip(words, train, strict=True) if k for w in ws)
    ends = sum(train)
    n, v = sum(c.values()) + ends, len(c) + 1
    once, twice = (sum(x == k for x in c.values()) for k in (1, 2))
    d = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
    lat = lattice_lm.Lattice(PIECES)
    logp = lat.initial

    def spellings(s, i=0):
        if i == len(s):
            return [(lat.stop,)]
        out = [(lat.index[s[i:j]], *r) for j in range(i + 1, len(s) + 1) if s[i:j] in lat.index for r in spellings(s, j)]
        own = (lat.start,) if i == 0 else tuple(lat.byte + b for b in s[i].encode())
        return out + [(*own, *r) for r in spellings(s, i + 1)]

    for _ in range(lattice_lm.STEPS):
        uses = np.zeros(len(logp))
        for w in c:
            ways = spellings("\u2581" + w)
            p = np.array([math.exp(sum(logp[x] for x in way)) for way in ways])
            for way, q in zip(ways, p / p.sum(), strict=True):
                for x in way:
                    uses[x] += q
        logp = lat.normal(uses)
    prob = lambda w: max(c[w] - d, 0) / n + d * v / n * math.exp(np.logaddexp.reduce(segmentations(lat, logp, "\u2581" + w)))
    want = sorted((i, round(sum(math.log10(prob(w)) for w in ws) + math.log10(ends / n), 6)) for (i, _), ws in zip(rows, words, strict=True))
    got = lattice_lm.lm_scores(documents(spark, rows), PIECES).collect()
    assert np.allclose([s for _, s in sorted((r["doc_id"], r["score"]) for r in got)], [s for _, s in want], atol=2e-6)


def test_lattice_gives_all_words_one_at_most():
    lat = lattice_lm.Lattice(PIECES)
    p = np.exp(lat.initial)
    assert np.isclose(p[lat.first].sum(), 1.0) and np.isclose(p[~lat.first].sum(), 1.0)


def test_complementary_words_are_two(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    rows = [(i, one) for i in range(20)] + [(100 + i, one.translate({97: "b", 98: "a"})) for i in range(20) if zlib.crc32(str(100 + i).encode()) % 5 == 1]
    got = lattice_lm.lm_scores(documents(spark, rows), PIECES).collect()
    assert {(r["doc_id"] < 100, r["n_known"]) for r in got} == {(True, 2), (False, 1)}


def test_known_words_against_base(spark, sf_dir):
    """On known words of held-out texts, with the mass for unknown words put aside, the model is no worse than the base."""
    rows = [(r[0], WORD.findall(ascii_lower(r[1] or ""))) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    c = Counter(w for i, ws in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    got = {r["doc_id"]: r for r in lattice_lm.lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), PIECES).collect()}
    n = next(iter(got.values()))["train_tokens"]
    once, twice = (sum(x == k for x in c.values()) for k in (1, 2))
    aside = once / (once + 2 * twice) * len(c) / n
    whole = [(i, ws) for i, ws in rows if got[i]["held_out"] and all(w in c for w in ws)]
    score, base, tokens = (sum(x) for x in zip(*((got[i]["score"], got[i]["base_score"], len(ws)) for i, ws in whole), strict=True))
    assert tokens > 20 and score - tokens * math.log10(1 - aside) >= base - 0.01 * abs(base)


# toxicity


def test_folding_and_exceptions():
    m = toxicity.ToxicModel({toxicity.fold("idiot").strip(): 4.0}, [toxicity.fold("idiot proof").strip()], (-3.0, 2.0, 0.5))
    for t in ("you idiot", "YOU ID1OT", "an іdіоt", "1d10t!", "idiots"):
        assert m.score(t) > 0.5, t
    for t in ("idiot proof plan", "nonidiot", "", None, "fine words", "x" * 100_000):
        assert m.score(t) < 0.5, t
    assert m.score("idiot") > m.score("idiot " + "and much else " * 400)


def plain_score(model, text):
    """The score by looking for every entry and phrase at every place."""
    folded = toxicity.fold(text or "")
    spots = lambda e: [i for i in range(len(folded)) if folded.startswith(" " + e, i)]
    free = [(i, i + len(e) + 1) for e in model.exceptions for i in spots(e)]
    best = {}
    for entry, w in model.weights.items():
        for i in spots(entry):
            if not any(a <= i and i + len(entry) + 1 <= b for a, b in free):
                best[i] = max(best.get(i, 0.0), w)
    total = sum(best.values())
    x = model.coef[0] + model.coef[1] * math.log1p(total) + model.coef[2] * math.log1p(1000 * total / len(folded))
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def test_scores_equal_a_plain_scan(spark):
    w = {toxicity.fold(e).strip(): k for e, k in (("idiot", 4.0), ("idio", 2.5), ("lazy dog", 3.0), ("dog", 1.5), ("quiet", 2.0))}
    model = toxicity.ToxicModel(w, [toxicity.fold(p).strip() for p in ("idiot proof", "quietly mix")], (-3.0, 2.0, 0.5))
    rows = [*awkward(), (50, "id10t idi0t-proof IDIOT proof idiots; lazy dog dogs quietly mixing quiet")]
    rows = [(i, (t or "")[:3000]) for i, t in rows]
    got = sorted((r["doc_id"], round(r["score"], 12)) for r in toxicity.score_toxicity(documents(spark, rows), model).collect())
    assert got == sorted((i, round(plain_score(model, t), 12)) for i, t in rows)


def test_no_entry_is_left_out(spark):
    words = [f"{a}{b}{c}x" for a in "bcdfgh" for b in ("ara", "ere", "oro", "unu") for c in "klmnprstvw"]
    rows = [(i, " ".join(words[(i * 40) % 240 :][:40])) for i in range(48)] + [(100 + i, f"plain harmless text number {i} of many about w{i} and v{i * 7}") for i in range(200)]
    labels = spark.createDataFrame([(i, i < 100) for i, _ in rows], "doc_id long, toxic boolean")
    words = [f"{w}{'yz'[k % 2]}{k}" for k, w in enumerate(words)]
    rows = [(i, t if i >= 100 else t + f" own{i} more{i * 3} yet{i * 7} end{i * 11} so{i}a") for i, t in rows]
    model = toxicity.fit_toxicity(documents(spark, rows), labels)
    assert sum(any(f"{a}{b}{c}x"[: len(e)] == e for e in model.weights) for a in "bcdfgh" for b in ("ara", "ere", "oro", "unu") for c in "klmnprstvw") == 240


def test_toxicity_is_learned(spark):
    rng = np.random.default_rng(3)
    words = [f"{a}{b}{c}" for a in ("the", "on", "er", "in") for b in ("ha", "nd", "st", "re") for c in ("tion", "ing", "ou", "ly")]
    rows, labels = [], []
    for i in range(600):
        ws = rng.choice(words, 40).tolist()
        bad = i % 6 == 0
        if bad:
            ws[int(rng.integers(40))] = ["grumbol", "gr0mple", "zortek" + "aeiou"[i % 5]][i % 3]
        rows.append((i, " ".join(ws)))
        labels.append((i, int(bad)))
    docs = documents(spark, rows)
    lab = spark.createDataFrame([*labels, (0, 1), (None, 1), (9999, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, toxicity.training_labels(lab))
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    held = [i for i, _ in rows if got[i]["held_out"]]
    assert len(held) > 80 and all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in rows)
    assert np.mean([got[i]["predicted"] == labels[i][1] for i in held]) >= 0.97
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in got.values())
    awk, empty, odd = tables_of(spark)
    assert toxicity.score_toxicity(awk, model).count() == len(awkward())
    assert toxicity.score_toxicity(odd, toxicity.fit_toxicity(empty, lab)).count() == 2


# mixing


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > 2 * sizes[s]] if open_ else []
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            open_.discard(s)
        left -= sum(2 * sizes[s] for s in over)


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    rng = np.random.default_rng(6)
    rows = awkward() + [(1000 + i, " ".join(["w"] * int(rng.integers(0, 60)))) for i in range(400)]
    docs = documents(spark, rows)
    first = mixing.mix(docs).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, mixing.mix(docs.repartition(3)).collect()))
    sizes, taken = Counter(), Counter()
    for r in first:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    want = brute_targets(sizes)
    for r in first:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
    for s in sizes:
        own = [r["size"] for r in first if r["source"] == s and r["size"]]
        # blocks of 16 can't take up a document that is much larger than they are; rounding to the nearer side loses half of it at most
        stuck = max(own) / 2 if max(own) > sum(own) / 8 else 0
        assert abs(taken[s] - want[s]) <= max(0.01 * want[s], min(own)) + stuck, s
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in first)
    _, empty, odd = tables_of(spark)
    assert mixing.mix(empty).count() == 0 and mixing.mix(odd).count() == 2


def test_rounding_keeps_expectations():
    rng = np.random.default_rng(2)
    sizes, fracs = sorted(rng.integers(10, 60, 40).tolist(), reverse=True), rng.uniform(0.1, 0.9, 40).tolist()
    total, words = np.zeros(40), []
    for seed in range(2000):
        taken = mixing.settle([(i,) for i in range(40)], sizes, fracs, seed, True)[0]
        total += taken
        words.append(np.dot(taken, sizes))
    assert np.abs(total / 2000 - fracs)[:20].max() < 0.06  # the last ones may be steered
    assert np.abs(np.array(words) - np.dot(sizes, fracs)).max() <= sizes[-1]


def test_targets_are_met_at_scale(spark):
    """The sources of the test table, each within 1 % or its smallest document."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least")).collect()
    assert len(got) > 5 and all(abs(r["taken"] - r["target"]) <= max(0.01 * r["target"], r["least"]) for r in got), got


# personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    import re

    out = []
    for kind, rx in BASE.items():
        for m in re.finditer(rx, text or ""):
            d = [int(c) for c in m[0] if c.isdigit() and c.isascii()]
            luhn = sum(x if k % 2 == 0 else (2 * x - 9 * (x > 4)) for k, x in enumerate(reversed(d))) % 10 == 0
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn, "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_stay(spark):
    odd = [
        "é😀 a@b.c a@b.c_d@e.f @x.y a@b a@b. a@-.- x@y.z.", "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4 999.1.2.3.4 1..2.3.4",
        "4111111111111111 4111-1111-1111-1111 4111 1111 1111 1112 41111111111111111111", "+12345678 +1 ( 2 ) 3-4.5 6789 +1 23 +123456789012345678 ++4912345678", "", "7" * 5000, "a" * 3000 + "@b.c",
        "write to jane at example dot com or 4111.1111.1111.1111",
    ]
    rows = awkward() + [(100 + i, t) for i, t in enumerate(odd)]
    got = pii.pii_digest(documents(spark, rows)).collect()
    want = Counter((i, tuple(base_spans(t))) for i, t in rows)
    import hashlib

    seen = Counter()
    for r in got:
        own = next(w for w in want if w[0] == r["doc_id"])
        seen[own] += 1
        assert r["base_sha256"] == hashlib.sha256(",".join(own[1]).encode()).hexdigest(), own
        assert set(own[1]) <= set(r["spans"].split(",")) | {""}
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in own[1]) for k in pii.KINDS]
    assert seen == want
    _, empty, null = tables_of(spark)
    assert pii.pii_digest(empty).count() == 0 and pii.pii_digest(null).count() == 2


def test_trees_separate_counted_candidates():
    rows = [((0, 3, 1, 0, 0, b, 0, 4, c), 50 * (b == 0 and c), 50 * (b != 0 or not c)) for b in range(5) for c in (0, 1)]
    trees = pii.boost(rows)
    limit = pii.calibrated_limit(rows, trees)[0]
    assert all((sum(pii.leaf(t, x) for t in trees) >= limit) == (p > n) for x, p, n in rows)
    assert pii.calibrated_limit([], pii.boost([]))[0] == math.inf


def test_redaction(spark):
    rows = [(1, "é mail a@b.cd, ip 1.2.3.4!"), (2, None), (3, "x@y.zz"), (3, "none"), (None, "so q@r.st"), (None, "q")]
    out = pii.redacted(documents(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in out) == [("1", "é mail [email], ip [ip]!"), ("2", ""), ("3", "[email]"), ("3", "none"), ("None", "q"), ("None", "so [email]")]


def test_announced_notations_are_found_elsewhere(spark):
    """Spelled-out addresses and plain phone numbers that follow such words often are found without them; other numbers are not."""
    names = ["ann", "bo", "cy", "dee", "eli"]
    rows = [(i, f"please mail {names[i % 5]}{i} [at] example{i} [dot] org and phone 555-{1000 + i}-{2000 + i % 7} soon") for i in range(80)]
    rows += [(200 + i, f"the total of items {3_000_000 + 7919 * i} was {10 + i}.{i % 10} in all") for i in range(200)]
    rows += [(500, "so cy32 [at] example32 [dot] org it is"), (501, "or 555-1234-2005 then"), (502, "items 3456789 again"), (503, "x@y.zz and jane at home")]
    got = {r["doc_id"]: r["spans"] for r in pii.pii_digest(documents(spark, rows)).collect()}
    assert got[500] == "email:3:32" and got[501] == "phone:3:16" and got[502] == "" and got[503] == "email:0:6"
    assert all(got[i].count("email:") == 1 and got[i].count("phone:") == 1 for i in range(80)) and not any(got[200 + i] for i in range(200))


def test_long_runs_of_repeating_shapes(spark):
    """Very long matches and runs that nearly match take neither stack nor quadratic time; spans are those of Python's patterns."""
    shapes = ["a.", "a dot ", "1.", "-2", "1 ", "(", "(1", "+1", ". ", "a@", "a@b.c ", " at ", "1" * 30 + " ", "[.]1"]
    rows = [(i, "x@" * (i % 2) + s * (120_000 // len(s)) + "com") for i, s in enumerate(shapes)]
    rows += [(90, "x@" + "a." * 500_000 + "com"), (91, "bob at " + "a dot " * 170_000 + "com"), (92, "call 209-555-1594 or (209) 555 1594, " + "2" * 25 + " or " + "5-" * 12 + "1")]
    got = {r["doc_id"]: r for r in pii.pii_digest(documents(spark, rows).repartition(4)).collect()}
    assert len(got) == len(rows)
    assert got[90]["n_email"] == 1 and got[90]["spans"].split(",")[0] == f"email:0:{len(rows[-3][1])}"
    assert [got[i]["n_email"] for i in (10, 11)] == [120_000 // 6, 0] and got[2]["n_ip"] == 120_000 // 2 // 4
    wide = {r["doc_id"]: [(w["kind"], w["at"], w["to"]) for w in r["wide"]] for r in pii.find_candidates(documents(spark, rows[-2:])).collect()}
    assert (0, 0, len(rows[-2][1])) in wide[91]
    assert [w[1:] for w in wide[92] if w[0] == 3] == [(5, 17), (21, 35), (37, 62), (66, 91)]
