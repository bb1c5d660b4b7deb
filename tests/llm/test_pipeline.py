from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as cp
from readloom.llm import mixing
from readloom.llm.shared import stored
from readloom.llm.toxicity import fit_toxicity, fold, training_labels
from tests.llm.helpers import SPACE, awkward, documents
from tests.llm.test_dedup import brute
from tests.llm.test_models import brute_targets, plain_score
from tests.llm.test_tokens import LIB, lib_ids


def keys(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


def brute_exact(rows):
    """Rows whose id is the smallest among equal texts."""
    least = {}
    for i, t in rows:
        k = SPACE.sub(" ", t or "")
        least[k] = min(least.get(k, float("inf")), float("inf") if i is None else i)
    return Counter((i, t) for i, t in rows if (float("inf") if i is None else i) == least[SPACE.sub(" ", t or "")])


def brute_near(rows):
    """The smallest document of each component of five-word shingles."""
    kept = {i for i, _, _, k in brute(rows, 5) if k}
    return Counter((i, t) for i, t in rows if i in kept)


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    own, stages = docs.columns, dict(cp.STAGES)
    model = fit_toxicity(docs, training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    a = stored(stages["toxicity"](spark, docs, sf_dir), "t")
    left = [(r["doc_id"], r["text"]) for r in a.collect()]
    assert a.columns == own and Counter(left) == Counter((i, t) for i, t in rows if plain_score(model, t) < 0.5)
    b = stored(stages["exact_copies"](spark, a, sf_dir), "t")
    assert b.columns == own and keys(b.collect()) == brute_exact(left)
    left = [(r["doc_id"], r["text"]) for r in b.collect()]
    c = stored(stages["near_copies"](spark, b, sf_dir), "t")
    assert c.columns == own and keys(c.collect()) == brute_near(left)
    d = stored(stages["mixing"](spark, c, sf_dir), "t")
    size = lambda t: len([w for w in SPACE.split(t or "") if w])
    before, after = c.collect(), d.collect()
    sizes, taken, least = Counter(), Counter(), {}
    for r in before:
        sizes[r["source"]] += size(r["text"])
        least[r["source"]] = min(least.get(r["source"], 10**9), size(r["text"]) or 10**9)
    for r in after:
        taken[r["source"]] += size(r["text"])
    want = brute_targets(sizes)
    times, there = keys(after), keys(before)
    assert d.columns == own and all(times[k] <= 2 * there[k] for k in times)
    lone = Counter(r["source"] for r in before)
    for s in sizes:
        assert lone[s] < 4 or abs(taken[s] - want[s]) <= max(0.1 * want[s], least[s]), s  # nine documents a source
    e = stages["encoding"](spark, d, sf_dir).collect()
    assert len(e) == len(after)
    for r, ids in zip(e, lib_ids([r["text"] or "" for r in e]), strict=True):
        assert np.frombuffer(r["token_ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == LIB.decode(ids, skip_special_tokens=False)


def test_stages_take_awkward_and_empty_tables(spark, sf_dir):
    rows = awkward()
    for docs, n in ((documents(spark), None), (documents(spark, []), 0)):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, sf_dir)
            assert set(docs.columns) <= set(out.columns) if name == "encoding" else out.columns == docs.columns
            found = out.collect()
            assert n is None or len(found) == n
            if n is None and name == "exact_copies":
                assert keys(found) == brute_exact(rows)
                assert all(r["_sha"] == f"_sha{r['doc_id']}" and r["row"] == f"row{r['doc_id']}" for r in found)
            if n is None and name == "near_copies":
                assert keys(found) == brute_near(rows)
            if n is None and name == "encoding":
                assert len(found) == len(rows)


def test_equal_texts_of_two_sources_are_mixed_apart(spark):
    text = " ".join(["w"] * 40)
    rows = [(1, text, s, i) for i, s in enumerate(("a", "b") * 4)] + [(2, text, "a", 9)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == len(rows)
    out = Counter((r["source"], r["doc_id"], r["copies"]) for r in mixing.mixed_documents(docs).collect())
    want = Counter()
    for r in mixed:
        want[r["source"], r["doc_id"]] += r["copies"]
    got = Counter()
    for (s, i, _), n in out.items():
        got[s, i] += n
    assert got == +want and {s for s, _ in got} == {"a", "b"}
    assert all(n <= 2 for (_, i, _), n in out.items() if i == 1) and sum(n for (_, i, _), n in out.items() if i == 2) <= 6


def test_registered_pipeline_is_the_stages_one_after_the_other(spark, tmp_path):
    rows = [r for r in awkward() if r[0] != 11]
    documents(spark, rows, extra=False).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    out = cp.run(spark, f"file://{tmp_path}")
    docs = documents(spark, rows, extra=False)
    for _, stage in cp.STAGES:
        docs = stored(stage(spark, docs, f"file://{tmp_path}"), "t")
    assert keys(out.collect()) == keys(docs.collect())


@pytest.mark.parametrize("text", ["", "x"])
def test_folding_keeps_length(text):
    assert len(fold(text)) == len(text) + 1
