import numpy as np

from readloom.llm import toxicity
from readloom.llm.near_dedup import near_rows, sketch_rows
from tests.llm.helpers import documents

PAIRS = [a + b for a in "abcdefghijkmnopqrstuvwxyz" for b in "abcdefghijkmnopqrstuvwxyz"]


def _text(i, special=""):
    """Three fifths of the word pairs in common, the others of this document."""
    passage, own = np.random.default_rng(5).choice(PAIRS, 120).tolist(), np.random.default_rng(1000 + i).choice(PAIRS, 36).tolist()
    return " ".join([*passage, special, *own])


def _fit(spark, rows):
    labels = spark.createDataFrame([(i, i < 100) for i, _ in rows], "doc_id long, toxic boolean")
    return toxicity.fit_toxicity(documents(spark, rows), labels)


def test_documents_that_share_passages_all_count(spark):
    rows = [(i, _text(i, "grumbex")) for i in range(10)] + [(100 + i, _text(100 + i)) for i in range(40)]
    assert any("grumbex".startswith(w) for w in _fit(spark, rows).weights)


def test_near_copies_count_once(spark):
    rows = [(i, _text(7, "grumbex") + f" {PAIRS[i]}") for i in range(10)] + [(100 + i, _text(100 + i)) for i in range(40)]
    assert not _fit(spark, rows).weights


def test_sketches_alone_give_the_same_classes_away_from_the_limit(spark):
    rows = [(i, _text(i % 7) + " ".join(["", *PAIRS[i % 3 : i % 5]])) for i in range(60)] + [(None, _text(3)), (70, None), (71, " "), (72, "one two"), (73, "one two")]
    docs = documents(spark, rows)
    own, full = ({(r.id, bytes(r.sha), r.low and r.low.id) for r in f(docs).collect()} for f in (sketch_rows, near_rows))
    assert own == full and len(own) == len(rows)
    assert sketch_rows(documents(spark, [])).count() == 0
