"""Signal functions that work on Arrow batches."""

import math

import pytest
from pyspark.sql import functions as F

from readloom import functions as fn
from readloom.operators import demux


@pytest.mark.parametrize("digits", [None, 6])
def test_qualities_are_looked_up(spark, digits):
    """Each character's probability, as the expression gives it; nulls stay null, characters beyond ASCII count by value."""
    texts = ["".join(map(chr, range(33, 127))), "", None, "I!", "é5\U0001f600", "5" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, q string").coalesce(1)
    chars = F.transform(F.filter(F.split("q", ""), lambda c: c != ""), lambda c: 1 - F.pow(F.lit(10.0), -(F.ascii(c) - 33) / 10.0))
    want = chars if digits is None else F.transform(chars, lambda v: F.round(v, digits))
    for r in df.select("q", fn.quality_decode(F.col("q"), digits).alias("got"), want.alias("want")).collect():
        assert r["got"] == (r["want"] if digits or r["want"] is None else pytest.approx(r["want"], rel=1e-14))


def test_centres_and_chances_of_odd_signals(spark):
    """Means leave nulls out, position by position; odd signals have null chances; no position is shuffled for itself."""
    rows = [("a", [1.0, 2.0], 0), ("b", [3.0, None], 0), ("c", [5.0, 6.0], 1), ("d", [1.0], 3), ("e", None, 3), ("f", [2.0, 2.0], None)]
    df = spark.createDataFrame(rows, "read_id string, signal array<double>, label int").coalesce(2)
    centers = demux.centroids(df)
    assert {r["label"]: r["center"] for r in centers.collect()} == {0: [2.0, 2.0], 1: [5.0, 6.0], 3: [1.0], None: [2.0, 2.0]}
    assert "Generate" not in centers._jdf.queryExecution().optimizedPlan().toString()
    got = {r["read_id"]: r["probs"] for r in demux.centroid_predict(df, centers.filter("label < 2")).collect()}
    near, far = (sum((x - y) ** 2 for x, y in zip((1.0, 2.0), c)) ** 0.5 / 2**0.5 for c in ((2.0, 2.0), (5.0, 6.0)))
    chance = 1 / (1 + math.exp(near - far))
    assert got["a"] == pytest.approx([chance, 1 - chance]) and [got[i] for i in "bde"] == [[None, None]] * 3
    assert demux.centroid_predict(df, centers.filter("label > 9")).collect()[0]["probs"] == []
