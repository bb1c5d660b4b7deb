import itertools

import numpy as np

from readloom.operators import segmentation as seg


def _score(model, x, path):
    with np.errstate(divide="ignore"):
        emit, moves, start = model.log_emission(np.array(x)), model.log_moves(), np.log(np.array(model.start))
    s = start[path[0]] + emit[0, path[0]]
    for t in range(1, len(x)):
        s += moves[path[t - 1], path[t]] + emit[t, path[t]]
    return s


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(3)
    signals = [rng.uniform(60, 120, n) for n in (1, 2, 3, 4, 5, 5)]
    for model in (seg.READ_MODEL, seg.WINDOW_MODEL):
        for x, path in zip(signals, seg.viterbi_batch(model, signals), strict=True):
            best = max(_score(model, x, p) for p in itertools.product(range(6), repeat=len(x)))
            assert np.isclose(_score(model, x, path.tolist()), best)


def test_planted_read_is_recovered(spark):
    rng = np.random.default_rng(5)
    parts = [(71.5, 3.6, 40), (102.0, 3.9, 60), (112.0, 4.8, 70), (78.0, 7.0, 200), (108.95, 2.5, 120), (95.0, 14.0, 400)]
    x = np.concatenate([rng.normal(m, s, n) for m, s, n in parts])
    df = spark.createDataFrame([("r", x.tolist()), ("empty", [])], "read_id string, signal array<double>")
    out = {r[0]: r[1] for r in df.select("read_id", seg.viterbi(df["signal"])).collect()}
    assert out["empty"] == []
    edges = np.flatnonzero(np.diff(out["r"])) + 1
    assert abs(int(edges[0]) - 40) <= 2 and abs(int(edges[1]) - 100) <= 3


def test_last_run_of_a_state_wins(spark):
    df = spark.createDataFrame([("a", i, s) for i, s in enumerate("xxyyxz")], "read_id string, k long, state string")
    got = {(r["state"], r["first"], r["last"]) for r in seg.segment_map(df).collect()}
    assert got == {("x", 4, 4), ("y", 2, 3), ("z", 5, 5)}
