import numpy as np
import pytest

from readloom.llm import whitening
from readloom.llm.queries import QUERIES


def _matrices():
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 40):
        x = rng.normal(size=(3 * d + 2, d)) * np.geomspace(1, 1e-3, d)
        yield x.T @ x / len(x)
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    yield q @ np.diag([5, 5, 5, 3, 3 + 1e-13, 2, 1, 1, 1, 0, 0, 0.5]) @ q.T  # ties and zeros
    yield q @ np.diag([4, 4 - 1e-8, 4 - 2e-8, 3, 2, 1, 1e-6, 1e-7, 1e-9, 1e-12, 1e-14, 0]) @ q.T  # near ties, a steep fall
    yield np.eye(6)
    yield np.zeros((4, 4))
    yield np.diag([0.0, 2.0, 0.0])


@pytest.mark.parametrize("a", list(_matrices()))
def test_slices_equal_a_dense_solver(a):
    a = (a + a.T) / 2
    truth = np.sort(np.linalg.eigvalsh(a))[::-1]
    for shift in (-1.0, 0.7, 1.5, 2.5, 4 - 1e-8 / 2, 10.0):
        assert whitening.count_above(a, shift) == (truth > shift).sum()
    values, axes = whitening.leading_eigenpairs(a, 8)
    norm = np.abs(a).sum(axis=1).max()
    want = truth[truth > len(a) * whitening.EPS * norm][:8]
    assert np.allclose(values[: len(want)], want, rtol=1e-9, atol=1e-14 * norm) and abs(len(values) - len(want)) <= 1
    assert np.allclose(a @ axes, axes * values, atol=1e-12 * norm)
    assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-6)


def _brute(rows, limit):
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    d = max(len(v) for _, v in fine)
    x = np.array([[int(np.floor(64.0 * c)) + 1_000_000 for c in v] + [1_000_000] * (d - len(v)) for _, v in fine])
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:limit], u[:, ::-1][:, :limit]
    return [i for i, _ in fine], n, [int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True))) for r in x], c @ u / np.sqrt(e), e / np.trace(cov)


def test_whitened_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 1, 6) * [9, 7, 5, 3, 2, 1]).tolist()) for i in range(400)] + [(1000 + i, [0.5] * 6) for i in range(300)]
    rows += [(None, [1.0] * 6), (7, [2.0, 3.0] + [0.0] * 4), (5000, None), (5001, [None] + [0.0] * 5), (5002, [float("nan")] * 6), (5003, [float("-inf")] * 6), (5004, [3.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, component string, n int").repartition(5)
    got = whitening.whiten(df, limit=4).toPandas()
    ids, n, deviation, white, explained = _brute(rows, 4)
    assert len(got) == 4 * len(ids) and set(got["n"]) == {n} and got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    for c in range(4):
        own = got[got["component"] == c + 1]
        assert np.allclose(own["explained"], explained[c], rtol=1e-9)
        value = {(None if i != i else int(i), round(float(w), 7)) for i, w in zip(own["vec_id"], own["whitened"], strict=True)}
        sides = [{(i, round(float(s * w), 7)) for i, w in zip(ids, white[:, c], strict=True)} for s in (1, -1)]
        assert max(len(value & side) for side in sides) >= 0.99 * len(value)  # rounding may split a few
    first = got[got["component"] == 1]
    assert sorted(first["deviation"].tolist()) == sorted(deviation)


def test_degenerate_tables(spark):
    kind = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 9, [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, kind)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(20)], kind)).toPandas()
    assert set(line["component"]) == {1} and np.isclose(line["explained"].iloc[0], 1.0) and line["identity_error"].iloc[0] < 1e-9
    huge = whitening.whiten(spark.createDataFrame([(i, [float(1 << 26) * i, 1.0 * i * i]) for i in range(200)], "vec_id long, embedding array<double>")).toPandas()
    assert huge["deviation"].isna().any() and huge["identity_error"].iloc[0] < 1e-4


def test_registered_query(spark, sf_dir):
    got = QUERIES["op13_whitening"](spark, sf_dir).toPandas()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    ids, n, deviation, white, explained = _brute(rows, 32)
    assert len(got) == 32 * len(ids) and got["identity_error"].iloc[0] <= 1e-4
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert np.allclose(np.abs(table), np.abs(white), atol=1e-6)
    assert np.allclose(got.groupby("component")["explained"].first(), explained, rtol=1e-8)
    assert got[got["component"] == 1].set_index("vec_id")["deviation"].to_dict() == dict(zip(ids, deviation, strict=True))
