import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom import streaming
from readloom.operators import assign, calibration, chimera, curves, demux, ranks, reads, scaling, selection, training
from readloom.operators.segmentation import WINDOW_MODEL
from readloom.plans import QUERIES
from readloom.sources import sinks
from readloom.sources.shared import ensure_checkpoints


def test_okay_reads_are_unique_and_failures_repeat(spark):
    rows = [("f", "a", "okay", 1), ("f", "a", "okay", 2), ("f", "b", "fail", 1), ("f", "b", "fail", 2), ("f", "c", "fail", 1), ("f", "c", "okay", 2), ("f", "c", "okay", 3)]
    df = spark.createDataFrame(rows, "filename string, read_id string, status string, arrival long")
    got = sorted((r["read_id"], r["arrival"]) for r in reads.dedup_okay(df, ["filename", "read_id"], "arrival").collect())
    assert got == [("a", 1), ("b", 1), ("b", 2), ("c", 1), ("c", 2)]


def test_stream_keeps_okay_once(spark, tmp_path):
    rows = [("f", "a", "okay"), ("f", "b", "fail")]
    df = spark.createDataFrame(rows, "filename string, read_id string, status string")
    for i in range(3):
        df.write.parquet(f"{tmp_path}/in/part={i}")
    stream = streaming.dedup_stream(streaming.live_scan(spark, f"{tmp_path}/in", df.schema, files_per_trigger=1), ["filename", "read_id"])
    out = f"{tmp_path}/out"
    streaming.run_available(stream, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}"), f"{tmp_path}/cp")
    got = sorted(r["read_id"] for r in spark.read.parquet(out).collect())
    assert got == ["a", "b", "b", "b"]


def test_splits_have_exact_sizes(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("read_id"), (F.col("id") % 7).alias("label"))
    parts = {r["is_train"]: r["count"] for r in scaling.train_test_split(df, 0.8).groupBy("is_train").count().collect()}
    assert parts == {True: 800, False: 200}
    test = training.stratified_split(df, 0.2).filter("is_test").groupBy("label").count().collect()
    assert all(r["count"] == (143 if r["label"] < 6 else 142) // 5 for r in test)
    ranks = [r["rank"] for r in training.shuffled(df, 3).collect()]
    assert sorted(ranks) == list(range(1, 1001))


def test_quotas_add_up(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate((5, 0, 3, 9, 2))], "bin long, n long")
    assert sum(r["quota"] for r in training.apportion(df, 101).collect()) == 101


def test_calibration_is_continuous_and_monotone(spark):
    ensure_checkpoints(spark)
    rows = [(0.2 + 0.008 * i, max(0.001, 0.5 * (1 - 0.01 * i) ** 3)) for i in range(100)]
    table = calibration.calibration_table(spark.createDataFrame(rows, "mean double, error_rate double")).orderBy("phred").collect()
    assert [r["phred"] for r in table] == list(range(len(table))) and table[0]["pred_score"] == 0.0
    scores = [r["pred_score"] for r in table]
    assert scores == sorted(scores)


def test_quality_beyond_the_table_is_an_error(spark):
    df = spark.createDataFrame([("a", [0.1, 0.9])], "read_id string, probs array<double>")
    try:
        demux.decide(df, [0.0, 0.5], quality=2)
    except ValueError:
        return
    raise AssertionError


def test_failing_rows_do_not_sink_the_batch(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "read_id string, x double")
    out = {r["read_id"]: r for r in reads.capture_errors(df, lambda r: {"read_id": r["read_id"], "y": 1 / r["x"]}, "read_id string, y double").collect()}
    assert out["a"]["status"] == "okay" and out["b"]["status"] == "unknown_error" and "ZeroDivision" in out["b"]["error"]


def test_fastq_is_written_by_group(spark, tmp_path):
    df = spark.createDataFrame([("a", "ACGU", "IIII", "pass", 0, 1), ("b", "AC", "II", None, None, 0)], "read_id string, seq string, qual string, label string, barcode long, trim long")
    sinks.write_text(sinks.fastq_rows(df), f"{tmp_path}/fastq")
    back = spark.read.text(f"{tmp_path}/fastq").groupBy("label", "barcode").agg(F.sort_array(F.collect_list("value")).alias("v")).collect()
    assert {(r["label"], r["barcode"]) for r in back} == {("pass", "BC1"), ("fail", "undetermined")}


def test_stream_and_batch_drop_the_same_rows(spark, tmp_path):
    rows = [("f", "a", "fail", 1), ("f", "a", "okay", 2), ("f", "a", "fail", 3), ("f", "a", "okay", 4), ("f", "b", "fail", 1), ("f", "b", "fail", 2), ("g", "a", "okay", 1)]
    df = spark.createDataFrame(rows, "filename string, read_id string, status string, arrival long")
    want = sorted(map(tuple, reads.dedup_okay(df, ["filename", "read_id"], "arrival").collect()))
    for per_file in (1, 2, 7):
        src, out = f"{tmp_path}/in{per_file}", f"{tmp_path}/out{per_file}"
        for i in range(0, 7, per_file):
            spark.createDataFrame(rows[i : i + per_file], df.schema).coalesce(1).write.parquet(f"{src}/part={i}")
        stream = streaming.dedup_stream(streaming.live_scan(spark, src, df.schema, files_per_trigger=1), ["filename", "read_id"], "arrival")
        streaming.run_available(stream, lambda b, i, out=out: b.write.mode("overwrite").parquet(f"{out}/batch={i}"), f"{tmp_path}/cp{per_file}")
        assert sorted(map(tuple, spark.read.parquet(out).select(df.columns).collect())) == want


def test_flag_needs_an_adapter_but_no_position(spark):
    """Head 5, nothing behind the adapter: (0 + 1) / (5 + 1) is above the ratio; without an adapter there is no flag."""
    rows = [("a", 0, 5), ("a", 1, 0), ("b", 0, 5), ("c", 0, 9), ("c", 1, 0), ("d", 0, 1000), ("d", 1, 20), ("d", 2, 11)]
    got = {r["read_id"]: (r["later"], r["head"], r["unsplit"]) for r in chimera.chimera_flag(spark.createDataFrame(rows, "read_id string, gap long, positions long")).collect()}
    assert got == {"a": (0, 5, True), "b": (0, 5, False), "c": (0, 9, False), "d": (31, 1000, True)}


def test_adapters_count_from_their_limits_on(spark):
    """An adapter alone that lasts exactly its limits in whole samples is one; a sample less is none."""
    level = WINDOW_MODEL.emission[WINDOW_MODEL.names.index("adapter")][0][0]
    out = {}
    for size in (59, 60, 61):
        starts = list(range(0, size + 1, 1))
        df = spark.createDataFrame([("r", 0, 0, starts, starts, [float(level)] * len(starts))], "read_id string, window long, begin long, starts array<long>, ends array<long>, means array<double>")
        out[size] = chimera.leader_adapters(df, 100.0).count()
    assert out == {59: 0, 60: 1, 61: 1}


def test_ranks_of_large_classes_are_whole(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("read_id"), F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("x")).alias("label"))
    got = training.hash_ranked(df, ["label"], "read_id", 1, "r").groupBy("label").agg(F.sort_array(F.collect_list("r")).alias("r")).collect()
    assert {r["label"]: r["r"] for r in got} == {None: list(range(1, 1001)), "x": list(range(1, 2001))}


def test_many_references_are_joined_by_a_shuffle(spark, monkeypatch):
    refs = spark.createDataFrame([("p", "ACGUACGUUACGGAUCCA"), ("q", "GGGGGGGGGGGGGGGGGGGG")], "name string, seq string")
    own = spark.createDataFrame([("1", "UUACGUACGUUACGGAUCCA"), ("2", "GGGGGGGGGGGGGG"), ("3", "AC")], "read_id string, seq string")
    own = own.unionByName(spark.createDataFrame([("1", "GGGGGGGGGGGGGG"), (None, "UUACGUACGUUACGGAUCCA"), (None, "GGGGGGGGGGGGGG"), ("2", "GGGGGGGGGGGGGG"), ("4", None), (None, None), ("5", "")], own.schema))
    refs = refs.unionByName(spark.createDataFrame([("o", "GGGGGGGGGGGGG"), ("p", "GGGGGGGGGGGGG")], refs.schema))  # ties and a name that repeats
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    few = order(assign.seed_assign(own, refs).collect())
    monkeypatch.setattr(assign, "SEEDS", 0)
    assert order(assign.seed_assign(own, refs).collect()) == few
    assert few == order([("1", "p", 6), ("2", "o", 1), ("3", "*", 0), ("1", "o", 1), (None, "p", 6), (None, "o", 1), ("2", "o", 1), ("4", "*", 0), (None, "*", 0), ("5", "*", 0)])


def test_middle_slopes_by_counting(monkeypatch):
    rng = np.random.default_rng(3)
    for n in (5, 8, 61, 300):
        for x in (rng.normal(0, 1, n), rng.integers(0, 6, n).astype(float)):
            y = np.round(2 * x + rng.normal(0, 1, n), 1)
            z = np.round(rng.normal(0, 1, n), 1)
            assert scaling._inversions(z) == sum(z[j] <= z[i] for j in range(n) for i in range(j))
            want = np.median([(y[j] - y[i]) / (x[j] - x[i]) for j in range(n) for i in range(j) if x[j] != x[i]])
            assert np.isclose(scaling.median_slope(x, y), want, rtol=1e-12)
            with monkeypatch.context() as m:
                m.setattr(scaling, "PAIRED", 0)
                assert np.isclose(scaling.median_slope(x, y), want, rtol=1e-9, atol=1e-12)
    assert scaling.median_slope(np.ones(4), np.arange(4.0)) is None


def written_curve(points, span=0.3):
    """Local lines with tricube weights over the nearest share of points."""
    k, out = max(2, math.ceil(len(points) * span)), []
    for m, _ in points:
        h = max(sorted(abs(x - m) for x, _ in points)[min(k, len(points)) - 1], 1e-12) * (1 + 1e-9)
        w = np.array([(1 - (abs(x - m) / h) ** 3) ** 3 if abs(x - m) < h else 0.0 for x, _ in points])
        x, y = np.array([x - m for x, _ in points]), np.array([y for _, y in points])
        sw, sx, sy, sxx, sxy = w.sum(), (w * x).sum(), (w * y).sum(), (w * x * x).sum(), (w * x * y).sum()
        det = sw * sxx - sx * sx
        out.append((m, (sxx * sy - sx * sxy) / det if det > 1e-18 else sy / sw))
    return out


def test_interpolated_scores_invert_the_written_curve(spark):
    rng = np.random.default_rng(5)
    points = sorted((0.2 + 0.009 * i, float(max(0.002, 0.4 * (1 - 0.011 * i) ** 2 + rng.normal(0, 0.004)))) for i in range(80))
    errors = spark.createDataFrame(points, "mean double, error_rate double")
    curve = written_curve(points)
    got = sorted(map(tuple, calibration.smoothed_errors(errors).collect()))
    assert np.allclose(got, curve)
    low = spark.createDataFrame([(i, 0.1 * i) for i in range(5)], "phred long, pred_score double")
    want, best, previous = {}, 0.0, None
    down = sorted(curve, reverse=True)
    for phred in range(5, math.floor(-10 * math.log10(points[-1][1])) + 1):
        error, found, least = 10 ** (-phred / 10), [], None
        for (x1, y1), (x, y) in zip(down, down[1:], strict=False):
            least = y1 if least is None else min(least, y1)
            if y > least and least <= error <= y:
                found.append(x1 + (x - x1) * (error - least) / (y - least))
        best = max(best, max(found) if found else max(m for m, _ in curve))
        want[phred] = best
    got = {r["phred"]: r["pred_score"] for r in calibration.interpolated_table(errors, low).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


@pytest.mark.parametrize("sent", [4096, 0])
def test_curves_of_many_windows_equal_the_written_one(spark, monkeypatch, sent):
    """3,000 windows, crowded towards 1 as scores are, with runs of equal means; joined by broadcast or by a shuffle."""
    monkeypatch.setattr(curves, "SENT", sent)
    rng = np.random.default_rng(6)
    x = 1 - rng.random(3000 if sent else 1200) ** 4
    x[:150], x[150:170] = 0.97, 1.0
    points = [(float(m), float((1 - m) ** 2 + rng.normal(0, 0.01))) for m in x]
    errors = spark.createDataFrame([*points, (None, 0.1)], "mean double, error_rate double").repartition(3)
    got = dict(map(tuple, calibration.smoothed_errors(errors).collect()))
    want = dict(written_curve(points))
    assert got.keys() == want.keys()
    assert max(abs(got[m] - want[m]) for m in want) < 1e-9


@pytest.mark.parametrize("points", [[], [(0.5, 0.2)], [(0.5, 0.2), (0.5, 0.4)], [(0.1, 0.3), (0.9, 0.1)], [(0.5, float(i)) for i in range(200)]])
def test_curves_of_few_or_equal_points(spark, points):
    got = calibration.smoothed_errors(spark.createDataFrame(points, "mean double, error_rate double")).collect()
    want = dict(written_curve(points))
    assert {r["mean"] for r in got} == want.keys() and all(math.isclose(r["smooth"], want[r["mean"]], abs_tol=1e-9) for r in got)


@pytest.fixture
def apart(spark):
    """Small partitions stay apart, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_next_rows_cross_partitions(apart):
    """One key with most rows, a null key, ties, values beyond the last, null values; every column comes through."""
    rng = np.random.default_rng(41)
    key = lambda: [None if k == 3 else int(k) for k in rng.choice(4, 400, p=[0.7, 0.1, 0.1, 0.1])]
    left = [(k, i, None if i % 50 == 0 else float(v), {"a": i}) for i, (k, v) in enumerate(zip(key(), rng.integers(0, 300, 400), strict=True))]
    right = [(k, i, None if i % 60 == 0 else float(v)) for i, (k, v) in enumerate(zip(key(), rng.integers(0, 280, 400), strict=True)) if v < 100 or v > 200]
    a, b = apart.createDataFrame(left, "g long, i long, v double, m map<string,long>"), apart.createDataFrame(right, "g long, j long, w double")
    out = training.next_at_least(a, b, ["g"], "v", "w", ["j"]).collect()
    assert len(out) == len(left) and all(r["m"] == {"a": r["i"]} for r in out)
    for r in out:
        fit = sorted((w, j) for g, j, w in right if g == r["g"] and w is not None and r["v"] is not None and w >= r["v"])
        assert r["next_j"] == (fit[0][1] if fit else None)
    assert {r["next_j"] for r in training.next_at_least(a, b.limit(0), ["g"], "v", "w", ["j"]).collect()} == {None}


def test_quotas_are_filled_in_order(apart):
    rng = np.random.default_rng(42)
    rows = [(None if i % 97 == 0 else int(k), i, float(v)) for i, (k, v) in enumerate(zip(rng.choice(3, 900, p=[0.8, 0.1, 0.1]), rng.random(900), strict=True))]
    quotas = {0: 500, 1: 0, 2: 10_000, 7: 5}
    got = training.quota_fill(apart.createDataFrame(rows, "bin long, i long, v double"), apart.createDataFrame(list(quotas.items()), "bin long, quota long"), "bin", ["v", "i"]).collect()
    want = {i for k in quotas for v, i in sorted((v, i) for b, i, v in rows if b == k)[: quotas[k]]}
    assert sorted(r["i"] for r in got) == sorted(want) and got[0].asDict().keys() == {"bin", "i", "v"}


def test_counts_and_steps_cross_partitions(apart):
    spark = apart
    rng = np.random.default_rng(7)
    x, q = rng.integers(0, 40, 500).astype(float), rng.integers(-5, 50, 300).astype(float)
    points, queries = (spark.createDataFrame([(float(v), i) for i, v in enumerate(vs)], "v double, i long") for vs in (x, q))
    got = {r["i"]: r["n"] for r in ranks.count_below(points, queries, "n").collect()}
    assert got == {i: int((x < v).sum()) for i, v in enumerate(q)}
    y = rng.normal(0, 1, 100)
    rows = {r["x"]: (r["x1"], r["y1"]) for r in ranks.steps_down(spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "x long, y double"), "x", "y", 7).collect()}
    assert rows == {i: (i + 1, min(y[i + 1 :])) if i < 99 else (None, None) for i in range(100)}


def test_values_of_models_and_user_functions(spark, sf_dir):
    """Queries without an oracle, row by row against plain Python."""
    from readloom import bindings as b

    own = {r["read_id"]: r for r in b.signals(spark, sf_dir).collect()}
    plugged = {}
    for r in QUERIES["udf_model_plug"](spark, sf_dir).collect():
        plugged.setdefault(r["read_id"], {})[r["i"]] = r["x"]
    assert plugged.keys() == own.keys()
    for k, p in plugged.items():
        e = np.exp((np.array(own[k]["signal"][:4]) - max(own[k]["signal"][:4])) / 5)
        assert np.allclose([p[i] for i in range(4)], e / e.sum(), atol=2e-6)
    for r in QUERIES["udf_batch_process"](spark, sf_dir).collect():
        bad = own[r["read_id"]]["label"] == 3
        assert (r["mean"] is None and r["status"] == "unknown_error") if bad else (r["status"] == "okay" and math.isclose(r["mean"], np.mean(own[r["read_id"]]["signal"]), abs_tol=1e-6))


def test_fragments_are_stretches_of_their_signal(spark):
    signals = {"a": [float(i) for i in range(400)], "b": [1000.0 + i for i in range(90)], "c": []}
    df = spark.createDataFrame([*signals.items(), ("d", None)], "read_id string, signal array<double>")
    assert "Exchange" not in training.fragment_slices(df, 20, 5, 60, 7)._jdf.queryExecution().executedPlan().toString()
    got = training.fragment_slices(df, 20, 5, 60, 7).collect()
    assert got and all(r["fragment"] == signals[r["read_id"]][r["start"] : r["start"] + r["length"]] and 5 <= r["length"] <= 60 for r in got)
    spans = sorted((r["read_id"], r["start"], r["start"] + r["length"]) for r in got)
    assert all(a[0] != z[0] or a[2] <= z[1] for a, z in zip(spans, spans[1:], strict=False))


def test_cut_points_are_as_dense_as_asked(spark):
    """Of 200 reads of 5,000 samples one place in 25 is a cut, evenly over reads and places, and another seed cuts elsewhere."""
    df = spark.range(200).select(F.col("id").cast("string").alias("read_id"), F.expr("transform(sequence(1, 5000), i -> 1D)").alias("signal"))
    starts = {seed: {(r["read_id"], r["start"]) for r in training.fragment_slices(df, 25, 1, 5000, seed).select("read_id", "start").collect() if r["start"]} for seed in (1, 2)}
    for own in starts.values():
        assert abs(len(own) - 40_000) < 1_000
        per_read = np.bincount([int(i) for i, _ in own], minlength=200)
        assert per_read.min() > 120 and per_read.max() < 280
        assert np.abs(np.bincount([at // 500 for _, at in own], minlength=10) - 4_000).max() < 400
    assert abs(len(starts[1] & starts[2]) - 1_600) < 300


@pytest.mark.parametrize("cells,kept", [(4096, 10_000), (3, 1), (16, 0)])
def test_quantiles_by_counting_cells(spark, monkeypatch, cells, kept):
    rng = np.random.default_rng(31)
    monkeypatch.setattr(selection, "CELLS", cells)
    monkeypatch.setattr(selection, "SORTED", kept)
    shares = (0.0, 0.5, 0.98, 1.0)
    sets = {"wide": [*rng.normal(0, 1, 40).tolist(), 1e300, -1e300], "ties": [2.0] * 30 + [1.0] * 9, "one": [7.0], "near": [1.0, 1.0 + 2**-52, 1.0 + 2**-51] * 5, "none": []}
    for values in sets.values() if kept == 10_000 else [sets["ties"], sets["near"]]:
        df = spark.createDataFrame([(v,) for v in [*values, None, math.nan, math.inf]], "v double")
        got = selection.exact_quantiles(df.coalesce(1), "v", shares)
        assert got == [None] * 4 if not values else np.allclose(got, np.quantile(values, shares), rtol=1e-15)


def test_far_pairs_are_left_out_as_written(spark):
    rng = np.random.default_rng(32)
    x = rng.normal(0, 1, (301, 2)) @ np.array([[2.0, 1.0], [0.0, 0.5]])
    df = spark.createDataFrame([*((str(i), *map(float, r)) for i, r in enumerate(x)), ("null", None, 1.0), ("nan", math.nan, 1.0)], "read_id string, a double, b double")
    d, c = x - np.median(x, axis=0), np.linalg.inv(np.cov(x.T, bias=True))
    distance = np.einsum("ij,jk,ik->i", d, c, d)
    got = {r["read_id"] for r in scaling.outlier_filter(df, "a", "b", 0.9).collect()}
    assert got == {str(i) for i in np.flatnonzero(distance <= np.quantile(distance, 0.9))}
    assert scaling.outlier_filter(df.limit(0), "a", "b").collect() == []


def test_redispersed_signals_keep_their_shape(spark):
    rng = np.random.default_rng(8)
    rows = [(str(i), 1 + 0.1 * float(z), 5 + float(z), rng.normal(0, 1, 20).tolist()) for i, z in enumerate(rng.normal(0, 1, 300))]
    df = spark.createDataFrame(rows, "read_id string, scale double, shift double, signal array<double>")
    out = {r["read_id"]: r for r in scaling.redisperse(df).collect()}
    again = {r["read_id"]: r["new_scale"] for r in scaling.redisperse(df.repartition(7)).collect()}
    for i, a, s, x in rows:
        r = out[i]
        assert np.allclose(np.array(r["signal"]) * r["new_scale"] + r["new_shift"], np.array(x) * a + s)
        assert math.isclose(again[i], r["new_scale"], rel_tol=1e-9)
    drawn, was = np.array([r["new_shift"] for r in out.values()]), np.array([r[2] for r in rows])
    assert 1.5 < drawn.std() / was.std() < 2.1 and abs(drawn.mean() - was.mean()) < 0.5


def test_classifier_tells_plain_classes_apart(spark):
    classes = [("a", 0), ("b", 1)]
    df = spark.createDataFrame([(f"r{i}", [float(label * 10), 1.0, 2.0], label, 1.0) for i in range(40) for _, label in classes], "read_id string, signal array<double>, label long, weight double")
    model = training.fit_demux(df)
    pred = training.prediction_table(training.predict_demux(model, df)).collect()
    assert all(r["prior_label"] == r["pred_label"] and r["pred_prob"] > 0.5 for r in pred)


def test_containers_are_full_files(spark, tmp_path):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("read_id"), F.when(F.col("id") % 10 < 9, "pass").alias("label"), F.lit(None).cast("long").alias("barcode"))
    sinks.write_regrouped(df.union(df.limit(50)), f"{tmp_path}/containers", 200)
    back = spark.read.parquet(f"{tmp_path}/containers").withColumn("file", F.input_file_name())
    sizes = sorted((r["label"], r["n"], r["numbers"]) for r in back.groupBy("label", "file").agg(F.count("read_id").alias("n"), F.count_distinct("file_no").alias("numbers")).collect())
    assert sum(n for _, n, _ in sizes) == back.select("read_id").distinct().count() == 1000 and all(n <= 200 for _, n, _ in sizes)
    assert [x for x in sizes if x[0] == "fail"] == [("fail", 100, 1)]
