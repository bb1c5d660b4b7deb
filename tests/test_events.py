import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.operators import events, polya, tails
from readloom.operators.intervals import interval_union
from readloom.plans import QUERIES


def test_steps_give_their_boundaries(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(m, 0.8, 60) for m in (80, 100, 85, 110)])
    df = spark.createDataFrame([("r", x.tolist())], "read_id string, signal array<double>")
    found = sorted(r["start"] for r in events.detect_events(df).collect())
    assert len(found) == 4 and all(abs(a - b) <= 3 for a, b in zip(found, (0, 60, 120, 180), strict=True))


def test_no_boundary_gives_no_event(spark):
    df = spark.createDataFrame([("r", [1.0] * 5), ("s", []), ("t", None)], "read_id string, signal array<double>")
    assert events.detect_events(df).collect() == []


def written_tstat(x, width):
    """The definition, sample by sample; a null in a window counts as a cut."""
    out = []
    for i in range(len(x)):
        a, b = x[max(0, i - width) : i], x[i : i + width]
        if len(a) < width or len(b) < width or None in a + b:
            out.append(0.0)
            continue
        var = sum(v * v for v in a) / width - (sum(a) / width) ** 2 + sum(v * v for v in b) / width - (sum(b) / width) ** 2
        out.append(abs(sum(b) - sum(a)) / width / np.sqrt(max(var, events.TINY) / width))
    return out


def written_peaks(short, long, windows, thresholds, height):
    """One read, sample by sample, with the state of both detectors in plain lists."""
    crest, level, sure, blind, out = [-1, -1], [np.inf, np.inf], [False, False], -1, set()
    for i, values in enumerate(zip(short, long, strict=True)):
        for d, v in enumerate(values):
            if d == 1 and i <= blind:
                continue
            if crest[d] < 0:
                if v < level[d]:
                    level[d] = v
                elif v - level[d] > height:
                    crest[d], level[d] = i, v
            else:
                if v > level[d]:
                    crest[d], level[d] = i, v
                if level[d] > thresholds[d]:
                    if d == 0:
                        blind, crest[1], level[1], sure[1] = crest[0] + windows[0], -1, np.inf, False
                    sure[d] = sure[d] or level[d] - v > height
            if crest[d] >= 0 and sure[d] and i - crest[d] > windows[d] // 2:
                out.add(crest[d])
                crest[d], level[d], sure[d] = -1, v, False
    return sorted(out)


def written_events(x, marks):
    cuts = sorted({m for m in marks if 0 < m < len(x)})
    out = []
    for a, z in zip([0, *cuts], [*cuts, len(x)], strict=True) if cuts else []:
        own = [v for v in x[a:z] if v is not None]
        out.append((a, len(own), np.mean(own) if own else None, np.std(own) if own else None))
    return out


def test_events_of_arrays_equal_the_sequential_versions(spark):
    rng = np.random.default_rng(4)
    reads = {"empty": [], "one": [5.0], "flat": [3.0] * 50}
    for r in range(60):
        steps = [rng.normal(rng.choice([80, 95, 110]), rng.choice([0.3, 2.0]), rng.integers(2, 40)) for _ in range(rng.integers(1, 12))]
        x = np.concatenate(steps).tolist()
        reads[f"r{r}"] = [None if r % 5 == 0 and rng.random() < 0.03 else v for v in x]
    df = spark.createDataFrame([*reads.items(), ("null", None)], "read_id string, signal array<double>").repartition(3)
    for windows, thresholds, height in (((3, 6), (1.0, 2.0), 0.5), ((7, 20), (3.0, 8.0), 4.0)):
        stats = events.window_tstat(events.window_tstat(df, windows[0], "t_short"), windows[1], "t_long")
        got = {r["read_id"]: r for r in stats.collect()}
        marks = {}
        for r in events.peak_boundaries(stats, windows, thresholds, height).collect():
            marks.setdefault(r["read_id"], []).append(r["boundary"])
        found = {}
        for r in sorted(events.detect_events(df, windows, thresholds, height).collect(), key=lambda r: r["start"]):
            found.setdefault(r["read_id"], []).append(r)
        for k, x in reads.items():
            for name, width in zip(("t_short", "t_long"), windows, strict=True):
                assert np.allclose(got[k][name], written_tstat(x, width), rtol=1e-6, atol=1e-9) or k == "flat"
            want = written_peaks(got[k]["t_short"], got[k]["t_long"], windows, thresholds, height)
            assert marks.get(k, []) == want
            cut = written_events(x, want)
            assert [(r["start"], r["length"]) for r in found.get(k, [])] == [c[:2] for c in cut]
            for r, c in zip(found.get(k, []), cut, strict=True):
                assert (r["mean"] is None) == (c[2] is None) and (c[2] is None or np.allclose([r["mean"], r["stdv"]], c[2:], atol=1e-9))
        assert sum(map(len, marks.values())) > 50


def test_touching_intervals(spark):
    df = spark.createDataFrame([("r", 0, 5), ("r", 5, 9), ("r", 10, 12), ("s", 1, 2)], "read_id string, first long, last long")
    got = sorted((r["read_id"], r["first"], r["last"]) for r in interval_union(df, ["read_id"]).collect())
    assert got == [("r", 0, 9), ("r", 10, 12), ("s", 1, 2)]


def brute_interval(rows, gap=110, penalty=1.5):
    """The definition: every interval of events, one by one."""
    best = None
    for i in range(len(rows)):
        score = away = 0
        for j in range(i, len(rows)):
            a, n = rows[j]
            away = 0 if a else away + n
            if away > gap:
                break
            score += n if a else int(-penalty * n)
            if best is None or (score, -i, -j) > best:
                best = (score, -i, -j)
    return (best[0], -best[1] + 1, -best[2] + 1) if best and best[0] > 0 else None


@pytest.mark.parametrize("spike,split", [(109, False), (110, False), (111, True)])
def test_spikes_bridge_up_to_the_gap(spark, spike, split):
    rows = [("r", 1, True, 400), ("r", 2, False, spike), ("r", 3, True, 300)]
    df = spark.createDataFrame(rows, "read_id string, k long, is_a boolean, length long")
    got = polya.best_interval(df).first()
    assert (got["first"], got["last"]) == ((1, 1) if split else (1, 3))


def test_best_interval_equals_the_definition(spark):
    rng = np.random.default_rng(9)
    data, want = [], {}
    for r in range(300):
        n = int(rng.integers(1, 14))
        rows = [(bool(rng.random() < 0.55), int(rng.choice([3, 20, 60, 109, 110, 111]))) for _ in range(n)]
        data += [(f"r{r}", k + 1, a, m) for k, (a, m) in enumerate(rows)]
        want[f"r{r}"] = brute_interval(rows)
    df = spark.createDataFrame(data, "read_id string, k long, is_a boolean, length long")
    got = {r["read_id"]: (r["score"], r["first"], r["last"]) for r in polya.best_interval(df).collect()}
    assert {k: v for k, v in want.items() if v} == got


def test_ties_go_to_the_earliest(spark):
    rows = [("r", 1, True, 50), ("r", 2, False, 200), ("r", 3, True, 50)]
    got = polya.best_interval(spark.createDataFrame(rows, "read_id string, k long, is_a boolean, length long")).first()
    assert (got["score"], got["first"], got["last"]) == (50, 1, 1)


def written_tail(rows, adapter_end, has_tail, x):
    """Both passes and the deviation check for one read's events ``(start, length, mean, stdv)``."""

    def search(center):
        return brute_interval([(abs(m - center) <= 2 * 2.55, n) for _, n, m, _ in rows])

    def again():
        near = [(n, m) for s, n, m, d in rows if s + n > adapter_end and s <= adapter_end + 100 and d < 5]
        if not near:
            return None
        center = sum(n * m for n, m in near) / sum(n for n, _ in near)
        return search(center) if sum(n for _, n, m, _ in rows if abs(m - center) <= 2 * 2.55) >= 750 else None

    def steady(best):
        start, n = max(rows[best[1] - 1 : best[2]], key=lambda r: (r[1], -r[0]))[:2]
        part = x[int(start + n * 0.05) : int(start + n * 0.95)]
        return len(part) > 2 and np.std(part) < 5

    found, second = search(108.95) if has_tail else None, False
    if found:
        own = rows[found[1] - 1 : found[2]]
        found = found if abs(sum(n * m for _, n, m, _ in own) / sum(n for _, n, _, _ in own) - 108.95) <= 1.7 * 2.55 else None
    if not found:
        found, second = again(), True
    if found and not steady(found) and not second:
        found, second = again(), True
    return (*found, second) if found and steady(found) else None


def test_tails_equal_the_written_chain(spark):
    rng = np.random.default_rng(12)
    data, samples, ends, tails, want = [], [], [], [], {}
    for r in range(160):
        offset, name, at, rows, x = rng.choice([0.0, 3.5, 6.0]), f"r{r}", 0, [], []
        for k in range(int(rng.integers(3, 12))):
            n, d = int(rng.choice([4, 60, 150, 500])), float(rng.choice([1.0, 3.0, 8.0]))
            m = float(108.95 + offset + (rng.normal(0, 1) if rng.random() < 0.75 else rng.choice([-15, 4.8, 15])))
            rows.append((at, n, m, d))
            x += (m + rng.normal(0, 1, n) * d).tolist()
            data.append((name, k + 1, at, n, m, d))
            at += n
        end, tail = rows[1][0], bool(rng.random() < 0.8)
        samples += [(name, i, v) for i, v in enumerate(x)]
        ends.append((name, end))
        tails += [(name,)] if tail else []
        want[name] = written_tail(rows, end, tail, x)
    e = polya.classify(spark.createDataFrame(data, "read_id string, k long, start long, length long, mean double, stdv double"))
    ends, tails = spark.createDataFrame(ends, "read_id string, adapter_end long"), spark.createDataFrame(tails, "read_id string")
    found = polya.recalibrate(e, polya.best_interval(e), ends, tails)
    out = polya.steady_intervals(e, found, spark.createDataFrame(samples, "read_id string, i long, x double"), ends)
    got = {r["read_id"]: (r["score"], r["first"], r["last"], r["recalibrated"]) for r in out.collect()}
    assert got == {k: v for k, v in want.items() if v}
    assert {v[3] for v in got.values()} == {True, False} and len(got) < len(want)


def written_growth(x, begin, upto, step, rounds, median):
    """The recursion, read by read: detect in the window, search, widen while the interval is open."""
    part = x[begin:upto]
    if median:
        padded = [0.0] * (median // 2) + part + [0.0] * (median // 2)
        part = [sorted(padded[i : i + median])[median // 2] for i in range(len(part))]
    own = written_events(part, written_peaks(written_tstat(part, 7), written_tstat(part, 20), (7, 20), (3.0, 8.0), 4.0))
    best = brute_interval([(abs(m - 108.95) <= 2 * 2.55, n) for _, n, m, _ in own])
    if best and best[2] == len(own) and upto < len(x) and rounds:
        return written_growth(x, begin, min(upto + step, len(x)), step, rounds - 1, median)
    return upto, best, [(begin + s, n) for s, n, _, _ in own]


@pytest.mark.parametrize("median,rounds", [(None, 6), (5, 6), (None, 1)])
def test_events_are_detected_again_in_wider_windows(spark, median, rounds):
    rng = np.random.default_rng(21)
    rows = []
    for r in range(40):
        levels = [rng.choice([80, 95]), *([109] * int(rng.integers(0, 4))), rng.choice([85, 120]), 109, rng.choice([90, 109])]
        x = np.concatenate([rng.normal(m + rng.normal(0, 1), rng.choice([0.5, 1.5]), rng.integers(20, 130)) for m in levels])
        begin = int(rng.integers(0, 30))
        rows.append((f"r{r}", x.tolist(), begin, begin + int(rng.integers(60, 200))))
    odd = [("null", None, 0, 50), ("empty", [], 0, 50), ("flat", [109.0] * 300, None, 100), ("outside", rows[0][1], -5, 10**6), ("unset", rows[0][1], 10, None)]
    df = spark.createDataFrame(rows + odd, "read_id string, signal array<double>, begin long, upto long").repartition(3)
    out = tails.extend_open(df, 45, rounds, median=median)
    got = {r["read_id"]: r for r in out.collect()}
    moved = 0
    for name, x, begin, upto in rows:
        end, best, own = written_growth(x, begin, min(upto, len(x)), 45, rounds, median)
        r = got[name]
        assert (r["upto"], (r["score"], r["first"], r["last"])) == (end, best or (None,) * 3)
        assert [(e["start"], e["length"]) for e in r["events"]] == own
        narrow = written_growth(x, begin, min(upto, len(x)), 45, 0, median)[2]
        moved += r["rounds"] > 0 and own[: len(narrow) - 1] != narrow[:-1]
    assert moved and sum(r["rounds"] > 0 for r in got.values()) > 3 and max(r["rounds"] for r in got.values()) <= rounds
    assert all(got[k]["events"] == [] and got[k]["score"] is None for k in ("null", "empty", "flat", "unset"))
    assert (got["outside"]["upto"], got["outside"]["rounds"], got["flat"]["upto"]) == (len(rows[0][1]), 0, 100)
    assert "Exchange" not in tails.extend_open(spark.createDataFrame(rows, df.schema), 45)._jdf.queryExecution().executedPlan().toString()
    table = {(r["read_id"], r["k"]): r["start"] for r in tails.grown_events(out).collect()}
    assert table == {(n, k + 1): e["start"] for n, r in got.items() for k, e in enumerate(r["events"])}


def test_ranges_of_their_own(spark, monkeypatch):
    """A read is searched in the range that its columns give; groups of any size give the same."""
    x = np.repeat([80.0, 95.0, 120.0], 100) + np.random.default_rng(3).normal(0, 0.5, 300)
    df = spark.createDataFrame([(str(c), x.tolist(), 0, 300, c) for c in (80.0, 95.0, 109.0, None)], "read_id string, signal array<double>, begin long, upto long, c double")
    want = None
    for size in (1 << 22, 1):
        monkeypatch.setattr(tails, "AT_ONCE", size)
        found = {r["read_id"]: (r["score"], r["first"], r["last"]) for r in tails.extend_open(df, 50, low=F.col("c") - 2, high=F.col("c") + 2).collect()}
        want = want or found
        assert found == want
    assert found["109.0"] == found["None"] == (None, None, None)
    assert found["80.0"][1] == 1 and found["95.0"][1] > 1 and all(90 <= found[k][0] <= 110 for k in ("80.0", "95.0"))


def test_median_filter_ahead_of_detection(spark):
    """Filtered events equal those of signals that were filtered one by one; neighbours in a batch don't meet, and nothing is shuffled."""
    rng = np.random.default_rng(12)
    rows = [(f"r{k}", [float(v) for v in np.repeat(rng.normal(90, 15, 1 + k % 6), 60) + rng.normal(0, 2, 60 * (1 + k % 6))]) for k in range(12)]
    rows += [("short", [5.0, 1.0]), ("empty", []), ("null", None)]

    def smoothed(x):
        padded = [0.0] * 3 + list(x or []) + [0.0] * 3
        return [sorted(padded[i : i + 7])[3] for i in range(len(x or []))]

    schema = "read_id string, signal array<double>"
    plain, done = spark.createDataFrame(rows, schema).coalesce(1), spark.createDataFrame([(i, smoothed(x)) for i, x in rows], schema)
    got = events.detect_events(plain, median=7)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, events.detect_events(done).collect())) != []
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        events.running_median(np.zeros(3), np.array([0, 3]), 4)


@pytest.mark.parametrize("cuts", [(0, 30), (0, 7, 12, 30)])
def test_pieces_are_measured_like_single_samples(spark, cuts):
    """Pieces of a signal that are cut down to the middle of the longest event give the deviation of its samples; the join is told to merge."""
    events = spark.createDataFrame([("a", 1, 0, 10), ("a", 2, 10, 20)], "read_id string, k long, start long, length long")
    interval = spark.createDataFrame([("a", 1, 2)], "read_id string, first long, last long")
    x = [float(i * i % 7) for i in range(30)]
    pieces = spark.createDataFrame([("a", p, q - p, x[p:q]) for p, q in itertools.pairwise(cuts)], "read_id string, start long, length long, x array<double>")
    single = spark.createDataFrame([("a", i, v) for i, v in enumerate(x)], "read_id string, i long, x double")
    out = polya.stdev_check(events, interval, pieces, F.col("x"))
    assert out.collect()[0]["stdev"] == pytest.approx(np.std(x[11:29])) == polya.stdev_check(events, interval, single).collect()[0]["stdev"]
    for df in (out, polya.stdev_check(events, interval, single)):
        assert "strategy=merge" in df._jdf.queryExecution().analyzed().toString()


def test_no_sample_of_the_deviation_check_is_shuffled(spark, sf_dir):
    """No exchange of the query carries samples: they are made behind the join."""
    plan = QUERIES["pa_stdev_qc"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    made = plan.index("Generate explode(slice(transform(sequence(")
    assert "SortMergeJoin" in plan[made:] and "Exchange" not in plan[made : made + plan[made:].index("SortMergeJoin")]
