import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklode.operators import trajectory as W

NAN, INF = float("nan"), float("inf")


def frame(spark, series, schema="k string, t int, v double"):
    return spark.createDataFrame([(k, t, v) for k, s in series.items() for t, v in enumerate(s)], schema)


def test_deltas_clean_the_difference(spark):
    df = frame(spark, {"a": [1.0, 4.0, NAN, 2.0, INF], "b": [1.0]})
    got = {(r.k, r.t): r.delta for r in W.deltas(df, ["k"], ["t"], "v").collect()}
    assert got == {("a", 0): None, ("a", 1): 3.0, ("a", 2): 0.0, ("a", 3): 0.0, ("a", 4): 0.0, ("b", 0): None}
    arr = spark.createDataFrame([("a", 0, [0.0, 0.0]), ("a", 1, [3.0, 4.0]), ("a", 2, [NAN, 4.0])], "k string, t int, v array<double>")
    assert [r.delta for r in W.deltas(arr, ["k"], ["t"], "v").orderBy("t").collect()] == [None, 5.0, 0.0]


def test_segments_and_transitions(spark):
    df = frame(spark, {"all": [0.0, 9.0, 0.0, 9.0], "none": [1.0] * 4, "two": [0.0, 5.0, 5.0, 9.0], "short": [2.0]})
    moved = W.deltas(df, ["k"], ["t"], "v")
    limits = spark.createDataFrame([(0.1, 0.1, 1.0, 99.0, 1.0, 4.0)], "pause_thr double, active_thr double, p95_ref double, spike_thr double, mean_ref double, grip_thr double")
    rows = W.flagged(moved, ["k"], ["t"], "v", limits).groupBy("k").agg(F.count_if("edge").alias("s"), F.count_if("switch").alias("g")).collect()
    assert {r.k: (r.s, r.g) for r in rows} == {"all": (1, 3), "none": (0, 0), "two": (2, 1), "short": (0, 0)}


@pytest.mark.parametrize("values,want", [([0.0, 1.0] * 20, 0.5), ([], 0.5), (list(map(float, range(101))), 50.0), ([0.0, 0.0, 4.0], 2.0)])
def test_binary_threshold(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(W.binary_threshold("v")).first()[0] == pytest.approx(want)


@pytest.mark.parametrize("left,right,want", [(1.16, 1.0, "left"), (1.0, 1.16, "right"), (1.14, 1.0, "balanced"), (1.0, 1.14, "balanced"), (0.0, 0.0, "balanced")])
def test_dominant_arm(spark, left, right, want):
    assert spark.range(1).select(W.dominant_arm(F.lit(left), F.lit(right))).first()[0] == want


def test_episode_stats_against_numpy(spark):
    rng = np.random.default_rng(1)
    series = {f"e{i}": rng.uniform(0, 10, n).tolist() for i, n in enumerate((1, 2, 40, 75))}
    got = {r.k: r for r in W.episode_stats(frame(spark, series), ["k"], ["t"], "v").collect()}
    deltas = {k: np.abs(np.diff(s)) for k, s in series.items()}
    every = np.concatenate(list(deltas.values()))
    pause, spike = np.percentile(every, 10), np.percentile(every, 99)
    for k, d in deltas.items():
        r = got[k]
        assert r.t == len(series[k])
        if len(d):
            assert r.delta_mean == pytest.approx(d.mean(), abs=1e-6) and r.delta_p95 == pytest.approx(np.percentile(d, 95), abs=1e-6) and r.delta_std == pytest.approx(d.std(), abs=1e-6)
            active = d > pause
            assert r.segments == int(active[0]) + int((active[1:] & ~active[:-1]).sum())
            assert r.pause_ratio == pytest.approx((d <= pause).mean(), abs=1e-6) and r.spike_ratio == pytest.approx((d >= spike).mean(), abs=1e-6)
        else:
            assert (r.delta_mean, r.motion, r.segments, r.pause_ratio) == (None, 0.0, 0, 0.0)


def test_complexity_is_capped(spark):
    lit = F.lit
    got = spark.range(1).select(W.complexity(lit(99.0), lit(99.0), lit(1.0), lit(1.0), lit(1.0), lit(99), lit(99)), W.complexity(lit(None).cast("double"), lit(None).cast("double"), lit(1.0), lit(1.0), lit(0.0), lit(3), lit(4))).first()
    assert tuple(got) == (10.0, 1.0)


def test_longest_run_and_contact_score(spark):
    df = frame(spark, {"a": [1.0, 1.0, 0.0, 1.0, 1.0, 1.0], "b": [0.0, 0.0]})
    got = {r.k: (r.n_runs, r.longest) for r in W.longest_run(df, ["k"], ["t"], F.col("v") > 0).collect()}
    assert got == {"a": (2, 3), "b": (0, 0)}
    lit = F.lit
    assert tuple(spark.range(1).select(W.contact_score(lit(4), lit(3), lit(2)), W.contact_score(lit(1), lit(1), lit(2)), W.contact_score(lit(4), lit(3), lit(1))).first()) == (0.75, 0.0, 0.0)


def test_normalise_clips_and_guards_constants(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 2))
    x[:, 1] = 3.0
    x[0, 0] = 99.0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>")
    rows, _ = W.normalise(df, "v")
    got = np.array([r.normalised for r in rows.orderBy("i").collect()])
    clipped = np.clip(x, np.percentile(x, 1, axis=0), np.percentile(x, 99, axis=0))
    assert np.allclose(got, (clipped - clipped.mean(axis=0)) / (clipped.std(axis=0) + 1e-6))


def test_dim_stats_count_what_is_not_finite(spark):
    df = spark.createDataFrame([("a", [1.0, NAN]), ("a", [3.0, INF]), ("b", [2.0, 5.0]), ("b", [2.0, 5.0])], "k string, v array<double>")
    got = {r.dim: r for r in W.dim_stats(df, ["k"], "v").collect()}
    assert (got[0].low, got[0].high, got[0].mean, got[0].constant_ratio) == (1.0, 3.0, 2.0, 0.5)
    assert (got[1].nan_count, got[1].inf_count, got[1].constant_ratio, got[1].low) == (1, 1, 1.0, 5.0)


def test_contract(spark):
    good = [[0.0] * 14] * 60
    cases = [(good, ""), (good[:59], "too_short"), ([[0.0] * 13] * 60, "action_shape_invalid"), ([[NAN] * 14] * 60, "action_not_finite"), (None, "action_missing"), ([[INF] * 13], "action_shape_invalid;too_short;action_not_finite")]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v array<array<double>>")
    assert [r[0] for r in df.orderBy("i").select(W.contract_reasons(F.col("v"))).collect()] == [w for _, w in cases]


def test_adjacent_similarity_and_peaks(spark):
    df = spark.createDataFrame([("a", 0, [1.0, 0.0]), ("a", 1, [1.0, 0.0]), ("a", 2, [0.0, 1.0])], "k string, t int, v array<double>")
    r = W.adjacent_similarity(df, ["k"], ["t"], "v").first()
    assert (r.cos_mean, r.cos_min, r.scene_cut, r.repeat_ratio) == (0.5, 0.0, 1.0, 0.5)
    peaks = W.motion_peaks(frame(spark, {"a": [0.0, 1.0, 9.0, 8.0, 0.0]}), ["k"], ["t"], "v", 2).orderBy("peak").collect()
    assert [(p.t, p.delta) for p in peaks] == [(2, 8.0), (4, 8.0)]
