"""Null handling, exact order statistics, running totals, neighbours, special functions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import by
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framegate.functions import nulls, status
from framegate.functions.cumulative import running_totals
from framegate.functions.hashing import row_hash
from framegate.functions.longform import summarise
from framegate.functions.neighbours import nearest_neighbours, probes_per_point
from framegate.functions.quantiles import exact_quantiles, quantile_frame
from framegate.functions.special import f_tail, regularised_beta

NAN, INF = float("nan"), float("inf")


@pytest.fixture()
def gappy(spark):
    return spark.createDataFrame([(1.0, 2.0), (NAN, 2.0), (None, 2.0), (60.0, None), (-3.0, 1.0)], "a double, b double")


def test_clip_keeps_missing(gappy):
    a = nulls.clean_value(gappy, "a")
    got = [r[0] for r in gappy.select(nulls.clip(a, 0.0, 48.0)).collect()]
    assert got == [1.0, None, None, 48.0, 0.0]


def test_smaller_needs_both(gappy):
    got = [r[0] for r in gappy.select(nulls.smaller_of(nulls.clean_value(gappy, "a"), F.col("b"))).collect()]
    assert got == [1.0, None, None, None, -3.0]


def test_missing_is_no_violation(gappy):
    flagged = gappy.select(nulls.holds(nulls.clean_value(gappy, "a") > 48).alias("x"))
    assert [r[0] for r in flagged.collect()] == [False, False, False, True, False]


def test_safe_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 0.0), (4.0, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(nulls.safe_ratio(F.col("n"), F.col("d"), 1e-9)).collect()]
    assert got[0] == pytest.approx(5e9) and got[1] == 0.0 and got[2] == pytest.approx(2.0)


def test_summarise_splits_wide_tables(spark):
    columns = [f"c{i}" for i in range(150)]
    df = spark.range(3).select(*[(F.col("id") + i).cast("double").alias(c) for i, c in enumerate(columns)])
    table = summarise(df, columns, {m: (lambda c, f=f: f(c)) for m, f in {"lo": F.min, "hi": F.max, "n": F.count}.items()})
    got = by(table, "feature")
    assert len(got) == 150 and got["c149"]["lo"] == 149 and got["c149"]["hi"] == 151


def check_quantiles(df, columns, probs, **settings_):
    got = exact_quantiles(df, columns, probs, **settings_)
    pdf = df.toPandas()
    for c in columns:
        values = pdf[c].dropna().astype(float).to_numpy()
        for p, g in zip(probs, got[c]):
            want = None if not len(values) else float(np.quantile(values, p))
            assert g == (want if want is None else pytest.approx(want, rel=1e-12, abs=1e-300)), (c, p)


PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


def test_quantiles_many_passes(spark):
    rng = random.Random(1)
    rows = [
        (rng.gauss(0, 1), math.exp(rng.gauss(0, 40)), float(rng.randrange(3)), 7.0 if rng.random() < 0.4 else rng.random(), None, i)
        for i in range(4000)
    ]
    df = spark.createDataFrame(rows, "normal double, wild double, few double, hot double, empty double, whole int")
    check_quantiles(df, df.columns, PROBS, direct_rows=30, bins=16)
    check_quantiles(df, df.columns, PROBS)


def test_quantiles_uneven_values(spark):
    """Powers of two defeat equal-width bins; the rank split must still finish."""
    df = spark.createDataFrame([(2.0**-i,) for i in range(1000)] + [(0.0,)] * 500, "x double")
    check_quantiles(df, ["x"], PROBS, direct_rows=10, bins=8)


def test_quantiles_infinite_values(spark):
    df = spark.createDataFrame([(-INF,)] * 40 + [(float(i),) for i in range(100)] + [(INF,)] * 40, "x double")
    got = exact_quantiles(df, ["x"], [0.0, 0.5, 1.0], direct_rows=5, bins=8)["x"]
    assert got == [-INF, 49.5, INF]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, width=32, allow_infinity=False), min_size=1, max_size=60), st.floats(0, 1))
def test_quantiles_any_values(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, ["x"], [p], direct_rows=4, bins=4)["x"][0]
    assert got == pytest.approx(float(np.quantile(np.array(values, dtype=float), p)), rel=1e-9, abs=1e-30)


def test_quantile_frame_methods(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    exact = quantile_frame(df, ["x"], [0.5], ["p50"]).first()
    approx = quantile_frame(df, ["x"], [0.5], ["p50"], method="approx").first()
    assert exact["p50"] == 500 and abs(approx["p50"] - 500) <= 1
    with pytest.raises(ValueError):
        quantile_frame(df, ["x"], [0.5], ["p50"], method="guess")


@pytest.mark.parametrize("groups", [(), ("g",)])
def test_running_totals_in_ranges(spark, groups):
    df = spark.range(3000).select(
        (F.col("id") % 2).alias("g"), F.exp(F.col("id") / 50.0).alias("v"), (F.col("id") % 7).alias("n")
    )
    whole = running_totals(df, "v", ["n"], groups=groups)
    ranged = running_totals(df, "v", ["n"], groups=groups, window_rows=100, range_rows=200)
    assert sorted(whole.collect()) == sorted(ranged.collect())
    assert "Window" in ranged._jdf.queryExecution().toString() and "range_" in ranged._jdf.queryExecution().toString()


def brute_force(points, k):
    out = {}
    for key, v in points:
        d = sorted((math.dist(v, w), other) for other, w in points if other != key)
        out[key] = [x for x, _ in d[:k]]
    return out


@pytest.mark.parametrize("mode", ["broadcast", "shards"])
def test_neighbours_match_brute_force(spark, mode):
    rng = random.Random(3)
    points = [(i, [rng.gauss(i % 4 * 3, 1), rng.gauss(0, 1)]) for i in range(300)]
    points += [(1000 + i, [1.0, 1.0]) for i in range(80)]  # a third of the points are copies of one
    df = spark.createDataFrame(points, "key bigint, vec array<double>").repartition(4)
    limits = {} if mode == "broadcast" else {"broadcast_points": 10, "shard_points": 25}
    got = nearest_neighbours(df, 4, **limits).collect()
    want = brute_force(points, 4)
    assert len(got) == len(points)
    for r in got:
        assert [math.dist(r["vec"], n) for n in r["near"]] == pytest.approx(want[r["key"]])


@pytest.mark.parametrize("mode", ["broadcast", "shards"])
def test_copies_are_the_nearest_neighbours(spark, mode):
    df = spark.createDataFrame([(1, [0.0], 3), (2, [1.0], 1), (3, [5.0], 2), (4, [6.0], 9)], "key bigint, vec array<double>, n bigint")
    limits = {} if mode == "broadcast" else {"broadcast_points": 1, "shard_points": 2}
    got = {r["key"]: [v[0] for v in r["near"]] for r in nearest_neighbours(df, 4, **limits).collect()}
    assert got == {1: [0.0, 0.0, 1.0, 5.0], 2: [0.0, 0.0, 0.0, 5.0], 3: [5.0, 6.0, 6.0, 6.0], 4: [6.0] * 4}


def related_features(n=1500, seed=5):
    """20 features that three hidden numbers move, with a little noise of their own, some of them large numbers."""
    rng = random.Random(seed)
    weights = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(20)]
    rows = []
    for i in range(n):
        hidden = [rng.gauss(i % 5, 1.0) for _ in range(3)]
        rows.append((i, [1e6 * (j == 7) + sum(w * h for w, h in zip(weights[j], hidden)) + rng.gauss(0, 0.05) for j in range(20)]))
    return rows


def test_boxes_close_shards_of_many_features(spark):
    points = related_features()
    df = spark.createDataFrame(points, "key bigint, vec array<double>").repartition(4)
    want = {r["key"]: r["near"] for r in nearest_neighbours(df, 5).collect()}
    got = {r["key"]: r["near"] for r in nearest_neighbours(df, 5, broadcast_points=10, shard_points=40).collect()}
    assert got == want
    with_boxes, without = (probes_per_point(df, 5, shard_points=40, axes=a).first() for a in (8, 0))
    assert with_boxes["points"] == 1500 and with_boxes["shards"] == without["shards"] > 30
    assert with_boxes["probes"] < 0.7 * without["probes"]


def test_neighbours_need_enough_points(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "key bigint, vec array<double>")
    with pytest.raises(ValueError):
        nearest_neighbours(df, 2)


def test_f_tail_known_values():
    # Upper 5 % points of the F distribution from standard tables.
    for f, d1, d2 in [(4.9646, 1, 10), (3.4928, 2, 20), (2.6896, 4, 30), (3.8415, 1, 10_000_000), (3.8415, 1, 1e14), (2.2141, 5, 1e12)]:
        assert f_tail(f, d1, d2) == pytest.approx(0.05, abs=2e-5)
    assert f_tail(0.0, 1, 5) == 1.0 and f_tail(INF, 1, 5) == 0.0
    assert regularised_beta(0.5, 2.0, 2.0) == pytest.approx(0.5)
    assert regularised_beta(0.25, 1.0, 3.0) == pytest.approx(1 - 0.75**3)


def test_status_lattice(spark):
    checks = spark.createDataFrame([("pass", "a"), ("fail", "b"), ("warn", "c")], "status string, message string")
    row = status.overall(checks).first()
    assert row["status"] == "fail" and row["details"] == ["b", "c"]
    assert status.overall(checks.filter("false")).first()["status"] == "pass"
    with pytest.raises(status.GateError, match="b"):
        status.enforce(checks)
    status.enforce(checks.filter("status <> 'fail'"))


def test_row_hash_is_uniform_and_stable(spark):
    df = spark.range(20000).select(row_hash(["id"], 1).alias("h"), row_hash(["id"], 1, portable=True).alias("p"))
    r = df.agg(F.min("h"), F.max("h"), F.avg(F.col("h") / 2.0**52), F.avg(F.col("p") / 2.0**52), F.min("p"), F.count_distinct("h")).first()
    assert r[0] >= 0 and r[1] < 2**52 and abs(r[2] - 0.5) < 0.01 and abs(r[3] - 0.5) < 0.01 and r[4] >= 0 and r[5] == 20000


def test_neighbour_functions_travel_by_value(tmp_path):
    """Executors need not have the package: the pickled function loads where it cannot be imported."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from framegate.functions import neighbours

    file = tmp_path / "fn.pickle"
    file.write_bytes(cloudpickle.dumps(neighbours._candidates))
    code = "import pickle, sys; pickle.load(open(sys.argv[1], 'rb')); assert 'framegate' not in sys.modules"
    subprocess.run([sys.executable, "-I", "-c", code, str(file)], cwd=tmp_path, check=True, timeout=120)
