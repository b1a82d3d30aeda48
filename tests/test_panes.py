"""Windows merged from panes, and fingerprints merged from slices, against one pass over all rows."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from framegate.operators import profile_state, profiling
from framegate.streaming import panes

START = datetime(2024, 3, 1)
EVENT = "ts timestamp, event_type string, status string, prediction int, probability double, latency_ms double"


def events(n=600, seed=4):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        kind, ok = rng.choice(["single_inference", "batch_inference"]), rng.random() < 0.8
        latency = None if rng.random() < 0.1 else rng.uniform(1, 50)
        rows.append((START + timedelta(seconds=rng.randrange(4 * 3600)), kind, "success" if ok else "failed", int(ok), rng.random(), latency))
    return rows + [(START + timedelta(hours=9), "batch_inference", None, None, None, None)]


def disc(values, q):
    return sorted(values)[math.ceil(round(q * len(values), 7)) - 1] if values else None


@pytest.mark.parametrize("window,slide", [(60, 15), (30, 30), (5, 5), (120, 5)])
def test_windows_equal_those_of_all_events(spark, window, slide):
    rows = events()
    table = panes.pane_stream(spark.createDataFrame(rows, EVENT), None).cache()
    assert table.count() == len({(r[0] - START) // panes.PANE for r in rows})
    length, step = timedelta(minutes=window), timedelta(minutes=slide)
    got = {r["window_start"]: r for r in panes.request_windows(table, length, step).collect()}
    predicted = {r["window_start"]: r for r in panes.prediction_windows(table, length, step).collect()}
    closed = START + timedelta(hours=9, minutes=5)
    want, at = {}, START - length
    while at + length <= closed:
        inside = [r for r in rows if at <= r[0] < at + length]
        if inside:
            want[at] = inside
        at += step
    want = {k: v for k, v in want.items() if (k - START) % step == timedelta(0)}
    assert set(got) == set(want)
    for k, inside in want.items():
        latency = [r[5] for r in inside if r[5] is not None]
        assert got[k]["requests"] == len(inside) and got[k]["p95_latency_ms"] == disc(latency, 0.95)
        assert got[k]["avg_latency_ms"] == (pytest.approx(sum(latency) / len(latency)) if latency else None)
        single = [r for r in inside if r[1] == "single_inference" and r[2] == "success"]
        assert (k in predicted) == bool(single)
        if single:
            assert predicted[k]["total_predictions"] == len(single)
            assert predicted[k]["p90_probability"] == disc([r[4] for r in single], 0.9)


def test_windows_are_whole_panes(spark):
    table = panes.pane_stream(spark.createDataFrame([], EVENT), None)
    for window, slide in ((7, 7), (10, 3), (5, 10)):
        with pytest.raises(ValueError):
            panes.request_windows(table, timedelta(minutes=window), timedelta(minutes=slide))
    assert panes.request_windows(table, timedelta(minutes=10)).collect() == []


def table(spark, n=4000, seed=8):
    rng = random.Random(seed)
    rows = [(1e9 + rng.gauss(0, 1), None if i % 7 == 0 else i % 50, rng.choice(["a", "b", None, ""]), None) for i in range(n)]
    return spark.createDataFrame(rows, "big double, few int, word string, nothing double")


def test_merged_slices_equal_the_whole(spark, tmp_path):
    df = table(spark).cache()
    path = str(tmp_path / "states")
    assert profile_state.read_slices(spark, path).count() == 0
    part = F.pmod(F.xxhash64("big"), F.lit(5))
    for k in range(5):
        profile_state.save_slice(df.filter(part == k), path, f"part-{k}")
    profile_state.save_slice(df.filter(part == 2), path, "part-2")  # a step that is run twice
    profile_state.save_slice(df.limit(0), path, "empty")
    got = {r["feature"]: r for r in profile_state.profile_of(profile_state.read_slices(spark, path)).collect()}
    want = {r["feature"]: r for r in profiling.profile(df).collect()}
    assert set(got) == set(want)
    for c, w in want.items():
        g = got[c]
        assert g["rows"] == w["rows"] and g["missing_ratio"] == pytest.approx(w["missing_ratio"])
        assert g["unique_ratio"] == pytest.approx(w["unique_ratio"], rel=0.03)
        for m in ("mean", "std"):
            assert g[m] == (None if w[m] is None else pytest.approx(w[m], rel=1e-7))
    assert got["big"]["std"] == pytest.approx(1, abs=0.1)  # not lost to 1e9
    values = sorted(r["big"] for r in df.select("big").collect())
    for q, name in ((0.01, "p01"), (0.5, "p50"), (0.99, "p99")):
        assert abs(sum(v <= got["big"][name] for v in values) / len(values) - q) < 0.01
    assert got["nothing"]["p50"] is None and got["word"]["mean"] is None
    merged = profile_state.merge_states(profile_state.read_slices(spark, path)).filter("feature = 'big'").first()
    assert (merged["low"], merged["high"]) == (values[0], values[-1])


def test_slice_names(spark):
    for name in ("", "a/b", "a=b"):
        with pytest.raises(ValueError):
            profile_state.save_slice(spark.range(1), "/nowhere", name)
