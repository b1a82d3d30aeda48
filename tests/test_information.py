"""The neighbour estimate against all pairs."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from framegate.operators import information


def psi(n):
    return -0.57721566490153286 + math.fsum(1 / i for i in range(1, n))


def brute(rows, k=3):
    """rows: (label, value)."""
    count = {y: sum(1 for z, _ in rows if z == y) for y, _ in rows}
    rows = [r for r in rows if count[r[0]] > 1]
    total = 0.0
    for i, (y, v) in enumerate(rows):
        near = sorted(abs(u - v) for j, (z, u) in enumerate(rows) if z == y and j != i)
        kk = min(k, len(near))
        r = near[kk - 1]
        m = sum(1 for _, u in rows if abs(u - v) < r or (r == 0 and u == v))
        total += psi(kk) - psi(count[y]) - psi(m)
    return psi(len(rows)) + total / len(rows)


def rows_of(seed=2, n=160):
    rng = random.Random(seed)
    rows = [(y := rng.choice("aab"), rng.gauss(2.0 * (y == "a"), 1)) for _ in range(n)]
    return rows + [("c", 0.5), ("d", 1.0), ("d", 1.5), ("e", 9.0), ("e", 9.0), ("e", 9.0), ("e", 9.0), ("e", 9.5)]


def test_digamma(spark):
    xs = [1, 2, 3, 7, 50, 12345]
    got = spark.createDataFrame([(x,) for x in xs], "x int").select(information.digamma(F.col("x"))).collect()
    assert [r[0] for r in got] == pytest.approx([psi(x) for x in xs], abs=1e-11)


@pytest.mark.parametrize("limits", [{}, {"block_rows": 7, "window_rows": 20, "range_rows": 50}])
def test_counts_and_intervals(spark, limits):
    """Without scaling and noise: exact ties, labels with fewer rows than neighbours, blocks and ranges smaller than a label."""
    rows = rows_of()
    df = spark.createDataFrame([("f", y, v) for y, v in rows] + [("g", "a", float(i % 5)) for i in range(40)], "feature string, y string, v double").repartition(5)
    blocks = {"block_rows": limits["block_rows"]} if limits else {}
    ranges = {k: v for k, v in limits.items() if k != "block_rows"}
    found = information.neighbour_intervals(df, 3, **blocks, **ranges).cache()
    m = information.values_inside(found, **ranges)
    got = sorted((r.feature, r.y, r.v, round(r.r, 12), r.m) for r in found.join(m, ["feature", "y", "place"]).collect())
    want = []
    for feature, own in (("f", [r for r in rows if r[0] != "c"]), ("g", [("a", float(i % 5)) for i in range(40)])):
        for i, (y, v) in enumerate(own):
            near = sorted(abs(u - v) for j, (z, u) in enumerate(own) if z == y and j != i)
            r = near[min(3, len(near)) - 1]
            want.append((feature, y, v, round(r, 12), sum(1 for _, u in own if abs(u - v) < r or (r == 0 and u == v))))
    assert got == sorted(want)


def test_score(spark):
    rows = rows_of(n=300)
    df = spark.createDataFrame([(i, y, v, float(i % 3), None if i % 7 else 1.0) for i, (y, v) in enumerate(rows)], "id int, y string, v double, w double, z double")
    got = {r.feature: r.score for r in information.neighbour_mutual_information(df, "y", ["v", "w", "z"], ["id"]).collect()}
    sd = (sum(v * v for _, v in rows) / len(rows) - (sum(v for _, v in rows) / len(rows)) ** 2) ** 0.5
    assert got["v"] == pytest.approx(brute([(y, v / sd) for y, v in rows]), abs=0.02) and got["v"] > 0.2
    assert got["w"] < 0.1 and 0 <= got["z"] < 0.5
    again = information.neighbour_mutual_information(df.repartition(7), "y", ["v", "w", "z"], ["id"], window_rows=30, range_rows=60, block_rows=20)
    assert {r.feature: pytest.approx(r.score, abs=1e-9) for r in again.collect()} == got
    assert information.neighbour_mutual_information(df.limit(0), "y", ["v"], ["id"]).collect() == []
