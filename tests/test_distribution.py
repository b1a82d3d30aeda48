"""Drift against a written reference: the same numbers as the tests on two tables, and lookups against brute force."""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right

import pytest
from pyspark.sql import functions as F

from framegate.operators import distribution, drift

SCHEMA = "x double, `a b` double, k string, only_null double"


def rows(seed, n, values, kinds):
    r = random.Random(seed)
    return [
        (r.choice([None, float("nan"), *values]), r.gauss(0, 1), r.choice([None, *kinds]), None)
        for _ in range(n)
    ]


def results(tests):
    return {
        r["feature"]: tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in ("statistic", "p_value", "drifted"))
        for r in tests.collect()
    }


@pytest.fixture()
def reference(spark):
    return spark.createDataFrame(rows(1, 400, [float(i) for i in range(40)], "pqr"), SCHEMA)


@pytest.mark.parametrize("ranges,folders", [(8192, 1024), (3, 2)])
@pytest.mark.parametrize("size,values,kinds", [(60, range(-5, 60, 3), "pqz"), (1, [7], "z"), (500, range(40), "pqr")])
def test_equal_to_the_tests_on_two_tables(spark, tmp_path, reference, ranges, folders, size, values, kinds):
    saved = distribution.save_distribution(reference, str(tmp_path / "d"), range_values=ranges, folder_ranges=folders)
    batch = spark.createDataFrame(rows(2, size, [float(v) for v in values], kinds), SCHEMA)
    expected = drift.dataset_drift(reference, batch)
    found = distribution.drift_from_saved(saved, batch, range_values=ranges)
    assert results(found[0]) == results(expected[0])
    assert found[1].collect() == expected[1].collect()


def test_lookups_by_brute_force(spark, tmp_path, reference):
    saved = distribution.save_distribution(reference, str(tmp_path / "d"), range_values=3, folder_ranges=2)
    held = sorted(r["x"] for r in reference.collect() if r["x"] is not None and r["x"] == r["x"])
    asked = [-1.0, 0.0, 0.5, 7.0, 7.25, 7.5, 7.75, 39.0, 39.5]
    batch = spark.createDataFrame([("x", v, 2) for v in asked], "feature string, v double, n long")
    got = sorted((r["v"], r["n_before"], r["ref_before"], r["ref_upto"]) for r in distribution.reference_counts(saved, batch, 2).collect())
    assert got == [(v, 2 * k, bisect_left(held, v), bisect_right(held, v)) for k, v in enumerate(asked)]


def test_a_saved_reference_is_found_again(spark, tmp_path, reference):
    distribution.save_distribution(reference, str(tmp_path / "d"))
    again = distribution.load_distribution(spark, str(tmp_path / "d"))
    assert set(again.numeric) == {"x", "a b", "only_null"} and again.other == ("k",)
    tests = results(distribution.drift_from_saved(again, reference)[0])
    assert tests["x"][0] == 0 and tests["k"][0] == 0 and tests["only_null"][0] is None


def test_empty_sides(spark, tmp_path, reference):
    none = reference.limit(0)
    saved = distribution.save_distribution(none, str(tmp_path / "d"))
    for current in (reference, none):
        assert results(distribution.drift_from_saved(saved, current)[0]) == results(drift.dataset_drift(none, current)[0])
    full = distribution.save_distribution(reference, str(tmp_path / "e"))
    assert results(distribution.drift_from_saved(full, none)[0]) == results(drift.dataset_drift(reference, none)[0])


def test_only_the_folders_of_the_batch_are_read(spark, tmp_path):
    reference = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    saved = distribution.save_distribution(reference, str(tmp_path / "d"), range_values=10, folder_ranges=10)
    batch = spark.createDataFrame([("x", 5_005.0, 1)], "feature string, v double, n long")
    found = distribution.reference_counts(saved, batch, 10)
    assert [tuple(r) for r in found.collect()] == [("x", 5_005.0, 1, 0, 5_005, 5_006)]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
