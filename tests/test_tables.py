"""Sources, sinks, cleaning, validation."""

from __future__ import annotations

import json
import os

import pytest
from conftest import by, season, seasons
from pyspark.sql import functions as F

from framegate import presets
from framegate.config import CleaningConfig, ColumnContract, Roles, ValidationConfig
from framegate.functions.status import GateError
from framegate.operators import cleaning, contracts
from framegate.sources import readers, writers

RULES = ValidationConfig(non_negative=presets.CHECKED_NON_NEGATIVE)


def test_duplicates_removed(dirty):
    assert cleaning.drop_duplicate_rows(dirty).count() == 2
    assert cleaning.duplicate_count(dirty).first().asDict() == {"rows": 3, "duplicate_rows": 1}


def test_null_counts(dirty):
    assert by(cleaning.null_counts(dirty), "feature", "missing")["3P%"] == 2


def test_imputation(spark):
    rows = [
        season("a", **{"3P%": None}),
        season("b", **{"3P%": None, "3PA": 0.0}),
        season("c", **{"3P%": None, "3P Made": None}),
        season("d", **{"3P%": None, "3PA": None}),
        season("e", **{"3P%": float("nan")}),
        season("f", **{"3P%": 12.0}),
    ]
    got = by(cleaning.impute_ratio(seasons(spark, rows), presets.ROLES), "Name", "3P%")
    assert got["a"] == pytest.approx(100 / 3) and got["b"] == 0.0 and got["c"] is None and got["d"] == 0.0
    assert got["e"] == pytest.approx(100 / 3) and got["f"] == 12.0


def test_corrections(dirty):
    b = by(cleaning.clean(dirty, presets.ROLES), "Name")["B"]
    assert b["MIN"] == 48 and b["PTS"] == 0 and b["FG%"] == 100 and b["FT%"] == 0 and b["3P%"] == 100
    assert b["FGM"] == 5.5 and b["3P Made"] == 1.5 and b["FTM"] == 2.5 and b["REB"] == 4
    assert by(cleaning.clean(dirty, presets.ROLES), "Name")["A"]["REB"] == 4


def test_switches_off(dirty):
    off = CleaningConfig(False, False, False)
    assert sorted(map(str, cleaning.clean(dirty, presets.ROLES, off).collect())) == sorted(map(str, dirty.collect()))


def test_floor_comes_before_pairs(spark):
    df = spark.createDataFrame([(-5.0, -1.0)], "made double, tried double")
    roles = Roles(non_negative=("made", "tried"), pairs=(("made", "tried"),))
    assert cleaning.correct_values(df, roles).first().asDict() == {"made": 0.0, "tried": 0.0}


def test_integer_columns_keep_their_type(spark):
    df = spark.createDataFrame([(70, -2)], "m int, p int")
    out = cleaning.correct_values(df, Roles(caps={"m": 48.0}, non_negative=("p",)))
    assert out.dtypes == [("m", "int"), ("p", "int")] and tuple(out.first()) == (48, 0)


def test_rules_raise_all_errors_at_once(dirty):
    with pytest.raises(GateError) as e:
        contracts.validate_rules(dirty, presets.ROLES, RULES)
    for part in ("MIN above 48", "FG% outside", "PTS negative", "FGM above FGA", "OREB + DREB != REB"):
        assert part in str(e.value)
    contracts.validate_rules(cleaning.clean(dirty, presets.ROLES), presets.ROLES, RULES)


def test_missing_label_and_missing_columns_are_violations(spark):
    df = spark.createDataFrame([(None, 1.0)], "y int, a double")
    got = by(contracts.rule_violations(df, Roles(target="y", sum_identity=("a", "b", "c"))), "rule", "violations")
    assert got["y not 0/1"] == 1 and got["b missing from table"] == 1 and got["c missing from table"] == 1
    assert by(contracts.rule_violations(df, Roles(target="z")), "rule", "violations") == {"z missing from table": 1}


def test_sum_tolerance_is_strict(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.5)], "a double, b double, t double")
    roles = lambda tol: Roles(sum_identity=("a", "b", "t"), sum_tolerance=tol)
    count = lambda tol: contracts.rule_violations(df, roles(tol)).first()["violations"]
    assert count(0.5) == 0 and count(0.4) == 1


def test_drop_violations_keeps_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (99.0,)], "m double")
    assert cleaning.drop_violations(df, Roles(caps={"m": 48.0})).count() == 2


def test_contract(spark, dirty):
    clean = cleaning.clean(dirty, presets.ROLES)
    shuffled = clean.select(*reversed(clean.columns))
    out = contracts.validate_contract(shuffled, presets.CONTRACT)
    assert out.columns == list(presets.COLUMNS) and dict(out.dtypes)["GP"] == "int"
    with pytest.raises(GateError, match="unexpected column"):
        contracts.validate_contract(clean.withColumn("extra", F.lit(1)), presets.CONTRACT)
    with pytest.raises(GateError, match="missing column"):
        contracts.validate_contract(clean.drop("AST"), presets.CONTRACT)
    with pytest.raises(GateError, match="MIN: missing value"):
        contracts.validate_contract(clean.withColumn("MIN", F.lit(None).cast("double")), presets.CONTRACT)
    bad = clean.withColumn("GP", F.lit(2.5)).withColumn("TARGET_5Yrs", F.lit(2))
    got = by(contracts.contract_violations(bad, presets.CONTRACT), "rule", "violations")
    assert got["GP: not int"] == 2 and got["TARGET_5Yrs: outside [0, 1]"] == 2


def test_contract_on_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    got = by(contracts.contract_violations(df, [ColumnContract("b", "int")]), "rule", "violations")
    assert got == {"a: unexpected column": 1, "b: missing column": 1}


def test_feature_contract(spark):
    df = spark.createDataFrame([(120.0, "x"), (float("inf"), "y"), (None, "z")], "r double, s string")
    got = by(contracts.feature_contract(df, {"r": (0.0, 5.0), "s": (0.0, 1.0), "t": (0.0, 1.0)}), "rule", "violations")
    assert got == {
        "r: infinite": 1, "r: missing value": 1, "r: outside [0, 5]": 2, "s: not numeric": 1, "t: missing feature": 1,
    }
    with pytest.raises(GateError):
        contracts.validate_features(df, {"r": (0.0, 5.0)})


# -- sources and sinks ----------------------------------------------------------------------


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_contract(spark, tmp_path):
    ok = write(tmp_path / "ok.csv", "a,b,c\n1,2,\n")
    df = readers.read_csv_contract(spark, ok, ["a", "c"])
    assert df.count() == 1 and df.columns == ["a", "b", "c"]
    with pytest.raises(FileNotFoundError):
        readers.read_csv_contract(spark, str(tmp_path / "none.csv"), ["a"])
    with pytest.raises(readers.SourceError, match="empty"):
        readers.read_csv_contract(spark, write(tmp_path / "empty.csv", ""), ["a"])
    with pytest.raises(readers.SourceError, match="empty"):
        readers.read_csv_contract(spark, write(tmp_path / "header.csv", "a,b\n"), ["a"])
    with pytest.raises(readers.SourceError, match="z"):
        readers.read_csv_contract(spark, ok, ["a", "z"])


def test_csv_schema_by_name(spark, tmp_path):
    schema = spark.createDataFrame([], "b double, a string").schema
    df = readers.read_csv_contract(spark, write(tmp_path / "x.csv", "a,b,more\n1,2,3\n"), ["a"], schema)
    assert df.dtypes == [("a", "string"), ("b", "double"), ("more", "string")] and tuple(df.first()) == ("1", 2.0, "3")


def test_read_table_suffix(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t.parquet"))
    assert readers.read_table(spark, str(tmp_path / "t.parquet"), strict=True).count() == 2
    assert readers.read_table(spark, write(tmp_path / "t.csv", "a\n1\n"), strict=True).count() == 1
    with pytest.raises(readers.SourceError):
        readers.read_table(spark, str(tmp_path / "t.xlsx"), strict=True)


def test_events_skip_bad_lines(spark, tmp_path):
    good = {"event_type": "single_inference", "timestamp_utc": "2024-01-01T00:00:01.5+00:00", "request_id": "1",
            "features": {"a": 1.0}, "prediction": 1, "probability": 0.7, "status": "success", "error_message": None}
    lines = [json.dumps(good), "not json", json.dumps({**good, "request_id": "2"})[:-3], '{"request_id": "3", "probability": NaN}', ""]
    df = readers.read_events(spark, write(tmp_path / "log.jsonl", "\n".join(lines)))
    assert df.count() == 2 and {r["request_id"] for r in df.select("request_id").collect()} == {"1", "3"}
    assert df.filter("request_id = '1'").first()["ts"].microsecond == 500000
    assert df.select("probability").collect()[0][0] == 0.7


def test_write_table_sorts_by_present_keys(spark, tmp_path):
    df = spark.range(100).select((F.col("id") * 37 % 101).alias("k"), "id").repartition(5)
    writers.write_table(df, str(tmp_path / "s.parquet"), ["absent", "k"], partitions=3)
    files = sorted(f for f in os.listdir(tmp_path / "s.parquet") if f.endswith(".parquet"))
    keys = [r["k"] for f in files for r in spark.read.parquet(str(tmp_path / "s.parquet" / f)).collect()]
    assert keys == sorted(keys) and len(keys) == 100


def test_reports_and_event_log(spark, tmp_path):
    report = spark.createDataFrame([("a", ["x", "y"])], "name string, cols array<string>")
    writers.write_report(report, str(tmp_path / "r"))
    assert spark.read.csv(str(tmp_path / "r"), header=True).first()["cols"] == "x; y"
    with pytest.raises(ValueError):
        writers.write_report(report, str(tmp_path / "r2"), "xls")
    events = spark.createDataFrame([("1", "success"), ("2", "failed")], "request_id string, status string")
    for _ in range(2):
        writers.append_events(events, str(tmp_path / "log"), str(tmp_path / "bad"))
    assert readers.read_events(spark, str(tmp_path / "log")).count() == 4
    assert readers.read_events(spark, str(tmp_path / "bad")).count() == 2


def test_fingerprint_ignores_layout(spark):
    df = spark.range(500).select("id", (F.col("id") * 1.5).alias("x"))
    prints = lambda d: sorted(map(tuple, writers.fingerprint(d).collect()))
    assert prints(df) == prints(df.repartition(7).orderBy(F.desc("x")))
    assert prints(df) != prints(df.withColumn("x", F.col("x") + (F.col("id") == 3).cast("int")))


def test_fingerprint_of_maps(spark):
    one = spark.createDataFrame([({"a": 1, "b": 2},)], "m map<string,int>")
    other = spark.createDataFrame([({"b": 2, "a": 1},)], "m map<string,int>")
    assert writers.fingerprint(one).collect() == writers.fingerprint(other).collect()


def test_a_hot_sort_key_is_split(spark, tmp_path):
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    writers.write_table(df, str(tmp_path / "t"), ["k"], partitions=8)
    files = spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 8 and max(r["count"] for r in files) < 1000


def test_projection_and_feature_sets(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `b%` int")
    assert readers.project(df, ["b%"]).columns == ["b%"]
    with pytest.raises(ValueError):
        readers.project(df, ["c"])
    assert readers.feature_set("all", ["a"], ["b"]) == ["a", "b"]
    assert readers.feature_set("engineered", ["a"], ["b"]) == ["b"]
    for bad in (("other", ["a"], []), ("explicit", ["a"], [])):
        with pytest.raises(ValueError):
            readers.feature_set(*bad)
