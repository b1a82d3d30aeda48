"""Profiles, gates, drift and outliers on the driver tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from framegate.bindings.registry import FLAGGED, GAPS, MEASURES, flagged, gaps, joined, query, rounded, table
from framegate.config import AnomalyConfig, DriftConfig, StatCheckConfig
from framegate.functions.longform import summarise
from framegate.functions.quantiles import exact_quantiles
from framegate.functions.status import GateError, enforce, overall
from framegate.operators import anomaly, distribution, drift, profile_state, profiling
from framegate.session import shared_dir
from framegate.sources.writers import write_report

_PROFILED = [*MEASURES, "l_returnflag", "l_shipdate", "l_suppkey"]


def _missing_unique_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, COUNT(*) AS rows, ROUND(1 - COUNT({c}) / COUNT(*), 9) AS missing_ratio, "
        f"ROUND((COUNT(DISTINCT {c}) + CAST(COUNT(*) > COUNT({c}) AS INTEGER)) / COUNT(*), 9) AS unique_ratio FROM {source}"
        for c in columns
    )


@query("profile_missing_unique", f"WITH {GAPS} {_missing_unique_sql('gaps', _PROFILED)}")
def profile_missing_unique(spark, d):
    return rounded(profiling.missing_and_unique(gaps(spark, d), _PROFILED), 9)


def _numeric_sql(source: str, columns: list[str], digits: int = 4) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(AVG({c}), {digits}) AS mean, ROUND(STDDEV_SAMP({c}), {digits}) AS std, "
        f"ROUND(QUANTILE_CONT({c}, 0.01), {digits}) AS p01, ROUND(QUANTILE_CONT({c}, 0.5), {digits}) AS p50, "
        f"ROUND(QUANTILE_CONT({c}, 0.99), {digits}) AS p99 FROM {source}"
        for c in columns
    )


@query("profile_numeric", f"WITH {GAPS} {_numeric_sql('gaps', MEASURES)}")
def profile_numeric(spark, d):
    return rounded(profiling.numeric_summary(gaps(spark, d), MEASURES), 4)


@query(
    "quantiles_of_large_keys",
    """WITH k AS (SELECT 9007199254740993 + o_orderkey * 2 AS k FROM orders), s AS (SELECT k, ROW_NUMBER() OVER (ORDER BY k) - 1 AS r, COUNT(*) OVER () AS n FROM k)
SELECT q, CAST(k AS VARCHAR) AS value FROM s, (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) t(q) WHERE r = (n - 1) * q""",
)
def quantiles_of_large_keys(spark, d):
    """Whole numbers above 2^53 keep every digit."""
    keys = table(spark, d, "orders").select((F.lit(9007199254740993) + F.col("o_orderkey") * 2).alias("k"))
    found = exact_quantiles(keys, ["k"], [0.0, 1.0])["k"]
    return spark.createDataFrame([(q, str(v)) for q, v in zip((0.0, 1.0), found)], "q double, value string")


@query(
    "profile_summary",
    f"WITH {GAPS} SELECT * FROM ({_numeric_sql('gaps', ['l_tax', 'l_quantity'], 3)})",
)
def profile_summary(spark, d):
    return profiling.profile_summary(profiling.profile(gaps(spark, d).select(*MEASURES)), ["l_tax", "l_quantity", "absent"])


@query(
    "profile_approx",
    "SELECT feature, q AS quantile, TRUE AS within FROM (VALUES "
    + ", ".join(f"('{c}')" for c in MEASURES)
    + ") f(feature), (VALUES ('p01'), ('p50'), ('p99')) q(q)",
)
def profile_approx(spark, d):
    """Sketched quantiles lie within the rank error that the sketch promises."""
    rows = gaps(spark, d)
    sketch = {r["feature"]: r for r in profiling.profile(rows.select(*_PROFILED), method="approx", distinct="approx").collect()}
    probs, slack = {"p01": 0.01, "p50": 0.5, "p99": 0.99}, 1 / 10_000
    checks = []
    for c in MEASURES:
        n = F.count(c)
        for name, p in probs.items():
            v = F.lit(sketch[c][name])
            within = (F.count_if(F.col(c) < v) / n <= p + slack + 1 / n) & (F.count_if(F.col(c) <= v) / n >= p - slack - 1 / n)
            checks.append(F.struct(F.lit(c).alias("feature"), F.lit(name).alias("quantile"), within.alias("within")))
    return rows.agg(F.array(*checks).alias("c")).select(F.inline("c"))


@query(
    "target_distribution",
    "SELECT quality AS value, COUNT(*) AS rows, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 9) AS share FROM labels GROUP BY quality",
)
def target_distribution(spark, d):
    return rounded(profiling.target_distribution(table(spark, d, "labels"), "quality"), 9)


@query(
    "target_balance",
    """SELECT l_returnflag AS value, COUNT(*) AS rows, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 6) AS percent
FROM lineitem GROUP BY l_returnflag""",
)
def target_balance(spark, d):
    return rounded(profiling.target_distribution(table(spark, d, "lineitem"), "l_returnflag", as_percent=True, keep_missing=False))


_Z = StatCheckConfig(zscore=1.5, missing_warn=0.09, missing_fail=0.10)


def _z_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS feature, AVG(CAST(ABS(({c} - m) / s) > 1.5 AS DOUBLE)) AS outlier_rate "
        f"FROM gaps, (SELECT AVG({c}) AS m, STDDEV_SAMP({c}) AS s FROM gaps) WHERE {c} IS NOT NULL"
    )


_Z_SQL = " UNION ALL ".join(_z_sql(c) for c in MEASURES)


@query("zscore_rates", f"WITH {GAPS} SELECT feature, ROUND(outlier_rate, 9) AS outlier_rate FROM ({_Z_SQL})")
def zscore_rates(spark, d):
    return rounded(profiling.zscore_rates(gaps(spark, d), MEASURES, _Z), 9)


@query(
    "stat_checks",
    f"""WITH {GAPS}, mu AS ({_missing_unique_sql('gaps', [*MEASURES, 'l_returnflag'])}), z AS ({_Z_SQL}),
names AS (
  SELECT 'missingness_warn' AS "check", 1 AS lvl, feature FROM mu WHERE missing_ratio >= 0.09
  UNION ALL SELECT 'missingness_fail', 2, feature FROM mu WHERE missing_ratio >= 0.10
  UNION ALL SELECT 'near_constant', 1, feature FROM mu WHERE unique_ratio <= 0.01
  UNION ALL SELECT 'outlier_rate', 1, feature FROM z WHERE outlier_rate >= 0.05),
c AS (SELECT * FROM (VALUES ('missingness_warn'), ('missingness_fail'), ('near_constant'), ('outlier_rate'), ('target_share')) t("check"))
SELECT c."check", CASE COALESCE(MAX(lvl), 0) WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS status,
  COALESCE(STRING_AGG(feature, ',' ORDER BY feature), '') AS columns
FROM c LEFT JOIN names USING ("check") GROUP BY c."check" """,
)
def stat_checks(spark, d):
    rows = gaps(spark, d).select(*MEASURES, "l_returnflag")
    checks = profiling.stat_checks(rows, "l_returnflag", _Z)
    return joined(checks.select("check", "status", "columns"), "columns")


@query(
    "stat_gate",
    f"""WITH {GAPS}, mu AS ({_missing_unique_sql('gaps', [*MEASURES, 'l_returnflag'])})
SELECT CASE WHEN MAX(missing_ratio) >= 0.10 THEN 'fail'
  WHEN MAX(missing_ratio) >= 0.09 OR MIN(unique_ratio) <= 0.01 THEN 'warn' ELSE 'pass' END AS status FROM mu""",
)
def stat_gate(spark, d):
    rows = gaps(spark, d).select(*MEASURES, "l_returnflag")
    return overall(profiling.stat_checks(rows, "l_returnflag", StatCheckConfig(missing_warn=0.09, missing_fail=0.10))).select("status")


# -- drift ----------------------------------------------------------------------------------

_EARLY = "o_orderdate < TIMESTAMP '1998-01-01 00:00:00'"
_ORDER_COLS = ["o_totalprice", "o_custkey"]


def _two_periods(spark, d):
    """Orders before and from 1998; late prices are scaled and partly missing, so that something moved."""
    orders = table(spark, d, "orders")
    late = orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    price = F.when(F.col("o_custkey") % 10 != 0, F.col("o_totalprice") * 1.3)
    early = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return (
        early.select(*_ORDER_COLS),
        late.select(price.alias("o_totalprice"), "o_custkey", F.col("o_orderkey").cast("double").alias("o_new")),
    )


_PERIODS = f"""early AS (SELECT o_totalprice, o_custkey FROM orders WHERE {_EARLY}),
late AS (SELECT CASE WHEN o_custkey % 10 <> 0 THEN o_totalprice * 1.3::DOUBLE END AS o_totalprice, o_custkey,
  CAST(o_orderkey AS DOUBLE) AS o_new FROM orders WHERE NOT ({_EARLY}))"""


def _side_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, AVG({c}) AS mean, QUANTILE_CONT({c}, 0.5) AS p50, QUANTILE_CONT({c}, 0.99) AS p99, "
        f"STDDEV_SAMP({c}) AS std, 1 - COUNT({c}) / COUNT(*) AS missing FROM {source}"
        for c in columns
    )


_SIDES = f"""{_PERIODS}, b AS ({_side_sql('early', _ORDER_COLS)}), c AS ({_side_sql('late', [*_ORDER_COLS, 'o_new'])})"""


@query(
    "profile_drift",
    f"""WITH {_SIDES}, r AS (SELECT feature, ABS(c.p50 - b.p50) / (ABS(b.p50) + 1e-8) AS relative_change FROM c JOIN b USING (feature))
SELECT feature, ROUND(relative_change, 6) AS relative_change,
  CASE WHEN relative_change >= 0.5 THEN 'fail' WHEN relative_change >= 0.2 THEN 'warn' ELSE 'pass' END AS status FROM r""",
)
def profile_drift(spark, d):
    early, late = _two_periods(spark, d)
    out = drift.profile_drift(profiling.profile(late), profiling.profile(early), DriftConfig())
    return rounded(out.drop("message"))


def _shift_sql() -> str:
    out = []
    for m in ("mean", "p50", "p99", "std"):
        pct = f"CASE WHEN ABS(b.{m}) >= 1e-12 THEN (c.{m} - b.{m}) / b.{m} * 100 END"
        out += [
            f"ROUND(b.{m}, 4) AS baseline_{m}", f"ROUND(c.{m}, 4) AS current_{m}",
            f"ROUND(c.{m} - b.{m}, 4) AS {m}_delta", f"ROUND({pct}, 4) AS {m}_delta_pct",
        ]
    size = lambda m: f"COALESCE(ABS((c.{m} - b.{m}) / b.{m} * 100), 0)"
    return (
        f"SELECT COALESCE(b.feature, c.feature) AS feature, {', '.join(out)}, ROUND(b.missing, 4) AS baseline_missing, "
        "ROUND(c.missing, 4) AS current_missing, ROUND(c.missing - b.missing, 4) AS missing_delta, "
        f"ROUND({size('mean')} + {size('std')} + COALESCE(ABS(c.missing - b.missing), 0) * 100, 4) AS shift_score "
        "FROM b FULL JOIN c ON b.feature = c.feature"
    )


@query("distribution_shift", f"WITH {_SIDES} {_shift_sql()}")
def distribution_shift(spark, d):
    early, late = _two_periods(spark, d)
    return rounded(drift.distribution_shift(profiling.profile(early), profiling.profile(late)), 4)


@query("top_shifted", f"WITH {_SIDES}, s AS ({_shift_sql()}) SELECT feature, shift_score FROM s ORDER BY shift_score DESC, feature LIMIT 2")
def top_shifted(spark, d):
    early, late = _two_periods(spark, d)
    shift = drift.distribution_shift(profiling.profile(early), profiling.profile(late))
    return rounded(drift.top_shifted(shift, 2).select("feature", "shift_score"), 4)


@query(
    "overlay_histogram",
    f"""WITH {_PERIODS}, v AS (SELECT 'early' AS side, o_totalprice AS x FROM early UNION ALL SELECT 'late', o_totalprice FROM late),
e AS (SELECT MIN(x) AS lo, MAX(x) AS hi, LEAST(40, GREATEST(10, CAST(FLOOR(SQRT(COUNT(x))) AS INTEGER))) AS k FROM v),
b AS (SELECT side, CAST(LEAST(FLOOR((x - lo) / (hi - lo) * k), k - 1) AS INTEGER) AS bin FROM v, e WHERE x IS NOT NULL)
SELECT 'o_totalprice' AS feature, side, bin, ROUND(ANY_VALUE(lo + (hi - lo) / k * bin), 6) AS low,
  ROUND(ANY_VALUE(lo + (hi - lo) / k * (bin + 1)), 6) AS high, COUNT(*) AS n FROM b, e GROUP BY side, bin""",
)
def overlay_histogram(spark, d):
    early, late = _two_periods(spark, d)
    return rounded(drift.overlay_histogram({"early": early, "late": late}, ["o_totalprice"]))


_HALF = "TIMESTAMP '2024-01-16 00:00:00'"


def _event_halves(spark, d):
    events = table(spark, d, "events")
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    late = events.filter(F.col("ts") >= half)
    return (
        events.filter(F.col("ts") < half).select("value", "event_type"),
        late.select((F.col("value") * 1.1).alias("value"), F.when(F.col("event_type") == "view", "click").otherwise(F.col("event_type")).alias("event_type")),
    )


_HALVES = f"""early AS (SELECT value, event_type FROM events WHERE ts < {_HALF}),
late AS (SELECT value * 1.1::DOUBLE AS value, CASE event_type WHEN 'view' THEN 'click' ELSE event_type END AS event_type FROM events WHERE ts >= {_HALF})"""

_KS_SQL = f"""{_HALVES}, v AS (SELECT value AS x, 1 AS a, 0 AS b FROM early UNION ALL SELECT value, 0, 1 FROM late),
g AS (SELECT x, SUM(a) AS a, SUM(b) AS b FROM v GROUP BY x),
r AS (SELECT SUM(a) OVER (ORDER BY x) / (SELECT COUNT(*) FROM early) AS fa, SUM(b) OVER (ORDER BY x) / (SELECT COUNT(*) FROM late) AS fb FROM g),
ks AS (SELECT 'value' AS feature, MAX(ABS(fa - fb)) AS statistic FROM r)"""

_PSI_SQL = """pa AS (SELECT event_type, COUNT(*) / (SELECT COUNT(*) FROM early) AS p FROM early GROUP BY event_type),
pb AS (SELECT event_type, COUNT(*) / (SELECT COUNT(*) FROM late) AS q FROM late GROUP BY event_type),
pq AS (SELECT GREATEST(COALESCE(p, 0), 1e-4) AS p, GREATEST(COALESCE(q, 0), 1e-4) AS q FROM pa FULL JOIN pb USING (event_type)),
psi AS (SELECT 'event_type' AS feature, SUM((q - p) * LN(q / p)) AS statistic FROM pq)"""


# The p-value's series; x is the statistic times the root of the sample size.
KS_P = "LEAST(GREATEST(" + " + ".join(f"{2 * (-1) ** (k - 1)} * EXP(-2 * {k * k} * x * x)" for k in range(1, 31)) + ", 0), 1)"


@query(
    "ks_drift",
    f"""WITH {_KS_SQL}, z AS (SELECT feature, statistic, statistic * SQRT((SELECT COUNT(*) FROM early) * (SELECT COUNT(*) FROM late) / (SELECT COUNT(*) FROM events)) AS x FROM ks),
p AS (SELECT feature, statistic, CASE WHEN x < 0.2 THEN 1 ELSE {KS_P} END AS p FROM z)
SELECT feature, ROUND(statistic, 9) AS statistic, ROUND(CAST(p AS DOUBLE), 9) AS p_value, p < 0.05 AS drifted FROM p""",
)
def ks_drift(spark, d):
    early, late = _event_halves(spark, d)
    return rounded(drift.ks_test(early, late, ["value"]), 9)


def _six_sides(spark, d):
    """Two periods of orders with three numbers and three categories, one number moved."""
    o = table(spark, d, "orders")
    late = F.year("o_orderdate") >= 1997
    price = F.col("o_totalprice")
    side = o.select(
        price.alias("moved"), price.alias("price"), (F.col("o_custkey") % 100).cast("double").alias("cust"), "o_orderstatus", "o_orderpriority",
        F.concat(F.lit("p"), (F.col("o_custkey") % 3).cast("string")).alias("third"), late.alias("late"),
    )
    return side.filter(~F.col("late")).drop("late"), side.filter("late").withColumn("moved", F.col("moved") * 1.2).drop("late")


_SIX_SIDES = """s AS (SELECT o_totalprice * CASE WHEN YEAR(o_orderdate) >= 1997 THEN 1.2::DOUBLE ELSE 1 END AS moved, o_totalprice AS price, CAST(o_custkey % 100 AS DOUBLE) AS cust,
  o_orderstatus, o_orderpriority, 'p' || (o_custkey % 3) AS third, YEAR(o_orderdate) >= 1997 AS late FROM orders), n AS (SELECT COUNT(*) FILTER (NOT late) AS a, COUNT(*) FILTER (late) AS b FROM s)"""


def _six_sql() -> str:
    numbers = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, MAX(ABS(fa - fb)) AS statistic FROM (SELECT SUM(a) OVER (ORDER BY v) / (SELECT a FROM n) AS fa, SUM(b) OVER (ORDER BY v) / (SELECT b FROM n) AS fb
  FROM (SELECT {c} AS v, COUNT(*) FILTER (NOT late) AS a, COUNT(*) FILTER (late) AS b FROM s GROUP BY {c}))"""
        for c in ("moved", "price", "cust")
    )
    groups = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, SUM((q - p) * LN(q / p)) AS statistic FROM (SELECT GREATEST(COUNT(*) FILTER (NOT late) / (SELECT a FROM n), 1e-4) AS p,
  GREATEST(COUNT(*) FILTER (late) / (SELECT b FROM n), 1e-4) AS q FROM s GROUP BY {c})"""
        for c in ("o_orderstatus", "o_orderpriority", "third")
    )
    return f"""WITH {_SIX_SIDES}, k AS ({numbers}), g AS ({groups}),
z AS (SELECT feature, statistic, statistic * SQRT((SELECT a * b / (a + b) FROM n)) AS x FROM k),
p AS (SELECT feature, statistic, CASE WHEN x < 0.2 THEN 1 ELSE {KS_P} END AS p FROM z)
SELECT feature, ROUND(statistic, 9) AS statistic, ROUND(CAST(p AS DOUBLE), 9) AS p_value, p < 0.05 AS drifted FROM p
UNION ALL SELECT feature, ROUND(CAST(statistic AS DOUBLE), 9), CAST(NULL AS DOUBLE), statistic >= 0.1 FROM g"""


@query("dataset_drift_columns", _six_sql())
def dataset_drift_columns(spark, d):
    """Six columns, each table scanned once for the numbers and once for the categories."""
    return rounded(drift.dataset_drift(*_six_sides(spark, d))[0], 9)


@query("drift_saved_reference", _six_sql())
def drift_saved_reference(spark, d):
    """The same six columns; the earlier table is counted, ordered and written, the later one looks its values up in it."""
    early, late = _six_sides(spark, d)
    reference = distribution.save_distribution(early, f"{shared_dir(spark)}/framegate/reference-{uuid.uuid4().hex}")
    return rounded(distribution.drift_from_saved(reference, late)[0], 9)


@query(
    "drift_states",
    """SELECT * FROM (VALUES ('off', 'disabled'), ('no_profile', 'skipped_no_profile'), ('no_path', 'skipped_no_path'), ('no_baseline', 'no_baseline'),
('baseline', 'compared')) t("case", state)""",
)
def drift_states(spark, d):
    """What a drift step does, with a profile of the events and with a baseline that was written and one that was not."""
    path = f"{shared_dir(spark)}/framegate/baseline-{uuid.uuid4().hex}"
    profile = profiling.profile(table(spark, d, "events").select("value"))
    write_report(profile, path, "parquet")
    there = spark.read.parquet(path).count() > 0
    cases = {
        "off": (False, there, path, there),
        "no_profile": (True, False, path, there),
        "no_path": (True, there, None, False),
        "no_baseline": (True, there, path + "-", False),
        "baseline": (True, there, path, there),
    }
    return spark.createDataFrame([(k, drift.drift_state(*v)) for k, v in cases.items()], "case string, state string")


_MERGED_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, COUNT(*) AS rows, ROUND(1 - COUNT({c}) / COUNT(*), 9) AS missing_ratio, ROUND(CAST(AVG({c}) AS DOUBLE), 4) AS mean, ROUND(CAST(STDDEV_SAMP({c}) AS DOUBLE), 4) AS std,
  CAST(MIN({c}) AS DOUBLE) AS low, CAST(MAX({c}) AS DOUBLE) AS high, TRUE AS distinct_within, TRUE AS ranks_within FROM gaps"""
    for c in [*MEASURES, "l_suppkey"]
)


@query("profile_merged_slices", f"WITH {GAPS} {_MERGED_SQL}")
def profile_merged_slices(spark, d):
    """Seven slices of the items, one of them written twice, merged; sketches are held against exact counts and ranks."""
    columns = [*MEASURES, "l_suppkey"]
    rows = gaps(spark, d)
    path = f"{shared_dir(spark)}/framegate/states-{uuid.uuid4().hex}"
    for k in (1, 2, 3, 4, 5, 6, 7, 3):
        profile_state.save_slice(rows.filter(F.col("l_linenumber") == k), path, f"line-{k}", columns)
    states = profile_state.read_slices(spark, path)
    ends = profile_state.merge_states(states).select("feature", "low", "high")
    found = profile_state.profile_of(states).join(ends, "feature")
    points = {r["feature"]: r for r in found.collect()}
    exact = profiling.missing_and_unique(rows, columns).select("feature", F.col("unique_ratio").alias("exact_ratio"))
    share = lambda c, p, low: F.avg((F.col(c) < p if low else F.col(c) <= p).cast("double"))
    # The share of values below and up to a point holds its rank, give or take the error.
    holds = lambda c: F.lit(True) if points[c]["p50"] is None else reduce(
        lambda a, b: a & b,
        [(share(c, points[c][n], True) <= q + 0.01) & (share(c, points[c][n], False) >= q - 0.01) for n, q in (("p01", 0.01), ("p50", 0.5), ("p99", 0.99))],
    )
    ranks = summarise(rows, columns, {"ranks_within": holds})
    return rounded(
        found.join(exact, "feature").join(ranks, "feature").select(
            "feature", "rows", F.round("missing_ratio", 9).alias("missing_ratio"), F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
            "low", "high", (F.abs(F.col("unique_ratio") / F.col("exact_ratio") - 1) <= 0.04).alias("distinct_within"), "ranks_within",
        ),
        9,
    )


@query("profile_as_baseline", f"WITH {GAPS} {_numeric_sql('gaps', MEASURES)}")
def profile_as_baseline(spark, d):
    """A profile written as a JSON report and read again, as the next run's baseline is."""
    path = f"{shared_dir(spark)}/framegate/profile-{uuid.uuid4().hex}"
    found = profiling.profile(gaps(spark, d).select(*MEASURES))
    write_report(found, path, "json")
    return rounded(spark.read.schema(found.schema).json(path).select("feature", "mean", "std", "p01", "p50", "p99"), 4)


_MISSES_SQL = " UNION ALL ".join(f"SELECT '{c} misses values' AS line, COUNT(*) - COUNT({c}) AS n FROM gaps" for c in MEASURES)


@query("gate_raises_once", f"WITH {GAPS}, m AS ({_MISSES_SQL}) SELECT line FROM m WHERE n > 0")
def gate_raises_once(spark, d):
    """All failed checks are collected and raised as one error; its lines."""
    missing = F.col("missing_ratio") > 0
    checks = profiling.missing_and_unique(gaps(spark, d), MEASURES).select(
        F.when(missing, "fail").otherwise("pass").alias("status"), F.concat("feature", F.lit(" misses values")).alias("message")
    )
    lines = []
    try:
        enforce(checks)
    except GateError as e:
        lines = str(e).split("\n- ")[1:]
    return spark.createDataFrame([(x,) for x in lines], "line string")


@query("category_psi", f"WITH {_HALVES}, {_PSI_SQL} SELECT feature, ROUND(statistic, 9) AS statistic, statistic >= 0.1 AS drifted FROM psi")
def category_psi(spark, d):
    early, late = _event_halves(spark, d)
    return rounded(drift.category_psi(early, late, ["event_type"]).select("feature", "statistic", "drifted"), 9)


@query(
    "dataset_drift",
    f"""WITH {_KS_SQL}, {_PSI_SQL},
-- 1.358098… is the upper 5 % point of the Kolmogorov distribution
t AS (SELECT statistic * SQRT((SELECT COUNT(*) FROM early) * (SELECT COUNT(*) FROM late) / (SELECT COUNT(*) FROM events)) > 1.3580986393225505 AS d FROM ks
  UNION ALL SELECT statistic >= 0.1 FROM psi)
SELECT COUNT(*) FILTER (d) >= COUNT(*) * 0.5 AS dataset_drift, COUNT(*) FILTER (d) AS drifted_features, COUNT(*) AS total_features FROM t""",
)
def dataset_drift(spark, d):
    early, late = _event_halves(spark, d)
    return drift.dataset_drift(early, late)[1]


# -- outliers -------------------------------------------------------------------------------

_A = AnomalyConfig(q_low=0.05, q_high=0.95, exclude=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
_LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"
_BOUNDS = "q AS (SELECT " + ", ".join(
    f"QUANTILE_CONT({c}, 0.05) AS {c}_lo, QUANTILE_CONT({c}, 0.95) AS {c}_hi" for c in MEASURES
) + " FROM gaps)"
_FLAGS = "f AS (SELECT *, " + ", ".join(
    f"COALESCE({c} < {c}_lo OR {c} > {c}_hi, FALSE) AS f_{c}" for c in MEASURES
) + " FROM gaps, q)"
_COUNT = " + ".join(f"CAST(f_{c} AS INTEGER)" for c in MEASURES)
_NAMES = "CONCAT_WS(',', " + ", ".join(f"CASE WHEN f_{c} THEN '{c}' END" for c in MEASURES) + ")"


@query(
    "outlier_rows",
    f"""WITH {GAPS}, {_BOUNDS}, {_FLAGS} SELECT {_LINE_KEY}, {', '.join(MEASURES)}, {_COUNT} AS outlier_count,
({_COUNT}) > 0 AS outlier_any, {_NAMES} AS outlier_cols FROM f""",
)
def outlier_rows(spark, d):
    rows = gaps(spark, d).drop("l_returnflag", "l_linestatus")
    return anomaly.flag_outliers(rows, anomaly.quantile_bounds(rows, _A))


@query(
    "outlier_rates",
    f"WITH {GAPS}, {_BOUNDS}, {_FLAGS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(ANY_VALUE({c}_lo), 6) AS low, ROUND(ANY_VALUE({c}_hi), 6) AS high, ROUND(AVG(CAST(f_{c} AS DOUBLE)), 9) AS outlier_rate FROM f"
        for c in MEASURES
    ),
)
def outlier_rates(spark, d):
    rows = gaps(spark, d)
    rates = anomaly.outlier_rates(rows, anomaly.quantile_bounds(rows, _A))
    return rates.withColumns({"low": F.round("low", 6), "high": F.round("high", 6), "outlier_rate": F.round("outlier_rate", 9)})


@query(
    "outlier_report",
    f"""WITH {GAPS}, {_BOUNDS}, {_FLAGS}, r AS (SELECT AVG(CAST(({_COUNT}) > 0 AS DOUBLE)) AS x FROM f)
SELECT ROUND(x, 9) AS outlier_rate, CASE WHEN x >= 0.10 THEN 'fail' WHEN x >= 0.02 THEN 'warn' ELSE 'pass' END AS status,
  CASE WHEN x < 0.02 THEN 1 ELSE CAST(x >= 0.02 AS INTEGER) + CAST(x >= 0.10 AS INTEGER) END AS messages FROM r""",
)
def outlier_report(spark, d):
    rows = gaps(spark, d)
    out = anomaly.outlier_report(rows, anomaly.quantile_bounds(rows, _A), _A)
    return rounded(out.select("outlier_rate", "status", F.size("details").alias("messages")), 9)


@query(
    "outlier_matrix",
    f"""WITH {GAPS}, {_BOUNDS}, {_FLAGS} SELECT {_LINE_KEY}, {', '.join(f'CAST(f_{c} AS INTEGER) AS {c}_flag' for c in MEASURES)} FROM f""",
)
def outlier_matrix(spark, d):
    rows = gaps(spark, d)
    return anomaly.outlier_matrix(rows, anomaly.quantile_bounds(rows, _A), _LINE_KEY.split(", "), rows=None)


@query(
    "outliers_disabled",
    f"WITH {FLAGGED} SELECT *, 0 AS outlier_count, FALSE AS outlier_any, '' AS outlier_cols FROM flagged",
)
def outliers_disabled(spark, d):
    rows = flagged(spark, d)
    return anomaly.flag_outliers(rows, anomaly.quantile_bounds(rows, AnomalyConfig(enabled=False)))
