"""Feature engineering, quality, leakage, correlation and exploratory tables on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from framegate.bindings.registry import FLAGGED, GAPS, MEASURES, flagged, gaps, joined, query, rounded, table
from framegate.config import (
    CorrelationConfig,
    FeatureConfig,
    FeatureQAConfig,
    LeakageConfig,
    LinearFeature,
    RateFeature,
)
from framegate.operators import contracts, correlation, eda, features, importance, information, profiling, quality

_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"

_FEATURES = FeatureConfig(
    features=(
        RateFeature("unit_price", "l_extendedprice", "l_quantity"),
        RateFeature("tax_per_discount", "l_tax", "l_discount"),
        RateFeature("discount_share", "l_discount", "l_tax", clip=(0.0, 1.0)),
        LinearFeature("load", {"l_quantity": 1.0, "l_tax": 0.44, "l_discount": 1.0}),
        RateFeature("unused", "l_tax", "l_quantity"),
    ),
    enabled=("unit_price", "tax_per_discount", "discount_share", "load"),
)
_RATIOS = """r AS (SELECT *, l_extendedprice / (l_quantity + 1e-9::DOUBLE) AS unit_price, l_tax / (l_discount + 1e-9::DOUBLE) AS tax_per_discount,
  GREATEST(0.0::DOUBLE, LEAST(1.0::DOUBLE, l_discount / (l_tax + 1e-9::DOUBLE))) AS discount_share,
  l_quantity + l_tax * 0.44::DOUBLE + l_discount AS load FROM lineitem)"""


def _with_features(spark, d):
    return features.add_features(table(spark, d, "lineitem"), _FEATURES)


@query(
    "rate_features",
    f"""WITH {_RATIOS} SELECT {_KEY}, ROUND(unit_price, 4) AS unit_price, ROUND(tax_per_discount, 1) AS tax_per_discount,
ROUND(discount_share, 4) AS discount_share, ROUND(load, 4) AS load FROM r""",
)
def rate_features(spark, d):
    out = _with_features(spark, d)
    names = ["unit_price", "discount_share", "load"]
    return out.select(
        *_KEY.split(", "), *[F.round(n, 4).alias(n) for n in names], F.round("tax_per_discount", 1).alias("tax_per_discount")
    )


_RANGES = {"unit_price": (900.0, 2000.0), "tax_per_discount": (0.0, 20.0), "discount_share": (0.0, 1.0), "load": (2.0, 50.0)}


@query(
    "feature_contract",
    f"WITH {_RATIOS} "
    + " UNION ALL ".join(
        f"SELECT '{f}: infinite' AS rule, COUNT(*) FILTER (ISINF({f})) AS violations FROM r "
        f"UNION ALL SELECT '{f}: missing value', COUNT(*) FILTER ({f} IS NULL) FROM r "
        f"UNION ALL SELECT '{f}: outside [{lo:g}, {hi:g}]', COUNT(*) FILTER ({f} < {lo} OR {f} > {hi}) FROM r"
        for f, (lo, hi) in _RANGES.items()
    )
    + " UNION ALL SELECT 'absent: missing feature', 1::BIGINT UNION ALL SELECT 'l_returnflag: not numeric', 1::BIGINT",
)
def feature_contract(spark, d):
    ranges = {**_RANGES, "absent": (0.0, 1.0), "l_returnflag": (0.0, 1.0)}
    return contracts.feature_contract(_with_features(spark, d), ranges).select("rule", "violations")


_QA_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "odd", "same"]
_QA_INPUT = f"""{GAPS}, b AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax,
  CASE WHEN l_quantity = 1 THEN CAST('Infinity' AS DOUBLE) WHEN l_quantity = 2 THEN NULL ELSE l_extendedprice END AS odd, 1 AS same FROM gaps)"""


def _qa_input(spark, d):
    odd = (
        F.when(F.col("l_quantity") == 1, F.lit(float("inf")))
        .when(F.col("l_quantity") == 2, F.lit(float("nan")))
        .otherwise(F.col("l_extendedprice"))
    )
    return gaps(spark, d).select(*MEASURES, odd.alias("odd"), F.lit(1).alias("same"))


@query(
    "feature_measures",
    f"WITH {_QA_INPUT} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(1 - COUNT({c}) / COUNT(*), 9) AS missing_ratio, ROUND(COUNT(DISTINCT {c}) / COUNT(*), 9) AS unique_ratio, "
        f"COUNT(*) FILTER (ISINF(CAST({c} AS DOUBLE))) AS infinite, COUNT(*) - COUNT({c}) AS missing FROM b"
        for c in _QA_COLUMNS
    ),
)
def feature_measures(spark, d):
    return rounded(quality.feature_measures(_qa_input(spark, d)), 9)


def _qa_sql(fail: float, near: float) -> str:
    measures = " UNION ALL ".join(
        f"SELECT '{c}' AS f, 1 - COUNT({c}) / COUNT(*) AS m, COUNT(DISTINCT {c}) / COUNT(*) AS u, "
        f"COUNT(*) FILTER (ISINF(CAST({c} AS DOUBLE))) AS i, COUNT(*) - COUNT({c}) AS n FROM b"
        for c in _QA_COLUMNS
    )
    names = lambda p: f"COALESCE(STRING_AGG(f, ',' ORDER BY f) FILTER ({p}), '')"
    return f"""WITH {_QA_INPUT}, x AS ({measures}), a AS (SELECT MAX(m) AS m, {names(f'u <= {fail}')} AS c,
  {names(f'u > {fail} AND u <= {near}')} AS nc, {names('i > 0')} AS inf, {names('n > 0')} AS nan FROM x)
SELECT CASE WHEN m >= 0.30 OR c <> '' OR inf <> '' THEN 'fail' WHEN m >= 0.05 OR nc <> '' THEN 'warn' ELSE 'pass' END AS status,
  ROUND(m, 9) AS max_missing_ratio, c AS constant_features, CASE WHEN m >= 0.30 OR c <> '' THEN '' ELSE nc END AS near_constant_features,
  inf AS inf_features, nan AS nan_features FROM a"""


@query("feature_qa", _qa_sql(0.001, 0.01))
def feature_qa(spark, d):
    out = quality.feature_qa(_qa_input(spark, d), (), FeatureQAConfig())
    return rounded(joined(out, "constant_features", "near_constant_features", "inf_features", "nan_features").drop("details"), 9)


@query("feature_qa_near_constant", _qa_sql(0.0, 0.001))
def feature_qa_near_constant(spark, d):
    out = quality.feature_qa(_qa_input(spark, d), (), FeatureQAConfig(unique_ratio_fail=0.0, unique_ratio_warn=0.001))
    return rounded(joined(out, "constant_features", "near_constant_features", "inf_features", "nan_features").drop("details"), 9)


_DUP_COLUMNS = ["l_quantity", "l_tax", "l_tax_copy", "l_quantity_copy", "l_quantity_again", "l_discount"]


def _dup_input(spark, d):
    return gaps(spark, d).select(
        "l_quantity",
        "l_tax",
        F.col("l_tax").alias("l_tax_copy"),
        F.col("l_quantity").alias("l_quantity_copy"),
        F.col("l_quantity").alias("l_quantity_again"),
        "l_discount",
    )


_DUP_PAIRS = [(a, b) for i, a in enumerate(_DUP_COLUMNS) for b in _DUP_COLUMNS[i + 1 :]]


@query(
    "duplicate_columns",
    f"""WITH {GAPS}, b AS (SELECT l_quantity, l_tax, l_tax AS l_tax_copy, l_quantity AS l_quantity_copy, l_quantity AS l_quantity_again, l_discount FROM gaps),
s AS ({" UNION ALL ".join(f"SELECT {i} AS i, '{a}' AS col_a, '{b}' AS col_b, BOOL_AND({a} IS NOT DISTINCT FROM {b}) AS same FROM b" for i, (a, b) in enumerate(_DUP_PAIRS))})
SELECT ARG_MIN(col_a, i) AS col_a, col_b FROM s WHERE same GROUP BY col_b""",
)
def duplicate_columns(spark, d):
    return quality.duplicate_columns(_dup_input(spark, d))


_LEAKY = f"{FLAGGED}, b AS (SELECT *, y * 2 + l_tax AS leak, y * 2 + l_quantity / 25 AS hint, 3 AS same FROM flagged)"
_LEAKY_COLUMNS = [*MEASURES, "leak", "hint"]


def _leaky(spark, d):
    return flagged(spark, d).withColumns(
        {"leak": F.col("y") * 2 + F.col("l_tax"), "hint": F.col("y") * 2 + F.col("l_quantity") / 25, "same": F.lit(3)}
    )


@query(
    "label_correlations",
    f"WITH {_LEAKY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(CORR({c}, y), 6) AS corr, ROUND(ABS(CORR({c}, y)), 6) AS abs_corr FROM b" for c in _LEAKY_COLUMNS
    ),
)
def label_correlations(spark, d):
    return rounded(quality.label_correlations(_leaky(spark, d), "y"))


@query(
    "leakage_broken_columns",
    """SELECT 'required_columns' AS "check", 'fail' AS status, 'Missing required columns: [''absent'']' AS message
UNION ALL SELECT 'target', 'fail', 'Target column not found: absent'""",
)
def leakage_broken_columns(spark, d):
    """A missing required column or label ends the checks at once."""
    rows = table(spark, d, "lineitem")
    required = quality.leakage_checks(rows, LeakageConfig(target="l_tax", required=("l_discount", "absent")))
    return required.unionByName(quality.leakage_checks(rows, LeakageConfig(target="absent")))


@query(
    "leakage_checks",
    f"""WITH {_LEAKY}, c AS ({" UNION ALL ".join(f"SELECT ABS(CORR({c}, y)) AS r FROM b" for c in _LEAKY_COLUMNS)})
SELECT 'duplicate_columns' AS "check", 'warn' AS status FROM (SELECT BOOL_AND(l_tax IS NOT DISTINCT FROM l_tax_copy) AS s FROM (SELECT l_tax, l_tax AS l_tax_copy FROM b)) WHERE s
UNION ALL SELECT 'target_proxy', CASE WHEN MAX(r) >= 0.95 THEN 'fail' ELSE 'warn' END FROM c WHERE r >= 0.7 HAVING COUNT(*) > 0""",
)
def leakage_checks(spark, d):
    rows = _leaky(spark, d).withColumn("l_tax_copy", F.col("l_tax"))
    return quality.leakage_checks(rows, LeakageConfig(target="y", corr_warn=0.7)).select("check", "status")


@query("leakage_guard", f"WITH {FLAGGED} SELECT l_extendedprice, l_discount, l_tax, y FROM flagged")
def leakage_guard(spark, d):
    cfg = LeakageConfig(target="y", id_cols=("l_quantity",), forbidden=("y",), required=("l_tax", "y"))
    return quality.guard_leakage(flagged(spark, d), cfg)


# -- correlation ----------------------------------------------------------------------------

_PAIRS = [(a, b) for i, a in enumerate(MEASURES) for b in MEASURES[i + 1 :]]


def _pearson_sql(source: str, pairs=_PAIRS) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, CORR({a}, {b}) AS corr FROM {source}" for a, b in pairs)


@query("corr_pairs", f"WITH {GAPS}, c AS ({_pearson_sql('gaps')}) SELECT feature_a, feature_b, ROUND(corr, 6) AS corr FROM c")
def corr_pairs(spark, d):
    return rounded(correlation.pearson_pairs(gaps(spark, d), MEASURES))


@query(
    "corr_matrix",
    f"WITH {GAPS} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature, " + ", ".join(f"ROUND(CORR({a}, {b}), 6) AS {b}" if a != b else f"1.0::DOUBLE AS {b}" for b in MEASURES) + " FROM gaps"
        for a in MEASURES
    ),
)
def corr_matrix(spark, d):
    return rounded(correlation.correlation_matrix(correlation.pearson_pairs(gaps(spark, d), MEASURES), MEASURES))


def _rank_sql(source: str, a: str, b: str) -> str:
    rank = lambda c: f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE"
    return (
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, ROUND(CORR(ra, rb), 6) AS corr FROM "
        f"(SELECT {rank(a)} AS ra, {rank(b)} AS rb FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    )


@query("corr_spearman", f"WITH {GAPS} " + " UNION ALL ".join(_rank_sql("gaps", a, b) for a, b in _PAIRS))
def corr_spearman(spark, d):
    return rounded(correlation.spearman_pairs(gaps(spark, d), MEASURES))


_CYCLES = {f"c{i:02d}": f"CAST((o_orderkey * {7 * i + 3} + o_custkey * {i}) % {11 + 13 * i} AS DOUBLE)" for i in range(40)}


@query(
    "corr_spearman_wide",
    f"""WITH w AS (SELECT o_orderkey AS id, {", ".join(f"{e} AS {c}" for c, e in _CYCLES.items())} FROM orders),
l AS (SELECT id, f, RANK() OVER (PARTITION BY f ORDER BY v) + (COUNT(*) OVER (PARTITION BY f, v) - 1) / 2 AS r FROM (UNPIVOT w ON {", ".join(_CYCLES)} INTO NAME f VALUE v))
SELECT a.f AS feature_a, b.f AS feature_b, ROUND(CORR(a.r, b.r), 6) AS corr FROM l a JOIN l b ON a.id = b.id AND a.f < b.f GROUP BY ALL""",
)
def corr_spearman_wide(spark, d):
    """40 columns, so ranks return to rows in one exchange and all pairs are summed as matrices."""
    wide = table(spark, d, "orders").select(*[F.expr(e).alias(c) for c, e in _CYCLES.items()])
    return rounded(correlation.spearman_pairs(wide, list(_CYCLES)))


_REDUNDANT = f"{GAPS}, b AS (SELECT l_quantity, l_extendedprice, l_tax, l_quantity * 2 + l_tax AS twice, l_extendedprice + l_quantity * 50 AS mixed FROM gaps)"
_REDUNDANT_COLUMNS = ["l_quantity", "l_extendedprice", "l_tax", "twice", "mixed"]


def _redundant(spark, d):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return gaps(spark, d).select("l_quantity", "l_extendedprice", "l_tax", (q * 2 + F.col("l_tax")).alias("twice"), (p + q * 50).alias("mixed"))


_REDUNDANT_PAIRS = [(a, b) for i, a in enumerate(_REDUNDANT_COLUMNS) for b in _REDUNDANT_COLUMNS[i + 1 :]]


@query(
    "corr_high_pairs",
    f"""WITH {_REDUNDANT}, c AS ({_pearson_sql('b', _REDUNDANT_PAIRS)})
SELECT feature_a, feature_b, ROUND(corr, 6) AS corr, ROUND(ABS(corr), 6) AS abs_corr FROM c WHERE ABS(corr) >= 0.8""",
)
def corr_high_pairs(spark, d):
    rows = _redundant(spark, d)
    return rounded(correlation.high_correlations(correlation.pearson_pairs(rows, _REDUNDANT_COLUMNS), 0.8))


@query(
    "corr_gate",
    f"""WITH {_REDUNDANT}, c AS ({_pearson_sql('b', _REDUNDANT_PAIRS)})
SELECT CASE WHEN COUNT(*) > 0 THEN 'warn' ELSE 'pass' END AS status, 5 AS n_features_used, COUNT(*) AS n_high_corr_pairs FROM c WHERE ABS(corr) >= 0.95""",
)
def corr_gate(spark, d):
    return correlation.correlation_gate(_redundant(spark, d), CorrelationConfig())


@query(
    "corr_pruned",
    # With these scores `twice` beats l_quantity, and l_extendedprice beats `mixed`.
    f"""WITH {_REDUNDANT}, c AS ({_pearson_sql('b', _REDUNDANT_PAIRS)}), high AS (SELECT * FROM c WHERE ABS(corr) >= 0.9)
SELECT f AS feature FROM (VALUES ('l_quantity', 1), ('l_extendedprice', 9), ('l_tax', 2), ('twice', 5), ('mixed', 4)) s(f, v)
WHERE NOT EXISTS (SELECT 1 FROM high JOIN (VALUES ('l_quantity', 1), ('l_extendedprice', 9), ('l_tax', 2), ('twice', 5), ('mixed', 4)) o(g, w)
  ON (feature_a = f AND feature_b = g) OR (feature_b = f AND feature_a = g) WHERE w > v)""",
)
def corr_pruned(spark, d):
    scores = {"l_quantity": 1, "l_extendedprice": 9, "l_tax": 2, "twice": 5, "mixed": 4}
    kept = correlation.prune_correlated_features(_redundant(spark, d), _REDUNDANT_COLUMNS, scores, 0.9)
    return spark.createDataFrame([(k,) for k in kept], "feature string")


# -- exploratory tables ---------------------------------------------------------------------


def _skew_sql(source: str, columns: list[str]) -> str:
    moments = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, MIN(x) < MAX(x) AS varies, AVG(POW(x - m, 3)) / POW(AVG(POW(x - m, 2)), 1.5) AS s, "
        f"COUNT(*) FILTER (x = 0) / (SELECT COUNT(*) FROM {source}) AS z "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS x, AVG({c}) OVER () AS m FROM {source}) WHERE x IS NOT NULL"
        for c in columns
    )
    return f"""m AS ({moments}), v AS (SELECT feature, CASE WHEN varies THEN s END AS s, CASE WHEN varies THEN z END AS z FROM m),
k AS (SELECT *, CASE WHEN s IS NULL THEN 'constant_or_empty' WHEN z >= 0.3 AND ABS(s) >= 1 THEN 'zero_inflated_high_skew'
  WHEN s >= 1 AND z > 0 THEN 'high_pos_zero_skew' WHEN s <= -1 THEN 'high_neg_skew' WHEN ABS(s) >= 0.5 THEN 'moderate_skew' ELSE 'low_skew' END AS category FROM v)
SELECT feature, ROUND(s, 5) AS skewness, ROUND(z, 9) AS zero_ratio, category, CASE category WHEN 'constant_or_empty' THEN 'drop_or_ignore'
  WHEN 'zero_inflated_high_skew' THEN 'log1p' WHEN 'high_pos_zero_skew' THEN 'log1p' WHEN 'low_skew' THEN 'none' ELSE 'yeo_johnson' END AS suggestion FROM k"""


_SKEWED = """b AS (SELECT value, CASE WHEN event_type IN ('error', 'view') THEN 0.0::DOUBLE ELSE value END AS gated,
  CASE WHEN user_id = 1 THEN 0.0::DOUBLE ELSE value END AS dotted, -value AS negative, SQRT(value) AS root, CAST(user_id AS DOUBLE) AS user_id,
  7.0::DOUBLE AS same FROM events)"""
_SKEWED_COLUMNS = ["value", "gated", "dotted", "negative", "root", "user_id", "same"]


def _skewed(spark, d):
    v, kind = F.col("value"), F.col("event_type")
    return table(spark, d, "events").select(
        "value",
        F.when(kind.isin("error", "view"), 0.0).otherwise(v).alias("gated"),
        F.when(F.col("user_id") == 1, 0.0).otherwise(v).alias("dotted"),
        (-v).alias("negative"),
        F.sqrt(v).alias("root"),
        F.col("user_id").cast("double").alias("user_id"),
        F.lit(7.0).alias("same"),
    )


@query("skew_report", f"WITH {_SKEWED}, {_skew_sql('b', _SKEWED_COLUMNS)}")
def skew_report(spark, d):
    out = eda.skew_report(_skewed(spark, d))
    return out.withColumns({"skewness": F.round("skewness", 5), "zero_ratio": F.round("zero_ratio", 9)})


def _anova_sql(source: str, columns: list[str], y: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, ROUND((SUM(n * POW(m - g, 2)) / (COUNT(*) - 1)) / (SUM(n * v) / (SUM(n) - COUNT(*))), 4) AS f_score
FROM (SELECT COUNT({c}) AS n, AVG({c}) AS m, VAR_POP({c}) AS v FROM {source} GROUP BY {y}), (SELECT AVG({c}) AS g FROM {source})"""
        for c in columns
    )


@query("anova_scores", f"WITH {_LEAKY} {_anova_sql('b', _LEAKY_COLUMNS, 'y')}")
def anova_scores(spark, d):
    scores = eda.anova_scores(_leaky(spark, d).drop("same"), "y")
    return rounded(scores.select("feature", "f_score"), 4)


@query("top_features", f"WITH {_LEAKY}, s AS ({_anova_sql('b', _LEAKY_COLUMNS, 'y')}) SELECT * FROM s ORDER BY f_score DESC LIMIT 2")
def top_features(spark, d):
    scores = eda.anova_scores(_leaky(spark, d).drop("same"), "y")
    return rounded(eda.top_features(scores, 2).select("feature", "f_score"), 4)


def _mi_sql(c: str) -> str:
    cuts = f"(SELECT LIST_DISTINCT(QUANTILE_CONT({c}, [{', '.join(f'{k / 10}' for k in range(1, 10))}])) AS q FROM b)"
    return f"""SELECT '{c}' AS feature, ROUND(GREATEST(SUM(n / t * LN(n * t / (nb * ny))), 0), 6) AS score FROM (
  SELECT n, SUM(n) OVER () AS t, SUM(n) OVER (PARTITION BY bin) AS nb, SUM(n) OVER (PARTITION BY y) AS ny FROM (
    SELECT LEN(LIST_FILTER(q, lambda e: e <= {c})) AS bin, y, CAST(COUNT(*) AS DOUBLE) AS n FROM b, {cuts} WHERE {c} IS NOT NULL GROUP BY ALL))"""


@query("binned_mi", f"WITH {_LEAKY} {' UNION ALL '.join(_mi_sql(c) for c in ['l_quantity', 'l_tax', 'leak', 'hint'])}")
def binned_mi(spark, d):
    return rounded(eda.binned_mutual_information(_leaky(spark, d), "y", ["l_quantity", "l_tax", "leak", "hint"]))


@query(
    "missing_table",
    f"WITH {GAPS} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, ROUND((1 - COUNT({c}) / COUNT(*)) * 100, 6) AS missing_pct FROM gaps" for c in MEASURES),
)
def missing_table(spark, d):
    return rounded(profiling.missing_table(gaps(spark, d), MEASURES))


@query(
    "missing_matrix",
    f"WITH {GAPS} SELECT {_KEY}, CAST(l_discount IS NULL AS INTEGER) AS l_discount_missing, CAST(l_tax IS NULL AS INTEGER) AS l_tax_missing FROM gaps",
)
def missing_matrix(spark, d):
    return eda.missing_matrix(gaps(spark, d), MEASURES, _KEY.split(", "), rows=None)


_KEY_TEXT = ", ".join(f"CAST({k} AS VARCHAR)" for k in _KEY.split(", "))


@query(
    "missing_sample",
    f"""WITH {GAPS} SELECT {_KEY}, CAST(l_discount IS NULL AS INTEGER) AS l_discount_missing, CAST(l_tax IS NULL AS INTEGER) AS l_tax_missing
FROM gaps ORDER BY SUBSTR(MD5(CONCAT_WS('|', {_KEY_TEXT}, '42')), 1, 13), {_KEY} LIMIT 300""",
)
def missing_sample(spark, d):
    return eda.missing_matrix(gaps(spark, d), MEASURES, _KEY.split(", "), portable=True)


_MANY = [f"m{i}" for i in range(25)]
_MANY_SQL = "many AS (SELECT " + ", ".join(f"l_quantity * {i + 1} + l_tax * {25 - i} AS m{i}" for i in range(25)) + ", CAST(l_returnflag = 'R' AS INTEGER) AS y FROM lineitem)"


def _many(spark, d):
    """25 numeric columns made of two."""
    made = [(F.col("l_quantity") * (i + 1) + F.col("l_tax") * (25 - i)).alias(f"m{i}") for i in range(25)]
    return table(spark, d, "lineitem").select(*made, (F.col("l_returnflag") == "R").cast("int").alias("y"))


def _hist_sql(source: str, c: str, k: int, y: str | None) -> str:
    group = f"{y}, bin" if y else "bin"
    label = f"{y} AS label, " if y else ""
    density = f", ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY {y}), 9) AS density" if y else ""
    return f"""SELECT '{c}' AS feature, {label}bin, ROUND(ANY_VALUE(lo + (hi - lo) / {k} * bin), 6) AS low,
  ROUND(ANY_VALUE(lo + (hi - lo) / {k} * (bin + 1)), 6) AS high, COUNT(*) AS n{density}
FROM (SELECT *, CAST(LEAST(FLOOR(({c} - lo) / (hi - lo) * {k}), {k} - 1) AS INTEGER) AS bin FROM {source}, (SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM {source}) WHERE {c} IS NOT NULL) GROUP BY {group}"""


@query("histograms", f"WITH {GAPS} {' UNION ALL '.join(_hist_sql('gaps', c, 20, None) for c in MEASURES)}")
def histograms(spark, d):
    return rounded(eda.histograms(gaps(spark, d), MEASURES))


@query(
    "histograms_many_columns",
    f"WITH {_MANY_SQL}, h AS ({' UNION ALL '.join(_hist_sql('many', c, 20, None) for c in _MANY)}) SELECT feature, COUNT(*) AS bins, CAST(SUM(n) AS BIGINT) AS n FROM h GROUP BY feature",
)
def histograms_many_columns(spark, d):
    """No column is left out, however many there are."""
    found = eda.histograms(_many(spark, d).drop("y"))
    return found.groupBy("feature").agg(F.count(F.lit(1)).alias("bins"), F.sum("n").alias("n"))


@query(
    "class_histograms_many_columns",
    f"WITH {_MANY_SQL}, h AS ({' UNION ALL '.join(_hist_sql('many', c, 20, 'y') for c in _MANY)}) SELECT feature, label, COUNT(*) AS bins, CAST(SUM(n) AS BIGINT) AS n FROM h GROUP BY feature, label",
)
def class_histograms_many_columns(spark, d):
    found = eda.class_histograms(_many(spark, d), "y")
    return found.groupBy("feature", "label").agg(F.count(F.lit(1)).alias("bins"), F.sum("n").alias("n"))


@query("class_histograms", f"WITH {FLAGGED} {' UNION ALL '.join(_hist_sql('flagged', c, 20, 'y') for c in MEASURES)}")
def class_histograms(spark, d):
    out = eda.class_histograms(flagged(spark, d), "y", MEASURES)
    return out.withColumns({"low": F.round("low", 6), "high": F.round("high", 6), "density": F.round("density", 9)})


@query("forest_importance", "SELECT 'hint,leak' AS first_two, CAST(7 AS BIGINT) AS features, 1.0::DOUBLE AS total")
def forest_importance(spark, d):
    """The columns that give the label away come first, and shares add up to 1."""
    rows = _leaky(spark, d)
    found = importance.importance_table(rows, importance.forest_importance(rows, "y"))
    best = F.sort_array(F.collect_list(F.struct("importance", "feature")), asc=False)  # seven rows
    return found.agg(
        F.array_join(F.array_sort(F.transform(F.slice(best, 1, 2), lambda x: x["feature"])), ",").alias("first_two"),
        F.count(F.lit(1)).alias("features"),
        F.round(F.sum("importance"), 9).alias("total"),
    )


@query(
    "pca_variance",
    """WITH s AS (SELECT VAR_SAMP(l_quantity) AS a, VAR_SAMP(l_extendedprice / 1000) AS b, COVAR_SAMP(l_quantity, l_extendedprice / 1000) AS c FROM lineitem),
e AS (SELECT (a + b) / 2 + SQRT(POW((a - b) / 2, 2) + c * c) AS first, a + b AS total FROM s)
SELECT 1 AS component, ROUND(first / total, 6) AS explained_variance_ratio, ROUND(first / total, 6) AS cumulative FROM e
UNION ALL SELECT 2, ROUND(1 - first / total, 6), 1.0::DOUBLE FROM e""",
)
def pca_variance(spark, d):
    rows = table(spark, d, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 1000).alias("price"))
    return rounded(importance.explained_variance(rows))


@query(
    "selected_features",
    f"WITH {_LEAKY} SELECT 'selected' AS step, 'hint,l_quantity,leak' AS columns, COUNT(*) AS rows, CAST(SUM(y) AS BIGINT) AS positives, ROUND(SUM(leak), 4) AS leak FROM b",
)
def selected_features(spark, d):
    """The two columns that tell the label survive scores, forest and pruning; one is kept by order."""
    from framegate.config import SelectionConfig

    candidates = [*MEASURES, "leak", "hint"]
    cfg = SelectionConfig(mi_top_k=5, mi_min_score=0.01, forest_top_k=2, corr_threshold=0.99, always_keep=("l_quantity",))
    reduced, report = importance.select_features(_leaky(spark, d).drop("same"), "y", candidates, cfg)
    return reduced.agg(
        F.lit("selected").alias("step"),
        F.lit(",".join(report["selected"])).alias("columns"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("y").alias("positives"),
        F.round(F.sum("leak"), 4).alias("leak"),
    )


_NEIGHBOURS = "(SELECT '{c}' AS feature, event_type AS y, CAST({c} AS DOUBLE) AS value, CAST('0x' || SUBSTR(MD5(event_id || '|{c}|42'), 1, 13) AS BIGINT) / 4503599627370496::DOUBLE AS u FROM events)"


@query(
    "neighbour_information",
    f"""WITH e AS ({" UNION ALL ".join(_NEIGHBOURS.format(c=c) for c in ("value", "user_id"))}),
s AS (SELECT feature, STDDEV_POP(value) AS s, AVG(ABS(value)) AS size FROM e GROUP BY feature),
v AS (SELECT feature, y, ROW_NUMBER() OVER () AS id, value / s + 1e-10::DOUBLE * GREATEST(1, size / s) * (2 * u - 1) AS v FROM e JOIN s USING (feature)),
c AS (SELECT feature, y, COUNT(*) AS n FROM v GROUP BY feature, y),
d AS (SELECT a.feature, a.y, a.id, a.v, MIN(ABS(b.v - a.v), 3)[3] AS r FROM v a JOIN v b ON a.feature = b.feature AND a.y = b.y AND a.id <> b.id GROUP BY ALL),
m AS (SELECT d.feature, d.y, d.id, COUNT(*) AS m FROM d JOIN v ON v.feature = d.feature AND ABS(v.v - d.v) < d.r GROUP BY ALL),
h AS (SELECT i, SUM(1::DOUBLE / i) OVER (ORDER BY i) - 1::DOUBLE / i - 0.5772156649015329 AS psi FROM (SELECT UNNEST(RANGE(1, 100000)) AS i)),
n AS (SELECT feature, COUNT(*) AS n FROM v GROUP BY feature)
SELECT m.feature, ROUND(GREATEST(0, MIN(hn.psi) + MIN(h3.psi) - AVG(hc.psi) - AVG(hm.psi)), 6) AS score
FROM m JOIN c ON c.feature = m.feature AND c.y = m.y JOIN n ON n.feature = m.feature JOIN h hm ON hm.i = m.m JOIN h hc ON hc.i = c.n JOIN h hn ON hn.i = n.n JOIN h h3 ON h3.i = 3
GROUP BY m.feature""",
)
def neighbour_information(spark, d):
    """Nearest neighbours of the same kind of event, against all values that are closer."""
    found = information.neighbour_mutual_information(table(spark, d, "events"), "event_type", ["value", "user_id"], ["event_id"], portable=True)
    return rounded(found)
