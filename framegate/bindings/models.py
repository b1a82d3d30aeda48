"""Model preparation, selection and evaluation on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from framegate.bindings.registry import FLAGGED, GAPS, MEASURES, SCORED, flagged, gaps, query, rounded, scored, table
from framegate.config import Candidate, ForestSelectionConfig, GateConfig, SmoteConfig
from framegate.operators import eda, evaluation, importance, preparation, resampling, trees, tuning

# -- splits and folds -----------------------------------------------------------------------

_HASH = "CAST('0x' || SUBSTR(MD5(CONCAT_WS('|', CAST({key} AS VARCHAR), '42')), 1, 13) AS BIGINT)"
_LABELLED_ORDERS = f"""o AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS y, {_HASH.format(key='o_orderkey')} AS h FROM orders),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY y ORDER BY h) - 1 AS rn, COUNT(*) OVER (PARTITION BY y) AS n FROM o)"""


def _labelled_orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"))


@query("stratified_split", f"WITH {_LABELLED_ORDERS} SELECT o_orderkey, y, rn < FLOOR(n * 0.2::DOUBLE + 0.5) AS is_test FROM r")
def stratified_split(spark, d):
    return preparation.stratified_split(_labelled_orders(spark, d), "y", ["o_orderkey"], portable=True)


@query(
    "stratified_folds",
    f"WITH {_LABELLED_ORDERS} SELECT o_orderkey, y, "
    + " + ".join(f"CAST(rn >= {i} * n // 5 AS INTEGER)" for i in range(1, 5))
    + " AS fold FROM r",
)
def stratified_folds(spark, d):
    return preparation.stratified_folds(_labelled_orders(spark, d), "y", ["o_orderkey"], portable=True)


_BY_CUSTOMER = _LABELLED_ORDERS.replace("CAST(o_orderstatus = 'F' AS INTEGER) AS y", "NULLIF(o_custkey, 1) AS y")


@query("folds_of_many_classes", f"WITH {_BY_CUSTOMER} SELECT o_orderkey, y, CASE WHEN y IS NOT NULL THEN CAST(rn >= n // 3 AS INTEGER) + CAST(rn >= 2 * n // 3 AS INTEGER) END AS fold FROM r")
def folds_of_many_classes(spark, d):
    """A class for every customer but the first, whose orders have none."""
    orders = table(spark, d, "orders").select("o_orderkey", F.nullif("o_custkey", F.lit(1)).alias("y"))
    return preparation.stratified_folds(orders, "y", ["o_orderkey"], 3, portable=True)


@query(
    "fold_counts",
    """SELECT y, fold, (n // 5) + CAST(n % 5 > 0 AND (fold + 1) * n // 5 - fold * n // 5 > n // 5 AS INTEGER) AS rows FROM
(SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, COUNT(*) AS n FROM lineitem GROUP BY y), (SELECT CAST(range AS INTEGER) AS fold FROM RANGE(5))""",
)
def fold_counts(spark, d):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    rows = table(spark, d, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    folded = preparation.stratified_folds(rows, "y", key)
    return folded.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("rows"))


@query("plain_folds", f"SELECT o_orderkey, CAST({_HASH.format(key='o_orderkey')} % 3 AS INTEGER) AS fold FROM orders")
def plain_folds(spark, d):
    return preparation.plain_folds(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], k=3, portable=True)


# -- transforms -----------------------------------------------------------------------------


@query("log_and_root", "SELECT event_id, ROUND(LN(1 + value), 9) AS logged, ROUND(SQRT(value), 9) AS root FROM events")
def log_and_root(spark, d):
    v = F.col("value")
    out = table(spark, d, "events").select(
        "event_id", preparation.log1p(v).alias("logged"), preparation.square_root(v).alias("root")
    )
    return rounded(out, 9)


_CENTRED = "c AS (SELECT event_id, value - 40 AS x FROM events)"


def _yj_sql(lam: float) -> str:
    box = lambda v, p: f"LN(1 + {v})" if p == 0 else f"(POW({v} + 1, {p}) - 1) / {p}"
    return f"CASE WHEN x >= 0 THEN {box('x', lam)} ELSE -({box('(-x)', 2 - lam)}) END"


_LAMBDAS = {"l0": 0.0, "l05": 0.5, "l2": 2.0, "lm1": -1.0}


@query(
    "yeo_johnson_fixed",
    f"WITH {_CENTRED} SELECT event_id, " + ", ".join(f"ROUND({_yj_sql(p)}, 6) AS {n}" for n, p in _LAMBDAS.items()) + " FROM c",
)
def yeo_johnson_fixed(spark, d):
    rows = table(spark, d, "events").select("event_id", (F.col("value") - 40).alias("x"))
    return rounded(rows.select("event_id", *[preparation.yeo_johnson(F.col("x"), p).alias(n) for n, p in _LAMBDAS.items()]))


def _yj_fit_sql(c: str) -> str:
    """Likelihood on a grid of 0.05, then on one of 0.0005 around its best point (values of gaps are not negative)."""
    score = lambda grid: f"""(SELECT lam, -COUNT(*) / 2 * LN(VAR_POP(CASE WHEN ABS(lam) < 1e-12 THEN LN(1 + x) ELSE (POW(1 + x, lam) - 1) / lam END))
    + (lam - 1) * SUM(LN(1 + x)) AS score FROM (SELECT CAST({c} AS DOUBLE) AS x FROM gaps WHERE {c} IS NOT NULL), {grid} GROUP BY lam)"""
    first = score("(SELECT range * 0.05::DOUBLE - 5 AS lam FROM RANGE(201))")
    second = score(f"(SELECT best + range * 0.0005::DOUBLE - 0.05 AS lam FROM (SELECT ARG_MAX(lam, score) AS best FROM {first}), RANGE(201))")
    return f"SELECT '{c}' AS feature, ROUND(ARG_MAX(lam, score), 2) AS lambda FROM {second}"


@query("yeo_johnson_fit", f"WITH {GAPS} {' UNION ALL '.join(_yj_fit_sql(c) for c in ['l_quantity', 'l_discount'])}")
def yeo_johnson_fit(spark, d):
    fitted = preparation.fit_yeo_johnson(gaps(spark, d), ["l_quantity", "l_discount"], precision=1e-4)
    return spark.createDataFrame([(c, round(x, 2)) for c, x in fitted.items()], "feature string, lambda double")


@query(
    "skew_before_after",
    """WITH m AS (SELECT AVG(value) AS a, AVG(SQRT(value)) AS b FROM events)
SELECT 'value' AS feature, ROUND(AVG(POW(value - a, 3)) / POW(AVG(POW(value - a, 2)), 1.5), 5) AS skew_before,
  ROUND(AVG(POW(SQRT(value) - b, 3)) / POW(AVG(POW(SQRT(value) - b, 2)), 1.5), 5) AS skew_after FROM events, m""",
)
def skew_before_after(spark, d):
    events = table(spark, d, "events")
    before = eda.skew_report(events, ["value"])
    after = eda.skew_report(events.withColumn("value", F.sqrt("value")), ["value"])
    return rounded(preparation.skew_comparison(before, after), 5)


@query(
    "transform_plan",
    """WITH s AS (SELECT 'value' AS feature, AVG(POW(value - a, 3)) / POW(AVG(POW(value - a, 2)), 1.5) AS v, COUNT(*) FILTER (value = 0) / COUNT(*) AS z
  FROM events, (SELECT AVG(value) AS a FROM events)
  UNION ALL SELECT 'user_id', AVG(POW(user_id - a, 3)) / POW(AVG(POW(user_id - a, 2)), 1.5), COUNT(*) FILTER (user_id = 0) / COUNT(*)
  FROM events, (SELECT AVG(user_id) AS a FROM events))
SELECT feature, CASE WHEN (v >= 1 AND z > 0) OR (ABS(v) >= 1 AND z >= 0.3) THEN 'log1p' WHEN ABS(v) >= 0.5 THEN 'yeo_johnson' ELSE 'none' END AS transform FROM s
UNION ALL SELECT 'unseen', 'none'""",
)
def transform_plan(spark, d):
    skew = eda.skew_report(table(spark, d, "events"), ["value", "user_id"])
    plan = preparation.transform_plan(skew, ["value", "user_id", "unseen"])
    return spark.createDataFrame(list(plan.items()), "feature string, transform string")


def _scale_sql(shift: str, spread: str) -> str:
    out = ", ".join(
        f"ROUND(({c} - {shift}({c}) OVER ()) / CASE WHEN {spread.format(c=c)} > 0 THEN {spread.format(c=c)} ELSE 1 END, 6) AS scaled_{c}"
        for c in MEASURES
    )
    return f"WITH {FLAGGED} SELECT {', '.join(MEASURES)}, {out}, CAST(0 AS DOUBLE) AS scaled_same FROM flagged"


@query("scale_standard", _scale_sql("AVG", "STDDEV_POP({c}) OVER ()"))
def scale_standard(spark, d):
    rows = flagged(spark, d).drop("y").withColumn("same", F.lit(5.0))
    return rounded(preparation.scale(rows, [*MEASURES, "same"]).drop("same"))


@query("scale_minmax", _scale_sql("MIN", "(MAX({c}) OVER () - MIN({c}) OVER ())"))
def scale_minmax(spark, d):
    rows = flagged(spark, d).drop("y").withColumn("same", F.lit(5.0))
    return rounded(preparation.scale(rows, [*MEASURES, "same"], "minmax").drop("same"))


@query(
    "transform_and_scale",
    """WITH t AS (SELECT event_id, LN(1 + value) AS a, CAST(user_id AS DOUBLE) AS b FROM events)
SELECT event_id, ROUND((a - AVG(a) OVER ()) / STDDEV_POP(a) OVER (), 6) AS t_value, ROUND((b - AVG(b) OVER ()) / STDDEV_POP(b) OVER (), 6) AS t_user_id FROM t""",
)
def transform_and_scale(spark, d):
    events = table(spark, d, "events")
    fitted = preparation.fit_transforms(events, ["value", "user_id"], {"user_id": "none", "value": "log1p"})
    return rounded(fitted.apply(events).select("event_id", *fitted.columns()))


# -- evaluation -----------------------------------------------------------------------------

_SWEEP = f"""{SCORED}, t AS (SELECT range * 0.01::DOUBLE AS threshold FROM RANGE(101)),
c AS (SELECT threshold, COUNT(*) FILTER (p >= threshold AND y = 1) AS tp, COUNT(*) FILTER (p >= threshold AND y = 0) AS fp,
  COUNT(*) FILTER (p < threshold AND y = 1) AS fn, COUNT(*) FILTER (p < threshold AND y = 0) AS tn FROM t, scored GROUP BY threshold),
m AS (SELECT *, CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, CASE WHEN tp = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN tp = 0 THEN 0 ELSE tp / (tp + fp) END AS "precision", (tp / (tp + fn) + tn / (tn + fp)) / 2 AS balanced_accuracy FROM c)"""


@query(
    "threshold_sweep",
    f"""WITH {_SWEEP} SELECT ROUND(threshold, 9) AS threshold, tp, fp, fn, tn, ROUND(f1, 9) AS f1, ROUND(recall, 9) AS recall, ROUND("precision", 9) AS "precision",
ROUND(balanced_accuracy, 9) AS balanced_accuracy, ROUND(0.4 * f1 + 0.4 * recall + 0.2 * "precision", 9) AS balanced FROM m""",
)
def threshold_sweep(spark, d):
    return rounded(evaluation.threshold_sweep(scored(spark, d), "y", "p"), 9)


@query(
    "best_threshold",
    f"WITH {_SWEEP} SELECT ROUND(threshold, 9) AS threshold, ROUND(balanced_accuracy, 9) AS score FROM m ORDER BY balanced_accuracy DESC, threshold LIMIT 1",
)
def best_threshold(spark, d):
    sweep = evaluation.threshold_sweep(scored(spark, d), "y", "p")
    return rounded(evaluation.best_threshold(sweep, "balanced_accuracy"), 9)


def _ranking_sql(source: str, y: str, p: str, n: str = "") -> str:
    return f"""g{n} AS (SELECT {p} AS s, SUM({y}) AS pos, SUM(1 - {y}) AS neg FROM {source} GROUP BY {p}),
w{n} AS (SELECT *, SUM(neg) OVER (ORDER BY s) - neg AS below, SUM(pos) OVER (ORDER BY s DESC) AS tp, SUM(neg) OVER (ORDER BY s DESC) AS fp,
  SUM(pos) OVER () AS np, SUM(neg) OVER () AS nn FROM g{n}),
rank_measures{n} AS (SELECT SUM(pos * (below + neg / 2)) / ANY_VALUE(np * nn) AS roc_auc, SUM(pos / np * (tp / (tp + fp))) AS average_precision FROM w{n})"""


@query(
    "ranking_measures",
    f"WITH {SCORED}, {_ranking_sql('scored', 'y', 'p')} SELECT ROUND(roc_auc, 9) AS roc_auc, ROUND(average_precision, 9) AS average_precision FROM rank_measures",
)
def ranking_measures(spark, d):
    return rounded(evaluation.ranking_measures(scored(spark, d), "y", "p"), 9)


@query(
    "roc_auc_many_ties",
    f"WITH {FLAGGED}, {_ranking_sql('flagged', 'y', 'l_discount')} SELECT ROUND(roc_auc, 9) AS roc_auc FROM rank_measures",
)
def roc_auc_many_ties(spark, d):
    return rounded(evaluation.roc_auc(flagged(spark, d), "y", "l_discount"), 9)


@query(
    "average_precision_lineitem",
    f"WITH {FLAGGED}, {_ranking_sql('flagged', 'y', 'l_extendedprice')} SELECT ROUND(average_precision, 9) AS average_precision FROM rank_measures",
)
def average_precision_lineitem(spark, d):
    return rounded(evaluation.average_precision(flagged(spark, d), "y", "l_extendedprice"), 9)


@query(
    "classification_report",
    """WITH r AS (SELECT quality AS y, 1 - toxic AS p FROM labels),
c AS (SELECT CAST(k AS VARCHAR) AS label, COUNT(*) FILTER (y = k AND p = k) AS tp, COUNT(*) FILTER (p = k) AS pred, COUNT(*) FILTER (y = k) AS support
  FROM r, (VALUES (0), (1)) v(k) GROUP BY k),
m AS (SELECT label, CASE WHEN pred = 0 THEN 0 ELSE tp / pred END AS "precision", CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
  CASE WHEN support + pred = 0 THEN 0 ELSE 2 * tp / (support + pred) END AS f1, support, tp FROM c),
a AS (SELECT label, "precision", recall, f1, support FROM m
  UNION ALL SELECT 'accuracy', SUM(tp) / SUM(support), SUM(tp) / SUM(support), SUM(tp) / SUM(support), SUM(support) FROM m
  UNION ALL SELECT 'macro avg', AVG("precision"), AVG(recall), AVG(f1), SUM(support) FROM m
  UNION ALL SELECT 'weighted avg', SUM("precision" * support) / SUM(support), SUM(recall * support) / SUM(support), SUM(f1 * support) / SUM(support), SUM(support) FROM m)
SELECT label, ROUND("precision", 9) AS "precision", ROUND(recall, 9) AS recall, ROUND(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM a""",
)
def classification_report(spark, d):
    rows = table(spark, d, "labels").select("quality", (1 - F.col("toxic")).alias("guess"))
    return rounded(evaluation.classification_report(rows, "quality", "guess"), 9)


_CONFUSION = """COUNT(*) FILTER (y = 1 AND yhat = 1) AS tp, COUNT(*) FILTER (y = 0 AND yhat = 1) AS fp,
COUNT(*) FILTER (y = 1 AND yhat = 0) AS fn, COUNT(*) FILTER (y = 0 AND yhat = 0) AS tn"""


@query(
    "classification_report_mixed_types",
    """WITH r AS (SELECT quality AS y, CASE WHEN toxic = 1 THEN 0 ELSE 1 END AS p FROM labels),
c AS (SELECT t.kind, CAST(k AS VARCHAR) AS label, COUNT(*) FILTER (y = k AND p = k) AS tp, COUNT(*) FILTER (p = k) AS pred, COUNT(*) FILTER (y = k) AS support
  FROM r, (VALUES (0), (1)) v(k), (VALUES ('int_double'), ('double_boolean'), ('boolean_decimal')) t(kind) GROUP BY t.kind, k)
SELECT kind, label, ROUND(CASE WHEN support + pred = 0 THEN 0 ELSE 2 * tp / (support + pred) END, 9) AS f1, support FROM c""",
)
def classification_report_mixed_types(spark, d):
    """Labels and predictions of different types are the same classes."""
    rows = table(spark, d, "labels").select("quality", (1 - F.col("toxic")).alias("guess"))
    kinds = {"int_double": ("int", "double"), "double_boolean": ("double", "boolean"), "boolean_decimal": ("boolean", "decimal(3,1)")}
    parts = None
    for kind, (y, p) in kinds.items():
        typed = rows.select(F.col("quality").cast(y).alias("quality"), F.col("guess").cast(p).alias("guess"))
        own = evaluation.classification_report(typed, "quality", "guess").filter("label in ('0', '1')").select(F.lit(kind).alias("kind"), "label", "f1", "support")
        parts = own if parts is None else parts.unionByName(own)
    return rounded(parts, 9)


@query(
    "fold_confusion",
    f"""WITH {SCORED}, c AS (SELECT fold, {_CONFUSION} FROM scored GROUP BY fold)
SELECT CAST(SUM(tp) AS BIGINT) AS tp, CAST(SUM(fp) AS BIGINT) AS fp, CAST(SUM(fn) AS BIGINT) AS fn, CAST(SUM(tn) AS BIGINT) AS tn,
  ROUND(AVG(tp / (tp + fp)), 9) AS precision_1, ROUND(AVG(tp / (tp + fn)), 9) AS recall_1, ROUND(AVG(2 * tp / (2 * tp + fp + fn)), 9) AS f1_1,
  ROUND(AVG(tn / (tn + fn)), 9) AS precision_0, ROUND(AVG(tn / (tn + fp)), 9) AS recall_0, ROUND(AVG(2 * tn / (2 * tn + fp + fn)), 9) AS f1_0 FROM c""",
)
def fold_confusion(spark, d):
    return rounded(evaluation.fold_confusion(scored(spark, d), "fold", "y", "yhat"), 9)


@query(
    "label_metrics",
    f"""WITH {SCORED}, c AS (SELECT {_CONFUSION} FROM scored), m AS (SELECT 'f1' AS metric, 2 * tp / (2 * tp + fp + fn) AS value FROM c
UNION ALL SELECT 'recall', tp / (tp + fn) FROM c UNION ALL SELECT 'precision', tp / (tp + fp) FROM c
UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn) FROM c UNION ALL SELECT 'balanced_accuracy', (tp / (tp + fn) + tn / (tn + fp)) / 2 FROM c)
SELECT metric, ROUND(value, 9) AS value FROM m""",
)
def label_metrics(spark, d):
    return rounded(evaluation.label_metrics(scored(spark, d), "y", "yhat"), 9)


_VARIANT = """SELECT '{v}' AS variant, {t}::DOUBLE AS threshold, COUNT(*) FILTER (y = 1 AND p {op} {t}::DOUBLE) AS tp, COUNT(*) FILTER (y = 0 AND p {op} {t}::DOUBLE) AS fp,
COUNT(*) FILTER (y = 1 AND NOT p {op} {t}::DOUBLE) AS fn, COUNT(*) FILTER (y = 0 AND NOT p {op} {t}::DOUBLE) AS tn FROM scored"""


@query(
    "holdout_evaluation",
    f"""WITH {SCORED}, {_ranking_sql('scored', 'y', 'p')}, c AS ({_VARIANT.format(v='default', t='0.5', op='>')} UNION ALL {_VARIANT.format(v='tuned', t='0.33', op='>=')})
SELECT variant, threshold, ROUND(2 * tp / (2 * tp + fp + fn), 9) AS f1, ROUND(tp / (tp + fn), 9) AS recall, ROUND(tp / (tp + fp), 9) AS "precision",
  ROUND((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, ROUND((tp / (tp + fn) + tn / (tn + fp)) / 2, 9) AS balanced_accuracy,
  ROUND(roc_auc, 9) AS roc_auc, ROUND(average_precision, 9) AS average_precision FROM c, rank_measures""",
)
def holdout_evaluation(spark, d):
    return rounded(evaluation.evaluate_at_thresholds(scored(spark, d), "y", "p", 0.33), 9)


@query(
    "promotion_gates",
    f"""WITH {SCORED}, c AS (SELECT {_CONFUSION} FROM scored), m AS (SELECT 2 * tp / (2 * tp + fp + fn) AS f1, tp / (tp + fn) AS recall FROM c)
SELECT 'min_f1' AS "check", f1 >= 0.3 AS ok, ROUND(f1, 9) AS value, 0.3::DOUBLE AS threshold FROM m
UNION ALL SELECT 'min_recall', recall >= 0.65, ROUND(recall, 9), 0.65::DOUBLE FROM m
UNION ALL SELECT 'max_drop_vs_previous', 0.6 - f1 <= 0.05, ROUND(0.6::DOUBLE - f1, 9), 0.05::DOUBLE FROM m""",
)
def promotion_gates(spark, d):
    m = evaluation.binary_measures(evaluation.confusion_counts(scored(spark, d), "y", "yhat")).withColumn("previous_f1", F.lit(0.6))
    return rounded(evaluation.promotion_gates(m, GateConfig(min_f1=0.3, max_drop_vs_previous=0.05)), 9)


@query(
    "metric_decay",
    f"""WITH {SCORED}, c AS (SELECT {_CONFUSION} FROM scored), m AS (SELECT 'f1' AS metric, 2 * tp / (2 * tp + fp + fn) AS v FROM c
UNION ALL SELECT 'recall', tp / (tp + fn) FROM c UNION ALL SELECT 'precision', tp / (tp + fp) FROM c UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn) FROM c)
SELECT metric, reference, ROUND(v, 9) AS current, ROUND(reference - v, 9) AS "drop", reference - v > 0.05 AS alert
FROM m JOIN (VALUES ('f1', 0.85::DOUBLE), ('precision', 0.41::DOUBLE), ('recall', 0.2::DOUBLE), ('accuracy', 0.84::DOUBLE)) r(metric, reference) USING (metric)""",
)
def metric_decay(spark, d):
    reference = {"f1": 0.85, "precision": 0.41, "recall": 0.2, "accuracy": 0.84}
    return rounded(evaluation.metric_decay(evaluation.label_metrics(scored(spark, d), "y", "yhat"), reference), 9)


@query(
    "best_candidate",
    f"WITH {FLAGGED}, "
    + ", ".join(
        _ranking_sql("flagged", "y", c, str(i))
        for i, c in enumerate(MEASURES)
    )
    + ", s AS ("
    + " UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS name, roc_auc AS score FROM rank_measures{i}" for i, c in enumerate(MEASURES))
    + ") SELECT position, name, ROUND(score, 9) AS score FROM s ORDER BY s.score DESC, position LIMIT 1",
)
def best_candidate(spark, d):
    rows = flagged(spark, d)
    parts = [
        evaluation.roc_auc(rows, "y", c).select(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col("roc_auc").alias("score"))
        for i, c in enumerate(MEASURES)
    ]
    scores = parts[0]
    for p in parts[1:]:
        scores = scores.unionByName(p)
    return rounded(evaluation.best_candidate(scores), 9)


# -- rebalancing and training ---------------------------------------------------------------


def _quality(spark, d):
    """Labelled documents: text length and shape against the quality label."""
    docs = table(spark, d, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("words"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"),
        F.regexp_count("text", F.lit("[0-9]")).cast("double").alias("digits"),
    )
    return docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")


_QUALITY_FEATURES = ("chars", "words", "lines", "digits")


def _setup(**changes) -> tuning.TrainingSetup:
    plan = {"chars": "log1p", "words": "yeo_johnson", "lines": "none", "digits": "none"}
    return tuning.TrainingSetup("quality", _QUALITY_FEATURES, ("doc_id",), plan, smote=SmoteConfig(k_neighbors=5), **changes)


_QUALITY = """q AS (SELECT doc_id, quality AS y, CAST(n_chars AS DOUBLE) AS chars FROM documents JOIN labels USING (doc_id))"""


def _folds_sql(k: int) -> str:
    reached = " + ".join(f"CAST(rn >= {i} * n // {k} AS INTEGER)" for i in range(1, k))
    return f"""{_QUALITY}, hq AS (SELECT *, {_HASH.format(key='doc_id')} AS h FROM q),
rq AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY y ORDER BY h) - 1 AS rn, COUNT(*) OVER (PARTITION BY y) AS n FROM hq),
folded AS (SELECT doc_id, y, {reached} AS fold FROM rq)"""


def _folded(spark, d, k: int = 5):
    return preparation.stratified_folds(_quality(spark, d), "quality", ["doc_id"], k, portable=True)


@query(
    "smote_balance",
    """WITH q AS (SELECT quality, CAST(n_chars AS DOUBLE) AS chars FROM labels JOIN documents USING (doc_id)),
c AS (SELECT quality, COUNT(*) AS n FROM q GROUP BY quality)
SELECT quality, FALSE AS synthetic, n AS rows, TRUE AS inside FROM c
UNION ALL SELECT quality, TRUE, (SELECT MAX(n) FROM c) - n, TRUE FROM c WHERE n < (SELECT MAX(n) FROM c)""",
)
def smote_balance(spark, d):
    """Rows per class; synthetic values lie within the minority's range in every feature (and so are computed)."""
    source = _quality(spark, d)
    rows = resampling.smote(source, "quality", _QUALITY_FEATURES, ["doc_id"])
    ends = [f(c).alias(f"{n}_{c}") for c in _QUALITY_FEATURES for n, f in (("low", F.min), ("high", F.max))]
    limits = source.groupBy("quality").agg(*ends)  # one row per class
    within = [F.col(c).between(F.col(f"low_{c}") - 1e-9, F.col(f"high_{c}") + 1e-9) for c in _QUALITY_FEATURES]
    both = rows.join(F.broadcast(limits), "quality").withColumn("inside", within[0] & within[1] & within[2] & within[3])
    return both.groupBy("quality", "synthetic").agg(F.count(F.lit(1)).alias("rows"), F.bool_and("inside").alias("inside"))


@query(
    "smote_hot_keys",
    """WITH q AS (SELECT quality, COUNT(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY quality)
SELECT TRUE AS same, CAST(MAX(n) - MIN(n) AS BIGINT) AS made FROM q""",
)
def smote_hot_keys(spark, d):
    """With one key for all rows both ways of finding neighbours give the same synthetic rows."""
    rows = _quality(spark, d).withColumn("key", F.lit(1))
    made = [resampling.synthetic_rows(rows, "quality", _QUALITY_FEATURES, ["key"], broadcast_points=n) for n in (1_000_000, 1)]
    digest = F.sum(F.xxhash64(*[F.round(c, 6) for c in _QUALITY_FEATURES]).cast("decimal(38,0)"))
    one, other = (m.agg(F.count(F.lit(1)).alias("made"), digest.alias("h")).first() for m in made)
    return spark.createDataFrame([(one == other, one["made"])], "same boolean, made bigint")


@query(
    "balancing_weights",
    """SELECT quality, ROUND(SUM(w), 6) AS total FROM (SELECT quality, COUNT(*) OVER () / (2 * COUNT(*) OVER (PARTITION BY quality)) AS w FROM labels) GROUP BY quality""",
)
def balancing_weights(spark, d):
    weighted = resampling.balancing_weights(table(spark, d, "labels"), "quality")
    return weighted.groupBy("quality").agg(F.round(F.sum("weight"), 6).alias("total"))


# -- trees of this library's own --------------------------------------------------------------

_SHAPES = """q AS (SELECT doc_id, quality AS y, CAST(n_chars AS DOUBLE) AS f0, CAST(LEN(REGEXP_EXTRACT_ALL(text, '[0-9]')) AS DOUBLE) AS f1,
  CAST(LEN(text) - LEN(REPLACE(text, CHR(10), '')) + 1 AS DOUBLE) AS f2 FROM documents JOIN labels USING (doc_id))"""
_SHAPE_CUTS = [[200.0, 500.0, 1000.0, 2000.0, 4000.0], [1.0, 5.0, 20.0], [2.0, 4.0, 8.0, 16.0]]
_BAGS = 12


def _cuts_sql(cuts) -> str:
    return "(VALUES " + ", ".join(f"({f}, {k}, {c}::DOUBLE)" for f, own in enumerate(cuts) for k, c in enumerate(own)) + ") c(f, k, cut)"


def _bags_sql(bags: int) -> str:
    """Every draw is a hash of its number, taken modulo the rows of its class."""
    return f"""num AS (SELECT doc_id, y, ROW_NUMBER() OVER (PARTITION BY y ORDER BY doc_id) - 1 AS place, COUNT(*) OVER (PARTITION BY y) AS size FROM q),
many AS (SELECT MIN(size) AS m FROM num), cls AS (SELECT y, MIN(size) AS size, ROW_NUMBER() OVER (ORDER BY y) - 1 AS k FROM num GROUP BY y),
ids AS (SELECT UNNEST(RANGE({bags} * (SELECT COUNT(*) * (SELECT m FROM many) FROM cls))) AS id),
draws AS (SELECT CAST(id // ((SELECT COUNT(*) FROM cls) * m) AS INTEGER) AS tree, (id // m) % (SELECT COUNT(*) FROM cls) AS k, {_HASH.format(key="id")} AS h FROM ids, many),
bag AS (SELECT tree, num.doc_id, num.y, COUNT(*) AS n FROM draws JOIN cls USING (k) JOIN num ON num.y = cls.y AND num.place = h % cls.size GROUP BY ALL)"""


def _shapes(spark, d):
    """Labelled documents and three numbers about their texts."""
    docs = table(spark, d, "documents").select(
        "doc_id",
        F.array(
            F.col("n_chars").cast("double"),
            F.regexp_count("text", F.lit("[0-9]")).cast("double"),
            (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("double"),
        ).alias("x"),
    )
    return docs.join(table(spark, d, "labels").select("doc_id", F.col("quality").alias("y")), "doc_id")


@query(
    "balanced_bags",
    f"WITH {_SHAPES}, {_bags_sql(_BAGS)} SELECT tree, doc_id, y, n, CAST(SUM(n) OVER (PARTITION BY tree, y) AS BIGINT) AS drawn FROM bag",
)
def balanced_bags(spark, d):
    """How often each document is in each bag; `drawn` is the same for both classes of all bags."""
    bags = trees.balanced_bags(_shapes(spark, d), "y", ["doc_id"], _BAGS, portable=True)
    return bags.select("tree", "doc_id", "y", "n", F.sum("n").over(Window.partitionBy("tree", "y")).alias("drawn"))


@query(
    "balanced_forest_votes",
    f"""WITH {_SHAPES}, {_bags_sql(_BAGS)},
v AS (SELECT doc_id, 0 AS f, f0 AS v FROM q UNION ALL SELECT doc_id, 1, f1 FROM q UNION ALL SELECT doc_id, 2, f2 FROM q),
s AS (SELECT tree, f, k, cut, COALESCE(SUM(n) FILTER (v < cut AND y = 1), 0) AS la, COALESCE(SUM(n) FILTER (v < cut AND y = 0), 0) AS lb, SUM(n * y) AS ta, SUM(n * (1 - y)) AS tb
  FROM bag JOIN v USING (doc_id) JOIN {_cuts_sql(_SHAPE_CUTS)} USING (f) GROUP BY tree, f, k, cut),
g AS (SELECT *, (la * la + lb * lb)::DOUBLE / NULLIF(la + lb, 0) + ((ta - la) * (ta - la) + (tb - lb) * (tb - lb))::DOUBLE / NULLIF(ta + tb - la - lb, 0)
  - (ta * ta + tb * tb)::DOUBLE / (ta + tb) AS gain FROM s),
b AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY tree ORDER BY ROUND(gain, 9) DESC, f, k) AS r FROM g WHERE gain > 1e-9) WHERE r = 1),
t AS (SELECT tree, SUM(n * y)::DOUBLE / SUM(n) AS share FROM bag GROUP BY tree),
p AS (SELECT v.doc_id, tree, CASE WHEN v < cut THEN la::DOUBLE / (la + lb) ELSE (ta - la)::DOUBLE / (ta + tb - la - lb) END AS vote FROM b JOIN v USING (f)
  UNION ALL SELECT doc_id, tree, share FROM t ANTI JOIN b USING (tree), q)
SELECT doc_id, COUNT(*) AS votes, ROUND(AVG(vote), 6) AS score FROM p GROUP BY doc_id""",
)
def balanced_forest_votes(spark, d):
    """Trees of one split on balanced bags; a document's score is the mean of the shares in the leaves that it falls into."""
    rows = _shapes(spark, d)
    made = trees.fit_forest(rows, "y", F.col("x"), ["doc_id"], _BAGS, _SHAPE_CUTS, trees.gini(1), portable=True)
    votes = trees.tree_values(trees.as_column(made), F.col("x"), 1)
    return rows.select("doc_id", F.size(votes).cast("long").alias("votes"), F.round(F.aggregate(votes, F.lit(0.0), lambda a, v: a + v) / F.size(votes), 6).alias("score"))


_LINE_CUTS = [[10.0, 20.0, 30.0, 40.0], [0.02, 0.05, 0.08], [0.02, 0.04, 0.06]]


def _boosting_sql(n_trees: int, depth: int) -> str:
    """Each level takes the best cut of every node by the sums of gradients and hessians on its sides."""
    parts = ["m0 AS (SELECT ROW_NUMBER() OVER () AS id, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity AS f0, l_discount AS f1, l_tax AS f2, 0.0::DOUBLE AS m FROM lineitem)"]
    leaves = []
    for t in range(n_trees):
        parts.append(f"n{t}_0 AS (SELECT *, '' AS node, 1 / (1 + EXP(-m)) - y AS g, (1 / (1 + EXP(-m))) * (1 - 1 / (1 + EXP(-m))) AS h FROM m{t})")
        for level in range(depth):
            at = f"n{t}_{level}"
            value = "CASE f WHEN 0 THEN f0 WHEN 1 THEN f1 ELSE f2 END"
            parts.append(
                f"""c{at} AS (SELECT node, f, k, cut, SUM(CASE WHEN {value} < cut THEN g ELSE 0 END) AS lg, SUM(CASE WHEN {value} < cut THEN h ELSE 0 END) AS lh, SUM(g) AS tg, SUM(h) AS th
  FROM {at}, {_cuts_sql(_LINE_CUTS)} WHERE LEN(node) = {level} GROUP BY ALL)"""
            )
            parts.append(
                f"""b{at} AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY node ORDER BY gain DESC, f, k) AS r
  FROM (SELECT *, lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1) - tg * tg / (th + 1) AS gain FROM c{at} WHERE lh >= 1 AND th - lh >= 1) WHERE gain > 1e-9) WHERE r = 1)"""
            )
            parts.append(
                f"n{t}_{level + 1} AS (SELECT a.* EXCLUDE (node), a.node || CASE WHEN b.f IS NULL THEN '' WHEN {value.replace('f0', 'a.f0').replace('f1', 'a.f1').replace('f2', 'a.f2').replace('CASE f', 'CASE b.f')} < b.cut THEN 'L' ELSE 'R' END AS node FROM {at} a LEFT JOIN b{at} b ON a.node = b.node)"
            )
        last = f"n{t}_{depth}"
        parts.append(f"l{t} AS (SELECT node, COUNT(*) AS rows, -0.3::DOUBLE * SUM(g) / (SUM(h) + 1) AS value FROM {last} GROUP BY node)")
        parts.append(f"m{t + 1} AS (SELECT id, y, f0, f1, f2, m + value AS m FROM {last} JOIN l{t} USING (node))")
        leaves.append(f"SELECT {t} AS tree, node AS leaf, rows, ROUND(value, 6) AS value FROM l{t}")
    return f"WITH {', '.join(parts)} {' UNION ALL '.join(leaves)}"


@query("boosted_leaves", _boosting_sql(3, 2))
def boosted_leaves(spark, d):
    """The leaves of three trees by gradients and hessians: which rows fall into each, and what it adds to their margin."""
    x = F.array("l_quantity", "l_discount", "l_tax")
    rows = table(spark, d, "lineitem").select(x.alias("x"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    made = trees.fit_boosting(rows, "y", F.col("x"), _LINE_CUTS, trees.BoostingConfig(trees=3, depth=2))
    leaves = F.transform(trees.as_column(made), lambda t: trees.routed(t, F.col("x"), "cut", 2))
    named = [(k, node, path, t.value[node]) for k, t in enumerate(made) for node, path in t.paths().items()]
    names = spark.createDataFrame(named, "tree int, node int, leaf string, value double")
    counted = rows.select(F.posexplode(leaves).alias("tree", "node")).groupBy("tree", "node").agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(F.broadcast(names), ["tree", "node"]).select("tree", "leaf", "rows", F.round("value", 6).alias("value"))


_SMALL_FOREST = Candidate("forest", tuning.FOREST, {"n_estimators": 50, "max_depth": 5, "min_samples_leaf": 2})
_CHECKED = ["f1", "recall", "precision", "accuracy", "balanced_accuracy", "roc_auc", "average_precision"]


def _agrees(result, metrics) -> bool:
    """Do the reported scores follow from the out-of-fold rows?"""
    again = tuning.fold_scores(result.predictions, metrics)
    return all(abs(x - y) < 1e-12 for m in metrics for x, y in zip(again[m], result.folds[m]) if x is not None)


@query(
    "cross_validation",
    f"WITH {_folds_sql(5)} SELECT fold, CAST(y AS INTEGER) AS label, COUNT(*) AS rows, TRUE AS scores_follow, TRUE AS scores_in_range FROM folded GROUP BY fold, y",
)
def cross_validation(spark, d):
    """Every row is predicted once, by the model that has not seen its fold, and scores follow from these rows."""
    folds = tuning.prepare_folds(_folded(spark, d), _setup())
    result = tuning.cross_validate(folds, _setup(), _SMALL_FOREST, _CHECKED)
    inside = all(0.0 <= v <= 1.0 for vs in result.folds.values() for v in vs if v is not None)
    return result.predictions.groupBy("fold", "label").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(_agrees(result, _CHECKED)).alias("scores_follow"), F.lit(inside).alias("scores_in_range")
    )


@query(
    "model_selection",
    """SELECT * FROM (VALUES ('forest', 'baseline', 5, TRUE), ('forest', 'search', 5, TRUE), ('balanced', 'baseline', 5, TRUE), ('balanced', 'search', 5, TRUE),
('boosting', 'baseline', 5, TRUE), ('boosting', 'search', 5, TRUE)) t(name, variant, folds, best_is_first_highest)""",
)
def model_selection(spark, d):
    """Three kinds of model, plain and searched; the chosen one has the highest mean, the first of equal ones.

    Sizes are those of the reference's candidates; the search has the library's whole spaces and 25 trials a kind."""
    forest = {"n_estimators": 500, "max_depth": 8, "min_samples_leaf": 2}
    candidates = [
        Candidate("forest", tuning.FOREST, forest),
        Candidate("balanced", tuning.BALANCED_FOREST, forest),
        Candidate("boosting", tuning.BOOSTING, {"n_estimators": 400, "max_depth": 5, "learning_rate": 0.05}),
    ]
    chosen = tuning.select_model(_folded(spark, d), _setup(), candidates, ["recall"], "balanced_accuracy", trials=25)
    means = [r.means["balanced_accuracy"] for r in chosen.results]
    right = chosen.best is chosen.results[means.index(max(means))] and 0.0 <= chosen.threshold <= 1.0
    rows = [(r.candidate.name, r.variant, len(r.folds["recall"]), right) for r in chosen.results]
    return spark.createDataFrame(rows, "name string, variant string, folds int, best_is_first_highest boolean")


@query(
    "boosting_search",
    f"WITH {_folds_sql(5)} SELECT fold, CAST(y AS INTEGER) AS label, COUNT(*) AS rows, TRUE AS scores_follow, TRUE AS within_space FROM folded GROUP BY fold, y",
)
def boosting_search(spark, d):
    """The best trial's rows; its parameters lie in the space. All trials and the whole space of the library's search."""
    folds = tuning.prepare_folds(_folded(spark, d), _setup())
    found = tuning.random_search(folds, _setup(), Candidate("boost", tuning.BOOSTING), ["f1"], "f1")
    p, space = found.candidate.params, tuning.BOOSTING_SPACE
    low, high = space["learning_rate"]
    inside = p["n_estimators"] in space["n_estimators"] and p["max_depth"] in space["max_depth"] and low <= p["learning_rate"] <= high
    return found.predictions.groupBy("fold", "label").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(_agrees(found, ["f1"])).alias("scores_follow"), F.lit(inside).alias("within_space")
    )


@query(
    "nested_grid",
    f"WITH {_folds_sql(3)} SELECT fold, CAST(y AS INTEGER) AS label, COUNT(*) AS rows, TRUE AS decided FROM folded GROUP BY fold, y",
)
def nested_grid(spark, d):
    """Each outer fold is predicted by the winner of a grid search on the other folds."""
    grid = {"n_estimators": [10, 20], "max_depth": [2, 4]}
    predicted = tuning.nested_grid_search(_folded(spark, d, 3), _QUALITY_FEATURES, "quality", _SMALL_FOREST, grid)
    return predicted.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("prediction").isin(0, 1)).alias("decided"))


@query(
    "search_then_refit",
    f"WITH {_QUALITY} SELECT CAST(y AS INTEGER) AS quality, COUNT(*) AS rows, TRUE AS decided, 5 AS folds FROM q GROUP BY y",
)
def search_then_refit(spark, d):
    """Search, cross-validation of the best parameters, and a model refitted on all rows that scores raw columns."""
    space = {"n_estimators": (10, 20), "max_depth": (3, 5)}
    best, model = tuning.search_then_refit(_folded(spark, d), _setup(), Candidate("f", tuning.FOREST), ["f1"], "f1", trials=2, space=space)
    return model.transform(_quality(spark, d)).groupBy("quality").agg(
        F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("prediction").isin(0.0, 1.0)).alias("decided"), F.lit(len(best.folds["f1"])).alias("folds")
    )


@query(
    "forest_selection",
    "SELECT feature, TRUE AS by_rule, 1.0::DOUBLE AS total FROM (VALUES ('chars'), ('words'), ('lines'), ('digits')) t(feature)",
)
def forest_selection(spark, d):
    """Chosen on the training rows only: the two most important features and the one that always stays."""
    split = preparation.stratified_split(_quality(spark, d), "quality", ["doc_id"], portable=True)
    cfg = ForestSelectionConfig(top_k=2, trees=100, max_depth=5, always_keep=("lines",))
    chosen, found = importance.forest_selection(split.filter(~F.col("is_test")), "quality", _QUALITY_FEATURES, cfg)
    top = set(sorted(found, key=lambda f: -found[f])[:2]) | {"lines"}
    total = round(sum(found.values()), 9)
    return spark.createDataFrame([(f, (f in chosen) == (f in top), total) for f in _QUALITY_FEATURES], "feature string, by_rule boolean, total double")
