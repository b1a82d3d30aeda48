"""Sources, sinks, cleaning and validation on the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from framegate.bindings.registry import GAPS, INFERENCES, MEASURES, gaps, inferences, query, rounded, table
from framegate.config import ColumnContract, Roles, ValidationConfig
from framegate.operators import cleaning, contracts
from framegate.session import shared_dir
from framegate.sources import event_store, fingerprints, readers, writers


def _new_folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/framegate/{name}-{uuid.uuid4().hex}"


@query("csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(spark, d):
    source = table(spark, d, "customer")
    folder = _new_folder(spark, "customer.csv")
    writers.write_report(source, folder)
    return readers.read_csv_contract(spark, folder, source.columns, source.schema)


@query(
    "sorted_parquet_roundtrip",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def sorted_parquet_roundtrip(spark, d):
    folder = _new_folder(spark, "orders") + ".parquet"
    writers.write_table(table(spark, d, "orders"), folder, sort_by=["o_custkey", "o_orderkey", "absent"])
    return readers.read_table(spark, folder, strict=True)


@query(
    "event_log_roundtrip",
    f"""WITH {INFERENCES}
SELECT l.log, l.status, COUNT(*) AS n, ROUND(SUM(latency_ms), 4) AS latency, COUNT(DISTINCT request_id) AS requests
FROM inferences, (VALUES ('events'), ('failures')) l(log)
WHERE l.log = 'events' OR status = 'failed' GROUP BY ALL""".replace("l.status", "status"),
)
def event_log_roundtrip(spark, d):
    log, failures = _new_folder(spark, "events"), _new_folder(spark, "failures")
    rows = inferences(spark, d).withColumns(
        {"timestamp_utc": F.col("ts").cast("string"), "package_id": F.lit("p"), "threshold_used": F.lit(0.5)}
    )
    writers.append_events(rows.drop("event_id", "ts"), log, failures)
    read = lambda path, name: readers.read_events(spark, path).withColumn("log", F.lit(name))
    return (
        read(log, "events").unionByName(read(failures, "failures")).groupBy("log", "status")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum("latency_ms"), 4).alias("latency"),
            F.count_distinct("request_id").alias("requests"),
        )
    )


@query(
    "events_exactly_once",
    f"""WITH {INFERENCES}
SELECT l.log, status, COUNT(*) AS n, ROUND(SUM(latency_ms), 4) AS latency, COUNT(DISTINCT request_id) AS requests
FROM inferences, (VALUES ('events'), ('failures')) l(log)
WHERE l.log = 'events' OR status = 'failed' GROUP BY ALL""",
)
def events_exactly_once(spark, d):
    """Three batches of events: one published twice, and one whose first attempt was lost after its files were written."""
    root = _new_folder(spark, "store")
    for k in range(3):
        batch = inferences(spark, d).filter(F.col("event_id") % 3 == k).drop("event_id", "ts")
        if k == 1:
            event_store.write_attempt(batch, root, str(k), "lost")
        for _ in range(2 if k == 2 else 1):
            event_store.publish_events(batch, root, str(k))
    read = lambda name: event_store.read_published(spark, root, name).withColumn("log", F.lit(name))
    return (
        read("events").unionByName(read("failures")).groupBy("log", "status")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum("latency_ms"), 4).alias("latency"),
            F.count_distinct("request_id").alias("requests"),
        )
    )


_FINGERPRINT_COLUMNS = ["l_orderkey", "l_returnflag", *MEASURES]


@query(
    "table_fingerprint",
    f"WITH {GAPS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) AS rows, COUNT({c}) AS non_null FROM gaps" for c in _FINGERPRINT_COLUMNS
    ),
)
def table_fingerprint(spark, d):
    return writers.fingerprint(gaps(spark, d).select(*_FINGERPRINT_COLUMNS)).select("column", "rows", "non_null")


@query(
    "fingerprint_incremental",
    f"WITH {GAPS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CASE MIN(TYPEOF({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' END AS type, "
        f"COUNT(*) AS rows, COUNT({c}) AS non_null, TRUE AS as_whole FROM gaps"
        for c in _FINGERPRINT_COLUMNS
    ),
)
def fingerprint_incremental(spark, d):
    """A table that grows by files: what is known of the first ones is added to, and is compared with a scan of all."""
    path, state = _new_folder(spark, "grown"), _new_folder(spark, "known")
    rows = gaps(spark, d).select(*_FINGERPRINT_COLUMNS)
    for k in range(2):
        rows.filter(F.col("l_orderkey") % 2 == k).write.mode("append").parquet(path)
        known = fingerprints.table_fingerprint(spark, path, state)
    whole = writers.fingerprint(spark.read.parquet(path)).select("column", F.col("hash_sum").alias("whole"))
    # One row per column.
    return known.join(F.broadcast(whole), "column").select("column", "type", "rows", "non_null", (F.col("hash_sum") == F.col("whole")).alias("as_whole"))


@query("dedup_rows", "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)")
def dedup_rows(spark, d):
    li = table(spark, d, "lineitem")
    return cleaning.drop_duplicate_rows(li.unionByName(li))


@query(
    "duplicate_count",
    """SELECT CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows FROM (
SELECT COUNT(*) AS n FROM lineitem GROUP BY l_quantity, l_discount, l_tax, l_returnflag)""",
)
def duplicate_count(spark, d):
    return cleaning.duplicate_count(table(spark, d, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag"))


@query(
    "null_counts",
    f"WITH {GAPS} "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, COUNT(*) - COUNT({c}) AS missing FROM gaps" for c in MEASURES),
)
def null_counts(spark, d):
    return cleaning.null_counts(gaps(spark, d).select(*MEASURES))


_LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


@query(
    "impute_ratio",
    f"""WITH {GAPS}, b AS (SELECT *, l_quantity - 1 AS attempts FROM gaps)
SELECT {", ".join(_LINE_KEY)}, ROUND(CASE WHEN l_discount IS NOT NULL THEN l_discount
  WHEN attempts > 0 THEN l_tax / attempts * 100 ELSE 0 END, 6) AS l_discount FROM b""",
)
def impute_ratio(spark, d):
    rows = gaps(spark, d).withColumn("attempts", F.col("l_quantity") - 1)
    done = cleaning.impute_ratio(rows, Roles(impute=("l_tax", "attempts", "l_discount")))
    return rounded(done.select(*_LINE_KEY, "l_discount"))


_CORRECT = Roles(
    percent_cols=("l_extendedprice",),
    percent_bounds=(2000.0, 50000.0),
    caps={"l_quantity": 48.0},
    non_negative=("margin",),
    pairs=(("margin", "l_discount"),),
    sum_identity=("margin", "l_discount", "total"),
)
_CORRECT_INPUT = f"""{GAPS}, b AS (SELECT *, l_tax - 0.04::DOUBLE AS margin, l_tax AS total FROM gaps)"""


def _correct_input(spark, d):
    return gaps(spark, d).withColumns({"margin": F.col("l_tax") - 0.04, "total": F.col("l_tax")})


@query(
    "correct_values",
    f"""WITH {_CORRECT_INPUT}, f AS (
  SELECT *, CASE WHEN margin IS NULL THEN NULL ELSE GREATEST(margin, 0.0::DOUBLE) END AS m0 FROM b),
m AS (SELECT *, CASE WHEN m0 IS NULL OR l_discount IS NULL THEN NULL ELSE LEAST(m0, l_discount) END AS m1 FROM f)
SELECT {", ".join(_LINE_KEY)}, LEAST(l_quantity, 48.0::DOUBLE) AS l_quantity,
  GREATEST(2000.0::DOUBLE, LEAST(50000.0::DOUBLE, l_extendedprice)) AS l_extendedprice,
  ROUND(m1, 6) AS margin, ROUND(m1 + l_discount, 6) AS total FROM m""",
)
def correct_values(spark, d):
    out = cleaning.correct_values(_correct_input(spark, d), _CORRECT)
    return rounded(out.select(*_LINE_KEY, "l_quantity", "l_extendedprice", "margin", "total"))


@query(
    "clean_table",
    f"""WITH {_CORRECT_INPUT}, u AS (SELECT DISTINCT l_quantity, l_extendedprice, l_discount, margin FROM (
  SELECT * FROM b UNION ALL SELECT * FROM b)),
i AS (SELECT l_quantity, l_extendedprice, margin, CASE WHEN l_discount IS NOT NULL THEN l_discount
  WHEN l_quantity > 0 THEN margin / l_quantity * 100 ELSE 0 END AS l_discount FROM u),
f AS (SELECT *, CASE WHEN margin IS NULL THEN NULL ELSE GREATEST(margin, 0.0::DOUBLE) END AS m0 FROM i)
SELECT LEAST(l_quantity, 48.0::DOUBLE) AS l_quantity,
  GREATEST(2000.0::DOUBLE, LEAST(50000.0::DOUBLE, l_extendedprice)) AS l_extendedprice, ROUND(l_discount, 6) AS l_discount,
  ROUND(CASE WHEN m0 IS NULL OR l_discount IS NULL THEN NULL ELSE LEAST(m0, l_discount) END, 6) AS margin FROM f""",
)
def clean_table(spark, d):
    rows = _correct_input(spark, d).select("l_quantity", "l_extendedprice", "l_discount", "margin")
    roles = Roles(
        percent_cols=_CORRECT.percent_cols,
        percent_bounds=_CORRECT.percent_bounds,
        caps=_CORRECT.caps,
        non_negative=_CORRECT.non_negative,
        pairs=_CORRECT.pairs,
        impute=("margin", "l_quantity", "l_discount"),
    )
    return rounded(cleaning.clean(rows.unionByName(rows), roles))


_RULES = Roles(
    target="y",
    percent_cols=("l_discount",),
    percent_bounds=(0.02, 0.08),
    caps={"l_quantity": 48.0},
    non_negative=("margin",),
    pairs=(("l_tax", "l_discount"),),
    sum_identity=("l_tax", "l_discount", "total"),
    sum_tolerance=0.05,
)
_RULES_INPUT = f"""{GAPS}, b AS (SELECT *, l_tax - 0.04::DOUBLE AS margin, l_tax AS total,
  CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 WHEN 'N' THEN NULL END AS y FROM gaps)"""


def _rules_input(spark, d):
    flag = F.col("l_returnflag")
    return _correct_input(spark, d).withColumn("y", F.when(flag == "R", 1).when(flag == "A", 0))


_RULE_SQL = {
    "l_quantity above 48": "l_quantity > 48",
    "l_discount outside [0.02,0.08]": "l_discount < 0.02::DOUBLE OR l_discount > 0.08::DOUBLE",
    "margin negative": "margin < 0",
    "l_tax above l_discount": "l_tax > l_discount",
    "l_tax + l_discount != total": "ABS(l_tax + l_discount - total) > 0.05::DOUBLE",
}


@query(
    "rule_violations",
    f"WITH {_RULES_INPUT} "
    + " UNION ALL ".join(
        f"SELECT '{r}' AS rule, COUNT(*) FILTER ({p}) AS violations, CASE WHEN COUNT(*) FILTER ({p}) > 0 THEN 'fail' ELSE 'pass' END AS status FROM b"
        for r, p in {**_RULE_SQL, "y not 0/1": "y IS NULL OR y NOT IN (0, 1)"}.items()
    ),
)
def rule_violations(spark, d):
    return contracts.rule_violations(_rules_input(spark, d), _RULES).select("rule", "violations", "status")


@query(
    "drop_invalid",
    f"WITH {_RULES_INPUT} SELECT {', '.join(_LINE_KEY)}, l_quantity, l_extendedprice, l_discount, l_tax FROM b WHERE "
    + " AND ".join(f"NOT COALESCE({p}, FALSE)" for p in _RULE_SQL.values()),
)
def drop_invalid(spark, d):
    kept = cleaning.drop_violations(_rules_input(spark, d), _RULES, ValidationConfig())
    return kept.select(*_LINE_KEY, *MEASURES)


_CONTRACT = (
    ColumnContract("c_custkey", "bigint", low=10),
    ColumnContract("c_nationkey", "int", low=0, high=20, allowed=tuple(range(20))),
    ColumnContract("c_acctbal", "double", low=0.0, high=9000.0),
    ColumnContract("segment_code", "int", nullable=False),
    ColumnContract("c_phone", "string"),
)


@query(
    "schema_violations",
    """WITH b AS (SELECT *, NULLIF(c_mktsegment, 'BUILDING') AS segment_code FROM customer)
SELECT 'c_name: unexpected column' AS rule, 1::BIGINT AS violations
UNION ALL SELECT 'c_mktsegment: unexpected column', 1::BIGINT
UNION ALL SELECT 'c_phone: missing column', 1::BIGINT
UNION ALL SELECT 'c_custkey: not bigint', 0::BIGINT
UNION ALL SELECT 'c_custkey: missing value', COUNT(*) FILTER (c_custkey IS NULL) FROM b
UNION ALL SELECT 'c_custkey: below 10', COUNT(*) FILTER (c_custkey < 10) FROM b
UNION ALL SELECT 'c_nationkey: not int', 0::BIGINT
UNION ALL SELECT 'c_nationkey: missing value', COUNT(*) FILTER (c_nationkey IS NULL) FROM b
UNION ALL SELECT 'c_nationkey: below 0', COUNT(*) FILTER (c_nationkey < 0) FROM b
UNION ALL SELECT 'c_nationkey: above 20', COUNT(*) FILTER (c_nationkey > 20) FROM b
UNION ALL SELECT 'c_nationkey: outside [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19]',
  COUNT(*) FILTER (c_nationkey NOT BETWEEN 0 AND 19) FROM b
UNION ALL SELECT 'c_acctbal: not double', 0::BIGINT
UNION ALL SELECT 'c_acctbal: missing value', COUNT(*) FILTER (c_acctbal IS NULL) FROM b
UNION ALL SELECT 'c_acctbal: below 0', COUNT(*) FILTER (c_acctbal < 0) FROM b
UNION ALL SELECT 'c_acctbal: above 9000', COUNT(*) FILTER (c_acctbal > 9000) FROM b
UNION ALL SELECT 'segment_code: not int', COUNT(*) FILTER (segment_code IS NOT NULL AND TRY_CAST(segment_code AS INTEGER) IS NULL) FROM b
UNION ALL SELECT 'segment_code: missing value', COUNT(*) FILTER (segment_code IS NULL) FROM b""",
)
def schema_violations(spark, d):
    rows = table(spark, d, "customer").withColumn("segment_code", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return contracts.contract_violations(rows, _CONTRACT).select("rule", "violations")


@query(
    "conform_schema",
    """SELECT CAST(p_size AS DOUBLE) AS p_size, CAST(p_partkey AS VARCHAR) AS p_partkey,
TRY_CAST(SUBSTR(p_brand, 7) AS INTEGER) AS p_brand, ROUND(p_retailprice, 6) AS p_retailprice FROM part""",
)
def conform_schema(spark, d):
    rows = table(spark, d, "part").withColumn("p_brand", F.expr("substr(p_brand, 7)"))
    order = (
        ColumnContract("p_size", "double"),
        ColumnContract("p_partkey", "string"),
        ColumnContract("p_brand", "int"),
        ColumnContract("p_retailprice", "double"),
    )
    return rounded(contracts.conform(rows, order))


@query("drop_unlabelled", f"WITH {_RULES_INPUT} SELECT {', '.join(MEASURES)}, y FROM b WHERE y IS NOT NULL")
def drop_unlabelled(spark, d):
    labelled = readers.drop_unlabelled(_rules_input(spark, d), "y")
    return readers.project(labelled, [*readers.feature_set("explicit", [], [], MEASURES), "y"])
