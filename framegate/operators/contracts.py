"""Schema contracts and domain rules: violations are counted in one scan, raising is separate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.config import ColumnContract, Roles, ValidationConfig
from framegate.functions.longform import MAX_AGGREGATES, rows_from, text
from framegate.functions.nulls import clean_value, col, holds, is_numeric
from framegate.functions.status import FAIL, PASS, enforce


# -- domain rules ---------------------------------------------------------------------------


def rule_predicates(df: DataFrame, roles: Roles, cfg: ValidationConfig = ValidationConfig()) -> dict[str, Column]:
    """Rule name to "row breaks the rule"; only rules whose columns exist, missing values break none."""
    present = set(df.columns)
    v = lambda c: clean_value(df, c)
    rules: dict[str, Column] = {}
    if cfg.ranges:
        for c, cap in roles.caps.items():
            if c in present:
                rules[f"{c} above {cap:g}"] = holds(v(c) > cap)
        low, high = roles.percent_bounds
        for c in roles.percent_cols:
            if c in present:
                rules[f"{c} outside [{low:g},{high:g}]"] = holds((v(c) < low) | (v(c) > high))
        for c in roles.non_negative if cfg.non_negative is None else cfg.non_negative:
            if c in present:
                rules[f"{c} negative"] = holds(v(c) < 0)
    if cfg.pairs:
        for made, attempted in roles.pairs:
            if {made, attempted} <= present:
                rules[f"{made} above {attempted}"] = holds(v(made) > v(attempted))
    if cfg.sum_identity and roles.sum_identity and set(roles.sum_identity) <= present:
        a, b, total = roles.sum_identity
        rules[f"{a} + {b} != {total}"] = holds(F.abs(v(a) + v(b) - v(total)) > roles.sum_tolerance)
    return rules


def rule_violations(df: DataFrame, roles: Roles, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """(rule, violations, status, message) for all rules from one aggregation.

    A missing label is a violation of the label domain, unlike in the other rules. Columns
    that the sum rule or the label rule need but the table lacks are violations themselves.
    """
    rules = dict(rule_predicates(df, roles, cfg))
    absent = []
    if cfg.sum_identity and roles.sum_identity:
        absent += [c for c in roles.sum_identity if c not in df.columns]
    if roles.target:
        if roles.target in df.columns:
            rules[f"{roles.target} not 0/1"] = ~holds(col(roles.target).isin(0, 1))
        else:
            absent.append(roles.target)
    counts = {name: F.count_if(p) for name, p in rules.items()}
    counts.update({f"{c} missing from table": _always() for c in dict.fromkeys(absent)})
    return _violation_table(df, "rule", counts)


def validate_rules(df: DataFrame, roles: Roles, cfg: ValidationConfig = ValidationConfig()) -> None:
    """Collect every broken rule, then raise once."""
    enforce(rule_violations(df, roles, cfg), title="Validation rules failed")


# -- strict table contract ------------------------------------------------------------------


def contract_violations(df: DataFrame, contract: Sequence[ColumnContract]) -> DataFrame:
    """(rule, violations, status, message): presence, extra columns, type, nulls, bounds, domain."""
    names = [c.name for c in contract]
    counts: dict[str, Column] = {}
    for extra in [c for c in df.columns if c not in names]:
        counts[f"{extra}: unexpected column"] = _always()
    for c in contract:
        if c.name not in df.columns:
            counts[f"{c.name}: missing column"] = _always()
            continue
        raw = clean_value(df, c.name)
        typed = _coerced(df, c)
        counts[f"{c.name}: not {c.type}"] = F.count_if(raw.isNotNull() & typed.isNull())
        if not c.nullable:
            counts[f"{c.name}: missing value"] = F.count_if(raw.isNull())
        if c.low is not None:
            counts[f"{c.name}: below {c.low:g}"] = F.count_if(holds(typed < c.low))
        if c.high is not None:
            counts[f"{c.name}: above {c.high:g}"] = F.count_if(holds(typed > c.high))
        if c.allowed is not None:
            counts[f"{c.name}: outside {list(c.allowed)}"] = F.count_if(typed.isNotNull() & ~typed.isin(*c.allowed))
    return _violation_table(df, "rule", counts)


def _coerced(df: DataFrame, c: ColumnContract) -> Column:
    """The value in the contract's type; a number with a fraction does not become an integer."""
    raw = clean_value(df, c.name)
    typed = raw.try_cast(c.type)
    if c.type in ("int", "bigint") and not df.schema[c.name].dataType.simpleString() in ("int", "bigint", "smallint"):
        typed = F.when(raw.try_cast("double") == typed, typed)
    return typed


def conform(df: DataFrame, contract: Sequence[ColumnContract]) -> DataFrame:
    """Coerced columns in contract order."""
    return df.select(*[_coerced(df, c).alias(c.name) for c in contract])


def validate_contract(df: DataFrame, contract: Sequence[ColumnContract]) -> DataFrame:
    """Raise on any violation, else return the conformed table."""
    enforce(contract_violations(df, contract), title="Schema contract failed")
    return conform(df, contract)


# -- feature contract -----------------------------------------------------------------------


def feature_contract(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(rule, violations, status, message): every feature exists, is numeric, finite, present, in range."""
    counts: dict[str, Column] = {}
    for name, (low, high) in ranges.items():
        if name not in df.columns:
            counts[f"{name}: missing feature"] = _always()
            continue
        if not is_numeric(df.schema[name].dataType):
            counts[f"{name}: not numeric"] = _always()
            continue
        v = clean_value(df, name)
        counts[f"{name}: infinite"] = F.count_if(holds(F.abs(v) == float("inf")))
        counts[f"{name}: missing value"] = F.count_if(v.isNull())
        counts[f"{name}: outside [{low:g}, {high:g}]"] = F.count_if(holds((v < low) | (v > high)))
    return _violation_table(df, "rule", counts)


def validate_features(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> None:
    enforce(feature_contract(df, ranges), title="Feature contract failed")


def _always() -> Column:
    """One violation whatever the rows are, also for an empty table."""
    return F.greatest(F.count(F.lit(1)) * 0, F.lit(1)).cast("bigint")


def _violation_table(df: DataFrame, key: str, counts: Mapping[str, Column]) -> DataFrame:
    names = list(counts)
    if not names:
        return df.sparkSession.createDataFrame([], f"{key} string, violations bigint, status string, message string")
    parts = []
    for start in range(0, len(names), MAX_AGGREGATES):
        chunk = names[start : start + MAX_AGGREGATES]
        wide = df.agg(*[counts[n].alias(f"v{i}") for i, n in enumerate(chunk)])
        parts.append(rows_from(wide, [{key: text(n), "violations": f"coalesce(cast(v{i} as bigint), 0L)"} for i, n in enumerate(chunk)]))
    long = reduce(DataFrame.unionByName, parts)
    broken = F.col("violations") > 0
    return long.select(
        key,
        "violations",
        F.when(broken, F.lit(FAIL)).otherwise(F.lit(PASS)).alias("status"),
        F.format_string("%s (%d rows)", F.col(key), F.col("violations")).alias("message"),
    )
