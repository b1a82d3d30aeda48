"""One scan, many columns: aggregate wide, report long."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.functions.nulls import col

# Aggregates per scan; beyond this generated code stops compiling into one stage.
MAX_AGGREGATES = 400


def summarise(
    df: DataFrame,
    columns: Sequence[str],
    metrics: Mapping[str, Callable[[str], Column]],
    key: str = "feature",
) -> DataFrame:
    """(key, metric…) with one row per column, computed by one aggregation of the table.

    `metrics` maps an output name to a function from column name to aggregate. Very wide
    tables are split into several scans so that one aggregation stays within codegen limits.
    """
    if not columns:
        raise ValueError("summarise needs at least one column")
    step = max(1, MAX_AGGREGATES // len(metrics))
    parts = [_summarise_once(df, columns[i : i + step], metrics, key) for i in range(0, len(columns), step)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _summarise_once(df, columns, metrics, key):
    wide = df.agg(*[fn(c).alias(f"m{j}_{i}") for i, c in enumerate(columns) for j, fn in enumerate(metrics.values())])
    return rows_from(
        wide, [{key: text(c), **{m: f"m{j}_{i}" for j, m in enumerate(metrics)}} for i, c in enumerate(columns)]
    )


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    """A SQL double literal, infinities included."""
    return f"double('{float(value)!r}')"


def rows_from(one_row: DataFrame, rows: Sequence[Mapping[str, str | Column]]) -> DataFrame:
    """Turn a one-row table into a few rows; every mapping gives one output row.

    Values are columns or SQL text. Text is parsed in one go, which matters for reports on
    hundreds of columns, where building every struct by its own calls takes seconds.
    """
    if all(isinstance(v, str) for r in rows for v in r.values()):
        structs = ", ".join("struct(" + ", ".join(f"{v} AS `{k}`" for k, v in r.items()) + ")" for r in rows)
        return one_row.selectExpr(f"inline(array({structs}))")
    as_column = lambda v: F.expr(v) if isinstance(v, str) else v
    return one_row.select(
        F.inline(F.array(*[F.struct(*[as_column(v).alias(k) for k, v in r.items()]) for r in rows]))
    )


def scalar_struct(one_row: DataFrame) -> Column:
    """A one-row table as a struct-typed scalar subquery: evaluated once, used in plain projections."""
    return one_row.select(F.struct(*[col(c) for c in one_row.columns])).scalar()


def melt(df: DataFrame, values: Mapping[str, Column], ids: Mapping[str, Column] | None = None, key: str = "feature") -> DataFrame:
    """(ids…, key, value) rows, one per column; all values must share a type."""
    ids = ids or {}
    wide = df.select(
        *[c.alias(f"id_{n}") for n, c in ids.items()], *[c.alias(f"v_{n}") for n, c in values.items()]
    )
    long = wide.unpivot([col(f"id_{n}") for n in ids], [col(f"v_{n}") for n in values], "k", "value")
    return long.select(
        *[col(f"id_{n}").alias(n) for n in ids], F.substring(F.col("k"), 3, 10_000).alias(key), F.col("value")
    )
