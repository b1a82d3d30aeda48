"""Missing-value rules: NULL is the only missing marker, comparisons with it are never true."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column by its literal name (names may hold blanks, dots or `%`)."""
    return F.col(quoted(name))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in skip]


def require_columns(df: DataFrame, names: Sequence[str], what: str = "columns") -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Missing required {what}: {missing}")


def clean_value(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing; untouched for types that cannot hold NaN."""
    if isinstance(df.schema[name].dataType, FRACTIONAL_TYPES):
        return F.expr(f"nullif({quoted(name)}, double('NaN'))")
    return col(name)


def double_value(df: DataFrame, name: str) -> Column:
    c = clean_value(df, name)
    return c if isinstance(df.schema[name].dataType, T.DoubleType) else c.cast("double")


def nan_to_null(df: DataFrame) -> DataFrame:
    fractional = [f.name for f in df.schema.fields if isinstance(f.dataType, FRACTIONAL_TYPES)]
    return df.withColumns({n: clean_value(df, n) for n in fractional}) if fractional else df


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clip that keeps missing values missing (plain least/greatest skip NULL)."""
    bounded = c
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    return F.when(c.isNotNull(), bounded)


def smaller_of(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def safe_ratio(numerator: Column, denominator: Column, eps: float) -> Column:
    return numerator / (denominator + F.lit(eps))


def holds(predicate: Column) -> Column:
    """A predicate over missing values counts as not met."""
    return F.coalesce(predicate, F.lit(False))


def share(predicate: Column) -> Column:
    return F.avg(holds(predicate).cast("double"))


def ratio(numerator: Column, denominator: Column, empty: float = 0.0) -> Column:
    """numerator / denominator, `empty` where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(empty))
