"""pass < warn < fail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASS, WARN, FAIL = "pass", "warn", "fail"
LEVELS = (PASS, WARN, FAIL)


class GateError(ValueError):
    """Raised by `enforce` when a gate is not met."""


def level(warn: Column | bool = False, fail: Column | bool = False) -> Column:
    """Status of one check; missing operands never raise the level."""
    as_col = lambda c: F.lit(c) if isinstance(c, bool) else F.coalesce(c, F.lit(False))
    return F.when(as_col(fail), F.lit(FAIL)).when(as_col(warn), F.lit(WARN)).otherwise(F.lit(PASS))


def rank(status: Column) -> Column:
    return F.when(status == FAIL, 2).when(status == WARN, 1).otherwise(0)


def worst(status: Column) -> Column:
    """Aggregate: the highest status of a group (pass for an empty one)."""
    top = F.coalesce(F.max(rank(status)), F.lit(0))
    return F.element_at(F.array(*[F.lit(s) for s in LEVELS]), top + 1)


def overall(checks: DataFrame, message: str = "message") -> DataFrame:
    """One row (status, details) over a table of checks with a `status` column."""
    noted = F.collect_list(F.when(F.col("status") != PASS, F.col(message)))
    return checks.agg(worst(F.col("status")).alias("status"), F.array_sort(noted).alias("details"))


def enforce(checks: DataFrame, at: str = FAIL, message: str = "message", title: str = "Gate failed") -> None:
    """Run the gate and raise with every message at or above the level `at`."""
    minimum = LEVELS.index(at)
    bad = checks.filter(rank(F.col("status")) >= minimum).select(message).collect()
    if bad:
        raise GateError(f"{title}:\n- " + "\n- ".join(sorted(r[0] for r in bad)))
