"""Table, report and event sinks, and content fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegate.functions.hashing import hashable
from framegate.functions.longform import summarise
from framegate.functions.nulls import col
from framegate.session import saved, workspace


def write_table(df: DataFrame, path: str, sort_by: Sequence[str] = (), partitions: int | None = None) -> None:
    """Parquet in a reproducible order: range-partitioned and sorted by the sort columns that exist.

    A hash of the row ends the key, so rows of one frequent value spread over as many files as they need.
    """
    keys = [k for k in sort_by if k in df.columns]
    if keys:
        by = [*[col(k) for k in keys], F.xxhash64(*[hashable(df, c) for c in df.columns])]
        ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
        df = ranged.sortWithinPartitions(*by)
    df.write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A report table (one row per column, pair or check) as CSV, JSON or Parquet."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        flat = [
            F.concat_ws("; ", col(f.name)).alias(f.name) if f.dataType.typeName() == "array" else col(f.name)
            for f in df.schema.fields
        ]
        df.select(*flat).write.mode("overwrite").csv(path, header=True)
    elif fmt in ("json", "parquet"):
        writer.format(fmt).save(path)
    else:
        raise ValueError(f"Unsupported report format: {fmt}")


def append_events(events: DataFrame, log_path: str, failure_path: str) -> None:
    """Append inference events as JSON lines; failed ones also go to the failure log. The events are evaluated once."""
    with workspace(events.sparkSession, "events") as folder:
        rows = saved(events, folder)
        rows.write.mode("append").json(log_path)
        failed_events(rows).write.mode("append").json(failure_path)


def failed_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("status") == "failed")


def fingerprint(df: DataFrame) -> DataFrame:
    """(column, type, rows, non_null, hash_sum): equal tables give equal rows in any file layout.

    Sums of per-value hashes do not depend on row order or partitioning; file bytes would.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    table = summarise(
        df,
        df.columns,
        {
            "type": lambda c: F.first(F.lit(types[c])),
            "rows": lambda c: F.count(F.lit(1)),
            "non_null": lambda c: F.count(col(c)),
            "hash_sum": lambda c: F.sum(F.xxhash64(hashable(df, c)).cast("decimal(38,0)")).cast("string"),
        },
        key="column",
    )
    return table
