"""Splits, folds, transforms and scaling: fitted numbers are small, applying them is a projection."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegate.functions.hashing import HASH_BITS, row_hash
from framegate.functions.longform import summarise
from framegate.functions.nulls import col, double_value
from framegate.session import checkpoint

# -- exact stratified splits ----------------------------------------------------------------

# Classes up to which cut-offs become literals of a projection; more of them are a table that is joined.
CLASSES_AS_LITERALS = 20
# Bits of the hash that one pass tells apart, and rows of a table that may be sent to every executor (some tens of bytes each).
PASS_BITS = 10
BROADCAST_CLASSES = 500_000


def _class_cutoffs(df: DataFrame, target: str, hashed: Column, ranks: Callable[[Column], Sequence[Column]]) -> DataFrame:
    """(class_, i, cutoff): the hash with exactly `ranks(rows of the class)[i]` rows of the class below it.

    All classes are searched at once. A pass counts rows by class and the next bits of the hash and keeps, for each rank, the
    bin that holds it; the next one looks only into these bins, until they hold one value. However large a class is, it
    never meets in one task, and classes stay a table however many there are. A rank beyond the rows has no cut-off.
    """
    rows = df.select(col(target).alias("class_"), hashed.alias("h")).filter("class_ is not null")
    shift, bins, left = HASH_BITS, None, 0
    done: list[DataFrame] = []
    while True:
        before, shift = shift, max(0, shift - PASS_BITS)
        inside = rows.withColumn("bin", F.shiftright("h", before))
        if bins is not None:
            inside = inside.join(_sent(bins.select("class_", "bin").distinct(), left), ["class_", "bin"])
        cells = inside.groupBy("class_", "bin", F.shiftright("h", shift).alias("next")).agg(
            F.count(F.lit(1)).alias("n"), F.min("h").alias("low"), F.max("h").alias("high")
        )
        # At most 2 ** PASS_BITS cells per class and bin reach these windows.
        whole = Window.partitionBy("class_", "bin")
        upto = whole.orderBy("next").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cells = cells.withColumn("upto", F.sum("n").over(upto))
        if bins is None:
            numbered = F.array(*[F.struct(F.lit(i).alias("i"), r.cast("long").alias("rank")) for i, r in enumerate(ranks(F.col("rows")))])
            asked = cells.withColumn("rows", F.sum("n").over(whole)).select("*", F.inline(numbered))
        else:
            asked = cells.join(_sent(bins, left), ["class_", "bin"])
        found = asked.filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))).select(
            "class_", "i", F.col("next").alias("bin"), (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "low", "high"
        )
        found = checkpoint(found)
        done.append(found.filter("low = high").select("class_", "i", F.col("low").alias("cutoff")))
        bins = found.filter("low < high").select("class_", "i", "bin", "rank")
        left = bins.count()
        if not left:
            return reduce(DataFrame.unionByName, done)


def _sent(table: DataFrame, rows: int) -> DataFrame:
    """Broadcast if counted to be small; otherwise a hot class is many keys, as the bins are keys as well."""
    return F.broadcast(table) if rows <= BROADCAST_CLASSES else table


def _with_passed(df: DataFrame, target: str, hashed: Column, cutoffs: DataFrame, name: str, final: Callable[[Column], Column]) -> DataFrame:
    """Adds `final` of how many of its class's cut-offs the row's hash reaches; NULL without a class.

    A few classes are literals in a projection; more are a small table that is joined.
    """
    per_class = cutoffs.groupBy("class_").agg(F.array_sort(F.collect_list("cutoff")).alias("cutoffs_"))
    few = per_class.limit(CLASSES_AS_LITERALS + 1).collect()
    labelled = lambda passed: F.when(col(target).isNotNull(), passed)
    if len(few) <= CLASSES_AS_LITERALS:
        passed = F.lit(0)
        for y, values in few:
            reached = sum(((hashed >= F.lit(v)).cast("int") for v in values), F.lit(0))
            passed = F.when(col(target) == F.lit(y), reached).otherwise(passed)
        return df.withColumn(name, final(labelled(passed)))
    per_class = checkpoint(per_class)
    reached = F.size(F.filter(F.coalesce("cutoffs_", F.array().cast("array<bigint>")), lambda c: hashed >= c))
    joined = df.join(_sent(per_class, per_class.count()), col(target) == F.col("class_"), "left")
    return joined.withColumn(name, final(labelled(reached))).drop("class_", "cutoffs_")


def stratified_split(
    df: DataFrame, target: str, keys: Sequence[str], test_share: float = 0.2, seed: int = 42, portable: bool = False
) -> DataFrame:
    """Adds `is_test`: the same rounded share of every class, drawn by the hash of a unique row key.

    Rows without a label get NULL. With few classes adding the column is a projection without a shuffle.
    """
    hashed = row_hash(keys, seed, portable)
    cutoffs = _class_cutoffs(df, target, hashed, lambda n: [F.floor(n * F.lit(float(test_share)) + 0.5)])
    return _with_passed(df, target, hashed, cutoffs, "is_test", lambda passed: passed == 0)


def stratified_folds(
    df: DataFrame, target: str, keys: Sequence[str], k: int = 5, seed: int = 42, portable: bool = False
) -> DataFrame:
    """Adds `fold` in 0…k-1; fold sizes differ by at most one within every class."""
    hashed = row_hash(keys, seed, portable)
    cutoffs = _class_cutoffs(df, target, hashed, lambda n: [F.call_function("div", n * i, F.lit(k)) for i in range(1, k)])
    return _with_passed(df, target, hashed, cutoffs, "fold", lambda passed: passed)


def plain_folds(df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 42, portable: bool = False) -> DataFrame:
    """Adds `fold` by hash alone: one projection, sizes equal up to chance."""
    return df.withColumn("fold", F.pmod(row_hash(keys, seed, portable), F.lit(k)).cast("int"))


# -- single transforms ----------------------------------------------------------------------


def log1p(c: Column) -> Column:
    return F.log1p(c)


def square_root(c: Column) -> Column:
    return F.sqrt(c)


def yeo_johnson(c: Column, lam: float) -> Column:
    """Power transform for values of any sign at a fixed parameter.

    Each branch is fed with operands of its own sign only, so neither ever leaves its domain.
    """
    return _yeo_johnson(c, F.lit(float(lam)))


def _yeo_johnson(c: Column, lam: Column) -> Column:
    up, down = F.greatest(c, F.lit(0.0)), F.greatest(-c, F.lit(0.0))
    return F.when(c >= 0, _box(up, lam)).when(c < 0, -_box(down, 2 - lam))


def _box(v: Column, power: Column) -> Column:
    """((v + 1)^power - 1) / power, the logarithm at power 0."""
    flat = F.abs(power) < 1e-12
    return F.when(flat, F.log1p(v)).otherwise(F.try_divide(F.pow(v + 1, power) - 1, power))


def fit_yeo_johnson(
    df: DataFrame, columns: Sequence[str], low: float = -5.0, high: float = 5.0, precision: float = 1e-3
) -> dict[str, float]:
    """Maximum-likelihood parameter per column, all columns per scan.

    A coarse grid over [low, high] is followed by ever closer triples around the top of the
    parabola through the best point and its neighbours: about twenty evaluations per value in
    five or six scans. Each scan combines columns × tried parameters groups on the map side.
    """
    i, size, sign = F.col("i"), F.col("size"), F.col("sign")
    v = F.col("v")
    # With L = log(1 + |x|) the transform is ±(exp(p·L) - 1) / p, p = λ for x >= 0 and 2 - λ below.
    long = (
        df.select(
            F.stack(F.lit(len(columns)), *[x for j, c in enumerate(columns) for x in (F.lit(j), double_value(df, c))]).alias("i", "v")
        )
        .filter("v is not null")
        .select("i", F.log1p(F.abs(v)).alias("size"), F.when(v < 0, -1.0).otherwise(1.0).alias("sign"))
    )
    p = F.when(sign < 0, 2 - F.col("lam")).otherwise(F.col("lam"))
    value = sign * F.when(F.abs(p) < 1e-12, size).otherwise(F.expm1(p * size) / p)

    def score(tried: Sequence[Sequence[float]]) -> list[list[float]]:
        grids = F.array(*[F.array(*[F.lit(float(x)) for x in t]) for t in tried])
        rows = (
            long.select("i", "size", "sign", F.posexplode(grids[i]).alias("g", "lam"))
            .groupBy("i", "g")
            .agg(F.var_pop(value).alias("var"), F.count(F.lit(1)).alias("n"), F.sum(sign * size).alias("logs"))
            .collect()
        )
        out = [[-math.inf] * len(t) for t in tried]
        for r in rows:
            out[r["i"]][r["g"]] = _log_likelihood(r["n"], r["var"], r["logs"], tried[r["i"]][r["g"]])
        return out

    known: list[dict[float, float]] = [{} for _ in columns]
    step = (high - low) / 10
    tried = [[low + step * g for g in range(11)] for _ in columns]
    while True:
        for seen, t, s in zip(known, tried, score(tried)):
            seen.update(zip(t, s))
        best = [max(seen, key=lambda x: (seen[x], -abs(x))) for seen in known]
        # A column is done when its best point lies between two tried points within the precision.
        done = [
            any(0 < b - x <= precision for x in seen) and any(0 < x - b <= precision for x in seen) or b in (low, high)
            for b, seen in zip(best, known)
        ]
        if all(done):
            return dict(zip(columns, best))
        step = max(step / 10, precision)
        tried = [
            [min(max(x, low), high) for x in (top - step, top, top + step)]
            for top in (b if d else _parabola_top(seen, b) for b, d, seen in zip(best, done, known))
        ]


def _parabola_top(seen: Mapping[float, float], best: float) -> float:
    """Top of the parabola through the best point and its nearest neighbours, if that is a top between them."""
    below = max((x for x in seen if x < best), default=None)
    above = min((x for x in seen if x > best), default=None)
    if below is None or above is None or math.isinf(seen[below]) or math.isinf(seen[above]):
        return best
    left, right = (seen[best] - seen[below]) / (best - below), (seen[above] - seen[best]) / (above - best)
    if not left > right:
        return best
    middle_left, middle_right = (below + best) / 2, (best + above) / 2
    return min(max(middle_left + (middle_right - middle_left) * left / (left - right), below), above)


def _log_likelihood(n: int, variance: float | None, signed_logs: float | None, lam: float) -> float:
    if not n or variance is None or not variance > 0 or math.isinf(variance) or math.isnan(variance):
        return -math.inf
    return -n / 2 * math.log(variance) + (lam - 1) * signed_logs


def skew_comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """(feature, skew_before, skew_after) from two skew reports."""
    return (
        before.select("feature", F.col("skewness").alias("skew_before"))
        .join(F.broadcast(after.select("feature", F.col("skewness").alias("skew_after"))), "feature")
        .orderBy("feature")
    )


# -- transform plan -------------------------------------------------------------------------

LOG1P, YEO_JOHNSON, NONE = "log1p", "yeo_johnson", "none"


def transform_plan(skew: DataFrame, features: Sequence[str]) -> dict[str, str]:
    """Feature to transform, from a skew report; features the report lacks stay as they are."""
    suggested = {r["feature"]: r["suggestion"] for r in skew.select("feature", "suggestion").collect()}
    return {f: s if (s := suggested.get(f)) in (LOG1P, YEO_JOHNSON) else NONE for f in features}


def output_order(plan: Mapping[str, str]) -> list[str]:
    """Transformed columns first: log, then power, then the rest."""
    return [f for kind in (LOG1P, YEO_JOHNSON, NONE) for f, t in plan.items() if t == kind]


@dataclass(frozen=True)
class FittedTransforms:
    """Transform and scaling per feature, fitted on training rows.

    The fitted numbers are rendered as SQL text, so the same expressions run in a DataFrame and
    inside a saved pipeline model.
    """

    order: tuple[str, ...]
    plan: Mapping[str, str]
    lambdas: Mapping[str, float] = field(default_factory=dict)
    # feature -> (shift, scale): (x - shift) / scale
    power_scaling: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    scaling: Mapping[str, tuple[float, float]] = field(default_factory=dict)

    def shaped_sql(self, feature: str) -> str:
        x = f"cast(`{feature}` as double)"
        kind = self.plan[feature]
        if kind == LOG1P:
            return f"log1p({x})"
        if kind == YEO_JOHNSON:
            return _scaled_sql(yeo_johnson_sql(x, self.lambdas[feature]), self.power_scaling.get(feature))
        return x

    def sql(self, feature: str) -> str:
        return _scaled_sql(self.shaped_sql(feature), self.scaling.get(feature))

    def columns(self, prefix: str = "t_") -> list[str]:
        return [f"{prefix}{f}" for f in self.order]

    def apply(self, df: DataFrame, prefix: str = "t_") -> DataFrame:
        return df.withColumns({f"{prefix}{f}": F.expr(self.sql(f)) for f in self.order})

    def statement(self, prefix: str = "t_") -> str:
        """The projection as a statement for a SQL pipeline stage."""
        return "SELECT *, " + ", ".join(f"{self.sql(f)} AS `{prefix}{f}`" for f in self.order) + " FROM __THIS__"


def _literal(x: float) -> str:
    return f"({float(x)!r}D)"


def _scaled_sql(value: str, shift_scale: tuple[float, float] | None) -> str:
    if shift_scale is None:
        return value
    return f"(({value}) - {_literal(shift_scale[0])}) / {_literal(shift_scale[1])}"


def yeo_johnson_sql(x: str, lam: float) -> str:
    def box(v: str, power: float) -> str:
        if abs(power) < 1e-12:
            return f"log1p({v})"
        return f"((power({v} + 1, {_literal(power)}) - 1) / {_literal(power)})"

    up, down = f"greatest({x}, 0D)", f"greatest(-{x}, 0D)"
    return f"(CASE WHEN {x} >= 0 THEN {box(up, lam)} WHEN {x} < 0 THEN -{box(down, 2 - lam)} END)"


def _scaled(value: Column, shift_scale: tuple[float, float] | None) -> Column:
    if shift_scale is None:
        return value
    return (value - F.lit(shift_scale[0])) / F.lit(shift_scale[1])


SCALERS = ("standard", "minmax", "none")


def scaling_table(df: DataFrame, columns: Sequence[str], method: str, values: Mapping[str, Column] | None = None) -> DataFrame:
    """(feature, shift, scale) fitted in one scan; population deviation, constant columns get scale 1."""
    value = (lambda c: values[c]) if values is not None else (lambda c: double_value(df, c))
    if method == "standard":
        shift, spread = (lambda c: F.avg(value(c))), (lambda c: F.stddev_pop(value(c)))
    elif method == "minmax":
        shift, spread = (lambda c: F.min(value(c))), (lambda c: F.max(value(c)) - F.min(value(c)))
    else:
        raise ValueError(f"Unsupported scaler: {method}. Use one of: {', '.join(SCALERS)}.")
    table = summarise(df, columns, {"shift": shift, "scale": spread})
    return table.select(
        "feature",
        F.coalesce("shift", F.lit(0.0)).alias("shift"),
        F.when(F.col("scale") > 0, F.col("scale")).otherwise(F.lit(1.0)).alias("scale"),
    )


def fit_scaling(df: DataFrame, columns: Sequence[str], method: str, values: Mapping[str, Column] | None = None) -> dict[str, tuple[float, float]]:
    return {r["feature"]: (r["shift"], r["scale"]) for r in scaling_table(df, columns, method, values).collect()}


def scale(df: DataFrame, columns: Sequence[str], method: str = "standard", prefix: str = "scaled_") -> DataFrame:
    """Adds scaled copies of the columns, fitted on this table."""
    if method == "none":
        return df.withColumns({f"{prefix}{c}": double_value(df, c) for c in columns})
    fitted = fit_scaling(df, columns, method)
    return df.withColumns({f"{prefix}{c}": _scaled(double_value(df, c), fitted[c]) for c in columns})


def fit_transforms(
    train: DataFrame, features: Sequence[str], plan: Mapping[str, str] | None = None, scaler: str = "standard",
    standardise_power: bool = True,
) -> FittedTransforms:
    """Fit power parameters, their standardisation and the scaling on the training rows only."""
    if scaler not in SCALERS:
        raise ValueError(f"Unsupported scaler: {scaler}. Use one of: {', '.join(SCALERS)}.")
    plan = dict(plan or {f: NONE for f in features})
    order = tuple(output_order(plan))
    power = [f for f in order if plan[f] == YEO_JOHNSON]
    lambdas = fit_yeo_johnson(train, power) if power else {}
    powered = {f: F.expr(yeo_johnson_sql(f"cast(`{f}` as double)", lambdas[f])) for f in power}
    power_scaling = fit_scaling(train, power, "standard", powered) if power and standardise_power else {}
    fitted = FittedTransforms(order, plan, lambdas, power_scaling)
    if scaler == "none":
        return fitted
    values = {f: F.expr(fitted.shaped_sql(f)) for f in order}
    return FittedTransforms(order, plan, lambdas, power_scaling, fit_scaling(train, list(order), scaler, values))
