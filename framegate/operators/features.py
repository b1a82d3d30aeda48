"""Ratio and linear features declared by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.config import FeatureConfig, LinearFeature, RateFeature
from framegate.functions.nulls import clip, col, require_columns, safe_ratio


def enabled_features(cfg: FeatureConfig) -> list[RateFeature | LinearFeature]:
    known = {f.name for f in cfg.features}
    unknown = [n for n in cfg.enabled or () if n not in known]
    if unknown:
        raise ValueError(f"Unknown features: {unknown}")
    return [f for f in cfg.features if cfg.enabled is None or f.name in cfg.enabled]


def inputs_of(feature: RateFeature | LinearFeature) -> list[str]:
    if isinstance(feature, RateFeature):
        return [feature.numerator, feature.denominator]
    return list(feature.weights)


def feature_expression(feature: RateFeature | LinearFeature, eps: float) -> Column:
    """A zero denominator gives a huge finite value, which the feature contract then reports."""
    if isinstance(feature, RateFeature):
        value = safe_ratio(col(feature.numerator), col(feature.denominator), eps)
        return clip(value, *feature.clip) if feature.clip else value
    terms = [col(c) if w == 1 else col(c) * F.lit(float(w)) for c, w in feature.weights.items()]
    return sum(terms[1:], terms[0])


def add_features(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Append every enabled feature in one projection; missing inputs raise first."""
    chosen = enabled_features(cfg)
    require_columns(df, list(dict.fromkeys(c for f in chosen for c in inputs_of(f))), "feature inputs")
    return df.withColumns({f.name: feature_expression(f, cfg.eps) for f in chosen}) if chosen else df
