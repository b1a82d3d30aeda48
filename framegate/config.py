"""Column roles and thresholds. Every default is the value the checks are expected to use."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    """Which columns play which part in cleaning and validation."""

    target: str | None = None
    id_cols: tuple[str, ...] = ()
    percent_cols: tuple[str, ...] = ()
    percent_bounds: tuple[float, float] = (0.0, 100.0)
    caps: Mapping[str, float] = field(default_factory=dict)
    non_negative: tuple[str, ...] = ()
    # (made, attempted): the first may not exceed the second
    pairs: tuple[tuple[str, str], ...] = ()
    # (a, b, total): a + b = total
    sum_identity: tuple[str, str, str] | None = None
    sum_tolerance: float = 0.0
    # (made, attempted, percent): a missing percent follows from the other two
    impute: tuple[str, str, str] | None = None


@dataclass(frozen=True)
class CleaningConfig:
    drop_duplicates: bool = True
    impute_ratio: bool = True
    correct_values: bool = True


@dataclass(frozen=True)
class ValidationConfig:
    ranges: bool = True
    pairs: bool = True
    sum_identity: bool = True
    # columns whose negatives are violations (cleaning floors more columns than this checks)
    non_negative: tuple[str, ...] | None = None


@dataclass(frozen=True)
class ColumnContract:
    """Type, bounds and nullability of one column of a strict table contract."""

    name: str
    type: str
    nullable: bool = False
    low: float | None = None
    high: float | None = None
    allowed: tuple[int, ...] | None = None


@dataclass(frozen=True)
class StatCheckConfig:
    missing_warn: float = 0.20
    missing_fail: float = 0.50
    zscore: float = 4.0
    zscore_min_rows: int = 10
    outlier_rate_warn: float = 0.05
    constant_unique_ratio: float = 0.01
    # Optional second condition: at scale any low-cardinality column has a tiny unique ratio.
    constant_max_distinct: int | None = None
    target_max_share: float = 0.95


@dataclass(frozen=True)
class DriftConfig:
    quantile: str = "p50"
    warn: float = 0.20
    fail: float = 0.50
    eps: float = 1e-8


@dataclass(frozen=True)
class AnomalyConfig:
    enabled: bool = True
    q_low: float = 0.01
    q_high: float = 0.99
    min_non_null: int = 10
    exclude: tuple[str, ...] = ()
    rate_warn: float = 0.02
    rate_fail: float = 0.10
    method: str = "exact"


@dataclass(frozen=True)
class RateFeature:
    """numerator / (denominator + eps), optionally clipped."""

    name: str
    numerator: str
    denominator: str
    clip: tuple[float, float] | None = None


@dataclass(frozen=True)
class LinearFeature:
    """Weighted sum of columns."""

    name: str
    weights: Mapping[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class FeatureConfig:
    features: tuple[RateFeature | LinearFeature, ...] = ()
    enabled: tuple[str, ...] | None = None
    eps: float = 1e-9


@dataclass(frozen=True)
class FeatureQAConfig:
    enabled: bool = True
    missing_warn: float = 0.05
    missing_fail: float = 0.30
    unique_ratio_warn: float = 0.01
    unique_ratio_fail: float = 0.001
    inf_fail: bool = True


@dataclass(frozen=True)
class LeakageConfig:
    target: str
    enabled: bool = True
    id_cols: tuple[str, ...] = ()
    forbidden: tuple[str, ...] = ()
    drop_id_cols: bool = True
    required: tuple[str, ...] = ()
    check_duplicates: bool = True
    check_proxy: bool = True
    corr_warn: float = 0.85
    corr_fail: float = 0.95


@dataclass(frozen=True)
class CorrelationConfig:
    enabled: bool = True
    threshold: float = 0.95
    method: str = "pearson"
    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class SkewConfig:
    high: float = 1.0
    moderate: float = 0.5
    zero_ratio: float = 0.30


@dataclass(frozen=True)
class SelectionConfig:
    """Chain of score filter, forest filter and correlation pruning."""

    use_mutual_information: bool = True
    mi_top_k: int = 20
    mi_min_score: float = 0.0
    use_forest: bool = True
    forest_top_k: int = 15
    prune_correlated: bool = True
    corr_threshold: float = 0.90
    always_keep: tuple[str, ...] = ()


@dataclass(frozen=True)
class ForestSelectionConfig:
    enabled: bool = True
    top_k: int = 15
    min_importance: float = 0.0
    always_keep: tuple[str, ...] = ()
    trees: int = 300
    max_depth: int | None = None
    min_leaf: int = 1


@dataclass(frozen=True)
class Candidate:
    """A model to try: `random_forest`, `balanced_random_forest` or `gradient_boosting`."""

    name: str
    kind: str
    params: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class SmoteConfig:
    enabled: bool = True
    k_neighbors: int = 5


@dataclass(frozen=True)
class GateConfig:
    min_f1: float | None = 0.70
    min_recall: float | None = 0.65
    max_drop_vs_previous: float | None = None
