"""Roles and features of season statistics with a 0/1 career label, as one ready-made binding.

Fixed values: column names, limits, pairs, feature definitions and their allowed ranges.
"""

from __future__ import annotations

from framegate.config import ColumnContract, FeatureConfig, LeakageConfig, LinearFeature, RateFeature, Roles

ID = "Name"
TARGET = "TARGET_5Yrs"

COUNTS = (
    "GP", "MIN", "PTS", "FGM", "FGA", "3P Made", "3PA", "FTM", "FTA",
    "OREB", "DREB", "REB", "AST", "STL", "BLK", "TOV",
)
PERCENTS = ("FG%", "3P%", "FT%")
COLUMNS = (
    "Name", "GP", "MIN", "PTS", "FGM", "FGA", "FG%", "3P Made", "3PA", "3P%", "FTM", "FTA", "FT%",
    "OREB", "DREB", "REB", "AST", "STL", "BLK", "TOV", "TARGET_5Yrs",
)
BASE_FEATURES = COLUMNS[1:-1]

ROLES = Roles(
    target=TARGET,
    id_cols=(ID,),
    percent_cols=PERCENTS,
    percent_bounds=(0.0, 100.0),
    caps={"MIN": 48.0},
    non_negative=COUNTS,
    pairs=(("FGM", "FGA"), ("3P Made", "3PA"), ("FTM", "FTA")),
    sum_identity=("OREB", "DREB", "REB"),
    sum_tolerance=0.0,
    impute=("3P Made", "3PA", "3P%"),
)

# Columns whose negatives are a broken rule; cleaning floors all counts.
CHECKED_NON_NEGATIVE = ("PTS",)


def _column(name: str) -> ColumnContract:
    if name == ID:
        return ColumnContract(name, "string", nullable=True)
    if name == TARGET:
        return ColumnContract(name, "int", allowed=(0, 1))
    if name in PERCENTS:
        return ColumnContract(name, "double", low=0.0, high=100.0)
    return ColumnContract(name, "int" if name == "GP" else "double", low=0.0)


CONTRACT = tuple(_column(c) for c in COLUMNS)

FEATURES = FeatureConfig(
    features=(
        RateFeature("PTS_per_MIN", "PTS", "MIN"),
        RateFeature("FGM_per_FGA", "FGM", "FGA"),
        RateFeature("FT_per_FTA", "FTM", "FTA"),
        RateFeature("ThreePA_rate", "3PA", "FGA"),
        RateFeature("FT_rate", "FTA", "FGA"),
        LinearFeature("Usage_proxy", {"FGA": 1.0, "FTA": 0.44, "TOV": 1.0}),
        RateFeature("AST_to_TOV", "AST", "TOV"),
        RateFeature("REB_per_MIN", "REB", "MIN"),
        RateFeature("OREB_share", "OREB", "REB", clip=(0.0, 1.0)),
        RateFeature("DREB_share", "DREB", "REB", clip=(0.0, 1.0)),
    ),
    eps=1e-9,
)

FEATURE_RANGES = {
    "PTS_per_MIN": (0.0, 5.0),
    "FGM_per_FGA": (0.0, 1.5),
    "FT_per_FTA": (0.0, 1.5),
    "ThreePA_rate": (0.0, 2.0),
    "FT_rate": (0.0, 2.0),
    "Usage_proxy": (0.0, 200.0),
    "AST_to_TOV": (0.0, 20.0),
    "REB_per_MIN": (0.0, 2.0),
    "OREB_share": (0.0, 1.0),
    "DREB_share": (0.0, 1.0),
}

LEAKAGE = LeakageConfig(target=TARGET, id_cols=(ID,), forbidden=(TARGET,))
