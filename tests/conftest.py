from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from framegate import presets  # noqa: E402
from framegate.session import local_session  # noqa: E402

STATS = [c for c in presets.COLUMNS if c not in (presets.ID, presets.TARGET)]


@pytest.fixture(scope="session")
def spark():
    session = local_session("framegate-tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def season(name="A", **changes):
    """One clean season line; keyword arguments use the column names."""
    row = {
        "Name": name, "GP": 50.0, "MIN": 20.0, "PTS": 10.0, "FGM": 4.0, "FGA": 9.0, "FG%": 44.4, "3P Made": 1.0, "3PA": 3.0,
        "3P%": 33.3, "FTM": 2.0, "FTA": 3.0, "FT%": 66.7, "OREB": 1.0, "DREB": 3.0, "REB": 4.0, "AST": 2.0, "STL": 1.0,
        "BLK": 0.5, "TOV": 1.0, "TARGET_5Yrs": 1,
    }
    row.update(changes)
    return row


def seasons(spark, rows):
    schema = ", ".join(
        f"`{c}` " + ("string" if c == presets.ID else "int" if c == presets.TARGET else "double") for c in presets.COLUMNS
    )
    return spark.createDataFrame([tuple(r[c] for c in presets.COLUMNS) for r in rows], schema)


@pytest.fixture()
def dirty(spark):
    """A, A again, B: a missing percent and a wrong total; a copy; impossible values."""
    a = season("A", **{"3P%": None, "REB": 9.5})
    b = season(
        "B", MIN=51.5, PTS=-0.5, FGM=7.5, FGA=5.5, FTM=3.5, FTA=2.5, REB=40.0, TARGET_5Yrs=0,
        **{"FG%": 101.0, "3P Made": 4.5, "3PA": 1.5, "3P%": 300.0, "FT%": -1.0},
    )
    return seasons(spark, [a, a, b])


def by(df, key, value=None):
    """Rows of a small table as a dict."""
    return {r[key]: (r.asDict() if value is None else r[value]) for r in df.collect()}
