"""Model features as Spark SQL expressions over trip columns.

Features stay plain double columns, so the arithmetic runs in generated code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.schemas import FEATURE_NAMES

WEIGHT_COUNT = len(FEATURE_NAMES) + 1
X_COLUMNS = [f"x{j}" for j in range(WEIGHT_COUNT)]

IS_WEEKEND = "day_of_week in (0, 6)"
IS_AIRPORT = "rate_code_id in (2, 3)"


def raw_features(
    distance: str = "trip_distance",
    hour: str = "hour_of_day",
    day: str = "day_of_week",
    latitude: str = "pickup_latitude",
    longitude: str = "pickup_longitude",
    rate_code: str = "rate_code_id",
    passengers: str = "passenger_count",
) -> list[str]:
    """The eight unscaled features in model order, over the given column names."""
    return [
        distance,
        f"sin(2D * pi() * {hour} / 24D)",
        f"cos(2D * pi() * {hour} / 24D)",
        f"cast({day} in (0, 6) as double)",
        latitude,
        longitude,
        f"cast({rate_code} in (2, 3) as double)",
        f"cast({passengers} as double)",
    ]


def literal(value: float) -> str:
    return f"({float(value)!r}D)"


def extract_raw(trips: DataFrame, *keep: str) -> DataFrame:
    """Trip frame -> one double column per feature, plus any columns to keep."""
    features = [f"{f} as {n}" for f, n in zip(raw_features(), FEATURE_NAMES)]
    return trips.selectExpr(*keep, *features)


def standardised(
    means: Sequence[float], stds: Sequence[float], features: Sequence[str] | None = None
) -> list[str]:
    """z-scored features (those of a trip by default) followed by the constant bias input."""
    scaled = [
        f"({f} - {literal(m)}) / {literal(s)}"
        for f, m, s in zip(features or raw_features(), means, stds, strict=True)
    ]
    return [*scaled, "1D"]


def feature_matrix(
    trips: DataFrame, means: Sequence[float], stds: Sequence[float], *keep: str
) -> DataFrame:
    """``x0..x8`` and the target ``y`` for every trip."""
    x = [f"{c} as {n}" for c, n in zip(standardised(means, stds), X_COLUMNS)]
    return trips.selectExpr(*keep, *x, "duration_min as y")


def dot(terms: Sequence[str], weights: Sequence[float]) -> str:
    """Dot product with constant weights, summed from the left."""
    return " + ".join(f"({t}) * {literal(w)}" for t, w in zip(terms, weights, strict=True))


def dot_arrays(a: Column, b: Column) -> Column:
    """Dot product of two array columns of equal length."""
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)
