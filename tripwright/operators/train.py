"""Linear regression by full-batch gradient descent, from one distributed aggregate.

The loss and its gradient depend on the data only through counts, means and second moments. One
pass collects those (numbers of a 9 x 9 matrix per split); the epochs then run on that matrix,
so a hundred epochs read the data no more often than one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripwright.functions import features as X
from tripwright.functions import trip as P
from tripwright.operators import evaluate as E
from tripwright.operators.model import LinearModel
from tripwright.schemas import FEATURE_NAMES, MIN_STD

# The features and the target; those that vary by row come from these trip columns, the rest are
# functions of hour, weekend and airport.
_VARIABLES = [*FEATURE_NAMES, "y"]
_BY_ROW = {
    "trip_distance": "trip_distance",
    "pickup_lat": "pickup_latitude",
    "pickup_lon": "pickup_longitude",
    "passenger_count": "passenger_count",
    "y": "duration_min",
}

# Sums are taken around these points to keep digits; any value near the data will do.
_FIRST_CENTRE = dict.fromkeys(_VARIABLES, 0.0) | {"pickup_lat": 40.75, "pickup_lon": -74.0}
_MIN_CONDITION = 1e-6
_CATEGORY = ["is_train", "hour_of_day", "weekend", "airport"]


@dataclass
class Moments:
    """Count, means and population covariance of the features and the target of one split."""

    n: int
    means: np.ndarray
    covariance: np.ndarray
    mean_mph: float
    well_conditioned: bool = True

    @property
    def stds(self) -> np.ndarray:
        """Population deviations of the features; 1 for a constant one."""
        stds = np.sqrt(np.diag(self.covariance)[:-1])
        return np.where(stds < MIN_STD, 1.0, stds)

    @property
    def mean_y(self) -> float:
        return float(self.means[-1])


EMPTY = Moments(0, np.zeros(9), np.zeros((9, 9)), 0.0)


def category_sums(
    trips: DataFrame, train: Column, centre: Mapping[str, float], *by: str
) -> DataFrame:
    """Sums and sums of products per split, hour, weekend and airport: at most 192 rows (for each value of ``by``).

    Four of the eight features are functions of those keys. Grouping by them leaves 20 running
    sums per trip instead of 54, no sine or cosine per trip, and a result that does not grow with
    the data.
    """
    by_row = [f"{c} - {X.literal(centre[v])} as {v}" for v, c in _BY_ROW.items()]
    rows = trips.withColumn("is_train", train).selectExpr(
        *by,
        "is_train",
        "hour_of_day",
        f"{X.IS_WEEKEND} as weekend",
        f"{X.IS_AIRPORT} as airport",
        *by_row,
        f"{P.MOVING_MPH} as mph",
    )
    pairs = combinations_with_replacement(_BY_ROW, 2)
    sums = [f"sum({v}) as {v}" for v in _BY_ROW]
    sums += [f"sum({u} * {v}) as `{u}*{v}`" for u, v in pairs]
    sums += ["count(*) as n", "sum(mph) as mph_sum", "count(mph) as mph_n"]
    keys = [*by, *_CATEGORY]
    return rows.groupBy(*keys).agg(*[F.expr(e) for e in sums])


def combine(groups: Sequence[Row], centre: Mapping[str, float]) -> Moments:
    """Moments of one split from its category sums."""
    n, mph_n = sum(g.n for g in groups), sum(g.mph_n for g in groups)
    sums, products = np.zeros(9), np.zeros((9, 9))
    for g in groups:
        angle = 2 * math.pi * g.hour_of_day / 24
        fixed = {
            "sin_hour": math.sin(angle),
            "cos_hour": math.cos(angle),
            "is_weekend": float(g.weekend),
            "is_airport": float(g.airport),
        }
        offset = np.array([fixed[v] - centre[v] if v in fixed else 0.0 for v in _VARIABLES])
        row_sums = np.array([0.0 if v in fixed else g[v] for v in _VARIABLES])
        sums += g.n * offset + row_sums
        products += g.n * np.outer(offset, offset)
        products += np.outer(offset, row_sums) + np.outer(row_sums, offset)
        for u, v in combinations_with_replacement(_BY_ROW, 2):
            i, j = _VARIABLES.index(u), _VARIABLES.index(v)
            products[i, j] += g[f"{u}*{v}"]
            if i != j:
                products[j, i] += g[f"{u}*{v}"]
    mean, second = sums / n, products / n
    covariance = second - np.outer(mean, mean)
    spread, raw = np.diag(covariance), np.diag(second)
    lost = (raw > 0) & (spread < _MIN_CONDITION * raw) & (np.abs(mean) > MIN_STD)
    covariance[np.diag_indices(9)] = np.maximum(spread, 0.0)
    return Moments(
        n=n,
        means=np.array([centre[v] for v in _VARIABLES]) + mean,
        covariance=covariance,
        mean_mph=sum(g.mph_sum or 0.0 for g in groups) / mph_n if mph_n else 0.0,
        well_conditioned=not lost.any(),
    )


def moments(trips: DataFrame, train: Column) -> tuple[Moments, Moments]:
    """Moments of the train and the test split, in one pass over the trips.

    If a column lies so far from the expected centre that its variance would lose digits, a second
    pass sums around the means just found.
    """
    centre = _FIRST_CENTRE
    for _ in range(2):
        groups = category_sums(trips, train, centre).collect()
        splits = {}
        for side in (True, False):
            rows = [g for g in groups if g.is_train is side]
            splits[side] = combine(rows, centre) if rows else EMPTY
        if all(m.well_conditioned for m in splits.values()):
            break
        around = splits[True] if splits[True].n else splits[False]
        centre = dict(zip(_VARIABLES, around.means.tolist()))
    return splits[True], splits[False]


def add_moments(trips: DataFrame, train: Column, folder: str, source: str = "file_path") -> None:
    """Append to the table in ``folder`` the sums of each ``source`` it does not hold yet.

    Sums of sources add up, so training on more sources reads the new ones only. All are taken around
    the means of the first trips stored. The append is one job: after a failure none of its sources is
    held. One writer at a time.
    """
    spark = trips.sparkSession
    if _exists(spark, f"{folder}/sums"):
        held = stored_sources(spark, folder, source)
        trips = trips.join(held, source, "left_anti")
        centre = _stored_centre(spark, folder)
    else:
        in_train, in_test = moments(trips, train)
        around = in_train if in_train.n else in_test
        centre = dict(zip(_VARIABLES, around.means.tolist())) if around.n else _FIRST_CENTRE
        rows = spark.createDataFrame(list(centre.items()), "variable string, value double")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/centre")
    sums = category_sums(trips, train, centre, source)
    sums.coalesce(1).write.mode("append").parquet(f"{folder}/sums")


def stored_sources(spark: SparkSession, folder: str, source: str = "file_path") -> DataFrame:
    """The sources whose sums the table in ``folder`` holds."""
    if not _exists(spark, f"{folder}/sums"):
        return spark.createDataFrame([], f"{source} string")
    return spark.read.parquet(f"{folder}/sums").select(source).distinct()


def stored_moments(spark: SparkSession, folder: str) -> tuple[Moments, Moments]:
    """Moments of the train and the test split over all sources held, from sums alone.

    The centre of stored sums is fixed; where later sources lie so far from it that digits are lost,
    a second pass is not possible and it is an error.
    """
    if not _exists(spark, f"{folder}/sums"):
        raise LookupError(f"no moments in {folder}")
    table, centre = spark.read.parquet(f"{folder}/sums"), _stored_centre(spark, folder)
    names = table.columns[table.columns.index("airport") + 1 :]
    groups = table.groupBy(*_CATEGORY).agg(*[F.sum(f"`{n}`").alias(n) for n in names]).collect()
    out = []
    for side in (True, False):
        rows = [g for g in groups if g.is_train is side]
        out.append(combine(rows, centre) if rows else EMPTY)
    if not all(m.well_conditioned for m in out):
        raise ValueError("stored sums lie too far from their centre; store them anew")
    return out[0], out[1]


def _stored_centre(spark: SparkSession, folder: str) -> dict[str, float]:
    """A value for each of the nine variables."""
    return dict(map(tuple, spark.read.parquet(f"{folder}/centre").collect()))


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def descend(m: Moments, epochs: int, learning_rate: float) -> tuple[list[float], list[float]]:
    """Weights after ``epochs`` full-batch updates from zero, and the loss after each.

    On standardised inputs the mean gradient is (correlations · weights - covariances with y); the
    bias input is uncorrelated with the others, so its part is (bias - mean of y).
    """
    correlation, with_y, variance_y = _standardised(m)
    weights, losses = np.zeros(9), []
    for _ in range(epochs):
        weights[:8] -= learning_rate * (correlation @ weights[:8] - with_y)
        weights[8] -= learning_rate * (weights[8] - m.mean_y)
        w = weights[:8]
        mse = variance_y + w @ correlation @ w - 2 * (w @ with_y) + (weights[8] - m.mean_y) ** 2
        losses.append(max(float(mse), 0.0))
    return weights.tolist(), losses


def _standardised(m: Moments) -> tuple[np.ndarray, np.ndarray, float]:
    scale = 1.0 / m.stds
    features = m.covariance[:8, :8] * np.outer(scale, scale)
    return features, m.covariance[:8, 8] * scale, float(m.covariance[8, 8])


def gram_matrix(spark: SparkSession, m: Moments) -> DataFrame:
    """The sufficient statistics as rows (i, j, value): X'X, then X'y as j=9 and y'y as (9, 9)."""
    features, with_y, variance_y = _standardised(m)
    full = np.zeros((10, 10))
    full[:8, :8], full[8, 8] = features, 1.0
    full[:8, 9], full[8, 9], full[9, 9] = with_y, m.mean_y, variance_y + m.mean_y**2
    rows = [(i, j, float(full[i, j] * m.n)) for i in range(10) for j in range(i, 10)]
    return spark.createDataFrame(rows, "i int, j int, value double")


def fit(
    trips: DataFrame,
    train: Column,
    epochs: int = 10,
    learning_rate: float = 0.01,
    batch_size: int = 1024,
    workers: int = 1,
) -> tuple[LinearModel, DataFrame]:
    """Fitted and evaluated model, and the comparison table against two baselines.

    Two passes over the trips whatever the number of epochs: one for the moments, one for the
    errors of all three models on both splits. ``batch_size`` and ``workers`` are only recorded:
    every batch of an epoch is taken at the same weights, so they do not change the result.
    """
    if epochs <= 0 or learning_rate <= 0:
        raise ValueError("epochs and learning rate must be positive")
    in_train, in_test = moments(trips, train)
    if in_train.n == 0:
        raise ValueError("no trips to train on")
    weights, losses = descend(in_train, epochs, learning_rate)
    model = LinearModel(
        weights=weights,
        means=in_train.means[:8].tolist(),
        stds=in_train.stds.tolist(),
        epochs=epochs,
        learning_rate=learning_rate,
        batch_size=batch_size,
        workers=workers,
        loss_history=losses,
    )
    results = E.evaluate_splits(trips, train, model, in_train.mean_y, in_train.mean_mph)
    model.set_metrics(results["train", "model"], results["test", "model"])
    return model, E.comparison_table(trips.sparkSession, results, both=in_test.n > 0)


# --- The same descent with one aggregate per epoch ----------------------------------------


def gradient_sum(matrix: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Sum of (prediction - y)·x over the rows of a feature matrix, and the row count.

    One row; zeros for an empty matrix. Spark's partial aggregation is the weighted combination of
    the partial gradients.
    """
    sums = [f"coalesce(sum(e * {c}), 0D) as g{j}" for j, c in enumerate(X.X_COLUMNS)]
    return with_error(matrix, weights).agg(*[F.expr(e) for e in [*sums, "count(*) as n"]])


def with_error(matrix: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Feature matrix with ``e`` = prediction - y."""
    return matrix.selectExpr(*X.X_COLUMNS, f"{X.dot(X.X_COLUMNS, weights)} - y as e")


def mean_gradient(matrix: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Mean gradient as one row of nine columns."""
    means = [f"coalesce(try_divide(g{j}, n), 0D) as g{j}" for j in range(X.WEIGHT_COUNT)]
    return gradient_sum(matrix, weights).selectExpr(*means)


def mean_squared_error(matrix: DataFrame, weights: Sequence[float]) -> DataFrame:
    return with_error(matrix, weights).agg(F.expr("avg(e * e) as mse"))


def descend_by_pass(
    matrix: DataFrame, epochs: int, learning_rate: float
) -> tuple[list[float], list[float]]:
    """As :func:`descend`, reading the matrix once per epoch: the cross-check of the moments.

    The loss after an update is the loss the next pass sees, so a pass serves both. Persist the
    matrix when it is dear to compute.
    """
    weights = [0.0] * X.WEIGHT_COUNT
    losses: list[float] = []
    for epoch in range(epochs + 1):
        sums = [f"sum(e * {c})" for c in X.X_COLUMNS] + ["sum(e * e)", "count(*)"]
        row = with_error(matrix, weights).agg(*[F.expr(e) for e in sums]).head()
        *gradient, squared, n = row
        if n == 0:
            raise ValueError("no trips to train on")
        if epoch:
            losses.append(squared / n)
        if epoch < epochs:
            weights = [w - learning_rate * g / n for w, g in zip(weights, gradient)]
    return weights, losses


# --- Loss curve --------------------------------------------------------------------------


def loss_curve(models: DataFrame) -> DataFrame:
    """Stored loss history as rows (epoch from 1, mse)."""
    return models.select(F.posexplode("loss_history").alias("pos", "mse")).select(
        (F.col("pos") + 1).alias("epoch"), "mse"
    )


def divergence_flags(curve: DataFrame, *model_keys: str) -> DataFrame:
    """Loss curve with a flag where the loss passes ten times the one before.

    The window of each model holds one row per epoch.
    """
    window = W.partitionBy(*model_keys).orderBy("epoch")
    before = F.lag("mse").over(window)
    return curve.withColumn(
        "diverging", F.coalesce(F.col("mse") > before * 10, F.lit(False))
    )

