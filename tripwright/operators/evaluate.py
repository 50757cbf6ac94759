"""Error metrics of the model and of two baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions import trip as P
from tripwright.functions.features import literal
from tripwright.operators.model import LinearModel, Metrics

# --- Fixed values: row labels of the comparison table --------------------------------------
MODEL_LABELS = {
    "model": "Regresión Lineal",
    "mean": "Baseline: media",
    "speed": "Baseline: vel. media",
}
# --- end of fixed values -------------------------------------------------------------------


def metric_aggregates(error: str, actual: str = "duration_min") -> dict[str, str]:
    """SQL aggregates MAE, RMSE and R²; zeros for no rows, R² zero for a constant target."""
    spread = f"count(*) * var_pop({actual})"
    r2 = f"case when {spread} > 0 then 1 - sum({error} * {error}) / ({spread}) end"
    return {
        "mae": f"coalesce(avg(abs({error})), 0D)",
        "rmse": f"coalesce(sqrt(avg({error} * {error})), 0D)",
        "r2": f"coalesce({r2}, 0D)",
    }


def metrics(trips: DataFrame, prediction: str = "prediction", *by: str) -> DataFrame:
    """``mae``, ``rmse`` and ``r2`` of a prediction (SQL over the columns) of ``duration_min``."""
    rows = trips.selectExpr(*by, f"{prediction} - duration_min as e", "duration_min")
    aggregates = [F.expr(sql).alias(name) for name, sql in metric_aggregates("e").items()]
    return rows.groupBy(*by).agg(*aggregates)


def baseline_inputs(train: DataFrame) -> tuple[float, float] | None:
    """Mean minutes and mean of per-trip speeds of a train set; None if it is empty."""
    row = train.selectExpr("avg(duration_min) as minutes", f"avg({P.MOVING_MPH}) as mph").head()
    return None if row.minutes is None else (row.minutes, row.mph or 0.0)


def speed_prediction(mean_mph: float) -> str:
    """Minutes at the mean speed; 0 where there is no speed."""
    return f"trip_distance / {literal(mean_mph)} * 60D" if mean_mph > 0 else "0D"


def baseline_metrics(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metrics on ``test`` of the train mean and of the train mean speed.

    Zeros for both if either set is empty.
    """
    inputs = baseline_inputs(train)
    if inputs is None:
        test, inputs = test.where("false"), (0.0, 0.0)
    minutes, mph = inputs
    return metrics(test, literal(minutes)), metrics(test, speed_prediction(mph))


def evaluate_splits(
    trips: DataFrame, train: Column, model: LinearModel, mean_minutes: float, mean_mph: float
) -> dict[tuple[str, str], Metrics]:
    """Metrics by (split, model) of the model and both baselines, in one pass over the trips."""
    guesses = {
        "model": model.prediction(),
        "mean": literal(mean_minutes),
        "speed": speed_prediction(mean_mph),
    }
    errors = [f"{guess} - duration_min as e_{name}" for name, guess in guesses.items()]
    rows = trips.withColumn("is_train", train).selectExpr("is_train", "duration_min", *errors)
    aggregates = [
        F.expr(f"{sql} as {name}_{metric}")
        for name in guesses
        for metric, sql in metric_aggregates(f"e_{name}").items()
    ]
    found = {r.is_train: r for r in rows.groupBy("is_train").agg(*aggregates).collect()}
    return {
        (split, name): Metrics(*(found[side][f"{name}_{m}"] for m in ("mae", "rmse", "r2")))
        if side in found
        else Metrics()
        for split, side in (("train", True), ("test", False))
        for name in guesses
    }


def comparison_table(
    spark: SparkSession, results: dict[tuple[str, str], Metrics], both: bool = True
) -> DataFrame:
    """Model and baselines on the test split: 2 decimals, R² with 4.

    Baselines are zeros when a split is empty.
    """
    rows = []
    for name, label in MODEL_LABELS.items():
        m = results["test", name] if both else Metrics()
        rows.append((label, m.mae, m.rmse, m.r2))
    table = spark.createDataFrame(rows, "model string, mae double, rmse double, r2 double")
    return table.select(
        "model",
        F.round("mae", 2).alias("mae"),
        F.round("rmse", 2).alias("rmse"),
        F.round("r2", 4).alias("r2"),
    )
