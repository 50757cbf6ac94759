"""The linear duration model: nine weights and the scaling of its eight inputs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import DataFrame, Row, SparkSession

from tripwright.functions import features as X
from tripwright.schemas import BIAS_NAME, FEATURE_NAMES, MODEL


@dataclass(frozen=True)
class Metrics:
    mae: float = 0.0
    rmse: float = 0.0
    r2: float = 0.0


@dataclass
class LinearModel:
    weights: list[float]
    means: list[float]
    stds: list[float]
    feature_names: list[str] = field(default_factory=lambda: [*FEATURE_NAMES, BIAS_NAME])
    epochs: int = 0
    learning_rate: float = 0.0
    batch_size: int = 0
    workers: int = 1
    loss_history: list[float] = field(default_factory=list)
    train_mae: float = 0.0
    train_rmse: float = 0.0
    train_r2: float = 0.0
    test_mae: float = 0.0
    test_rmse: float = 0.0
    test_r2: float = 0.0

    def prediction(self, features: Sequence[str] | None = None) -> str:
        """SQL expression for the predicted minutes of a trip row; not clamped.

        ``features`` stands for the raw features of a trip where columns have other names.
        """
        return X.dot(X.standardised(self.means, self.stds, features), self.weights)

    def predict_standardised(self, columns: Sequence[str]) -> str:
        """SQL expression for the prediction from nine standardised inputs, bias last."""
        return X.dot(columns, self.weights)

    def set_metrics(self, train: Metrics, test: Metrics) -> None:
        self.train_mae, self.train_rmse, self.train_r2 = train.mae, train.rmse, train.r2
        self.test_mae, self.test_rmse, self.test_r2 = test.mae, test.rmse, test.r2

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row in the model document schema."""
        row = asdict(self)
        return spark.createDataFrame([[row[name] for name in MODEL.names]], MODEL)

    @classmethod
    def from_row(cls, row: Row) -> LinearModel:
        """Model from a stored document; scaling arrays are cut or zero-filled to eight values."""
        stored = row.asDict(recursive=True)
        values = {f.name: stored[f.name] for f in fields(cls) if stored.get(f.name) is not None}
        for name in ("means", "stds"):
            known = list(values.get(name, []))[: len(FEATURE_NAMES)]
            values[name] = known + [0.0] * (len(FEATURE_NAMES) - len(known))
        return cls(**values)
