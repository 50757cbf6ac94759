"""Model documents as indented JSON."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripwright.operators.model import LinearModel
from tripwright.schemas import MODEL


def save_model(spark: SparkSession, model: LinearModel, path: str) -> None:
    """Write one document as a folder with one part file."""
    document = F.to_json(F.struct(*MODEL.names), {"pretty": "true"})
    rows = model.to_frame(spark).select(document.alias("value"))
    rows.coalesce(1).write.mode("overwrite").text(path)


def load_model(spark: SparkSession, path: str) -> LinearModel:
    rows = spark.read.schema(MODEL).option("multiLine", True).json(path).head(1)
    if not rows:
        raise ValueError(f"no model document in {path}")
    return LinearModel.from_row(rows[0])
