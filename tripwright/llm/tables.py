"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripwright.session import new_workspace


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as Parquet in the shared folder: lineage ends here and lost executors lose nothing."""
    path = new_workspace(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
