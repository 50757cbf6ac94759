"""Models, training runs, predictions and insights as Parquet tables under one folder.

Versions are reserved by creating a marker file that must not exist yet, so trainings that run at
once take different numbers: of two that ask for one number the store lets one create it, the other
tries the next. An insight is written beside the one it replaces and counts once it is complete.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.operators.model import LinearModel
from tripwright.schemas import ACTIVATION, MODEL, MODEL_VERSION, PREDICTION, TRAINING_RUN


# A local file system checks and creates in two steps; stores of a cluster do it in one.
_CREATING = threading.Lock()


class NotFound(LookupError):
    """No such model, activation or insight."""


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, table: str, schema) -> DataFrame:
        """The table, empty where nothing was written yet."""
        try:
            return self.spark.read.schema(schema).parquet(self._path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    # --- models --------------------------------------------------------------------------

    def models(self) -> DataFrame:
        return self._read("models", MODEL_VERSION)

    def next_version(self) -> int:
        """Greatest version plus one, from 1. Versions are folder names: no data is read."""
        return self.models().agg(F.coalesce(F.max("version"), F.lit(0))).head()[0] + 1

    def allocate_version(self) -> int:
        """Reserve a version that nobody else has or gets, even if no model is ever saved under it."""
        files, folder = self._files(self._path("versions"))
        names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
        version = max([self.next_version(), *(int(n) + 1 for n in names if n.isdigit())])
        while True:
            marker = self.spark._jvm.org.apache.hadoop.fs.Path(folder, str(version))
            with _CREATING:
                if files.createNewFile(marker):
                    return version
            version += 1

    def _files(self, folder: str):
        """File system and path of a folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def save_model(self, model: LinearModel, version: int, nodes: int = 1) -> None:
        row = model.to_frame(self.spark).select(
            *MODEL.names,
            F.lit(nodes).alias("nodes"),
            F.lit(utc_now()).cast("timestamp").alias("created_at"),
        )
        row.coalesce(1).write.parquet(self._path(f"models/version={version}"))

    def latest_model(self) -> DataFrame:
        """The model document with the greatest version, one row."""
        latest = self.models().orderBy(F.desc("version")).limit(1)
        if latest.isEmpty():
            raise NotFound("no model")
        return latest

    # --- active model --------------------------------------------------------------------

    def activate(self, version: int) -> None:
        """Make a version the active one. Activations are appended; the newest counts."""
        row = self.spark.createDataFrame([(version, utc_now())], ACTIVATION)
        row.coalesce(1).write.mode("append").parquet(self._path("activations"))

    def active_model(self) -> DataFrame:
        """The model document activated last, one row."""
        newest = self._read("activations", ACTIVATION).orderBy(
            F.desc("activated_at"), F.desc("version")
        )
        rows = newest.limit(1).collect()
        if not rows:
            raise NotFound("no version has been activated yet")
        return self.models().where(F.col("version") == rows[0].version)

    def active(self) -> tuple[LinearModel, int]:
        row = self.active_model().head()
        return LinearModel.from_row(row), row.version

    # --- runs and predictions ------------------------------------------------------------

    def training_runs(self) -> DataFrame:
        return self._read("training_runs", TRAINING_RUN)

    def save_run(self, **run) -> None:
        row = self.spark.createDataFrame([[run[n] for n in TRAINING_RUN.names]], TRAINING_RUN)
        row.coalesce(1).write.mode("append").parquet(self._path("training_runs"))

    def predictions(self) -> DataFrame:
        return self._read("predictions", PREDICTION)

    def log_predictions(self, rows: DataFrame) -> None:
        rows.select(*PREDICTION.names).write.mode("append").parquet(self._path("predictions"))

    # --- insights ------------------------------------------------------------------------

    def upsert_insight(self, name: str, rows: DataFrame) -> None:
        """Store a result by name, replacing only that name.

        The new rows get a folder of their own. Readers take the newest one that Spark has marked as
        complete, so a write that fails half-way leaves the earlier rows as they are. Of the older
        folders the last complete one stays for those who are reading it.
        """
        files, folder = self._files(self._path(f"insights/{name}"))
        complete, every = self._insight_runs(name)
        run = max(every, default=0) + 1
        rows.write.parquet(self._path(f"insights/{name}/run={run}"))
        for old in set(every) - set(complete[-1:]):
            files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"run={old}"), True)

    def _insight_runs(self, name: str) -> tuple[list[int], list[int]]:
        """Complete runs and all runs of an insight, ascending."""
        files, folder = self._files(self._path(f"insights/{name}"))
        if not files.exists(folder):
            return [], []
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        every = sorted(int(n[4:]) for n in names if n.startswith("run="))
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return [r for r in every if files.exists(done(folder, f"run={r}/_SUCCESS"))], every

    def upsert_insights(self, insights: Mapping[str, DataFrame]) -> dict[str, Exception]:
        """Store several; a failure is returned by name and does not keep the others from it."""
        failed = {}
        for name, rows in insights.items():
            try:
                self.upsert_insight(name, rows)
            except Exception as error:  # noqa: BLE001 - reported to the caller, by name
                failed[name] = error
        return failed

    def insight(self, name: str) -> DataFrame:
        complete, _ = self._insight_runs(name)
        if not complete:
            raise NotFound(f"nothing is stored under the name {name}")
        return self.spark.read.parquet(self._path(f"insights/{name}/run={complete[-1]}"))


def utc_now() -> datetime:
    return datetime.now(timezone.utc)
