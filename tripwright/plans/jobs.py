"""Whole jobs: load report and exports, insight seeding, training with registration."""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripwright.operators import profile as PR
from tripwright.operators import rules, split, train
from tripwright.operators.model import LinearModel
from tripwright.plans import exports
from tripwright.plans.registry import Registry, utc_now
from tripwright.schemas import RAW_COLUMNS, RULES, Bounds
from tripwright.session import stored
from tripwright.sources import csv_lines


def timed_load_report(records: DataFrame, bounds: Bounds = Bounds()) -> dict[str, object]:
    """Load report with its wall time, rows per second and the parallelism it ran with."""
    started = time.monotonic()
    report = rules.load_report(rules.with_rule(records, bounds)).head().asDict()
    seconds = time.monotonic() - started
    return report | {
        "seconds": seconds,
        "rows_per_second": report["total"] / seconds,
        "workers": records.sparkSession.sparkContext.defaultParallelism,
    }


@dataclass(frozen=True)
class Loaded:
    """What a load leaves: valid trips and rejected records, stored, and the counts of the load report."""

    trips: DataFrame
    rejects: DataFrame
    report: dict[str, float]


def load(records: DataFrame, folder: str, *keep: str, bounds: Bounds = Bounds()) -> Loaded:
    """Trips, rejects and load report in one pass over the records.

    The records are written once, in a partition per rule; the counts are metrics observed by that
    same job. ``keep`` names columns that trips carry besides their own. Of lines equal to a CSV
    header one in each file is no record; how many files there are is read off the rejects.
    """
    spark = records.sparkSession
    ruled = rules.with_rule(records, bounds)
    text = "is_header" in ruled.columns
    places = [c for c in ("file_path", "file_block_start", "line_id") if c in ruled.columns] if text else []
    columns = dict.fromkeys([*keep, *RAW_COLUMNS, "duration_min", *places, *(["is_header"] if text else []), "rule"])
    header = "is_header" if text else "false"
    counts = Observation()
    observed = ruled.selectExpr(*columns).observe(
        counts,
        F.expr(f"count_if({header})").alias("headers"),
        *[F.expr(f"count_if(rule = {r} and not {header})").alias(f"r{r}") for r in (0, *RULES)],
    )
    observed.write.partitionBy("rule").parquet(folder)
    found = dict(counts.get)
    schema = observed.schema
    stored = spark.read.schema(schema).parquet(folder)
    if found["headers"]:
        files = stored.where("rule = 1 and is_header").selectExpr("file_path" if "file_path" in places else "1 as file_path")
        found["r1"] += found["headers"] - files.distinct().count()
    total = sum(found[f"r{r}"] for r in (0, *RULES))
    report = {"total": total, "valid": found["r0"], "retention_pct": found["r0"] / total * 100 if total else 0.0}
    report |= {f"r{r}": found[f"r{r}"] for r in RULES}
    return Loaded(rules.as_trips(stored.where("rule = 0"), *keep), rules.rejects(stored.where("rule > 0")), report)


def export_statistics(records: DataFrame, folder: str, bounds: Bounds = Bounds()) -> None:
    """Profile the valid records and write the six CSV reports."""
    with PR.profiled(rules.valid_trips(records, bounds=bounds)) as profile:
        exports.export_reports(profile, folder)


def seed_insights(
    records: DataFrame, registry: Registry, bounds: Bounds = Bounds()
) -> dict[str, Exception]:
    """Profile the valid records and store the six insights; failures by name."""
    with PR.profiled(rules.valid_trips(records, bounds=bounds)) as profile:
        return registry.upsert_insights(exports.insights(profile))


@dataclass(frozen=True)
class TrainRequest:
    dataset: str = ""
    epochs: int = 100
    learning_rate: float = 0.05
    batch_size: int = 1024
    fraction: float = split.DEFAULT_FRACTION
    limit: int = 0  # records to use, in the order of the keys; 0 for all

    def with_defaults(self) -> TrainRequest:
        """Values of 0 or less stand for the defaults."""
        return TrainRequest(
            dataset=self.dataset,
            epochs=self.epochs if self.epochs > 0 else 100,
            learning_rate=self.learning_rate if self.learning_rate > 0 else 0.05,
            batch_size=self.batch_size if self.batch_size > 0 else 1024,
            fraction=split.train_fraction(self.fraction),
            limit=max(self.limit, 0),
        )


def train_local(
    trips: DataFrame,
    key: Column,
    epochs: int = 10,
    learning_rate: float = 0.01,
    batch_size: int = 1024,
    workers: int = 1,
    seed: int = 42,
    fraction: float = split.DEFAULT_FRACTION,
) -> tuple[LinearModel, DataFrame]:
    """Fit on a seeded hash split; also returns the comparison with the baselines."""
    chosen = split.in_train_by_hash(key, seed, fraction)
    return train.fit(
        trips,
        chosen,
        epochs if epochs > 0 else 10,
        learning_rate if learning_rate > 0 else 0.01,
        batch_size if batch_size > 0 else 1024,
        max(workers, 1),
    )


def moments_of_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    folder: str,
    train_rows: Column,
    *keep: str,
    bounds: Bounds = Bounds(),
) -> tuple[train.Moments, train.Moments]:
    """Moments of all CSV files seen so far; only files not yet in ``folder`` are read.

    ``train_rows`` is a condition on trips and the ``keep`` columns. Files are known by their path: one
    that changes is not read again. A file without a valid trip leaves no sums and is read each time.
    """
    # The listing of the files is on the driver as it is.
    files = sorted(spark.read.text(paths).inputFiles())
    held = {_plain(r[0]) for r in train.stored_sources(spark, folder).collect()}
    new = [f for f in files if _plain(f) not in held]
    if new:
        records = csv_lines.read_trips_csv(spark, new)
        train.add_moments(rules.valid_trips(records, "file_path", *keep, bounds=bounds), train_rows, folder)
    return train.stored_moments(spark, folder)


def _plain(path: str) -> str:
    """A path in one spelling: listings and rows may differ in escapes and in the slashes of a local one."""
    return re.sub("^file:/+", "file:/", unquote(path))


def train_ordered(
    trips: DataFrame, order: Sequence[str], request: TrainRequest = TrainRequest(), nodes: int = 1
) -> LinearModel:
    """Fit on the first part of the trips in key order."""
    request = request.with_defaults()
    chosen = split.in_train_by_order(trips, order, request.fraction)
    model, _ = train.fit(
        trips, chosen, request.epochs, request.learning_rate, request.batch_size, nodes
    )
    return model


def train_and_register(
    records: DataFrame,
    order: Sequence[str],
    registry: Registry,
    request: TrainRequest = TrainRequest(),
    nodes: int = 1,
    bounds: Bounds = Bounds(),
) -> DataFrame:
    """Validate, train, store model and run under the next version, activate it; one summary row.

    The valid trips are written once, since finding the cut and fitting read them several times.
    A failed save fails the job, so no model becomes active that is not stored.
    """
    spark: SparkSession = records.sparkSession
    started, clock = utc_now(), time.monotonic()
    request = request.with_defaults()
    if request.limit:
        records = records.where(split.in_first(records, order, request.limit))
    with stored(rules.valid_trips(records, *order, bounds=bounds), "trips") as trips:
        rows_used = trips.count()
        model = train_ordered(trips, order, request, nodes)
    duration_ms = int((time.monotonic() - clock) * 1000)
    version = registry.allocate_version()
    registry.save_model(model, version, nodes)
    registry.save_run(
        version=version,
        started_at=started,
        finished_at=utc_now(),
        duration_ms=duration_ms,
        nodes=nodes,
        loss_history=model.loss_history,
        dataset_file=request.dataset,
        rows_used=rows_used,
    )
    registry.activate(version)
    return spark.createDataFrame(
        [
            (
                version,
                nodes,
                duration_ms,
                model.train_mae,
                model.train_rmse,
                model.train_r2,
                model.test_mae,
                model.test_rmse,
                model.test_r2,
            )
        ],
        "version int, nodes int, duration_ms bigint, train_mae double, train_rmse double, "
        "train_r2 double, test_mae double, test_rmse double, test_r2 double",
    )
