"""Headline timings: one JSON line. Folder ``$BENCH_SF_DIR``, cores ``$BENCH_CPUS``."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import functions as F

from tripwright import catalog
from tripwright.operators import profile, rules, score, split, train
from tripwright.plans import jobs
from tripwright.plans.registry import Registry
from tripwright.session import local_session, new_workspace
from tripwright.sources import csv_lines, lineitem_trips
from tripwright.sources.lineitem_trips import KEYS, trip_id

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(run: Callable[[], object]) -> float:
    """Median of some runs after one to warm up."""
    run()
    seconds = []
    for _ in range(RUNS):
        started = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - started)
    return sorted(seconds)[len(seconds) // 2]


def main() -> None:
    spark = local_session("bench", CPUS)
    # Small row groups and files would leave cores idle: derive the records once, in CPUS files.
    stored = new_workspace(spark, "bench-records")
    source = lineitem_trips.read_records(spark, FOLDER).repartition(int(CPUS))
    source.write.parquet(stored)
    csv = new_workspace(spark, "bench-csv")
    lineitem_trips.write_csv(spark.read.parquet(stored), csv)
    rows = spark.read.parquet(stored).count()
    model = catalog._fixed_model()

    def records():
        return spark.read.parquet(stored)

    def trips():
        return rules.valid_trips(records(), *KEYS)

    def six_passes():
        valid = trips()
        for result in (
            profile.trips_by_hour(valid),
            profile.trips_by_weekday(valid),
            profile.duration_histogram(valid),
            profile.distance_histogram(valid),
            profile.speed_by_hour(valid),
            profile.top_cells(profile.pickup_cells(valid)),
        ):
            result.collect()

    def one_pass():
        with profile.profiled(trips()) as p:
            for result in (
                p.trips_by_hour(),
                p.trips_by_weekday(),
                p.duration_histogram(),
                p.distance_histogram(),
                p.speed_by_hour(),
                p.top_cells(),
            ):
                result.collect()

    def fit(epochs: int):
        return lambda: train.fit(trips(), split.in_train_by_hash(trip_id()), epochs, 0.01)

    def fit_by_pass(epochs: int):
        def run():
            chosen = split.in_train_by_hash(trip_id())
            fitted, _ = train.moments(trips(), chosen)
            matrix = catalog.X.feature_matrix(
                trips().where(chosen), fitted.means[:8], fitted.stds
            ).persist()
            train.descend_by_pass(matrix, epochs, 0.01)
            matrix.unpersist()

        return run

    def noop(frame):
        frame.write.format("noop").mode("overwrite").save()

    def requests():
        return score.requests_from_trips(trips())

    def skewed():
        """Half of the requests ask the same."""
        numbered = requests().withColumn("id", F.monotonically_increasing_id())
        same = F.pmod(F.col("id"), F.lit(2)) == 0
        names = [c for c in numbered.columns if c != "id"]
        return numbered.withColumns({c: F.when(same, F.lit(1)).otherwise(F.col(c)) for c in names})

    queries = {
        "validate": lambda: rules.load_report(rules.with_rule(records())).collect(),
        "validate_csv": lambda: rules.load_report(
            rules.with_rule(csv_lines.read_trips_csv(spark, csv))
        ).collect(),
        "trips_by_hour": lambda: profile.trips_by_hour(trips()).collect(),
        "profile_six_passes": six_passes,
        "profile_one_pass": one_pass,
        "fit_moments_10": fit(10),
        "fit_moments_100": fit(100),
        "fit_by_pass_3": fit_by_pass(3),
        "ordered_cut": lambda: split.in_first(records(), ["pickup_ts", *KEYS], rows * 4 // 5),
        "score": lambda: noop(score.score(requests(), model, 1)),
        "score_memo": lambda: noop(
            score.score_with_memo(
                requests().withColumn("id", F.monotonically_increasing_id()), model, 1, "id"
            )
        ),
        "score_memo_one_key_half": lambda: noop(
            score.score_with_memo(skewed(), model, 1, "id")
        ),
        "csv_first_half": lambda: csv_lines.first_lines(spark, csv, rows // 2).count(),
        "train_and_register": lambda: jobs.train_and_register(
            records(), ["pickup_ts", *KEYS], Registry(spark, new_workspace(spark, "bench-registry"))
        ).collect(),
        "latency_summary": lambda: catalog.QUERIES["latency_summary"](spark, FOLDER).collect(),
        "adapter_rule_counts": lambda: catalog.QUERIES["rule_counts"](spark, FOLDER).collect(),
        "latency_p50_p95": lambda: catalog.QUERIES["latency_p50_p95"](spark, FOLDER).collect(),
    }
    seconds = {name: round(timed(run), 4) for name, run in queries.items()}
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "rows": rows,
        "rows_per_second": {
            name: round(rows / seconds[name])
            for name in ("validate", "validate_csv", "profile_one_pass", "fit_moments_100", "score")
        },
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
