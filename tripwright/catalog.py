"""Every operator as a query over a folder of tables: ``QUERIES[name](spark, folder)``.

Trips come from the folder's ``lineitem`` (see ``sources.lineitem_trips``), latency samples from
its ``events``. Doubles are rounded in both engines, since sums depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright import oracle
from tripwright.functions import features as X
from tripwright.functions import text
from tripwright.operators import evaluate, latency, profile, rules, score, split, train
from tripwright.operators.model import LinearModel
from tripwright.plans import exports, jobs
from tripwright.plans.registry import Registry
from tripwright.schemas import FEATURE_NAMES
from tripwright.session import configure, new_workspace
from tripwright.sources import csv_lines, lineitem_trips, model_json
from tripwright.sources.lineitem_trips import KEYS
from tripwright.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EPOCHS, RATE = 10, 0.05
ORDER = ["pickup_ts", *KEYS]
FIXED = oracle.FIXED_MODEL


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(configure(spark), folder)

    QUERIES[function.__name__] = run
    return function


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in oracle.queries().items() if name in QUERIES}


def rounded(sql: str, digits: int = 6, name: str | None = None) -> str:
    """Rounding made of IEEE operations only, so two engines agree on it."""
    return f"floor(({sql}) * 1e{digits}D + 0.5D) / 1e{digits}D as {name or sql}"


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return lineitem_trips.read_records(spark, folder)


def _ruled(spark: SparkSession, folder: str) -> DataFrame:
    return rules.with_rule(_records(spark, folder))


def _trips(spark: SparkSession, folder: str) -> DataFrame:
    return rules.valid_trips(_records(spark, folder), *KEYS)


def _in_train() -> Column:
    return split.in_train_by_hash(lineitem_trips.trip_id())


def _fixed_model() -> LinearModel:
    return LinearModel(**FIXED)


def _fit(spark: SparkSession, folder: str, epochs: int = EPOCHS) -> LinearModel:
    return train.fit(_trips(spark, folder), _in_train(), epochs, RATE)[0]


# --- validation ---------------------------------------------------------------------------


@query
def rule_counts(spark, folder):
    return rules.rule_counts(_ruled(spark, folder))


@query
def rule_detail(spark, folder):
    return _ruled(spark, folder).select(*KEYS, "pickup_ts", "trip_distance", "duration_min", "rule")


@query
def rejects(spark, folder):
    return rules.rejects(_ruled(spark, folder)).select(*KEYS, "dropoff_ts", "rule")


@query
def load_report(spark, folder):
    report = rules.load_report(_ruled(spark, folder))
    return report.selectExpr("total", "valid", rounded("retention_pct"), "* except (total, valid, retention_pct)")


@query
def load_one_pass(spark, folder):
    """Counts observed while trips and rejects are written, beside what was written."""
    loaded = jobs.load(_records(spark, folder), new_workspace(spark, "load"), *KEYS)
    counted = [(r, loaded.report["valid" if r == 0 else f"r{r}"]) for r in range(10)]
    stored = loaded.trips.selectExpr("0 as rule", "duration_min as minutes").unionByName(
        loaded.rejects.selectExpr("rule", "cast(null as double) as minutes")
    )
    stored = stored.groupBy("rule").agg(F.count("*").alias("n"), F.sum("minutes").alias("minutes"))
    rows = spark.createDataFrame(counted, "rule int, counted bigint").join(stored, "rule", "left")
    return rows.selectExpr("rule", "counted", "coalesce(n, 0) as stored", rounded("minutes", 4))


@query
def valid_trips(spark, folder):
    return _trips(spark, folder)


def _csv(spark: SparkSession, folder: str) -> str:
    path = new_workspace(spark, "csv")
    lineitem_trips.write_csv(_records(spark, folder), path)
    return path


@query
def csv_rule_counts(spark, folder):
    records = csv_lines.read_trips_csv(spark, _csv(spark, folder))
    return rules.rule_counts(rules.with_rule(records))


@query
def csv_trips(spark, folder):
    return rules.valid_trips(csv_lines.read_trips_csv(spark, _csv(spark, folder)))


@query
def first_n_valid(spark, folder):
    records = _records(spark, folder)
    half = split.in_first(records, ORDER, records.count() // 2)
    return rules.valid_trips(records.where(half), *KEYS).select(*KEYS, "pickup_ts", "duration_min")


# --- profiles -----------------------------------------------------------------------------


@query
def trips_by_hour(spark, folder):
    return profile.trips_by_hour(_trips(spark, folder))


@query
def trips_by_weekday(spark, folder):
    rows = profile.trips_by_weekday(_trips(spark, folder))
    return rows.selectExpr("day_of_week", f"{exports.P.weekday_name('day_of_week')} as name", "n")


@query
def duration_hist(spark, folder):
    return profile.duration_histogram(_trips(spark, folder))


@query
def duration_hist_dense(spark, folder):
    return profile.duration_histogram(_trips(spark, folder), dense=True)


@query
def distance_hist(spark, folder):
    return profile.distance_histogram(_trips(spark, folder))


@query
def distance_hist_dense(spark, folder):
    return profile.distance_histogram(_trips(spark, folder), dense=True)


@query
def speed_by_hour(spark, folder):
    return profile.speed_by_hour(_trips(spark, folder)).selectExpr(
        "hour_of_day", rounded("mean_mph")
    )


def _cells(spark, folder, grid):
    cells = profile.top_cells(profile.pickup_cells(_trips(spark, folder), grid))
    return cells.selectExpr(
        "lat_cell", "lon_cell", rounded("lat_centre"), rounded("lon_centre"), "n"
    )


@query
def top_pickup_cells(spark, folder):
    return _cells(spark, folder, "truncate")


@query
def top_pickup_cells_floor(spark, folder):
    return _cells(spark, folder, "floor")


@query
def profile_grouping_sets(spark, folder):
    return profile.profile_long(_trips(spark, folder))


@query
def report_files(spark, folder):
    """The six CSV reports, written, read back and listed line by line."""
    path = new_workspace(spark, "reports")
    jobs.export_statistics(_records(spark, folder), path)
    lines = [
        spark.read.text(f"{path}/{name}.csv").select(F.lit(name).alias("report"), "value")
        for name in exports.REPORTS
    ]
    out = lines[0]
    for more in lines[1:]:
        out = out.unionByName(more)
    return out


# --- features and splits ------------------------------------------------------------------


@query
def feature_matrix(spark, folder):
    raw = X.extract_raw(_trips(spark, folder), *KEYS, "duration_min as y")
    return raw.selectExpr(*KEYS, *[rounded(c) for c in [*FEATURE_NAMES, "y"]])


@query
def scaler_fit(spark, folder):
    fitted, _ = train.moments(_trips(spark, folder), _in_train())
    rows = list(zip(FEATURE_NAMES, fitted.means.tolist(), fitted.stds.tolist()))
    frame = spark.createDataFrame(rows, "feature string, mean double, std double")
    return frame.selectExpr("feature", rounded("mean"), rounded("std"))


def _matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Standardised features of all trips, scaled by the train split."""
    trips = _trips(spark, folder)
    fitted, _ = train.moments(trips, _in_train())
    return X.feature_matrix(trips, fitted.means[:8], fitted.stds, *KEYS)


def _train_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _matrix(spark, folder).where(_in_train())


@query
def scaled_features(spark, folder):
    return _matrix(spark, folder).selectExpr(*KEYS, *[rounded(c) for c in [*X.X_COLUMNS, "y"]])


@query
def hash_split_counts(spark, folder):
    return (
        _trips(spark, folder)
        .select(_in_train().alias("is_train"), "l_orderkey")
        .groupBy("is_train")
        .agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("sum_orderkey"))
    )


@query
def ordered_split_counts(spark, folder):
    trips = _trips(spark, folder)
    first = split.in_train_by_order(trips, ORDER)
    return (
        trips.select(first.alias("is_train"), "l_orderkey", "pickup_ts")
        .groupBy("is_train")
        .agg(
            F.count("*").alias("n"),
            F.sum("l_orderkey").alias("sum_orderkey"),
            F.min("pickup_ts").alias("first_pickup"),
            F.max("pickup_ts").alias("last_pickup"),
        )
    )


# --- training -----------------------------------------------------------------------------


@query
def gradient_at_theta(spark, folder):
    gradient = train.mean_gradient(_train_matrix(spark, folder), FIXED["weights"])
    return gradient.selectExpr(*[rounded(f"g{j}") for j in range(9)])


@query
def gradient_sum_at_theta(spark, folder):
    gradient = train.gradient_sum(_train_matrix(spark, folder), FIXED["weights"])
    return gradient.selectExpr("n", *[rounded(f"g{j}", 2) for j in range(9)])


@query
def mse_at_theta(spark, folder):
    error = train.mean_squared_error(_train_matrix(spark, folder), FIXED["weights"])
    return error.selectExpr(rounded("mse"))


@query
def gram_matrix(spark, folder):
    fitted, _ = train.moments(_trips(spark, folder), _in_train())
    rows = train.gram_matrix(spark, fitted)
    return rows.selectExpr("i", "j", rounded(f"value / {fitted.n}", 6, "mean_value"))


def _weight_rows(spark: SparkSession, weights) -> DataFrame:
    frame = spark.createDataFrame(list(enumerate(weights)), "j int, weight double")
    return frame.selectExpr("j", rounded("weight"))


@query
def fit_weights(spark, folder):
    return _weight_rows(spark, _fit(spark, folder).weights)


@query
def fit_stored_moments(spark, folder):
    """Some sources first, then all: those whose sums are held are not added again."""
    trips = _trips(spark, folder).withColumn("source", F.col("l_linenumber").cast("string"))
    store = new_workspace(spark, "moments")
    train.add_moments(trips.where("l_linenumber <= 3"), _in_train(), store, "source")
    train.add_moments(trips, _in_train(), store, "source")
    fitted, _ = train.stored_moments(spark, store)
    return _weight_rows(spark, train.descend(fitted, EPOCHS, RATE)[0])


@query
def fit_weights_by_pass(spark, folder):
    weights, _ = train.descend_by_pass(_train_matrix(spark, folder), 3, RATE)
    return _weight_rows(spark, weights)


@query
def loss_curve(spark, folder):
    curve = train.loss_curve(_fit(spark, folder).to_frame(spark))
    return curve.selectExpr("epoch", rounded("mse", 4))


@query
def divergence_flags(spark, folder):
    """A rate far too high: the loss explodes and the flags go up."""
    fitted, _ = train.moments(_trips(spark, folder), _in_train())
    _, losses = train.descend(fitted, 6, 6.0)
    curve = spark.createDataFrame(list(enumerate(losses, 1)), "epoch int, mse double")
    return train.divergence_flags(curve).select("epoch", "diverging")


@query
def loss_report_file(spark, folder):
    path = new_workspace(spark, "loss")
    report = exports.loss_report(_fit(spark, folder, 5).to_frame(spark))
    exports.write_report(report, path)
    written = spark.read.option("header", True).schema("epoca int, mse_train double").csv(path)
    return written.selectExpr("epoca", rounded("mse_train", 4))


# --- evaluation ---------------------------------------------------------------------------


@query
def eval_metrics(spark, folder):
    trips, chosen = _trips(spark, folder), _in_train()
    model = _fixed_model()
    labelled = trips.withColumn("is_train", chosen)
    found = evaluate.metrics(labelled, model.prediction(), "is_train")
    return found.selectExpr("is_train", rounded("mae"), rounded("rmse"), rounded("r2"))


def _baselines(spark, folder):
    trips, chosen = _trips(spark, folder), _in_train()
    return evaluate.baseline_metrics(trips.where(chosen), trips.where(~chosen))


@query
def baseline_mean(spark, folder):
    found = _baselines(spark, folder)[0]
    return found.selectExpr(rounded("mae"), rounded("rmse"), rounded("r2"))


@query
def baseline_speed(spark, folder):
    found = _baselines(spark, folder)[1]
    return found.selectExpr(rounded("mae"), rounded("rmse"), rounded("r2"))


@query
def comparison_table(spark, folder):
    return train.fit(_trips(spark, folder), _in_train(), EPOCHS, RATE)[1]


# --- scoring ------------------------------------------------------------------------------


def _text_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests as text, as they come off the wire: absent, blank and junk values included."""
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    records = lineitem_trips.trips_from_lineitem(lineitem)
    return records.selectExpr(
        *KEYS,
        "case when l_linenumber = 7 then '' else cast(trip_distance / 8D as string) end"
        " as trip_distance",
        "cast(hour(pickup_ts) as string) as hour",
        "case when l_linenumber = 6 then 'x' else cast(dayofweek(pickup_ts) - 1 as string) end"
        " as day_of_week",
        "cast(pickup_latitude as string) as pickup_lat",
        "cast(pickup_longitude / 16D as string) as pickup_lon",
        "cast(rate_code_id as string) as rate_code",
        "cast(passenger_count as string) as passenger_count",
    )


@query
def predict_trips(spark, folder):
    trips = _trips(spark, folder)
    return trips.selectExpr(*KEYS, rounded(_fixed_model().prediction(), 6, "prediction"))


@query
def dot_product(spark, folder):
    """The same predictions by array columns."""
    model = _fixed_model()
    inputs = X.standardised(model.means, model.stds)
    vectors = _trips(spark, folder).selectExpr(
        *KEYS,
        f"array({', '.join(inputs)}) as x",
        f"array({', '.join(X.literal(w) for w in model.weights)}) as w",
    )
    dots = vectors.select(*KEYS, X.dot_arrays(F.col("x"), F.col("w")).alias("prediction"))
    return dots.selectExpr(*KEYS, rounded("prediction"))


@query
def score_requests(spark, folder):
    keyed = score.with_cache_key(score.score(_text_requests(spark, folder), _fixed_model(), 1))
    return keyed.selectExpr(
        *KEYS, "error", "passenger_count", "cache_key", rounded("duration_min"), "model_version"
    )


def _coarse_requests(lineitem: DataFrame) -> DataFrame:
    """Typed requests of few distinct keys, with differences too small to show in the key."""
    return lineitem.selectExpr(
        "l_orderkey * 8 + l_linenumber as request_id",
        "cast(l_partkey % 40 as double)"
        " + cast((l_orderkey + l_linenumber) % 400 as double) / 1e6D as trip_distance",
        "cast(l_linenumber as bigint) as hour",
        "l_partkey % 7 as day_of_week",
        "cast(405 + l_partkey % 5 as double) / 10D as pickup_lat",
        "-cast(737 + l_partkey % 4 as double) / 10D as pickup_lon",
        "l_partkey % 4 as rate_code",
        "l_partkey % 3 as passenger_count",
    )


def _answers(answers: DataFrame) -> DataFrame:
    return answers.selectExpr(
        "request_id", "cache_key", rounded("duration_min"), "model_version", "cached"
    )


@query
def score_memo(spark, folder):
    requests = _coarse_requests(spark.read.parquet(f"{folder}/lineitem.parquet"))
    return _answers(score.score_with_memo(requests, _fixed_model(), 3, "request_id"))


def _dirty_csv(spark: SparkSession, folder: str) -> str:
    """Damaged lines in two layouts, in one folder."""
    path = new_workspace(spark, "dirty-csv")
    records = _records(spark, folder)
    for odd in (False, True):
        part = records.where((F.col("l_linenumber") % 2 == 1) == F.lit(odd))
        lineitem_trips.write_dirty_csv(part, path, swapped=odd)
    return path


def _dirty(spark: SparkSession, folder: str) -> DataFrame:
    return rules.with_rule(csv_lines.read_trips_csv(spark, _dirty_csv(spark, folder)))


@query
def csv_dirty_rule_counts(spark, folder):
    return rules.rule_counts(_dirty(spark, folder))


@query
def csv_dirty_trips(spark, folder):
    """What is valid in damaged text of two layouts, each column from its own place."""
    valid = _dirty(spark, folder).where("rule = 0")
    return valid.groupBy("rate_code_id").agg(
        F.count("*").alias("n"), F.expr(rounded("sum(trip_distance)", 6, "miles"))
    )


@query
def score_by_time(spark, folder):
    """Entries answer for five minutes from the arrival that computed them."""
    requests = _coarse_requests(spark.read.parquet(f"{folder}/lineitem.parquet")).withColumn(
        "arrived_at", F.timestamp_seconds(F.expr("request_id div 20"))
    )
    answers, _ = score.score_by_time(requests, _fixed_model(), 3, "request_id", "arrived_at")
    return _answers(answers)


@query
def csv_first_n(spark, folder):
    """The first half of the lines of CSV files: those of whole files and a part of one."""
    path = _csv(spark, folder)
    lines = csv_lines.read_trips_csv(spark, path).where("not is_header").count()
    first = csv_lines.first_lines(spark, path, lines // 2).where("not is_header")
    return first.agg(F.count("*").alias("n"))


@query
def prediction_log(spark, folder):
    """Model answers stored in the prediction table; memo hits are not."""
    registry = Registry(spark, new_workspace(spark, "registry"))
    requests = _coarse_requests(spark.read.parquet(f"{folder}/lineitem.parquet"))
    answers = score.score_with_memo(requests, _fixed_model(), 3, "request_id")
    registry.log_predictions(score.prediction_log(answers, F.current_timestamp()))
    return registry.predictions().selectExpr(
        rounded("input.trip_distance", 6, "trip_distance"),
        "input.hour",
        "input.passenger_count",
        rounded("duration_min"),
        "model_version",
    )


# --- registry -----------------------------------------------------------------------------


def _registered(spark: SparkSession, folder: str) -> Registry:
    """Two stored models, fitted with 2 and 5 epochs; the first was activated last."""
    registry = Registry(spark, new_workspace(spark, "registry"))
    trips = _trips(spark, folder)
    fitted, _ = train.moments(trips, _in_train())
    for epochs in (2, 5):
        weights, losses = train.descend(fitted, epochs, RATE)
        model = LinearModel(
            weights=weights,
            means=fitted.means[:8].tolist(),
            stds=fitted.stds.tolist(),
            epochs=epochs,
            learning_rate=RATE,
            loss_history=losses,
        )
        version = registry.next_version()
        registry.save_model(model, version, nodes=3)
        registry.activate(version)
    registry.activate(1)
    return registry


def _model_rows(models: DataFrame) -> DataFrame:
    rows = models.select("version", "epochs", "nodes", F.posexplode("weights").alias("j", "weight"))
    return rows.selectExpr("version", "epochs", "nodes", "j", rounded("weight"))


@query
def latest_model(spark, folder):
    return _model_rows(_registered(spark, folder).latest_model())


@query
def active_model(spark, folder):
    return _model_rows(_registered(spark, folder).active_model())


@query
def next_version(spark, folder):
    registry = _registered(spark, folder)
    rows = registry.models().groupBy().agg(F.count("*").alias("stored"))
    return rows.select("stored", F.lit(registry.next_version()).alias("next_version"))


@query
def concurrent_versions(spark, folder):
    """A training for each line number, all at once: as many versions as line numbers, without gaps."""
    registry = Registry(spark, new_workspace(spark, "registry"))
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_linenumber").distinct()
    numbers = [r[0] for r in lines.collect()]  # seven at most

    def register(number: int) -> None:
        version = registry.allocate_version()
        registry.save_model(LinearModel([0.0] * 8 + [float(number)], [0.0] * 8, [1.0] * 8), version)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(register, numbers))
    stored = registry.models().select("version", F.element_at("weights", -1).cast("bigint").alias("line"))
    return stored.agg(
        F.count("*").alias("stored"), F.min("version").cast("bigint").alias("first"),
        F.max("version").cast("bigint").alias("last"), F.sum("line").alias("lines"),
    )


@query
def model_json_round_trip(spark, folder):
    path = new_workspace(spark, "model-json")
    model_json.save_model(spark, _fit(spark, folder), path)
    return _weight_rows(spark, model_json.load_model(spark, path).weights)


@query
def insight_upsert(spark, folder):
    """All insights stored twice under one name each, then read back by name."""
    registry = Registry(spark, new_workspace(spark, "registry"))
    for _ in range(2):
        failed = jobs.seed_insights(_records(spark, folder), registry)
        if failed:
            raise next(iter(failed.values()))
    tall = None
    for name in exports.INSIGHTS:
        rows = registry.insight(name)
        keys = [f"cast({c} as double)" for c in rows.columns[:-1]]
        keys += ["cast(null as double)"] * (2 - len(keys))
        value = rounded(f"cast({rows.columns[-1]} as double)", 6, "value")
        part = rows.selectExpr(f"'{name}' as name", f"{keys[0]} as k1", f"{keys[1]} as k2", value)
        tall = part if tall is None else tall.unionByName(part)
    return tall


@query
def train_and_register(spark, folder):
    registry = Registry(spark, new_workspace(spark, "registry"))
    request = jobs.TrainRequest(dataset="lineitem", epochs=EPOCHS, learning_rate=RATE)
    summary = jobs.train_and_register(_records(spark, folder), ORDER, registry, request, nodes=3)
    runs = registry.training_runs().select("version", "dataset_file", "rows_used")
    measured = [f"{part}_{m}" for part in ("train", "test") for m in ("mae", "rmse", "r2")]
    return summary.join(runs, "version").selectExpr(
        "version", "nodes", "dataset_file", "rows_used", *[rounded(m, 5) for m in measured]
    )


# --- latency ------------------------------------------------------------------------------


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _newest(spark: SparkSession, folder: str) -> DataFrame:
    return latency.newest_per_key(_events(spark, folder), "event_type", "ts", "event_id")


@query
def latest_200(spark, folder):
    return _newest(spark, folder).select("event_type", "event_id", "ts", "value")


@query
def latency_p50_p95(spark, folder):
    return latency.p50_p95(_newest(spark, folder), "event_type", "value")


@query
def latency_summary(spark, folder):
    summary = latency.latency_summary(_events(spark, folder), "event_type", "value")
    return summary.selectExpr(
        "event_type", "n", "min", rounded("avg"), "p50", "p95", "max", "passed"
    )


# --- streams ------------------------------------------------------------------------------


def _lineitem_stream(spark: SparkSession, folder: str) -> DataFrame:
    return streams.read_parquet_stream(spark, f"{folder}/lineitem.parquet")


@query
def stream_profile(spark, folder):
    work = new_workspace(spark, "stream")
    trips = rules.valid_trips(lineitem_trips.trips_from_lineitem(_lineitem_stream(spark, folder)))

    streams.run_to_end(
        streams.profile_stream(trips, profile.profile, f"{work}/out", f"{work}/check")
    )
    found = profile.Profile(spark.read.parquet(f"{work}/out"))
    parts = [
        found.trips_by_hour().selectExpr("'hour' as metric", "hour_of_day as k1", "null as k2", "n"),
        found.trips_by_weekday().selectExpr("'weekday'", "day_of_week", "null", "n"),
        found.duration_histogram(dense=True).selectExpr("'duration'", "bin_start", "null", "n"),
        found.distance_histogram(dense=True).selectExpr("'distance'", "bin_start", "null", "n"),
        found.speed_by_hour().selectExpr("'speed'", "hour_of_day", "null", rounded("mean_mph", 6, "n")),
        found.top_cells().selectExpr("'cell'", "lat_cell", "lon_cell", "n"),
    ]
    tall = [p.toDF("metric", "k1", "k2", "n").selectExpr(
        "metric", "cast(k1 as double) as k1", "cast(k2 as double) as k2", "cast(n as double) as value"
    ) for p in parts]
    out = tall[0]
    for more in tall[1:]:
        out = out.unionByName(more)
    return out


@query
def stream_csv_rule_counts(spark, folder):
    """Damaged text of two layouts, three files a batch, each file by its own header."""
    work = new_workspace(spark, "stream")
    lines = streams.read_csv_stream(spark, _dirty_csv(spark, folder), 3)
    streams.run_to_end(streams.csv_rule_stream(lines, f"{work}/out", f"{work}/check"))
    counts = spark.read.parquet(f"{work}/out").where("rule > 0")
    every = spark.range(1, 10).selectExpr("cast(id as int) as rule", "0L as n")
    return every.unionByName(counts.select("rule", "n")).groupBy("rule").agg(F.sum("n").alias("n"))


@query
def stream_score(spark, folder):
    work = new_workspace(spark, "stream")
    requests = _coarse_requests(_lineitem_stream(spark, folder))
    streams.run_to_end(
        streams.score_stream(requests, _fixed_model(), 3, f"{work}/out", f"{work}/check")
    )
    return spark.read.parquet(f"{work}/out").selectExpr(
        rounded("input.trip_distance", 6, "trip_distance"),
        "input.hour",
        rounded("duration_min"),
        "model_version",
    )


@query
def stream_memo(spark, folder):
    work = new_workspace(spark, "stream")
    requests = _coarse_requests(_lineitem_stream(spark, folder)).withColumn(
        "arrived_at", F.timestamp_seconds(F.expr("request_id div 20"))
    )
    streams.run_to_end(
        streams.memo_stream(
            requests, _fixed_model(), 3, "request_id", "arrived_at", work, f"{work}/check"
        )
    )
    return _answers(spark.read.parquet(f"{work}/answers"))


@query
def stream_latency(spark, folder):
    work = new_workspace(spark, "stream")
    samples = streams.read_parquet_stream(spark, f"{folder}/events.parquet")
    streams.run_to_end(
        streams.latency_stream(
            samples, "event_type", "value", ["ts", "event_id"], f"{work}/out", f"{work}/check"
        )
    )
    newest = streams.last_state(spark, f"{work}/out")
    return latency.p50_p95(newest, "event_type", "value")


# --- text helpers -------------------------------------------------------------------------


@query
def fixed_decimals(spark, folder):
    """Correctly rounded fixed-point text of arbitrary doubles."""
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    values = lineitem.selectExpr(
        *KEYS,
        "l_extendedprice",
        "(l_extendedprice - 50000D) * l_discount / 64D as a",
        "l_extendedprice / 16D as b",
    )
    texts = {"d3": ("a", 3), "d4": ("a", 4), "d2": ("b", 2)}
    return text.with_fixed_decimals(values, texts).drop("a", "b")
