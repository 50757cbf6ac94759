from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pytest
from fixtures import trips_frame, varied_trips, write_lines, line
from pyspark.sql import functions as F

from tripwright.operators import profile, score
from tripwright.operators.model import LinearModel
from tripwright.plans import exports, jobs
from tripwright.plans.registry import NotFound, Registry
from tripwright.sources import csv_lines
from tripwright.sources.lineitem_trips import read_records


def model(bias):
    return LinearModel([0.0] * 8 + [bias], [0.0] * 8, [1.0] * 8, loss_history=[3.0, 2.0])


def test_versions_and_activation(spark, folder):
    registry = Registry(spark, folder)
    assert registry.next_version() == 1
    for missing in (registry.latest_model, registry.active_model):
        with pytest.raises(NotFound):
            missing()
    for bias in (1.0, 2.0):
        version = registry.next_version()
        registry.save_model(model(bias), version, nodes=2)
        registry.activate(version)
    assert registry.next_version() == 3
    assert registry.latest_model().head().version == 2
    registry.activate(1)
    active, version = registry.active()
    assert version == 1 and active == model(1.0)
    row = registry.active_model().head()
    assert row.nodes == 2 and row.feature_names[-1] == "bias" and row.created_at is not None
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        registry.save_model(model(9.0), 2)
    assert registry.models().count() == 2


def test_runs_and_predictions_are_appended(spark, folder):
    registry = Registry(spark, folder)
    at = datetime(2015, 1, 1, tzinfo=timezone.utc)
    for version in (1, 2):
        registry.save_run(
            version=version, started_at=at, finished_at=at, duration_ms=5, nodes=1,
            loss_history=[1.0], dataset_file="x", rows_used=3,
        )
    assert registry.training_runs().count() == 2
    requests = score.requests_from_trips(trips_frame(spark, varied_trips(5)))
    for _ in range(2):
        rows = score.prediction_log(score.score(requests, model(4.0), 3), F.current_timestamp())
        registry.log_predictions(rows)
    logged = registry.predictions()
    assert logged.count() == 10
    assert {(r.duration_min, r.model_version) for r in logged.collect()} == {(4.0, 3)}


def test_insights_are_replaced_by_name(spark, folder):
    registry = Registry(spark, folder)
    registry.upsert_insight("a", spark.range(3))
    registry.upsert_insight("b", spark.range(4))
    registry.upsert_insight("a", spark.range(5))
    assert (registry.insight("a").count(), registry.insight("b").count()) == (5, 4)
    with pytest.raises(NotFound, match="nope"):
        registry.insight("nope")
    broken = spark.range(1).selectExpr("assert_true(id > 5) as x")
    failed = registry.upsert_insights({"broken": broken, "c": spark.range(2)})
    assert list(failed) == ["broken"] and registry.insight("c").count() == 2


def test_seeded_insights(spark, folder):
    registry = Registry(spark, folder)
    path = write_lines(f"{folder}/trips.csv", [line()] * 20)
    assert jobs.seed_insights(csv_lines.read_trips_csv(spark, path), registry) == {}
    assert {name: registry.insight(name).count() for name in exports.INSIGHTS} == {
        "trips_por_hora": 24,
        "trips_por_dia_semana": 7,
        "histograma_duracion": 91,
        "histograma_distancia": 101,
        "velocidad_media_por_hora": 24,
        "top_celdas_pickup": 1,
    }
    with profile.profiled(trips_frame(spark, varied_trips(3))) as p:
        assert set(exports.insights(p)) == set(exports.REPORTS)


def test_train_and_register(spark, folder):
    registry = Registry(spark, folder)
    records = read_records(spark, "/root/testdata/sf0.001")
    order = ["pickup_ts", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    request = jobs.TrainRequest(dataset="rides", epochs=0)
    for version in (1, 2):
        summary = jobs.train_and_register(records, order, registry, request, nodes=4).head()
        assert (summary.version, summary.nodes) == (version, 4)
    stored, version = registry.active()
    assert version == 2 and stored.epochs == 100 and stored.learning_rate == 0.05
    assert stored.train_mae == summary.train_mae and len(stored.loss_history) == 100
    run = registry.training_runs().where("version = 2").head()
    assert run.dataset_file == "rides" and run.rows_used == 3234
    assert run.finished_at >= run.started_at


def test_versions_of_concurrent_trainings(spark, folder):
    """Eight threads take eight numbers; a reserved number is not given again, saved or not."""
    registry = Registry(spark, folder)
    registry.save_model(model(1.0), 1)
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(lambda _: Registry(spark, folder).allocate_version(), range(8)))
    assert sorted(taken) == list(range(2, 10))
    assert registry.next_version() == 2 and registry.allocate_version() == 10


def test_failed_insight_leaves_the_old_rows(spark, folder):
    registry = Registry(spark, folder)
    registry.upsert_insight("a", spark.range(3))
    broken = spark.range(1000).selectExpr("if(id = 999, raise_error('half-way'), id) as id")
    assert set(registry.upsert_insights({"a": broken, "b": spark.range(1)})) == {"a"}
    assert registry.insight("a").count() == 3 and registry.insight("b").count() == 1
    reading = registry.insight("a")
    registry.upsert_insight("a", spark.range(5))
    assert reading.count() == 3  # whoever reads the old rows may finish
    registry.upsert_insight("a", spark.range(6))
    assert registry.insight("a").count() == 6
