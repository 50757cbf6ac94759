import math
import os

import numpy as np
import pytest
from fixtures import line, trip, trips_frame, varied_trips, write_lines
from pyspark.sql import functions as F

from tripwright.functions import features as X
from tripwright.operators import evaluate, rules, split, train
from tripwright.operators.model import LinearModel
from tripwright.plans import exports, jobs
from tripwright.sources import csv_lines, model_json



def raw(t):
    """The features of one trip, written out again."""
    _, _, distance, latitude, longitude, rate, passengers, hour, day = t
    angle = 2 * math.pi * hour / 24
    return [
        distance,
        math.sin(angle),
        math.cos(angle),
        float(day in (0, 6)),
        latitude,
        longitude,
        float(rate in (2, 3)),
        float(passengers),
    ]


def brute_force(rows, epochs, rate):
    """Row-by-row descent in numpy: (weights, losses, means, stds)."""
    features = np.array([raw(t) for t in rows])
    y = np.array([t[1] for t in rows])
    means, stds = features.mean(axis=0), features.std(axis=0)
    stds[stds < 1e-10] = 1.0
    x = np.c_[(features - means) / stds, np.ones(len(rows))]
    weights, losses = np.zeros(9), []
    for _ in range(epochs):
        weights = weights - rate * (x.T @ (x @ weights - y)) / len(y)
        losses.append(float(((x @ weights - y) ** 2).mean()))
    return weights, losses, means, stds


def matrix(spark, x, y):
    x = [row + [0.0] * (9 - len(row)) for row in x]
    rows = [(*row, value) for row, value in zip(x, y)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*X.X_COLUMNS, "y"]))


def test_gradient_by_hand(spark):
    m = matrix(spark, [[2.0, 1.0], [4.0, 1.0]], [3.0, 7.0])
    weights = [1.0] + [0.0] * 8
    assert list(train.mean_gradient(m, weights).head())[:2] == [-7.0, -2.0]
    assert list(train.gradient_sum(m, weights).head())[:2] == [-14.0, -4.0]
    assert train.gradient_sum(m, weights).head().n == 2
    m = matrix(spark, [[1.0, 0.0, 1.0]], [5.0])
    assert list(train.mean_gradient(m, [2.0] + [0.0] * 8).head())[:3] == [-3.0, 0.0, -3.0]
    none = m.where("false")
    assert list(train.gradient_sum(none, weights).head()) == [0.0] * 9 + [0]
    assert list(train.mean_gradient(none, weights).head()) == [0.0] * 9


@pytest.mark.parametrize("partitions", [1, 2, 8])
def test_ordered_fit_equals_brute_force(spark, partitions):
    made = varied_trips(60)
    frame = trips_frame(spark, [(*t,) for t in made], partitions)
    # Distance grows with the position, so the first 48 rows are those up to 1.0 + 47 * 0.05.
    first = F.col("trip_distance") < 1.0 + 47.5 * 0.05
    model, _ = train.fit(frame, first, epochs=5, learning_rate=0.01)
    weights, losses, means, stds = brute_force(made[:48], 5, 0.01)
    assert np.abs(np.array(model.weights) - weights).max() < 1e-9
    assert model.loss_history == pytest.approx(losses, rel=1e-9)
    assert model.means == pytest.approx(means.tolist(), rel=1e-12)
    assert model.stds == pytest.approx(stds.tolist(), rel=1e-9)
    passes, by_pass = train.descend_by_pass(
        X.feature_matrix(frame.where(first), model.means, model.stds), 5, 0.01
    )
    assert np.abs(np.array(passes) - weights).max() < 1e-9
    assert by_pass == pytest.approx(losses, rel=1e-9)


def test_linear_trips_are_learned(spark):
    made = [
        trip(5 * (0.5 + (i % 20) / 2) + 5, 0.5 + (i % 20) / 2, hour=i % 24, weekday=1 + i % 5)
        for i in range(500)
    ]
    frame = trips_frame(spark, made)
    key = F.concat_ws("-", "trip_distance", "hour_of_day", "day_of_week")
    model, table = jobs.train_local(frame, key, epochs=100, learning_rate=0.05)
    assert model.train_rmse < 50 and model.train_r2 > 0.99
    assert len(model.loss_history) == 100
    assert all(b <= a for a, b in zip(model.loss_history, model.loss_history[1:]))
    labels = [r.model for r in table.collect()]
    assert labels == list(evaluate.MODEL_LABELS.values())


def test_constant_and_far_off_features(spark):
    """Constant inputs have scale 1; a centre far from the data costs no digits."""
    made = [trip(10 + i % 7, 1 + i % 10, latitude=-33.4, longitude=151.2) for i in range(200)]
    found, _ = train.moments(trips_frame(spark, made), F.lit(True))
    weights, _, means, stds = brute_force(made, 20, 0.05)
    assert found.means[:8].tolist() == pytest.approx(means.tolist(), abs=1e-12)
    assert found.stds.tolist() == pytest.approx(stds.tolist(), abs=1e-12)
    assert found.stds.tolist()[1:] == [1.0] * 7
    assert np.abs(np.array(train.descend(found, 20, 0.05)[0]) - weights).max() < 1e-9
    narrow = [trip(10 + i % 7, 1 + i % 10, latitude=-33 + i * 1e-7) for i in range(200)]
    found, _ = train.moments(trips_frame(spark, narrow), F.lit(True))
    assert found.stds[4] == pytest.approx(brute_force(narrow, 0, 0)[3][4], rel=1e-6)


def test_scaler_basics(spark):
    made = [trip(10, 1.0, 8), trip(20, 3.0, 12), trip(30, 5.0, 16)]
    found, rest = train.moments(trips_frame(spark, made), F.lit(True))
    assert found.means[0] == pytest.approx(3.0) and (found.stds > 0).all()
    assert (found.n, rest.n) == (3, 0)
    nothing, _ = train.moments(trips_frame(spark, []), F.lit(True))
    assert nothing.means.tolist() == [0.0] * 9 and nothing.stds.tolist() == [1.0] * 8


def test_nothing_to_train_on(spark):
    with pytest.raises(ValueError):
        train.fit(trips_frame(spark, []), F.lit(True))
    with pytest.raises(ValueError):
        train.fit(trips_frame(spark, varied_trips(3)), F.lit(False))


def test_everything_in_train_leaves_zero_test_metrics(spark):
    model, table = train.fit(trips_frame(spark, varied_trips(30)), F.lit(True))
    assert (model.test_mae, model.test_rmse, model.test_r2) == (0.0, 0.0, 0.0)
    assert model.train_mae > 0
    assert {(r.mae, r.rmse, r.r2) for r in table.collect()} == {(0.0, 0.0, 0.0)}


def test_metrics_against_plain_python(spark):
    made = varied_trips(40)
    model = LinearModel([float(j) for j in range(1, 10)], [0.0] * 8, [2.0] * 8)
    guesses = [sum((v / 2) * w for v, w in zip(raw(t), model.weights)) + 9 for t in made]
    y = [t[1] for t in made]
    errors = [p - a for p, a in zip(guesses, y)]
    mean = sum(y) / len(y)
    found = evaluate.metrics(trips_frame(spark, made), model.prediction()).head()
    assert found.mae == pytest.approx(sum(map(abs, errors)) / 40)
    assert found.rmse == pytest.approx(math.sqrt(sum(e * e for e in errors) / 40))
    spread = sum((a - mean) ** 2 for a in y)
    assert found.r2 == pytest.approx(1 - sum(e * e for e in errors) / spread)
    flat = trips_frame(spark, [trip(5.0, i) for i in range(1, 5)])
    assert evaluate.metrics(flat, "3D").head().r2 == 0.0
    assert list(evaluate.metrics(flat.where("false"), "3D").head()) == [0.0, 0.0, 0.0]


def test_baselines(spark):
    known = trips_frame(spark, [trip(10, 2.0), trip(20, 2.0), trip(0, 1.0)])
    test = trips_frame(spark, [trip(15, 3.0), trip(25, 4.0)])
    by_mean, by_speed = (m.head() for m in evaluate.baseline_metrics(known, test))
    assert by_mean.mae == pytest.approx((5 + 15) / 2)
    mph = (12.0 + 6.0) / 2
    errors = [3 / mph * 60 - 15, 4 / mph * 60 - 25]
    assert by_speed.mae == pytest.approx(sum(map(abs, errors)) / 2)
    for empty in (evaluate.baseline_metrics(known.where("false"), test),
                  evaluate.baseline_metrics(known, test.where("false"))):
        assert [list(m.head()) for m in empty] == [[0.0] * 3] * 2
    still = trips_frame(spark, [trip(0, 1.0)])
    assert evaluate.baseline_metrics(still, test)[1].head().mae == pytest.approx(20)


def test_fit_evaluates_like_the_parts(spark):
    frame = trips_frame(spark, varied_trips(80))
    chosen = F.col("passenger_count") < 4
    model, table = train.fit(frame, chosen, 10, 0.05)
    on_test = evaluate.metrics(frame.where(~chosen), model.prediction()).head()
    assert (model.test_mae, model.test_rmse, model.test_r2) == pytest.approx(tuple(on_test))
    assert model.loss_history[-1] == pytest.approx(model.train_rmse**2)
    baseline = [list(m.head()) for m in evaluate.baseline_metrics(frame.where(chosen), frame.where(~chosen))]
    rows = {r.model: [r.mae, r.rmse, r.r2] for r in table.collect()}
    for label, wanted in zip(list(rows)[1:], baseline):
        assert rows[label] == pytest.approx([round(wanted[0], 2), round(wanted[1], 2), round(wanted[2], 4)])


def test_zero_weights_predict_zero(spark):
    model = LinearModel([0.0] * 9, [0.0] * 8, [1.0] * 8)
    frame = trips_frame(spark, varied_trips(3))
    assert {r.p for r in frame.selectExpr(f"{model.prediction()} as p").collect()} == {0.0}
    assert frame.selectExpr(f"{model.predict_standardised(['2D'] * 9)} as p").head().p == 0.0


def test_divergence_flags(spark):
    curve = spark.createDataFrame([(1, 50.0), (2, 501.0), (3, 5010.0), (4, 60000.0)], "epoch int, mse double")
    flags = [r.diverging for r in train.divergence_flags(curve).orderBy("epoch").collect()]
    assert flags == [False, True, False, True]


def test_json_round_trip_and_loss_report(spark, folder):
    made = [trip(5 * (1 + i % 10) + 5, 1.0 + i % 10) for i in range(200)]
    model, _ = jobs.train_local(trips_frame(spark, made), F.col("trip_distance"), epochs=5)
    model_json.save_model(spark, model, f"{folder}/model.json")
    assert model_json.load_model(spark, f"{folder}/model.json") == model
    text = "\n".join(r.value for r in spark.read.text(f"{folder}/model.json").collect())
    assert text.startswith("{\n") and '"learning_rate" : 0.01' in text
    exports.write_report(exports.loss_report(model.to_frame(spark)), f"{folder}/loss.csv")
    lines = [r.value for r in spark.read.text(f"{folder}/loss.csv").collect()]
    assert lines[0] == "epoca,mse_train" and len(lines) == 6
    assert lines[1] == f"1,{model.loss_history[0]:.6f}"


def test_short_scaling_arrays_are_zero_filled(spark):
    frame = LinearModel([1.0] * 9, [2.0, 3.0], [4.0] * 9).to_frame(spark)
    model = LinearModel.from_row(frame.head())
    assert model.means == [2.0, 3.0] + [0.0] * 6 and model.stds == [4.0] * 8


def test_default_parameters():
    request = jobs.TrainRequest(epochs=0, learning_rate=-1, batch_size=0, fraction=1.0).with_defaults()
    assert (request.epochs, request.learning_rate, request.batch_size, request.fraction) == (100, 0.05, 1024, 0.8)
    assert split.train_fraction(0.3) == 0.3


def test_stored_moments_equal_a_full_fit_and_read_new_files_only(spark, folder):
    files = [f"{folder}/{name}.csv" for name in ("a", "b", "c")]
    for k, path in enumerate(files):
        lines = [line(f4=f"{1 + (i * (k + 1)) % 17 * 0.3}", f2=f"2015-01-10 08:{10 + i % 40}:00") for i in range(60)]
        write_lines(path, lines)
    chosen = F.col("trip_distance") < 4.5
    store = f"{folder}/store"
    jobs.moments_of_files(spark, files[:2], store, chosen)
    stamp = sorted(os.listdir(f"{store}/sums"))
    jobs.moments_of_files(spark, files[:2], store, chosen)
    assert sorted(os.listdir(f"{store}/sums")) == stamp
    found = jobs.moments_of_files(spark, files, store, chosen)
    held = spark.read.parquet(f"{store}/sums").where(F.col("file_path").endswith("a.csv")).agg(F.sum("n")).head()[0]
    assert held == 60
    trips = rules.valid_trips(csv_lines.read_trips_csv(spark, files))
    for one, other in zip(found, train.moments(trips, chosen)):
        assert one.n == other.n
        np.testing.assert_allclose(one.covariance, other.covariance, atol=1e-9)
    full, _ = train.fit(trips, chosen, 20, 0.05)
    np.testing.assert_allclose(train.descend(found[0], 20, 0.05)[0], full.weights, rtol=1e-9, atol=1e-9)
    with pytest.raises(LookupError):
        train.stored_moments(spark, f"{folder}/none")
