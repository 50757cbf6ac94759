import os
from datetime import datetime, timedelta

import pytest
from fixtures import line, trips_frame, varied_trips, write_lines
from pyspark.sql import functions as F
from test_latency import SCHEMA, by_key, samples
from test_score import MODEL, memo_brute_force

from tripwright.operators import latency, profile, score
from tripwright.sources.lineitem_trips import CSV_HEADER
from tripwright.session import shared_dir
from tripwright.streaming import jobs


def write_files(frame, folder, column, count):
    """One Parquet file per slice of ``column``, in order of modification."""
    for part in range(count):
        frame.where(F.col(column) % count == part).coalesce(1).write.mode("append").parquet(folder)


def test_profile_equals_batch(spark, folder):
    trips = trips_frame(spark, varied_trips(200)).withColumn("part", F.col("hour_of_day"))
    write_files(trips, f"{folder}/in", "part", 3)
    stream = jobs.read_parquet_stream(spark, f"{folder}/in", files_per_batch=1)

    def by_hour(frame):
        return frame.groupBy("hour_of_day").agg(F.count("*").alias("n"))

    jobs.run_to_end(jobs.profile_stream(stream, by_hour, f"{folder}/out", f"{folder}/check"))
    found = {r.hour_of_day: r.n for r in spark.read.parquet(f"{folder}/out").collect()}
    assert found == {r.hour_of_day: r.n for r in profile.trips_by_hour(trips).collect()}


def test_scores_are_appended_once(spark, folder):
    requests = score.requests_from_trips(trips_frame(spark, varied_trips(60)))
    writer = lambda: jobs.score_stream(  # noqa: E731 - started twice
        jobs.read_parquet_stream(spark, f"{folder}/in", 1), MODEL, 5, f"{folder}/out", f"{folder}/check"
    )
    write_files(requests, f"{folder}/in", "rate_code", 3)
    jobs.run_to_end(writer())
    jobs.run_to_end(writer())
    requests.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    jobs.run_to_end(writer())
    stored = spark.read.parquet(f"{folder}/out")
    wanted = sorted(r.duration_min for r in score.score(requests, MODEL, 5).collect())
    assert sorted(r.duration_min for r in stored.collect()) == sorted(wanted * 2)
    assert stored.select("model_version").distinct().collect() == [(5,)]


def test_memo_over_batches(spark, folder):
    """Batches a few minutes apart: entries answer later batches until they are five minutes old."""
    start = datetime(2015, 1, 10, 9)
    minutes = [0, 2, 5, 6, 20]
    batches = [
        [(batch * 1000 + i, 1.0 + (i * (batch + 1)) % 7 + i * 1e-6, start + timedelta(minutes=m)) for i in range(40)]
        for batch, m in enumerate(minutes)
    ]
    stream = None
    for rows in batches:
        frame = spark.createDataFrame(rows, "id bigint, trip_distance double, at timestamp")
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = jobs.read_parquet_stream(spark, f"{folder}/in", 1)
        jobs.run_to_end(
            jobs.memo_stream(stream, MODEL, 2, "id", "at", folder, f"{folder}/check")
        )
    assert stream is not None
    answers = spark.read.parquet(f"{folder}/answers").collect()
    found = {r.id: (r.duration_min, r.cached) for r in answers}
    memo, wanted = {}, {}
    for rows, minute in zip(batches, minutes):
        frame = spark.createDataFrame(rows, "id bigint, trip_distance double, at timestamp")
        plain = score.with_cache_key(score.score(frame, MODEL, 2)).collect()
        now = start + timedelta(minutes=minute)
        made, memo = memo_brute_force([(r.id, r.cache_key, r.duration_min) for r in plain], memo, now)
        wanted |= made
    assert found == wanted
    assert {cached for _, cached in found.values()} == {True, False}
    last = jobs.last_state(spark, f"{folder}/memo")
    assert {r.cache_key: r.duration_min for r in last.collect()} == {k: m for k, (m, _) in memo.items()}


def test_replayed_batch_gives_the_same(spark, folder):
    rows = [(i, 1.0 + i % 5, datetime(2015, 1, 10, 9)) for i in range(30)]
    frame = spark.createDataFrame(rows, "id bigint, trip_distance double, at timestamp")
    frame.coalesce(1).write.parquet(f"{folder}/in")
    seen = []
    for check in ("one", "two"):  # a new checkpoint replays batch 0 onto the same state folder
        stream = jobs.read_parquet_stream(spark, f"{folder}/in")
        jobs.run_to_end(jobs.memo_stream(stream, MODEL, 2, "id", "at", folder, f"{folder}/{check}"))
        answers = spark.read.parquet(f"{folder}/answers").drop("batch")
        seen.append(sorted(tuple(r) for r in answers.select("id", "duration_min", "cached").collect()))
    assert seen[0] == seen[1] and len(seen[0]) == 30


def test_latency_equals_batch(spark, folder):
    made = samples(1500)
    frame = spark.createDataFrame(made, SCHEMA)
    write_files(frame, f"{folder}/in", "id", 4)
    stream = jobs.read_parquet_stream(spark, f"{folder}/in", 1)
    jobs.run_to_end(
        jobs.latency_stream(stream, "key", "value", ["at", "id"], f"{folder}/out", f"{folder}/check")
    )
    kept = jobs.last_state(spark, f"{folder}/out").select("key", "value", "at", "id")
    wanted = latency.newest_per_key(frame, "key", "at", "id")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, wanted.collect()))
    assert max(len(rows) for rows in by_key([tuple(r) for r in kept.collect()]).values()) == 200


def test_memo_does_not_depend_on_batches(spark, folder):
    """One key ten minutes apart, and a backlog of hours: any cut gives the same answers."""
    start = datetime(2015, 1, 10, 9)
    rows = [(i, 1.0, start + timedelta(minutes=10 * i)) for i in range(4)]
    rows += [(100 + i, 2.0 + (i % 3), start + timedelta(seconds=97 * i)) for i in range(90)]
    frame = spark.createDataFrame(rows, "id bigint, trip_distance double, at timestamp")
    seen = []
    for cuts in (1, 4):
        for k in range(cuts):
            low, high = (start + timedelta(minutes=200 * n / cuts) for n in (k, k + 1))
            part = frame.where((F.col("at") >= low) & (F.col("at") < high))
            part.coalesce(1).write.mode("append").parquet(f"{folder}/in{cuts}")
            stream = jobs.read_parquet_stream(spark, f"{folder}/in{cuts}", 1)
            jobs.run_to_end(
                jobs.memo_stream(stream, MODEL, 2, "id", "at", f"{folder}/{cuts}", f"{folder}/check{cuts}")
            )
        answers = spark.read.parquet(f"{folder}/{cuts}/answers")
        seen.append(sorted(map(tuple, answers.select("id", "duration_min", "cached").collect())))
    assert seen[0] == seen[1]
    last, wanted = {}, {}
    for i, distance, at in sorted(rows, key=lambda r: (r[2], r[0])):
        hit = distance in last and at <= last[distance] + timedelta(minutes=5)
        if not hit:
            last[distance] = at
        wanted[i] = hit
    assert {i: cached for i, _, cached in seen[0]} == wanted
    assert not any(wanted[i] for i in range(4)) and any(wanted.values())


def test_old_state_goes(spark, folder):
    """At most two state folders, and a new run does not read what another one left."""
    made = spark.createDataFrame(samples(300), SCHEMA)
    write_files(made, f"{folder}/in", "id", 5)
    for check in ("one", "two"):
        stream = jobs.read_parquet_stream(spark, f"{folder}/in", 1)
        jobs.run_to_end(
            jobs.latency_stream(stream, "key", "value", ["at", "id"], f"{folder}/out", f"{folder}/{check}")
        )
        assert len([n for n in os.listdir(f"{folder}/out") if n.startswith("batch=")]) <= 2
    spark.createDataFrame([("new", 1.0, datetime(2030, 1, 1), 1)], SCHEMA).write.parquet(f"{folder}/in2")
    stream = jobs.read_parquet_stream(spark, f"{folder}/in2")
    jobs.run_to_end(
        jobs.latency_stream(stream, "key", "value", ["at", "id"], f"{folder}/out", f"{folder}/three")
    )
    assert [r.key for r in jobs.last_state(spark, f"{folder}/out").collect()] == ["new"]


def test_no_state_yet(spark, folder):
    with pytest.raises(LookupError):
        jobs.last_state(spark, f"{folder}/none")


def test_new_run_leaves_no_old_answers(spark, folder):
    """Sixty requests in three batches, then in one batch by a new run: sixty answers, not more."""
    rows = [(i, 1.0 + i % 5, datetime(2015, 1, 10, 9, i)) for i in range(60)]
    frame = spark.createDataFrame(rows, "id bigint, trip_distance double, at timestamp")
    write_files(frame, f"{folder}/in", "id", 3)
    for check, files in (("one", 1), ("two", None)):
        stream = jobs.read_parquet_stream(spark, f"{folder}/in", files)
        jobs.run_to_end(jobs.memo_stream(stream, MODEL, 2, "id", "at", folder, f"{folder}/{check}"))
        assert sorted(r.id for r in spark.read.parquet(f"{folder}/answers").collect()) == list(range(60)) or check == "one"


def test_csv_files_of_two_layouts_as_a_stream(spark, folder):
    os.mkdir(f"{folder}/in")
    names = CSV_HEADER.split(",")
    turned = lambda text: ",".join([*text.split(",")[1:], text.split(",")[0]])
    writer = lambda: jobs.csv_rule_stream(  # noqa: E731 - started twice
        jobs.read_csv_stream(spark, f"{folder}/in", 1), f"{folder}/out", f"{folder}/check"
    )
    records = [line(), line(f4="0.0"), "x", CSV_HEADER]
    write_lines(f"{folder}/in/a.csv", records)
    write_lines(f"{folder}/in/b.csv", [turned(r) for r in records[:2]], turned(",".join(names)), "\r\n")
    open(f"{folder}/in/empty.csv", "w").close()
    jobs.run_to_end(writer())
    write_lines(f"{folder}/in/c.csv", [line()] * 3)
    jobs.run_to_end(writer())
    found = spark.read.parquet(f"{folder}/out").groupBy("rule").agg(F.sum("n")).collect()
    assert sorted(map(tuple, found)) == [(0, 5), (1, 2), (6, 2)]


def test_latency_of_logged_scores(spark):
    clock = F.timestamp_seconds(F.lit(1000.5))
    requests = score.requests_from_trips(trips_frame(spark, varied_trips(3)))
    arrived = requests.withColumn("at", F.timestamp_seconds(F.lit(1000)))
    log = score.prediction_log(score.score(arrived, MODEL, 5), clock, "at")
    assert [r.latency_ms for r in log.collect()] == [500] * 3
    assert log.schema["latency_ms"].dataType.simpleString() == "bigint"


def test_memo_stream_leaves_answers_and_state_only(spark, folder):
    """What a batch worked with goes with it, and the shared folder does not grow by its requests."""
    rows = [(i, 1.0 + i % 7, datetime(2015, 1, 10, 9, i % 50)) for i in range(200)]
    write_files(spark.createDataFrame(rows, "id bigint, trip_distance double, at timestamp"), f"{folder}/in", "id", 1)
    shared = f"{shared_dir(spark)}/tripwright"
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    stream = jobs.read_parquet_stream(spark, f"{folder}/in", 1)
    jobs.run_to_end(jobs.memo_stream(stream, MODEL, 2, "id", "at", folder, f"{folder}/check"))
    assert spark.read.parquet(f"{folder}/answers").count() == 200
    assert [n for n in set(os.listdir(shared)) - before if n.startswith("memo-")] == []
