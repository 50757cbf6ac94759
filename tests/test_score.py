import os
import random
from datetime import datetime, timedelta

import pytest
from fixtures import trips_frame, varied_trips
from pyspark.sql import functions as F

from tripwright.functions import features as X
from tripwright.functions import text
from tripwright.operators import score
from tripwright.operators.model import LinearModel
from tripwright.session import shared_dir
from tripwright.schemas import SCORING_INPUT

MODEL = LinearModel([3.0, 1.0, 2.0, 4.0, 0.5, 0.25, 6.0, 0.125, 20.0], [1.0] * 8, [2.0] * 8)
SENT = [
    ("2.5", "18", "3", "40.75", "-73.98", "1", "1"),
    ("1.0", "8", "1", "40.70", "-74.00", "1", "2"),
    ("5.3", "22", "5", "40.76", "-73.97", "2", "1"),
    ("0.8", "12", "0", "40.72", "-73.99", "1", "3"),
]
TEXT_SCHEMA = ", ".join(f"{name} string" for name in SCORING_INPUT.names)


def requests(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"id bigint, {TEXT_SCHEMA}")


def test_requests_equal_trips(spark):
    made = varied_trips(50)
    trips = trips_frame(spark, made)
    direct = trips.selectExpr("trip_distance", f"{MODEL.prediction()} as p")
    asked = score.score(score.requests_from_trips(trips), MODEL, 7)
    wanted = {r.trip_distance: r.p for r in direct.collect()}
    for row in asked.collect():
        assert row.duration_min == wanted[row.trip_distance] and row.model_version == 7


def test_sample_requests(spark):
    rows = score.score(requests(spark, SENT), MODEL, 1).orderBy("id").collect()
    assert [r.error for r in rows] == [None] * 4
    assert rows[3].passenger_count == 3 and rows[3].hour == 12
    keys = [r.cache_key for r in score.with_cache_key(score.score(requests(spark, SENT), MODEL, 1)).orderBy("id").collect()]
    assert keys[0] == "2.500:18:3:40.7500:-73.9800:1:1"


def test_defaults_and_errors(spark):
    rows = [
        ("2.5", None, "x", "", "1e400", "9" * 30, "-4"),
        (None, "1", "1", "1", "1", "1", "1"),
        ("", "1", "1", "1", "1", "1", "1"),
        ("abc", "1", "1", "1", "1", "1", "1"),
        ("1e400", "1", "1", "1", "1", "1", "1"),
        (" 2", "1", "1", "1", "1", "1", "1"),
        ("1_0.5", "-" + "9" * 30, "+5", "-inf", "nan", "1.0", "0"),
        ("inf", "1", "1", "1", "1", "1", "1"),
    ]
    found = score.score(requests(spark, rows), MODEL, 1).orderBy("id").collect()
    first = found[0]
    assert (first.hour, first.day_of_week, first.pickup_lat, first.passenger_count) == (0, 0, 0.0, 1)
    assert first.pickup_lon == float("inf") and first.rate_code == 2**63 - 1
    assert [r.error for r in found] == [
        None,
        "trip_distance: missing value",
        "trip_distance: missing value",
        *["trip_distance: invalid value"] * 3,
        None,
        None,
    ]
    assert all((r.duration_min is None) == (r.error is not None) for r in found)
    assert (found[6].trip_distance, found[6].hour, found[6].day_of_week) == (10.5, -(2**63), 5)
    assert (found[6].pickup_lat, found[6].rate_code) == (float("-inf"), 0)
    few = spark.createDataFrame([(1, 2.5), (2, None)], "id int, trip_distance double")
    one, two = score.score(few, MODEL, 1).orderBy("id").collect()
    assert one.error is None and one.passenger_count == 1 and one.hour == 0
    assert two.error == "trip_distance: missing value"


def test_fixed_decimals_round_exactly(spark):
    rng = random.Random(5)
    values = [0.0, -0.0, 0.5, 2.0005, 1.0005, 0.0005, 0.00005, -73.98505, 2.5, 1e15, -1e17, 5e-324]
    values += [0.125, 0.375, 1.0625, -0.0625, 999.9995, 0.9995, float("inf"), float("-inf"), float("nan")]
    values += [rng.uniform(-200, 200) for _ in range(2000)]
    values += [round(rng.uniform(-200, 200), 4) + 0.0005 for _ in range(2000)]
    values += [rng.randrange(-(10**6), 10**6) / 2**k for k in range(1, 14) for _ in range(50)]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    made = text.with_fixed_decimals(frame, {f"d{k}": ("v", k) for k in (1, 3, 4, 6)})
    special = {float("inf"): "+Inf", float("-inf"): "-Inf"}
    for row in made.collect():
        v = values[row.i]
        for k in (1, 3, 4, 6):
            wanted = "NaN" if v != v else special.get(v, f"{v:.{k}f}")
            assert row[f"d{k}"] == wanted, (v, k)


def memo_brute_force(rows, memo, now):
    """(id -> (minutes, cached)) and the memo afterwards; rows are (id, key, own minutes)."""
    live = {k: (m, at) for k, (m, at) in memo.items() if now - at <= timedelta(minutes=5)}
    answers = {}
    for i, key, own in sorted(rows):
        answers[i] = (live[key][0], True) if key in live else (own, False)
        live.setdefault(key, (own, now))
    return answers, live


def test_memo_against_plain_python(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        kind = 0 if i % 3 == 0 else rng.randrange(1, 40)  # a third share one key
        rows.append((str(kind + rng.random() * 4e-4), "8", "1", "40.7", "-74.0", "1", "1"))
    sent = requests(spark, rows).repartition(6)
    scored = score.with_cache_key(score.score(sent, MODEL, 2)).collect()
    plain = [(r.id, r.cache_key, r.duration_min) for r in scored]
    keys = sorted({key for _, key, _ in plain})
    now = datetime(2015, 1, 10, 9)
    memo = {
        keys[0]: (111.0, now - timedelta(minutes=5)),
        keys[1]: (222.0, now - timedelta(minutes=5, microseconds=1)),
        "other": (333.0, now),
    }
    stored = spark.createDataFrame(
        [(k, m, at) for k, (m, at) in memo.items()], "cache_key string, duration_min double, scored_at timestamp_ntz"
    )
    clock = F.lit(now).cast("timestamp_ntz")
    for known, table in (({}, None), (memo, stored)):
        answers = score.score_with_memo(sent, MODEL, 2, "id", table, clock).persist()
        wanted, after = memo_brute_force(plain, known, now)
        found = {r.id: (r.duration_min, r.cached) for r in answers.collect()}
        assert found == wanted
        assert all(r.model_version == (-1 if r.cached else 2) for r in answers.collect())
        fresh = {r.cache_key: r.duration_min for r in score.new_entries(answers, clock).collect()}
        assert fresh == {k: m for k, (m, at) in after.items() if at == now and k not in known or k == keys[1] and known}
        logged = score.prediction_log(answers, clock)
        assert logged.count() == sum(not cached for _, cached in wanted.values())
        assert logged.head().input.asDict().keys() == set(SCORING_INPUT.names)


def test_failed_requests_are_answered_too(spark):
    rows = [SENT[0], (None, *SENT[0][1:]), SENT[0]]
    found = score.score_with_memo(requests(spark, rows), MODEL, 2, "id").orderBy("id").collect()
    assert [r.cached for r in found] == [False, False, True]
    assert found[1].error and found[1].duration_min is None and found[1].model_version is None


def test_dot_of_arrays(spark):
    frame = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0, 6.0])], "a array<double>, b array<double>")
    assert frame.select(X.dot_arrays(F.col("a"), F.col("b")).alias("d")).head().d == 32.0


@pytest.mark.parametrize("hour", [0, 6, 23, 30, -5])
def test_any_hour_is_scored(spark, hour):
    frame = spark.createDataFrame([(1.0, hour)], "trip_distance double, hour int")
    assert score.score(frame, MODEL, 1).head().duration_min is not None


def chain(times, life):
    """Entry times of one key, one after the other."""
    out = []
    for t in sorted(times):
        if not out or t > out[-1] + life:
            out.append(t)
    return out


def test_entry_times_against_plain_python(spark):
    """Random times, ties with an entry's end, negative times, gaps of many slots; rounds by the logarithm."""
    life, draw = score.MEMO_SECONDS * 1_000_000, random.Random(5)
    keys = {f"r{k}": {draw.randrange(-40 * life, 40 * life) for _ in range(300)} for k in range(4)}
    keys["edge"] = {0, life, life + 1, 2 * life + 1, 2 * life + 2, 50 * life, -life}
    keys["long"] = {i * 2 * life for i in range(1000)} | {i * 2 * life + life // 2 for i in range(1000)}
    keys["one"] = {7}
    rows = [(k, t) for k, times in keys.items() for t in times]
    found, rounds = score.entry_times(spark.createDataFrame(rows, "cache_key string, t bigint"))
    by_key = {}
    for r in found.collect():
        by_key.setdefault(r.cache_key, []).append(r.t)
    assert {k: sorted(v) for k, v in by_key.items()} == {k: chain(v, life) for k, v in keys.items()}
    assert len(by_key["long"]) == 1000 and rounds <= 11


def test_times_without_rows(spark):
    found, rounds = score.entry_times(spark.createDataFrame([], "cache_key string, t bigint"))
    assert found.isEmpty() and rounds == 0


def test_request_without_arrival_is_computed(spark):
    sent = requests(spark, [SENT[0], SENT[0]]).withColumn("at", F.expr("if(id = 0, timestamp'2015-01-10 09:00:00', null)"))
    answers, entries = score.score_by_time(sent, MODEL, 2, "id", "at")
    found = {r.id: (r.cached, r.model_version, r.duration_min is None) for r in answers.collect()}
    assert found == {0: (False, 2, False), 1: (False, 2, False)} and entries.count() == 1


def _tables(spark):
    folder = f"{shared_dir(spark)}/tripwright"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


@pytest.mark.parametrize("part, remembered", [(10**9, False), (60, True)])
def test_keys_in_parts_leave_answers_only(spark, monkeypatch, part, remembered):
    """Sparse and crowded keys, ties, errors, no times, earlier entries: as one by one; no table but answers and entries stays."""
    monkeypatch.setattr(score, "PART_REQUESTS", part, raising=False)
    draw, start, rows = random.Random(11), datetime(2015, 1, 10, 9), []
    for i in range(400):
        key = 0 if i % 2 else draw.randrange(1, 12)
        at = None if i % 97 == 5 else start + timedelta(seconds=draw.randrange(0, 4000 if key else 2000))
        rows.append((i, None if i % 50 == 7 else key + 1.0, at))
    frame = spark.createDataFrame(rows, "id bigint, trip_distance double, at timestamp")
    plain = {r.id: r for r in score.with_cache_key(score.score(frame, MODEL, 2)).collect()}
    keys = sorted({r.cache_key for r in plain.values() if r.cache_key})
    memo = {keys[0]: (111.0, start + timedelta(seconds=30)), keys[1]: (222.0, start - timedelta(hours=1)), "other": (3.0, start)} if remembered else {}
    known = [(k, m, at) for k, (m, at) in memo.items()]
    stored = spark.createDataFrame(known, "cache_key string, duration_min double, scored_at timestamp") if remembered else None
    before = _tables(spark)
    answers, newest = score.score_by_time(frame.repartition(5), MODEL, 2, "id", "at", stored)
    found = {r.id: (r.duration_min, r.cached, r.model_version) for r in answers.collect()}
    assert len(found) == answers.count() == len(rows)
    assert {n.rsplit("-", 1)[0] for n in _tables(spark) - before} <= {"memo-answers", "memo-newest", "per-key"}
    wanted, live = {}, dict(memo)
    for i, distance, at in sorted(rows, key=lambda r: (r[2] or start, r[0])):
        own, key = plain[i].duration_min, plain[i].cache_key
        if distance is None:
            wanted[i] = (None, False, None)
        elif at is None:
            wanted[i] = (own, False, 2)
        elif key in live and at <= live[key][1] + timedelta(minutes=5):
            wanted[i] = (live[key][0], True, -1)
        else:
            live[key] = (own, at)
            wanted[i] = (own, False, 2)
    assert found == wanted and {c for _, c, _ in found.values()} == {True, False}
    assert {r.cache_key: (r.duration_min, r.scored_at) for r in newest.collect()} == live


def test_sparse_times_take_no_rounds(spark):
    """Times further apart than an entry's life begin entries by themselves; only unbroken stretches get pointers."""
    life = score.MEMO_SECONDS * 1_000_000
    rows = [(k, i * 3 * life + k) for k in range(3) for i in range(300)]
    found, rounds = score.entry_times(spark.createDataFrame(rows, "cache_key bigint, t bigint"))
    assert sorted(map(tuple, found.select("cache_key", "t").collect())) == sorted(rows) and rounds == 0


def test_numbers_of_keys_are_checked(spark, monkeypatch):
    """Numbers that two keys share are not used."""
    frame = spark.range(3000).selectExpr("cast(id as string) as cache_key")
    number, short = score._key_number([frame]), F.pmod
    assert frame.select(number.alias("k")).distinct().count() == 3000
    monkeypatch.setattr(score.F, "pmod", lambda a, b: short(a, F.lit(1000)))
    number = score._key_number([frame])
    assert frame.select(number.alias("k")).distinct().count() == 3000
