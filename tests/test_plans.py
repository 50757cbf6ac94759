"""Physical plans: what reaches the scan, what is shuffled, what runs outside the JVM."""

import contextlib
import io
import re

import pytest
from fixtures import line, write_lines
from pyspark.sql import functions as F

from tripwright import catalog
from tripwright.operators import latency, profile, rules, split, train
from tripwright.plans import jobs
from tripwright.schemas import RAW_COLUMNS
from tripwright.sources import csv_lines
from tripwright.sources.lineitem_trips import CSV_HEADER, KEYS, read_records, trip_id

FOLDER = "/root/testdata/sf0.001"


def plan(frame, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain(mode)
    return out.getvalue()


def method_sizes(spark, frame):
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan(frame, "codegen"))]


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "records")
    read_records(spark, FOLDER).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_rules_reach_the_scan(stored):
    shown = plan(profile.trips_by_hour(rules.valid_trips(stored)))
    pushed = re.search(r"PushedFilters: \[(.*)\]", shown).group(1)
    assert "GreaterThanOrEqual(pickup_ts" in pushed and "LessThan(pickup_ts" in pushed
    for column in set(RAW_COLUMNS) - {"dropoff_ts", "rate_code_id"}:
        assert re.search(rf"(Than|Equal)\w*\({column}", pushed), column
    schema = re.search(r"ReadSchema: (.*)", shown).group(1)
    assert "l_orderkey" not in schema


def test_positional_cut_reaches_the_scan(stored):
    shown = plan(stored.where(split.in_first(stored, ["pickup_ts", *KEYS], 3000)))
    assert re.search(r"PushedFilters: \[.*LessThan\(pickup_ts", shown)
    assert "Exchange" not in shown and "Sort" not in shown


def test_profile_reads_once(stored):
    shown = plan(profile.profile(rules.valid_trips(stored)))
    assert shown.count("Scan parquet") == 2  # once in the tree, once in its details
    assert "Expand" in shown and shown.count("Exchange") == 2
    assert plan(profile.profile_long(rules.valid_trips(stored))).count("(1) Scan parquet") == 1


def test_top_cells_is_a_top_k(stored):
    shown = plan(profile.top_cells(profile.pickup_cells(rules.valid_trips(stored))))
    assert "TakeOrderedAndProject" in shown


def test_training_aggregate_is_partial_and_small(spark, stored):
    trips = rules.valid_trips(stored, *KEYS)
    sums = train.category_sums(trips, split.in_train_by_hash(trip_id()), train._FIRST_CENTRE)
    shown = plan(sums)
    assert "partial_sum" in shown and shown.count("Exchange") == 2
    assert sums.count() <= 192


def test_newest_rows_are_cut_before_the_shuffle(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    shown = plan(latency.newest_per_key(events, "event_type", "ts", "event_id"), "simple")
    assert shown.count("WindowGroupLimit") == 4


def test_lines_are_parsed_once(spark, tmp_path):
    path = write_lines(str(tmp_path / "a.csv"), [line()])
    shown = plan(rules.valid_trips(csv_lines.read_trips_csv(spark, path)), "simple")
    assert shown.count("split(") == 1
    assert shown.count("Generate inline") == 2


def test_hot_paths_stay_below_the_compiler_limit(spark, no_aqe, stored):
    records = read_records(spark, FOLDER)
    for frame in (
        rules.rule_totals(rules.with_rule(records)),
        profile.profile(rules.valid_trips(records)),
        train.category_sums(
            rules.valid_trips(records, *KEYS), split.in_train_by_hash(trip_id()), train._FIRST_CENTRE
        ),
        catalog.QUERIES["score_memo"](spark, FOLDER),
    ):
        sizes = method_sizes(spark, frame)
        assert sizes and max(sizes) < 8000


@pytest.mark.parametrize(
    "name",
    ["rule_counts", "profile_grouping_sets", "score_memo", "latency_summary", "latest_200", "eval_metrics"],
)
def test_no_python_and_no_cross_join(spark, name):
    shown = plan(catalog.QUERIES[name](spark, FOLDER), "simple")
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in shown


def test_partial_counts_do_not_depend_on_partitions(spark):
    records = read_records(spark, FOLDER)
    wanted = sorted(rules.rule_counts(rules.with_rule(records)).collect())
    for n in (1, 2, 9):
        spread = records.repartition(n, F.rand(n))
        assert sorted(rules.rule_counts(rules.with_rule(spread)).collect()) == wanted


def test_load_takes_one_job_and_one_scan(spark, folder):
    """Trips, rejects and counts as from separate passes; the records are scanned by one job only."""
    records = read_records(spark, "/root/testdata/sf0.001")
    sc = spark.sparkContext
    sc.setJobGroup("one-load", "load")
    loaded = jobs.load(records, f"{folder}/load", "l_orderkey")
    n_jobs = len(sc.statusTracker().getJobIdsForGroup("one-load"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert n_jobs == 1
    ruled = rules.with_rule(records)
    assert loaded.report == rules.load_report(ruled).head().asDict()
    wanted = rules.valid_trips(records, "l_orderkey")
    assert loaded.trips.columns == wanted.columns
    assert loaded.trips.exceptAll(wanted).isEmpty() and wanted.exceptAll(loaded.trips).isEmpty()
    counts = {r.rule: r["count"] for r in loaded.rejects.groupBy("rule").count().collect()}
    assert counts == {r.rule: r.n for r in rules.rule_counts(ruled).collect() if r.n}


def test_load_of_text_and_of_nothing(spark, folder):
    """Each file's header is no record, a repeated one is; no records give zeros."""
    paths = [write_lines(f"{folder}/{i}.csv", [line(), CSV_HEADER, line(f3="0")]) for i in range(2)]
    records = csv_lines.read_trips_csv(spark, paths)
    loaded = jobs.load(records, f"{folder}/load")
    assert loaded.report == rules.load_report(rules.with_rule(records)).head().asDict()
    assert (loaded.report["total"], loaded.report["r1"], loaded.report["r8"]) == (6, 2, 2)
    assert loaded.trips.count() == 2 and loaded.rejects.count() == 4
    empty = jobs.load(records.limit(0), f"{folder}/none")
    assert empty.report["total"] == 0 and empty.report["retention_pct"] == 0 and empty.trips.isEmpty()
