from datetime import datetime

import pytest
from fixtures import line, write_lines
from pyspark.sql import functions as F

from tripwright.operators import rules
from tripwright.plans import jobs
from tripwright.sources import csv_lines
from tripwright.sources.lineitem_trips import CSV_HEADER


def codes(spark, lines):
    """Rule code of each line, in order."""
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    ruled = rules.with_rule(csv_lines.parse_lines(frame, CSV_HEADER, header_in_lines=False))
    valid = rules.valid_trips(csv_lines.parse_lines(frame, CSV_HEADER, False), "i")
    found = {r.i: r.rule for r in ruled.collect()}
    assert {r.i for r in valid.collect()} == {i for i, rule in found.items() if rule == 0}
    return [found[i] for i in range(len(lines))]


def test_valid_record(spark):
    frame = spark.createDataFrame([(line(),)], "value string")
    row = rules.valid_trips(csv_lines.parse_lines(frame, CSV_HEADER, False)).head()
    assert row.pickup_ts == datetime(2015, 1, 10, 8)
    assert (row.duration_min, row.trip_distance, row.passenger_count) == (20.0, 3.5, 2)
    assert (row.rate_code_id, row.hour_of_day, row.day_of_week) == (1, 8, 6)


@pytest.mark.parametrize(
    "rule, records",
    [
        (1, [line() + ",extra", ",".join(line().split(",")[:10]), line(f1="no-es-fecha"), ""]),
        (
            2,
            [
                line(f1="2015-02-15 10:00:00", f2="2015-02-15 10:30:00"),
                line(f1="2014-12-31 23:00:00", f2="2014-12-31 23:30:00"),
                line(f1="2015-02-01 00:00:00", f2="2015-02-01 00:30:00"),
            ],
        ),
        (3, [line(f2="2015-01-10 08:00:00"), line(f2="2015-01-10 07:00:00")]),
        (4, [line(f2="2015-01-10 08:00:30"), line(f2="2015-01-10 11:01:00")]),
        (5, [line(f6="0.0", f5="0.0"), line(f6="42.0"), line(f6="NaN"), line(f5="-74.31")]),
        (6, [line(f4="0.0"), line(f4="150.0"), line(f4="-1"), line(f4="+Inf")]),
        (7, [line(f12="-5.00"), line(f18="0.00"), line(f12="-inf")]),
        (8, [line(f3="0"), line(f3="7"), line(f3="99999999999"), line(f3="-3")]),
        (9, [line(f4="99.9"), line(f4="0.001"), line(f4="nan")]),
    ],
)
def test_each_rule(spark, rule, records):
    assert codes(spark, records) == [rule] * len(records)


def test_limits_that_are_valid(spark):
    records = [
        line(f1="2015-01-01 00:00:00", f2="2015-01-01 00:20:00"),
        line(f1="2015-01-31 23:59:59", f2="2015-02-01 00:20:00"),
        line(f2="2015-01-10 08:01:00", f4="1.0"),
        line(f2="2015-01-10 11:00:00"),
        line(f6="40.5", f5="-74.3"),
        line(f6="41.0", f5="-73.7"),
        line(f3="1"),
        line(f3="6"),
        line(f12="NaN"),
        line(f12="Infinity"),
    ]
    assert codes(spark, records) == [0] * len(records)


def test_first_failure_wins(spark):
    assert codes(spark, [line(f1="2015-03-01 00:00:00", f3="0", f4="0"), line(f3="0", f4="0")]) == [
        2,
        6,
    ]


def test_number_and_time_spellings(spark):
    accepted = [
        line(f3="+2"),
        line(f3=" 2 "),
        line(f3="02"),
        line(f4=" 3.5\t"),
        line(f4="\u00a03.5\u2003"),
        line(f4="3."),
        line(f4="35e-1"),
        line(f4="3_5.0e-1"),
        line(f4="0x1.cp1"),
        line(f4="+3.5"),
        line(f1="2015-01-10 8:00:00"),
        line(f1="2015-01-10 08:00:00.123456789"),
        line(f1="2015-01-10   08:00:00"),
        line(f1=" 2015-01-10 08:00:00 "),
        line(f18="15.30 "),
    ]
    refused = [
        line(f3="2.0"),
        line(f3=""),
        line(f3="1_0"),
        line(f3="9223372036854775808"),
        line(f4="1d"),
        line(f4="1f"),
        line(f4="1e400"),
        line(f4="-1e400"),
        line(f4="3,5"),
        line(f4="3__5"),
        line(f4="0x1c"),
        line(f4="+nan"),
        line(f4='"3.5"'),
        line(f7="x"),
        line(f1="2015-01-10"),
        line(f1="2015-01-10T08:00:00"),
        line(f1="2015-01-10 08:00"),
        line(f1="2015-01-10 08:0:00"),
        line(f1="2015-01-10 24:00:00"),
        line(f1="2015-01-10 08:00:60"),
        line(f1="2015-02-30 08:00:00"),
        line(f1="2015-1-10 08:00:00"),
        line(f1="2015-01-10 08:00:00Z"),
        line(f1="2015-01-10\u00a008:00:00"),
        "   ",
    ]
    assert codes(spark, accepted) == [0] * len(accepted)
    assert codes(spark, refused) == [1] * len(refused)


def test_unused_fields_are_free(spark):
    assert codes(spark, [line(f0="", f8="a_b  c", f9="?", f17="")]) == [0]


def bad_lines(n):
    by_rule = [
        line() + ",extra",
        line(f1="2015-03-01 10:00:00", f2="2015-03-01 10:20:00"),
        line(f2="2015-01-10 08:00:00"),
        line(f2="2015-01-10 08:00:30"),
        line(f6="0.0", f5="0.0"),
        line(f4="0.0"),
        line(f12="-1.00"),
        line(f3="0"),
        line(f4="99.9"),
    ]
    return [bad for bad in by_rule for _ in range(n)]


def test_whole_file(spark, folder):
    path = write_lines(f"{folder}/a.csv", [line()] * 900 + bad_lines(10))
    report = jobs.timed_load_report(csv_lines.read_trips_csv(spark, path))
    assert (report["total"], report["valid"]) == (990, 900)
    assert [report[f"r{r}"] for r in range(1, 10)] == [10] * 9
    assert report["retention_pct"] == pytest.approx(900 / 990 * 100)
    assert report["rows_per_second"] > 0


def test_valid_only_file_has_zero_counts(spark, folder):
    path = write_lines(f"{folder}/a.csv", [line()] * 50)
    ruled = rules.with_rule(csv_lines.read_trips_csv(spark, path))
    assert {r.rule: r.n for r in rules.rule_counts(ruled).collect()} == dict.fromkeys(range(1, 10), 0)
    assert rules.load_report(ruled).head().valid == 50


def test_windows_line_ends_blank_lines_and_no_data(spark, folder):
    path = write_lines(f"{folder}/a.csv", [line(), "", line()], end="\r\n")
    report = rules.load_report(rules.with_rule(csv_lines.read_trips_csv(spark, path))).head()
    assert (report.total, report.valid, report.r1) == (3, 2, 1)
    path = write_lines(f"{folder}/b.csv", [])
    report = rules.load_report(rules.with_rule(csv_lines.read_trips_csv(spark, path))).head()
    assert (report.total, report.retention_pct) == (0, 0.0)


def test_every_file_has_its_header_and_repeats_are_rejected(spark, folder):
    write_lines(f"{folder}/a.csv", [line(), CSV_HEADER, line(), CSV_HEADER])
    write_lines(f"{folder}/b.csv", [line()])
    ruled = rules.with_rule(csv_lines.read_trips_csv(spark, folder))
    report = rules.load_report(ruled).head()
    assert (report.total, report.valid, report.r1) == (5, 3, 2)
    assert rules.rejects(ruled).count() == 2


def test_header_forms(spark, folder):
    names = CSV_HEADER.split(",")
    padded = ["VENDORID", f" {names[1].upper()} ", *names[2:]]
    assert csv_lines.header_positions(",".join(padded))["pickup_ts"] == 1
    assert csv_lines.header_positions(",".join(padded))["pickup_latitude"] == 6
    swapped = [*names]
    swapped[4], swapped[12] = swapped[12], swapped[4]
    path = write_lines(
        f"{folder}/a.csv", [line(f4="12.00", f12="3.5")], header=",".join(swapped)
    )
    assert rules.valid_trips(csv_lines.read_trips_csv(spark, path)).head().trip_distance == 3.5
    later = csv_lines.header_positions(CSV_HEADER + ",trip_distance")
    assert later["trip_distance"] == 19
    with pytest.raises(ValueError, match="fare_amount"):
        csv_lines.header_positions(CSV_HEADER.replace("fare_amount", "x"))


def test_missing_and_empty_sources(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_lines.read_trips_csv(spark, f"{folder}/none.csv")
    open(f"{folder}/empty.csv", "w").close()
    with pytest.raises(ValueError, match="header"):
        csv_lines.read_trips_csv(spark, f"{folder}/empty.csv")


@pytest.mark.parametrize("n", [0, 1, 3, 4, 7, 100])
def test_first_lines(spark, folder, n):
    """Lines count before validation; files are taken in path order."""
    for name, hours in (("a", "123"), ("b", "45"), ("c", "6")):
        rows = [line(f1=f"2015-01-0{h} 08:00:00", f2=f"2015-01-0{h} 08:20:00") for h in hours]
        write_lines(f"{folder}/{name}.csv", [*rows, ""])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        found = csv_lines.first_lines(spark, folder, n).where("not is_header")
        days = sorted(r.d for r in found.select(F.dayofmonth("pickup_ts").alias("d")).collect() if r.d)
        every = ["1", "2", "3", "", "4", "5", "", "6", ""]
        wanted = every if n == 0 else every[:n]
        assert days == [int(d) for d in wanted if d]
        assert found.count() == len(wanted)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rules_on_other_bounds(spark):
    from tripwright.schemas import Bounds

    frame = spark.createDataFrame([(line(f3="9"),)], "value string")
    records = csv_lines.parse_lines(frame, CSV_HEADER, False)
    wide = Bounds(max_passengers=9)
    assert rules.valid_trips(records).count() == 0
    assert rules.valid_trips(records, bounds=wide).count() == 1
    assert rules.with_rule(records, wide).head().rule == 0


def swapped(header_or_line):
    """The same fields with two columns in each other's place."""
    f = header_or_line.split(",")
    f[4], f[12] = f[12], f[4]
    return ",".join(f)


def test_each_file_has_its_own_header(spark, folder):
    rows = [line(f4="3.5"), line(f4="1.5"), "", line(f4="x")]
    write_lines(f"{folder}/a.csv", rows)
    with open(f"{folder}/b.csv", "w") as file:
        file.write("\n".join(swapped(x) if x else x for x in [CSV_HEADER, *rows, CSV_HEADER]) + "\n")
    one = rules.rule_counts(rules.with_rule(csv_lines.read_trips_csv(spark, f"{folder}/a.csv")))
    both = rules.with_rule(csv_lines.read_trips_csv(spark, folder))
    alone = {r.rule: r.n for r in one.collect()}
    # The second file's repeated header is one more rejected record.
    assert {r.rule: r.n for r in rules.rule_counts(both).collect()} == {
        rule: 2 * n + (rule == 1) for rule, n in alone.items()
    }
    trips = rules.valid_trips(csv_lines.read_trips_csv(spark, folder)).collect()
    assert sorted(t.trip_distance for t in trips) == [1.5, 1.5, 3.5, 3.5]


def test_a_file_without_a_required_column_is_named(spark, folder):
    write_lines(f"{folder}/good.csv", [line()])
    with open(f"{folder}/bad.csv", "w") as file:
        file.write(CSV_HEADER.replace("fare_amount", "fare") + "\n" + line() + "\n")
    with pytest.raises(ValueError, match="bad.csv.*fare_amount"):
        csv_lines.read_trips_csv(spark, folder)


@pytest.mark.parametrize("n", [1, 2, 5, 8])
def test_first_lines_do_not_depend_on_splits(spark, folder, n):
    for name in "ab":
        write_lines(f"{folder}/{name}.csv", [line(f4=f"{i}.25") for i in range(4)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        built = csv_lines.first_lines(spark, folder, n)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = sorted(r.trip_distance for r in built.where("not is_header").collect())
    assert found == sorted(([i + 0.25 for i in range(4)] * 2)[:n])
