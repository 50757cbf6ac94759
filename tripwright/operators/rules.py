"""Validation: nine ordered rules, the first one that fails names the reason."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripwright.functions.once import select_once
from tripwright.functions.trip import DAY_OF_WEEK, DURATION_MIN, HOUR_OF_DAY, SPEED_MPH
from tripwright.schemas import RAW_COLUMNS, RULES, TRIP_COLUMNS, Bounds


def _ntz(moment: datetime) -> str:
    return f"timestamp_ntz'{moment.isoformat(sep=' ')}'"


def rule_code(bounds: Bounds = Bounds()) -> str:
    """SQL ``CASE`` over the raw columns and ``duration_min``, evaluated in rule order.

    NaN sorts above every number in Spark: a NaN coordinate breaks rule 5, since it would poison
    every mean behind it, and a NaN distance is kept from rule 6 to break rule 9.
    """
    b = bounds
    unparsed = " or ".join(f"{c} is null" for c in RAW_COLUMNS)
    return f"""
        case when {unparsed} then 1
             when pickup_ts < {_ntz(b.pickup_from)} or pickup_ts >= {_ntz(b.pickup_before)} then 2
             when dropoff_ts <= pickup_ts then 3
             when duration_min < {b.min_minutes}D or duration_min > {b.max_minutes}D then 4
             when pickup_latitude < {b.min_latitude}D or pickup_latitude > {b.max_latitude}D
               or pickup_longitude < {b.min_longitude}D or pickup_longitude > {b.max_longitude}D
               then 5
             when not isnan(trip_distance)
              and (trip_distance <= 0D or trip_distance > {b.max_distance}D) then 6
             when fare_amount <= 0D or total_amount <= 0D then 7
             when passenger_count < {b.min_passengers} or passenger_count > {b.max_passengers}
               then 8
             when not ({SPEED_MPH} between {b.min_mph}D and {b.max_mph}D) then 9
             else 0 end"""


def with_rule(records: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Every record with its ``duration_min`` and its ``rule``: 0 if valid, else the first broken."""
    timed = records.selectExpr("*", f"{DURATION_MIN} as duration_min")
    return timed.selectExpr("*", f"{rule_code(bounds)} as rule")


def valid_trips(records: DataFrame, *keep: str, bounds: Bounds = Bounds()) -> DataFrame:
    """Records of rule 0 as trips, with any extra columns to keep.

    The rules are written as plain comparisons instead of the ``CASE`` of :func:`with_rule`, which
    no scan can use: a columnar source skips row groups outside the pickup range or bounding box.
    Rules on the duration come second, over a duration that is computed once.
    """
    b = bounds
    kept = [k for k in keep if k not in TRIP_COLUMNS]
    stored = [c for c in TRIP_COLUMNS if c in RAW_COLUMNS]
    parsed = " and ".join(f"{c} is not null" for c in RAW_COLUMNS)
    candidates = records.where(f"""
        {parsed}
        and pickup_ts >= {_ntz(b.pickup_from)} and pickup_ts < {_ntz(b.pickup_before)}
        and pickup_latitude >= {b.min_latitude}D and pickup_latitude <= {b.max_latitude}D
        and pickup_longitude >= {b.min_longitude}D and pickup_longitude <= {b.max_longitude}D
        and trip_distance > 0D and trip_distance <= {b.max_distance}D
        and fare_amount > 0D and total_amount > 0D
        and passenger_count >= {b.min_passengers} and passenger_count <= {b.max_passengers}
        and dropoff_ts > pickup_ts""")
    timed = select_once(candidates, [*kept, *stored], {"duration_min": DURATION_MIN})
    plausible = timed.where(f"""
        duration_min between {b.min_minutes}D and {b.max_minutes}D
        and {SPEED_MPH} between {b.min_mph}D and {b.max_mph}D""")
    return as_trips(plausible, *kept)


def as_trips(valid: DataFrame, *keep: str) -> DataFrame:
    """Valid records with their ``duration_min`` as trips, with any extra columns to keep."""
    kept = [k for k in keep if k not in TRIP_COLUMNS]
    derived = {"hour_of_day": HOUR_OF_DAY, "day_of_week": DAY_OF_WEEK}
    trip = [f"{derived[c]} as {c}" if c in derived else c for c in TRIP_COLUMNS]
    return valid.selectExpr(*kept, *trip)


def rejects(ruled: DataFrame) -> DataFrame:
    """Rejected records with their rule code.

    Of lines equal to the header, the first of each file is that file's header and no record. Only
    such lines are ranked, so the shuffle carries about one row per file.
    """
    failed = ruled.where("rule > 0")
    if "is_header" not in ruled.columns:
        return failed
    file = ["file_path"] if "file_path" in ruled.columns else []
    order = [c for c in ("file_block_start", "line_id") if c in ruled.columns] or ["value"]
    place = W.partitionBy(*file or [F.lit(0)]).orderBy(*order)
    repeated = (
        ruled.where("is_header")
        .withColumn("nth", F.row_number().over(place))
        .where("nth > 1")
        .drop("nth")
    )
    return failed.where("not is_header").unionByName(repeated).drop("is_header")


def rule_totals(ruled: DataFrame) -> DataFrame:
    """Records per rule code, valid ones under 0. At most ten rows, one pass.

    Each file's own header line is taken off the lines equal to the header, so repeats inside a
    file count as rejected records.
    """
    if "is_header" not in ruled.columns:
        return ruled.groupBy("rule").agg(F.count("*").alias("n"))
    file = "file_path" if "file_path" in ruled.columns else "'' as file_path"
    per_file = (
        ruled.selectExpr(file, "is_header", "rule")
        .groupBy("file_path", "is_header", "rule")
        .agg(F.count("*").alias("n"))
    )
    return (
        per_file.groupBy("rule")
        .agg(F.expr("sum(n - cast(is_header as bigint))").alias("n"))
        .where("n > 0")
    )


def rule_counts(ruled: DataFrame) -> DataFrame:
    """Discarded records per rule, 1..9, zeros kept."""
    every = ruled.sparkSession.range(RULES.start, RULES.stop, 1, 1).selectExpr("cast(id as int) rule")
    joined = every.join(rule_totals(ruled), "rule", "left")
    return joined.selectExpr("rule", "coalesce(n, 0) as n")


def load_report(ruled: DataFrame) -> DataFrame:
    """One row: records read, valid, retention percent, and a count per rule."""
    counts = [f"coalesce(sum(n) filter (where rule = {r}), 0) as r{r}" for r in RULES]
    totals = rule_totals(ruled).agg(
        F.expr("coalesce(sum(n), 0) as total"),
        F.expr("coalesce(sum(n) filter (where rule = 0), 0) as valid"),
        *[F.expr(c) for c in counts],
    )
    retention = "case when total > 0 then valid / total * 100 else 0D end as retention_pct"
    return totals.selectExpr("total", "valid", retention, *[f"r{r}" for r in RULES])
