"""Six aggregates over valid trips.

Each is available alone; :func:`profile` computes all of them in one scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions import trip as P

TOP_CELLS = 50
DURATION_BINS = int(P.DURATION_BIN_LIMIT / P.DURATION_BIN_MINUTES) + 1
DISTANCE_BINS = int(P.DISTANCE_BIN_LIMIT / P.DISTANCE_BIN_MILES) + 1


def _range(spark: SparkSession, key: str, size: int) -> DataFrame:
    return spark.range(0, size, 1, 1).selectExpr(f"cast(id as int) as {key}")


def _filled(counts: DataFrame, key: str, size: int) -> DataFrame:
    """Counts with a row for every key 0..size-1. Both sides have at most ``size`` rows."""
    every = _range(counts.sparkSession, key, size)
    return every.join(counts, key, "left").selectExpr(key, "coalesce(n, 0) as n")


def trips_by_hour(trips: DataFrame) -> DataFrame:
    return _filled(trips.groupBy("hour_of_day").agg(F.count("*").alias("n")), "hour_of_day", 24)


def trips_by_weekday(trips: DataFrame) -> DataFrame:
    counts = trips.groupBy("day_of_week").agg(F.count("*").alias("n"))
    return _filled(counts, "day_of_week", 7)


def duration_histogram(trips: DataFrame, dense: bool = False) -> DataFrame:
    """Trips per 2-minute bin; without ``dense`` only bins that hold any."""
    counts = trips.selectExpr(f"{P.DURATION_BIN} as bin").groupBy("bin").agg(F.count("*").alias("n"))
    return _histogram(counts, P.DURATION_BIN_MINUTES, DURATION_BINS, dense)


def distance_histogram(trips: DataFrame, dense: bool = False) -> DataFrame:
    """Trips per mile; without ``dense`` only bins that hold any."""
    counts = trips.selectExpr(f"{P.DISTANCE_BIN} as bin").groupBy("bin").agg(F.count("*").alias("n"))
    return _histogram(counts, P.DISTANCE_BIN_MILES, DISTANCE_BINS, dense)


def _histogram(counts: DataFrame, width: float, bins: int, dense: bool) -> DataFrame:
    counts = counts.where("bin is not null")
    if dense:
        counts = _filled(counts, "bin", bins)
    return counts.selectExpr(f"bin * {width}D as bin_start", "n")


def speed_by_hour(trips: DataFrame) -> DataFrame:
    """Unweighted mean of the trips' speeds per hour, 0 for an hour without trips."""
    means = trips.groupBy("hour_of_day").agg(F.expr(f"avg({P.MOVING_MPH}) as mph"))
    return _mean_filled(means)


def _mean_filled(means: DataFrame) -> DataFrame:
    every = _range(means.sparkSession, "hour_of_day", 24)
    return every.join(means, "hour_of_day", "left").selectExpr(
        "hour_of_day", "coalesce(mph, 0D) as mean_mph"
    )


def pickup_cells(trips: DataFrame, grid: str = "truncate") -> DataFrame:
    """Trips per cell of a 0.01 degree grid."""
    cells = trips.selectExpr(
        f"{P.grid_cell('pickup_latitude', grid)} as lat_cell",
        f"{P.grid_cell('pickup_longitude', grid)} as lon_cell",
    )
    return cells.groupBy("lat_cell", "lon_cell").agg(F.count("*").alias("n"))


def top_cells(cells: DataFrame, k: int = TOP_CELLS) -> DataFrame:
    """The k busiest cells; equal counts are ordered by cell number, so the cut is stable."""
    top = cells.orderBy(F.desc("n"), "lat_cell", "lon_cell").limit(k)
    return top.selectExpr(
        "lat_cell",
        "lon_cell",
        f"{P.cell_centre('lat_cell')} as lat_centre",
        f"{P.cell_centre('lon_cell')} as lon_centre",
        "n",
    )


def profile(trips: DataFrame, grid: str = "truncate") -> DataFrame:
    """All groupings of the six aggregates in one scan and one shuffle of small partial counts.

    Three grouping sets serve six aggregates: (hour, weekday) rolls up to trips and speed by hour
    and to trips by weekday, (duration bin, distance bin) to both histograms. So each trip is
    expanded three times and no trip is cached or read twice.
    """
    keyed = trips.selectExpr(
        "hour_of_day",
        "day_of_week",
        f"{P.DURATION_BIN} as duration_bin",
        f"{P.DISTANCE_BIN} as distance_bin",
        f"{P.grid_cell('pickup_latitude', grid)} as lat_cell",
        f"{P.grid_cell('pickup_longitude', grid)} as lon_cell",
        f"{P.MOVING_MPH} as mph",
    )
    keys = [F.col(c) for c in keyed.columns[:-1]]
    return keyed.groupingSets([keys[0:2], keys[2:4], keys[4:6]], *keys).agg(
        F.grouping_id().alias("grouping"),
        F.count("*").alias("n"),
        F.sum("mph").alias("mph_sum"),
        F.count("mph").alias("mph_n"),
    )


# grouping_id() has one bit per key, first key highest; a bit is 0 where the key is grouped by.
_BY_TIME, _BY_SIZE, _BY_CELL = 0b001111, 0b110011, 0b111100


class Profile:
    """The six results, rolled up from the rows of :func:`profile`.

    Those rows number at most a few ten thousand (168 hours of the week, 91 x 101 bins, the cells
    of the bounding box), whatever the number of trips.
    """

    def __init__(self, grouped: DataFrame):
        self._grouped = grouped

    def _part(self, grouping: int) -> DataFrame:
        return self._grouped.where(F.col("grouping") == grouping)

    def _count(self, grouping: int, key: str) -> DataFrame:
        return self._part(grouping).groupBy(key).agg(F.sum("n").alias("n"))

    def trips_by_hour(self) -> DataFrame:
        return _filled(self._count(_BY_TIME, "hour_of_day"), "hour_of_day", 24)

    def trips_by_weekday(self) -> DataFrame:
        return _filled(self._count(_BY_TIME, "day_of_week"), "day_of_week", 7)

    def duration_histogram(self, dense: bool = False) -> DataFrame:
        counts = self._count(_BY_SIZE, "duration_bin").withColumnRenamed("duration_bin", "bin")
        return _histogram(counts, P.DURATION_BIN_MINUTES, DURATION_BINS, dense)

    def distance_histogram(self, dense: bool = False) -> DataFrame:
        counts = self._count(_BY_SIZE, "distance_bin").withColumnRenamed("distance_bin", "bin")
        return _histogram(counts, P.DISTANCE_BIN_MILES, DISTANCE_BINS, dense)

    def speed_by_hour(self) -> DataFrame:
        mean = F.try_divide(F.sum("mph_sum"), F.sum("mph_n")).alias("mph")
        return _mean_filled(self._part(_BY_TIME).groupBy("hour_of_day").agg(mean))

    def top_cells(self, k: int = TOP_CELLS) -> DataFrame:
        return top_cells(self._part(_BY_CELL).select("lat_cell", "lon_cell", "n"), k)


@contextmanager
def profiled(trips: DataFrame, grid: str = "truncate") -> Iterator[Profile]:
    """Profile whose grouped rows are computed once and shared by the results read inside."""
    grouped = profile(trips, grid).persist()
    try:
        yield Profile(grouped)
    finally:
        grouped.unpersist()


def profile_long(trips: DataFrame) -> DataFrame:
    """The five count groupings as one tall table: metric, key, second key, count.

    Each grouped row turns into its two metrics by ``explode``, so the scan is not repeated.
    """
    def entry(metric: str, k1: str, k2: str = "cast(null as int)") -> str:
        return f"named_struct('metric', '{metric}', 'k1', {k1}, 'k2', {k2}, 'n', n)"

    by_time = f"{entry('hour', 'hour_of_day')}, {entry('weekday', 'day_of_week')}"
    by_size = f"{entry('duration', 'duration_bin')}, {entry('distance', 'distance_bin')}"
    entries = f"""
        case grouping when {_BY_TIME} then array({by_time})
                      when {_BY_SIZE} then array({by_size})
                      else array({entry('cell', 'lat_cell', 'lon_cell')}) end"""
    tall = profile(trips).selectExpr(f"inline({entries})").where("k1 is not null")
    return tall.groupBy("metric", "k1", "k2").agg(F.sum("n").alias("n"))
