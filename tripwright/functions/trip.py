"""Derived columns of one trip record, as Spark SQL expressions over the trip columns."""

from __future__ import annotations

# --- Fixed values: weekday labels, Sunday first --------------------------------------------
WEEKDAY_NAMES = ["Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado"]
# --- end of fixed values -------------------------------------------------------------------

DURATION_BIN_MINUTES = 2.0
DURATION_BIN_LIMIT = 180.0
DISTANCE_BIN_MILES = 1.0
DISTANCE_BIN_LIMIT = 100.0

# Minutes between the two timestamps of a raw record, with fraction.
DURATION_MIN = "timestampdiff(MICROSECOND, pickup_ts, dropoff_ts) / 6e7D"
HOUR_OF_DAY = "hour(pickup_ts)"
# 0 = Sunday .. 6 = Saturday.
DAY_OF_WEEK = "dayofweek(pickup_ts) - 1"
# Null where the duration is zero.
SPEED_MPH = "try_divide(trip_distance, duration_min / 60D)"
# Null also for a negative duration: such trips have no part in mean speeds.
MOVING_MPH = f"case when duration_min > 0 then {SPEED_MPH} end"


def weekday_name(day: str) -> str:
    names = ", ".join(f"'{n}'" for n in WEEKDAY_NAMES)
    return f"element_at(array({names}), {day} + 1)"


def histogram_bin(value: str, size: float, limit: float) -> str:
    """Bin number by truncation toward zero; null outside 0 .. limit/size."""
    number = f"try_cast({value} / {size}D as int)"
    return f"case when {number} between 0 and {int(limit / size)} then {number} end"


DURATION_BIN = histogram_bin("duration_min", DURATION_BIN_MINUTES, DURATION_BIN_LIMIT)
DISTANCE_BIN = histogram_bin("trip_distance", DISTANCE_BIN_MILES, DISTANCE_BIN_LIMIT)


def grid_cell(degrees: str, grid: str = "truncate") -> str:
    """Cell number of a 0.01 degree grid: toward zero by default, ``floor`` for true cells."""
    if grid == "floor":
        return f"cast(floor({degrees} * 100D) as int)"
    if grid == "truncate":
        return f"cast({degrees} * 100D as int)"
    raise ValueError(f"unknown grid {grid!r}")


def cell_centre(cell: str) -> str:
    """Cell number back to degrees plus half a cell.

    With the default grid the centre of a negative cell lies one cell off; ``grid='floor'`` puts it
    right.
    """
    return f"{cell} / 100D + 0.005D"
