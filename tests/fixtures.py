"""Records and trips the tests build."""

from __future__ import annotations

from datetime import datetime

from tripwright.schemas import TRIP
from tripwright.sources.lineitem_trips import CSV_HEADER

# Positions in the line.
PICKUP, DROPOFF, PASSENGERS, DISTANCE, LONGITUDE, LATITUDE, RATE = range(1, 8)
FARE, TOTAL = 12, 18


def fields(**changes: str) -> list[str]:
    line = (
        "1,2015-01-10 08:00:00,2015-01-10 08:20:00,2,3.5,-73.985,40.750,1,N,-73.960,40.760,1,"
        "12.00,0.50,0.50,2.00,0.00,0.30,15.30"
    ).split(",")
    for position, text in changes.items():
        line[int(position[1:])] = text
    return line


def line(**changes: str) -> str:
    """A valid record, with fields replaced by position: ``line(f4="0.0")``."""
    return ",".join(fields(**changes))


def write_lines(path: str, lines: list[str], header: str = CSV_HEADER, end: str = "\n") -> str:
    with open(path, "w", encoding="utf-8", newline="") as file:
        file.write(end.join([header, *lines]) + end)
    return path


def trip(
    minutes: float,
    distance: float,
    hour: int = 9,
    weekday: int = 1,
    latitude: float = 40.75,
    longitude: float = -73.98,
    rate_code: int = 1,
    passengers: int = 1,
) -> tuple:
    at = datetime(2015, 1, 10, hour)
    numbers = [float(v) for v in (minutes, distance, latitude, longitude)]
    return (at, *numbers, rate_code, passengers, hour, weekday)


def trips_frame(spark, rows, partitions: int = 4):
    return spark.createDataFrame(rows, TRIP).repartition(partitions)


def varied_trips(n: int) -> list[tuple]:
    return [
        trip(
            minutes=3.0 + i * 0.15,
            distance=1.0 + i * 0.05,
            hour=i % 24,
            weekday=i % 7,
            latitude=40.70 + (i % 10) * 0.01,
            longitude=-73.90 + (i % 10) * 0.01,
            rate_code=1 + i % 3,
            passengers=1 + i % 4,
        )
        for i in range(n)
    ]
