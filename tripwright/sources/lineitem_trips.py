"""Ride-shaped records derived from a ``lineitem`` table, for tables that hold no rides.

Deterministic integer arithmetic on the keys, so another engine can build the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions.once import select_once
from tripwright.schemas import REQUIRED_COLUMNS

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]

_PICKUP_S = "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 1299709) % 2851200"
_DURATION_S = "(l_orderkey * 31 + l_partkey * 577 + l_suppkey * 7919) % 11200 - 100"
_EPOCH = "timestamp_ntz'2014-12-31 00:00:00'"

_COLUMNS = {
    "pickup_ts": f"timestampadd(SECOND, {_PICKUP_S}, {_EPOCH})",
    "dropoff_ts": f"timestampadd(SECOND, {_PICKUP_S} + {_DURATION_S}, {_EPOCH})",
    "passenger_count": """
        case when cast(l_quantity as int) = 13 then null
             else (l_orderkey + l_linenumber) % 8 end""",
    "trip_distance": """
        cast((l_partkey * 13 + l_linenumber * 101 + cast(l_quantity as int) * 37) % 2600 - 50
             as double) / cast(100 as double)""",
    "pickup_longitude": """
        cast(-74310 + (l_partkey * 11 + l_suppkey * 53) % 620 as double) / cast(1000 as double)""",
    "pickup_latitude": """
        cast(40480 + (l_suppkey * 37 + l_partkey * 7) % 530 as double) / cast(1000 as double)""",
    "rate_code_id": "1 + (l_partkey + l_linenumber) % 6",
    "fare_amount": "l_extendedprice",
    "total_amount": """
        l_extendedprice * (cast(1 as double) - l_discount)
        - cast(cast(l_quantity as int) = 50 as int) * cast(200000 as double)""",
}


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Unvalidated trip records; the four key columns stay as a total order."""
    return select_once(lineitem, KEYS, _COLUMNS)


def trip_id() -> Column:
    return F.concat_ws("-", *KEYS)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    return trips_from_lineitem(spark.read.parquet(f"{folder}/lineitem.parquet"))


# --- Fixed values: header of a full record ---------------------------------------------------
CSV_HEADER = (
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,"
    "pickup_longitude,pickup_latitude,RateCodeID,store_and_fwd_flag,dropoff_longitude,"
    "dropoff_latitude,payment_type,fare_amount,extra,mta_tax,tip_amount,tolls_amount,"
    "improvement_surcharge,total_amount"
)
# --- end of fixed values ---------------------------------------------------------------------


def write_csv(records: DataFrame, path: str) -> None:
    """The same records as a folder of headered CSV files, to feed the text source."""
    fields = _fields(records)
    records.select(*fields).write.option("header", True).option("emptyValue", "").csv(path)


#: What ``write_dirty_csv`` does to a line, by ``l_orderkey % 16``; other lines stay as they are.
REJECTED_AS = {0: "a field more", 1: "a field less", 2: "blank", 3: "the header again", 4: "1e400", 5: "1d"}


def write_dirty_csv(records: DataFrame, path: str, swapped: bool = False) -> None:
    """The records as CSV lines of which some are damaged, in ways that reject them or do not.

    ``swapped`` writes distance and total in each other's place, in lines and header.
    """
    fields = _fields(records)
    names = CSV_HEADER.split(",")
    if swapped:
        a, b = names.index("trip_distance"), names.index("total_amount")
        names[a], names[b], fields[a], fields[b] = names[b], names[a], fields[b], fields[a]
    header = ",".join(names)
    texts = [F.coalesce(f, F.lit("")) for f in fields]
    fare = names.index("fare_amount")

    def line(value: str | None = None) -> Column:
        return F.concat_ws(",", *[F.lit(value) if value and i == fare else t for i, t in enumerate(texts)])

    kind = F.col("l_orderkey") % 16
    dirty = (
        F.when(kind == 0, F.concat(line(), F.lit(",x")))
        .when(kind == 1, F.concat_ws(",", *texts[:-1]))
        .when(kind == 2, " ")
        .when(kind == 3, header)
        .when(kind == 4, line("1e400"))
        .when(kind == 5, line("1d"))
        .otherwise(line())
    )
    # One column that no character cuts or quotes: its name becomes the header line.
    writer = records.select(dirty.alias(header)).write.option("header", True)
    writer = writer.option("sep", "\u0001").option("quote", "\u0002").option("escapeQuotes", False)
    writer = writer.option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False)
    writer.option("emptyValue", "").option("quoteAll", False).mode("append").csv(path)


def _fields(records: DataFrame) -> list[Column]:
    """The fields of a CSV line, as text, in the order of the header."""
    columns = {
        "tpep_pickup_datetime": F.date_format("pickup_ts", "yyyy-MM-dd HH:mm:ss"),
        "tpep_dropoff_datetime": F.date_format("dropoff_ts", "yyyy-MM-dd HH:mm:ss"),
    }
    for name, column in REQUIRED_COLUMNS.items():
        columns.setdefault(name, F.col(column).cast("string"))
    return [
        columns.get(name.lower(), F.lit("0")).alias(name) for name in CSV_HEADER.split(",")
    ]
