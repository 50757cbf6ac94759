"""Column names, types and fixed parameters shared by the whole package."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import types as T

# --- Fixed values: the headered CSV layout of a ride record ------------------------------
# Required header names (compared lower-cased and trimmed) -> typed column of this package.
REQUIRED_COLUMNS = {
    "tpep_pickup_datetime": "pickup_ts",
    "tpep_dropoff_datetime": "dropoff_ts",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "pickup_longitude": "pickup_longitude",
    "pickup_latitude": "pickup_latitude",
    "ratecodeid": "rate_code_id",
    "fare_amount": "fare_amount",
    "total_amount": "total_amount",
}
CSV_FIELD_COUNT = 19
# --- end of fixed values -----------------------------------------------------------------

RAW_TRIP = T.StructType(
    [
        T.StructField("pickup_ts", T.TimestampNTZType()),
        T.StructField("dropoff_ts", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("rate_code_id", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)
RAW_COLUMNS = RAW_TRIP.names

TRIP_COLUMNS = [
    "pickup_ts",
    "duration_min",
    "trip_distance",
    "pickup_latitude",
    "pickup_longitude",
    "rate_code_id",
    "passenger_count",
    "hour_of_day",
    "day_of_week",
]

TRIP = T.StructType(
    [
        T.StructField("pickup_ts", T.TimestampNTZType()),
        T.StructField("duration_min", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("rate_code_id", T.LongType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Bounds:
    """Limits of the validation rules; the defaults are the fixed values of the rule set."""

    pickup_from: datetime = datetime(2015, 1, 1)
    pickup_before: datetime = datetime(2015, 2, 1)
    min_minutes: float = 1.0
    max_minutes: float = 180.0
    min_latitude: float = 40.50
    max_latitude: float = 41.00
    min_longitude: float = -74.30
    max_longitude: float = -73.70
    max_distance: float = 100.0
    min_passengers: int = 1
    max_passengers: int = 6
    min_mph: float = 0.5
    max_mph: float = 80.0


RULES = range(1, 10)

# --- Fixed values: feature order of the linear model ---------------------------------------
FEATURE_NAMES = [
    "trip_distance",
    "sin_hour",
    "cos_hour",
    "is_weekend",
    "pickup_lat",
    "pickup_lon",
    "is_airport",
    "passenger_count",
]
BIAS_NAME = "bias"
MIN_STD = 1e-10
# --- end of fixed values -------------------------------------------------------------------

_doubles = T.ArrayType(T.DoubleType())

# Field names and order of the model document, as stored in JSON.
MODEL = T.StructType(
    [
        T.StructField("weights", _doubles),
        T.StructField("means", _doubles),
        T.StructField("stds", _doubles),
        T.StructField("feature_names", T.ArrayType(T.StringType())),
        T.StructField("epochs", T.IntegerType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("batch_size", T.IntegerType()),
        T.StructField("workers", T.IntegerType()),
        T.StructField("loss_history", _doubles),
        T.StructField("train_mae", T.DoubleType()),
        T.StructField("train_rmse", T.DoubleType()),
        T.StructField("train_r2", T.DoubleType()),
        T.StructField("test_mae", T.DoubleType()),
        T.StructField("test_rmse", T.DoubleType()),
        T.StructField("test_r2", T.DoubleType()),
    ]
)

MODEL_VERSION = T.StructType(
    [T.StructField("version", T.IntegerType())]
    + MODEL.fields
    + [T.StructField("nodes", T.IntegerType()), T.StructField("created_at", T.TimestampType())]
)

TRAINING_RUN = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("nodes", T.IntegerType()),
        T.StructField("loss_history", _doubles),
        T.StructField("dataset_file", T.StringType()),
        T.StructField("rows_used", T.LongType()),
    ]
)

ACTIVATION = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField("activated_at", T.TimestampType()),
    ]
)

SCORING_INPUT = T.StructType(
    [
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("hour", T.LongType()),
        T.StructField("day_of_week", T.LongType()),
        T.StructField("pickup_lat", T.DoubleType()),
        T.StructField("pickup_lon", T.DoubleType()),
        T.StructField("rate_code", T.LongType()),
        T.StructField("passenger_count", T.LongType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("input", SCORING_INPUT),
        T.StructField("duration_min", T.DoubleType()),
        T.StructField("model_version", T.IntegerType()),
        T.StructField("latency_ms", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
