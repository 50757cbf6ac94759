"""Profile results as CSV reports and as insight tables.

Reports keep the fixed names, headers and decimals below. Results are small (at most 101 rows), so
each report is one sorted part file in a folder of its name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.functions import trip as P
from tripwright.functions.text import with_fixed_decimals
from tripwright.operators.profile import Profile
from tripwright.operators.train import loss_curve


def hour_report(profile: Profile) -> DataFrame:
    rows = profile.trips_by_hour().orderBy("hour_of_day")
    return rows.selectExpr("hour_of_day as hora", "n as viajes")


def weekday_report(profile: Profile) -> DataFrame:
    rows = profile.trips_by_weekday().orderBy("day_of_week")
    name = f"{P.weekday_name('day_of_week')} as nombre"
    return rows.selectExpr("day_of_week as dia", name, "n as viajes")


def duration_report(profile: Profile) -> DataFrame:
    """Empty bins are left out."""
    rows = profile.duration_histogram().orderBy("bin_start")
    rows = with_fixed_decimals(rows, {"bin_inicio_min": ("bin_start", 1)})
    return rows.selectExpr("bin_inicio_min", "n as conteo")


def distance_report(profile: Profile) -> DataFrame:
    """Empty bins are left out."""
    rows = profile.distance_histogram().orderBy("bin_start")
    rows = with_fixed_decimals(rows, {"bin_inicio_mi": ("bin_start", 1)})
    return rows.selectExpr("bin_inicio_mi", "n as conteo")


def speed_report(profile: Profile) -> DataFrame:
    rows = profile.speed_by_hour().orderBy("hour_of_day")
    rows = with_fixed_decimals(rows, {"velocidad_media_mph": ("mean_mph", 4)})
    return rows.selectExpr("hour_of_day as hora", "velocidad_media_mph")


def cells_report(profile: Profile) -> DataFrame:
    rows = profile.top_cells().orderBy(F.desc("n"), "lat_cell", "lon_cell")
    centres = {"lat_centro": ("lat_centre", 5), "lon_centro": ("lon_centre", 5)}
    return with_fixed_decimals(rows, centres).selectExpr(
        "lat_cell as lat_celda", "lon_cell as lon_celda", *centres, "n as conteo"
    )


# --- Fixed values: report and insight names ------------------------------------------------
NAMES = [
    "trips_por_hora",
    "trips_por_dia_semana",
    "histograma_duracion",
    "histograma_distancia",
    "velocidad_media_por_hora",
    "top_celdas_pickup",
]
# --- end of fixed values -------------------------------------------------------------------

_REPORTS = [
    hour_report, weekday_report, duration_report, distance_report, speed_report, cells_report
]
_INSIGHTS = [
    Profile.trips_by_hour,
    Profile.trips_by_weekday,
    lambda p: p.duration_histogram(dense=True),
    lambda p: p.distance_histogram(dense=True),
    Profile.speed_by_hour,
    lambda p: p.top_cells().select("lat_cell", "lon_cell", "n"),
]
REPORTS = dict(zip(NAMES, _REPORTS))
INSIGHTS = dict(zip(NAMES, _INSIGHTS))


def write_report(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_reports(profile: Profile, folder: str) -> None:
    """All six reports; the first failure stops the export."""
    for name, report in REPORTS.items():
        write_report(report(profile), f"{folder.rstrip('/')}/{name}.csv")


def insights(profile: Profile) -> dict[str, DataFrame]:
    """The six results as stored for reading by name: histograms keep their empty bins."""
    return {name: result(profile) for name, result in INSIGHTS.items()}


def loss_report(models: DataFrame) -> DataFrame:
    curve = loss_curve(models).orderBy("epoch")
    curve = with_fixed_decimals(curve, {"mse_train": ("mse", 6)})
    return curve.selectExpr("epoch as epoca", "mse_train")
