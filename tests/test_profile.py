import pytest
from fixtures import trip, trips_frame, varied_trips
from pyspark.sql import functions as F

from tripwright.operators import profile as P
from tripwright.plans import exports


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def trips(spark):
    return trips_frame(spark, varied_trips(500)).persist()


def test_counts_against_plain_python(spark, trips):
    made = varied_trips(500)
    by_hour = {h: sum(t[7] == h for t in made) for h in range(24)}
    assert rows(P.trips_by_hour(trips)) == sorted(by_hour.items())
    by_day = {d: sum(t[8] == d for t in made) for d in range(7)}
    assert rows(P.trips_by_weekday(trips)) == sorted(by_day.items())
    bins = {}
    for t in made:
        bins[int(t[1] / 2) * 2.0] = bins.get(int(t[1] / 2) * 2.0, 0) + 1
    assert rows(P.duration_histogram(trips)) == sorted(bins.items())
    cells = {}
    for t in made:
        cell = (int(t[3] * 100), int(t[4] * 100))
        cells[cell] = cells.get(cell, 0) + 1
    assert {(r.lat_cell, r.lon_cell): r.n for r in P.pickup_cells(trips).collect()} == cells
    for row in P.speed_by_hour(trips).collect():
        speeds = [t[2] / (t[1] / 60) for t in made if t[7] == row.hour_of_day]
        assert row.mean_mph == pytest.approx(sum(speeds) / len(speeds), rel=1e-12)


def test_one_pass_equals_six_passes(trips):
    with P.profiled(trips) as p:
        assert rows(p.trips_by_hour()) == rows(P.trips_by_hour(trips))
        assert rows(p.trips_by_weekday()) == rows(P.trips_by_weekday(trips))
        for dense in (False, True):
            assert rows(p.duration_histogram(dense)) == rows(P.duration_histogram(trips, dense))
            assert rows(p.distance_histogram(dense)) == rows(P.distance_histogram(trips, dense))
        assert rows(p.top_cells()) == rows(P.top_cells(P.pickup_cells(trips)))
        mine, alone = rows(p.speed_by_hour()), rows(P.speed_by_hour(trips))
        assert [h for h, _ in mine] == [h for h, _ in alone]
        assert [m for _, m in mine] == pytest.approx([m for _, m in alone], rel=1e-12)


def test_totals_and_partitioning(trips):
    totals = P.profile_long(trips).groupBy("metric").agg(F.sum("n").alias("n")).collect()
    assert {r.n for r in totals} == {500} and len(totals) == 5
    assert rows(P.profile_long(trips.repartition(1))) == rows(P.profile_long(trips.repartition(13)))


def test_empty_and_edge_trips(spark):
    none = trips_frame(spark, [])
    assert {r.n for r in P.trips_by_hour(none).collect()} == {0}
    assert P.trips_by_hour(none).count() == 24
    assert {r.mean_mph for r in P.speed_by_hour(none).collect()} == {0.0}
    assert P.duration_histogram(none).count() == 0
    assert P.duration_histogram(none, dense=True).count() == 91
    assert P.distance_histogram(none, dense=True).count() == 101
    edge = trips_frame(
        spark,
        [
            trip(180.0, 100.0),
            trip(181.9, 100.9),
            trip(182.0, 101.0),
            trip(0.0, -0.5),
            trip(-2.0, -1.0),
            trip(float("nan"), float("inf")),
        ],
    )
    assert rows(P.duration_histogram(edge)) == [(0.0, 1), (180.0, 2)]
    assert rows(P.distance_histogram(edge)) == [(0.0, 1), (100.0, 2)]


def test_grids_and_ties(spark):
    here = trips_frame(spark, [trip(10, 1, latitude=40.755, longitude=-73.985)] * 3)
    cut, true = (P.top_cells(P.pickup_cells(here, g)).head() for g in ("truncate", "floor"))
    assert (cut.lat_cell, cut.lon_cell, cut.n) == (4075, -7398, 3)
    assert (true.lat_cell, true.lon_cell) == (4075, -7399)
    assert cut.lon_centre == pytest.approx(-73.975) and true.lon_centre == pytest.approx(-73.985)
    with pytest.raises(ValueError):
        P.pickup_cells(here, "hex")
    spread = trips_frame(spark, [trip(10, 1, latitude=40.0 + i / 50) for i in range(80)])
    top = P.top_cells(P.pickup_cells(spread)).collect()
    assert len(top) == 50
    assert [r.lat_cell for r in top] == sorted(r.lat_cell for r in top)


def test_report_files(spark, trips, folder):
    with P.profiled(trips) as p:
        exports.export_reports(p, folder)
        insights = exports.insights(p)
        assert insights["histograma_duracion"].count() == 91
        assert insights["histograma_distancia"].count() == 101
        assert insights["top_celdas_pickup"].columns == ["lat_cell", "lon_cell", "n"]
        assert "name" not in insights["trips_por_dia_semana"].columns

    def lines(name):
        return [r.value for r in spark.read.text(f"{folder}/{name}.csv").collect()]

    assert lines("trips_por_hora")[:2] == ["hora,viajes", "0,21"]
    assert len(lines("trips_por_hora")) == 25
    assert lines("trips_por_dia_semana")[0] == "dia,nombre,viajes"
    assert lines("trips_por_dia_semana")[4].startswith("3,Miércoles,")
    assert lines("histograma_duracion")[:2] == ["bin_inicio_min,conteo", "2.0,7"]
    assert lines("histograma_distancia")[:2] == ["bin_inicio_mi,conteo", "1.0,20"]
    assert lines("velocidad_media_por_hora")[0] == "hora,velocidad_media_mph"
    assert all(len(v.split(".")[1]) == 4 for v in lines("velocidad_media_por_hora")[1:])
    assert lines("top_celdas_pickup")[0] == "lat_celda,lon_celda,lat_centro,lon_centro,conteo"
