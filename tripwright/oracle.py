"""The catalog's queries as SQL for another engine, written from the definitions alone."""

from __future__ import annotations

from tripwright.schemas import FEATURE_NAMES
from tripwright.sources.lineitem_trips import KEYS

_K = ", ".join(KEYS)
_N = len(FEATURE_NAMES)

# Parameters of a model that is not fitted, for queries about scoring alone.
FIXED_MODEL = {
    "weights": [3.25, -0.5, 0.75, -1.5, 0.25, -0.125, 4.0, 0.0625, 21.5],
    "means": [12.5, 0.0, 0.0, 0.25, 40.75, -74.0, 0.375, 3.5],
    "stds": [7.0, 0.75, 0.75, 0.5, 0.125, 0.1875, 0.5, 1.75],
}

_TRIPS = f"""
raw as (
  select *, (l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 1299709) % 2851200 as p_s,
         (l_orderkey * 31 + l_partkey * 577 + l_suppkey * 7919) % 11200 - 100 as d_s,
         cast(l_quantity as int) as q
  from lineitem),
records as (
  select {_K},
    timestamp '2014-12-31 00:00:00' + to_seconds(p_s) as pickup_ts,
    timestamp '2014-12-31 00:00:00' + to_seconds(p_s + d_s) as dropoff_ts,
    case when q = 13 then null else (l_orderkey + l_linenumber) % 8 end as passenger_count,
    cast((l_partkey * 13 + l_linenumber * 101 + q * 37) % 2600 - 50 as double)
      / cast(100 as double) as trip_distance,
    cast(-74310 + (l_partkey * 11 + l_suppkey * 53) % 620 as double)
      / cast(1000 as double) as pickup_longitude,
    cast(40480 + (l_suppkey * 37 + l_partkey * 7) % 530 as double)
      / cast(1000 as double) as pickup_latitude,
    1 + (l_partkey + l_linenumber) % 6 as rate_code_id,
    l_extendedprice as fare_amount,
    l_extendedprice * (cast(1 as double) - l_discount)
      - cast(cast(q = 50 as int) as double) * cast(200000 as double) as total_amount
  from raw),
timed as (
  select *, (epoch_us(dropoff_ts) - epoch_us(pickup_ts))::double / 60000000::double as duration_min
  from records),
ruled as (
  select *, cast(case
      when passenger_count is null then 1
      when pickup_ts < timestamp '2015-01-01' or pickup_ts >= timestamp '2015-02-01' then 2
      when dropoff_ts <= pickup_ts then 3
      when duration_min < 1 or duration_min > 180 then 4
      when pickup_latitude < 40.5::double or pickup_latitude > 41::double
        or pickup_longitude < -74.3::double or pickup_longitude > -73.7::double then 5
      when trip_distance <= 0 or trip_distance > 100 then 6
      when fare_amount <= 0 or total_amount <= 0 then 7
      when passenger_count < 1 or passenger_count > 6 then 8
      when trip_distance / (duration_min / 60::double) < 0.5::double
        or trip_distance / (duration_min / 60::double) > 80::double then 9
      else 0 end as int) as rule
  from timed),
trips as (
  select {_K}, pickup_ts, duration_min, trip_distance, pickup_latitude, pickup_longitude,
         rate_code_id, passenger_count, cast(hour(pickup_ts) as int) as hour_of_day,
         cast(dayofweek(pickup_ts) as int) as day_of_week,
         trip_distance / (duration_min / 60::double) as mph,
         concat_ws('-', {_K}) as trip_id
  from ruled where rule = 0)"""

_RAW = [
    "trip_distance",
    "sin(2 * pi() * hour_of_day / 24)",
    "cos(2 * pi() * hour_of_day / 24)",
    "cast(day_of_week in (0, 6) as double)",
    "pickup_latitude",
    "pickup_longitude",
    "cast(rate_code_id in (2, 3) as double)",
    "cast(passenger_count as double)",
]

_FEATURES = f"""
features as (
  select {_K}, pickup_ts, duration_min as y, trip_distance, mph,
         {", ".join(f"{e} as f{j}" for j, e in enumerate(_RAW))},
         ('0x' || substr(md5(concat('42:', trip_id)), 1, 8))::bigint < 3435973836 as is_train
  from trips)"""


def _scaled(train: str = "is_train", source: str = "features") -> str:
    stats = ", ".join(f"avg(f{j}) as m{j}, stddev_pop(f{j}) as s{j}" for j in range(_N))
    scaled = ", ".join(f"(f{j} - m{j}) / s{j} as x{j}" for j in range(_N))
    return f"""
scaler as materialized (select {stats} from {source} where {train}),
scaled as materialized (select {source}.*, {scaled}, 1::double as x8 from {source}, scaler)"""


def _gram(train: str = "is_train") -> str:
    sums = [f"sum(x{i} * x{j}) / count(*) as g{i}{j}" for i in range(9) for j in range(i, 9)]
    sums += [f"sum(x{i} * y) / count(*) as b{i}" for i in range(9)]
    return f"""
gram as materialized (
  select count(*) as n, {", ".join(sums)}, sum(y * y) / count(*) as yy from scaled where {train})"""


def _g(i: int, j: int) -> str:
    return f"g{min(i, j)}{max(i, j)}"


def _descent(epochs: int, rate: float = 0.05) -> str:
    """theta(epoch, w0..w8): full-batch gradient descent on the Gram matrix."""
    steps = []
    for i in range(9):
        product = " + ".join(f"{_g(i, j)} * w{j}" for j in range(9))
        steps.append(f"w{i} - {rate}::double * ({product} - b{i})")
    zero = ", ".join(f"0::double as w{i}" for i in range(9))
    return f"""
theta as (
  select 0 as epoch, {zero}
  union all
  select epoch + 1, {", ".join(steps)} from theta, gram where epoch < {epochs})"""


def _mse() -> str:
    quadratic = " + ".join(f"{_g(i, j)} * w{i} * w{j}" for i in range(9) for j in range(9))
    linear = " + ".join(f"b{i} * w{i}" for i in range(9))
    return f"{quadratic} - 2 * ({linear}) + yy"


def _r(sql: str, digits: int = 6, name: str | None = None) -> str:
    return f"floor(({sql}) * 1e{digits}::double + 0.5::double) / 1e{digits}::double as {name or sql}"


def _weights(epochs: int, extra: str = "") -> str:
    rows = " union all ".join(
        f"select {extra}{i} as j, {_r(f'w{i}', 6, 'weight')} from theta where epoch = {epochs}"
        for i in range(9)
    )
    return f"with recursive {_TRIPS}, {_FEATURES}, {_scaled()}, {_gram()}, {_descent(epochs)} {rows}"


def _metrics(error: str, y: str = "y") -> str:
    spread = f"(count(*) * var_pop({y}))"
    return ", ".join(
        [
            _r(f"avg(abs({error}))", 6, "mae"),
            _r(f"sqrt(avg(({error}) * ({error})))", 6, "rmse"),
            _r(f"1 - sum(({error}) * ({error})) / {spread}", 6, "r2"),
        ]
    )


def _fixed_prediction(features: list[str] | None = None) -> str:
    m = FIXED_MODEL
    terms = [
        f"(({f}) - ({mean})::double) / {std}::double * ({w})::double"
        for f, mean, std, w in zip(features or _RAW, m["means"], m["stds"], m["weights"])
    ]
    return " + ".join([*terms, f"({m['weights'][8]})::double"])


_HOURS = "(select cast(range as int) as hour_of_day from range(24))"
_DAYS = "(select cast(range as int) as day_of_week from range(7))"
_NAMES = "['Domingo', 'Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado']"
_DUR_BIN = "cast(floor(duration_min / 2) as int)"
_DIST_BIN = "cast(floor(trip_distance) as int)"
_CELL = "cast(trunc(pickup_latitude * 100) as int), cast(trunc(pickup_longitude * 100) as int)"

_BY_HOUR = f"""
by_hour as (
  select hour_of_day, coalesce(n, 0) as n, coalesce(mph, 0) as mean_mph
  from {_HOURS} left join
    (select hour_of_day, count(*) as n, avg(mph) as mph from trips group by 1) using (hour_of_day)),
by_day as (
  select day_of_week, coalesce(n, 0) as n
  from {_DAYS} left join
    (select day_of_week, count(*) as n from trips group by 1) using (day_of_week)),
by_duration as (
  select cast(range as int) as bin, coalesce(n, 0) as n from range(91) left join
    (select {_DUR_BIN} as range, count(*) as n from trips group by 1) using (range)),
by_distance as (
  select cast(range as int) as bin, coalesce(n, 0) as n from range(101) left join
    (select {_DIST_BIN} as range, count(*) as n from trips group by 1) using (range)),
cells as (
  select lat_cell, lon_cell, count(*) as n
  from (select cast(trunc(pickup_latitude * 100) as int) as lat_cell,
               cast(trunc(pickup_longitude * 100) as int) as lon_cell from trips)
  group by all order by n desc, lat_cell, lon_cell limit 50)"""


def _top_cells(to_int: str) -> str:
    lat, lon = (f"cast({to_int}(pickup_{d} * 100) as int)" for d in ("latitude", "longitude"))
    return f"""with {_TRIPS}
select lat_cell, lon_cell, {_r("lat_cell / 100::double + 0.005::double", 6, "lat_centre")},
       {_r("lon_cell / 100::double + 0.005::double", 6, "lon_centre")}, n
from (select {lat} as lat_cell, {lon} as lon_cell, count(*) as n from trips group by all
      order by n desc, lat_cell, lon_cell limit 50)"""


_COARSE = """
requests as (
  select l_orderkey * 8 + l_linenumber as request_id,
    cast(l_partkey % 40 as double)
      + cast((l_orderkey + l_linenumber) % 400 as double) / 1000000::double as trip_distance,
    cast(l_linenumber as bigint) as hour, l_partkey % 7 as day_of_week,
    cast(405 + l_partkey % 5 as double) / 10::double as pickup_lat,
    -cast(737 + l_partkey % 4 as double) / 10::double as pickup_lon,
    l_partkey % 4 as rate_code, greatest(l_partkey % 3, 1) as passenger_count
  from lineitem)"""

_REQUEST_FEATURES = [
    "trip_distance",
    "sin(2 * pi() * hour / 24)",
    "cos(2 * pi() * hour / 24)",
    "cast(day_of_week in (0, 6) as double)",
    "pickup_lat",
    "pickup_lon",
    "cast(rate_code in (2, 3) as double)",
    "cast(passenger_count as double)",
]

_KEY = """concat_ws(':', printf('%.3f', trip_distance), hour, day_of_week,
  printf('%.4f', pickup_lat), printf('%.4f', pickup_lon), rate_code, passenger_count)"""

_ANSWERS = f"""
keyed as (select *, {_KEY} as cache_key, {_fixed_prediction(_REQUEST_FEATURES)} as own
          from requests),
firsts as (select cache_key, min(request_id) as first_id, arg_min(own, request_id) as answer
           from keyed group by 1),
answers as (select keyed.*, answer, request_id <> first_id as cached
            from keyed join firsts using (cache_key))"""

_MEMO = f"""with {_COARSE}, {_ANSWERS}
select request_id, cache_key, {_r("answer", 6, "duration_min")},
       case when cached then -1 else 3 end as model_version, cached from answers"""

_BY_TIME = f"""with recursive {_COARSE},
keyed as (select *, {_KEY} as cache_key, {_fixed_prediction(_REQUEST_FEATURES)} as own,
                 request_id // 20 as arrived from requests),
entries as (
  select cache_key, min(arrived) as arrived from keyed group by 1
  union all
  select k.cache_key, min(k.arrived) from entries e
  join keyed k on k.cache_key = e.cache_key and k.arrived > e.arrived + 300 group by k.cache_key, e.arrived),
made as (select cache_key, arrived, min(request_id) as first_id, arg_min(own, request_id) as answer
         from keyed join entries using (cache_key, arrived) group by 1, 2)
select request_id, k.cache_key, {_r("answer", 6, "duration_min")},
       case when request_id <> first_id then -1 else 3 end as model_version,
       request_id <> first_id as cached
from keyed k join made m on m.cache_key = k.cache_key and k.arrived between m.arrived and m.arrived + 300"""

_NEWEST = """
newest as (
  select event_type, event_id, ts, value from events
  qualify row_number() over (partition by event_type order by ts desc, event_id desc) <= 200)"""

_PERCENTILES = f"""with {_NEWEST},
ranked as (select event_type, value, count(*) over (partition by event_type) as n,
                  row_number() over (partition by event_type order by value, event_id) - 1 as pos
           from newest)
select event_type, min(value) filter (where pos = n // 2) as p50,
       min(value) filter (where pos = cast(floor(n * 0.95::double) as bigint)) as p95
from ranked group by 1"""


def _split_models() -> str:
    """Metrics of 10-epoch weights on the ordered split."""
    ordered = f"""
features as (
  select *, row_number() over (order by pickup_ts, {_K})
            <= cast(floor(count(*) over () * 0.8::double) as bigint) as is_train
  from (select {_K}, pickup_ts, duration_min as y, trip_distance, mph,
               {", ".join(f"{e} as f{j}" for j, e in enumerate(_RAW))} from trips))"""
    predicted = " + ".join(f"x{j} * w{j}" for j in range(9))

    def of(part: str, condition: str) -> str:
        e = "(p - y)"
        spread = "(count(*) * var_pop(y))"
        return f"""(select {_r(f"avg(abs({e}))", 5, f"{part}_mae")},
          {_r(f"sqrt(avg({e} * {e}))", 5, f"{part}_rmse")},
          {_r(f"1 - sum({e} * {e}) / {spread}", 5, f"{part}_r2")}
          from predicted where {condition})"""

    return f"""with recursive {_TRIPS}, {ordered}, {_scaled()}, {_gram()}, {_descent(10)},
predicted as (select y, is_train, {predicted} as p from scaled, theta where epoch = 10)
select 1 as version, 3 as nodes, 'lineitem' as dataset_file,
       (select count(*) from trips) as rows_used, *
from {of("train", "is_train")}, {of("test", "not is_train")}"""


def queries() -> dict[str, str]:
    rule_counts = f"""with {_TRIPS}
select cast(range as int) as rule, coalesce(n, 0) as n from range(1, 10)
left join (select rule as range, count(*) as n from ruled group by 1) using (range)"""
    trips = f"with {_TRIPS} "
    featured = f"with {_TRIPS}, {_FEATURES} "
    scaled = f"with {_TRIPS}, {_FEATURES}, {_scaled()} "
    profiled = f"with {_TRIPS}, {_BY_HOUR} "
    fixed_error = " + ".join(
        f"x{j} * ({w})::double" for j, w in enumerate(FIXED_MODEL["weights"])
    )
    test_error = {
        "mean": "(select avg(y) from features where is_train) - y",
        "speed": "trip_distance / (select avg(mph) from features where is_train) * 60::double - y",
    }
    trip_columns = """pickup_ts, duration_min, trip_distance, pickup_latitude, pickup_longitude,
      rate_code_id, passenger_count, hour_of_day, day_of_week"""
    predicted = " + ".join(f"x{j} * w{j}" for j in range(9))

    def table_row(label: str, error: str, source: str) -> str:
        spread = "(count(*) * var_pop(y))"
        return f"""select '{label}' as model, round(avg(abs({error})), 2) as mae,
          round(sqrt(avg(({error}) * ({error}))), 2) as rmse,
          round(1 - sum(({error}) * ({error})) / {spread}, 4) as r2 from {source}"""

    report_lines = [
        ("trips_por_hora", "hora,viajes", "concat_ws(',', hour_of_day, n)", "by_hour"),
        (
            "trips_por_dia_semana",
            "dia,nombre,viajes",
            f"concat_ws(',', day_of_week, {_NAMES}[day_of_week + 1], n)",
            "by_day",
        ),
        (
            "histograma_duracion",
            "bin_inicio_min,conteo",
            "concat_ws(',', printf('%.1f', bin * 2::double), n)",
            "by_duration where n > 0",
        ),
        (
            "histograma_distancia",
            "bin_inicio_mi,conteo",
            "concat_ws(',', printf('%.1f', bin::double), n)",
            "by_distance where n > 0",
        ),
        (
            "velocidad_media_por_hora",
            "hora,velocidad_media_mph",
            "concat_ws(',', hour_of_day, printf('%.4f', mean_mph))",
            "by_hour",
        ),
        (
            "top_celdas_pickup",
            "lat_celda,lon_celda,lat_centro,lon_centro,conteo",
            """concat_ws(',', lat_cell, lon_cell,
                 printf('%.5f', lat_cell / 100::double + 0.005::double),
                 printf('%.5f', lon_cell / 100::double + 0.005::double), n)""",
            "cells",
        ),
    ]
    reports = " union all ".join(
        f"select '{name}' as report, '{header}' as value"
        f" union all select '{name}', {line} from {source}"
        for name, header, line, source in report_lines
    )
    insight = "cast({} as double) as k1, cast({} as double) as k2, "
    insight_parts = [
        ("trips_por_hora", "hour_of_day", "null", "n", "by_hour"),
        ("trips_por_dia_semana", "day_of_week", "null", "n", "by_day"),
        ("histograma_duracion", "bin * 2", "null", "n", "by_duration"),
        ("histograma_distancia", "bin", "null", "n", "by_distance"),
        ("velocidad_media_por_hora", "hour_of_day", "null", "mean_mph", "by_hour"),
        ("top_celdas_pickup", "lat_cell", "lon_cell", "n", "cells"),
    ]
    insights = " union all ".join(
        f"select '{name}' as name, {insight.format(k1, k2)}"
        f"{_r(f'cast({value} as double)', 6, 'value')} from {source}"
        for name, k1, k2, value, source in insight_parts
    )
    gram_rows = " union all ".join(
        [
            f"select {i} as i, {j} as j, {_r(_g(i, j), 6, 'mean_value')} from gram"
            for i in range(9)
            for j in range(i, 9)
        ]
        + [f"select {i}, 9, {_r(f'b{i}', 6, 'mean_value')} from gram" for i in range(9)]
        + [f"select 9, 9, {_r('yy', 6, 'mean_value')} from gram"]
    )
    losses = f"with recursive {_TRIPS}, {_FEATURES}, {_scaled()}, {_gram()}, "
    text_requests = f"""with {_TRIPS},
requests as (
  select {_K}, trip_distance / 8::double as trip_distance,
    case when l_linenumber = 7 then 'trip_distance: missing value' end as error,
    hour(pickup_ts) as hour,
    case when l_linenumber = 6 then 0 else dayofweek(pickup_ts) end as day_of_week,
    pickup_latitude as pickup_lat, pickup_longitude / 16::double as pickup_lon,
    rate_code_id as rate_code,
    case when coalesce(passenger_count, 0) <= 0 then 1 else passenger_count end as passenger_count
  from records)
select {_K}, error, passenger_count, case when error is null then {_KEY} end as cache_key,
       {_r("case when error is null then " + _fixed_prediction(_REQUEST_FEATURES) + " end", 6,
           "duration_min")},
       case when error is null then 1 end as model_version
from requests"""
    value = "(l_extendedprice - 50000::double) * l_discount / 64::double"

    dirty_counts = f"""with {_TRIPS},
dirty as (select case when l_orderkey % 16 < 6 then 1 else rule end as rule from ruled)
select cast(range as int) as rule, coalesce(n, 0) as n from range(1, 10)
left join (select rule as range, count(*) as n from dirty group by 1) using (range)"""
    return {
        "rule_counts": rule_counts,
        "csv_rule_counts": rule_counts,
        "rule_detail": trips + f"select {_K}, pickup_ts, trip_distance, duration_min, rule from ruled",
        "rejects": trips + f"select {_K}, dropoff_ts, rule from ruled where rule > 0",
        "load_report": trips
        + "select count(*) as total, count(*) filter (where rule = 0) as valid, "
        + _r("count(*) filter (where rule = 0) / count(*)::double * 100", 6, "retention_pct")
        + ", "
        + ", ".join(f"count(*) filter (where rule = {r}) as r{r}" for r in range(1, 10))
        + " from ruled",
        "load_one_pass": trips
        + f"""select range::int as rule, coalesce(n, 0) as counted, coalesce(n, 0) as stored,
       {_r("case when range = 0 then minutes end", 4, "minutes")}
from range(10) left join (select rule, count(*) as n, sum(duration_min) as minutes from ruled group by 1)
  on rule = range""",
        "valid_trips": trips + f"select {_K}, {trip_columns} from trips",
        "csv_trips": trips + f"select {trip_columns} from trips",
        "first_n_valid": trips
        + f"""select {_K}, pickup_ts, duration_min from (
  select * from ruled qualify row_number() over (order by pickup_ts, {_K})
                              <= (select count(*) // 2 from lineitem)) where rule = 0""",
        "trips_by_hour": profiled + "select hour_of_day, n from by_hour",
        "trips_by_weekday": profiled
        + f"select day_of_week, {_NAMES}[day_of_week + 1] as name, n from by_day",
        "duration_hist": profiled
        + "select bin * 2::double as bin_start, n from by_duration where n > 0",
        "duration_hist_dense": profiled + "select bin * 2::double as bin_start, n from by_duration",
        "distance_hist": profiled
        + "select bin::double as bin_start, n from by_distance where n > 0",
        "distance_hist_dense": profiled + "select bin::double as bin_start, n from by_distance",
        "speed_by_hour": profiled + f"select hour_of_day, {_r('mean_mph')} from by_hour",
        "top_pickup_cells": _top_cells("trunc"),
        "top_pickup_cells_floor": _top_cells("floor"),
        "profile_grouping_sets": trips
        + f"""select metric, k1, k2, count(*) as n from (
  select 'hour' as metric, hour_of_day as k1, null::int as k2 from trips
  union all select 'weekday', day_of_week, null from trips
  union all select 'duration', {_DUR_BIN}, null from trips
  union all select 'distance', {_DIST_BIN}, null from trips
  union all select 'cell', {_CELL} from trips) group by all""",
        "report_files": profiled + reports,
        "feature_matrix": featured
        + f"select {_K}, "
        + ", ".join(_r(f"f{j}", 6, name) for j, name in enumerate(FEATURE_NAMES))
        + f", {_r('y')} from features",
        "scaler_fit": scaled
        + " union all ".join(
            f"select '{name}' as feature, {_r(f'm{j}', 6, 'mean')}, {_r(f's{j}', 6, 'std')}"
            " from scaler"
            for j, name in enumerate(FEATURE_NAMES)
        ),
        "scaled_features": scaled
        + f"select {_K}, "
        + ", ".join(_r(f"x{j}") for j in range(9))
        + f", {_r('y')} from scaled",
        "hash_split_counts": featured
        + "select is_train, count(*) as n, sum(l_orderkey)::bigint as sum_orderkey"
        " from features group by 1",
        "ordered_split_counts": trips
        + f"""select is_train, count(*) as n, sum(l_orderkey)::bigint as sum_orderkey,
  min(pickup_ts) as first_pickup, max(pickup_ts) as last_pickup
from (select *, row_number() over (order by pickup_ts, {_K})
             <= cast(floor(count(*) over () * 0.8::double) as bigint) as is_train from trips)
group by 1""",
        "gradient_at_theta": scaled
        + "select "
        + ", ".join(_r(f"avg(({fixed_error} - y) * x{j})", 6, f"g{j}") for j in range(9))
        + " from scaled where is_train",
        "gradient_sum_at_theta": scaled
        + "select count(*) as n, "
        + ", ".join(_r(f"sum(({fixed_error} - y) * x{j})", 2, f"g{j}") for j in range(9))
        + " from scaled where is_train",
        "mse_at_theta": scaled
        + f"select {_r(f'avg(({fixed_error} - y) * ({fixed_error} - y))', 6, 'mse')}"
        " from scaled where is_train",
        "gram_matrix": f"with {_TRIPS}, {_FEATURES}, {_scaled()}, {_gram()} {gram_rows}",
        "fit_weights": _weights(10),
        "fit_stored_moments": _weights(10),
        "fit_weights_by_pass": _weights(3),
        "model_json_round_trip": _weights(10),
        "loss_curve": losses
        + f"{_descent(10)} select epoch, {_r(_mse(), 4, 'mse')} from theta, gram where epoch > 0",
        "loss_report_file": losses
        + f"{_descent(5)} select epoch as epoca, {_r(_mse(), 4, 'mse_train')}"
        " from theta, gram where epoch > 0",
        "divergence_flags": losses
        + f"""{_descent(6, 6.0)}, curve as (select epoch, {_mse()} as mse from theta, gram
  where epoch > 0)
select epoch, coalesce(mse > 10 * lag(mse) over (order by epoch), false) as diverging
from curve""",
        "eval_metrics": featured
        + f"""select is_train, {_metrics("p - y")} from (
  select is_train, y, {_fixed_prediction([f"f{j}" for j in range(_N)])} as p from features)
group by 1""",
        "baseline_mean": featured
        + f"select {_metrics('e')} from (select {test_error['mean']} as e, y"
        " from features where not is_train)",
        "baseline_speed": featured
        + f"select {_metrics('e')} from (select {test_error['speed']} as e, y"
        " from features where not is_train)",
        "comparison_table": losses
        + f"""{_descent(10)},
tested as (select y, {predicted} - y as e_model, {test_error["mean"]} as e_mean,
                  {test_error["speed"]} as e_speed
           from scaled, theta where epoch = 10 and not is_train)
{table_row("Regresión Lineal", "e_model", "tested")}
union all {table_row("Baseline: media", "e_mean", "tested")}
union all {table_row("Baseline: vel. media", "e_speed", "tested")}""",
        "predict_trips": trips
        + f"select {_K}, {_r(_fixed_prediction(), 6, 'prediction')} from trips",
        "dot_product": trips
        + f"select {_K}, {_r(_fixed_prediction(), 6, 'prediction')} from trips",
        "score_requests": text_requests,
        "score_memo": _MEMO,
        "score_by_time": _BY_TIME,
        "stream_memo": _BY_TIME,
        "csv_dirty_rule_counts": dirty_counts,
        "stream_csv_rule_counts": dirty_counts,
        "csv_dirty_trips": trips
        + f"""select rate_code_id, count(*) as n, {_r("sum(trip_distance)", 6, "miles")}
from ruled where l_orderkey % 16 >= 6 and rule = 0 group by 1""",
        "csv_first_n": "select count(*) // 2 as n from lineitem",
        "prediction_log": f"""with {_COARSE}, {_ANSWERS}
select {_r("trip_distance")}, hour, passenger_count, {_r("answer", 6, "duration_min")},
       3 as model_version from answers where not cached""",
        "stream_score": f"""with {_COARSE}
select {_r("trip_distance")}, hour,
       {_r(_fixed_prediction(_REQUEST_FEATURES), 6, "duration_min")}, 3 as model_version
from requests""",
        "latest_model": _weights(5, "2 as version, 5 as epochs, 3 as nodes, "),
        "active_model": _weights(2, "1 as version, 2 as epochs, 3 as nodes, "),
        "next_version": "select 2::bigint as stored, 3 as next_version",
        "concurrent_versions": """select count(*) as stored, 1::bigint as first, count(*) as last, sum(l)::bigint as lines
from (select distinct l_linenumber as l from lineitem)""",
        "insight_upsert": profiled + insights,
        "train_and_register": _split_models(),
        "latest_200": f"with {_NEWEST} select event_type, event_id, ts, value from newest",
        "latency_p50_p95": _PERCENTILES,
        "stream_latency": _PERCENTILES,
        "latency_summary": f"""with
ranked as (select event_type, value, count(*) over (partition by event_type) as n,
                  row_number() over (partition by event_type order by value, event_id) - 1 as pos
           from events)
select event_type, max(n) as n, min(value) as min, {_r("avg(value)", 6, "avg")},
       min(value) filter (where pos = n // 2) as p50,
       min(value) filter (where pos = cast(floor(n * 0.95::double) as bigint)) as p95,
       max(value) as max,
       min(value) filter (where pos = cast(floor(n * 0.95::double) as bigint)) < 100 as passed
from ranked group by 1""",
        "stream_profile": profiled
        + f"""select metric, k1::double as k1, k2::double as k2, n::double as value from (
  select 'hour' as metric, hour_of_day::double as k1, null::double as k2, n::double as n from by_hour
  union all select 'weekday', day_of_week, null, n from by_day
  union all select 'duration', bin * 2::double, null, n from by_duration
  union all select 'distance', bin, null, n from by_distance
  union all select 'speed', hour_of_day, null, v from (select hour_of_day, {_r("mean_mph", 6, "v")} from by_hour)
  union all select 'cell', lat_cell, lon_cell, n from ({_top_cells("trunc")}))""",
        "fixed_decimals": f"""select {_K}, l_extendedprice, printf('%.3f', {value}) as d3,
       printf('%.4f', {value}) as d4, printf('%.2f', l_extendedprice / 16::double) as d2
from lineitem""",
    }
