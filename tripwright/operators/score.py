"""Scoring of request tables, with a memo of recent answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwright.functions import text as X
from tripwright.functions.features import raw_features
from tripwright.operators.hot_keys import HOT_SHARE, join_per_key
from tripwright.operators.model import LinearModel
from tripwright.schemas import SCORING_INPUT
from tripwright.session import Scratch

# --- Fixed values: texts of the two request errors -------------------------------------------
MISSING, INVALID = "trip_distance: missing value", "trip_distance: invalid value"
# --- end of fixed values ---------------------------------------------------------------------

MEMO_SECONDS = 300
# Requests whose keys are worked on at once, and the most parts of keys.
PART_REQUESTS, MOST_PARTS = 1 << 21, 16
CACHED_VERSION = -1
_INPUTS = SCORING_INPUT.names
_LIFE = MEMO_SECONDS * 1_000_000
_SLOT = f"({{0}} - pmod({{0}}, {_LIFE})) div {_LIFE}"

# Decimals of the quantised inputs; requests equal after rounding share one answer.
KEY_DECIMALS = {"trip_distance": 3, "pickup_lat": 4, "pickup_lon": 4}
_AS_TRIP = {
    "trip_distance": "trip_distance",
    "hour": "hour_of_day",
    "day_of_week": "day_of_week",
    "pickup_lat": "pickup_latitude",
    "pickup_lon": "pickup_longitude",
    "rate_code": "rate_code_id",
    "passenger_count": "passenger_count",
}


def scoring_inputs(requests: DataFrame) -> DataFrame:
    """Requests with typed inputs, defaults filled in, and an ``error`` column.

    Only the distance is required. Any other input that is missing or unreadable counts as 0, and a
    passenger count of 0 or less as 1. Columns may be text or numbers; others pass through.
    """
    types = dict(requests.dtypes)

    def typed(name: str, type_name: str) -> str:
        if name not in types:
            return f"cast(0 as {type_name})"
        if types[name] == "string":
            return X.lenient(name, type_name)
        return f"coalesce(try_cast({name} as {type_name}), cast(0 as {type_name}))"

    others = [c for c in requests.columns if c not in _INPUTS]
    columns = {f.name: typed(f.name, f.dataType.simpleString()) for f in SCORING_INPUT.fields}
    # What the distance was written as; numbers need no text to tell a bad value from a missing one.
    given = "trip_distance" if "trip_distance" in types else "cast(null as double)"
    read = requests.selectExpr(
        *others, f"{given} as given", *[f"{sql} as {name}" for name, sql in columns.items()]
    )
    missing, invalid = "given is null", "false"
    if types.get("trip_distance") == "string":
        missing = "coalesce(given, '') = ''"
        overflow = f"({X.without_overflow('trip_distance', 'given')}) is null"
        invalid = f"not {X.is_form('given', 'double')} or {overflow}"
    checked = read.selectExpr(
        "* except (given)",
        f"""case when {missing} then '{MISSING}'
                 when {invalid} then '{INVALID}' end as error""",
    )
    return checked.selectExpr(
        *others,
        "case when error is null then trip_distance end as trip_distance",
        *_INPUTS[1:-1],
        "greatest(passenger_count, 1L) as passenger_count",
        "error",
    )


def prediction(model: LinearModel) -> str:
    """SQL expression for the prediction over the request's column names."""
    return model.prediction(
        raw_features(
            hour="hour", latitude="pickup_lat", longitude="pickup_lon", rate_code="rate_code"
        )
    )


def score(requests: DataFrame, model: LinearModel, version: int) -> DataFrame:
    """Every request with ``duration_min`` and ``model_version``; both null where ``error`` is set.

    A projection without shuffle or state, so it serves batches and streams alike.
    """
    typed = scoring_inputs(requests)
    return typed.selectExpr(
        "*",
        f"case when error is null then {prediction(model)} end as duration_min",
        f"case when error is null then {int(version)} end as model_version",
    )


def with_cache_key(scored: DataFrame) -> DataFrame:
    """Adds ``cache_key``, the quantised inputs as one text; null where ``error`` is set."""
    texts = {f"{name}_text": (name, digits) for name, digits in KEY_DECIMALS.items()}
    parts = [f"{name}_text" if name in KEY_DECIMALS else name for name in _INPUTS]
    key = f"case when error is null then concat_ws(':', {', '.join(parts)}) end as cache_key"
    return X.with_fixed_decimals(scored, texts).selectExpr(*scored.columns, key)


def score_with_memo(
    requests: DataFrame,
    model: LinearModel,
    version: int,
    request_id: str,
    memo: DataFrame | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Answers to a batch of requests that arrive together, each key computed once.

    The first request of a key (by ``request_id``) is answered by the model; the others get that
    answer with ``cached`` set and version -1. Entries of an earlier ``memo`` not older than five
    minutes at ``now`` answer all requests of their key. Being hit does not renew an entry.

    Predictions are cheap, so every row is predicted and only (key, id, prediction) triples are
    shuffled, combined before the shuffle. Their results join back; rows of hot keys stay in place.
    """
    keyed = with_cache_key(score(requests, model, version))
    firsts = (
        keyed.where("error is null")
        .groupBy("cache_key")
        .agg(
            F.count("*").alias("requests_of_key"),
            F.min(request_id).alias("first_id"),
            F.min_by("duration_min", request_id).alias("first_minutes"),
        )
    )
    if memo is None:
        firsts = firsts.withColumn("memo_minutes", F.lit(None).cast("double"))
    else:
        live = live_entries(memo, now).selectExpr("cache_key", "duration_min as memo_minutes")
        firsts = firsts.join(live, "cache_key", "left")
    asked = keyed.drop("duration_min", "model_version")
    answered = join_per_key(asked, firsts, "cache_key", "requests_of_key")
    cached = f"coalesce(memo_minutes is not null or {request_id} != first_id, false)"
    return answered.selectExpr(
        *asked.columns,
        "coalesce(memo_minutes, first_minutes) as duration_min",
        f"""case when error is null
                 then if({cached}, {CACHED_VERSION}, {int(version)}) end as model_version""",
        f"{cached} as cached",
    )


def score_by_time(
    requests: DataFrame,
    model: LinearModel,
    version: int,
    request_id: str,
    arrived_at: str,
    memo: DataFrame | None = None,
    keep: Scratch | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Answers by the memo as it stands when each request arrives, and the newest entry per key.

    The first request of a key computes, and its entry answers the key for five minutes from then;
    the first request after that computes again. ``memo`` holds an earlier entry per key; it also
    answers requests older than itself. Requests of one time go by id. So cutting a sequence of
    requests into batches does not change the answers.

    Entries are found by pointer doubling (see ``entry_times``): the rounds grow with the logarithm of
    a key's entries, so a backlog of a month costs little more than a batch of minutes. A request
    without arrival time is computed by itself.

    Keys do not depend on each other, so a large table's are worked on in parts: beside the requests and the
    answers, which are stored once each, there is never more than one part's work on disk.
    Answers and entries are stored in ``keep``, to be dropped with it, or else outlive this call.
    """
    spark = requests.sparkSession
    keep = keep or Scratch(spark)
    with Scratch(spark) as scratch:
        keyed = with_cache_key(score(requests, model, version)).drop("model_version")
        keyed = scratch.written(keyed.withColumnRenamed("duration_min", "own_minutes"), "memo-requests")
        memo = None if memo is None or memo.isEmpty() else memo.select("cache_key", "duration_min", "scored_at")
        key_id = _key_number([keyed] if memo is None else [keyed, memo])
        at = F.unix_micros(F.col(arrived_at).cast("timestamp"))
        asked = keyed.where("error is null").withColumns({"memo_k": key_id, "memo_t": at})
        limit = keyed.count() * HOT_SHARE
        others = [c for c in keyed.columns if c != "own_minutes"]
        failed = _answers(keyed.where("error is not null"), others, version, F.lit(None), F.lit(False))
        out, newest = [keep.written(failed, "memo-answers")], []
        parts = parts_of(keyed.count())
        for part in range(parts):
            here = F.pmod("memo_k", F.lit(parts)) == part
            known = None if memo is None else memo.withColumn("memo_k", key_id).where(here)
            with Scratch(spark) as own:
                answers, entries = _by_time(asked.where(here), others, version, request_id, known, limit, own)
                out.append(keep.written(answers, "memo-answers"))
                newest.append(keep.written(entries, "memo-newest"))
    return reduce(DataFrame.unionByName, out), reduce(DataFrame.unionByName, newest)


def parts_of(requests: int) -> int:
    """In how many parts the keys of so many requests are worked on."""
    return min(MOST_PARTS, 1 + requests // PART_REQUESTS)


def _answers(rows: DataFrame, others: list[str], version: int, minutes: Column, cached: Column) -> DataFrame:
    number = F.when(cached, F.lit(CACHED_VERSION)).otherwise(F.lit(int(version)))
    return rows.select(
        *others,
        minutes.cast("double").alias("duration_min"),
        F.when(F.col("error").isNull(), number).alias("model_version"),
        cached.alias("cached"),
    )


def _by_time(
    asked: DataFrame, others: list[str], version: int, request_id: str, memo: DataFrame | None, limit: float, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """Answers to some keys' requests and their newest entries; slots of more requests than ``limit`` are hot."""
    columns, out = asked.columns, []
    named = asked.select("memo_k", "cache_key").distinct()
    if memo is not None:
        counts = asked.groupBy("memo_k").agg(F.count("*").alias("requests_of_key"))
        known = memo.selectExpr(
            "memo_k", "duration_min as memo_minutes", f"unix_micros(cast(scored_at as timestamp)) + {_LIFE} as memo_until"
        )
        met = join_per_key(asked, counts.join(known, "memo_k"), "memo_k", "requests_of_key").drop("requests_of_key")
        from_memo = F.coalesce(F.col("memo_t") <= F.col("memo_until"), F.lit(False))
        out.append(_answers(met.where(from_memo), others, version, F.col("memo_minutes"), F.lit(True)))
        asked = met.where(~from_memo).select(*columns)
    asked = asked.withColumn("memo_slot", F.expr(_SLOT.format("memo_t")))

    first = F.min(F.struct(F.col(request_id).alias("id"), "own_minutes")).alias("first")
    times = asked.where("memo_t is not null").groupBy(F.col("memo_k").alias("cache_key"), F.col("memo_t").alias("t")).agg(first)
    times = scratch.written(times, "memo-times")
    found, _ = entry_times(times.select("cache_key", "t"), scratch)
    entries = found.join(times, ["cache_key", "t"]).selectExpr("cache_key as memo_k", "struct(t, first.id, first.own_minutes) as entry")
    entries = scratch.written(entries, "memo-entries")

    # An entry lives in two slots of its life's length at most, and no slot has more than two entries.
    begun = _SLOT.format("entry.t")
    slots = entries.withColumn("memo_slot", F.explode(F.expr(f"array({begun}, {begun} + 1)")))
    slots = slots.groupBy("memo_k", "memo_slot").agg(F.min("entry").alias("memo_older"), F.max("entry").alias("memo_newer"))
    # Requests of hot slots, fewer than 1 / HOT_SHARE by their definition, and those without a time stay in place.
    on = ["memo_k", "memo_slot"]
    timed = asked.where("memo_slot is not null")
    crowded = timed.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") > limit).select(*on)
    crowded = scratch.written(crowded, "memo-hot")
    hot = scratch.written(slots.join(F.broadcast(crowded), on), "memo-hot")
    none = {c: F.lit(None).cast(slots.schema[c].dataType) for c in ("memo_older", "memo_newer")}
    entry = F.when(F.col("memo_newer.t") <= F.col("memo_t"), F.col("memo_newer")).otherwise(F.col("memo_older"))
    hit = F.coalesce(F.col("memo_entry.id") != F.col(request_id), F.lit(False))
    minutes = F.coalesce("memo_entry.own_minutes", "own_minutes")
    for rows in (
        timed.join(F.broadcast(hot), on),
        timed.join(F.broadcast(hot.select(*on)), on, "left_anti").join(slots, on, "left"),
        asked.where("memo_slot is null").withColumns(none),
    ):
        out.append(_answers(rows.withColumn("memo_entry", entry), others, version, minutes, hit))

    # The newest entry of each key, under the key's own text.
    made = entries.groupBy("memo_k").agg(F.max("entry").alias("entry")).join(named, "memo_k")
    newest = made.selectExpr("cache_key", "entry.own_minutes as duration_min", "timestamp_micros(entry.t) as scored_at")
    if memo is not None:
        newest = memo.select(*newest.columns).unionByName(newest).groupBy("cache_key").agg(
            F.max_by("duration_min", "scored_at").alias("duration_min"), F.max("scored_at").alias("scored_at")
        )
    return reduce(DataFrame.unionByName, out), newest


def _key_number(frames: list[DataFrame]) -> Column:
    """A long that stands for ``cache_key``; hashed with another seed if two keys of the frames share one."""
    for seed in range(64):
        number = F.xxhash64(F.lit(seed), "cache_key")
        if not seed:  # short numbers do for few keys
            number = F.pmod(number, F.lit(1 << 32))
        checks = [f.where("cache_key is not null").select(number.alias("k"), F.xxhash64("cache_key", F.lit(seed)).alias("other")) for f in frames]
        both = reduce(DataFrame.unionByName, checks).groupBy("k").agg(F.min("other").alias("a"), F.max("other").alias("b"))
        if both.where("a <> b").isEmpty():
            return number
    raise ValueError("two keys share a number with every seed")


def entry_times(times: DataFrame, scratch: Scratch | None = None) -> tuple[DataFrame, int]:
    """The times (``cache_key``, ``t`` in microseconds) at which a key's entries begin, and the rounds taken.

    A time that comes more than an entry's life after the one before begins an entry whatever went before,
    and so does the first time after each entry's end. Every time gets a pointer to the time that would
    follow it, where that is not such a beginning. Each round doubles the pointers and adds what the
    entries found so far point to, so 1,000 entries of one key take eleven rounds. Pointers that have run
    off an unbroken stretch are dropped, so a batch of minutes ends after one round, and so do sparse times.
    """
    scratch = scratch or Scratch(times.sparkSession)  # whose tables then stay
    slots = scratch.written(_slots(times), "memo-slots")
    pointers = scratch.written(_next_times(times, slots), "memo-pointers")
    entries = scratch.written(slots.where("begins").selectExpr("cache_key", "first as t"), "memo-entries")
    scratch.drop(slots)
    reached, rounds = entries, 0
    while not pointers.isEmpty():
        rounds += 1
        found = entries.join(pointers, ["cache_key", "t"]).select("cache_key", F.col("next").alias("t"))
        reached = scratch.written(found, "memo-entries")
        if reached.isEmpty():
            break
        entries = entries.unionByName(reached)
        far = pointers.select("cache_key", F.col("t").alias("next"), F.col("next").alias("far"))
        doubled = pointers.join(far, ["cache_key", "next"]).select("cache_key", "t", F.col("far").alias("next"))
        doubled = scratch.written(doubled, "memo-pointers")
        scratch.drop(pointers)
        pointers = doubled
    scratch.drop(pointers)
    return entries, rounds


def _slots(times: DataFrame) -> DataFrame:
    """Times cut into slots of an entry's life: ``first`` time, whether it ``begins`` an entry whatever went before,
    whether the next slot with times ``goes_on``, i.e. does not so, and then the first time ``beyond`` the slot
    that follows, unless that begins one."""
    slots = times.groupBy("cache_key", F.expr(_SLOT.format("t")).alias("slot"))
    slots = slots.agg(F.min("t").alias("first"), F.max("t").alias("last"))
    by_slot = Window.partitionBy("cache_key").orderBy("slot")
    slots = slots.withColumn("begins", F.coalesce(F.col("first") - F.lag("last").over(by_slot) > _LIFE, F.lit(True)))
    later = {f"{c}_{n}": F.lead(c, n).over(by_slot) for n in (1, 2) for c in ("first", "begins")}
    return slots.withColumns(later).selectExpr(
        "cache_key", "slot", "first", "begins", "coalesce(not begins_1, false) as goes_on", "if(begins_2, null, first_2) as beyond"
    )


def _next_times(times: DataFrame, slots: DataFrame) -> DataFrame:
    """``cache_key``, ``t`` and ``next``, the key's first time more than an entry's life after ``t``, where there is one
    that does not begin an entry by itself.

    Then ``next`` lies in the slot after that of ``t`` or is the first time of the one after that; windows run over one
    slot's times, or over one key's slots.
    """
    slotted = times.select("cache_key", "t", F.expr(_SLOT.format("t")).alias("slot"))
    slotted = slotted.join(slots.where("goes_on or not begins").select("cache_key", "slot", "goes_on", "begins"), ["cache_key", "slot"])
    asked = slotted.where("goes_on").selectExpr("cache_key", "slot + 1 as slot", f"t + {_LIFE} as place", "t as asked", "cast(null as bigint) as t")
    there = slotted.where("not begins").selectExpr("cache_key", "slot", "t as place", "cast(null as bigint) as asked", "t")
    # Going down in time, the last time met before a question is the first one after it.
    down = Window.partitionBy("cache_key", "slot").orderBy(F.desc("place"), F.desc_nulls_last("asked"))
    later = F.min("t").over(down.rowsBetween(Window.unboundedPreceding, -1))
    near = asked.unionByName(there).withColumn("near", later).where("asked is not null")
    beyond = slots.where("goes_on").selectExpr("cache_key", "slot + 1 as slot", "beyond")
    both = near.join(beyond, ["cache_key", "slot"])
    return both.selectExpr("cache_key", "asked as t", "coalesce(near, beyond) as next").where("next is not null")


def live_entries(memo: DataFrame, now: Column) -> DataFrame:
    """Memo entries that still answer requests at ``now``."""
    return memo.where(F.col("scored_at") >= now - F.expr(f"interval {MEMO_SECONDS} seconds"))


def new_entries(answers: DataFrame, now: Column) -> DataFrame:
    """Memo entries written by the model answers of a batch."""
    computed = answers.where("error is null and not cached")
    return computed.select("cache_key", "duration_min", now.alias("scored_at"))


def prediction_log(
    answers: DataFrame, created_at: Column, arrived_at: str | None = None
) -> DataFrame:
    """Rows for the prediction table: model answers only, memo hits are not logged.

    ``latency_ms`` is the time from ``arrived_at``, a column of the answers, to ``created_at``; without such
    a column, or where it is null, a row has no latency of its own and it is null.
    """
    made = answers.where("error is null")
    if "cached" in answers.columns:
        made = made.where("not cached")
    created = created_at.cast("timestamp")
    waited = F.lit(None)
    if arrived_at is not None:
        waited = (F.unix_micros(created) - F.unix_micros(F.col(arrived_at).cast("timestamp"))) / 1000
    return made.select(
        F.struct(*_INPUTS).alias("input"),
        "duration_min",
        F.col("model_version").cast("int").alias("model_version"),
        F.floor(waited).cast("bigint").alias("latency_ms"),
        created.alias("created_at"),
    )


def requests_from_trips(trips: DataFrame, *keep: str) -> DataFrame:
    """Trips as a scoring request table."""
    columns = [f"{trip} as {name}" for name, trip in _AS_TRIP.items()]
    return trips.selectExpr(*keep, *columns)
