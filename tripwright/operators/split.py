"""Train/test splits and positional cuts, all as row conditions: no row is moved or sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_FRACTION = 0.8
_BINS = 1 << 15
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def train_fraction(fraction: float) -> float:
    """The fraction itself if strictly between 0 and 1, else the default."""
    return fraction if 0 < fraction < 1 else DEFAULT_FRACTION


def in_train_by_hash(key: Column, seed: int = 42, fraction: float = DEFAULT_FRACTION) -> Column:
    """True for about ``fraction`` of the rows, chosen by a hash of the row key and the seed.

    The same row falls on the same side whatever the partitioning, so a lost task recomputes the
    split it had; ``randomSplit`` does not promise that. md5 is used because any engine has it.
    """
    # Eight hex digits compare as text like the number they spell.
    limit = f"{int(train_fraction(fraction) * 2**32):08x}"
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.substring(digest, 1, 8) < F.lit(limit)


def in_first(df: DataFrame, keys: Sequence[str], n: int) -> Column:
    """True for the first ``n`` rows of ``df`` in ascending order of integer or time keys, nulls first.

    Finds the n-th row by counting, not by sorting: each pass counts the rows per slice of the key
    range (at most 32,768 counts reach the driver), then narrows the range to the slice where the
    n-th row lies. Rows tied on one key are ranked by the next. The answer is a comparison with
    constants, which a scan can use to skip data.

    The keys together should identify a row; rows equal in all of them stay on one side.
    """
    if n <= 0:
        return F.lit(False)
    types = dict(df.dtypes)
    scope, wanted = df, n
    chosen, tied = F.lit(False), F.lit(True)
    for key in keys:
        values = scope.select(_as_long(key, types[key]).alias("v"))
        rows, known, low, high = values.agg(
            F.count("*"), F.count("v"), F.min("v"), F.max("v")
        ).head()
        nulls = rows - known
        if nulls >= wanted:
            tied = tied & F.col(key).isNull()
            if nulls == wanted:
                return chosen | tied
            scope = scope.where(F.col(key).isNull())
            continue
        if nulls:
            chosen = chosen | (tied & F.col(key).isNull())
            tied = tied & F.col(key).isNotNull()
            wanted -= nulls
        if wanted >= known:
            return chosen | tied
        found = _nth_value(values, wanted, low, high)
        value, below, equal = found
        cut = _literal(value, types[key])
        chosen = chosen | (tied & (F.col(key) < cut))
        tied = tied & (F.col(key) == cut)
        wanted -= below
        if wanted == equal:
            return chosen | tied
        scope = scope.where(F.col(key) == cut)
    return chosen | tied


def in_train_by_order(
    df: DataFrame, keys: Sequence[str], fraction: float = DEFAULT_FRACTION
) -> Column:
    """True for the first ⌊fraction·rows⌋ rows in key order."""
    return in_first(df, keys, int(df.count() * train_fraction(fraction)))


def _nth_value(values: DataFrame, n: int, low: int, high: int) -> tuple[int, int, int]:
    """(n-th smallest ``v``, rows below it, rows equal to it); all lie between ``low`` and ``high``."""
    below = 0
    while True:
        width = -(-(high - low + 1) // _BINS)
        slice_no = F.floor((F.col("v") - low) / width) if width > 1 else F.col("v") - low
        counts = (
            values.where(F.col("v").between(low, high))
            .groupBy(slice_no.alias("slice"))
            .agg(F.count("*").alias("n"))
            .collect()
        )
        for slice_, rows in sorted((r.slice, r.n) for r in counts):
            if below + rows >= n:
                break
            below += rows
        if width == 1:
            return low + slice_, below, rows
        low = low + slice_ * width
        high = min(high, low + width - 1)


def _as_long(key: str, type_name: str) -> Column:
    if type_name == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, `{key}`)")
    if type_name == "timestamp":
        return F.unix_micros(key)
    if type_name == "date":
        return F.unix_date(key).cast("bigint")
    if type_name in ("tinyint", "smallint", "int", "bigint"):
        return F.col(key).cast("bigint")
    raise TypeError(f"order key {key} has type {type_name}; an integer or time is needed")


def _literal(value: int, type_name: str) -> Column:
    if type_name == "timestamp_ntz":
        return F.expr(f"timestampadd(MICROSECOND, {value}L, {_EPOCH})")
    if type_name == "timestamp":
        return F.timestamp_micros(F.lit(value))
    if type_name == "date":
        return F.date_from_unix_date(F.lit(value))
    return F.lit(value).cast(type_name)
