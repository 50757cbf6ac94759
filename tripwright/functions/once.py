"""Keep an expensive expression from being evaluated more than once per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def select_once(df: DataFrame, keep: Sequence[str], computed: Mapping[str, str]) -> DataFrame:
    """``keep`` columns plus computed ones, which later filters read instead of recomputing.

    Catalyst moves a filter below a projection by copying the projected expressions into it. With
    several conditions over parsed or derived columns each row then pays for every expression many
    times over, and the generated method can outgrow what the JVM compiles. A filter does not move
    below a generator, so the columns pass through a one-row ``inline``.
    """
    fields = ", ".join(f"'{name}', {sql}" for name, sql in computed.items())
    return df.selectExpr(*keep, f"inline(array(named_struct({fields})))")
