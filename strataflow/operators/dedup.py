"""One row per key by a ranked window.

The ``row_number() = 1`` form lets Spark keep one candidate per key in each map
task (WindowGroupLimit), so a key that holds much of the table shuffles as a
handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank_in_key"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order, which must not tie."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], latest: str, tiebreak: Sequence[str]
) -> DataFrame:
    """The row with the greatest ``latest``; equal ones are settled by ``tiebreak``."""
    order = [F.col(latest).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tiebreak]]
    return first_per_key(df, keys, order)


def by_priority(column: str, ranking: Sequence[str] | None = None) -> Column:
    """Sort key for ``first_per_key``: the text itself, or its place in a list
    (values outside the list come last)."""
    if ranking is None:
        return F.col(column).asc_nulls_last()
    place = F.array_position(F.array(*[F.lit(v) for v in ranking]), F.col(column))
    return F.when(place > 0, place).otherwise(len(ranking) + 1).asc()


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Any one row per key, combined in each task before the shuffle."""
    return df.dropDuplicates(list(keys))
