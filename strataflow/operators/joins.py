"""Joins that stay whole and spread out when one key is very frequent.

At run time Spark splits a skewed join partition on the side whose rows are not
padded: either side of an inner join, the kept side of an outer one, no side of
a full one. The outer joins here are therefore written as an inner join plus
the unmatched rows, whose other side is only a set of distinct keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def inner_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both sides with equal keys; the keys appear once."""
    return left.join(right, list(keys), "inner")


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows without a partner (anti-join on the distinct right keys)."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def outer_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left``, ``right`` or ``full`` outer join on shared key columns.

    Rows with a NULL key match nothing and skip the join; that also gives the
    inner and the unmatched part the same input, so its shuffle is done once.
    Each side is evaluated more than once: give it deterministic inputs (tables,
    files). The result of ``dropDuplicates`` on part of the columns, for example,
    may differ between evaluations and make a row both matched and unmatched.
    """
    if how not in ("left", "right", "full"):
        raise ValueError(f"not an outer join: {how}")
    keyed = reduce(and_, [F.col(k).isNotNull() for k in keys])
    left_keyed, right_keyed = left.filter(keyed), right.filter(keyed)
    parts = [inner_join(left_keyed, right_keyed, keys)]
    if how in ("left", "full"):
        parts += [unmatched(left_keyed, right_keyed, keys), left.filter(~keyed)]
    if how in ("right", "full"):
        parts += [unmatched(right_keyed, left_keyed, keys), right.filter(~keyed)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def left_join_where(
    left: DataFrame, right: DataFrame, keys: Sequence[str], right_condition: Column
) -> DataFrame:
    """``LEFT JOIN ... ON keys AND condition(right)``.

    A condition on the right side alone may run before the join, where it prunes
    the scan; put after the join it would drop the unmatched left rows.
    """
    return outer_join(left, right.filter(right_condition), keys, "left")


def lookup_join(left: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a reference table, without measuring it first.

    Spark broadcasts the reference where its statistics, or at run time its shuffled
    size, are below the session's threshold. Otherwise it shuffles, and splits a
    hot key on the kept side, rows whose key is NULL among them.
    """
    return left.join(reference, list(keys), "left")


def cross_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pair of two sets. The output is the product of both sizes."""
    return left.crossJoin(right)


def fanout_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys to which an inner join gives more than one row, and how many.

    Each side is counted per key before it is shuffled; the joined rows never
    have to exist.
    """
    n_left = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n_left"))
    n_right = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n_right"))
    product = F.col("_n_left") * F.col("_n_right")
    return (
        n_left.join(n_right, list(keys), "inner")
        .filter(product > 1)
        .select(*keys, product.alias("rows_after_join"))
    )
