"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_lower(name: str) -> Column:
    return F.trim(F.lower(F.col(name)))


def clean_title(name: str) -> Column:
    return F.trim(F.initcap(F.col(name)))


def money_sum(amount: Column | str) -> Column:
    """Sum of a two-decimal amount, exact whatever order the rows arrive in."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(column.cast("decimal(18,2)")).cast("double")


def with_tax(amount: Column | str, rate: float) -> Column:
    column = F.col(amount) if isinstance(amount, str) else amount
    return column * F.lit(1 + rate)
