"""Batch loads: overwrite, append and high-watermark extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.aggregates import high_watermark


def full_load(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table. Partition columns of few values, such as the batch, let
    later reads skip files; they become the last columns."""
    df.write.mode("overwrite").saveAsTable(table, partitionBy=list(partition_by) or None)


def append_load(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows without looking for duplicates: a second run adds them again."""
    df.write.mode("append").saveAsTable(table, partitionBy=list(partition_by) or None)


def write_path(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Replace the files below a path."""
    df.write.mode("overwrite").format(format).save(path)


def newer_than(
    source: DataFrame,
    target: DataFrame,
    column: str,
    inclusive: bool = False,
    keys: list[str] | None = None,
) -> DataFrame:
    """Source rows above the greatest ``column`` of the target.

    The value becomes a literal, so a database source receives the filter. An
    empty target asks for everything. A late row that shares the watermark is
    missed by ``>``; ``inclusive`` reads the ties again and leaves out those
    whose ``keys`` the target already holds at that value.
    """
    watermark = high_watermark(target, column)
    return source if watermark is None else above(source, target, column, F.lit(watermark), inclusive, keys)


def above(
    source: DataFrame, target: DataFrame, column: str, watermark: Column, inclusive: bool, keys: list[str] | None
) -> DataFrame:
    """Source rows above a watermark, or from it on less those the target holds."""
    if not inclusive:
        return source.filter(F.col(column) > watermark)
    if not keys:
        raise ValueError("an inclusive extract needs the key columns")
    held = target.filter(F.col(column) == watermark).select(*keys, column).distinct()
    return source.filter(F.col(column) >= watermark).join(held, [*keys, column], "left_anti")


def describe(spark: SparkSession, table: str) -> DataFrame:
    """Columns and types of a table."""
    return spark.sql(f"DESCRIBE TABLE {table}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
