"""Cleaning rules between the landed and the refined layer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflow.functions.columns import clean_lower, clean_title

REJECT_REASON = "reject_reason"


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count of every column, in one aggregate over one scan."""
    return df.select([F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def keep_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows that lack any required value."""
    return df.dropna(subset=list(required))


def rejected(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The rows ``keep_required`` drops, with the missing columns as the reason."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    any_missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return df.filter(any_missing).withColumn(
        REJECT_REASON, F.concat(F.lit("missing: "), F.concat_ws(", ", *missing))
    )


def count_missing(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows in, rows kept and rows dropped by ``keep_required``, from one scan."""
    any_missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~any_missing).alias("rows_kept"),
        F.count_if(any_missing).alias("rows_dropped"),
    )


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace NULL in optional columns by a value of the column's own type."""
    return df.fillna(defaults)


def standardize(
    df: DataFrame,
    lower: Sequence[str] = (),
    title: Sequence[str] = (),
    trim: Sequence[str] = (),
) -> DataFrame:
    """Trim the named text columns; lower-case or capitalise them as listed."""
    return df.withColumns(
        {c: clean_lower(c) for c in lower}
        | {c: clean_title(c) for c in title}
        | {c: F.trim(c) for c in trim}
    )


def enforce_schema(df: DataFrame, schema: StructType, strict: bool = True) -> DataFrame:
    """Names, order and types of the contract; columns outside it go.

    Strict casts fail the job on a value that does not fit, lenient ones make it
    NULL. A NULL in a NOT NULL column fails the job, which Spark itself does not
    do for data read from files.
    """
    return df.select(*[_conform(f.name, f.dataType.simpleString(), f.nullable, strict) for f in schema.fields])


def _conform(name: str, type_name: str, nullable: bool, strict: bool) -> Column:
    source = F.col(f"`{name}`")
    value = source.cast(type_name) if strict else source.try_cast(type_name)
    if not nullable:
        value = F.coalesce(value, F.raise_error(F.lit(f"NULL in required column {name}")).cast(type_name))
    return value.alias(name)


def validate_keys(df: DataFrame, key: str, required: str) -> DataFrame:
    """Total rows, distinct keys and NULLs of a required column.

    Counted per key first, so that a frequent key is one row when it is shuffled.
    """
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(required).isNull()).alias("missing")
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(key).alias("distinct_keys"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias(f"null_{required}"),
    )
