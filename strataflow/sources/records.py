"""In-memory records and raw payloads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def from_records(spark: SparkSession, records: Iterable[dict], schema: StructType) -> DataFrame:
    """Rows from a driver-side list, such as one API reply; NOT NULL is enforced.
    What is more than a reply belongs in files (``land_payload``, ``parse_payload``)
    or in ``paged.read_pages``, which never pass through the driver."""
    return spark.createDataFrame([tuple(record.get(name) for name in schema.names) for record in records], schema)


def land_payload(df: DataFrame, path: str, column: str = "payload", by: str | None = None) -> None:
    """Write raw JSON text, one record per line, before anything reads it."""
    kept = df.select(column, *([by] if by else []))
    writer = kept.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).text(path)


def parse_payload(df: DataFrame, schema: StructType, column: str = "payload") -> DataFrame:
    """Schema fields of a JSON text column; absent keys become NULL."""
    return df.select(F.from_json(column, schema).alias("_record")).select("_record.*")
