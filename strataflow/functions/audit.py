"""Audit columns every landed table carries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_label(prefix: str, at: datetime | None = None) -> str:
    """``prefix_YYYYMMDD_HHMM``. Two runs in one minute share it: pass an own id
    to ``add_audit`` where that matters."""
    return f"{prefix}_{(at or datetime.now()).strftime('%Y%m%d_%H%M')}"


def add_audit(
    df: DataFrame,
    source_system: str | None = None,
    batch_id: str | None = None,
    source_file: bool = False,
) -> DataFrame:
    """Add ``ingestion_timestamp`` and those of ``source_file``, ``source_system``
    and ``batch_id`` that are asked for. ``source_file`` needs a file scan as input."""
    columns = {"ingestion_timestamp": F.current_timestamp()}
    if source_file:
        columns["source_file"] = F.col("_metadata.file_name")
    if source_system is not None:
        columns["source_system"] = F.lit(source_system)
    if batch_id is not None:
        columns["batch_id"] = F.lit(batch_id)
    return df.withColumns(columns)
