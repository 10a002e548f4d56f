"""Incremental ingestion of a growing folder of CSV files.

The stream itself only discovers paths; each micro-batch then reads its files,
resolves their columns against a stored schema and adds one load to a
``LedgerTable``. The load records the batch it came from, so a batch that is
replayed after a crash is recognised and not written twice.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strataflow import schemas
from strataflow.functions.audit import add_audit
from strataflow.plans.ledger import STREAM, LedgerTable
from strataflow.session import delete_path
from strataflow.sources import files


class UnknownFieldError(RuntimeError):
    """Files brought columns the stored schema lacked; it has them now, so a
    restart goes on."""


class SinkSchemaError(RuntimeError):
    """The target lacks columns and the stream was not told to add them."""


@dataclass(frozen=True)
class SchemaLog:
    """Column names seen so far, one small JSON folder per version."""

    spark: SparkSession
    path: str

    def versions(self) -> list[list[str]]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(root):
            return []
        rows = self.spark.read.schema("version INT, columns ARRAY<STRING>").json(f"{self.path}/version=*")
        return [r.columns for r in rows.orderBy("version").collect()]

    def latest(self) -> list[str] | None:
        found = self.versions()
        return found[-1] if found else None

    def append(self, columns: list[str]) -> None:
        version = len(self.versions())
        line = self.spark.createDataFrame([(json.dumps({"version": version, "columns": columns}),)], "value STRING")
        line.coalesce(1).write.mode("overwrite").text(f"{self.path}/version={version}")


@dataclass
class AutoLoad:
    """``hints`` pins column types as DDL; every other column stays text."""

    spark: SparkSession
    source: str
    table: str
    checkpoint: str
    schema_location: str
    hints: str = ""
    rescue_column: str = "_rescued_data"
    merge_schema: bool = False
    source_system: str | None = None
    glob: str = "*.csv"
    max_files: int = 1000
    options: dict[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.sink = LedgerTable(self.spark, self.table)
        self.schema_log = SchemaLog(self.spark, self.schema_location)
        self.pinned = {f.name.lower(): f for f in schemas.contract(self.hints)} if self.hints else {}

    # Running

    def start(self, **trigger: object) -> StreamingQuery:
        """Start with ``availableNow=True`` or ``processingTime="15 seconds"``."""
        discovered = (
            self.spark.readStream.format("binaryFile")
            .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
            .option("pathGlobFilter", self.glob)
            .option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", self.max_files)
            # Files count by path alone: by default Spark passes over those a week older than the newest.
            .option("maxFileAge", "36500d")
            .load(self.source)
            .select("path", "length")
        )
        return (
            discovered.writeStream.option("checkpointLocation", self.checkpoint)
            .trigger(**trigger)
            .foreachBatch(self._load_batch)
            .start()
        )

    def drain(self) -> StreamingQuery:
        """Take everything present, then stop. Raises what stopped the stream."""
        query = self.start(availableNow=True)
        try:
            query.awaitTermination()
        except Exception as stopped:
            for known in (UnknownFieldError, SinkSchemaError):
                if known.__name__ in str(stopped):
                    raise known(str(stopped)) from stopped
            raise
        return query

    def read(self) -> DataFrame:
        return self.sink.read()

    def batches(self) -> DataFrame:
        """Rows and files per micro-batch; the stream's own progress counts files."""
        metric = F.col("operationMetrics")
        return self.sink.history().filter(F.col("operation") == STREAM).select(
            metric["batchId"].cast("bigint").alias("batch_id"),
            metric["numOutputRows"].cast("bigint").alias("rows"),
            metric["numSourceFiles"].cast("bigint").alias("files"),
        )

    def reset(self) -> None:
        """Forget table, progress and schema together: the next run reads all again."""
        self.sink.drop()
        delete_path(self.spark, self.checkpoint)
        delete_path(self.spark, self.schema_location)

    # One micro-batch

    def _load_batch(self, batch: DataFrame, batch_id: int) -> None:
        # Spark's id of the stream, which a new checkpoint changes.
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if self.sink.exists() and batch_id <= self.sink.last_batch(query_id):
            return
        sizes = {r.path: r.length for r in batch.collect()}  # at most max_files
        groups = files.header_groups(self.spark, sizes, str(self.options.get("sep", ",")))
        if not groups:
            return
        columns = self._resolve(groups)
        text = files.read_csv_groups(self.spark, groups, columns, **self.options)
        typed = self._typed(text, columns)
        typed = add_audit(typed, self.source_system)
        self._match_sink(typed.schema)
        self.sink.write(typed, STREAM, list(sizes), {"batchId": str(batch_id), "queryId": query_id})

    def _resolve(self, groups: dict[tuple[str, ...], list[str]]) -> list[str]:
        stored = self.schema_log.latest()
        known = {c.lower() for c in stored or ()}
        added: list[str] = []
        for header in groups:
            added += [c for c in header if c.lower() not in known | {a.lower() for a in added}]
        if not added:
            return stored
        self.schema_log.append((stored or []) + added)
        if stored is not None:
            raise UnknownFieldError(f"new columns: {', '.join(added)}")
        return added

    def _typed(self, text: DataFrame, columns: list[str]) -> DataFrame:
        """Cast the hinted columns; a value that does not fit becomes NULL and
        keeps its original in the rescue column, together with its file. A line with
        more fields than its header keeps its whole text there."""
        for missing in (c for c in columns if c not in text.columns):
            text = text.withColumn(missing, F.lit(None).cast("string"))
        hinted = [c for c in columns if c.lower() in self.pinned]
        rescued = {c: self._misfit(c) for c in hinted}
        surplus = F.col(files.SURPLUS_LINE)
        any_misfit = F.coalesce(*rescued.values(), surplus).isNotNull()
        fields = [v.alias(c) for c, v in rescued.items()]
        fields += [surplus.alias("_line"), F.col(files.SOURCE_PATH).alias("_file_path")]
        rescue = F.when(any_misfit, F.to_json(F.struct(*fields)))
        return text.select(
            *[self._cast(c).alias(c) if c in hinted else F.col(f"`{c}`") for c in columns],
            rescue.alias(self.rescue_column),
        )

    def _cast(self, name: str) -> Column:
        return F.col(f"`{name}`").try_cast(self.pinned[name.lower()].dataType.simpleString())

    def _misfit(self, name: str) -> Column:
        return F.when(self._cast(name).isNull(), F.col(f"`{name}`"))

    def _match_sink(self, schema: StructType) -> None:
        if not self.sink.exists():
            self.sink.create(schema)
            return
        held = {f.name.lower(): f for f in self.sink.schema}
        added = [f for f in schema if f.name.lower() not in held]
        changed = [f.name for f in schema if f.name.lower() in held and held[f.name.lower()].dataType != f.dataType]
        if changed:
            raise SinkSchemaError(f"column types differ from the target: {', '.join(changed)}")
        if added and not self.merge_schema:
            raise SinkSchemaError(f"columns the target lacks: {', '.join(f.name for f in added)}")
        if added:
            self.sink.add_columns(StructType(added))
