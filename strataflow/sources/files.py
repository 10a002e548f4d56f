"""File scans: CSV, nested JSON, header-aware CSV, landing inventory."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from urllib import parse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SOURCE_PATH = "_source_path"
SOURCE_FILE = "_source_file"
SURPLUS_LINE = "_surplus_line"
DIALECT = ("sep", "delimiter", "quote", "escape", "charToEscapeQuoteEscaping")

ONE_PETABYTE = str(1 << 50)
WHOLE_FILE = 1 << 20  # bytes up to which a file is read whole for its header


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str, **options: object
) -> DataFrame:
    """CSV with a header row and an explicit schema; a bad value becomes NULL."""
    return spark.read.options(header=True, **options).schema(schema).csv(_listed(path))


def read_csv_inferred(spark: SparkSession, path: str | Sequence[str], **options: object) -> DataFrame:
    """CSV with detected types, for small curated reference data (one extra pass)."""
    return spark.read.options(header=True, inferSchema=True, **options).csv(_listed(path))


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str, **options: object
) -> DataFrame:
    """JSON Lines with an explicit, possibly nested schema."""
    return spark.read.options(**options).schema(schema).json(_listed(path))


def with_source(df: DataFrame) -> DataFrame:
    """Capture the origin of each row while the file scan still offers it."""
    return df.withColumns(
        {SOURCE_PATH: F.col("_metadata.file_path"), SOURCE_FILE: F.col("_metadata.file_name")}
    )


def inventory(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Files below landing folders: path, length, modificationTime. No content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(_listed(path)).select("path", "length", "modificationTime")


def listing_session(spark: SparkSession) -> SparkSession:
    """A like session whose scans are cut by cores alone. Listing opens no file,
    so the usual limit of bytes per task would only make needless tasks."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if not key.startswith("spark.") or (key.startswith("spark.sql.") and spark.conf.isModifiable(key)):
            session.conf.set(key, value)
    session.conf.set("spark.sql.files.maxPartitionBytes", ONE_PETABYTE)
    return session


def csv_headers(spark: SparkSession, sizes: Mapping[str, int]) -> dict[str, str]:
    """First line that is not blank of each file, keyed by path; files without one are absent.

    ``sizes`` gives the bytes of each path. Files of up to ``WHOLE_FILE`` are read by
    one job, many a task; larger ones by another, with a task per file. Both stay in the JVM.
    """
    small = [literal(p) for p, n in sizes.items() if n <= WHOLE_FILE]
    large = [literal(p) for p, n in sizes.items() if n > WHOLE_FILE]
    found = []  # a line per file
    if small:
        whole = spark.read.text(small, wholetext=True)
        line = F.regexp_extract("value", r"[^\r\n]*[^\s][^\r\n]*", 0).alias("value")
        found += whole.select(F.col("_metadata.file_path").alias("path"), line).filter("value <> ''").collect()
    if large:
        found += first_lines(spark, large).filter("value IS NOT NULL").collect()
    named = {_bare(p): p for p in sizes}
    return {named[_bare(parse.unquote(row.path))]: row.value for row in found}


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """First line that is not blank of each file, of which it holds one line at a time.

    A file's lines are aggregated in the order of the one task that reads them. A Python
    function that returned after a line would be sent the others all the same, in batches of a row.
    """
    session = listing_session(spark)
    session.conf.set("spark.sql.files.openCostInBytes", ONE_PETABYTE)  # no two files in one task
    filled = F.when(F.btrim("value", F.lit(" \t\n\x0b\f\r")) != "", F.col("value"))
    lines = session.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), filled.alias("value"))
    return lines.groupBy("path").agg(F.first("value", ignorenulls=True).alias("value"))


def _bare(path: str) -> str:
    """A path without its scheme, of which ``file:/x`` and ``file:///x`` are two forms."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*:)?/*", "", path)


def header_groups(spark: SparkSession, sizes: Mapping[str, int], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their column names, in header order. Blank lines before a header
    do not count, as for Spark's reader; a file of blank lines only is in no group."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in sorted(csv_headers(spark, sizes).items()):
        names = tuple(next(csv.reader([line.lstrip("\ufeff")], delimiter=sep)))
        if not all(name.strip() for name in names):
            raise ValueError(f"the header of {path} leaves a column without a name: {line}")
        groups.setdefault(names, []).append(path)
    return groups


def read_csv_groups(
    spark: SparkSession,
    groups: dict[tuple[str, ...], list[str]],
    columns: Iterable[str] | None = None,
    **options: object,
) -> DataFrame:
    """All-text scan that binds columns by name although Spark binds them by position.

    One scan per distinct header, united by name; a column a file lacks is NULL.
    ``enforceSchema`` off makes Spark itself check each file against its header.
    Names that differ from ``columns`` in case alone are taken as those. A line with
    fewer fields than the header has NULL for the rest; one with more keeps its text
    in ``_surplus_line``, which is NULL otherwise.
    """
    known = {name.lower(): name for name in columns or ()}
    parts = []
    for names, paths in groups.items():
        text = ", ".join(f"`{name}` STRING" for name in names)
        # Spark keeps the text of a line whose number of fields is not the header's.
        read = read_csv(
            spark, [literal(p) for p in paths], f"{text}, `{SURPLUS_LINE}` STRING",
            enforceSchema=False, columnNameOfCorruptRecord=SURPLUS_LINE, columnPruning=False, **options,
        )
        dialect = {k: str(v) for k, v in options.items() if k in DIALECT}
        more = F.from_csv(SURPLUS_LINE, f"{text}, `{SURPLUS_LINE}` STRING", dialect)[SURPLUS_LINE]
        part = with_source(read)
        parts.append(part.select(*[F.col(f"`{n}`").alias(known.get(n.lower(), n)) for n in names],
                                 F.when(more.isNotNull(), F.col(SURPLUS_LINE)).alias(SURPLUS_LINE),
                                 SOURCE_PATH, SOURCE_FILE))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def refuse_surplus(df: DataFrame) -> DataFrame:
    """Fail on a line that has more fields than its header names."""
    message = F.concat(F.lit("more fields than the header names: "), SURPLUS_LINE, F.lit(" in "), SOURCE_PATH)
    return df.filter(F.when(F.col(SURPLUS_LINE).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True))


def literal(path: str) -> str:
    """A listed path as a reader argument: marks that would be patterns are escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _listed(path: str | Sequence[str]) -> str | list[str]:
    return path if isinstance(path, str) else list(path)
