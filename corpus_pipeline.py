"""From raw documents to token ids: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import bpe, linededup, mixing, simhash, toxicity
from strataflow.llm.common import documents, written

#: What every stage but the last returns.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject. The chain is fitted on
    a bounded sample of the labelled documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxic_documents(docs, labels).where("NOT toxic").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut out; a document of which nothing but
    white space is left goes. n_chars is counted anew where lines were cut."""
    done = linededup.dedup_lines(docs)
    cut = F.col("removed_runs").isNotNull()
    kept = done.where(~cut | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    chars = F.when(cut, F.length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", chars.cast("bigint")).select(*COLUMNS)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id. Copies
    are texts whose SimHash over three-word shingles differs in three bits or fewer,
    and texts that such links reach."""
    return simhash.keep_first(docs, simhash.simhash_components(docs)).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture, files and rows in slot order."""
    mixed = mixing.mix(docs)
    return mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its token ids, and whether decoding them gives the text back."""
    path = public_tokenizers.path(bpe.RANKS)
    return bpe.encode_checked(docs, path).select(*COLUMNS, "ids", F.size("ids").cast("bigint").alias("n_tokens"), "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_near),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: The classifier and the recursion over merges have no SQL form; tests compare
#: every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
