"""SimHash near-duplicates, candidates found by Golay-code fuzzy hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import documents, small_batches, words, written
from strataflow.llm.components import connected_components, forest

SHINGLE = 3
RADIUS = 3
SEGMENT_BITS = 16
SEGMENTS = 4
#: Rows of one side that a task compares at once within one hot key.
BLOCK = 2048
#: Generator polynomial of the binary Golay code (23, 12, 7), a fixed value.
GOLAY_POLYNOMIAL = 0b110001110101
#: Keys of one seed: place, 16 bits of the whole segment, 12 of the codeword.
SEED_KEYS = SEGMENTS << 28


# -- fingerprints -----------------------------------------------------------


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One ``(doc_id, fp)`` row per document, the 64-bit SimHash as a BIGINT.

    Words are split at ASCII white space with A-Z in lower case; a text shorter
    than one shingle is one shingle, a null, empty or blank text has fingerprint 0.
    """
    source = small_batches(docs).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [_simhash(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.record_batch({"doc_id": batch.column(0), "fp": pa.array(np.array(prints, "u8").view("i8"))})

    return source.mapInArrow(run, "doc_id bigint, fp bigint")


def _simhash(text: bytes | None, shingle: int) -> int:
    tokens = words(text or b"")
    if not tokens:
        return 0
    size = min(shingle, len(tokens))
    grams = map(b" ".join, zip(*(tokens[i:] for i in range(size))))
    return _majority(np.fromiter(map(_xxh64, grams), "u8", len(tokens) - size + 1))


def _majority(hashes: np.ndarray, piece: int = 1 << 14) -> int:
    """Each bit that is set in over half of the hashes."""
    set_bits = np.zeros(64, np.int64)
    for start in range(0, len(hashes), piece):
        bits = np.unpackbits(hashes[start:start + piece].view("u1"), bitorder="little")
        set_bits += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("u8")[0])


def _xxh64(gram: bytes) -> int:
    return xxhash.xxh64_intdigest(gram, 42)


# -- candidate keys ---------------------------------------------------------


@lru_cache(1)
def golay_keys() -> list[list[int]]:
    """For each 16-bit segment, padded to 23 bits: the number of its own
    codeword first, then of every codeword at distance 4.

    The code is perfect: each word lies within 3 bits of exactly one codeword.
    So if two words differ in one bit, the codeword of the one is within 4 bits
    of the other and thus in its list, whichever of the two is looked up.
    """
    messages = np.arange(4096, dtype=np.int64)
    codewords = np.zeros(4096, np.int64)
    for bit in range(12):  # multiply the message by the generator over GF(2)
        codewords ^= np.where(messages >> bit & 1, GOLAY_POLYNOMIAL << bit, 0)
    table = []
    for segment in range(1 << SEGMENT_BITS):
        away = np.bitwise_count(codewords ^ segment)
        table.append([int(away.argmin()), *map(int, np.flatnonzero(away == 4))])
    return table


def _golay_table(spark: SparkSession) -> DataFrame:
    """65,536 rows whatever the data, which is the proven bound of its broadcast."""
    rows = pa.table({
        "segment": pa.array(range(1 << SEGMENT_BITS), pa.int32()),
        "near": pa.array(golay_keys(), pa.list_(pa.int32())),
    })
    return spark.createDataFrame(rows)


def candidate_keys(prints: DataFrame) -> DataFrame:
    """``prints(id, fp, seed)`` to ``(key, id, stored)``: four stored keys a fingerprint,
    which are looked up as well, and about seventeen only looked up. Fingerprints of
    different seeds share none.

    64 bits make four segments in a ring. Among 3 wrong bits some segment is
    whole while the one after it has at most one wrong bit: with one segment
    whole, the three others have one wrong bit each; with two or three whole, a
    whole one precedes another whole one or the one with a single wrong bit.
    A key is the number of the whole segment, its 16 bits, and a codeword number
    of the next segment: its own when stored, each of the list when looked up.
    """
    spark = prints.sparkSession
    mask = (1 << SEGMENT_BITS) - 1
    segments = [F.shiftrightunsigned("fp", i * SEGMENT_BITS).bitwiseAND(F.lit(mask)).cast("int") for i in range(SEGMENTS)]
    ring = F.array(*(
        F.struct(F.lit(i).alias("place"), segments[i].alias("whole"), segments[(i + 1) % SEGMENTS].alias("segment"))
        for i in range(SEGMENTS)
    ))
    placed = prints.select("id", "fp", "seed", F.explode(ring).alias("s")).select("id", "fp", "seed", "s.*")
    near = placed.join(F.broadcast(_golay_table(spark)), "segment")
    listed = near.select("id", "seed", "place", "whole", F.posexplode("near").alias("at", "code"))
    key = F.col("seed").cast("bigint") * SEED_KEYS + F.col("place") * (1 << 28) + F.col("whole").cast("bigint") * (1 << 12) + F.col("code")
    return listed.select(key.alias("key"), "id", (F.col("at") == 0).alias("stored"))


def near_edges(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(a, b)`` links of ids that join the same components as all pairs with
    fingerprints of one seed at ``radius`` or fewer differing bits.

    Every candidate of a key is compared; of the links found a task keeps a
    spanning forest, so a group of copies makes rows in proportion to its size.
    """
    if radius > RADIUS:
        raise ValueError("the keys find fingerprints at up to 3 differing bits")
    keys = candidate_keys(prints)
    sizes = keys.groupBy("key").agg(F.count("*").alias("n"), F.max("stored").alias("held"))
    shared = written(sizes.where("held AND n > 1").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "simhash-shared")
    found = written(keys.join(shared, "key"), "simhash-candidates")
    dealt = _dealt(found).withColumn("seed", F.floor(F.col("key") / SEED_KEYS).cast("int")).join(prints, ["id", "seed"])
    columns = ("key", "left", "right", "stored", "id", "fp")
    parts = dealt.select(*columns).repartition("key", "left", "right").sortWithinPartitions("key", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for group, (stored, ids, fps) in _whole_groups(batches):
            near = lambda x, y: (np.bitwise_count((fps[x] ^ fps[y]).view("u8")) <= radius) & (ids[x] != ids[y])
            x, y = _compare(group, stored, near)
            kept.append(forest(ids[x], ids[y]))
            if sum(len(x) for x, _ in kept) > 1 << 20:
                kept = [forest(*map(np.concatenate, zip(*kept)))]
                if len(kept[0][0]) > 1 << 19:
                    yield pa.record_batch({"a": pa.array(kept[0][0]), "b": pa.array(kept[0][1])})
                    kept = []
        if kept:
            a, b = forest(*map(np.concatenate, zip(*kept)))
            yield pa.record_batch({"a": pa.array(a), "b": pa.array(b)})

    return parts.mapInArrow(run, "a bigint, b bigint")


def _dealt(found: DataFrame) -> DataFrame:
    """``found(key, id, stored, blocks)`` with each row in every pair of blocks it takes
    part in: a key with more than ``BLOCK`` rows is dealt out as pairs of blocks, each
    compared in a task of its own. A stored row is looked up as well."""
    roles = F.when(F.col("stored"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))
    return (
        found.withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
        .withColumn("stored", F.explode(roles))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key",
            F.when(F.col("stored"), F.col("own")).otherwise(F.col("other")).alias("left"),
            F.when(F.col("stored"), F.col("other")).otherwise(F.col("own")).alias("right"),
            "stored", "id",
        )
    )


def _whole_groups(batches: Iterator[pa.RecordBatch]):
    """Batches cut at group ends; a group has at most about two blocks of rows."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        if rest is not None:
            columns = [np.concatenate(pair) for pair in zip(rest, columns)]
        if not len(columns[0]):
            continue
        change = np.ones(len(columns[0]), bool)
        change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:3]])
        last = int(np.flatnonzero(change)[-1])
        rest = [c[last:] for c in columns]
        if last:
            yield np.cumsum(change[:last]), [c[:last] for c in columns[3:]]
    if rest is not None:
        yield np.zeros(len(rest[0]), np.int64), rest[3:]


def _compare(group, stored, good, most: int = 1 << 21):
    """Places ``(x, y)`` of a stored and a looked-up row of the same group that are ``good(x, y)``."""
    held, asked = np.flatnonzero(stored), np.flatnonzero(~stored)
    starts = np.searchsorted(group[held], group[asked], "left")
    counts = np.searchsorted(group[held], group[asked], "right") - starts
    ends = np.cumsum(counts)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(asked):  # some looked-up rows at a time bound the memory
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        n = counts[at:upto]
        first = np.repeat(starts[at:upto], n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        x, y = held[first + offset], np.repeat(asked[at:upto], n)
        kept = good(x, y)
        a.append(x[kept])
        b.append(y[kept])
        at = upto
    return np.concatenate(a), np.concatenate(b)


# -- operator ---------------------------------------------------------------


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fp, component_id)`` for each document.

    component_id is the smallest doc_id that links reach, the document itself
    included. Equal fingerprints are linked, the zero ones of empty texts too, and
    are folded before candidates are looked for. A null doc_id takes part by its
    text but is never a component's name (null only if nobody else is in it).
    Rows of the same doc_id stay rows of their own. An empty table gives no rows.
    """
    prints = written(fingerprints(docs, shingle), "simhash")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    nodes = distinct.select(F.col("fp").alias("id"), "fp", F.lit(0).alias("seed"))
    roots = connected_components(near_edges(nodes, radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, components: DataFrame) -> DataFrame:
    """One document of each component: the row of its smallest doc_id, all columns kept.

    If several rows bear the smallest doc_id, each stays: they are one document to
    every later join. Rows whose doc_id is null cannot be told apart and stay.
    """
    gone = components.where("doc_id <> component_id").select("doc_id").distinct()
    kept = components.where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(gone.join(kept, "doc_id", "left_anti"), "doc_id", "left_anti").select(*docs.columns)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
