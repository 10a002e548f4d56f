"""Interleave sources at target weights by Pfair scheduling."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import batched
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataflow.llm.common import documents, partitions, written

#: Documents a block holds; the last one of a source may hold fewer.
BLOCK = 16
#: A round of the schedule is a multiple of so many slots; a target weight is a whole number of slots.
FRAME = 1000
#: Slots of a round for each source, at least.
SLOTS = 10
#: Columns that mixing adds.
ADDED = ("block", "place", "slot", "release", "deadline", "share")


def shares(weights: dict[str, int], frame: int = FRAME) -> dict[str, int]:
    """Slots of a frame for each source: one to start with, the others in proportion to
    the whole-number weights by largest remainder (ties: smaller key)."""
    if len(weights) > frame:
        raise ValueError(f"{len(weights)} sources need a frame of at least as many slots, not {frame}")
    total, free = sum(weights.values()), frame - len(weights)
    if not total:
        weights, total = dict.fromkeys(weights, 1), len(weights)
    given = {k: 1 + free * w // total for k, w in weights.items()}
    by_remainder = sorted(weights, key=lambda k: (-(free * weights[k] % total), k))
    for k in by_remainder[: frame - sum(given.values())]:
        given[k] += 1
    return given


def schedule(given: dict[str, int]) -> list[tuple[str, int, int]]:
    """One frame as ``(source, block of the frame, slot)``.

    With F slots, a of them its own, a source's block j (from 0) is released at
    floor(j F / a) and due by ceil((j + 1) F / a). In each slot the released block
    with the earliest deadline runs (ties: smaller key). The shares fill the frame,
    so each block meets its window, which is the Pfair property: at every slot a
    source is less than one block away from its exact share.
    """
    return list(_slots(given))


def _slots(given: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    frame = sum(given.values())
    waiting = [(0, -(-frame // a), k, 0) for k, a in given.items()]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    for slot in range(frame):
        while waiting and waiting[0][0] <= slot:
            _, due, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due, k, j))
        _, k, j = heapq.heappop(ready)
        yield k, j, slot
        if j + 1 < given[k]:
            a = given[k]
            heapq.heappush(waiting, ((j + 1) * frame // a, -(-(j + 2) * frame // a), k, j + 1))


def mix(docs: DataFrame, targets: dict[str | None, int] | None = None, block: int = BLOCK, frame: int | None = None) -> DataFrame:
    """``docs`` with the slot of each row's block in the mixture; sorting by
    ``slot, place`` gives the mixture.

    ``targets`` gives each source a whole-number weight, by default the whole square
    root of its row count; a source it does not name has one slot a frame. A null
    source is a source. Inside a source rows come in the order of the MD5 of their
    doc_id (null as empty), then doc_id. The schedule repeats every ``frame`` slots,
    so a block's slot follows from its number and nothing is simulated over the
    data. By default a frame is the least multiple of ``FRAME`` with ``SLOTS`` slots for
    each source. One task makes the schedule of a frame, holding one entry a source. Once a source has run out its slots stay empty and every other row keeps
    its slot: no row is dropped or repeated. Columns named as the added ones are
    replaced; an empty table gives no rows.
    """
    rows = docs.drop(*ADDED).withColumn("__mix_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("bigint")
    # ranges of the hash split a hot source; the order does not depend on their number
    ranges = 4 * partitions(docs.sparkSession)
    rows = rows.withColumns({"__mix_hash": hashed, "__mix_range": F.floor(hashed * ranges / (1 << 32)).cast("int")})
    counts = rows.groupBy("__mix_key", "__mix_range").agg(F.count("*").alias("n"))
    offsets = counts.select(
        "__mix_key", "__mix_range", (F.sum("n").over(W.partitionBy("__mix_key").orderBy("__mix_range")) - F.col("n")).alias("__mix_offset")
    )
    sizes = written(counts.groupBy("__mix_key").agg(F.sum("n").alias("n")), "mixing-sizes")
    sources = sizes.count()
    if frame is None:
        frame = FRAME * -(-SLOTS * sources // FRAME)
    if sources > frame:
        raise ValueError(f"{sources} sources need a frame of at least as many slots, not {frame}")
    named = None if targets is None else {"" if k is None else f"={k}": w for k, w in targets.items()}
    plan = written(sizes.repartition(1).mapInArrow(_planned(named, frame), PLAN), "mixing-plan")
    order = W.partitionBy("__mix_key", "__mix_range").orderBy("__mix_hash", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), "doc_id")
    numbered = rows.withColumn("__mix_row", F.row_number().over(order).cast("bigint")).join(offsets, ["__mix_key", "__mix_range"])
    number = F.col("__mix_row") + F.col("__mix_offset") - 1
    placed = numbered.withColumns({"block": F.floor(number / block), "place": number % block})
    # the plan is a written table, so Spark knows its size when it chooses these joins
    turned = placed.join(plan.select("__mix_key", "share").distinct(), "__mix_key").withColumn("__mix_turn", F.col("block") % F.col("share"))
    timed = turned.join(plan.drop("share"), ["__mix_key", "__mix_turn"])
    return timed.withColumns({
        "slot": F.floor(F.col("block") / F.col("share")) * frame + F.col("__mix_slot"),
        "release": F.floor(F.col("block") * frame / F.col("share")),
        "deadline": F.ceil((F.col("block") + 1) * frame / F.col("share")),
    }).select(*(c for c in docs.columns if c not in ADDED), *ADDED)


PLAN = "__mix_key string, __mix_turn bigint, __mix_slot bigint, share bigint"


def _planned(named: dict[str, int] | None, frame: int):
    """All ``(key, rows)`` of a table to the rows of one frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = {}
        for batch in batches:
            for k, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                weights[k] = isqrt(n) if named is None else named.get(k, 0)
        given = shares(weights, frame) if weights else {}
        for rows in batched(_slots(given), 1 << 14):
            keys, turns, slots = zip(*rows)
            yield pa.record_batch({
                "__mix_key": pa.array(keys, pa.string()), "__mix_turn": pa.array(turns, pa.int64()),
                "__mix_slot": pa.array(slots, pa.int64()), "share": pa.array([given[k] for k in keys], pa.int64()),
            })

    return run


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir).select("doc_id", "source"))


SQL = f"""
WITH RECURSIVE numbered AS (
    SELECT doc_id, source, coalesce('=' || source, '') AS key,
           row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1 AS number
    FROM documents
),
sizes AS (SELECT key, floor(sqrt(count(*)))::BIGINT AS w FROM numbered GROUP BY key),
framed AS (SELECT {FRAME} * (({SLOTS} * count(*) + {FRAME} - 1) // {FRAME}) AS frame FROM sizes),
totals AS (SELECT sum(w)::BIGINT AS total, any_value(frame) - count(*) AS free FROM sizes, framed),
floors AS (SELECT key, 1 + free * w // total AS a, free * w % total AS r FROM sizes, totals),
ranked AS (
    SELECT key, a, row_number() OVER (ORDER BY r DESC, key) AS rank, frame - sum(a) OVER () AS missing FROM floors, framed
),
given AS (SELECT key, (a + CASE WHEN rank <= missing THEN 1 ELSE 0 END)::BIGINT AS a FROM ranked),
listed AS (SELECT list(a ORDER BY key) AS shares, list(key ORDER BY key) AS keys FROM given),
steps AS (
    SELECT -1::BIGINT AS slot, 0::BIGINT AS chosen, -1::BIGINT AS turn, list_transform(shares, lambda x: 0::BIGINT) AS done FROM listed
    UNION ALL
    SELECT slot, chosen, done[chosen] AS turn, list_transform(done, lambda x, i: CASE WHEN i = chosen THEN x + 1 ELSE x END) AS done
    FROM (
        SELECT slot + 1 AS slot, done, list_position(due, list_min(due)) AS chosen
        FROM (
            SELECT slot, done, list_transform(done, lambda x, i: CASE WHEN x < shares[i] AND x * frame // shares[i] <= slot + 1
                                              THEN ((x + 1) * frame + shares[i] - 1) // shares[i] END) AS due
            FROM steps, listed, framed WHERE slot + 1 < frame
        )
    )
),
plan AS (SELECT keys[chosen] AS key, turn, slot FROM steps, listed WHERE slot >= 0)
SELECT n.doc_id, n.source, n.number // {BLOCK} AS block, n.number % {BLOCK} AS place,
       n.number // {BLOCK} // g.a * frame + p.slot AS slot,
       n.number // {BLOCK} * frame // g.a AS release,
       ((n.number // {BLOCK} + 1) * frame + g.a - 1) // g.a AS deadline, g.a AS share
FROM numbered n JOIN given g USING (key) CROSS JOIN framed JOIN plan p ON p.key = n.key AND p.turn = n.number // {BLOCK} % g.a
"""
