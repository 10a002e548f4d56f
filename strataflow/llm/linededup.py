"""Line dedup: winnowed windows of lines, later repeated runs deleted."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import documents, small_batches, written

#: Words from which on a repeated run of lines is deleted.
MIN_WORDS = 50

_WINDOW = "low bigint, block bigint, place int, start int, stop int"


def line_windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, text_hash, low, block, place, start, stop)``, one row per window.

    A window is a least stretch of lines with ``min_words`` words: from each line
    on, and up to each line. ``low`` is the least line hash in it and ``place``
    the line that has it (the last of equals), ``block`` the hash of the whole
    stretch. Lines are compared without white space at their ends; lines without
    words are passed over. Any run of ``min_words`` words holds such a window, so
    two copies of the run select the same minimum, and each line of the run lies
    in some window of it.
    """
    source = small_batches(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # one document at a time bounds the memory
                found = _windows(batch.column(2)[row].as_py(), min_words)
                n = len(found[0])
                if n:
                    key = [pa.array([batch.column(i)[row].as_py()] * n, pa.int64()) for i in (0, 1)]
                    yield pa.record_batch([*key, *map(pa.array, found)], ["doc_id", "text_hash", "low", "block", "place", "start", "stop"])

    return source.mapInArrow(run, f"doc_id bigint, text_hash bigint, {_WINDOW}")


def _windows(text: bytes | None, min_words: int):
    lines = [line.strip() for line in (text or b"").split(b"\n")]
    counts = np.array([len(line.split()) for line in lines])
    real = np.flatnonzero(counts)
    ends = np.cumsum(counts[real])
    if not len(real) or ends[-1] < min_words:
        return ([],) * 5
    hashes = np.array([xxhash.xxh64_intdigest(lines[i]) for i in real], "u8")
    before = ends - counts[real]
    stop = np.searchsorted(ends, before + min_words)  # first line at which enough words are reached
    forward = [(i, j) for i, j in enumerate(stop.tolist()) if j < len(real)]
    start = np.searchsorted(before, ends - min_words, "right") - 1  # last line from which enough are left
    backward = [(i, j) for j, i in enumerate(start.tolist()) if i >= 0]
    raw = hashes.tobytes()
    low, block, place, first, last = [], [], [], [], []
    for i, j in sorted({*forward, *backward}):
        window = hashes[i:j + 1]
        at = j - int(window[::-1].argmin())
        low.append(hashes[at])
        block.append(xxhash.xxh3_64_intdigest(raw[8 * i:8 * j + 8]))
        place.append(real[at])
        first.append(real[i])
        last.append(real[j])
    signed = (np.array(x, "u8").view("i8") for x in (low, block))
    return (*signed, *(np.array(x, "i4") for x in (place, first, last)))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, text_hash, runs)``: per document with repeated lines, the runs to
    delete as an array of (start, stop, first_doc_id), lines counted from 0.

    Documents come in order of doc_id (null last). A window whose content stands
    wholly before it, there or in an earlier document, is repeated. It is paired
    with its first occurrence alone, so a passage in n documents makes n rows, and
    firsts are found with partial aggregation, so a common one is no hot task.
    Windows of one minimum and shift are one match; matches of one shift that
    touch are one run, which is how a match extends both ways.
    """
    windows = written(line_windows(docs, min_words), "line-windows")
    spot = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "start", "stop")
    firsts = windows.groupBy("low", "block").agg(F.count("*").alias("n"), F.min(spot).alias("first")).where("n > 1")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    matches = (
        windows.join(firsts.drop("n"), ["low", "block"])
        .where(~same | (F.col("start") > F.col("first.stop")))
        .select("doc_id", "text_hash", F.col("first.doc_id").alias("first_doc_id"), F.col("first.text_hash").alias("first_hash"),
                (F.col("start") - F.col("first.start")).alias("shift"), "place", "start", "stop")
    )
    by_minimum = matches.groupBy("doc_id", "text_hash", "first_doc_id", "first_hash", "shift", "place").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop")
    )
    runs = by_minimum.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop", "first_doc_id"))).alias("runs")
    )  # at most two windows a line of the document itself
    return runs.withColumn("runs", F.aggregate(
        "runs", F.expr("CAST(array() AS array<struct<start:int,stop:int,first_doc_id:bigint>>)"), _join_run
    ))


def _join_run(done, run):
    """Add a run to the list, or lengthen the last one if they touch."""
    last = F.try_element_at(done, F.lit(-1))
    longer = F.struct(
        last["start"].alias("start"), F.greatest(last["stop"], run["stop"]).alias("stop"), last["first_doc_id"].alias("first_doc_id")
    )
    touches = F.coalesce(run["start"] <= last["stop"] + 1, F.lit(False))
    return F.when(touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(
        F.concat(done, F.array(run))
    )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated runs cut out of ``text``, plus ``n_lines`` (before)
    and ``removed_runs``.

    A null or short text stays as it is. Rows that repeat doc_id and text are one
    document and get the same result. All other columns pass through; columns
    named like the added ones are replaced.
    """
    docs = docs.drop("n_lines", "removed_runs")
    runs = repeated_runs(docs, min_words).select(F.col("doc_id").alias("__line_doc"), F.col("text_hash").alias("__line_hash"), F.col("runs").alias("removed_runs"))
    joined = docs.join(runs, F.col("doc_id").eqNullSafe(F.col("__line_doc")) & (F.xxhash64("text") == F.col("__line_hash")), "left").drop("__line_doc", "__line_hash")
    lines = F.split("text", "\n", -1)
    cut = F.aggregate(
        "removed_runs",
        F.struct(F.expr("CAST(array() AS array<string>)").alias("kept"), F.lit(0).alias("next")),
        lambda done, run: F.struct(
            F.concat(done["kept"], F.slice(lines, done["next"] + 1, run["start"] - done["next"])).alias("kept"),
            (run["stop"] + 1).alias("next"),
        ),
        lambda done: F.array_join(F.concat(done["kept"], F.slice(lines, done["next"] + 1, F.size(lines))), "\n"),
    )
    return joined.withColumns({
        "n_lines": F.coalesce(F.size(lines), F.lit(0)),
        "text": F.when(F.col("removed_runs").isNull(), F.col("text")).otherwise(cut),
    })


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(documents(spark, sf_dir))
    removed = F.coalesce(F.aggregate("removed_runs", F.lit(0), lambda n, r: n + r["stop"] - r["start"] + 1), F.lit(0))
    return done.select(
        "doc_id", "text", F.col("n_lines").cast("bigint").alias("n_lines"), removed.cast("bigint").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("removed_runs", lambda r: F.concat_ws("-", r["start"], r["stop"])), ","), F.lit("")).alias("removed"),
    )


#: The same rows: a line goes if a window with it stands wholly before that window.
SQL = f"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
every_line AS (SELECT doc_id, unnest(lines) AS raw, generate_subscripts(lines, 1) - 1 AS pos FROM docs),
stripped AS (SELECT doc_id, pos, regexp_replace(raw, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS line FROM every_line),
counted AS (
    SELECT *, len(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+')) AS n FROM stripped WHERE line <> ''
),
real AS (
    SELECT doc_id, pos, line, n, row_number() OVER w AS i, sum(n) OVER w AS ends, sum(n) OVER w - n AS before
    FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
),
forward AS (SELECT a.doc_id, a.i, b.i AS j FROM real a ASOF JOIN real b ON a.doc_id = b.doc_id AND a.before + {MIN_WORDS} <= b.ends),
backward AS (SELECT a.doc_id, b.i, a.i AS j FROM real a ASOF JOIN real b ON a.doc_id = b.doc_id AND a.ends - {MIN_WORDS} >= b.before),
spans AS (SELECT * FROM forward UNION SELECT * FROM backward),
texts AS (SELECT doc_id, list(line ORDER BY i) AS lines, list(pos ORDER BY i) AS places FROM real GROUP BY doc_id),
windows AS (
    SELECT s.doc_id, t.places[s.i] AS start, t.places[s.j] AS stop, array_to_string(t.lines[s.i:s.j], chr(10)) AS block
    FROM spans s JOIN texts t USING (doc_id)
),
firsts AS (SELECT block, min(struct_pack(d := doc_id, s := start, e := stop)) AS f FROM windows GROUP BY block),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(start, stop + 1)) AS pos
    FROM windows JOIN firsts USING (block) WHERE doc_id <> f.d OR start > f.e
),
islands AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM gone),
runs AS (SELECT doc_id, min(pos) AS a, max(pos) AS b, count(*) AS n FROM islands GROUP BY doc_id, g),
removed AS (SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS removed, sum(n) AS n FROM runs GROUP BY doc_id),
kept AS (
    SELECT doc_id, string_agg(raw, chr(10) ORDER BY pos) AS text
    FROM every_line ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN r.n IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text, len(d.lines)::BIGINT AS n_lines,
       coalesce(r.n, 0)::BIGINT AS n_removed, coalesce(r.removed, '') AS removed
FROM docs d LEFT JOIN removed r USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
