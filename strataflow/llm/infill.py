"""Fill-in-middle: texts cut at two token places and rearranged.

A unit is a stretch of ASCII letters or one other code point. The texts of a batch lie
one after another in one buffer, viewed as 64-bit words of eight bytes. Arithmetic on
whole words marks the bytes that end a unit, in the high bit of each byte; the marks of
a word are counted, the word of the k-th mark is found in the running sum, and the
byte within that word by clearing its lower marks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import documents, small_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100 texts, so many are cut, and of 100 that are cut, so many begin with their suffix.
CUT_PERCENT = 90
SPM_PERCENT = 20

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_BYTE = np.uint64(8)


def _each(byte: int) -> np.uint64:
    """The byte at all eight places of a word."""
    return np.uint64(byte) * _ONES


class Marks:
    """Marked bytes of a buffer: how many lie before a place, and where the k-th lies."""

    def __init__(self, words: np.ndarray):
        self.words = np.append(words, np.uint64(0))
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Marks in the bytes before ``place``."""
        word = place >> 3
        below = (np.uint64(1) << (_BYTE * (place & 7).astype(np.uint64))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def after(self, k: np.ndarray) -> np.ndarray:
        """The place behind the ``k``-th mark, counted from 1."""
        word = np.searchsorted(self.before, k, side="left") - 1
        left = self.words[word]
        skip = k - self.before[word] - 1
        for lower in range(7):
            left = np.where(skip > lower, left & (left - np.uint64(1)), left)
        lowest = left & (~left + np.uint64(1))
        return 8 * word + (np.bitwise_count(lowest - np.uint64(1)) >> 3) + 1


def marks_of(data: np.ndarray, ends: np.ndarray) -> tuple[Marks, Marks]:
    """Bytes that end a unit, and bytes that begin a code point, of UTF-8 texts that end
    before the places ``ends`` of ``data``."""
    words = np.concatenate([data, np.zeros(-len(data) % 8, np.uint8)]).view("<u8")
    folded = (words | _each(0x20)) & _each(0x7F)  # A-Z as a-z
    letter = (folded + _each(0x80 - ord("a"))) & ~(folded + _each(0x80 - ord("z") - 1)) & ~words & _HIGH
    inner = words & ~(words << np.uint64(1)) & _HIGH  # 10xxxxxx: not the first byte of a code point
    stop = _HIGH & ~_following(inner) & ~(letter & _following(letter))
    last = ends[ends > 0] - 1
    np.bitwise_or.at(stop, last >> 3, np.uint64(0x80) << (_BYTE * (last & 7).astype(np.uint64)))
    return Marks(stop), Marks(_HIGH & ~inner)


def _following(marks: np.ndarray) -> np.ndarray:
    """For each byte the mark of the next one."""
    return (marks >> _BYTE) | (np.append(marks[1:], np.uint64(0)) << np.uint64(56))


def draws(seed: str, key: object) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed, colon and key (null: nothing)."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))


def _rearranged(texts: pa.Array, keys: list, seed: str, cut_percent: int, spm_percent: int) -> dict[str, pa.Array]:
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[bounds[0]:bounds[-1]] if buffer else np.zeros(0, np.uint8)
    starts, ends = bounds[:-1] - bounds[0], bounds[1:] - bounds[0]
    units, points = marks_of(data, ends)
    before = units.rank(starts)
    n = units.rank(ends) - before
    h = np.array([draws(seed, key) for key in keys], np.int64).reshape(-1, 4)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    first, second = (np.where(c > 0, units.after(np.maximum(before + c, 1)) if len(data) else starts, starts)
                     for c in (np.minimum(one, two), np.maximum(one, two)))
    cut = (n > 0) & (h[:, 2] % 100 < cut_percent)
    spm = h[:, 3] % 100 < spm_percent
    form, output = [], []
    for row, text in enumerate(texts.to_pylist()):
        if not cut[row] or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            cut[row] = False
            form.append(PLAIN)
            output.append(text)
            continue
        a, b = int(first[row] - starts[row]), int(second[row] - starts[row])
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        head = (SUFFIX, suffix, PREFIX, prefix) if spm[row] else (PREFIX, prefix, SUFFIX, suffix)
        form.append(SPM if spm[row] else PSM)
        output.append(b"".join((*head, MIDDLE, middle)))
    chars = [points.rank(b) - points.rank(a) for a, b in ((starts, first), (first, second))]
    return {
        "n_units": pa.array(n, pa.int64()), "form": pa.array(form, pa.string()),
        "prefix_chars": pa.array(chars[0], pa.int64(), mask=~cut), "middle_chars": pa.array(chars[1], pa.int64(), mask=~cut),
        "output": pa.array(output, pa.binary()).cast(pa.string()),
    }


def fill_in_middle(
    docs: DataFrame, text: str = "text", key: str = "doc_id", seed: str = "1",
    cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """``docs`` with ``n_units``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Where a text is cut, and whether, depends on ``seed`` and ``key`` alone, so a repeated
    row or a second run gives the same output and equal keys the same numbers; null
    keys are one key of their own. Forms: ``psm`` is prefix, suffix, middle, each behind
    its sentinel; ``spm`` has the suffix first; ``plain`` is the text as it is, for texts that
    are empty, null (output: empty) or hold a sentinel, and for the share that is not cut.
    Character counts are null for plain texts. Input columns of the five names are
    replaced. Memory is bounded by an Arrow batch of about 8 MB or the longest text.
    """
    added = ("n_units", "form", "prefix_chars", "middle_chars", "output")
    columns = [c for c in docs.columns if c not in added]
    source = small_batches(docs.select(*[F.col(f"`{c}`") for c in columns]))
    zero = F.lit(None).cast("bigint")
    schema = source.select(
        "*", zero.alias("n_units"), F.lit("").alias("form"), zero.alias("prefix_chars"), zero.alias("middle_chars"), F.lit("").alias("output"),
    ).schema
    at, by = columns.index(text), columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _rearranged(batch.column(at), batch.column(by).to_pylist(), seed, cut_percent, spm_percent)
            yield pa.RecordBatch.from_arrays([*batch.columns, *found.values()], [*batch.schema.names, *found])

    return source.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output stands for. No text that is cut holds a sentinel, and no
    end of one is the beginning of another, so a sentinel is found where it was put."""
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == PSM, F.concat(parts[1], parts[3], parts[2]))
        .when(form == SPM, F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


SQL = """
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
    FROM documents
), drawn AS (
    SELECT doc_id, t, u, len(u) AS n,
           CAST('0x' || x[1:8] AS BIGINT) % (len(u) + 1) AS one, CAST('0x' || x[9:16] AS BIGINT) % (len(u) + 1) AS two,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR CAST('0x' || x[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                WHEN CAST('0x' || x[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
), parts AS (
    SELECT doc_id, t, n, form,
           array_to_string(u[1:least(one, two)], '') AS p,
           array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS m,
           array_to_string(u[greatest(one, two) + 1:], '') AS s
    FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
