"""Byte-level BPE by recursive DuckDB queries inside Spark tasks."""

from __future__ import annotations

import base64
import ctypes
import gc
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import documents, small_batches

RANKS = "byte_bpe_50k.tiktoken"
#: Bytes of text a task encodes at once, unless one text alone has more.
CHUNK_BYTES = 5 << 18
#: Words whose ids a Python worker remembers from task to task, in its database. A full
#: memory starts anew; ids do not depend on it.
MEMORY_WORDS = 700_000
#: Words that one recursive query contracts at most, and of a thrifty codec; its state is
#: what a worker's memory goes to.
WORDS_PER_QUERY = (200_000, 25_000)
#: Bytes above which a word is first cut into independent parts.
LONG_WORD = 64

_MERGE = """
WITH RECURSIVE state(word, pos, token) USING KEY (word, pos) AS (
    SELECT word, pos, token FROM start
    UNION ALL
    (WITH placed AS (
        SELECT word, pos, token, lag(token) OVER each AS before, lead(token) OVER each AS following
        FROM state WHERE token IS NOT NULL WINDOW each AS (PARTITION BY word ORDER BY pos)
    ), ranked AS (
        SELECT p.word, p.pos, p.token, l.rank AS left_rank, r.rank
        FROM placed p
        LEFT JOIN merges l ON l.pair = (p.before::BIGINT << 32) + p.token
        LEFT JOIN merges r ON r.pair = (p.token::BIGINT << 32) + p.following
    ), least AS (
        SELECT word, min(rank) AS best, bool_or(rank = left_rank) AS doubled FROM ranked GROUP BY word HAVING min(rank) IS NOT NULL
    )
    SELECT word, pos, CASE WHEN left_rank = best THEN NULL WHEN rank = best THEN rank ELSE token END
    FROM ranked JOIN least USING (word) WHERE NOT coalesce(doubled, false)
    UNION ALL
    SELECT word, pos, CASE WHEN left_rank = best AND turn % 2 = 0 THEN NULL WHEN rank = best AND turn % 2 = 1 THEN rank ELSE token END
    FROM (
        SELECT *, row_number() OVER (PARTITION BY word, starts ORDER BY pos) AS turn
        FROM (
            SELECT *, count(CASE WHEN left_rank IS DISTINCT FROM best THEN 1 END) OVER (PARTITION BY word ORDER BY pos) AS starts
            FROM ranked JOIN least USING (word) WHERE doubled
        )
    ))
)
SELECT word, list(token ORDER BY pos) AS ids FROM state WHERE token IS NOT NULL GROUP BY word
"""

_DECODE = """
SELECT doc, string_agg(v.hex, '' ORDER BY pos) AS hex
FROM ids JOIN vocabulary v ON v.token = ids.token GROUP BY doc
"""


@lru_cache(2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(1)
def codec_for(path: str, pattern: str, thrifty: bool = False) -> Codec:
    """The worker's own codec; Spark gives the next task to the same Python worker, whose
    earlier tasks, of other stages, may have left memory that nothing uses."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # GNU systems
        trim(0)
    return Codec(path, pattern, thrifty)


class Codec:
    """A worker's DuckDB connection with the merge table and the vocabulary.

    The rank of a pair is the rank of the token it makes, so the merge table holds
    every split of every token into two tokens. A ``thrifty`` codec takes up to an eighth
    more time and some 40 MB less: it contracts fewer words at once, and what a query
    frees goes back to the system.
    """

    def __init__(self, path: str, pattern: str, thrifty: bool = False):
        self.ranks = load_ranks(path)
        self.pattern = regex.compile(pattern)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        self.at_once = WORDS_PER_QUERY[thrifty]
        if thrifty:
            self.db.execute("SET allocator_flush_threshold = '1MB'")
            self.db.execute("SET allocator_bulk_deallocation_flush_threshold = '1MB'")
        pairs, made = array("q"), array("i")
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                if (first := self.ranks.get(token[:i])) is not None and (second := self.ranks.get(token[i:])) is not None:
                    pairs.append((first << 32) + second)
                    made.append(rank)
        self._table("merges", {"pair": pa.array(np.frombuffer(pairs, "i8")), "rank": pa.array(np.frombuffer(made, "i4"))})
        self.longest: dict[bytes, int] = {}  # token that begins with these two bytes
        for token in self.ranks:
            self.longest[token[:2]] = max(len(token), self.longest.get(token[:2], 0))
        self._table("vocabulary", {
            "token": pa.array(list(self.ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in self.ranks]),
        })
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], "i4")
        self._forget()

    def _forget(self) -> None:
        self.db.execute("CREATE OR REPLACE TABLE memory (word BLOB, ids INTEGER[])")
        self.known = 0

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS FROM incoming")
        self.db.unregister("incoming")

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces = [self.pattern.findall(t) if t else [] for t in texts]
        flat = pa.array([p for doc in pieces for p in doc], pa.large_string()).dictionary_encode()
        listed = flat.dictionary.cast(pa.large_binary())
        self._table("asked", {"row": pa.array(np.arange(len(listed))), "word": listed})
        if self.known + len(listed) > MEMORY_WORDS:
            self._forget()
        self._learn(self.db.sql("SELECT word FROM asked ANTI JOIN memory USING (word) ORDER BY row").to_arrow_table()["word"].to_pylist())
        lists = self.db.sql("SELECT ids FROM asked JOIN memory USING (word) ORDER BY row").to_arrow_table()["ids"].combine_chunks()
        values = lists.values.to_numpy().astype("<u4").tobytes()
        bounds = (lists.offsets.to_numpy().astype(np.int64) * 4).tolist()
        ids = [values[a:b] for a, b in zip(bounds, bounds[1:])]
        found = flat.indices.to_numpy().tolist()
        ends = np.cumsum([len(p) for p in pieces]).tolist()
        return [
            None if text is None else b"".join([ids[i] for i in found[end - len(doc):end]])
            for text, doc, end in zip(texts, pieces, ends)
        ]

    def _learn(self, new: list[bytes]) -> None:
        """Remember the ids of each new word: of a token its own, of a long word those of
        its independent parts, of the others what is left when no pair makes a token."""
        self.known += len(new)
        whole = [w for w in new if w in self.ranks]
        self._remember(whole, [[self.ranks[w]] for w in whole])
        short = [w for w in new if w not in self.ranks and len(w) <= LONG_WORD]
        for start in range(0, len(short), self.at_once):
            self.db.execute(f"INSERT INTO memory {self._contracted(short[start:start + self.at_once])}")
        for word in (w for w in new if w not in self.ranks and len(w) > LONG_WORD):
            parts = self._independent(word)
            ids = {p: [self.ranks[p]] for p in parts if p in self.ranks}
            rest = list(dict.fromkeys(p for p in parts if p not in ids))
            for start in range(0, len(rest), self.at_once):
                ids |= self.db.execute(self._contracted(rest[start:start + self.at_once])).fetchall()
            self._remember([word], [[i for p in parts for i in ids[p]]])

    def _remember(self, words: list[bytes], ids: list[list[int]]) -> None:
        self._table("words", {"word": pa.array(words, pa.large_binary()), "ids": pa.array(ids, pa.list_(pa.int32()))})
        self.db.execute("INSERT INTO memory FROM words")

    def _contracted(self, words: list[bytes]) -> str:
        """The query for the ids of words that are no tokens.

        A round contracts the pair of least rank in each word, leftmost first,
        at all of its places that do not overlap.
        """
        lengths = np.array([len(w) for w in words])
        ends = np.cumsum(lengths)
        self._table("start", {
            "word": pa.array(np.repeat(np.arange(len(words), dtype="i4"), lengths)),
            "pos": pa.array((np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)).astype("i4")),
            "token": pa.array(self.byte[np.frombuffer(b"".join(words), "u1")]),
        })
        self._table("words", {"number": pa.array(np.arange(len(words), dtype="i4")), "word": pa.array(words, pa.large_binary())})
        return f"SELECT w.word, m.ids FROM ({_MERGE}) m JOIN words w ON w.number = m.word"

    def _independent(self, word: bytes) -> list[bytes]:
        """``word`` cut where no token that occurs in it reaches across: merges make tokens
        only, so none joins what lies on both sides of such a place."""
        parts, begin, reach = [], 0, 1
        for at in range(len(word)):
            if at >= reach:
                parts.append(word[begin:at])
                begin = reach = at
            for size in range(self.longest.get(word[at:at + 2], 0), 1, -1):
                if at + size <= reach:
                    break
                if at + size <= len(word) and word[at:at + size] in self.ranks:
                    reach = at + size
                    break
            reach = max(reach, at + 1)
        return [*parts, word[begin:]]

    def decode(self, encoded: list[bytes | None]) -> list[bytes | None]:
        """The bytes that each list of ids stands for."""
        ids = [np.frombuffer(e or b"", "<u4") for e in encoded]
        lengths = np.array([len(i) for i in ids], np.int64)
        self._table("ids", {
            "doc": pa.array(np.repeat(np.arange(len(ids), dtype="i4"), lengths)),
            "pos": pa.array(np.arange(lengths.sum())),
            "token": pa.array(np.concatenate(ids).astype("i4") if ids else np.zeros(0, "i4")),
        })
        found = dict(self.db.execute(_DECODE).fetchall())
        return [None if e is None else bytes.fromhex(found.get(i, "")) for i, e in enumerate(encoded)]


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``CHUNK_BYTES`` of text: small ones joined, large ones cut."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = 0
        for i, n in enumerate(lengths):
            if size and size + n > CHUNK_BYTES:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size, start = [], 0, i
            size += n
        if start < len(lengths):
            held.append(batch.slice(start))
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with one more column, the token ids of ``text`` as array<int>.

    Each match of ``pattern`` is encoded by itself; special tokens are ordinary
    text. A null text has null ids, an empty one no ids. ``path`` is the rank
    file, readable on every executor. A column already named ``ids`` is replaced.
    Memory is bounded by a chunk of text, or by the longest single text.
    """
    columns = [c for c in docs.columns if c != ids]
    source = small_batches(docs.select(*columns), "2m")
    schema = source.select("*", F.lit(None).cast("array<int>").alias(ids)).schema
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(path, pattern)
        for batch in _chunks(batches, at):
            yield _with(batch, ids, _lists(codec.encode(batch.column(at).to_pylist())))

    return source.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of the token list ``ids`` as a binary column ``out``;
    null ids give null, an empty list no bytes. An id outside the vocabulary fails."""
    columns = [c for c in docs.columns if c != out]
    source = docs.select(*columns)
    schema = source.select("*", F.lit(None).cast("binary").alias(out)).schema
    at = columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(path, public_tokenizers.PATTERN)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = [None if x is None else np.array(x, "<u4").tobytes() for x in part.column(at).to_pylist()]
                if any(x and np.frombuffer(x, "<u4").max() >= len(codec.ranks) for x in lists):
                    raise ValueError("a token id is not in the vocabulary")
                yield _with(part, out, pa.array(codec.decode(lists), pa.binary()))

    return source.mapInArrow(run, schema)


def encode_checked(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``encode``, and a column ``round_trip``: whether the decoded ids are the text
    (null for a null text). The codec is a thrifty one, as workers of earlier stages of a
    pipeline hold memory too."""
    columns = [c for c in docs.columns if c not in ("ids", "round_trip")]
    source = small_batches(docs.select(*columns), "2m")
    schema = source.select("*", F.lit(None).cast("array<int>").alias("ids"), F.lit(None).cast("boolean").alias("round_trip")).schema
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(path, pattern, thrifty=True)
        for batch in _chunks(batches, at):
            texts = batch.column(at).to_pylist()
            encoded = codec.encode(texts)
            same = [None if t is None else d == t.encode() for t, d in zip(texts, codec.decode(encoded))]
            yield _with(_with(batch, "ids", _lists(encoded)), "round_trip", pa.array(same, pa.bool_()))

    return source.mapInArrow(run, schema)


def _with(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, name])


def _lists(encoded: list[bytes | None]) -> pa.Array:
    ends = np.cumsum([0, *(len(e or b"") // 4 for e in encoded)])
    offsets = pa.array([None if i < len(encoded) and encoded[i] is None else e for i, e in enumerate(ends.tolist())], pa.int32())
    values = pa.array(np.frombuffer(b"".join(e or b"" for e in encoded), "<u4").astype("i4"))
    return pa.ListArray.from_arrays(offsets, values)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text (null as empty) in one pass and keep their digests."""
    source = small_batches(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "2m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(path, public_tokenizers.PATTERN)
        for batch in _chunks(batches, 1):
            encoded = codec.encode(batch.column(1).to_pylist())
            yield pa.record_batch({
                "doc_id": batch.column(0),
                "n_tokens": pa.array([len(e) // 4 for e in encoded], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(e).hexdigest() for e in encoded]),
                "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in codec.decode(encoded)]),
            })

    return source.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), public_tokenizers.path(RANKS))
