"""Packing token lists into training sequences: vector bin packing by dot products.

A sequence has three limits at once: tokens, segments and loss-bearing tokens. It is
filled with the example, among those that fit, whose demand has the greatest dot product
with what the sequence has left, each dimension weighted by the average demand on it.
Every task packs the examples it reads, in a pool of bounded size, so nothing is
shuffled. Where examples may be cut, a piece of one fills a gap that no whole example
fits, and what is left at last goes to sequences of a power of two of tokens, which
need no padding.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import documents, small_batches

VOCABULARY = "word_bpe_49k.json"
#: The id that ends a document.
END = 1
#: Parts of words whose ids a Python worker remembers from task to task, apart from those
#: of one chunk; a full memory starts anew.
MEMORY_PARTS = 400_000
#: Bytes of text a task tokenizes at once, unless one text alone has more.
CHUNK_BYTES = 4 << 20
#: Examples from which a task chooses; it packs when it holds so many, down to half.
POOL = 4096


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 2048
    segments: int = 128
    loss: int = 2048

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("limits are positive")


@dataclass(eq=False)
class Piece:
    """The tokens ``start`` to ``end`` of ``ids``, which begin ``base`` tokens into an example.
    ``loss`` counts, for each number of first tokens, those that bear loss; without it all do."""

    key: int
    ids: np.ndarray
    loss: np.ndarray | None
    start: int
    end: int
    base: int = 0

    @property
    def length(self) -> int:
        return self.end - self.start

    @property
    def bearing(self) -> int:
        return self.length if self.loss is None else int(self.loss[self.end] - self.loss[self.start])

    def fitting(self, tokens: int, loss: int) -> int:
        """How many of its first tokens keep to both limits."""
        most = min(tokens, self.length)
        if self.loss is None:
            return min(most, loss)
        return bisect_right(self.loss, int(self.loss[self.start]) + loss, self.start, self.start + most + 1) - 1 - self.start

    def split(self, n: int) -> tuple["Piece", "Piece"]:
        at = self.start + n
        return replace(self, end=at), replace(self, start=at)

    def alone(self) -> "Piece":
        """The piece without the rest of its example, which can be long."""
        loss = None if self.loss is None else self.loss[self.start:self.end + 1].copy()
        return Piece(self.key, self.ids[self.start:self.end].copy(), loss, 0, self.length, self.base + self.start)


class Pool:
    """Pieces that wait, by their demand: those of equal demand are interchangeable."""

    def __init__(self, limits: Limits):
        self.room = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
        self.weights = 1 / self.room
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[tuple[int, int], int] = {}
        self.held: list[list[Piece]] = []
        self.demand, self.count = np.zeros((64, 3)), np.zeros(64)
        self.size = 0

    def add(self, piece: Piece) -> None:
        tokens, loss = piece.length, piece.bearing
        at = self.numbers.setdefault((tokens, loss), len(self.held))
        if at == len(self.held):
            self.held.append([])
            if at == len(self.count):
                self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)])
                self.count = np.concatenate([self.count, np.zeros_like(self.count)])
            self.demand[at] = tokens, 1, loss
        self.held[at].append(piece)
        self.count[at] += 1
        self.size += 1

    def take(self, at: int) -> Piece:
        self.count[at] -= 1
        self.size -= 1
        return self.held[at].pop()

    def settle(self) -> None:
        """Forget demands that no piece has any more, and weigh the dimensions by what all
        pieces together ask of them."""
        pieces = [p for held in self.held for p in held]
        self._clear()
        for piece in pieces:
            self.add(piece)
        self.weights = (self.count @ self.demand) / max(1, self.size) / self.room ** 3

    def best(self, left: np.ndarray, fitting: bool) -> int | None:
        """The demand of greatest dot product with what is left, of those that fit or of all."""
        used = len(self.held)
        demand, here = self.demand[:used], self.count[:used] > 0
        if fitting:
            here &= (demand <= left).all(1)
        places = np.flatnonzero(here)
        return int(places[np.argmax(demand[places] @ (self.weights * left))]) if len(places) else None


def _fill(pool: Pool, cut: bool) -> list[Piece]:
    """One sequence out of the pool."""
    left, chosen = pool.room.copy(), []

    def place(piece: Piece) -> None:
        chosen.append(piece)
        left[:] -= piece.length, 1, piece.bearing

    while left[:2].all() and (at := pool.best(left, True)) is not None:
        place(pool.take(at))
    if cut and left[:2].all() and (at := pool.best(left, False)) is not None:
        piece = pool.take(at)
        head, rest = piece.split(piece.fitting(int(left[0]), int(left[2])))
        if head.length:
            place(head)
        pool.add(rest)
    tokens = int(pool.room[0] - left[0])
    if cut and left[0]:
        # nothing else can go in: as many tokens as need no padding
        surplus = tokens - (1 << tokens.bit_length() - 1)
        while surplus:
            last = chosen.pop()
            head, rest = last.split(max(0, last.length - surplus))
            surplus -= rest.length
            if head.length:
                chosen.append(head)
            pool.add(rest)
    return chosen


def pack_pieces(
    examples: Iterator[tuple[int, np.ndarray, np.ndarray | None]], limits: Limits, cut: bool
) -> Iterator[list[Piece]]:
    """Sequences of all ``examples`` (key, ids, which of them bear loss)."""
    pool = Pool(limits)
    for key, ids, bears in examples:
        loss = None if bears is None else np.concatenate([[0], np.cumsum(bears, dtype=np.int64)])
        rest = Piece(key, ids, loss, 0, len(ids))
        while rest.length > limits.tokens or rest.bearing > limits.loss:
            head, rest = rest.split(rest.fitting(limits.tokens, limits.loss))
            if head.length == limits.tokens:
                yield [head]
            else:
                pool.add(head.alone())
        pool.add(rest.alone())
        if pool.size >= POOL:
            pool.settle()
            while pool.size > POOL // 2:
                yield _fill(pool, cut)
    pool.settle()
    while pool.size:
        yield _fill(pool, cut)


def pack(
    examples: DataFrame, limits: Limits = Limits(), keys: Sequence[str] = ("doc_id",), ids: str = "ids",
    bears_loss: str | None = None, cut: bool = True,
) -> DataFrame:
    """One row per piece of an example: ``keys``, ``start`` (tokens of its example before
    it), ``length``, ``ids`` (little-endian unsigned 32-bit integers), ``example_tokens``,
    ``sequence_id`` and ``offset`` (tokens before it in its sequence, without gaps).

    ``ids`` is a binary column like the result's; ``bears_loss``, a binary column of one
    byte a token, 0 or 1, says which bear loss (without it, or null: all). With ``cut``
    each sequence has ``limits.tokens`` tokens or a power of two. Without it an example is
    cut only if no sequence holds it, and sequences may be shorter. Null or empty ids
    give no piece; keys may be null or repeated, each row is an example of its own.

    Sequence ids hold the number of the Spark partition and of its sequence, so they are
    unique, not consecutive. A task holds at most ``POOL`` examples, each of no more than
    ``limits.tokens`` tokens, beside an Arrow batch or one example. A retried task gives the same rows
    if its input has the same order, as files do; write the result before shuffling it.
    """
    taken = {"start", "length", "ids", "example_tokens", "sequence_id", "offset"} & set(keys)
    if taken:
        raise ValueError(f"key columns {sorted(taken)} have names of the result's")
    chosen = [F.col(f"`{k}`") for k in keys]
    loss = F.col(f"`{bears_loss}`") if bears_loss else F.lit(None)
    source = small_batches(examples.select(*chosen, F.col(f"`{ids}`").cast("binary").alias("_ids"), loss.cast("binary").alias("_loss")))
    n = F.lit(0).cast("bigint")
    schema = source.select(
        *chosen, n.alias("start"), n.alias("length"), F.lit(b"").alias("ids"), n.alias("example_tokens"), n.alias("sequence_id"), n.alias("offset"),
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        held: dict[int, list] = {}  # keys, tokens and pieces not yet given, of each example in the pool
        types: list[pa.DataType] = []

        def read() -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
            number = 0
            for batch in batches:
                types[:] = [batch.column(k).type for k in range(len(keys))]
                named = [batch.column(k).to_pylist() for k in range(len(keys))]
                for row in range(batch.num_rows):
                    packed, flags = batch.column(len(keys))[row], batch.column(len(keys) + 1)[row]
                    if not packed.is_valid or not len(packed.as_buffer()):
                        continue
                    tokens = np.frombuffer(packed.as_py(), "<u4")
                    bears = np.frombuffer(flags.as_py(), np.uint8) if flags.is_valid else None
                    if bears is not None and len(bears) != len(tokens):
                        raise ValueError("bears_loss has not one byte for each token")
                    number += 1
                    held[number] = [[c[row] for c in named], len(tokens), len(tokens)]
                    yield number, tokens, bears

        rows: list[tuple] = []
        size = 0
        for pieces in pack_pieces(read(), limits, cut):
            offset = 0
            for piece in pieces:
                entry = held[piece.key]
                rows.append((entry[0], piece.base + piece.start, piece.length, piece.ids[piece.start:piece.end].tobytes(), entry[1], sequence, offset))
                offset += piece.length
                entry[2] -= piece.length
                if not entry[2]:
                    del held[piece.key]
            sequence += 1
            size += offset
            if size >= 1 << 20:
                yield _batch(rows, types, keys)
                rows, size = [], 0
        if rows:
            yield _batch(rows, types, keys)

    return source.mapInArrow(run, schema)


def _batch(rows: list[tuple], types: list[pa.DataType], keys: Sequence[str]) -> pa.RecordBatch:
    named, start, length, ids, tokens, sequence, offset = zip(*rows)
    columns = {k: pa.array([n[i] for n in named], t) for i, (k, t) in enumerate(zip(keys, types))}
    columns |= {k: pa.array(v, pa.int64()) for k, v in (("start", start), ("length", length))}
    columns["ids"] = pa.array(ids, pa.binary())
    columns |= {k: pa.array(v, pa.int64()) for k, v in (("example_tokens", tokens), ("sequence_id", sequence), ("offset", offset))}
    return pa.RecordBatch.from_pydict(columns)


@lru_cache(1)
def _words_of(path: str) -> "WordIds":
    return WordIds(path)


#: Words whose parts are encoded each by itself: of printable ASCII without the apostrophe,
#: which alone joins letters behind it, and accented Latin letters, without the beginning
#: of a special token. These letters are whole code points that nothing here combines with.
_ACCENTED = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_SIMPLE = f"^[!-&(-~{_ACCENTED}]*$"
_PART = f"([a-z{_ACCENTED}]+|[0-9]|[!-/:-`{{-~]+)"
#: Parts that the model reads as they are: the steps before it change nothing.
_AS_THEY_ARE = re.compile(rb"[!-@\[-~]+")


def _spread(begins: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places of the elements of the lists ``which``, that begin and are as long as given."""
    counts = lengths[which]
    ends = np.cumsum(counts)
    return np.repeat(begins[which] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


class WordIds:
    """Ids of texts from those of their parts. Neither the normalizer nor the splitting of
    this kind of vocabulary looks past white space, nor in a simple word past the places
    where letters, digits and marks meet; so parts are encoded once and remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memory: dict[bytes, bytes] = {}

    def encode(self, texts: pa.Array, end: int | None) -> list[bytes]:
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        flat = split.flatten().dictionary_encode()
        words = flat.dictionary
        simple = pc.and_(pc.match_substring_regex(words, _SIMPLE), pc.invert(pc.match_substring(words, "<|")))
        cut = pc.replace_substring_regex(pc.ascii_lower(words), _PART, r"\1 ")
        listed = pc.split_pattern(pc.if_else(simple, cut, words), " ")  # words hold no space
        parts = listed.flatten().dictionary_encode()
        ids = self._ids(parts.dictionary.cast(pa.large_binary()).to_pylist())
        lengths = np.array([len(i) // 4 for i in ids], np.int64)
        places = parts.indices.to_numpy()
        tokens = np.frombuffer(b"".join(ids), "<u4")[_spread(np.cumsum(lengths) - lengths, lengths, places)]
        # where the tokens of each word begin, then where those of each text do
        begins = np.concatenate([[0], np.cumsum(lengths[places])])[listed.offsets.to_numpy()]
        words_at = flat.indices.to_numpy()
        found = tokens[_spread(begins[:-1], np.diff(begins), words_at)].tobytes()
        bounds = 4 * np.concatenate([[0], np.cumsum(np.diff(begins)[words_at])])[split.offsets.to_numpy()]
        tail = b"" if end is None else end.to_bytes(4, "little")
        return [found[a:b] + tail for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def _ids(self, parts: list[bytes]) -> list[bytes]:
        known = self.memory
        new = [p for p in parts if p not in known]
        if len(known) + len(new) > MEMORY_PARTS:
            known = self.memory = {}
            new = parts
        for part in new:
            if _AS_THEY_ARE.fullmatch(part) and b"'" not in part and b"<|" not in part:
                known[part] = np.array([t.id for t in self.tokenizer.model.tokenize(part.decode())], "<u4").tobytes()
        rest = [p for p in new if p not in known]
        for start in range(0, len(rest), 10_000):
            some = rest[start:start + 10_000]
            for part, found in zip(some, self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)):
                known[part] = np.array(found.ids, "<u4").tobytes()
        return [known[p] for p in parts]


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    size = start = 0
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for row, n in enumerate(lengths):
        if size and size + n > CHUNK_BYTES:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)


def word_ids(docs: DataFrame, path: str, text: str = "text", keys: Sequence[str] = ("doc_id",), end: int | None = END) -> DataFrame:
    """``keys`` and ``ids``, the ids of each whole text as little-endian unsigned 32-bit
    integers, then the id ``end``. A null text is an empty one. ``path`` names a vocabulary
    for ``tokenizers``, readable on every executor, that drops white space."""
    chosen = [F.col(f"`{k}`") for k in keys]
    source = small_batches(docs.select(*chosen, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text")))
    schema = source.select(*chosen, F.lit(b"").alias("ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _words_of(path)
        for batch in batches:
            for part in _chunks(batch, len(keys)):
                ids = known.encode(part.column(len(keys)), end)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.binary())], schema.names)

    return source.mapInArrow(run, schema)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as examples of which every token bears loss."""
    packed = pack(word_ids(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY)))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        F.col("example_tokens").alias("doc_tokens"), "sequence_id", "offset",
    )
