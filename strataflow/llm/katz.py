"""Katz backoff bigram model, trained and evaluated over blocks of documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import documents, partitions, release, small_batches, words, written
from strataflow.session import delete_path, scratch_path

#: Counts up to this one are discounted by Good-Turing.
DISCOUNTED = 5
#: Tokens of a block of documents, unless one document alone has more.
BLOCK_TOKENS = 2_000_000
#: Tokens per bucket of n-grams; a bucket is counted in one task.
BUCKET_TOKENS = 1_000_000
#: Documents whose crc32(doc_id as text) is 0 modulo this are held out.
HOLD_OUT = 10

_BLOCK = (
    "block bigint, doc_ids array<bigint>, held array<boolean>, ends array<bigint>, tokens binary, "
    "vocabulary array<bigint>, n_tokens bigint"
)

def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(packed: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype)


_ASKED = "bucket bigint, block bigint, kind int, keys binary, sums binary"


# -- blocks of documents ----------------------------------------------------


def token_blocks(docs: DataFrame) -> DataFrame:
    """Documents as blocks of token numbers with a vocabulary of 64-bit word hashes.

    A document's tokens are its words and one end. Words are known by their XXH64
    from here on: two of n distinct words share one with a chance of n^2 / 2^65.
    The end, and the start as a context, have the hash of the empty word.
    """
    source = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        base = int.from_bytes(os.urandom(7), "little")  # names a block; only the stored attempt's names count
        number, held = 0, _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = words(text.as_py() or b"")
                if held.size and held.size + len(tokens) >= BLOCK_TOKENS:
                    yield held.batch(base + number)
                    number, held = number + 1, _Block()
                held.add(doc_id, tokens)
        if held.size:
            yield held.batch(base + number)

    return source.mapInArrow(run, _BLOCK)


class _Block:
    def __init__(self):
        self.numbers: dict[bytes, int] = {b"": 0}
        self.parts: list[np.ndarray] = []
        self.doc_ids, self.held, self.ends, self.size = [], [], [], 0

    def add(self, doc_id: int | None, tokens: list[bytes]) -> None:
        numbers = self.numbers
        found = [numbers.setdefault(t, len(numbers)) for t in tokens]
        found.append(0)
        self.parts.append(np.array(found, "u4"))
        self.size += len(found)
        self.doc_ids.append(doc_id)
        name = b"" if doc_id is None else str(doc_id).encode()
        self.held.append(zlib.crc32(name) % HOLD_OUT == 0)
        self.ends.append(self.size)

    def batch(self, block: int) -> pa.RecordBatch:
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.numbers], "u8").view("i8")
        return pa.record_batch({
            "block": pa.array([block], pa.int64()),
            "doc_ids": pa.array([self.doc_ids], pa.list_(pa.int64())),
            "held": pa.array([self.held]),
            "ends": pa.array([self.ends], pa.list_(pa.int64())),
            "tokens": pa.array([_pack(np.concatenate(self.parts))], pa.binary()),
            "vocabulary": pa.array([hashes], pa.list_(pa.int64())),
            "n_tokens": pa.array([self.size], pa.int64()),
        })


class _View:
    """A stored block's arrays. Each token is one unigram and one bigram event."""

    def __init__(self, row: dict):
        self.block = row["block"].as_py()
        self.doc_ids, self.held = row["doc_ids"].as_py(), np.array(row["held"].as_py(), bool)
        self.ends = row["ends"].values.to_numpy().astype(np.int64)
        self.word = _unpack(row["tokens"].as_py(), "u4")
        self.vocabulary = row["vocabulary"].values.to_numpy().view("u8")
        self.context = np.zeros_like(self.word)
        self.context[1:] = self.word[:-1]
        starts = np.concatenate([[0], self.ends[:-1]])
        self.context[starts] = 0
        self.lengths = self.ends - starts
        self.trained = np.repeat(~self.held, self.lengths)
        pair = _mix(self.vocabulary[self.context], self.vocabulary[self.word])
        self.pairs, first, self.pair = np.unique(pair, return_index=True, return_inverse=True)
        self.pair_context, self.pair_word = self.context[first], self.word[first]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the vocabulary and of the distinct bigrams."""
        weights = self.trained.astype(np.float64)
        return (np.bincount(self.word, weights, len(self.vocabulary)).astype("i8"),
                np.bincount(self.pair, weights, len(self.pairs)).astype("i8"))

    def per_document(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.ends - self.lengths)


def _mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit hash of a bigram from the hashes of its words."""
    x = (context * np.uint64(0x9E3779B97F4A7C15)) ^ word
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# -- sums over all blocks ---------------------------------------------------


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Order of the keys by bucket and key, the buckets, and where each begins and ends."""
    home = (keys >> np.uint64(1)) % np.uint64(buckets)
    order = np.lexsort((keys, home))
    home = home[order]
    first = np.flatnonzero(np.r_[True, home[1:] != home[:-1]]) if len(home) else np.zeros(0, int)
    return order, home[first].astype("i8"), list(zip(first, [*first[1:], len(home)]))


def _ask(block: int, kind: int, keys: np.ndarray, sums: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket with the block's distinct keys of it, in order, and their sums."""
    order, homes, spans = _dealt(keys, buckets)
    keys, sums = keys[order], sums[order]
    return pa.record_batch({
        "bucket": pa.array(homes),
        "block": pa.array([block] * len(spans), pa.int64()),
        "kind": pa.array([kind] * len(spans), pa.int32()),
        "keys": pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
        "sums": pa.array([_pack(sums[a:b]) for a, b in spans], pa.binary()),
    })


def _answered(rows: pa.Table, kind: int, keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Corpus counts of a block's keys, and which of them it stands for."""
    order, _, spans = _dealt(keys, buckets)
    mine = rows.filter(pa.compute.equal(rows["kind"], kind)).sort_by("bucket")
    counts, own = np.zeros(len(keys), "i8"), np.zeros(len(keys), bool)
    if len(keys):
        counts[order] = np.concatenate([_unpack(c.as_py(), "i8") for c in mine["counts"]])
        bits = (np.unpackbits(np.frombuffer(o.as_py(), "u1"), count=b - a) for o, (a, b) in zip(mine["own"], spans))
        own[order] = np.concatenate(list(bits)).astype(bool)
    return counts, own


def _questions(blocks: DataFrame, buckets: int) -> DataFrame:
    """Training counts of each block's words (kind 1) and bigrams (kind 2), dealt to buckets.

    A block sends each key once, so a common word is one entry a block and no
    bucket is hot.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_struct_array():
                view = _View(row)
                single, pair = view.counts()
                yield _ask(view.block, 1, view.vocabulary, single.astype("i4"), buckets)
                yield _ask(view.block, 2, view.pairs, pair.astype("i4"), buckets)

    return blocks.mapInArrow(run, _ASKED)


def ngram_counts(blocks: DataFrame, buckets: int) -> DataFrame:
    """The counts of all n-grams, a table partitioned by bucket.

    Rows of ``block`` null hold the model: distinct keys and counts of a bucket, by
    kind. The others answer a block: the corpus counts of the keys it asked for, in
    their order, and in ``own`` whether the block is the one that stands for the key.
    ``histogram`` has the number of keys by count up to DISCOUNTED + 1, then all
    keys, then all tokens.
    """
    def count(table: pa.Table) -> pa.Table:
        kind, bucket = table["kind"][0].as_py(), table["bucket"][0].as_py()
        keys = [np.frombuffer(k.as_py(), "u8") for k in table["keys"]]
        sums = [_unpack(s.as_py(), "i4") for s in table["sums"]]
        distinct, first, where = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(where, np.concatenate(sums)).astype("i8")
        own = np.zeros(len(where), bool)
        own[first] = True
        found, bounds = total[where], np.cumsum([0, *map(len, keys)])
        seen = total[total > 0]
        histogram = [*(int((seen == r).sum()) for r in range(1, DISCOUNTED + 2)), len(seen), int(seen.sum())]
        n = len(keys)
        return pa.table({
            "bucket": pa.array([bucket] * (n + 1), pa.int64()),
            "block": pa.array([None, *table["block"].to_pylist()], pa.int64()),
            "kind": pa.array([kind] * (n + 1), pa.int32()),
            "keys": pa.array([distinct[total > 0].tobytes(), *[None] * n], pa.binary()),
            "counts": pa.array([_pack(seen), *(_pack(found[a:b]) for a, b in zip(bounds, bounds[1:]))], pa.binary()),
            "own": pa.array([None, *(np.packbits(own[a:b]).tobytes() for a, b in zip(bounds, bounds[1:]))], pa.binary()),
            "histogram": pa.array([histogram, *[None] * n], pa.list_(pa.int64())),
        })

    return _questions(blocks, buckets).groupBy("bucket", "kind").applyInArrow(
        count, "bucket bigint, block bigint, kind int, keys binary, counts binary, own binary, histogram array<bigint>"
    )


# -- the model --------------------------------------------------------------


def discounts(histogram: list[int]) -> np.ndarray:
    """Katz's discount d_r of the counts r = 0 (unused) to DISCOUNTED; larger counts keep 1.

    d_r = (r* / r - A) / (1 - A), r* = (r + 1) n_{r+1} / n_r, A = (k + 1) n_{k+1} / n_1.
    Where the counts of counts give no value in (0, 1], r - 0.5 takes the place of r*.
    """
    n = [0, *histogram]
    out = np.ones(DISCOUNTED + 1)
    tail = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    for r in range(1, DISCOUNTED + 1):
        value = ((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail) if n[r] and tail < 1 else 0.0
        out[r] = value if 0 < value <= 1 else (r - 0.5) / r
    return out


class Model:
    """What all blocks share: discounts, totals and the mass of unseen words.

    An unseen word is one further event. With no discounted mass left for it one
    event is added to the denominator, here and per context, so that every
    distribution sums to one exactly and no probability is zero.
    """

    def __init__(self, single: list[int], pair: list[int]):
        self.d1, self.d2 = discounts(single), discounts(pair)
        self.types, self.tokens = single[-2], single[-1]
        freed = sum(r * single[r - 1] * (1 - self.d1[r]) for r in range(1, DISCOUNTED + 1))
        self.events = self.tokens + (0 if freed > 0 else 1)
        self.unseen = (freed if freed > 0 else 1) / self.events

    def single(self, counts: np.ndarray) -> np.ndarray:
        """p(w) from its count; a count of zero is the unseen event."""
        small = self.d1[np.minimum(counts, DISCOUNTED)]
        kept = np.where(counts > DISCOUNTED, 1.0, small) * counts / self.events
        return np.where(counts > 0, kept, self.unseen)

    def freed(self, counts: np.ndarray) -> np.ndarray:
        """What discounting takes from bigrams of these counts."""
        return np.where((counts > 0) & (counts <= DISCOUNTED), counts * (1 - self.d2[np.minimum(counts, DISCOUNTED)]), 0.0)


def _partial(model: Model, buckets: int):
    """Per block: all of the scores that needs no backoff weight, and the sums per
    context of the bigrams it stands for."""
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        empty = {"block": [], "bucket": [], "keys": [], "sums": [], "docs": []}
        if not block.num_rows:
            return pa.table({k: pa.array(v, _PARTIAL[k]) for k, v in empty.items()}, schema=pa.schema(_PARTIAL))
        view = _View({name: block[name][0] for name in block.column_names})
        single, _ = _answered(answers, 1, view.vocabulary, buckets)
        pair, own = _answered(answers, 2, view.pairs, buckets)
        p = model.single(single)
        context_n = single[view.pair_context]  # events of a context: a word is followed as often as it occurs
        # contexts in the order of the vocabulary: discounted mass, and p of the words seen after them
        mass = np.zeros((len(view.vocabulary), 2))
        mine = own & (pair > 0)
        np.add.at(mass[:, 0], view.pair_context[mine], model.freed(pair[mine]))
        np.add.at(mass[:, 1], view.pair_context[mine], p[view.pair_word[mine]])
        # score of each distinct bigram as far as it is known; the rest waits for its context
        kept = np.where(pair > DISCOUNTED, 1.0, model.d2[np.minimum(pair, DISCOUNTED)]) * pair
        with np.errstate(divide="ignore"):
            known = np.where(pair > 0, np.log10(kept) - np.log10(np.maximum(context_n, 1)), np.log10(p[view.pair_word]))
        frees = np.zeros(len(view.vocabulary), bool)
        frees[view.pair_context[model.freed(pair) > 0]] = True
        waits = (context_n > 0) & ((pair == 0) | ~frees[view.pair_context])
        base = np.log10((single + 0.1) / (model.tokens + 0.1 * (model.types + 1)))
        waiting = np.flatnonzero(waits[view.pair])
        docs = pa.array([{
            "doc_ids": view.doc_ids, "held": view.held.tolist(), "n_tokens": view.lengths.tolist(),
            "n_known": view.per_document((single > 0)[view.word].astype("i8")).tolist(),
            "base": view.per_document(base[view.word]).tolist(), "score": view.per_document(known[view.pair]).tolist(),
            "waiting_doc": (np.searchsorted(view.ends, waiting, "right")).tolist(),
            "waiting_context": view.vocabulary[view.context[waiting]].view("i8").tolist(),
            "waiting_events": single[view.context[waiting]].tolist(),
            "waiting_seen": (pair[view.pair[waiting]] > 0).tolist(),
        }], _DOCS)
        asks = np.unique(np.concatenate([np.flatnonzero(mass.any(1)), view.context[waiting]]))
        asked = _ask(view.block, 3, view.vocabulary[asks], mass[asks], buckets)
        n = asked.num_rows
        return pa.table({
            "block": pa.array([view.block] * (n + 1), pa.int64()),
            "bucket": pa.concat_arrays([asked["bucket"], pa.array([None], pa.int64())]),
            "keys": pa.concat_arrays([asked["keys"], pa.array([None], pa.binary())]),
            "sums": pa.concat_arrays([asked["sums"], pa.array([None], pa.binary())]),
            "docs": pa.concat_arrays([pa.nulls(n, _DOCS), docs]),
        })

    return run


_DOCS = pa.struct({
    "doc_ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "n_tokens": pa.list_(pa.int64()), "n_known": pa.list_(pa.int64()),
    "base": pa.list_(pa.float64()), "score": pa.list_(pa.float64()), "waiting_doc": pa.list_(pa.int64()),
    "waiting_context": pa.list_(pa.int64()), "waiting_events": pa.list_(pa.int64()), "waiting_seen": pa.list_(pa.bool_()),
})
_PARTIAL = {"block": pa.int64(), "bucket": pa.int64(), "keys": pa.binary(), "sums": pa.binary(), "docs": _DOCS}
_PARTIAL_SQL = (
    "block bigint, bucket bigint, keys binary, sums binary, docs struct<doc_ids:array<bigint>,held:array<boolean>,"
    "n_tokens:array<bigint>,n_known:array<bigint>,base:array<double>,score:array<double>,waiting_doc:array<bigint>,"
    "waiting_context:array<bigint>,waiting_events:array<bigint>,waiting_seen:array<boolean>>"
)


def _context_sums(table: pa.Table) -> pa.Table:
    """Sums over all blocks for the contexts of one bucket, sent back to each block."""
    keys = [np.frombuffer(k.as_py(), "u8") for k in table["keys"]]
    sums = np.concatenate([_unpack(s.as_py(), "f8").reshape(-1, 2) for s in table["sums"]])
    _, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.stack([np.bincount(where, sums[:, i]) for i in (0, 1)], 1)[where]
    bounds = np.cumsum([0, *map(len, keys)])
    return pa.table({
        "block": table["block"], "keys": table["keys"],
        "sums": pa.array([_pack(total[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary()),
    })


def _finish(model: Model):
    """Back off: add log10 of the context's weight to the score of each waiting token."""
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _SCORES.empty_table()
        row = block["docs"][0].as_py()
        keys = np.array(row["waiting_context"], "i8").view("u8")
        got = np.concatenate([np.zeros(0, "u8"), *(np.frombuffer(k.as_py(), "u8") for k in answers["keys"])])
        sums = np.concatenate([np.zeros((0, 2)), *(_unpack(v.as_py(), "f8").reshape(-1, 2) for v in answers["sums"])])
        order = np.argsort(got)
        freed, seen_p = sums[order][np.searchsorted(got[order], keys)].T
        events = np.array(row["waiting_events"], "f8")
        added = np.where(freed > 0, 0.0, 1.0)  # one event more if nothing was freed
        left = np.where(freed > 0, freed, 1.0) / (events + added)
        seen = np.array(row["waiting_seen"], bool)
        change = np.where(seen, np.log10(events) - np.log10(events + added), np.log10(left) - np.log10(np.maximum(1 - seen_p, model.unseen)))
        score = np.array(row["score"]) + np.bincount(np.array(row["waiting_doc"], "i8"), change, len(row["score"]))
        n = len(score)
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
            "n_tokens": pa.array(row["n_tokens"], pa.int64()), "n_known": pa.array(row["n_known"], pa.int64()),
            "train_tokens": pa.array([model.tokens] * n, pa.int64()), "base_score": pa.array(row["base"], pa.float64()),
            "score": pa.array(score, pa.float64()),
        })

    return run


_SCORES = pa.schema({
    "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(),
    "train_tokens": pa.int64(), "base_score": pa.float64(), "score": pa.float64(),
})


def score_documents(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out and score all of them.

    p(w | h) = d c(h, w) / c(h) if the bigram was seen, else backoff(h) p(w), and
    p(w) = d c(w) / N if the word was seen, else the mass of unseen words; the first
    word follows a start, and the end is a token. backoff(h) is what discounting
    freed in h over 1 minus the p(w) of all words seen after h, hence exact; an
    unseen context has weight 1. A null doc_id is held out (crc32 of no text is 0);
    a null text is empty and has its end alone. Rows that share a doc_id are scored
    one by one. An empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "katz-blocks")
    token_blocks(docs).write.parquet(folder)
    blocks = spark.read.schema(_BLOCK).parquet(folder)
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = max(partitions(spark), -(-tokens // BUCKET_TOKENS))
    counts = written(ngram_counts(blocks, buckets), "katz-counts")
    release(spark)  # the questions, the largest shuffle, are answered
    width = DISCOUNTED + 3
    sums = counts.where("block IS NULL").groupBy("kind").agg(*(F.sum(F.col("histogram")[i]).alias(f"h{i}") for i in range(width)))
    histograms = {r["kind"]: [r[f"h{i}"] for i in range(width)] for r in sums.collect()}  # one row a kind
    nothing = [0] * width
    model = Model(histograms.get(1, nothing), histograms.get(2, nothing))
    answers = counts.where("block IS NOT NULL").select("block", "bucket", "kind", "counts", "own")
    partial = written(
        blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_partial(model, buckets), _PARTIAL_SQL), "katz-partial"
    )
    delete_path(spark, folder)  # all that is needed from here on is in ``partial``
    release(spark)
    contexts = partial.where("bucket IS NOT NULL").groupBy("bucket").applyInArrow(_context_sums, "block bigint, keys binary, sums binary")
    rows = partial.where("docs IS NOT NULL").select("block", "docs")
    return rows.groupBy("block").cogroup(contexts.groupBy("block")).applyInArrow(
        _finish(model), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
