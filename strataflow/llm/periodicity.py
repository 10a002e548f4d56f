"""Runs of periodically repeated words, found by difference-cover LCE on a harmonic grid.

A run is a stretch of consecutive words in which words ``q`` apart are equal, ``q``
being the smallest such distance, that no neighbour extends and that is long enough.
A run of period ``q`` and length ``L`` or more holds two equal words ``q`` apart at
some place of any grid of step ``L - q``. Such grids of all periods have about
``n log n`` places; the stretch around a place follows from how far the two suffixes
there agree (their longest common extension, LCE), forwards and backwards.

LCE sorts only the suffixes at places whose residue modulo 31 lies in a difference
cover. Two places agree on a residue shift of at most 30 words that takes both to
sampled places: so many words are compared one by one, and if all are equal the rest
is the least LCP between the two sampled suffixes, a sparse-table range minimum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import SPACES, documents, small_batches

#: A perfect difference set modulo 31 (every residue is a difference of two).
MODULUS = 31
COVER = (0, 1, 3, 8, 12, 18)
#: Words a task handles at once, unless one text alone has more.
CHUNK_WORDS = 400_000
#: Grid places handled at once.
CHUNK_PLACES = 4_000_000

MIN_LENGTH = 24
MIN_EXPONENT = 3

_SAMPLED = np.isin(np.arange(MODULUS), COVER)
#: Shift that takes places of two residues to sampled ones.
_SHIFT = np.array([
    [next(d for d in range(MODULUS) if _SAMPLED[(a + d) % MODULUS] and _SAMPLED[(b + d) % MODULUS]) for b in range(MODULUS)]
    for a in range(MODULUS)
], np.int64)


class Extensions:
    """Longest common extensions of places of the same text in ``words``.

    ``owner`` gives the text of each place. Each text must end in a word of its own,
    so that no extension passes its end. Suffixes are sorted when a query first
    reaches sampled places, and only those of the texts asked about.
    """

    def __init__(self, words: np.ndarray, owner: np.ndarray):
        self.words, self.owner = words, owner
        self.built = np.zeros(int(owner[-1]) + 1, bool)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and from ``j`` on are equal, for ``i < j`` of one text."""
        shift = _SHIFT[i % MODULUS, j % MODULUS]
        length = np.zeros(len(i), np.int64)
        alive = np.arange(len(i))
        for t in range(MODULUS):
            alive = alive[shift[alive] > t]
            alive = alive[self.words[i[alive] + t] == self.words[j[alive] + t]]
            if not len(alive):
                break
            length[alive] = t + 1
        far = np.flatnonzero(length == shift)
        if len(far):
            a, b = i[far] + shift[far], j[far] + shift[far]
            if not self.built[self.owner[a]].all():
                self.built[self.owner[a]] = True
                self._build()
            length[far] += self._minimum(self.slot[a], self.slot[b])
        return length

    def _build(self) -> None:
        """Sort the sampled suffixes of the texts in ``built``, with LCPs and range minima."""
        size = len(self.words)
        places = np.flatnonzero(_SAMPLED[np.arange(size) % MODULUS] & self.built[self.owner])
        padded = np.concatenate([self.words, np.zeros(MODULUS + 1, self.words.dtype)]).astype(np.int64)
        # ``rank`` of a place: the slot at which the suffixes that tie with it begin.
        order = places  # by text, as places ascend
        rank = np.zeros(size, np.int64)
        rank[order] = np.searchsorted(self.owner[order], self.owner[order])
        for t in range(0, MODULUS, 2):
            order = _refine(order, rank, (padded[t:t + size] << 32) + padded[t + 1:t + 1 + size])
        levels = [rank.copy()]  # equal at level k: at least the first 31 * 2^k words are
        while _ties(order, rank):
            # a suffix that ends within so many words ties with none
            step = min(MODULUS << len(levels) - 1, size)
            order = _refine(order, rank, np.concatenate([rank[step:], np.zeros(step, np.int64)]))
            levels.append(rank.copy())
        self.slot = np.full(size, -1, np.int64)
        self.slot[order] = np.arange(len(order))
        self._table(self._adjacent(order, levels, padded))

    def _adjacent(self, order: np.ndarray, levels: list[np.ndarray], padded: np.ndarray) -> np.ndarray:
        """LCP of each sorted suffix and the one before it (0 across texts)."""
        lcp = np.zeros(len(order), np.int64)
        pair = 1 + np.flatnonzero(self.owner[order[1:]] == self.owner[order[:-1]])
        x, y = order[pair - 1].copy(), order[pair].copy()
        for level in range(len(levels) - 1, -1, -1):
            leap = np.where(levels[level][x] == levels[level][y], MODULUS << level, 0)
            x += leap
            y += leap
            lcp[pair] += leap
        alive = np.arange(len(pair))
        for t in range(MODULUS):
            alive = alive[padded[x[alive] + t] == padded[y[alive] + t]]
            if not len(alive):
                break
            lcp[pair[alive]] += 1
        return lcp

    def _table(self, lcp: np.ndarray) -> None:
        self.least = [lcp.astype(np.int32)]
        width = 1
        while 2 * width <= len(lcp):
            row = self.least[-1]
            self.least.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def _minimum(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        found = np.zeros(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.least[k]
            found[at] = np.minimum(row[low[at]], row[high[at] - (1 << k) + 1])
        return found


def _ties(order: np.ndarray, rank: np.ndarray) -> bool:
    ranks = rank[order]
    return bool((ranks[1:] == ranks[:-1]).any())


def _refine(order: np.ndarray, rank: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Sort the suffixes that tie in ``rank`` by the ``key`` of their place; updates ``rank``."""
    ranks = rank[order]
    tied = np.zeros(len(order) + 1, bool)
    tied[1:-1] = ranks[1:] == ranks[:-1]
    slots = np.flatnonzero(tied[1:] | tied[:-1])
    if not len(slots):
        return order
    held, group = order[slots], ranks[slots]
    keys = key[held]
    by = np.lexsort((keys, group))
    held, keys = held[by], keys[by]  # groups keep their slots
    head = np.ones(len(slots), bool)
    head[1:] = (keys[1:] != keys[:-1]) | (group[1:] != group[:-1])
    order = order.copy()
    order[slots] = held
    rank[held] = slots[head][np.cumsum(head) - 1]
    return order


def _places(lengths: np.ndarray, min_length: int, min_exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, place within it and period, for all periods of all texts, in bounded batches."""
    widest = np.where(lengths >= min_length, lengths // min_exponent, 0)
    ends = np.cumsum(widest)
    total = int(ends[-1]) if len(ends) else 0
    at = 0
    while at < total:
        upto = min(total, at + CHUNK_PLACES // 4)
        number = np.arange(at, upto)
        text = np.searchsorted(ends, number, side="right")
        period = number - (ends - widest)[text] + 1
        step = np.maximum(min_length, min_exponent * period) - period
        places = -(-(lengths[text] - period) // step)
        cut = 0
        sums = np.cumsum(places)
        while cut < len(number):
            done = int(sums[cut - 1]) if cut else 0
            stop = max(cut + 1, int(np.searchsorted(sums, done + CHUNK_PLACES, side="right")))
            count = places[cut:stop]
            rows = np.repeat(np.arange(cut, stop), count)
            nth = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
            yield text[rows], nth * step[rows], period[rows]
            cut = stop
        at = upto


def runs_of(
    texts: list[np.ndarray], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> list[np.ndarray]:
    """Runs of each text of word numbers (0 or more), as rows of start, length and
    period, by start and then period."""
    none = np.zeros((0, 3), np.int64)
    if not texts:
        return []
    lengths = np.array([len(t) for t in texts], np.int64)
    top = max((int(t.max()) for t in texts if len(t)), default=0)
    # a word of its own before all texts and after each of them
    marks = top + 1 + np.arange(len(texts) + 1, dtype=np.int64)
    words = np.concatenate([marks[:1]] + [part for t, m in zip(texts, marks[1:]) for part in (t, [m])]).astype(np.int32)
    owner = np.repeat(np.arange(len(texts)), lengths + 1)
    owner = np.concatenate([owner[:1], owner])
    starts = 1 + np.cumsum(lengths + 1) - (lengths + 1)
    forward = Extensions(words, owner)
    # backwards, a text ends at the mark before it
    last = len(words) - 1
    back_owner = np.concatenate([np.repeat(np.arange(len(texts)), lengths + 1), [len(texts) - 1]])
    backward = Extensions(words[::-1].copy(), (len(texts) - 1 - back_owner)[::-1].copy())
    found = []
    for text, place, period in _places(lengths, min_length, min_exponent):
        i = starts[text] + place
        same = np.flatnonzero(words[i] == words[i + period])
        text, i, period = text[same], i[same], period[same]
        j = i + period
        ahead = forward(i, j)
        behind = backward(last - (j - 1), last - (i - 1))
        length = behind + ahead + period
        good = length >= np.maximum(min_length, min_exponent * period)
        begin = i - behind - starts[text]
        rows = np.stack([text, begin, length, period], 1)[good]
        found.append(np.unique(rows, axis=0))
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    # a multiple of the smallest period spans the same stretch
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    bounds = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    return [rows[a:b, 1:] if b > a else none for a, b in zip(bounds[:-1], bounds[1:])]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in no run behind its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def _solve(texts: list[bytes], min_length: int, min_exponent: int) -> tuple[list[int], list[np.ndarray], list[bytes]]:
    split = [t.split() for t in texts]
    numbers = pa.array([w for doc in split for w in doc], pa.large_binary()).dictionary_encode().indices.to_numpy()
    counts = [len(doc) for doc in split]
    ends = np.cumsum([0, *counts])
    runs = runs_of([numbers[a:b] for a, b in zip(ends[:-1], ends[1:])], min_length, min_exponent)
    collapsed = []
    for doc, found in zip(split, runs):
        if len(found):
            doc = [doc[k] for k in np.flatnonzero(kept_words(len(doc), found))]
        collapsed.append(b" ".join(doc))
    return counts, runs, collapsed


def _chunks(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Spans of rows of about ``CHUNK_WORDS`` words, at six bytes a word."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for row, n in enumerate(sizes.tolist()):
        if size and size + n > 6 * CHUNK_WORDS:
            yield start, row
            start, size = row, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _run_lists(runs: list[np.ndarray]) -> pa.Array:
    rows = np.concatenate([*runs, np.zeros((0, 3), np.int64)])
    fields = [pa.array(rows[:, k]) for k in range(3)]
    values = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()), values).cast(_RUNS)


def periodic_runs(
    docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """``docs`` with the columns ``n_words``, ``runs`` (array of start, length and
    period, by start and then period) and ``collapsed``: the words, joined by one
    space, without those a run holds after its first period.

    Words are what lies between ASCII white space and are compared byte by byte. Runs
    have ``min_length`` words or more and ``min_exponent`` (2 or more) periods or more. A
    null or empty text has no words, no runs and an empty ``collapsed``. Rows are handled
    one by one, so repeated rows or ids give repeated results; input columns of the
    three names are replaced. Memory is bounded by a chunk of rows or the longest text.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("runs need two periods and two words at least")
    added = ("n_words", "runs", "collapsed")
    columns = [c for c in docs.columns if c not in added]
    source = small_batches(docs.select(*[F.col(f"`{c}`") for c in columns]))
    schema = source.select(
        "*", F.lit(0).cast("bigint").alias("n_words"),
        F.lit(None).cast("array<struct<start:bigint,length:bigint,period:bigint>>").alias("runs"), F.lit("").alias("collapsed"),
    ).schema
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in _chunks(batch.column(at)):
                part = batch.slice(begin, end - begin)
                texts = [t or b"" for t in part.column(at).cast(pa.binary()).to_pylist()]
                counts, runs, collapsed = _solve(texts, min_length, min_exponent)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(counts, pa.int64()), _run_lists(runs), pa.array(collapsed).cast(pa.string())],
                    [*part.schema.names, *added],
                )

    return source.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run of greatest length/period, compared exactly; of ties the least start,
    then period. Null if there is none."""
    def better(a: Column, b: Column) -> Column:
        ahead = b["length"] * a["period"] - a["length"] * b["period"]
        return F.when(a.isNull() | (ahead > 0), b).otherwise(a)  # runs come by start, then period

    # bound once, however often the comparison names it
    return F.aggregate(runs, F.get(F.slice(runs, 1, 1), F.lit(0)), better)


def planted(docs: DataFrame) -> DataFrame:
    """The query's texts: every tenth document, by the CRC of its id, repeats itself from
    some word on. A document without id stays as it is."""
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))

    def repeated(row: Column) -> Column:
        g = F.floor(row["h"] / 10).cast("bigint")
        n = F.size(row["w"]).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
        moved = F.transform(
            F.array(F.struct(row["w"].alias("w"), a.alias("a"), p.alias("p"), n.alias("n"))),
            lambda x: F.array_join(F.concat(F.slice(x["w"], F.lit(1), x["a"].cast("int")), F.transform(
                F.sequence(x["a"], x["n"] - 1), lambda i: F.get(x["w"], (x["a"] + (i - x["a"]) % x["p"]).cast("int")),
            )), " "),
        )
        return F.when(n > 0, F.get(moved, F.lit(0))).otherwise("")

    again = F.get(F.transform(F.array(F.struct(words.alias("w"), h.alias("h"))), repeated), F.lit(0))
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), again).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(documents(spark, sf_dir)))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))), "\n")
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        F.col("n_words"),
    )
