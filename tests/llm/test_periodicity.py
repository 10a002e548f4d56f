"""Periodic runs against all periods tried one by one."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from strataflow.llm import periodicity
from strataflow.llm.common import documents

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, runs int, collapsed string, n_words string, h int, w string"


def smallest_period(words):
    border = [0] * len(words)
    for i in range(1, len(words)):
        k = border[i - 1]
        while k and words[k] != words[i]:
            k = border[k - 1]
        border[i] = k + (words[k] == words[i])
    return len(words) - border[-1]


def plain_runs(words, min_length=24, min_exponent=3):
    words, found = np.asarray(words), []
    for q in range(1, len(words) // min_exponent + 1):
        same = np.concatenate([[False], words[q:] == words[:-q], [False]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(same))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if e + q - s >= max(min_length, min_exponent * q) and smallest_period(words[s:e + q].tolist()) == q:
                found.append((s, e + q - s, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def numbers(words):
    seen = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int32)


def periodic(rng, n, letters):
    out = []
    while len(out) < n:
        unit = [rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 40]))]
        out += (unit * rng.randrange(1, 12))[: rng.randrange(1, 200)]
        out += [rng.randrange(letters) for _ in range(rng.randrange(0, 9))]
    return np.array(out[:n], np.int32)


def test_cover_meets_every_difference():
    assert {(a - b) % periodicity.MODULUS for a in periodicity.COVER for b in periodicity.COVER} == set(range(periodicity.MODULUS))


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_extensions(letters):
    rng = random.Random(letters)
    texts = [periodic(rng, rng.randrange(1, 300), letters) for _ in range(12)]
    words = np.concatenate([np.append(t, 1000 + k) for k, t in enumerate(texts)])
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    lce = periodicity.Extensions(words, owner)
    pairs = [(a, b) for k in range(len(texts)) for a in np.flatnonzero(owner == k) for b in np.flatnonzero(owner == k) if a < b]
    pairs = np.array(rng.sample(pairs, 8000))
    got = lce(pairs[:, 0], pairs[:, 1])
    for (a, b), length in zip(pairs.tolist(), got.tolist()):
        assert (words[a:a + length] == words[b:b + length]).all() and words[a + length] != words[b + length]


@pytest.mark.parametrize("seed", range(6))
def test_random_texts(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(periodicity, "CHUNK_PLACES", rng.choice([50, 5000, 4_000_000]))
    texts = [periodic(rng, rng.randrange(0, 700), rng.choice([1, 2, 3, 20])) for _ in range(25)]
    for length, exponent in ((24, 3), (2, 2), (9, 4)):
        got = periodicity.runs_of(texts, length, exponent)
        assert [list(map(tuple, g.tolist())) for g in got] == [plain_runs(t, length, exponent) for t in texts]


def test_long_texts():
    rng = np.random.default_rng(5)
    block = rng.integers(0, 5000, 30_011)
    thrice = np.concatenate([block, block, block, block[:17], rng.integers(0, 5000, 1000)]).astype(np.int32)
    same = np.zeros(200_000, np.int32)
    assert [g.tolist() for g in periodicity.runs_of([thrice, same])] == [[[0, 3 * 30_011 + 17, 30_011]], [[0, 200_000, 1]]]


def expected(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and text is not None:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(numbers(words)) if words else []
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None, None, None)), best and best[1] * 1000 // best[2],
        hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
        hashlib.sha256(plain_collapse(words, runs)).hexdigest(), len(words),
    )


def test_test_table(spark):
    texts = {r.doc_id: r.text for r in documents(spark, SF_DIR).select("doc_id", "text").collect()}
    rows = periodicity.op11_periodic_runs(spark, SF_DIR).collect()
    assert len(rows) == len(texts) and any(r.n_runs for r in rows)
    assert sorted(map(tuple, rows)) == sorted(expected(i, t) for i, t in texts.items())


def test_edge_cases(spark, tmp_path):
    tenth = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    data = [
        (None, None), (None, "x " * 30), (tenth, None), (tenth, ""), (tenth, " \n\t "), (tenth, "one"), (tenth, "a b c d " * 9), (1, "a b c " * 8),
        (1, "a b c " * 8), (3, "a b c " * 7 + "a b"), (4, "é è É " * 9), (5, "A a " * 11 + "A"), (6, "\x0bq\x0c" * 24), (7, "word " * 1500),
    ]
    docs = spark.createDataFrame([(i, t, 1, "c", "n", 2, "w") for i, t in data], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = periodicity.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(expected(i, t)) for i, t in data)
    found = periodicity.periodic_runs(docs).where("doc_id = 3").first()
    assert [tuple(r) for r in found.runs] == [] and found.collapsed == " ".join(data[9][1].split())
    found = periodicity.periodic_runs(docs, min_length=23).where("doc_id = 3").first()
    assert [tuple(r) for r in found.runs] == [(0, 23, 3)] and found.collapsed == "a b c" and found.n_words == 23


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert periodicity.op11_periodic_runs(spark, str(tmp_path)).collect() == []
