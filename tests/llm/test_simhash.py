"""SimHash groups against the comparison of all pairs."""

from __future__ import annotations

import random

import pytest
import xxhash

from strataflow.llm import simhash
from strataflow.llm.common import documents
from strataflow.llm.components import connected_components

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, fp string, key int, component_id int"


def plain_print(text, size=3):
    toks = (text or "").encode().lower().split()
    n = min(size, len(toks))
    hashes = [xxhash.xxh64_intdigest(b" ".join(toks[i:i + n]), 42) for i in range(len(toks) - n + 1)] if toks else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, names, radius=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, name in enumerate(names):
        if name is not None:
            least[find(i)] = min(least.get(find(i), name), name)
    return [least.get(find(i)) for i in range(len(prints))]


def check(rows, data):
    prints = [plain_print(t) for _, t in data]
    named = components(prints, [i for i, _ in data])
    want = sorted((i if i is not None else -1, p, c if c is not None else -1) for (i, _), p, c in zip(data, prints, named))
    assert sorted((i if i is not None else -1, f & (1 << 64) - 1, c if c is not None else -1) for i, f, c in rows) == want


def test_test_table(spark):
    data = [(r.doc_id, r.text) for r in documents(spark, SF_DIR).select("doc_id", "text").collect()]
    rows = simhash.op9_simhash(spark, SF_DIR).collect()
    check([(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in rows], data)
    assert all(len(r.fingerprint) == 16 for r in rows)


@pytest.mark.parametrize("data", [
    [],
    [(None, None), (1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (5, "one two three four"), (None, "x y z"), (7, "Ä b c"), (8, "ä b c")],
    [(1, "word " * 100_000), (2, "word " * 99_999)],
], ids=["empty", "nulls and ties", "long"])
def test_edge_cases(spark, data):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in data], SCHEMA)
    check([(r.doc_id, r.fp, r.component_id) for r in simhash.simhash_components(docs).collect()], data)


def test_words_one_bit_apart_share_a_codeword():
    keys = simhash.golay_keys()
    for segment in range(0, 1 << 16, 37):
        for bit in range(16):
            assert keys[segment][0] in keys[segment ^ 1 << bit]


@pytest.mark.parametrize("block", [4, 2048])
def test_all_links_up_to_three_bits(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)  # small blocks: hot keys are dealt out in pairs of blocks
    rng = random.Random(5)
    prints = []
    for _ in range(60):
        start = rng.getrandbits(64)
        prints.append(start)
        for _ in range(rng.choice([1, 2, 30])):
            prints.append(rng.choice(prints[-8:]) ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4]))))
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    edges = simhash.near_edges(spark.createDataFrame([(p, p, 0) for p in prints], "id bigint, fp bigint, seed int"))
    found = {r.node: r.root for r in connected_components(edges).collect()}
    got = [found.get(p, p) for p in prints]
    assert got == components([p & (1 << 64) - 1 for p in prints], prints)
    assert edges.count() < 30 * len(prints)


def test_one_of_each_group_is_kept(spark):
    data = [(3, "a b c d e f"), (1, "A b c d e f"), (2, "q w e r t y"), (None, "a b c d e f"), (9, "")]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in data], SCHEMA)
    kept = simhash.keep_first(docs, simhash.simhash_components(docs))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "9", "None"]


def test_copies_are_linked_by_bits_alone(spark):
    """Texts with words changed, appended or cut: those within three bits, and no others, are one group."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.choice([2, 3, 7]))) for _ in range(3000)]
    texts = []
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(150, 1500))]
        changed = list(base)
        changed[rng.randrange(len(changed))] = "other"
        texts += [base, list(base), changed, [*base, "one", "more"], base[:-2], base[:len(base) // 2]]
    data = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in data], SCHEMA)
    found = simhash.simhash_components(docs)
    check([(r.doc_id, r.fp, r.component_id) for r in found.collect()], data)
    groups = {r.doc_id: r.component_id for r in found.collect()}
    kept = simhash.keep_first(docs, found)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in groups if groups[i] == i}
    assert 60 < kept.count() < 200
