"""Line dedup against a plain version that looks at every run."""

from __future__ import annotations

import pytest
import xxhash

from strataflow.llm import linededup

SCHEMA = "doc_id bigint, text string, runs int, start int, n_lines string"


def text_hash(text):
    """As Spark's ``xxhash64``, which orders texts of one doc_id."""
    digest = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return digest - (1 << 64) if digest >> 63 else digest


def plain(data, least):
    """Lines in a run of ``least`` words that stands wholly before it."""
    docs = []
    for i, text in sorted(set(data), key=lambda d: (d[0] is None, d[0] or 0, text_hash(d[1]))):
        lines = [x.strip(" \t\n\x0b\x0c\r") for x in (text or "").split("\n")]
        real = [(n, x, len(x.split())) for n, x in enumerate(lines) if x]
        docs.append((i, text, real))
    seen, gone = {}, {}
    for d, (i, text, real) in enumerate(docs):
        for a in range(len(real)):
            n = 0
            for b in range(a, len(real)):
                n += real[b][2]
                if n >= least:
                    # every run of enough words that starts here, not only the shortest
                    seen.setdefault(tuple(x for _, x, _ in real[a:b + 1]), (d, real[a][0], real[b][0]))
    for d, (i, text, real) in enumerate(docs):
        for a in range(len(real)):
            n = 0
            for b in range(a, len(real)):
                n += real[b][2]
                if n >= least:
                    first, _, end = seen[tuple(x for _, x, _ in real[a:b + 1])]
                    if first < d or end < real[a][0]:
                        gone.setdefault((i, text), set()).update(range(real[a][0], real[b][0] + 1))
    kept = {}
    for i, text, _ in docs:
        cut = gone.get((i, text))
        kept[i, text] = text if not cut else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in cut)
    return [(i, kept[i, text]) for i, text in data]


BOX = "one two three four"
CASES = {
    "empty": [],
    "nulls": [(None, None), (1, None), (2, ""), (3, "\n\n \n")],
    "ties": [(1, f"{BOX}\nfive six"), (1, f"{BOX}\nfive six"), (1, f"{BOX}\nfive six\nx"), (None, f"{BOX}\nfive six")],
    "both ways": [(1, f"a b\n{BOX}\nc d\ne"), (2, f"zz\na b\n\n {BOX} \nc d\nyy"), (3, f"c d\n{BOX}\nc d"), (5, f"a b\n{BOX}\nq")],
    "within one": [(4, "\n".join(["x y"] * 9)), (5, "\n".join(["x y"] * 4)), (6, f"{BOX} five\nz\n{BOX} five")],
    "context of the first differs": [(1, f"k\n{BOX} v\nl"), (2, f"a b c\n{BOX} v\nd e f"), (3, f"a b c\n{BOX} v\nd e f"), (9, "a b c\nd e f")],
    "long": [(1, "\n".join(f"w{i} q" for i in range(3000))), (2, "\n".join(f"w{i} q" for i in range(40, 60))), (3, "w " * 60_000)],
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    data, least = CASES[name], 5
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in data], SCHEMA)
    done = linededup.dedup_lines(docs, least)
    got = [(r.doc_id, r.text) for r in done.collect()]
    want = [(i, t) for i, t in data] if name == "long" else plain(data, least)
    if name == "long":
        want = [want[0], (2, ""), want[2]]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    assert sorted(got, key=key) == sorted(want, key=key)


def test_a_common_passage_makes_one_row_a_document(spark):
    passage = "\n".join(f"{BOX} {i}" for i in range(12))
    docs = spark.createDataFrame([(i, f"own {i}\n{passage}\nend {i}", 1, 2, "x") for i in range(200)], SCHEMA)
    runs = linededup.repeated_runs(docs).collect()
    assert len(runs) == 199
    assert all(tuple(x) == (1, 12, 0) for r in runs for x in r.runs)
