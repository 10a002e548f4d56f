"""Fill-in-middle against a regular expression on each text, and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from strataflow.llm import infill

SCHEMA = "doc_id bigint, text string, form int, output string, n_units string, h int"


def expected(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[k:k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted(v % (len(units) + 1) for v in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    rng = random.Random(3)
    letters = ["a", "Z", "@", "[", "`", "{", "é", "ß", "一", "😀", "́", " ", "\n", "\x00", "\x7f", "0", "<", "P", ">", "S", "M", "﻿", " "]
    return [
        "", " ", "a", "é", "😀", "<P>", "x<S>y", "<M", "<", "P>", "a<\n>b", "ab" * 70_000, "é" * 9_000, "\r\n\n",
        *("".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(1500)),
        *("".join(rng.choice("abé ") for _ in range(rng.randrange(1, 20))) for _ in range(500)),
    ]


def test_marks():
    texts = [t.encode() for t in odd_texts()]
    ends = np.cumsum([len(t) for t in texts])
    units, points = infill.marks_of(np.frombuffer(b"".join(texts), np.uint8), ends)
    at = 0
    for text, end in zip(texts, ends.tolist()):
        found = [u.encode() for u in re.findall(r"[A-Za-z]+|[^A-Za-z]", text.decode())]
        first = int(units.rank(np.array([at]))[0])
        assert units.rank(np.array([end]))[0] - first == len(found)
        assert points.rank(np.array([end]))[0] - points.rank(np.array([at]))[0] == len(text.decode())
        if found and len(found) < 100:
            assert units.after(first + 1 + np.arange(len(found))).tolist() == (at + np.cumsum([len(u) for u in found])).tolist()
        at = end


def test_edge_cases(spark):
    data = [*enumerate(odd_texts()), (None, None), (None, "ab cd"), (7, None), (8, "tie tie"), (8, "tie tie"), (10**12, "long " * 200_000)]
    docs = spark.createDataFrame([(i, t, 1, "clash", "n", 2) for i, t in data], SCHEMA)
    done = infill.fill_in_middle(docs)
    assert set(done.columns) == set(docs.columns) | {"prefix_chars", "middle_chars"}
    rows = done.withColumn("back", infill.restored(done.output, done.form)).collect()
    got = sorted(str((r.doc_id, r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in rows)
    assert got == sorted(str(expected(i, t)) for i, t in data)
    assert all(r.back == (r.text or "") for r in rows)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_shares_and_seed(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'one two three' AS text")
    forms = {r.form: r["count"] for r in infill.fill_in_middle(docs, cut_percent=50, spm_percent=50).groupBy("form").count().collect()}
    assert all(abs(forms[f] - want) < 200 for f, want in (("plain", 2000), ("psm", 1000), ("spm", 1000)))
    other = infill.fill_in_middle(docs, seed="2").select("output").collect()
    assert other != infill.fill_in_middle(docs).select("output").collect()


def test_empty_table(spark):
    assert infill.fill_in_middle(spark.createDataFrame([], SCHEMA)).collect() == []
