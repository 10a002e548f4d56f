"""Licence scan: variants of the templates, and texts that only look like them."""

from __future__ import annotations

import pytest

from strataflow.llm import licenses

SCHEMA = "doc_id bigint, text string, matches string"


def plain(text):
    """Dice with every template, no pruning."""
    found, lines = [], (text or "").split("\n")
    for at, unit in [*enumerate(lines), *([(-1, text)] if len(lines) > 1 else [])]:
        grams = set(licenses._bigrams_of("".join(c if c.isascii() else "." for c in unit)))
        best = [(2 * len(grams & b) / (len(grams) + len(b)), k) for k, v in licenses.TEMPLATES.items() if (b := set(licenses._bigrams_of(v)))]
        best = max((x for x in best if x[0] >= licenses.THRESHOLD), default=None)
        if best:
            found.append((at, best[1], round(best[0], 9)))
    return sorted(found)


GPL = licenses.TEMPLATES["GPL-3.0-header"]
DATA = [
    (None, None), (1, ""), (2, "x"), (3, licenses.TEMPLATES["MIT"]), (4, "é\n  RELEASED under -- the MIT   licence\nReleased under the MIT License"),
    (5, GPL.replace(" the ", "\nthe ")), (6, "Licensed under the Apache License, Version 2.0"), (6, "Licensed under the Apache License, Version 2.0"),
    (7, "this work is licensed to nobody"), (8, "word " * 30_000 + "\n" + licenses.TEMPLATES["CC-BY-NC-4.0"]), (9, "\n\n"),
]


@pytest.mark.parametrize("data", [[], DATA], ids=["empty", "edge"])
def test_edge_cases(spark, data):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in data], SCHEMA)
    rows = licenses.scan(docs).collect()
    got = sorted((str(r.doc_id), [(m.line, m.license, round(m.dice, 9)) for m in r.matches]) for r in rows)
    assert got == sorted((str(i), plain(t)) for i, t in data)
