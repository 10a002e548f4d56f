"""The classifier chain: held-out accuracy and odd tables."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import toxicity
from strataflow.llm.common import documents

SF_DIR = "/root/testdata/sf0.1"
LABELS = "doc_id bigint, quality int, toxic int, text string"
DOCS = "doc_id bigint, text string, toxic string, p_toxic int"


def test_held_out_labels(spark):
    docs = documents(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    chain = toxicity.fit_chain(docs, labels.where("doc_id % 2 = 0"))
    scored = chain.transform(docs).join(labels, "doc_id").where("doc_id % 2 = 1").select("toxic", "p_toxic", "quality", "p_low_quality").collect()
    toxic = [r.p_toxic for r in scored if r.toxic]
    clean = [r.p_toxic for r in scored if not r.toxic]
    assert sum(p >= toxicity.THRESHOLD for p in toxic) > 0.8 * len(toxic)  # only half of a small table to learn from
    assert sum(p >= toxicity.THRESHOLD for p in clean) < 0.01 * len(clean)
    junk = [r.p_low_quality for r in scored if r.quality == 0]
    assert sum(p >= 0.5 for p in junk) > 0.8 * len(junk)


@pytest.mark.parametrize("labels", [
    [], [(1, 1, 0, "")], [(None, 0, 1, ""), (1, None, 1, ""), (2, 1, 1, ""), (2, 0, 0, "")],
    [(i, 1, i % 2, "") for i in range(40)],
], ids=["none", "one class", "nulls and repeats", "no low quality"])
def test_odd_tables(spark, labels):
    data = [(None, None), (1, ""), (2, "bad words"), (2, "bad words"), (3, "x " * 50_000)] + [(i, "vile rude" if i % 2 else "nice kind") for i in range(4, 40)]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in data], DOCS)
    rows = toxicity.toxic_documents(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in rows) == sorted((str(i), t or "") for i, t in data)
    if len(labels) == 40:
        assert {r.doc_id for r in rows if r.toxic} >= set(range(5, 40, 2)) and not any(r.toxic for r in rows if r.doc_id in range(4, 40, 2))
    assert toxicity.toxic_documents(docs.limit(0), spark.createDataFrame(labels, LABELS)).count() == 0


def plain_terms(text):
    found = [w for w in re.split(r"[^a-z]+", text.lower()) if w]
    signs, variety = 20 * len(re.sub(r"[a-z\s]+", "", text)) // len(text), 20 * len(set(found)) // len(found)
    starts = {"^" + w[:n] for n in (4, 5) for w in found if len(w) > n}
    return {*found, *starts, f"~signs {signs}", f"~variety {variety}"}


def plain_fit(x, y, penalty):
    """Logistic weights under an L1 penalty on standardised features, by proximal gradients."""
    spread = x.std(0, ddof=1)
    scale = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1), 0)
    z = (x - x.mean(0)) * scale
    step = 4 / (np.linalg.norm(np.column_stack([z, np.ones(len(z))]), 2) ** 2 / len(z))
    w = ahead = np.zeros(z.shape[1] + 1)
    for k in range(20_000):
        gap = 1 / (1 + np.exp(-(z @ ahead[:-1] + ahead[-1]))) - y
        new = ahead - step * np.append(z.T @ gap, gap.sum()) / len(z)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        ahead, w = new + k / (k + 3) * (new - w), new
    return lambda a: 1 / (1 + np.exp(-((a - x.mean(0)) * scale @ w[:-1] + w[-1])))


def test_the_chain_against_plain_fits_out_of_fold(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "ITERATIONS", 2000)
    monkeypatch.setattr(toxicity, "PENALTY", 0.01)
    rng = random.Random(2)
    vocabulary = [a + b for a in "bcdf" for b in ("ad", "el", "ix", "opped", "oppers")]
    data, labels = [], []
    for i in range(160):
        found = rng.sample(vocabulary, 7)
        low = rng.random() < (0.8 if "bad" in found else 0.2)
        data.append((i, " ".join(found), "clash", 1))
        labels.append((i, 0 if low else 1, int(rng.random() < (0.7 if low else 0.1) + 0.2 * ("fix" in found)), ""))
    docs, held = spark.createDataFrame(data, DOCS), spark.createDataFrame(labels, LABELS)
    rows = toxicity.fit_chain(docs, held).transform(docs).orderBy("doc_id").collect()
    folds = np.array([r[0] for r in docs.orderBy("doc_id").select(F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(2))).collect()])
    terms = sorted(set().union(*(plain_terms(d[1]) for d in data)))
    x = np.array([[t in plain_terms(d[1]) for t in terms] for d in data], float)
    low, toxic = (np.array([float(f(row)) for row in labels]) for f in (lambda r: r[1] == 0, lambda r: r[2] == 1))
    first = plain_fit(x, low, 0.01)(x)
    outside = np.zeros(len(x))
    for fold in (0, 1):
        outside[folds == fold] = plain_fit(x[folds != fold], low[folds != fold], 0.01)(x[folds == fold])
    second = plain_fit(np.column_stack([x, outside]), toxic, 0.01)(np.column_stack([x, first]))
    assert np.abs(np.array([r.p_low_quality for r in rows]) - first).max() < 0.01
    assert np.abs(np.array([r.p_toxic for r in rows]) - second).max() < 0.01
    assert first.std() > 0.1 and second.std() > 0.1  # both have learnt something
