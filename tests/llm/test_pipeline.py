"""Each stage of the pipeline on its own input."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from strataflow.llm import bpe, mixing
from strataflow.llm.common import documents, written
from tests.llm.test_simhash import components, plain_print

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each."""
    kept = [documents(spark, SF_DIR)]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], SF_DIR), f"test-{name}"))
    return kept


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    assert all(df.dtypes == stages[0].dtypes for df in stages[:-1])


def test_toxic_documents_go(spark, stages):
    before, after = ({r.doc_id for r in df.select("doc_id").collect()} for df in stages[:2])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    gone = before - after
    toxic, clean = ({i for i in before if labels.get(i) == y} for y in (1, 0))
    assert len(gone & toxic) > 0.9 * len(toxic) and len(gone & clean) <= 0.01 * len(clean)
    assert {tuple(r) for r in stages[1].collect()} <= {tuple(r) for r in stages[0].collect()}


def test_long_passages_stand_once(stages):
    before = {r.doc_id: r.text for r in stages[1].collect()}
    after = {r.doc_id: r.text for r in stages[2].collect()}
    for df, most in ((before, 10 ** 9), (after, 1)):
        lines = Counter(x.strip() for t in df.values() for x in (t or "").split("\n") if len(x.split()) >= 50)
        assert max(lines.values(), default=0) <= most
    changed = {i for i in after if after[i] != before[i]}
    assert 0 < len(changed) < 0.5 * len(before)


def test_one_of_each_group_stays(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r.text for r in stages[3].collect()}
    prints = [plain_print(text) for text in before.values()]
    named = components(prints, list(before))
    assert after == {i: before[i] for i, name in zip(before, named) if i == name}
    assert 0 < len(before) - len(after) < 0.1 * len(before)


def test_mixture_keeps_all_rows_in_slot_order(spark, stages):
    assert Counter(map(tuple, stages[3].collect())) == Counter(map(tuple, stages[4].collect()))
    slots = {r.doc_id: (r.slot, r.place) for r in mixing.mix(stages[3]).collect()}
    order = [slots[r.doc_id] for r in corpus_pipeline.mix_sources(spark, stages[3], SF_DIR).collect()]
    assert order == sorted(order)


def test_ids(stages):
    path = public_tokenizers.path(bpe.RANKS)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    rows = stages[5].collect()
    assert len(rows) == stages[4].count() and all(r.round_trip for r in rows)
    assert all(r.ids == plain.encode_ordinary(r.text) and r.n_tokens == len(r.ids) for r in rows)


def test_run_gives_the_last_stage(spark, stages):
    want = {(r.doc_id, r.n_tokens) for r in stages[5].select("doc_id", "n_tokens").collect()}
    assert {(r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id", "n_tokens").collect()} == want


def test_nulls_and_empty_tables(spark):
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (2, "", "en", None, 0), (3, "x y z " * 40_000, None, "b", 5)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF_DIR), "test-nulls")
        assert docs.count() == (3 if data else 0)
