"""Byte-level BPE against tiktoken, and exact round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from strataflow.llm import bpe
from strataflow.llm.common import documents

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(bpe.RANKS)
SCHEMA = "doc_id bigint, text string, ids string, decoded int, n int"


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def odd_texts():
    rng = random.Random(1)
    letters = [" ", "a", "a", "b", "c", "\n", " ", "é", "一", "😀", "0", "'", "s", "\x00"]
    return [
        "", " ", "a" * 30_000, "ab" * 900, "aaab" * 60, "".join(rng.choice("abcdefghij") for _ in range(3000)), "  \n\n \t x　 y  ",
        "<|endoftext|>", "don't I'LL we'Ve", *("".join(rng.choice(letters) for _ in range(40)) for _ in range(300)),
        *("".join(rng.choice("ae") for _ in range(40)) for _ in range(100)),
    ]


def test_test_table(spark, reference):
    texts = {r.doc_id: r.text for r in documents(spark, SF_DIR).select("doc_id", "text").collect()}
    rows = bpe.op5_bpe(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_texts(spark, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 5000)
    data = [*enumerate(odd_texts()), (None, None), (7, None), (7, "tie"), (7, "tie")]
    docs = spark.createDataFrame([(i, t, "clash", 3, 4) for i, t in data], SCHEMA)
    done = bpe.encode(docs, PATH)
    assert set(done.columns) == set(docs.columns) and dict(done.dtypes)["ids"] == "array<int>"
    rows = bpe.decode(done, PATH).collect()
    assert len(rows) == len(data)
    for r in rows:
        if r.text is None:
            assert r.ids is None and r.decoded is None
        else:
            assert r.ids == reference.encode_ordinary(r.text) and bytes(r.decoded) == r.text.encode()


def test_long_words(reference):
    rng = random.Random(4)
    codec = bpe.Codec(PATH, public_tokenizers.PATTERN)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["".join(rng.choice(letters) for _ in range(100_000)), "".join(rng.choice(letters + letters.upper()) for _ in range(30_000)),
             "".join(rng.choice("äöüßéèñ一二三") for _ in range(3000)), "=" * 5000 + "-" * 777, "the" * 3000, "ACGT" * 400]
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert b"".join(codec._independent(text.encode())) == text.encode()


def test_memory_does_not_change_ids(monkeypatch, reference):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 3)
    codec = bpe.Codec(PATH, public_tokenizers.PATTERN)
    for text in odd_texts()[-40:]:
        assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == reference.encode_ordinary(text)


def test_empty_table_and_unknown_id(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert bpe.encode_checked(docs, PATH).count() == 0
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([([1, 50256],)], "ids array<int>"), PATH).collect()
