import base64

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinfold.llm import tokenize

TEXTS = [
    None, "", " ", "Hello world", "It's  we'll\t\n\n x ", "<|endoftext|>", "नमस्ते दुनिया", "naïve café ​﻿", "👍🏽 emoji", "�� damaged", "a" * 5000,
    "KIj5EHzoK0+UKe+MeLu+Tz9yodvu " * 50, "\x00\x1c\x85\xa0", "١٢٣ ½",
]


def reference():
    import tiktoken

    with open(tokenize.DEFAULT_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("r", pat_str=tokenize.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, block string, ids int")


def test_ids_equal_the_library(spark):
    enc = reference()
    got = {r["doc_id"]: list(r["ids"]) for r in tokenize.encode(rows(spark, TEXTS)).collect()}
    assert got == {i: enc.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}


def test_counts_and_round_trip(spark):
    df = rows(spark, TEXTS)
    e = tokenize.encode(df)
    n = {r[0]: r[1] for r in tokenize.encode(df, counts_only=True).collect()}
    assert n == {r["doc_id"]: len(r["ids"]) for r in e.collect()}
    assert {r[0]: r[1] for r in tokenize.decode(e).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=12))
def test_any_text(spark, texts):
    enc = reference()
    got = {r["doc_id"]: list(r["ids"]) for r in tokenize.encode(rows(spark, texts)).collect()}
    assert got == {i: enc.encode_ordinary(t) for i, t in enumerate(texts)}


def test_repeated_and_missing_ids(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id bigint, text string").repartition(3)
    assert sorted((r[0], list(r[1])) for r in tokenize.encode(df).collect()) == [(1, [64, 275])] * 2


def test_empty(spark):
    assert tokenize.encode(rows(spark, TEXTS).limit(0)).count() == 0


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(tokenize, "BLOCK_CHARS", 3000)
