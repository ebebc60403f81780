"""Token counts of every prefix against the tokenizer library itself."""

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headwind.llm import prefix_counts
from headwind.llm.prefix_counts import PrefixCounter
from headwind.llm.texts import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
COUNTER = PrefixCounter(MODEL)


def library_counts(text):
    return [len(LIBRARY.encode(text[:i])) for i in range(len(text) + 1)]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet=" ▁\n\taeinrstABзн漢é́😀0012.'<s>/", max_size=40)))
def test_every_prefix_equals_the_library(text):
    assert COUNTER.counts(text).tolist() == library_counts(text)


@pytest.mark.parametrize("text", ["", " ", " " * 40 + "x", "<s> </s> <unk> <0x0A>", "a" * 300, "x\x00y", "▁▁a ▁", "﻿b"])
def test_odd_texts_equal_the_library(text):
    assert COUNTER.counts(text).tolist() == library_counts(text)


def test_exactly_one_last_piece_fits_each_prefix():
    word = "▁internationalisations"
    for i in range(1, len(word) + 1):
        ends = []
        for size in range(1, min(i, 16) + 1):
            piece, before = word[i - size : i], LIBRARY.encode(word[1 : i - size], out_type=str) if i - size > 1 else []
            before = before or (["▁"] if i - size == 1 else [])
            if size == 1 or piece in COUNTER._score:
                ends += [piece] if COUNTER._stay_apart(before[-1] if before else "", piece) else []
        assert len(ends) == 1


def test_a_long_text_is_counted_in_stretches(monkeypatch):
    text = "  ".join(f"wörd{i} {'z' * (i % 50)}\n" for i in range(3000))
    whole = COUNTER.counts(text)
    monkeypatch.setattr(prefix_counts, "_AT_ONCE", 97)
    assert np.array_equal(PrefixCounter(MODEL).counts(text), whole)
    assert whole[-1] == len(LIBRARY.encode(text))


@pytest.fixture(scope="module")
def docs(spark):
    texts = [None, "", "word " * 60_000, "a  b\n", "a  b\n", "naïve 漢字", "x" * 5000]
    rows = [(i if i != 3 else None, t, 1.5, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, counts double, n_tokens string")


def test_counts_of_a_table(spark, docs):
    got = prefix_counts.count(docs, MODEL, 4096).collect()
    assert len(got) == 7
    for row, (key, text) in zip(got, docs.select("doc_id", "text").collect(), strict=True):
        n = len(LIBRARY.encode(text or ""))
        assert (row.doc_id, row.n_bytes, row.n_tokens) == (key, len((text or "").encode()), n)
        assert row.over_limit == (n > 4096)
        fit = len(LIBRARY.encode((text or "")[: row.fit_chars]))
        assert fit <= 4096 and (row.over_limit or row.fit_chars == len(text or ""))
        assert not row.over_limit or len(LIBRARY.encode(text[: row.fit_chars + 1])) > 4096
    assert prefix_counts.count(docs.limit(0), MODEL).count() == 0


def test_stored_table_answers_without_encoding(spark, docs):
    table = prefix_counts.prefix_table(docs.filter("length(text) < 100 or text is null"), MODEL)
    asked = table.select(
        "n_tokens",
        "counts",
        prefix_counts.tokens_before(F.lit(2)).alias("two"),
        prefix_counts.tokens_before(F.lit(10**6)).alias("all"),
        prefix_counts.longest_within(1).alias("one"),
        prefix_counts.longest_within(-1).alias("none"),
    )
    for row in asked.collect():
        assert row.two == row.counts[min(2, len(row.counts) - 1)] and row["all"] == row.n_tokens
        assert row.one == max(i for i, c in enumerate(row.counts) if c <= 1) and row.none is None
    assert prefix_counts.prefix_table(docs.limit(0), MODEL).count() == 0


def test_truncated_texts_keep_to_the_limit(spark, docs):
    got = prefix_counts.truncated(docs, MODEL, 3)
    assert got.schema == docs.schema
    for old, new in zip(docs.collect(), got.collect(), strict=True):
        assert (new.doc_id, new.counts, new.n_tokens) == (old.doc_id, 1.5, "clash")
        if old.text is None:
            assert new.text is None
        else:
            counts = COUNTER.counts(old.text)
            assert new.text == old.text[: max(np.flatnonzero(counts <= 3))]
