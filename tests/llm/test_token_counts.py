import glob

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerwatch.llm import token_counts as tc

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
COUNT = tc.counter()


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["a", "th", "'s", "'re", "'", "'l", "l", " ", "\n", "É", "é", "Σ", "İ", "12", "!", "...", "ing", "<|endoftext|>", "<|", "漢", "\x1c", " ", "ß", "😀", "tion", "anti", "www"]), max_size=25).map("".join))
def test_equals_the_library(text):
    assert COUNT([text]) == library([text])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=4))
def test_equals_the_library_on_any_text(texts):
    assert COUNT(texts) == library(texts)


def test_newer_characters():
    """Letters and signs that Unicode got after Python's tables."""
    newer = [chr(c) for c in (0x1C89, 0x1C8A, 0xA7CB, 0xA7DA, 0xA7DC, 0x10D50, 0x10D70, 0x10D40, 0x11DE0, 0x13808, 0x1385C, 0x13988, 0x16D40, 0x1CCF0, 0x1E5F1, 0x2FFFF)]
    texts = [f.format(c) for c in newer for f in ("{0}", "a{0}", "İ {0}b", "{0}{0}1", ".{0}.", "5{0} x{0}'s", "Σ{0}")]
    assert COUNT(texts) == library(texts)


def test_the_states_of_a_long_pretoken_are_bounded(monkeypatch):
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcdeéthing"), n)) for n in (5_000, 40_000)]
    want = library(texts)
    monkeypatch.setattr(tc, "MOST_STATES", 700)
    own = tc.Counter()
    assert own(texts) == want
    assert len(own.merges.text) <= 702


@pytest.mark.parametrize("path", sorted(glob.glob("/root/testdata/sf0.01/documents.parquet")))
def test_equals_the_library_on_documents(path):
    texts = pq.read_table(path).column("text").to_pylist()
    assert COUNT(texts) == library(texts)


def test_chunks_and_long_texts():
    texts = ["x" * 5000, "it's " * 3000, "'re" * 2000, " " * 4000, "", "a" + "'" * 1023 + "s"]
    assert COUNT(texts) == library(texts)
    points = np.frombuffer(("we'll see 'em..'s " * 400).encode("utf-32-le"), np.uint32)
    state, slow = 0, []
    kinds = tc.classes()[points]
    text = "we'll see 'em..'s " * 400
    for i, k in enumerate(kinds):
        if text[i] == "'":
            k = tc.SHORT if text[i + 1] in "stmd" else tc.LONG if text[i + 1 : i + 3] in ("re", "ve", "ll") else k
        slow.append(bool(tc.MARK[state][k]))
        state = tc.NEXT[state][k]
    assert tc.marks(points).tolist() == slow


def test_rows(spark):
    docs = spark.createDataFrame([(1, "the the", 1), (1, "the the", 2), (None, None, 3), (2, "", 4), (3, "word " * 3000, 5)], "doc_id long, text string, n_tokens int")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in tc.token_counts(docs).collect())
    assert got == [(0, 0, 0, False), (1, 7, 2, False), (1, 7, 2, False), (2, 0, 0, False), (3, 15000, 3000, True)]
    assert tc.token_counts(docs.limit(0)).count() == 0


def test_equal_hashes_of_different_pretokens(monkeypatch):
    texts = ["one two three two one", "a bb ccc", ""]
    want = tc.Counter()(texts)
    monkeypatch.setattr(tc, "span_hashes", lambda data, first, last: np.zeros(len(first), np.uint64))
    assert tc.Counter()(texts) == want
