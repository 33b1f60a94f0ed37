import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwatch.llm import sentence_pieces as sp

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
MODEL = sp.model()


def ids(texts):
    return [np.frombuffer(x, sp.U4).tolist() for x in MODEL.encode(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "th", " ", "  ", "   ", "\n", "É", "漢", "😀", "▁", "ing", "<s>", "ation", "12", ".", "\t", "the"]), max_size=20).map("".join), max_size=3))
def test_equals_the_library(texts):
    assert ids(texts) == LIBRARY.encode(texts)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00▁"), max_size=60))
def test_round_trip(text):
    assert ids([text]) == [LIBRARY.encode(text)]
    assert MODEL.decode(ids([text])[0]) == text


def test_documents():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist() + [" " * 300, "x" * 3000, "ab" * 500 + " " * 50]
    assert ids(texts) == LIBRARY.encode(texts)


def test_suffix_order():
    points = np.array([ord(c) for c in "mississippi_mississippi"])
    got = sp.suffixes(points, 16)
    text = "mississippi_mississippi"
    assert [text[i : i + 16] for i in got] == sorted(text[i : i + 16] for i in range(len(text)))


def test_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, None, "y"), (2, "", "z")], "doc_id long, text string, back string")
    got = sp.encoded(docs).withColumn("again", sp.decoded("ids")).collect()
    assert sorted((r.doc_id or 0, len(r.ids), r.again) for r in got) == [(0, 0, ""), (1, 2, "a b"), (1, 2, "a b"), (2, 0, "")]
    assert sp.encoded(docs.limit(0)).columns == [*docs.columns, "ids"]


def test_a_column_of_the_same_name_and_long_texts(spark):
    docs = spark.createDataFrame([("x", 1, "ab " * 100_000), ("y", 2, "q" * 50_000)], "ids string, doc_id long, text string")
    got = {r.doc_id: r for r in sp.encoded(docs, back_col="back").collect()}
    assert got[1].ids == LIBRARY.encode("ab " * 100_000) and got[1].back == "ab " * 100_000 and got[2].ids == LIBRARY.encode("q" * 50_000)
    assert sp.encoded(docs).columns == ["doc_id", "text", "ids"]


def test_pairs_by_arrays_equal_the_merges():
    rng = np.random.default_rng(2)
    first, second = (rng.choice(MODEL.ids, 3000) for _ in range(2))
    want = [sp.merged([*MODEL.name[a], *MODEL.name[b]], MODEL.score)[0] == [MODEL.name[a], MODEL.name[b]] for a, b in zip(first.tolist(), second.tolist(), strict=True)]
    assert MODEL.stand(first, second).tolist() == want
