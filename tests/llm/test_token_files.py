import zlib

import numpy as np
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwatch.llm import token_files as tf


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=60), min_size=1, max_size=6))
def test_round_trip(docs):
    ids = np.array([x for d in docs for x in d], tf.U4)
    n = np.array([len(d) for d in docs])
    rules, lengths, symbols, n_symbols = tf.compress(ids, np.cumsum(n), 5)
    assert (tf.expand(symbols, rules, lengths, 5) == ids).all()
    s = tf.Shard({"base": 5, "doc_ids": list(range(len(docs))), "n_ids": n.astype(tf.U4).tobytes(), "n_symbols": n_symbols.tobytes(), "rules": rules.tobytes(), "rule_lengths": lengths.tobytes(), "symbols": symbols.tobytes()})
    for k, d in enumerate(docs):
        assert s.document(k).tolist() == d
        assert s.ids(k, len(d) // 3, len(d)).tolist() == d[len(d) // 3 :]


def test_repeats_shrink():
    ids = np.tile(np.arange(50), 400).astype(tf.U4)
    assert len(tf.compress(ids, np.array([len(ids)]), 100)[2]) < len(ids) / 20


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", " ", "\n", "it's", "É", "1", "  ", "\t", " ", "word", "!", "<|endoftext|>", "'", "x y", "　"]), max_size=12).map("".join))
def test_units_encode_as_the_whole(text):
    assert np.frombuffer(tf.Encoder()([text])[0], tf.U4).tolist() == tf.tokenizer().encode(text, add_special_tokens=False).ids


WHITE = [chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x180E, 0xFEFF)]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(st.sampled_from([*WHITE, *" " * 12, *"aé1!'", "\u0301"]), max_size=8), min_size=1, max_size=20))
def test_any_white_space(texts):
    for got, e in zip(tf.Encoder()(texts), tf.tokenizer().encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(got, tf.U4).tolist() == e.ids


def test_spaces_of_two_kinds():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice([" ", "\xa0", "a"], int(rng.integers(1, 12)))) for _ in range(60_000)]
    wrong = [t for t, got, e in zip(texts, tf.Encoder()(texts), tf.tokenizer().encode_batch(texts, add_special_tokens=False), strict=True) if np.frombuffer(got, tf.U4).tolist() != e.ids]
    assert not wrong


def test_documents():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist() + [" a", "a b. c, d!", " ", "", "Ünï çøđé. ⅷ x² ªb", "it's 5pm. U.S. e.g., a.b"]
    encoder = tf.Encoder()
    for got, e in zip(encoder(texts), tf.tokenizer().encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(got, tf.U4).tolist() == e.ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=6).map(" ".join))
def test_any_text(text):
    assert np.frombuffer(tf.Encoder()([text])[0], tf.U4).tolist() == tf.tokenizer().encode(text, add_special_tokens=False).ids


def test_files(spark, tmp_path):
    rows = [(i, f"hello  world {i} " * (i % 7)) for i in range(300)] + [(1000, None), (1001, ""), (None, "x"), (5, "again"), (2000, "long " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start").repartition(5)
    path = f"file://{tmp_path}/files"
    tf.write_token_files(docs, path, shard_ids=500)
    got = sorted(tf.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got if r.doc_id is not None] == sorted(r[0] for r in rows if r[0] is not None) and len(got) == len(rows)
    at, texts = 0, {r[0]: r[1] or "" for r in rows if r[0] != 5}
    for r in got:
        assert r.start == at
        at += r.n_tokens
        if r.doc_id != 5:
            ids = [*tf.tokenizer().encode(texts[r.doc_id], add_special_tokens=False).ids, 0]
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, tf.U4).tobytes()))
    tf.write_token_files(docs.limit(0), path + "0")
    assert tf.read_token_files(spark, path + "0").count() == 0


def test_long_passages_become_few_symbols():
    passage = np.random.default_rng(3).integers(0, 50_000, 2000)
    ids, ends = np.tile(passage, 50).astype("<u4"), np.arange(1, 51) * 2000
    rules, lengths, symbols, _ = tf.compress(ids, ends, 50_257)
    assert np.array_equal(tf.expand(symbols, rules, lengths, 50_257), ids)
    assert lengths.max() > 64 and len(symbols) < len(ids) / 64


def test_words_and_what_follows_them():
    """Words of letters with and without accents, in front of signs, digits, contractions, white space, marks and letters of other scripts."""
    rng = np.random.default_rng(4)
    letters, rest = [*"abthnwISZ", *"\u00c0\u00d6\u00d7\u00d8\u00f6\u00f7\u00f8\u0120\u01c5\u024f\u0250\u00aa\u00b5\u0301\u03b1\u4e2d"], ["", "", ".", ",\n", "'s", "'ll x", "\nNt", "12", "***", "\t", "\n\n", "-ab", "\x7f", "\u2019s", "\xa0", "!\u0301"]
    texts = [" ".join("".join(rng.choice(letters, int(rng.integers(1, 7)))) + str(rng.choice(rest)) for _ in range(int(rng.integers(1, 12)))) for _ in range(20_000)]
    encoder = tf.Encoder()
    for low in (0, 10_000):
        part = texts[low : low + 10_000]
        for t, got, e in zip(part, encoder(part), tf.tokenizer().encode_batch(part, add_special_tokens=False), strict=True):
            assert np.frombuffer(got, tf.U4).tolist() == e.ids, t


def test_the_library_gets_each_word_once(monkeypatch):
    """Signs behind a word make no new word of it."""
    count, cut = [], tf.Encoder.cut if hasattr(tf.Encoder, "cut") else None
    assert cut, "pieces were learned whole"
    monkeypatch.setattr(tf.Encoder, "cut", lambda self, tok, text, sizes: count.append(len(sizes)) or cut(self, tok, text, sizes))
    words = ["".join(np.random.default_rng(k).choice([*"abcdefgh"], 9)) for k in range(500)]
    texts = [" ".join(["x", *(w + sign for w in words)]) for sign in ("", ".", ",", "!\nA", "'s")]
    encoder = tf.Encoder()
    assert [np.frombuffer(x, tf.U4).tolist() for x in encoder(texts)] == [e.ids for e in tf.tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert sum(count) < 600
    encoder(texts)
    assert sum(count) < 600


def test_groups_are_bounded_by_rows_and_characters():
    assert list(tf.groups(["ab"] * 5, 2, 100)) == [(0, 2), (2, 4), (4, 5)] and list(tf.groups(["ab", "abcdef", "", "abc", "a"], 9, 4)) == [(0, 2), (2, 5)]
    assert list(tf.groups([], 2, 2)) == [] and list(tf.groups(["", ""], 2, 5)) == [(0, 2)]


def same_as_the_library(encoder, texts):
    for t, got, e in zip(texts, encoder(texts), tf.tokenizer().encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(got, tf.U4).tolist() == e.ids, t


def test_the_library_gets_a_word_behind_a_line_feed_once(monkeypatch):
    """Each line's first word and the sign before the line feed are units of their own."""
    count, cut = [], tf.Encoder.cut
    monkeypatch.setattr(tf.Encoder, "cut", lambda self, tok, text, sizes: count.append(len(sizes)) or cut(self, tok, text, sizes))
    words = ["".join(np.random.default_rng(k).choice([*"abcdefgh"], 9)) for k in range(500)]
    encoder = tf.Encoder()
    same_as_the_library(encoder, [" ".join(["x", *(f"y{sign}\n{w}" for w in words)]) for sign in (".", ",", "!", "?")])
    assert sum(count) < 600


def test_units_at_any_place():
    """Signs, line feeds, digits and letters of all kinds in any order, also where texts begin and end."""
    rng = np.random.default_rng(5)
    kinds = [*" " * 6, *"aZ\n\n\r\t'.<|0", "'s", "'ll", "\u00e9", "\u00d7", "\u00f7", "\u024f", "\u0250", "\u0301", "\u4e2d", "\U0001f600", "\x00", "\x1c", "\x7f", "\x85", "\xa0"]
    encoder = tf.Encoder()
    for _ in range(4):
        same_as_the_library(encoder, ["".join(rng.choice(kinds, int(rng.integers(0, 14)))) for _ in range(15_000)])


def test_forgotten_units_are_learned_again(monkeypatch):
    monkeypatch.setattr(tf, "MOST_CACHED", 40)
    rng, encoder = np.random.default_rng(6), tf.Encoder()
    words = ["".join(rng.choice([*"abcdefgh"], 6)) for _ in range(300)]
    for _ in range(30):
        same_as_the_library(encoder, [" ".join(rng.choice(words, 10)) + "." for _ in range(2)])
    assert len(encoder.known) == len(encoder.ids) == len(encoder.used) < 130


def test_long_units_go_to_the_library_in_small_groups(monkeypatch):
    """What the library holds at once is bounded by bytes too, as a text without spaces is one unit."""
    monkeypatch.setattr(tf, "TOGETHER_BYTES", 3_000)
    most, each = [], tf.Encoder.each
    monkeypatch.setattr(tf.Encoder, "each", lambda self, units: most.append(sum(map(len, units.to_pylist()))) or each(self, units))
    rng = np.random.default_rng(7)
    same_as_the_library(tf.Encoder(), ["".join(map(chr, rng.integers(0x4E00, 0x9FA5, 300))) + ". a" for _ in range(50)])
    assert len(most) > 10 and max(most) < 4_000
