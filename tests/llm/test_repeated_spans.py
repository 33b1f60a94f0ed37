import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwatch.llm import repeated_spans as rs


def brute(rows, length=50):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is not None:
            for k in range(len(b) - length + 1):
                w = b[k : k + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        if i is not None:
            for k in range(len(b) - length + 1):
                if first[b[k : k + length]] < i:
                    gone[k : k + length] = b"\x01" * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i if i is not None else -1, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=20, max_size=20), max_size=80), st.integers(1, 3))
def test_deep_shallow(words, shallow):
    data = np.frombuffer("".join(words).encode(), np.uint8)
    rows = rs.as_rows(data, np.arange(len(words)) * 20, np.full(len(words), 20), 20)
    order, kind = rs.deep_shallow(rows, shallow)
    got = [words[k] for k in order]
    assert got == sorted(words) and all((a == b) == (x == y) for a, b, x, y in zip(got, got[1:], kind, kind[1:], strict=False))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=3, max_size=3), max_size=200), st.integers(0, 3))
def test_multikey_quicksort(rows, depth):
    order, first = rs.multikey_quicksort(np.array(rows, np.uint64).reshape(-1, 3), depth)
    cut = [rows[k][:depth] for k in order]
    assert cut == sorted(cut) and first.tolist() == [k for k in range(len(cut)) if k == 0 or cut[k] != cut[k - 1]]


def test_every_window_has_its_anchor(monkeypatch):
    data = np.frombuffer(("abc" * 30 + "the quick brown fox jumps over it" * 9).encode(), np.uint8)
    at, gram = rs.anchors(data, 50)
    window = np.arange(len(data) - 49)
    assert len(at) == len(window) and (at >= window).all() and (at + rs.GRAM <= window + 50).all()
    monkeypatch.setattr(rs, "PIECE", 256)
    again, _ = rs.anchors(data, 50)
    assert len(again) == len(at)


def texts(seed, n=120):
    rng = np.random.default_rng(seed)
    words = [f"word{i}" for i in range(60)] + ["é", "naïve", "x"]
    passages = [" ".join(rng.choice(words, int(rng.integers(6, 40)))) for _ in range(8)]
    out = []
    for _ in range(n):
        t = " ".join(rng.choice(words, int(rng.integers(0, 40))))
        for _ in range(int(rng.integers(0, 3))):
            p, k = str(rng.choice(passages)), int(rng.integers(0, len(t) + 1))
            a = int(rng.integers(0, len(p)))
            t = t[:k] + p[a // 2 : len(p) - a // 3] + t[k:]
        out.append(t)
    return out


@pytest.mark.parametrize("seed,block,hot", [(1, 1 << 24, 4096), (2, 2000, 4096), (3, 2000, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, block, hot):
    monkeypatch.setattr(rs, "BLOCK_BYTES", block)
    monkeypatch.setattr(rs, "HOT_RUNS", hot)
    t = texts(seed)
    rows = [(int(i), x) for i, x in zip(np.random.default_rng(seed).permutation(len(t)), t, strict=True)]
    rows += [(500, t[0]), (500, t[0]), (501, "same " * 60), (502, "same " * 61), (503, None), (504, ""), (None, t[1]), (505, "a" * 300), (506, "a" * 49), (507, "ab" * 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as block", "1 as bucket").repartition(3)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rs.repeated_spans(docs).collect())
    assert got == brute(rows)


def test_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(rs, "PIECE", 256)
    t = texts(9, 12)
    rows = list(enumerate(t)) + [(50, " ".join(t))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in rs.repeated_spans(docs).collect()}
    assert got == {i: (a, b) for i, _, a, b, _ in brute(rows)}
    assert rs.repeated_spans(docs.limit(0)).count() == 0
