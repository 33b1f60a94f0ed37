import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwatch.llm import periodic_runs as pr


def runs_of(words, least=12):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        start = 0
        while start + q < n:
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            if end - start >= max(least, 2 * q) and not any(words[start : end - p] == words[start + p : end] for p in range(1, q)):
                out.append((start, end - start, q))
            start = end - q + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = runs_of(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def solved(codes, least=12):
    (q, x, y), = pr.fragments([np.array(codes, np.int64)], least)
    out = {}
    for period, a, z in sorted(zip(q.tolist(), x.tolist(), y.tolist(), strict=True)):
        out.setdefault((a, z - a + period), period)
    return sorted(((s, n, p) for (s, n), p in out.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 5)), max_size=8), st.sampled_from([2, 7, 12, 13, 20]))
def test_fragments_are_the_runs(parts, least):
    codes = [c for part, times in parts for c in part * times]
    assert solved(codes, least) == runs_of(codes, least) == sorted(pr.exact_runs(np.array(codes), least), key=lambda r: (r[0], r[2]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=30), st.integers(1, 9)), min_size=3, max_size=12), st.sampled_from([32, 64]))
def test_slabs_stitch_to_the_runs(parts, size):
    before, pr.SLAB = pr.SLAB, size
    try:
        codes = np.array([c for part, times in parts for c in part * times])
        found = [pr.slab_fragments(own, first, last, base, len(codes), 12) for first, last, base, own in pr.slabs(codes, 12)]
    finally:
        pr.SLAB = before
    q, x, y = pr.united(*(np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*found, strict=True))) if found else ((),) * 3
    out = {}
    for period, a, z in sorted(zip(q, x, y, strict=True)):
        if z - a + period >= max(12, 2 * period):
            out.setdefault((a, z - a + period), period)
    assert sorted(((s, n, p) for (s, n), p in out.items()), key=lambda r: (r[0], r[2])) == runs_of(codes.tolist())


def texts(seed, n=150):
    rng = np.random.default_rng(seed)
    words = ["a", "b", "é", "the", "x.", "naïve"]
    for _ in range(n):
        parts = [" ".join(rng.choice(words, int(rng.integers(1, 14)))) for _ in range(int(rng.integers(0, 5)))]
        yield " ".join(p for part in parts for p in [part] * int(rng.integers(1, 5)))


@pytest.mark.parametrize("long", [1 << 16, 20])
def test_query_equals_brute_force(spark, monkeypatch, tmp_path, long):
    monkeypatch.setattr(pr, "LONG", long)
    monkeypatch.setattr(pr, "SLAB", 64)
    rows = [(i, t) for i, t in enumerate(texts(3))]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (None, "a b " * 20), (None, None), (5, rows[5][1]), (5, rows[5][1]), (1003, "a " * 700), (1004, "\x0ba\x0c b\r" * 30), (1005, "a\xa0b " * 12), (1006, "a b c " * 99 + "d " + "a b c " * 99)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "'x' AS runs", "2 AS period").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = pr.op13_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted((tuple(r) for r in got), key=key) == sorted((expected(*r) for r in rows), key=key)


def test_spans_and_texts(spark):
    docs = spark.createDataFrame([(1, "x " + "one two three " * 5 + "y"), (2, "nothing here")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.kept) for r in pr.periodic_runs(docs).collect()}
    assert got == {1: (17, [(1, 15, 3)], "x one two three y"), 2: (2, [], "nothing here")}
    assert pr.periodic_runs(docs.limit(0)).count() == 0


def test_a_hash_collision_is_found_out(spark, monkeypatch):
    """With a hash that takes all words for one word, the words decide."""
    rows = list(texts(5, 20))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    monkeypatch.setattr(pr, "hashed", lambda codes: (np.arange(len(codes) + 1, dtype=np.uint64), np.ones(len(codes) + 1, np.uint64)))
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in pr.periodic_runs(docs).collect()}
    assert got == {i: runs_of(t.split()) for i, t in enumerate(rows)}
