import hashlib
import re

import duckdb
import numpy as np
import pytest

from ledgerwatch.llm import repeated_passages as rp


def brute(rows, length=20):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first, out = {}, []
    for i, w in words:
        if i is not None:
            for k in range(len(w) - length + 1):
                x = tuple(w[k : k + length])
                first[x] = min(first.get(x, (i, k)), (i, k))
    for i, w in words:
        gone = set()
        if i is not None:
            for k in range(len(w) - length + 1):
                if first[tuple(w[k : k + length])] < (i, k):
                    gone.update(range(k, k + length))
        out.append((-1 if i is None else i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("period,places", rp.COVERS.items())
def test_covers(period, places):
    assert {(a - b) % period for a in places for b in places} == set(range(period))
    for d in range(period):
        assert any((k % period) in places and ((k + d) % period) in places for k in range(period))


def test_every_pair_of_equal_windows_shares_an_aligned_anchor():
    for length in (5, 12, 20, 33, 50):
        period, places = rp.cover(length)
        gram = length - period + 1
        for a in range(period):
            for b in range(period):
                assert any((a + k) % period in places and (b + k) % period in places for k in range(length - gram + 1))


def texts(seed, n=120):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "naïve", "x."]
    passages = [list(rng.choice(words, int(rng.integers(15, 60)))) for _ in range(8)]
    out = []
    for _ in range(n):
        t = list(rng.choice(words, int(rng.integers(0, 40))))
        for _ in range(int(rng.integers(0, 4))):
            p, k = passages[int(rng.integers(0, 8))], int(rng.integers(0, len(t) + 1))
            a = int(rng.integers(0, len(p)))
            t[k:k] = p[a // 3 : len(p) - a // 4]
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("seed,block,part", [(1, 1 << 23, 1 << 20), (2, 2000, 1 << 20), (3, 2000, 30)])
def test_equals_brute_force(spark, monkeypatch, seed, block, part):
    monkeypatch.setattr(rp, "BLOCK_BYTES", block)
    monkeypatch.setattr(rp, "PART_WORDS", part)
    monkeypatch.setattr(rp, "RANGE_WORDS", 500)
    t = texts(seed)
    rows = [(int(i), x) for i, x in zip(np.random.default_rng(seed).permutation(len(t)), t, strict=True)]
    rows += [(500, t[0]), (500, t[0]), (501, "same " * 60), (502, " same\t\n" * 61), (503, None), (504, ""), (505, " \n\x0b"), (None, t[1]), (None, None), (506, "a " * 19), (507, "a b " * 90), (507, "b a " * 30), (508, t[2].replace(" ", "  ")), (-4, t[3] + " end"), (509, "a\xa0b " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS block", "1 AS row", "2 AS n_words").repartition(3)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept) for r in rp.repeated_passages(docs).collect())
    assert got == brute(rows)


def test_other_lengths_and_empty_tables(spark):
    rows = list(enumerate(texts(7, 40)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for length in (2, 7, 30):
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rp.repeated_passages(docs, length).collect())
        assert got == brute(rows, length)
    assert rp.repeated_passages(docs.limit(0)).count() == 0
    assert rp.repeated_passages(docs.limit(1).selectExpr("doc_id", "'' AS text")).first().kept == ""


def test_query_equals_sql(spark, tmp_path):
    rows = list(enumerate(texts(8, 60)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in rp.op11_repeated_passages(spark, str(tmp_path)).collect())
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(duck.sql(rp.OP11_SQL).fetchall())
    assert got == [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(rows)]
