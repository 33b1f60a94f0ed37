import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import common
from ledgerwatch.llm import near_duplicates as nd
from ledgerwatch.llm.components import components


def brute(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    ids = sorted(sets)

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed, size=160):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for i in range(size):
        if rows and rng.random() < 0.65:
            t = list(rows[int(rng.integers(0, min(len(rows), 12)))][1].split())
            for _ in range(int(rng.integers(0, 5))):
                t[int(rng.integers(0, len(t)))] = str(rng.choice(words))
        else:
            t = [str(x) for x in rng.choice(words, int(rng.integers(3, 120)))]
        rows.append((i, " ".join(t)))
    return rows + [(size, ""), (size + 1, None), (size + 2, "One"), (size + 3, "one"), (size + 4, "\x1f"), (size + 5, "one two"), (size + 6, " \n ")]


@pytest.mark.parametrize("n,percent,chunk", [(3, 85, 512), (5, 80, 8)])
def test_components_equal_brute_force(spark, monkeypatch, n, percent, chunk):
    monkeypatch.setattr(nd, "BLOCK_ROWS", chunk)
    rows = corpus(n)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kept", "'x' as block")
    got = nd.near_duplicates(docs, n, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, n, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (9, "A B C")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in nd.near_duplicates(docs, 3, 85).collect())
    assert got == [(-1, None, True), (4, 4, True), (4, 4, True), (9, 4, False)]
    assert nd.deduplicated(docs).count() == 3
    assert nd.near_duplicates(docs.limit(0)).count() == 0


def test_an_id_with_two_texts_ties_both(spark):
    one, two = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    docs = spark.createDataFrame([(7, one), (7, two), (8, one + " more"), (9, two + " more"), (10, two + " more")], "doc_id long, text string")
    got = [(r.doc_id, r.component_id) for r in nd.near_duplicates(docs, 3, 85).collect()]
    assert sorted(got) == [(7, 7), (7, 7), (8, 7), (9, 7), (10, 7)]


def test_the_filter_of_ids_has_no_false_negatives(spark, monkeypatch):
    rows = spark.range(-3000, 3000).selectExpr("CASE WHEN id <> 5 THEN id END AS doc_id", "'x' AS row", "id AS b", "1 AS hit", "'y' AS page", "id AS gone")
    ids = spark.range(-3000, 3000, 7).selectExpr("id AS some")
    for bits, most in ((common.BITS, 880), (1 << 16, 2000), (1 << 10, 6000)):
        monkeypatch.setattr(common, "BITS", bits)
        got = common.perhaps(rows, "doc_id", ids).filter("hit").select("row.*").collect()
        assert {r.doc_id for r in got} >= {r.some for r in ids.collect()} - {5} and len(got) <= most
    assert not common.perhaps(rows, "doc_id", ids.limit(0)).filter("hit").count()


def test_the_plan_is_the_same_at_every_size(spark, monkeypatch):
    """A filter that lets everything pass changes how much is moved, not what stays."""
    docs = spark.createDataFrame(corpus(4, 60), "doc_id long, text string").withColumns({"gone": F.lit(1), "b": F.lit("x"), "hit": F.lit(True)})
    few = sorted(map(tuple, nd.deduplicated(docs).collect()))
    assert nd.deduplicated(docs).columns == docs.columns
    monkeypatch.setattr(common, "BITS", 1)
    assert sorted(map(tuple, nd.deduplicated(docs).collect())) == few


def test_a_very_long_text_and_a_tie_at_the_threshold(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    exact = [f"v{k}" for k in range(202)]  # 200 shingles of three words
    cut = " ".join(exact[:172])  # 170 of them, 85 per cent
    docs = spark.createDataFrame([(1, long), (2, long + " x"), (3, " ".join(exact)), (4, cut), (5, " ".join(exact[:171]).replace("v170", "u"))], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in nd.near_duplicates(docs, 3, 85).collect())[:4] == [(1, 1), (2, 1), (3, 3), (4, 3)]


def test_long_chains(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[101] == 100


@pytest.mark.parametrize("seed", range(30))
def test_links_join_what_is_connected(seed):
    rng = np.random.default_rng(seed)
    centres = [np.unique(rng.integers(0, 1000, 40)) for _ in range(4)]
    sets = []
    for _ in range(40):
        own = centres[int(rng.integers(0, 4))].copy()
        own[: int(rng.integers(0, 9))] = rng.integers(1000, 5000, 1)
        sets.append(np.unique(own).astype(np.uint64))
    similar = [[100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)) for b in sets] for a in sets]

    def closed(label):
        changed = True
        while changed:
            changed = False
            for a in range(40):
                for b in range(40):
                    if similar[a][b] and label[a] != label[b]:
                        label = [min(label[a], label[b]) if x in (label[a], label[b]) else x for x in label]
                        changed = True
        return label

    start = list(range(40))
    for a in range(40):  # some links are known before
        for b in range(a):
            if similar[a][b] and rng.random() < 0.1:
                low, high = sorted((start[a], start[b]))
                start = [low if x == high else x for x in start]
    got = list(start)
    for a, b in nd.linked(np.arange(40), np.array(start), sets, 85):
        assert similar[a][b]
        low, high = sorted((got[a], got[b]))
        got = [low if x == high else x for x in got]
    assert got == closed(list(start))


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = c.sql(nd.OP2_SQL).fetchall()
    got = nd.op2_minhash(spark, sf).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(want)
