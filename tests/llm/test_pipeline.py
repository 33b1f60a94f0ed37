import re

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as cp
from ledgerwatch.llm import contamination, quality, secret_scan
from ledgerwatch.llm.common import documents, written
from tests.llm.test_contamination import least, split
from tests.llm.test_near_duplicates import brute as brute_components


@pytest.fixture(scope="module")
def stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = documents(spark, sf)
    out = [docs.collect()]
    for _, stage in cp.STAGES:
        docs = written(stage(spark, docs, sf))
        out.append(docs.collect())
    return out


def test_columns_and_order(stages):
    names = [list(s[0].asDict()) for s in stages]
    assert all(n == names[0] for n in names[:-1]) and len(cp.STAGES) == 5


def test_quality(spark, stages):
    rules = quality.fitted(documents(spark, "/root/testdata/sf0.001"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    want = set()
    for r in stages[0]:
        n = dict(zip(quality.COUNTS + quality.MORE, quality.counts(r.text or ""), strict=True))
        x = {k: [v] for k, v in quality.features(n.__getitem__).items()}
        bad = n["n_words"] < 20 or 100 * n["n_repeat_words"] > 30 * n["n_words"]
        bad |= any(all((x[f][0] > t) == above for f, above, t in rule.tests) for rule in rules)
        want |= set() if bad else {r.doc_id}
    assert {r.doc_id for r in stages[1]} == want


def test_near_duplicates(stages):
    found = brute_components([(r.doc_id, r.text) for r in stages[1]], 5, 80)
    assert {r.doc_id for r in stages[2]} == {i for i, (_, root) in found.items() if i == root}


def test_contamination(spark, stages):
    items = [split(r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    bad = {r.doc_id for r in stages[2] if any(least(i, w) <= 20 * len(i) // 100 for w in [split(r.text)] for i in items if set(i) & set(w))}
    assert {r.doc_id for r in stages[3]} == {r.doc_id for r in stages[2]} - bad
    assert contamination.STEPS


def test_secrets(stages):
    encoding, before = secret_scan.vocabulary(), {r.doc_id: r.text for r in stages[3]}
    assert {r.doc_id for r in stages[4]} == set(before)
    for r in stages[4]:
        assert r.n_chars == len(r.text)
        if r.text != before[r.doc_id]:
            assert "[SECRET]" in r.text and secret_scan.find(before[r.doc_id], encoding, 2.0)
        assert not re.search("[0-9a-f]{32}", r.text)


def test_pieces(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = {r.doc_id: r.text for r in stages[4]}
    assert len(stages[5]) == len(text)
    for r in stages[5]:
        assert r.ids == library.encode(text[r.doc_id]) and r.n_tokens == len(r.ids) and r.lossless


def test_run(spark, stages):
    got = cp.run(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted((r.doc_id, r.n_tokens) for r in stages[5])


def test_odd_rows_through_every_stage(spark, tmp_path):
    """Null ids and columns, repeated rows, empty, very long and tied texts, and extra columns with names that stages use."""
    words = [f"w{k}" for k in range(60)]
    plain, long = " ".join(words), " ".join(f"x{k}" for k in range(40_000))
    rows = [(1, plain, "en", "s", 1), (1, plain, "en", "s", 1), (2, plain, None, None, None), (None, plain + " end", "en", "s", 3), (None, plain + " end", "en", "s", 3), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, long, "en", "s", 9), (6, f"{' '.join(words[::-1])} AKIA{'B' * 16} tail", "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "'h' as hits", "1 as ids", "2 as kept", "'b' as back", "3 as block")
    sf = str(tmp_path)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"item{k}" for k in range(30))), (None, plain)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    after = []
    for _, stage in cp.STAGES:
        out = stage(spark, docs, sf)
        assert stage(spark, docs.limit(0), sf).count() == 0
        docs = written(out)
        after.append(sorted((-1 if r.doc_id is None else r.doc_id) for r in docs.collect()))
        if len(after) < len(cp.STAGES):
            assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and {"hits", "ids", "kept", "back", "block"} <= set(out.columns)
    assert after[0] == [-1, -1, 1, 1, 2, 5, 6]
    assert after[1] == after[2] == after[3] == after[4] == [-1, -1, 1, 1, 5, 6]
    by = {r.doc_id: r for r in docs.collect()}
    assert by[5].n_tokens == len(by[5].ids) > 40_000 and all(r.lossless for r in by.values())
    assert all(cp.token_stage(spark, spark.createDataFrame([(None, None, None, None)], "doc_id long, text string, lang string, source string"), sf).first()[k] is None for k in ("doc_id", "lossless"))
