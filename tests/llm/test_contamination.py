import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwatch.llm import contamination as c


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def least(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=70), st.lists(st.integers(0, 4), max_size=90))
def test_distance(item, text):
    assert c.best_stretch(np.array(item), np.array(text))[0] == least(item, text)


def planted(seed, edits):
    rng = np.random.default_rng(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(k, " ".join(rng.choice(vocabulary, int(rng.integers(15, 56))))) for k in range(30)]
    docs = []
    for i in range(200):
        body = [str(x) for x in rng.choice(vocabulary, int(rng.integers(0, 200)))]
        if i % 2:
            part = items[int(rng.integers(0, 30))][1].split()
            for _ in range(int(len(part) * edits * rng.random())):
                k = int(rng.integers(0, len(part)))
                part[k : k + 1] = [[], [str(rng.choice(vocabulary))], [part[k], str(rng.choice(vocabulary))]][int(rng.integers(0, 3))]
            at = int(rng.integers(0, len(body) + 1))
            body[at:at] = [w.upper() + "," for w in part]
        docs.append((i, " ".join(body)))
    return items, docs


def brute(items, docs):
    return {i: sorted(k for k, t in items if split(t) and least(split(t), split(text or "")) <= 20 * len(split(t)) // 100) for i, text in docs}


def test_recall_and_precision():
    for edits, recall in ((0.0, 1.0), (0.1, 0.99), (0.2, 0.95)):
        items, docs = planted(int(edits * 100), edits)
        index, want = c.Index(items, 20), brute(items, docs)
        got = {i: sorted(x[0] for x in found) for (i, _), found in zip(docs, index.find([t for _, t in docs]), strict=True)}
        assert all(set(got[i]) <= set(want[i]) for i in got)
        assert sum(map(len, got.values())) >= recall * sum(map(len, want.values()))


def test_short_items_equal_brute_force():
    rng = np.random.default_rng(11)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(n * 8 + k, [str(x) for x in rng.choice(vocabulary, n)]) for n in range(1, 15) for k in range(8)]
    docs = []
    for _, item in items:
        part = list(item)
        for k in sorted(rng.choice(len(item), len(item) // 5, replace=False), reverse=True):
            part[k : k + 1] = [[], ["new"], [part[k], "new"]][int(rng.integers(0, 3))]
        body = [str(x) for x in rng.choice(vocabulary, 40)]
        at = int(rng.integers(0, 41))
        docs.append(" ".join([*body[:at], *part, *body[at:]]))
    found = c.Index([(k, " ".join(item)) for k, item in items], 20).find(docs)
    for doc, hits in zip(docs, found, strict=True):
        text = doc.split()
        assert [x[:2] for x in hits] == [(k, d) for k, item in items if (d := least(item, text)) <= len(item) // 5]


def test_rows(spark, monkeypatch):
    items, docs = planted(5, 0.0)
    docs += [(1000, None), (1001, ""), (None, "clean"), (1, docs[1][1])]
    bench = spark.createDataFrame([*items, (None, "a b c"), (77, None), (78, ""), (79, "...")], "item_id long, text string").selectExpr("*", "1 as hits")
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "2 as item_id")
    want = brute(items, docs)
    rows = c.contaminated(frame, bench).collect()
    assert len(rows) == len(docs) and all(sorted(h.item_id for h in r.hits) == want[r.doc_id] for r in rows)
    assert c.clean(frame, bench).count() == sum(not want[i] for i, _ in docs) and c.clean(frame, bench).columns == frame.columns
    monkeypatch.setattr(c, "BLOCK_CHARACTERS", 1500)
    assert {(r.doc_id, tuple(sorted(h.item_id for h in r.hits))) for r in c.contaminated(frame, bench).collect()} == {(i, tuple(want[i])) for i, _ in docs}
    assert c.clean(frame, bench.limit(0)).count() == len(docs) and c.clean(frame.limit(0), bench).count() == 0


def test_ties_long_texts_and_a_column_of_the_same_name(spark):
    item = " ".join(f"q{k}" for k in range(40))
    near = item.replace("q7 ", "new ")
    filler = " ".join(f"z{k}" for k in range(100_000))
    rows = [(1, f"{filler} {item}", "a"), (2, f"{near} lorem {near}", "b"), (3, filler, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = {r.doc_id: [tuple(h) for h in r.hits] for r in c.contaminated(docs, bench).collect()}
    assert got == {1: [(9, 0, 100_040)], 2: [(9, 1, 40)], 3: []}
    assert c.clean(docs, bench).columns == docs.columns and c.clean(docs, bench).first().hits == "c"


def test_recall_by_length():
    rng = np.random.default_rng(5)
    vocabulary = [f"v{i}" for i in range(5000)]
    for n in (1, 2, 3, 5, 8, 12, 16, 24, 33, 40, 60):
        for edits in (0, n // 10, n // 5):
            items = [(k, [str(x) for x in rng.choice(vocabulary, n)]) for k in range(40)]
            docs = []
            for _, item in items:
                part = list(item)
                for k in sorted(rng.choice(n, edits, replace=False), reverse=True):
                    part[k : k + 1] = [[], ["new"], [part[k], "new"]][int(rng.integers(0, 3))]
                docs.append(" ".join([*rng.choice(vocabulary, 10), *part, *rng.choice(vocabulary, 50)]))
            found = c.Index([(k, " ".join(item)) for k, item in items], 20).find(docs)
            assert sum(k in {x[0] for x in hits} for k, hits in enumerate(found)) >= 38, (n, edits)
