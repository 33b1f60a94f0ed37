import random
import re
import time
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwatch.llm import license_scan, quality
from ledgerwatch.llm.license_texts import NOTICES

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = BLANK.findall(text)
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {i + j for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", " ", " ", "\n", "\t", "é", "#", " ", "a b c d e f g h ", "line\n", "\x1f"]), max_size=40).map("".join))
def test_counts(text):
    assert quality.counts(text)[:5] == brute(text)


def test_learned_list_tells_planted_classes():
    rng = np.random.default_rng(7)
    bad = rng.random(3000) < 0.3
    x = {"symbols": np.where(bad, rng.uniform(0.2, 0.5, 3000), rng.uniform(0, 0.1, 3000)), "words": rng.uniform(0, 1, 3000)}
    rules = quality.learn(x, bad)
    got = np.logical_or.reduce([r.covers(x, 3000) for r in rules])
    assert (got == bad).mean() > 0.98 and not (got & ~bad).any()


def test_quality_rows(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, good + f" x{i}", "a") for i in range(60)] + [(100 + i, good + " ###" * 12 + f" y{i}", "b") for i in range(60)] + [(500, None, None), (501, "", "c"), (None, good, "d"), (1, good + " x1", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(60)] + [(None, 1, 0), (7777, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rules = quality.fitted(docs, labels)
    out = quality.judged(docs, rules).collect()
    kept = {r.doc_id: r.kept for r in out}
    assert len(out) == len(rows)
    assert all(kept[i] for i in range(60)) and not any(kept[100 + i] for i in range(60)) and not kept[500] and not kept[501] and kept[None]
    assert quality.accepted(docs, labels).columns == docs.columns and quality.accepted(docs, labels).count() == 62
    assert quality.fitted(docs, labels.limit(0)) == [] and quality.judged(docs.limit(0), rules).count() == 0


def brute_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    at = [(i, label) for label, phrase in license_scan.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_license_rows(spark):
    texts = ["Released under the MIT License. mit-license!", None, "", "...", "GNU General Public\nLicense, general public license", "Apache license apache LICENSE mit", "É mit license", "Licensed under CC BY-NC 4.0.", "general public public license", "license", "mit license " * 500]
    texts.append("Permission is hereby granted, free of charge, to any person obtaining one copy of this Software and associated documentation files (the software), to deal in the software without restriction")
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x"), (None, "mit license", "y")], "doc_id long, text string, label string")
    out = license_scan.licenses(docs).collect()
    assert len(out) == len(texts) + 2
    for r in out:
        t = texts[r.doc_id] if r.doc_id is not None else "mit license"
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_license(t or ""), t
    by = {r.doc_id: r for r in out}
    assert by[7].labels == "cc-by" and by[11].labels == "mit" and 0.75 <= by[11].score <= 1 and by[3].score == 0 and by[0].score == 1
    assert license_scan.licenses(docs.limit(0)).count() == 0


def test_whole_notices(spark):
    texts = [(label, " ".join(words)) for label, text in NOTICES for words in (license_scan.split(text),)]
    cut = [(label, " ".join(w for k, w in enumerate(t.split()) if k % 23)) for label, t in texts]
    docs = spark.createDataFrame([(k, f"x y {t} z") for k, (_, t) in enumerate(texts + cut)], "doc_id long, text string").selectExpr("*", "1 as n_words")
    rows = {r.doc_id: r for r in license_scan.licenses(docs, templates=()).collect()}
    for k, (label, t) in enumerate(texts + cut):
        assert label in rows[k].labels.split(","), t
        if k < len(texts):
            assert rows[k].score == 1 and f"{label}:2:{len(t.split()) + 1}" in rows[k].spans.split(",")
    # a quarter of a notice is none
    part = spark.createDataFrame([(0, " ".join(texts[0][1].split()[:40]))], "doc_id long, text string")
    assert license_scan.licenses(part, templates=()).first().labels == ""


def test_license_of_a_very_long_text(spark):
    docs = spark.createDataFrame([(0, "lorem ipsum " * 150_000 + "Apache License, ok")], "doc_id long, text string")
    r = license_scan.licenses(docs).first()
    assert (r.n_words, r.n_base, r.first_word) == (300_003, 1, 300_000)


def test_two_labels_of_one_document(spark):
    good = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(i, good + " ###" * (i % 2 * 12) + f" x{i}") for i in range(120)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)] + [(i, 1) for i in range(1, 20, 2)], "doc_id long, quality int")
    once = quality.fitted(docs, labels)
    assert once and once == quality.fitted(docs.repartition(7), labels.orderBy("quality", ascending=False).repartition(3))
    assert not any(r.kept for r in quality.judged(docs, once).collect() if r.doc_id % 2)


def test_quality_of_a_very_long_text(spark):
    docs = spark.createDataFrame([(0, " ".join(f"w{k}" for k in range(200_000)))], "doc_id long, text string")
    assert quality.judged(docs, []).first().n_words == 200_000


def test_license_survives_a_word_at_every_place(spark):
    texts = []
    for t, (label, text) in enumerate(license_scan.TEMPLATES):
        words = text.split()
        for k in range(len(words) + 1):
            ends = k in (0, len(words))
            texts.append((label, len(words) - 1, len(words) - 1 - (not ends), " ".join([*words[:k], "zzz", *words[k:]])))
        for k in range(len(words)):
            texts.append((label, len(words) - 1, len(words) - 2 - (0 < k < len(words) - 1), " ".join([*words[:k], *words[k + 1 :]])))
    texts.append(("apache", 20, 20, "you may of the license " + license_scan.TEMPLATES[1][1] + " of the you may obtain"))
    docs = spark.createDataFrame([(k, x[3]) for k, x in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in license_scan.licenses(docs).collect()}
    for k, (label, size, left, text) in enumerate(texts):
        kept = left >= 0.75 * size
        assert (label in rows[k].labels.split(",")) == kept, text
        assert not kept or rows[k].score >= left / size - 1e-9, text


def test_license_spans_of_copies(spark):
    text, n = license_scan.TEMPLATES[3][1], len(license_scan.TEMPLATES[3][1].split())
    docs = spark.createDataFrame([(0, f"{text} {text} word {text}"), (1, "all rights all rights")], "doc_id long, text string")
    rows = {r.doc_id: r for r in license_scan.licenses(docs).collect()}
    assert rows[0].spans == ",".join(f"bsd:{a}:{a + n - 1}" for a in (0, n, 2 * n + 1)) and rows[0].score == 1
    assert rows[1].labels == "" and rows[1].score == 0


def brute_places(text):
    """Places of templates by counting, for each diagonal, the template grams found on it and its neighbours."""
    words, out = license_scan.split(text), []
    every = [(x, y, True, 2) for x, y in license_scan.PHRASES] + [(x, y, False, 2) for x, y in license_scan.TEMPLATES] + [(x, y, False, 4) for x, y in NOTICES]
    for label, phrase, base, k in every:
        tw = license_scan.split(phrase)
        n = len(tw) - k + 1
        shift = 0 if base else min(max(3, len(tw) // 20), (len(tw) - 1) // 2)
        hits = {(i, j) for j in range(n) for i in range(len(words) - k + 1) if words[i : i + k] == tw[j : j + k]}
        found = []
        for d in sorted({i - j for i, j in hits}):
            near = [(i, j) for i, j in hits if abs(i - j - d) <= shift]
            if (count := len({j for _, j in near})) >= (n if base else 0.75 * n):
                found.append((count, -min(near)[0], -max(near)[0], d))
        for own in found:
            if base or own[:3] == max(x[:3] for x in found if abs(x[3] - own[3]) < len(tw)):
                out.append((-own[1], -own[2] + k - 1, label, own[0] / n))
    return sorted(set(out))


def test_places_equal_brute_force(spark):
    rng = random.Random(8)
    sources = [license_scan.split(x) for _, x in (*license_scan.PHRASES, *license_scan.TEMPLATES, *NOTICES)]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rng.randint(1, 4)):
            part = list(rng.choice(sources))
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(part) + 1)
                part[at : at + rng.randint(0, 2)] = ["zzz"] * rng.randint(0, 2)
            words += part * rng.choice([1, 1, 2]) + ["x"] * rng.randint(0, 3)
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in license_scan.licenses(docs).collect()}
    for k, t in enumerate(texts):
        places = brute_places(t)
        assert rows[k].spans == ",".join(f"{label}:{a}:{z}" for a, z, label in sorted({p[:3] for p in places})), t
        assert rows[k].score == max((p[3] for p in places), default=0.0)


def test_very_many_hits_in_one_text(spark):
    """A hundred thousand repeats take time in proportion."""
    took = []
    for n in (25_000, 100_000):
        docs = spark.createDataFrame([(0, "All rights reserved. " * n)], "doc_id long, text string").cache()
        docs.count()
        began = time.perf_counter()
        r = license_scan.licenses(docs).first()
        took.append(time.perf_counter() - began)
        assert (r.n_words, r.labels, r.score, r.spans.count(",")) == (3 * n, "reserved", 1, n - 1)
    assert took[1] < 8 * max(took[0], 1)
