"""Quality rules as learned decision lists.

Text statistics are counted for every whole text. A decision list is learned by sequential covering: grow a conjunction of
threshold tests that best tells rejected from accepted labelled documents, prune it against held-back labels, keep it if it
stays precise, take away what it covers and go on. The ordered rules become one Spark conditional expression.

The learner sees at most `most_labels` labelled documents (those first by a hash of doc_id); everything else covers all rows.
Null or empty texts have no words, so they fail the base rule. Labels that are null, or of unknown documents, teach nothing; a document with
two labels counts as rejected, and of several texts of one labelled id the one with the least statistics is learned from. Without
labels the list is empty and the base rule alone decides. Repeated rows give repeated results, a null id stays null.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, documents, give_back, id_and_text, span_hashes, windows, word_bounds

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct", "n_upper", "n_digits", "n_marks")
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MARKS = np.zeros(256, bool)
MARKS[list(b"!?.,;:-_/\\()[]{}\"'")] = True
BLANKS = " \t\n\x0b\x0c\r"
REPEAT_WORDS = 8


def counts(text: str) -> tuple[int, ...]:
    """The statistics of one text, in the order of COUNTS and MORE."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends = word_bounds(data)
    words = span_hashes(data, starts, ends)
    runs = windows(words, REPEAT_WORDS)
    repeated = 0
    if len(runs):
        _, which, times = np.unique(runs, return_inverse=True, return_counts=True)
        again = np.zeros(len(words) + 1, np.int64)
        hit = np.flatnonzero(times[which] > 1)
        np.add.at(again, hit, 1)
        np.subtract.at(again, hit + REPEAT_WORDS, 1)
        repeated = int((np.cumsum(again) > 0).sum())
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    by_byte = np.bincount(data, minlength=256)
    chars = int((~WHITE[data] & ((data & 0xC0) != 0x80)).sum())
    return (len(words), chars, int(by_byte[SYMBOLS].sum()), len(lines) - len(set(lines)), repeated, len(lines), len(np.unique(words)), int(by_byte[65:91].sum()), int(by_byte[48:58].sum()), int(by_byte[MARKS].sum()))


def count_batch(texts: pa.Array) -> pa.Array:
    rows = np.array([counts(x or "") for low in range(0, len(texts), 1000) for x in texts[low : low + 1000].to_pylist()], np.int64).reshape(len(texts), len(COUNTS + MORE))
    give_back()
    return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(rows.shape[1])], COUNTS + MORE)


def text_counts(text: str | Column) -> Column:
    """A struct of all statistics."""
    return F.arrow_udf(count_batch, ", ".join(f"{x} long" for x in COUNTS + MORE))(text)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def features(count) -> dict:
    """Ratios that the rules test; works on Columns and on arrays alike."""
    per = lambda a, b: count(a) / (count(b) + 1.0)
    return {
        "words": count("n_words") * 1.0,
        "word_length": per("word_chars", "n_words"),
        "symbols": per("n_symbols", "word_chars"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
        "line_words": per("n_words", "n_lines"),
        "distinct": per("n_distinct", "n_words"),
        "upper": per("n_upper", "word_chars"),
        "digits": per("n_digits", "word_chars"),
        "marks": per("n_marks", "word_chars"),
    }


@dataclass(frozen=True)
class Rule:
    """Rejects where every test holds: (feature, True for > or False for <=, threshold)."""

    tests: tuple[tuple[str, bool, float], ...]

    def covers(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        return reduce(and_, (x[f] > t if above else x[f] <= t for f, above, t in self.tests), np.ones(n, bool))

    def column(self, x: dict[str, Column]) -> Column:
        return reduce(and_, (x[f] > t if above else x[f] <= t for f, above, t in self.tests))


def grown(x: dict[str, np.ndarray], bad: np.ndarray, most_tests: int) -> Rule:
    """Adds the test of the best information gain until none of the accepted is covered or nothing improves."""
    tests: list[tuple[str, bool, float]] = []
    held = np.ones(len(bad), bool)
    while len(tests) < most_tests and (~bad[held]).any():
        p, n = bad[held].sum(), (~bad[held]).sum()
        best = (0.0, None)
        for f, v in x.items():
            own = v[held]
            edges = np.unique(np.quantile(own, np.linspace(0.01, 0.99, 64)))
            order = np.sort(own[bad[held]]), np.sort(own[~bad[held]])
            below = [np.searchsorted(o, edges, "right") for o in order]
            for above, (a, b) in ((False, below), (True, (p - below[0], n - below[1]))):
                gain = np.where(a > 0, a * (np.log2((a + 1e-9) / (a + b + 1e-9)) - np.log2(p / (p + n))), 0.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), (f, above, float(edges[k])))
        if best[1] is None:
            break
        tests.append(best[1])
        f, above, t = best[1]
        held &= x[f] > t if above else x[f] <= t
    return Rule(tuple(tests))


def pruned(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The prefix of the tests that does best on held-back labels, with its precision and number of covered rows there."""
    best = (rule, 0.0, 0)
    worth = -2.0
    for k in range(1, len(rule.tests) + 1):
        short = Rule(rule.tests[:k])
        held = short.covers(x, len(bad))
        p, n = int(bad[held].sum()), int((~bad[held]).sum())
        if p + n and (p - 3 * n) / (p + 3 * n) >= worth:
            worth, best = (p - 3 * n) / (p + 3 * n), (short, p / (p + n), p + n)
    return best


def centred(rule: Rule, x: dict[str, np.ndarray]) -> Rule:
    """Moves each threshold halfway to the next value on its other side, among the rows that the other tests leave."""
    n = len(next(iter(x.values())))
    tests = list(rule.tests)
    for k, (f, above, t) in enumerate(tests):
        v = x[f][Rule(tuple(tests[:k] + tests[k + 1 :])).covers(x, n)]
        low, high = v[v <= t], v[v > t]
        if len(low) and len(high):
            tests[k] = (f, above, float(low.max() + high.min()) / 2)
    return Rule(tuple(tests))


def learn(x: dict[str, np.ndarray], bad: np.ndarray, least_precision: float = 0.97, most_rules: int = 12, most_tests: int = 4) -> list[Rule]:
    """Sequential covering over labelled statistics; every third row is held back for pruning."""
    back = np.arange(len(bad)) % 3 == 2
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < most_rules and (bad & left & ~back).sum() >= 5:
        pick = lambda m: ({f: v[m] for f, v in x.items()}, bad[m])  # noqa: B023, E731
        rule = grown(*pick(left & ~back), most_tests)
        if not rule.tests:
            break
        rule, precision, n = pruned(rule, *pick(left & back))
        if precision < least_precision or n < 5:
            break
        rule = centred(rule, pick(left)[0])
        rules.append(rule)
        left &= ~rule.covers(x, len(bad))
    return rules


def verdict(rules: list[Rule], count) -> Column:
    """The number of the first rule that rejects, from 1; 0 if none does."""
    x, out = features(count), F.lit(0)
    for k, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(rule.column(x), F.lit(k)).otherwise(out)
    return out.cast("long")


def fitted(docs: DataFrame, labels: DataFrame, most_labels: int = 12_000, **how) -> list[Rule]:
    """Learns the list from `labels` (doc_id, quality 0 or 1) on a bounded sample."""
    sample = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna().groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labels)
    known = id_and_text(docs).join(F.broadcast(sample), "doc_id")  # at most most_labels rows of two numbers
    rows = known.select("doc_id", "quality", text_counts("text").alias("c")).groupBy("doc_id", "quality").agg(F.min("c").alias("c")).select("doc_id", "quality", "c.*").orderBy("doc_id").collect()
    if not rows:
        return []
    column = {k: np.array([r[k] for r in rows], np.float64) for k in COUNTS + MORE}
    return learn(features(column.__getitem__), np.array([r["quality"] == 0 for r in rows]), **how)


def judged(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: the base counts, whether the base rule failed, whether it is kept, and the rule that rejected it."""
    out = id_and_text(docs, id_col, text_col).select("doc_id", text_counts("text").alias("c"))
    out = out.select("doc_id", *(F.col(f"c.{k}").alias(k) for k in COUNTS), base_failed(F.col("c.n_words"), F.col("c.n_repeat_words")).alias("base_failed"), verdict(rules, lambda k: F.col(f"c.{k}")).alias("rule"))
    return out.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")


def accepted(docs: DataFrame, labels: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of docs that neither the base rule nor the learned list rejects, with their columns as they are."""
    rules = fitted(docs, labels, **how)
    c = "_quality_counts_"
    kept = docs.withColumn(c, text_counts(text_col))
    return kept.filter(~base_failed(F.col(f"{c}.n_words"), F.col(f"{c}.n_repeat_words")) & (verdict(rules, lambda k: F.col(f"{c}.{k}")) == 0)).drop(c)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return judged(docs, fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
