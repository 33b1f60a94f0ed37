"""Benchmark contamination by random-walk embedding.

Words are the symbols. From every word of a document, and of every benchmark item, a CGK random walk reads the words ahead: it
puts out the word that it stands on, and one random bit of that word and step says whether it goes on or stays. Two walks
over texts a few edits apart fall into step again, so edit distance becomes Hamming distance between the outputs. Repeated bit
sampling finds the close ones: each repetition has a walk of its own and joins a few sampled outputs to one key.
Item windows are indexed from each of their words, so that an item is met behind and between its edits, not just at its start.
A walk needs words to read, so items of up to `SHORT` words are found in an exact way: cut into one piece more than they may have
edits, they keep one piece whole in every stretch that is close enough. Pieces are keyed by their words; nothing is missed there.
Every key that a document shares with an item gives the place where the item would stand; there the exact word edit distance
to the best stretch of the text decides.

A document is contaminated by an item if that distance is at most `percent` of the item's words. Words are runs of letters, digits
and non-ASCII characters with A-Z lower-cased. Items without words match nothing; null and empty texts are clean.
Repeated rows give repeated results, a null id stays null; without items everything is clean. Of several places with the least
distance the first counts. Texts are read whole, however long. A column of the caller with the name of the new one is replaced.
The index goes to all tasks, so it is built over blocks of items of a bounded size. Texts pass through one block after another; what
a block found is written before the next one is sent, so that one index at a time is held, however large the benchmark.
"""

from __future__ import annotations

from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, Scratch, documents, give_back, mixed, span_hashes, windows

INSIDE = np.zeros(256, bool)
INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
STEPS, SAMPLED, REPEATS = 16, 6, 6
SHORT = 32
BLOCK_CHARACTERS, BUFFER_WORDS = 8_000_000, 30_000
SLOT = np.uint64(42)


def words(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    edge = np.zeros(len(data) + 2, np.int8)
    edge[1:-1] = INSIDE[data]
    step = np.diff(edge)
    return span_hashes(LOWER[data], np.flatnonzero(step == 1), np.flatnonzero(step == -1))


def samples() -> list[list[int]]:
    """The sampled steps of each repetition: one of each equal part of the walk, the first step among them, so that they rarely fall on one word."""
    rng = np.random.default_rng(3)
    part = STEPS // SAMPLED
    return [[0, *(k * part + int(rng.integers(0, part)) + 1 for k in range(1, SAMPLED))] for _ in range(REPEATS)]


def keys(symbols: np.ndarray) -> np.ndarray:
    """For each repetition a key of the walk from each symbol; past the end the walk reads an end symbol."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(STEPS + 1, np.uint64)])
    out = np.empty((REPEATS, n), np.uint64)
    for r, steps in enumerate(samples()):
        bits = mixed(padded + np.uint64((r + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        at, key = np.arange(n), np.full(n, r + 1, np.uint64)
        for j in range(steps[-1] + 1):
            if j in steps:
                key = key * np.uint64(0xD1342543DE82EF95) + padded[at]
            at = at + ((bits[at] >> np.uint64(j)) & np.uint64(1)).astype(np.int64)
        out[r] = mixed(key)
    return out


def pieces(n: int, most: int) -> tuple[int, list[int]]:
    """Length of the pieces of an item of n words, and where they begin: of most + 1 such pieces, most edits leave one whole."""
    length = max(1, n // (most + 1))
    return length, [k * length for k in range(min(most + 1, n))]


def runs(symbols: np.ndarray, length: int) -> np.ndarray:
    """A key of the words from each symbol on; past the end stand end symbols."""
    return windows(np.concatenate([symbols, np.zeros(length - 1, np.uint64)]), length)


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The least edit distance of the item to any stretch of the text, and where the first such stretch ends; bit-parallel."""
    n, where = len(item), {}
    for k, w in enumerate(item.tolist()):
        where[w] = where.get(w, 0) | 1 << k
    ones, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = ones, 0, n
    best, end = n, 0
    for k, w in enumerate(text.tolist(), 1):
        eq = where.get(w, 0)
        x = eq | minus
        d = (((x & plus) + plus) ^ plus) | x
        up, down = (minus | ~(d | plus)) & ones, plus & d
        score += 1 if up & top else -1 if down & top else 0
        up, down = up << 1 & ones, down << 1 & ones
        plus, minus = (down | ~(d | up)) & ones, up & d
        if score < best:
            best, end = score, k
    return best, end


class Index:
    """Keys of all windows, and of the pieces of short items, of a block of items."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        self.items = [(i, words(t or "")) for i, t in items]
        self.most = [percent * len(w) // 100 for _, w in self.items]
        long = [k for k, (_, w) in enumerate(self.items) if len(w) > SHORT]
        parts = [(keys(w).reshape(-1), np.tile(np.arange(len(w)), REPEATS), np.full(len(w) * REPEATS, k)) for k, w in ((k, self.items[k][1]) for k in long)]
        lengths = set()
        for k, (_, w) in enumerate(self.items):
            if 0 < len(w) <= SHORT:
                length, begins = pieces(len(w), self.most[k])
                lengths.add(length)
                parts.append((runs(w, length)[begins], np.array(begins), np.full(len(begins), k)))
        self.walks, self.lengths = bool(long), sorted(lengths)
        every, offset, item = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3))
        order = np.argsort(every, kind="stable")
        self.sets = [frozenset(w.tolist()) for _, w in self.items]
        self.keys, self.offset, self.item = every[order].astype(np.uint64), offset[order], item[order]
        self.known = np.zeros(1 << 22, bool)  # a look before the search
        self.known[(self.keys >> SLOT).astype(np.int64)] = True

    def find(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Of each text (item_id, distance, word after the stretch) of each item that it holds, at its best place."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if not len(self.keys):
            return out
        symbols, low, size = [], 0, 0
        for n, t in enumerate(texts, 1):
            symbols.append(words(t) if t else np.zeros(0, np.uint64))
            size += len(symbols[-1])
            if size > BUFFER_WORDS or n == len(texts):
                for k, hits in self.places(symbols).items():
                    out[low + k] = self.checked(symbols[k], hits)
                symbols, low, size = [], n, 0
        return out

    def places(self, symbols: list[np.ndarray]) -> dict[int, list[tuple[int, int]]]:
        """Of each text with a shared key the items and the words where they would begin. The walks of all texts run side by side."""
        gap = np.zeros(STEPS + 1, np.uint64)
        begin = np.cumsum([0, *(len(s) + len(gap) for s in symbols)])[:-1]
        joined = np.concatenate([x for s in symbols for x in (s, gap)])
        n = len(joined)
        flat = np.concatenate([*(keys(joined) if self.walks else ()), *(runs(joined, x) for x in self.lengths)])
        slot = (flat >> SLOT).astype(np.int64)
        hit = np.flatnonzero(self.known[slot])
        low = np.searchsorted(self.keys, flat[hit])
        same = self.keys[np.minimum(low, len(self.keys) - 1)] == flat[hit]
        hit, low = hit[same], low[same]
        times = np.searchsorted(self.keys, flat[hit], "right") - low
        which = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        at = np.repeat(hit % n, times)
        text = np.searchsorted(begin, at, "right") - 1
        inside = at - begin[text]
        real = inside < np.array([len(s) for s in symbols])[text]
        found = np.unique(np.stack([text, self.item[which], inside - self.offset[which]], 1)[real], axis=0)
        out: dict[int, list[tuple[int, int]]] = {}
        for t, k, place in found.tolist():
            out.setdefault(t, []).append((k, place))
        return out

    def checked(self, symbols: np.ndarray, places: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """The items whose exact distance at one of the places is small enough."""
        out: dict[int, tuple[int, int, int]] = {}
        text = symbols.tolist()
        for k, own in groupby(places, itemgetter(0)):
            i, item = self.items[k]
            most = self.most[k]
            parts: list[list[int]] = []
            for _, at in own:
                first, end = max(0, at - most - 1), at + len(item) + most + 1
                if parts and first < parts[-1][1]:
                    parts[-1][1] = end
                else:
                    parts.append([first, end])
            for first, end in parts:
                if i in out and out[i][1] == 0:
                    break
                part = text[first:end]
                if len(self.sets[k].intersection(part)) < len(self.sets[k]) - most:
                    continue
                distance, last = best_stretch(item, np.array(part, np.uint64))
                if distance <= most and (i not in out or distance < out[i][1]):
                    out[i] = (i, distance, first + last)
        return [x for _, x in sorted(out.items())]


def searcher(index):
    """The function of one broadcast index over a batch of texts."""
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int64()), ("last", pa.int64())]))

    def search(texts: pa.Array) -> pa.Array:
        found = index.value.find([t or "" for t in texts.to_pylist()])
        give_back()
        return pa.array([[dict(zip(("item_id", "distance", "last"), x, strict=True)) for x in own] for own in found], kind)

    return search


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", hits_col: str = "hits", percent: int = 20, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The same rows with one more column: an array of (item_id, distance, last) for each item that the text holds."""
    spark = docs.sparkSession
    schema = "array<struct<item_id:long,distance:long,last:long>>"
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).dropna().dropDuplicates()
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = int(size) // BLOCK_CHARACTERS + 1
    out, scratch = docs.withColumn(hits_col, F.expr(f"cast(array() as {schema})")), Scratch(spark) if blocks > 1 else None
    for b in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).orderBy("i", "t").collect()  # about BLOCK_CHARACTERS
        index = spark.sparkContext.broadcast(Index([(r.i, r.t) for r in block], percent))
        found = out.withColumn(hits_col, F.concat(hits_col, F.arrow_udf(searcher(index), schema)(text_col)))
        if scratch:
            before, found = out, scratch.write(found)
            index.destroy()
            scratch.drop(before)
        out = found
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of docs that hold no benchmark item, with their columns as they are."""
    hits = "_benchmark_hits_"
    return contaminated(docs, benchmark, text_col, hits, **how).filter(F.size(hits) == 0).drop(hits)


def op3_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document the items that it holds."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.size("hits").cast("long").alias("n_items"), F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h["item_id"], h["distance"], h["last"])), ",").alias("items"), (F.size("hits") > 0).alias("contaminated"))
