"""Periodic runs of words: maximal stretches that repeat a period at least twice.

A stretch with period q is an interval of places whose word stands again q words later; a run is such an interval that can't be
extended. Periods are taken by octaves, 2**k to 2**(k+1) - 1. An octave has boundaries as many words apart as its shortest run
must agree, so that each run holds one:

1. The text is cut into overlapping tiles, one around each boundary. In a tile the Z-functions of its boundary, forwards and
   backwards, give for each period of the octave how far the words agree with those one period later. A gram next to the boundary
   that doesn't come again rules a period out. Tiles of short texts are views of a batch; a text of over `LONG` words is exploded
   into rows of neighbouring tiles (slabs), octave by octave, which other tasks solve.
2. Texts without a run end here. The interval fragments of all others are shuffled by text and period and stitched where they
   touch or overlap. Of several periods with one interval the least is the run's own; the others are its multiples.
3. Runs and texts meet again. Each run is checked word by word, so that no result rests on a hash.

Words are `[^\\x20\\x09-\\x0D]+`. Null and empty texts have no words and no runs. Rows are on their own: repeated ids, null ids and
repeated rows each give their row. Extra columns don't matter. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, documents, id_and_text, mixed, powers

LONG, SLAB, ROWS, GRAM = 1 << 16, 1 << 15, 1000, 8
RUNS = "array<struct<start:long,length:long,period:long>>"


def spacing(k: int, least: int) -> int:
    """Words between the boundaries of an octave: in how many places the shortest run of its periods agrees with itself."""
    low, high = 1 << k, (2 << k) - 1
    return max(least, 2 * (q := min(max(low, least // 2), high))) - q


def hashed(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash, and the inverse powers of its base."""
    p, inverse = powers(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(1)) * p[: len(codes)], out=total[1:])
    return total, inverse


def united(q: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each period with those joined that touch or overlap."""
    if not len(q):
        return q, x, y
    order = np.lexsort((x, q))
    q, x, y = q[order], x[order], y[order]
    wide = int(y.max()) + 2
    reach = np.maximum.accumulate(y + q * wide)
    new = np.ones(len(q), bool)
    new[1:] = (x + q * wide)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return q[first], x[first], reach[np.append(first[1:], len(q)) - 1] - q[first] * wide


def solve(total: np.ndarray, inverse: np.ndarray, n: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, first, end) of the agreeing places around each boundary of an octave, in the first n words."""
    width, step = 1 << k, spacing(k, least)
    gram = min(-(-step // 2), GRAM)
    rows = n // width + 1
    ahead, behind = np.zeros(rows * width, np.uint64), np.zeros(rows * width, np.uint64)
    if n >= gram:
        g = (total[gram : n + 1] - total[: n + 1 - gram]) * inverse[: n + 1 - gram]
        ahead[: len(g)] = g[: len(ahead)]
        behind[gram : gram + len(g)] = g[: len(behind) - gram]
    if step == width:
        a, b = ahead.reshape(rows, width), behind.reshape(rows, width)
        flagged = a[1:] == a[:-1, :1]
        flagged |= b[1:] == b[:-1, :1]
        row, extra = np.divmod(np.flatnonzero(flagged), width)
        at, q = row * width, extra + width
    else:
        some = []
        for period in range(width, min(2 * width, n)):
            m = np.arange(0, len(ahead) - period, step)
            hit = m[(ahead[m] == ahead[m + period]) | (behind[m] == behind[m + period])]
            some.append((hit, np.full(len(hit), period)))
        at, q = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*some, strict=True)) if some else (np.zeros(0, np.int64),) * 2
    inside = at + q <= n
    at, q = at[inside], q[inside]
    same = lambda i, j, m: (total[i + m] - total[i]) * inverse[i] == (total[j + m] - total[j]) * inverse[j]
    z, back = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for bit in reversed(range(step.bit_length())):
        m = 1 << bit
        ok = np.flatnonzero((z + m <= step) & (at + q + z + m <= n))
        z[ok[same(at[ok] + z[ok], at[ok] + q[ok] + z[ok], m)]] += m
        ok = np.flatnonzero((back + m <= step) & (at - back - m >= 0))
        i = at[ok] - back[ok] - m
        back[ok[same(i, i + q[ok], m)]] += m
    some = z + back > 0
    return united(q[some], (at - back)[some], (at + z)[some])


def octaves(longest: int, least: int) -> range:
    """Those whose shortest run fits."""
    return range(max(longest // 2, 1).bit_length()) if longest >= least else range(0)


def fragments(codes: list[np.ndarray], least: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(period, first, end) of the long enough intervals of each text; all texts are solved side by side, the longest first."""
    order = sorted(range(len(codes)), key=lambda k: -len(codes[k]))
    size = np.array([len(codes[k]) for k in order], np.int64)
    ends = np.cumsum(size + 1)
    parts = []
    for number, k in enumerate(order):
        parts += [codes[k], np.array([-2 - number])]  # a sign of its own stands behind each text
    found = [(np.zeros(0, np.int64),) * 3]
    if len(size) and size[0] >= least:
        total, inverse = hashed(np.concatenate(parts))
        for k in octaves(int(size[0]), least):
            m = int(np.searchsorted(-size, -max(least, 2 << k), "right"))
            if m:
                q, x, y = solve(total, inverse, int(ends[m - 1]), k, least)
                keep = y - x + q >= np.maximum(least, 2 * q)
                found.append((q[keep], x[keep], y[keep]))
    q, x, y = (np.concatenate(c) for c in zip(*found, strict=True))
    owner = np.searchsorted(ends, x, "right")
    by = np.argsort(owner, kind="stable")
    cut = np.searchsorted(owner[by], np.arange(len(order) + 1))
    begin, out = ends - size - 1, [None] * len(order)
    for number, k in enumerate(order):
        own = by[cut[number] : cut[number + 1]]
        out[k] = (q[own], x[own] - begin[number], y[own] - begin[number])
    return out


def slabs(codes: np.ndarray, least: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(first octave, octave after the last, base, codes): overlapping pieces; any agreement is seen whole or from two of them."""
    every = octaves(len(codes), least)
    low = max(1, SLAB.bit_length() - 4)
    if not every:
        return
    for first, last in [(0, min(low, len(every))), *((k, k + 1) for k in range(low, len(every)))]:
        reach = (1 << last) + 2 * max(spacing(k, least) for k in range(first, last))
        size = max(SLAB, 4 * reach)
        for base in range(0, len(codes), size - reach):
            yield first, last, base, codes[base : base + size]
            if base + size >= len(codes):
                break


def slab_fragments(codes: np.ndarray, first: int, last: int, base: int, whole: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of a slab in the text's numbers: those that are long enough, or touch an end where the text goes on."""
    total, inverse = hashed(codes)
    found = []
    for k in range(first, last):
        q, x, y = solve(total, inverse, len(codes), k, least)
        keep = (y - x + q >= np.maximum(least, 2 * q)) | ((x == 0) & (base > 0)) | ((y + q == len(codes)) & (base + len(codes) < whole))
        found.append((q[keep], x[keep] + base, y[keep] + base))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def exact_runs(codes: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Runs by comparing all periods: for a text in which two grams have one hash."""
    out: dict[tuple[int, int], int] = {}
    for q in range(1, len(codes) // 2 + 1):
        step = np.diff(np.concatenate([[0], codes[:-q] == codes[q:], [0]]).astype(np.int8))
        for x, y in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True):
            if y - x + q >= max(least, 2 * q):
                out.setdefault((x, y - x + q), q)
    return [(s, n, q) for (s, n), q in out.items()]


def holds(codes: np.ndarray, start: int, length: int, q: int) -> bool:
    """Whether a stretch is a run of the period: it agrees with itself, and no neighbour extends it."""
    end = start + length
    if not np.array_equal(codes[start : end - q], codes[start + q : end]):
        return False
    return not (start and codes[start - 1] == codes[start - 1 + q]) and not (end < len(codes) and codes[end] == codes[end - q])


def coded(texts: pa.Array) -> tuple[list[bytes], list[np.ndarray]]:
    """(distinct words, the codes of each text's words)."""
    cut = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    words = cut.flatten().dictionary_encode()
    distinct, codes = words.dictionary.cast(pa.binary()).to_pylist(), words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))
    every = np.split(codes, ends[:-1])
    return distinct, [c[:0] if len(c) == 1 and not distinct[c[0]] else c for c in every]


def periodic_runs(docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, kept) for each row of docs: runs of at least `least` words and two periods, by start and then period, and
    the words, joined by one space, without what repeats a run's first period."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    source = id_and_text(docs, id_col, text_col)

    def tiled(only_open: bool):
        """Rows of texts that may have runs, or of all others."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 33
            for batch in batches:
                for base in range(0, batch.num_rows, ROWS):
                    part = batch.slice(base, ROWS)
                    distinct, codes = coded(part.column(1))
                    found = fragments([c if len(c) <= LONG else c[:0] for c in codes], least)
                    which = [k for k, c in enumerate(codes) if (len(c) > LONG or len(found[k][0]) > 0) == only_open]
                    texts = pa.array([b" ".join([distinct[w] for w in codes[k].tolist()]) for k in which], pa.binary())
                    ids = part.column(0).take(pa.array(which, pa.int64()))
                    sizes = pa.array([len(codes[k]) for k in which], pa.int64())
                    if only_open:
                        lists = [pa.array([found[k][j] for k in which], pa.list_(pa.int64())) for j in range(3)]
                        yield pa.RecordBatch.from_arrays([pa.array([number + k for k in which], pa.int64()), ids, sizes, texts, *lists], ["row", "doc_id", "n_words", "words", "periods", "firsts", "ends"])
                    else:
                        yield pa.RecordBatch.from_arrays([ids, sizes, texts.cast(pa.string())], ["doc_id", "n_words", "kept"])
                    number += part.num_rows

        return run

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                codes = pa.array(words.as_py().split(b" "), pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                for first, last, base, own in slabs(codes, least):
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((row, pa.int64()), (first, pa.int32()), (last, pa.int32()), (base, pa.int64()), (len(codes), pa.int64()), (own.astype("<i4").tobytes(), pa.binary()))], ["row", "first", "last", "base", "whole", "codes"])

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row, first, last, base, whole, codes = (c[k].as_py() for c in batch.columns)
                q, x, y = slab_fragments(np.frombuffer(codes, "<i4").astype(np.int64), first, last, base, whole, least)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), row)), pa.array(q), pa.array(x), pa.array(y)], ["row", "period", "x", "y"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, n, words, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words.split(b" ")
                number: dict[bytes, int] = {}
                codes = np.array([number.setdefault(w, len(number)) for w in words])
                own = [(r["start"], r["length"], r["period"]) for r in runs or []]
                if not all(holds(codes, *r) for r in own):
                    own = exact_runs(codes, least)
                own.sort(key=lambda r: (r[0], r[2]))
                gone = np.zeros(n + 1, np.int64)
                for start, length, q in own:
                    gone[start + q] += 1
                    gone[start + length] -= 1
                stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
                rows.append((i, n, [{"start": s, "length": m, "period": q} for s, m, q in own], b" ".join([words[k] for k in stay]).decode()))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["doc_id", "n_words", "runs", "kept"])

    settled = source.mapInArrow(tiled(False), "doc_id long, n_words long, kept string")
    opened = scratch.write(source.mapInArrow(tiled(True), "row long, doc_id long, n_words long, words binary, periods array<long>, firsts array<long>, ends array<long>"))
    short = opened.select("row", F.explode(F.arrays_zip("periods", "firsts", "ends")).alias("f")).select("row", F.col("f.periods").alias("period"), F.col("f.firsts").alias("x"), F.col("f.ends").alias("y"))
    dealt = opened.filter(F.col("n_words") > LONG).select("row", "words").mapInArrow(explode, "row long, first int, last int, base long, whole long, codes binary").repartition("row", "first", "base")
    pieces = short.unionByName(dealt.mapInArrow(solved, "row long, period long, x long, y long"))

    by = W.partitionBy("row", "period").orderBy("x", "y")
    reach = F.max("y").over(by.rowsBetween(W.unboundedPreceding, -1))
    islands = pieces.withColumn("new", F.when(F.col("x") <= reach, 0).otherwise(1)).withColumn("island", F.sum("new").over(by.rowsBetween(W.unboundedPreceding, 0)))
    stretches = islands.groupBy("row", "period", "island").agg(F.min("x").alias("start"), (F.max("y") - F.min("x") + F.col("period")).alias("length"))
    runs = stretches.filter(F.col("length") >= F.greatest(F.lit(least), 2 * F.col("period"))).groupBy("row", "start", "length").agg(F.min("period").alias("period"))
    listed = runs.groupBy("row").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))  # of one text
    met = opened.select("row", "doc_id", "n_words", "words").join(listed.hint("merge"), "row", "left").select("doc_id", "n_words", "words", "runs")
    return settled.select("doc_id", "n_words", F.array().cast(RUNS).alias("runs"), "kept").unionByName(met.mapInArrow(finish, f"doc_id long, n_words long, runs {RUNS}, kept string"))


def repeating(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by the checksum of its id, goes on repeating a part of itself from some word on. A null id has none."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    some = docs.filter((h % 10 == 0) & F.exists(words, lambda w: F.lit(True))).select("doc_id", words.alias("w"), F.floor(h / 10).alias("g"))
    # a generator stands between the words and their uses, so that they are cut once
    some = some.select("doc_id", "g", F.explode(F.array("w")).alias("w"))
    n = F.size("w")
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    turns = F.flatten(F.array_repeat(F.slice("w", a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = some.select("doc_id", F.array_join(F.concat(F.slice("w", F.lit(1), a), F.slice(turns, F.lit(1), n - a)), " ").alias("text"))
    plain = docs.filter(F.coalesce(h % 10 != 0, F.lit(True)) | ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return plain.select("doc_id", "text").unionByName(planted)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(repeating(documents(spark, sf_dir)))
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))), 1)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n")))), "")
    none = F.size("runs") == 0
    pick = lambda c: F.when(~none, c)
    rows = rows.withColumn("best", F.when(~none, best))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        pick(F.col("best.s")).alias("start"),
        pick(-F.col("best.l")).alias("length"),
        pick(F.col("best.p")).alias("period"),
        pick(F.floor(-1000 * F.col("best.l") / F.col("best.p"))).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"),
    )
