"""Removal of word passages that stand earlier, by anchors at the places of a difference cover.

A difference cover of a period holds, for any two numbers, places at the same distance behind both. So two equal windows of
`length` words have, wherever they begin, a gram of length - period + 1 words at one distance that stands at a cover place in both
(places are word numbers of the document, modulo the period), and only the grams at cover places are hashed and compared:

1. Texts are packed into blocks of word codes with their words, a written table bucketed by block. A text of over `PART_WORDS`
   words becomes several entries that overlap. A document whose whole word sequence (by SHA-256) an earlier one has is settled at
   once: all of it goes, and the earlier one speaks for it. Each block asks, once for each distinct anchor, whether it stands
   anywhere else; answers come back as bitmaps. Anchors are dealt out by ranges of their hash, so a gram that a third of all
   documents hold is one question for each block.
2. A shared anchor is extended to all windows around it. Each block sends its distinct windows (96 bits of a hash of their words)
   with the first place they have in it; equal ones meet in a range, and all but the first place of all are to go.
3. The verdicts go back to the blocks, which remove each word of a window that stands earlier.

Earlier means a smaller doc_id, or the same doc_id and a smaller first word; so rows of one id are one document that has several
texts, and repeated rows, whose places are the same, don't take away from each other. Windows are judged on the input. Null and
empty texts have no words. Documents with a null id lose nothing and take nothing away. Extra columns don't matter. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, id_and_text, mixed, spread
from .periodic_runs import coded

#: Difference covers by their period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
BLOCK_BYTES, PART_WORDS, RANGE_WORDS, MOST_SLICES = 8 << 20, 1 << 20, 4 << 20, 16_384
ENTRY = "row long, part int, parts int, doc_id long, base long, skip long, own long, size long, digest binary"


def cover(length: int) -> tuple[int, tuple[int, ...]]:
    """(period, places) for windows of so many words: the largest period up to two thirds of them."""
    period = max(p for p in COVERS if p == 1 or 3 * p <= 2 * length)
    return period, COVERS[period]


def factors(n: int, seed: int) -> np.ndarray:
    """Odd numbers that weigh the words of a gram by their places."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2 * seed + 1)) | np.uint64(1)


def grams(words: np.ndarray, at: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of the n words from each place."""
    out = np.zeros(len(at), np.uint64)
    for k, f in enumerate(factors(n, seed)):
        out += words[at + k] * f
    return mixed(out)


class Block:
    """Entries of one block, those with the smallest ids first. Copies, and documents without an id, have no windows."""

    def __init__(self, row: dict, length: int):
        self.length = length
        entries, first = row["entries"], {x["digest"]: x["first"] for x in row["copies"] or []}
        self.words = row["words"].split(b" ")
        codes, ends = np.frombuffer(row["codes"], "<u4"), np.cumsum([e["size"] for e in entries])
        self.copy = [e["doc_id"] is not None and e["digest"] is not None and e["doc_id"] > first.get(e["digest"], e["doc_id"]) for e in entries]
        order = sorted(range(len(entries)), key=lambda k: (entries[k]["doc_id"] is None, entries[k]["doc_id"] or 0, entries[k]["base"]))
        self.entries, self.copy = [entries[k] for k in order], [self.copy[k] for k in order]
        self.codes = np.concatenate([codes[ends[k] - entries[k]["size"] : ends[k]] for k in order])
        get = lambda c: np.array([e[c] or 0 for e in self.entries], np.int64)
        self.ids, self.base, self.size = get("doc_id"), get("base"), get("size")
        self.start = np.cumsum(self.size) - self.size
        mute = np.array([c or e["doc_id"] is None for c, e in zip(self.copy, self.entries, strict=True)])
        self.windows = np.where(mute, 0, np.maximum(self.size - length + 1, 0))
        digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.words)), "<u8").reshape(-1, 2)
        self.low, self.high = (np.ascontiguousarray(digests[:, k])[self.codes] for k in (0, 1))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, entry, hash) of the anchors."""
        period, places = cover(self.length)
        gram = self.length - period + 1
        every = []
        for p in places:
            lead = (p - self.base) % period
            n = np.where(self.windows > 0, np.maximum(-(-(self.size - gram + 1 - lead) // period), 0), 0)
            owner = np.repeat(np.arange(len(n)), n)
            every.append((self.start[owner] + lead[owner] + spread(np.zeros(len(n), np.int64), n) * period, owner))
        at, owner = (np.concatenate(x) for x in zip(*every, strict=True))
        return at, owner, grams(self.low, at, gram, 0)

    def questions(self, ranges: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(range, sorted 32-bit hashes, whether each stands twice in the block) of the distinct anchors."""
        self.at, self.owner, h = self.anchors()
        key = (h >> np.uint64(32)) % np.uint64(ranges) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)
        kinds, self.question, times = np.unique(key, return_inverse=True, return_counts=True)
        part = (kinds >> np.uint64(32)).astype(np.int64)
        return [(int(part[a]), (kinds[a:z] & np.uint64(0xFFFFFFFF)).astype("<u4"), times[a:z] > 1) for a, z in stretches(part)]

    def extend(self, answers: dict[int, bytes], ranges: int) -> None:
        """Finds the distinct windows around shared anchors: the class of each, and per class hash, first place and range."""
        shared = [np.unpackbits(np.frombuffer(answers[b], np.uint8), count=len(x)).astype(bool) for b, x, _ in self.questions(ranges)]
        hit = np.concatenate([*shared, np.zeros(0, bool)])[self.question]
        at, owner = self.at[hit], self.owner[hit]
        gram = self.length - cover(self.length)[0] + 1
        change = np.zeros(len(self.codes) + 1, np.int32)
        np.add.at(change, np.maximum(at - self.length + gram, self.start[owner]), 1)
        np.subtract.at(change, np.minimum(at, self.start[owner] + self.windows[owner] - 1) + 1, 1)
        self.window = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        entry = np.searchsorted(self.start, self.window, "right") - 1
        doc, place = self.ids[entry], self.window - self.start[entry] + self.base[entry]
        h, more = grams(self.low, self.window, self.length, 1), grams(self.high, self.window, self.length, 2) >> np.uint64(32)
        order = np.lexsort((place, doc, more, h))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(h[order]) != 0) | (np.diff(more[order]) != 0)
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        lead = order[new]
        self.later = (doc != doc[lead][kind]) | (place != place[lead][kind])
        part = ((h[lead] >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64)
        by = np.lexsort((place[lead], doc[lead], part))
        back = np.empty(len(by), np.int64)
        back[by] = np.arange(len(by))
        self.kind, lead, self.part = back[kind], lead[by], part[by]
        self.h, self.more, self.doc, self.place = h[lead], more[lead].astype("<u4"), doc[lead], place[lead]

    def offers(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(range, hashes, 32 bits more, doc_ids, places) of the distinct windows."""
        for a, z in stretches(self.part):
            yield int(self.part[a]), self.h[a:z], self.more[a:z], self.doc[a:z], self.place[a:z]

    def removed(self, verdicts: dict[int, bytes]) -> np.ndarray:
        """Whether each word goes."""
        bits = [np.unpackbits(np.frombuffer(verdicts[b], np.uint8), count=len(x)).astype(bool) for b, x, *_ in self.offers()]
        gone = self.window[self.later | np.concatenate([*bits, np.zeros(0, bool)])[self.kind]]
        change = np.zeros(len(self.codes) + 1, np.int32)
        np.add.at(change, gone, 1)
        np.subtract.at(change, gone + self.length, 1)
        return np.cumsum(change[:-1]) > 0


def stretches(part: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of each run of equal numbers."""
    cut = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    return list(zip(cut, [*cut[1:], len(part)], strict=True)) if cut else []


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def several(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(schema)], [c for c, _ in schema])


def repeated_passages(docs: DataFrame, length: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for each row of docs; kept are the words that stay, joined by one space."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    entry_type = pa.list_(pa.struct([(c, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t]) for c, t in (x.split() for x in ENTRY.split(", "))]))
    block_type = [("block", pa.int64()), ("n_words", pa.int64()), ("entries", entry_type), ("words", pa.binary()), ("codes", pa.binary())]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, row = TaskContext.get().partitionId(), 0, 0

        def made(entries: list[dict], pieces: list[np.ndarray], distinct: list[bytes]) -> pa.RecordBatch:
            nonlocal block
            used, codes = np.unique(np.concatenate([*pieces, np.zeros(0, np.int64)]), return_inverse=True)
            block += 1
            return several(block_type, [(part << 32 | block - 1, sum(e["own"] for e in entries), entries, b" ".join([distinct[k] for k in used.tolist()]), codes.astype("<u4").tobytes())])

        def rows(ids: list, texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
            nonlocal row
            distinct, codes = coded(pa.concat_arrays(texts))
            entries, pieces = [], []
            for i, c in zip(ids, codes, strict=True):
                row += 1
                n, parts = len(c), max(-(-len(c) // PART_WORDS), 1)
                digest = hashlib.sha256(b" ".join([distinct[k] for k in c.tolist()])).digest() if i is not None and n >= length else None
                for p in range(parts):
                    a, z = p * PART_WORDS, min((p + 1) * PART_WORDS, n)
                    base = max(a - length + 1, 0)
                    own = c[base : min(z + length - 1, n)]
                    entry = {"row": part << 40 | row, "part": p, "parts": parts, "doc_id": i, "base": base, "skip": a - base, "own": z - a, "size": len(own), "digest": digest}
                    if parts > 1:
                        yield made([entry], [own], distinct)
                    else:
                        entries.append(entry)
                        pieces.append(own)
            if entries:
                yield made(entries, pieces, distinct)

        ids, texts, size = [], [], 0
        for batch in batches:
            for base in range(0, batch.num_rows, 200):
                some = batch.slice(base, 200)
                ids += some.column(0).to_pylist()
                texts.append(some.column(1))
                size += some.column(1).nbytes
                if size >= BLOCK_BYTES:
                    yield from rows(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield from rows(ids, texts)

    asked_type = [("block", pa.int64()), ("range", pa.int64()), ("hashes", pa.binary()), ("twice", pa.binary())]
    offer_type = [("block", pa.int64()), ("range", pa.int64()), *((c, pa.binary()) for c in ("hashes", "more", "docs", "places"))]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            yield several(asked_type, [(row["block"], b, h.tobytes(), np.packbits(t).tobytes()) for b, h, t in Block(row, length).questions(ranges)])

    def bits_back(table: pa.Table, flags: np.ndarray, sizes: list[int]) -> pa.Table:
        return pa.table({"block": table["block"], "range": table["range"], "bits": pa.array([np.packbits(x).tobytes() for x in np.split(flags, np.cumsum(sizes)[:-1])], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, "<u4") for x in table["hashes"].to_pylist()]
        twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)) for x, h in zip(table["twice"].to_pylist(), hashes, strict=True)]
        kinds, which = np.unique(np.concatenate(hashes), return_inverse=True)
        shared = (np.bincount(which) > 1) | (np.bincount(which, np.concatenate(twice)) > 0)
        return bits_back(table, shared[which], [len(h) for h in hashes])

    def extended(row: dict) -> Block:
        block = Block(row, length)
        block.extend({x["range"]: x["bits"] for x in row["answers"] or []}, ranges)
        return block

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            yield several(offer_type, [(row["block"], b, *(x.tobytes() for x in rest)) for b, *rest in extended(row).offers()])

    def settle(table: pa.Table) -> pa.Table:
        parts = {c: [np.frombuffer(x, t) for x in table[c].to_pylist()] for c, t in (("hashes", "<u8"), ("more", "<u4"), ("docs", "<i8"), ("places", "<i8"))}
        h, more, doc, place = (np.concatenate(x) for x in parts.values())
        order = np.lexsort((place, doc, more, h))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(h[order]) != 0) | (np.diff(more[order]) != 0)
        lead = order[new][np.cumsum(new) - 1]
        later = np.empty(len(order), bool)
        later[order] = (doc[order] != doc[lead]) | (place[order] != place[lead])
        return bits_back(table, later, [len(x) for x in parts["hashes"]])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = extended(row)
            gone = block.removed({x["range"]: x["bits"] for x in row["verdicts"] or []})
            out = []
            for e, copy, a in zip(block.entries, block.copy, block.start.tolist(), strict=True):
                own = slice(a + e["skip"], a + e["skip"] + e["own"])
                stay = block.codes[own][~gone[own]] if not copy else block.codes[:0]
                out.append((e["row"], e["part"], e["parts"], e["doc_id"], e["own"], e["own"] - len(stay), b" ".join([block.words[k] for k in stay.tolist()]).decode()))
            yield several([("row", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())], out)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = id_and_text(docs, id_col, text_col).mapInArrow(pack, f"block long, n_words long, entries array<struct<{ENTRY.replace(' ', ':').replace(',:', ',')}>>, words binary, codes binary")
    blocks = scratch.write(packed, bucket="block", buckets=min(partitions, MOST_SLICES))
    ranges = max(partitions, (blocks.agg(F.sum("n_words")).first()[0] or 0) // RANGE_WORDS)

    per_block = blocks.select("block", F.explode("entries").alias("e")).filter("e.digest is not null").groupBy("block", F.col("e.digest").alias("digest")).agg(F.min("e.doc_id").alias("least"), F.max("e.doc_id").alias("most"))
    firsts = per_block.groupBy("digest").agg(F.min("least").alias("first"), F.max("most").alias("most")).filter("first < most").drop("most")
    copies = per_block.join(firsts.hint("merge"), "digest").groupBy("block").agg(F.collect_list(F.struct("digest", "first")).alias("copies"))  # at most one of each entry of the block
    known = blocks.join(scratch.write(copies).hint("merge"), "block", "left")

    asked = known.mapInArrow(ask, "block long, range long, hashes binary, twice binary")
    answers = scratch.write(asked.groupBy("range").applyInArrow(answer, "block long, range long, bits binary"))
    by_block = answers.groupBy("block").agg(F.collect_list(F.struct("range", "bits")).alias("answers"))  # one of each range
    known = known.join(by_block.hint("merge"), "block", "left")
    offered = known.mapInArrow(offer, "block long, range long, hashes binary, more binary, docs binary, places binary")
    verdicts = scratch.write(offered.groupBy("range").applyInArrow(settle, "block long, range long, bits binary"))
    by_block = verdicts.groupBy("block").agg(F.collect_list(F.struct("range", "bits")).alias("verdicts"))
    judged = known.join(by_block.hint("merge"), "block", "left")
    rows = "row long, part int, parts int, doc_id long, n_words long, n_removed long, kept string"
    # a block has either whole texts or one part of a text
    whole = judged.filter("entries[0].parts = 1").mapInArrow(remove, rows).select("doc_id", "n_words", "n_removed", "kept")
    pieces = judged.filter("entries[0].parts > 1").mapInArrow(remove, rows).groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sum("n_words").alias("n_words"), F.sum("n_removed").alias("n_removed"), F.array_sort(F.collect_list(F.struct("part", "kept"))).alias("k"))
    return whole.unionByName(pieces.select("doc_id", "n_words", "n_removed", F.array_join(F.filter(F.col("k.kept"), lambda x: x != ""), " ").alias("kept")))


def op11_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: The same rows as op11_repeated_passages.
OP11_SQL = r"""WITH w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
 s AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM w, LATERAL (SELECT unnest(range(1, len(w) - 18)) AS i) WHERE doc_id IS NOT NULL),
 f AS (SELECT h, min({'d': doc_id, 'i': i}) AS f FROM s GROUP BY h HAVING count(*) > 1),
 g AS (SELECT r, list(i) AS i FROM s JOIN f USING (h) WHERE f < {'d': doc_id, 'i': i} GROUP BY r),
 c AS (SELECT r, list_distinct(flatten(list_transform(i, lambda x: range(x, x + 20)))) AS c FROM g),
 k AS (SELECT doc_id, len(w) AS n_words, coalesce(len(c), 0) AS n_removed, CASE WHEN c IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(c, i)) END AS k FROM w LEFT JOIN c USING (r))
 SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM k"""
