"""Removal of byte strings that an earlier document has, by sorted suffixes.

Every window of `length` bytes picks an anchor: the 24-byte gram in it with the least hash. Equal windows pick equal anchors,
so only windows whose anchor occurs in two documents can repeat, and a few percent of the positions stand for all.

1. Texts are packed into blocks, a written table bucketed by block. A document whose whole text (by SHA-256) an earlier one has
   is settled at once: all of it goes, and the earlier one speaks for it. Each block asks, once for each distinct anchor, whether
   another document has it too; answers come back as bitmaps. Anchors are dealt out by ranges of their hash, so a gram that a
   third of all documents hold is one question for each block.
2. For shared anchors each block sends its distinct contexts: the bytes of all windows that picked this anchor, with the
   smallest doc_id that has them. An anchor with more than `HOT_RUNS` runs is dealt out by its windows instead, so that no
   gram lands in one task. Contexts are sorted deep-shallow, from the gram on; where an anchor has one context only, its windows
   are settled. All other windows are suffixes of contexts and are sorted deep-shallow in the same way, down to the window length.
   Equal suffixes give the smallest doc_id of each window.
3. The answers go back to the blocks, which remove each byte of a window that a smaller doc_id has.

Deep-shallow sorting: a multikey quicksort with 8-byte characters to a shallow depth; groups that still agree there are ordered by
blind tries, which also tell which strings are equal.

All comparisons but that of whole texts are of the bytes themselves; hashes only decide who is compared. Matches never cross
documents and are judged on the input. Null and empty texts have no bytes. Documents with a null id lose nothing and take nothing
away. Rows of one id don't take away from each other. Repeated rows give repeated results. Extra columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, id_and_text, mixed, span_hashes, spread

GRAM, SHALLOW = 24, 2
PIECE = 1 << 18
BLOCK_BYTES, RANGE_BYTES, HOT_RUNS = 8 << 20, 16 << 20, 4096
MOST_SLICES = 16_384


def loaded(data: np.ndarray, order: str = "<") -> np.ndarray:
    """The 8 bytes from each position as one integer."""
    return np.ndarray((len(data) - 7,), f"{order}u8", np.ascontiguousarray(data), strides=(1,)).astype(np.uint64)


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchor of each window."""
    out = []
    for base in range(0, len(data) - length + 1, PIECE - length + 1):
        part = data[base : base + PIECE]
        eight = loaded(part)
        gram = eight[: len(part) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15)
        for k in range(8, GRAM, 8):
            gram = mixed(gram + eight[k : len(part) - GRAM + 1 + k])
        least = (gram & ~np.uint64(PIECE - 1)) | np.arange(len(gram), dtype=np.uint64)
        wide, size = length - GRAM + 1, 1
        while size * 2 <= wide:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < wide:
            least = np.minimum(least[: len(least) - (wide - size)], least[wide - size :])
        at = (least & np.uint64(PIECE - 1)).astype(np.int64)
        out.append((at + base, gram[at]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class BlindTrie:
    """Orders strings of one length; inner nodes keep just the depth at which their strings part, leaves the members that are equal."""

    def __init__(self):
        self.root = None

    def add(self, text: bytes, member: int) -> None:
        if self.root is None:
            self.root = (text, [member])
            return
        node = self.root
        while isinstance(node[1], dict):
            depth, kids = node
            node = kids.get(text[depth]) or next(iter(kids.values()))
        other = node[0]
        apart = int.from_bytes(text) ^ int.from_bytes(other)
        if not apart:
            node[1].append(member)
            return
        common = len(text) - (apart.bit_length() + 7) // 8
        parent, node = None, self.root
        while isinstance(node[1], dict) and node[0] < common:
            parent, node = node, node[1][text[node[0]]]
        if isinstance(node[1], dict) and node[0] == common:
            node[1][text[common]] = (text, [member])
            return
        split = (common, {other[common]: node, text[common]: (text, [member])})
        if parent is None:
            self.root = split
        else:
            parent[1][text[parent[0]]] = split

    def ordered(self) -> Iterator[list[int]]:
        """Members of each string, in the order of the strings."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node[1], dict):
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                yield node[1]


def edges_of(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def multikey_quicksort(rows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts of the groups that agree in the first `depth` words). All open groups are split by a pivot of their own at once:
    what is less and what is greater stays at the word, what is equal goes on to the next one."""
    n = len(rows)
    order = np.arange(n)
    begins = np.zeros(n + 1, bool)
    begins[[0, n]] = True
    low, high, at = (np.array([x]) for x in (0, n, 0)) if n > 1 and depth else (np.zeros(0, np.int64),) * 3
    while len(low):
        size = high - low
        place = spread(low, size)
        group = np.repeat(np.arange(len(low)), size)
        own = order[place]
        word = rows[own, at[group]]
        first = np.cumsum(size) - size
        three = np.sort(np.stack([word[first], word[first + size // 2], word[first + size - 1]]), axis=0)
        pivot = three[1][group]
        less, more = word < pivot, word > pivot
        before_less = np.cumsum(less) - less
        before_more = np.cumsum(more) - more
        inside = np.arange(len(word)) - first[group]
        less_inside, more_inside = before_less - before_less[first][group], before_more - before_more[first][group]
        n_less, n_more = np.add.reduceat(less, first, dtype=np.int64), np.add.reduceat(more, first, dtype=np.int64)
        to = np.where(less, less_inside, np.where(more, (size - n_more)[group] + more_inside, n_less[group] + inside - less_inside - more_inside))
        order[low[group] + to] = own
        cut, end = low + n_less, high - n_more
        begins[cut] = begins[end] = True
        low, high, at = np.concatenate([low, cut, end]), np.concatenate([cut, end, high]), np.concatenate([at, at + 1, at])
        open_ = (high - low > 1) & (at < depth)
        low, high, at = low[open_], high[open_], at[open_]
    return order, np.flatnonzero(begins[:n])


def deep_shallow(rows: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of rows of big-endian words, number of each one's class in that order): equal rows are one class."""
    order, first = multikey_quicksort(rows, min(shallow, rows.shape[1]))
    new = np.zeros(len(order), np.int64)
    new[first] = 1
    size = np.diff(np.append(first, len(order)))
    # a group that agrees with its first row to the end is a trie of one leaf
    wide = np.flatnonzero(size > 1)
    place = spread(first[wide], size[wide])
    same = (rows[order[place], shallow:] == rows[order[np.repeat(first[wide], size[wide])], shallow:]).all(1)
    if len(wide):
        for g in wide[~np.logical_and.reduceat(same, np.cumsum(size[wide]) - size[wide])].tolist():
            a = int(first[g])
            members = order[a : a + size[g]]
            rest = rows[members, shallow:].astype(">u8").tobytes()
            deep, trie = len(rest) // len(members), BlindTrie()
            for k, m in enumerate(members.tolist()):
                trie.add(rest[k * deep : (k + 1) * deep], m)
            for own in trie.ordered():
                order[a : a + len(own)], new[a] = own, 1
                a += len(own)
    return order, np.cumsum(new) - 1


def as_rows(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """The bytes of each span as big-endian words, with zeros behind them."""
    padded = np.concatenate([data, np.zeros(most + 8, np.uint8)])
    words = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
    masks = np.array([0, *((1 << 64) - (1 << 64 - 8 * n) for n in range(1, 9))], np.uint64)
    out = np.empty((len(starts), -(-most // 8)), np.uint64)
    for k in range(out.shape[1]):
        out[:, k] = words[np.minimum(starts + 8 * k, len(words) - 1)].astype(np.uint64) & masks[np.clip(sizes - 8 * k, 0, 8)]
    return out


def settled(data: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each context (number of runs), and of all runs (their windows, the smallest doc_id that has them)."""
    starts = np.cumsum(sizes) - sizes
    whole = as_rows(data, starts, sizes, 2 * length - GRAM)
    rows = np.concatenate([as_rows(data, starts + offsets, np.full(len(sizes), GRAM), GRAM), whole, (sizes.astype(np.uint64) << np.uint64(8) | offsets.astype(np.uint64))[:, None]], 1)
    order, kind = deep_shallow(rows, GRAM // 8)
    first = edges_of(kind)
    lead = order[first]  # one context of each class
    least = np.minimum.reduceat(docs[order], first)
    same_gram = edges_of(*rows[lead, : GRAM // 8].T)
    alone = np.repeat(np.diff(np.append(same_gram, len(lead))) == 1, np.diff(np.append(same_gram, len(lead))))
    windows = sizes[lead] - length + 1
    open_ = np.flatnonzero(~alone)
    n_runs, run_windows, run_docs = np.ones(len(lead), np.int64), [windows[alone]], [least[alone]]
    run_of = [np.flatnonzero(alone)]
    if len(open_):
        owner = np.repeat(open_, windows[open_])
        begin = spread(starts[lead[open_]], windows[open_])
        by, equal = deep_shallow(as_rows(data, begin, np.full(len(begin), length), length), SHALLOW)
        found = np.empty(len(begin), np.int64)
        found[by] = np.minimum.reduceat(least[owner][by], edges_of(equal))[equal]
        edge = edges_of(owner, found)
        n_runs[open_] = np.bincount(owner[edge], minlength=len(lead))[open_]
        run_of.append(owner[edge])
        run_windows.append(np.diff(np.append(edge, len(owner))))
        run_docs.append(found[edge])
    by = np.argsort(np.concatenate(run_of), kind="stable")
    run_windows, run_docs = np.concatenate(run_windows)[by], np.concatenate(run_docs)[by]
    class_of = np.empty(len(sizes), np.int64)
    class_of[order] = kind
    own = spread((np.cumsum(n_runs) - n_runs)[class_of], n_runs[class_of])
    return n_runs[class_of], run_windows[own], run_docs[own]


class Block:
    """Documents of one packed block and the runs of windows in them. Copies, and documents without an id, have no runs."""

    def __init__(self, doc_ids: list, texts: list[str], silent: list[bool], length: int):
        self.length = length
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        speaking = sorted(range(len(parts)), key=silent.__getitem__)  # their bytes come first
        self.text = b"".join(parts[k] for k in speaking)
        self.data = np.frombuffer(self.text, np.uint8)
        size = np.array([len(parts[k]) for k in speaking])
        start = np.cumsum(size) - size
        self.size, self.start = (np.empty(len(parts), np.int64) for _ in range(2))
        self.size[speaking], self.start[speaking] = size, start
        self.ids = np.array([0 if i is None else i for i in doc_ids])
        windows = np.where(np.array(silent)[speaking], 0, np.maximum(size - length + 1, 0))
        ends, runs = np.cumsum(windows), []
        for low in range(0, int(windows.sum()), PIECE):
            high = min(low + PIECE, int(ends[-1]))
            k, z = np.searchsorted(ends, [low, high - 1], "right") + [0, 1]
            first, n = start[k:z].copy(), windows[k:z].copy()
            skip = low - (ends[k] - windows[k])
            first[0] += skip
            n[0] -= skip
            n[-1] -= ends[z - 1] - high
            window, doc = spread(first, n), np.repeat(np.array(speaking)[k:z], n)
            base = int(window[0])
            at, gram = anchors(self.data[base : int(window[-1]) + length], length)
            own = window - base
            edge = edges_of(doc, at[own])
            runs.append((at[own[edge]] + base, gram[own[edge]], doc[edge], window[edge], window[edge] + np.diff(np.append(edge, len(window))) - 1))
        none = np.zeros(0, np.int64)
        self.at, self.hash, self.doc, self.first, self.last = (np.concatenate(x) for x in zip(*runs, strict=True)) if runs else (none, none.astype(np.uint64), none, none, none)

    def questions(self, ranges: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(range, sorted 32-bit hashes, number of runs up to 127, and 128 more if two documents have it) of the distinct anchors."""
        part, short = (self.hash >> np.uint64(32)) % np.uint64(ranges), self.hash & np.uint64(0xFFFFFFFF)
        order = np.lexsort((short, part))
        b, s, d = part[order], short[order], self.ids[self.doc[order]]
        edge = edges_of(b, s)
        self.question = np.empty(len(order), np.int64)
        self.question[order] = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(order))))
        if not len(edge):
            return []
        several = np.minimum.reduceat(d, edge) != np.maximum.reduceat(d, edge)
        times = (np.minimum(np.diff(np.append(edge, len(order))), 127) | several << 7).astype(np.uint8)
        b, s = b[edge], s[edge]
        cut = edges_of(b)
        return [(int(b[x]), s[x:y].astype("<u4"), times[x:y]) for x, y in zip(cut.tolist(), [*cut[1:].tolist(), len(b)], strict=True)]

    def asked(self, answers: dict[int, tuple[bytes, bytes]], ranges: int) -> None:
        """Keeps the runs whose anchors are shared, and cuts those of hot anchors into their windows."""
        shared, hot = [], []
        for b, hashes, _ in self.questions(ranges):
            bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(hashes)).astype(bool) for x in answers[b]]
            shared.append(bits[0])
            hot.append(bits[1])
        shared, hot = (np.concatenate([*x, np.zeros(0, bool)]) for x in (shared, hot))
        keep = shared[self.question]
        hot = hot[self.question[keep]]
        at, doc, first, last, part = (x[keep] for x in (self.at, self.doc, self.first, self.last, (self.hash >> np.uint64(32)) % np.uint64(ranges)))
        times = np.where(hot, last - first + 1, 1)
        first, one = spread(first, times), np.repeat(hot, times)
        self.at, self.doc, part = (np.repeat(x, times) for x in (at, doc, part))
        self.first, self.last = first, np.where(one, first, np.repeat(last, times))
        part[one] = span_hashes(self.data, first[one], first[one] + self.length) % np.uint64(ranges)
        self.range = part.astype(np.int64)

    def contexts(self) -> dict[int, list[bytes]]:
        """Distinct contexts of each range (a byte of anchor offset, then the bytes). Run k has context number[k] of its range."""
        known: dict[bytes, int] = {}
        out: dict[int, list[bytes]] = {}
        number = []
        for b, offset, a, z in zip(self.range.tolist(), (self.at - self.first).tolist(), self.first.tolist(), (self.last + self.length).tolist(), strict=True):
            c = b"%c%b" % (offset, self.text[a:z])
            n = known.get(c)
            if n is None:
                own = out.setdefault(b, [])
                n = known[c] = len(own)
                own.append(c)
            number.append(n)
        self.number = np.array(number, np.int64)
        return out

    def least(self, contexts: dict[int, list[bytes]]) -> dict[int, np.ndarray]:
        """The smallest doc_id of each context."""
        base = dict(zip(contexts, np.cumsum([0, *map(len, contexts.values())]).tolist(), strict=False))
        out = np.full(sum(map(len, contexts.values())), np.iinfo(np.int64).max)
        at = np.array([base[b] for b in self.range.tolist()], np.int64) + self.number
        np.minimum.at(out, at, self.ids[self.doc])
        return {b: out[x : x + len(contexts[b])] for b, x in base.items()}

    def removed(self, verdicts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Whether each byte goes, by the runs of each context and the smallest doc_id of each."""
        cover = np.zeros(len(self.data) + 1, np.int32)
        if len(self.number):
            base = dict(zip(verdicts, np.cumsum([0, *(len(v[0]) for v in verdicts.values())]).tolist(), strict=False))
            n_runs, windows, docs = (np.concatenate([v[k] for v in verdicts.values()]).astype(np.int64) for k in range(3))
            context = np.array([base[b] for b in self.range.tolist()], np.int64) + self.number
            times = n_runs[context]
            run = spread((np.cumsum(n_runs) - n_runs)[context], times)
            owner = np.repeat(np.arange(len(context)), times)
            before = np.cumsum(windows[run]) - windows[run]
            begin = self.first[owner] + before - before[(np.cumsum(times) - times)[owner]]
            gone = docs[run] < self.ids[self.doc[owner]]
            np.add.at(cover, begin[gone], 1)
            np.subtract.at(cover, begin[gone] + windows[run][gone] - 1 + self.length, 1)
        return np.cumsum(cover[:-1]) > 0


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def repeated_spans(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of docs; length is over 24 and up to 139."""
    spark = docs.sparkSession
    scratch = Scratch(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def row() -> pa.RecordBatch:
            digests = [hashlib.sha256(d).digest() if i is not None and len(d := t.encode("utf-8", "surrogatepass")) >= length else None for i, t in zip(ids, texts, strict=True)]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((part << 32 | number, size, ids, digests, texts), kinds, strict=True)], ["block", "bytes", "doc_ids", "digests", "texts"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= BLOCK_BYTES:
                    yield row()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield row()

    def block_of(row: dict) -> Block:
        first = {x["digest"]: x["first"] for x in row["copies"] or []}
        silent = [i is None or i > first.get(d, i) for i, d in zip(row["doc_ids"], row["digests"], strict=True)]
        return Block(row["doc_ids"], row["texts"], silent, length)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            asked = block_of(row).questions(ranges)
            yield pa.RecordBatch.from_arrays([pa.array([row["block"]] * len(asked), pa.int64()), pa.array([x[0] for x in asked], pa.int64()), *(pa.array([x[k].tobytes() for x in asked], pa.binary()) for k in (1, 2))], ["block", "range", "hashes", "times"])

    def answer(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, "<u4") for x in table["hashes"].to_pylist()]
        times = np.concatenate([np.frombuffer(x, np.uint8) for x in table["times"].to_pylist()])
        kinds, which = np.unique(np.concatenate(hashes), return_inverse=True)
        shared = (np.bincount(which) > 1) | (np.bincount(which, times >> 7) > 0)
        hot = np.bincount(which, times & 127) > HOT_RUNS
        cut = np.cumsum([len(h) for h in hashes])[:-1]
        bits = [[np.packbits(x).tobytes() for x in np.split(flag[which], cut)] for flag in (shared, hot)]
        return pa.table({"block": table["block"], "range": table["range"], "shared": pa.array(bits[0], pa.binary()), "hot": pa.array(bits[1], pa.binary())})

    def shared_block(row: dict) -> Block:
        block = block_of(row)
        block.asked({x["range"]: (x["shared"], x["hot"]) for x in row["answers"] or []}, ranges)
        return block

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = shared_block(row)
            contexts = block.contexts()
            docs_of = block.least(contexts)
            every = [(b, np.array([len(x) - 1 for x in c], "u1").tobytes(), b"".join(x[:1] for x in c), b"".join(x[1:] for x in c), docs_of[b].tobytes()) for b, c in contexts.items()]
            yield pa.RecordBatch.from_arrays([pa.array([row["block"]] * len(every), pa.int64()), *(pa.array([x[k] for x in every], pa.binary() if k else pa.int64()) for k in range(5))], ["block", "range", "sizes", "offsets", "contexts", "docs"])

    def settle(table: pa.Table) -> pa.Table:
        sizes, offsets, data, docs_of = (np.concatenate([np.frombuffer(x, kind) for x in table[c].to_pylist()]) for c, kind in (("sizes", "u1"), ("offsets", "u1"), ("contexts", "u1"), ("docs", "<i8")))
        n_runs, windows, least = settled(data, sizes.astype(np.int64), offsets.astype(np.int64), docs_of, length)
        cut = np.cumsum([len(x) for x in table["sizes"].to_pylist()])
        run_cut = np.cumsum(n_runs)[cut - 1][:-1]
        out = {"n_runs": np.split(n_runs.astype("u1"), cut[:-1]), "windows": np.split(windows.astype("u1"), run_cut), "least": np.split(least.astype("<i8"), run_cut)}
        return pa.table({"block": table["block"], "range": table["range"], **{k: pa.array([x.tobytes() for x in v], pa.binary()) for k, v in out.items()}})

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = shared_block(row)
            block.contexts()
            gone = block.removed({x["range"]: (np.frombuffer(x["n_runs"], "u1"), np.frombuffer(x["windows"], "u1"), np.frombuffer(x["least"], "<i8")) for x in row["verdicts"] or []})
            first = {x["digest"]: x["first"] for x in row["copies"] or []}
            rows = []
            for i, digest, a, n in zip(row["doc_ids"], row["digests"], block.start.tolist(), block.size.tolist(), strict=True):
                own = gone[a : a + n] if i is None or i <= first.get(digest, i) else np.ones(n, bool)
                rows.append((n, int(own.sum()), int((np.diff(own.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(block.data[a : a + n][~own].tobytes()).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), *(pa.array([r[k] for r in rows], pa.int64() if k < 3 else pa.string()) for k in range(4))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = id_and_text(docs, id_col, text_col).mapInArrow(pack, "block long, bytes long, doc_ids array<long>, digests array<binary>, texts array<string>")
    blocks = scratch.write(packed, bucket="block", buckets=min(partitions, MOST_SLICES))
    ranges = max(partitions, (blocks.agg(F.sum("bytes")).first()[0] or 0) // RANGE_BYTES)

    per_block = blocks.select("block", F.explode(F.arrays_zip("doc_ids", "digests")).alias("d")).filter("d.digests is not null").groupBy("block", F.col("d.digests").alias("digest")).agg(F.min("d.doc_ids").alias("least"), F.max("d.doc_ids").alias("most"))
    firsts = per_block.groupBy("digest").agg(F.min("least").alias("first"), F.max("most").alias("most")).filter("first < most").drop("most")
    copies = per_block.join(firsts.hint("merge"), "digest").groupBy("block").agg(F.collect_list(F.struct("digest", "first")).alias("copies"))  # at most one of each document of the block
    known = blocks.join(scratch.write(copies).hint("merge"), "block", "left")

    asked = known.mapInArrow(ask, "block long, range long, hashes binary, times binary")
    answers = scratch.write(asked.groupBy("range").applyInArrow(answer, "block long, range long, shared binary, hot binary"), "none")
    by_block = answers.groupBy("block").agg(F.collect_list(F.struct("range", "shared", "hot")).alias("answers"))  # one of each range
    known = known.join(by_block.hint("merge"), "block", "left")
    offered = known.mapInArrow(offer, "block long, range long, sizes binary, offsets binary, contexts binary, docs binary")
    verdicts = scratch.write(offered.groupBy("range").applyInArrow(settle, "block long, range long, n_runs binary, windows binary, least binary"), "zstd")
    by_block = verdicts.groupBy("block").agg(F.collect_list(F.struct("range", "n_runs", "windows", "least")).alias("verdicts"))
    out = known.join(by_block.hint("merge"), "block", "left").mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return scratch.only(out)


def op7_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(documents(spark, sf_dir))
