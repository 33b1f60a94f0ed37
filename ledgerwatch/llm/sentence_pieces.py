"""SentencePiece encoding and decoding by suffix-array matching.

A batch's texts are cut where no piece reaches across (before a run of spaces, and between two characters that stand side by
side in no piece). The distinct segments of the batch text are laid end to end, and all their suffixes are sorted to the depth of
the longest piece. Every piece of the vocabulary finds its range of suffixes by binary search, so each range is the piece's
occurrences: the edges of a lattice. Edges are sorted by the position where they end and relaxed in that order. The model merges
by rank, so the best edge into a position is the one whose piece the merges leave standing beside the last piece of the prefix
before it; there is exactly one, and the longest edges are tried first. Characters outside the vocabulary fall back to their bytes.

Segments that were encoded before are looked up; that memory is bounded, and let go at the end of a task.
Ids equal the library's for the given model; decoding gives the text back, but for a U+2581 in it, which reads as a space.
Null and empty texts have no ids. Rows are independent: repeated rows give repeated results, a null id stays null. A column of the
caller with the name of the new one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Pieces, collector_resting, documents, give_back, id_and_text

SPACE = "▁"
U4 = np.dtype("<u4")
GAP = 0x110000  # ends each segment in the index; no character has it
FULL = np.uint64((1 << 63) - 1)  # three points of 21 bits
MOST_KNOWN, MOST_ODD, MOST_INDEX, ROWS = 200_000, 50_000, 100_000, 500


def suffixes(points: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by their first `depth` points at least: ranks of a length give ranks of twice that length."""
    n = len(points)
    key = points.astype(np.uint64)
    for k in (1, 2):
        key = key << np.uint64(21)
        key[: n - k] |= points[k:].astype(np.uint64) + np.uint64(1)
    size = 3
    while True:
        order = np.argsort(key)
        sorted_key = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]])).astype(np.uint64)
        if size >= depth or int(rank.max()) == n - 1:
            return order
        key = rank << np.uint64(32)
        key[: n - size] |= rank[size:] + np.uint64(1)
        size *= 2


def threes(points: np.ndarray) -> np.ndarray:
    """Three rows of points as one integer each, in the order of the points."""
    a, b, c = points.astype(np.uint64)
    return a << np.uint64(42) | b << np.uint64(21) | c


def merged(parts: list[str], score: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """The parts after all merges, by score and then from the left, and the two of the last merge."""
    ranks, pair = [score.get(x + y) for x, y in zip(parts, parts[1:], strict=False)], None
    while (best := max((s for s in ranks if s is not None), default=None)) is not None:
        at = ranks.index(best)
        pair = parts[at], parts[at + 1]
        parts[at : at + 2] = ["".join(pair)]
        del ranks[at]
        for k in (at - 1, at):
            if 0 <= k < len(ranks):
                ranks[k] = score.get(parts[k] + parts[k + 1])
    return parts, pair


def slots(pairs: np.ndarray) -> np.ndarray:
    return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)


class Model:
    """Pieces and ranks of a model file."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        self.bytes_from = sp.piece_to_id("<0x00>")
        every = range(sp.get_piece_size())
        plain = [i for i in every if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.name = {i: sp.id_to_piece(i) for i in plain}
        self.score = {self.name[i]: sp.get_score(i) for i in plain}
        self.raw = [bytes([i - self.bytes_from]) if sp.is_byte(i) else b"" if i not in self.name else self.name[i].replace(SPACE, " ").encode() for i in every]
        self.longest, self.count = max(map(len, self.score)), len(self.raw)
        self.index(np.array(plain))
        self.trees({self.name[i]: i for i in plain})
        self.alphabet()
        self.known: dict[str, bytes] = {}
        self.odd_pairs: dict[int, bool] = {}

    def index(self, ids: np.ndarray) -> None:
        """The pieces as rows of three-point words, with masks for words that a piece fills in part."""
        self.ids, self.length = ids, np.array([len(self.name[i]) for i in ids.tolist()])
        table = np.zeros((len(ids), self.longest + 3 + -self.longest % 3), np.int64)
        for row, i in zip(table, ids.tolist(), strict=True):
            row[: len(self.name[i])] = [ord(c) for c in self.name[i]]
        self.words = np.stack([threes(table[:, k : k + 3].T) for k in range(0, self.longest, 3)])
        kept = np.clip(self.length[None, :] - np.arange(0, self.longest, 3)[:, None], 0, 3).astype(np.uint64)
        self.masks = (FULL << (np.uint64(63) - kept * np.uint64(21))) & FULL

    def trees(self, number: dict[str, int]) -> None:
        """For each piece the two pieces of its last merge, and all pairs that merge, with their scores.

        A piece is odd if in its tree a merge scores above one that it is made of; then scores don't tell the order of merges.
        """
        self.left, self.right = np.full(self.count + 1, -1), np.full(self.count + 1, -1)
        self.worth, self.odd = np.full(self.count + 1, np.inf), np.zeros(self.count + 1, bool)
        for p, i in sorted(number.items(), key=lambda x: len(x[0])):
            if len(p) > 1:
                self.worth[i] = self.score[p]
                x, y = merged([*p], self.score)[1] or (p, p)
                if x == p:
                    self.odd[i] = True
                    continue
                a, b = self.left[i], self.right[i] = number[x], number[y]
                self.odd[i] = self.odd[a] or self.odd[b] or min(self.worth[a], self.worth[b]) <= self.worth[i]
        pairs = sorted((number[p[:k]] << 32 | number[p[k:]], self.score[p]) for p in number for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        self.pairs, self.pair_worth = np.array([x for x, _ in pairs]), np.array([x for _, x in pairs])
        self.may_merge = np.zeros(1 << 22, bool)  # a look before the search
        self.may_merge[slots(self.pairs)] = True

    def alphabet(self) -> None:
        """Which characters stand side by side in a piece; class 0 is in no piece of two characters or more."""
        beside = {p[k : k + 2] for p in self.score for k in range(len(p) - 1)}
        letters = sorted({c for pair in beside for c in pair})
        self.kind = np.zeros(GAP + 1, np.uint16)
        self.kind[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for a, b in beside:
            self.beside[self.kind[ord(a)], self.kind[ord(b)]] = True

    def stand(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Which pairs of pieces the merges leave side by side; self.count stands for a character outside the vocabulary.

        The merges of both are undone from the latest; before each, the two that then meet must not have a merge of their own
        that comes earlier, which is of a higher score, or of the same and further left.
        """
        out = np.ones(len(first), bool)
        odd = np.flatnonzero(self.odd[first] | self.odd[second])
        out[odd] = [self.apart(a, b) for a, b in zip(first[odd].tolist(), second[odd].tolist(), strict=True)]
        at = np.flatnonzero((first < self.count) & (second < self.count) & ~(self.odd[first] | self.odd[second]))
        a, b = first[at], second[at]
        limit, equal_too = np.full(len(at), -np.inf), np.zeros(len(at), bool)
        while len(at):
            pair = a << 32 | b
            worth = np.full(len(pair), -np.inf)
            some = np.flatnonzero(self.may_merge[slots(pair)])
            k = np.minimum(np.searchsorted(self.pairs, pair[some]), len(self.pairs) - 1)
            worth[some] = np.where(self.pairs[k] == pair[some], self.pair_worth[k], -np.inf)
            crossed = (worth > limit) | (equal_too & (worth == limit))
            out[at[crossed]] = False
            own, other = self.worth[a], self.worth[b]
            more = ~crossed & (np.minimum(own, other) < np.inf)
            at, a, b, own, other = at[more], a[more], b[more], own[more], other[more]
            equal_too = other <= own
            limit = np.where(equal_too, other, own)
            a, b = np.where(equal_too, a, self.right[a]), np.where(equal_too, self.left[b], b)
        return out

    def apart(self, a: int, b: int) -> bool:
        """The same for one pair, by running the merges of the joined text."""
        if a >= self.count or b >= self.count:
            return True
        if (known := self.odd_pairs.get(a << 32 | b)) is None:
            if len(self.odd_pairs) > MOST_ODD:
                self.odd_pairs.clear()
            known = self.odd_pairs[a << 32 | b] = merged([*self.name[a], *self.name[b]], self.score)[0] == [self.name[a], self.name[b]]
        return known

    def edges(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, id) of every occurrence of every piece, and of characters that are no piece."""
        order = suffixes(points, self.longest)
        padded = np.concatenate([points, np.full(self.longest + 3, GAP)])
        three = threes(np.stack([padded[:-2], padded[1:-1], padded[2:]]))
        # the first word of three points narrows the range at once, the rest by binary search in it
        begin = three[order]
        first, last = np.searchsorted(begin, self.words[0], "left"), np.searchsorted(begin, self.words[0] | (~self.masks[0] & FULL), "right")
        deep = np.flatnonzero((self.length > 3) & (first < last))
        first[deep], last[deep] = (self.bound(order, three, deep, first[deep], last[deep], after) for after in (False, True))
        n = last - first
        own = np.repeat(np.arange(len(n)), n)
        rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start, length, which = order[first[own] + rank], self.length[own], self.ids[own]
        covered = np.zeros(len(points), bool)
        covered[start[length == 1]] = True
        bare = np.flatnonzero(~covered & (points != GAP))
        return np.concatenate([start, bare]), np.concatenate([length, np.ones(len(bare), np.int64)]), np.concatenate([which, np.full(len(bare), self.count)])

    def bound(self, order: np.ndarray, three: np.ndarray, pieces: np.ndarray, low: np.ndarray, high: np.ndarray, after: bool) -> np.ndarray:
        """The first suffix of each range low:high that isn't below the piece, or that is above it."""
        low, high = low.copy(), high.copy()
        while len(on := np.flatnonzero(low < high)):
            middle, piece = (low[on] + high[on]) // 2, pieces[on]
            less, equal, at = np.zeros(len(on), bool), np.arange(len(on)), order[middle]
            for k in range(1, len(self.words)):
                x, own = three[at[equal] + 3 * k] & self.masks[k][piece[equal]], self.words[k][piece[equal]]
                less[equal] = x < own
                equal = equal[x == own]
                if not len(equal):
                    break
            less[equal] = after
            low[on], high[on] = np.where(less, middle + 1, low[on]), np.where(less, high[on], middle)
        return low

    def learn(self, segments: list[str]) -> None:
        """Encodes segments and keeps the results."""
        points = np.frombuffer("\x00".join((*segments, "")).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum([len(u) + 1 for u in segments]) - 1
        points[ends] = GAP
        start, length, which = self.edges(points)
        begin = np.concatenate([[0], ends[:-1] + 1])
        origin = np.repeat(begin, ends - begin + 1)[start]
        end = start + length
        bits = len(points).bit_length()
        # by depth, then by end, the longest first; in one integer where that holds them
        order = np.argsort((end - origin) << (bits + 16) | end << 16 | 0xFFFF - length) if bits < 24 else np.lexsort((-length, end, end - origin))
        start, which, end, origin = start[order], which[order], end[order], origin[order]
        # last[p]: the last piece of the prefix that ends before p; back[p]: where it starts
        last, back = np.full(len(points) + 1, -1, np.int64), np.zeros(len(points) + 1, np.int64)
        depth = end - origin
        cut = np.flatnonzero(np.diff(depth, prepend=-1))
        for low, high in zip(cut.tolist(), [*cut[1:].tolist(), len(depth)], strict=True):
            own = low + np.flatnonzero(np.diff(end[low:high], prepend=-1))
            until = np.append(own[1:], high)
            while len(own):
                s = start[own]
                fine = s == origin[own]
                inner = np.flatnonzero(~fine)
                fine[inner] = self.stand(last[s[inner]], which[own[inner]])
                done = own[fine]
                last[end[done]], back[end[done]] = which[done], start[done]
                more = ~fine & (own + 1 < until)
                own, until = own[more] + 1, until[more]
        at, own, ids = ends.copy(), [], []
        which_segment = np.arange(len(segments))
        while len(which_segment):
            ids.append(last[at])
            own.append(which_segment)
            at = back[at]
            more = at > begin[which_segment]
            at, which_segment = at[more], which_segment[more]
        tokens, of = np.concatenate(ids)[::-1], np.concatenate(own)[::-1]  # each segment's tokens are in order from its start now
        order = np.argsort(of, kind="stable")
        raw, cut = tokens[order].astype(U4).tobytes(), (4 * np.searchsorted(of[order], np.arange(len(segments) + 1))).tolist()
        bare = np.zeros(len(segments), bool)
        bare[of[tokens >= self.count]] = True
        for u, a, z, has_bare in zip(segments, cut, cut[1:], bare.tolist(), strict=False):
            self.known[u] = self.with_bytes(u, np.frombuffer(raw[a:z], U4).tolist()) if has_bare else raw[a:z]

    def with_bytes(self, segment: str, ids: list[int]) -> bytes:
        """The ids of a segment in which characters outside the vocabulary stand for their bytes."""
        out, at = [], 0
        for i in ids:
            out += [i] if i < self.count else [self.bytes_from + b for b in segment[at].encode("utf-8", "surrogatepass")]
            at += len(self.name[i]) if i < self.count else 1
        return np.array(out, U4).tobytes()

    def join(self, units: list[str]) -> None:
        """Encodes units: cut into segments, of which the new ones are learned in indexes of a bounded size."""
        joined = "".join(units)
        kind = self.kind[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        cut = np.ones(len(joined) + 1, bool)
        cut[1:-1] = ~self.beside[kind[:-1], kind[1:]]
        edge = np.cumsum([0, *map(len, units)])
        cut[edge] = True
        at = np.flatnonzero(cut)
        first = np.searchsorted(at, edge).tolist()
        at = at.tolist()
        parts = [joined[a:z] for a, z in zip(at, at[1:], strict=False)]
        fresh, size = [], 0
        for p in set(parts) - self.known.keys():
            fresh.append(p)
            size += len(p) + 1
            if size > MOST_INDEX:
                self.learn(fresh)
                fresh, size = [], 0
        if fresh:
            self.learn(fresh)
        get = self.known.__getitem__
        for u, a, z in zip(units, first, first[1:], strict=False):
            if z - a > 1:
                self.known[u] = b"".join(map(get, parts[a:z]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        texts = [t.replace(SPACE, " ") if SPACE in t else t for t in texts]
        plain = [k for k, t in enumerate(texts) if t and "  " not in t and t[0] != " " and t[-1] != " "]
        other = {k: self.runs(texts[k]) for k in set(range(len(texts))).difference(plain)}
        pieces = Pieces([texts[k] for k in plain])
        units = [SPACE + p for p in pieces.distinct]
        if len(self.known) > MOST_KNOWN:
            self.known.clear()
        if fresh := list(set(units).union(*other.values()) - self.known.keys()):
            self.join(fresh)
        get, out = self.known.__getitem__, [b""] * len(texts)
        for k, ids in zip(plain, pieces.joined(list(map(get, units))), strict=True):
            out[k] = ids.tobytes()
        for k, own in other.items():
            out[k] = b"".join(map(get, own))
        return out

    def runs(self, text: str) -> list[str]:
        """Units of a text with runs of spaces: each run with what follows it up to the next."""
        own, ahead = [], SPACE if text else ""
        for k, p in enumerate(text.split(" ") if text else ()):
            ahead += SPACE if k else ""
            if p:
                own.append(ahead + p)
                ahead = ""
        return own + [ahead] if ahead else own

    def forget(self) -> None:
        """Lets go of what was learned from texts."""
        self.known.clear()
        self.odd_pairs.clear()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


@lru_cache(1)
def model(path: str | None = None) -> Model:
    return Model(path)


def encoded(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", back_col: str | None = None, model_path: str | None = None) -> DataFrame:
    """The same rows with the ids as array<int>, none for a null text, and on demand with the text that they decode to."""
    kept = [c for c in docs.columns if c not in (ids_col, back_col)]
    rows = docs.select(text_col, *(docs[c] for c in kept))
    added = [T.StructField(ids_col, T.ArrayType(T.IntegerType())), *([T.StructField(back_col, T.StringType())] if back_col else [])]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                with collector_resting():
                    found = m.encode([t or "" for t in part.column(0).to_pylist()])
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) // 4 for p in found])]).astype(np.int32))
                columns = [*part.columns[1:], pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(found), U4).astype(np.int32)))]
                if back_col:
                    columns.append(pa.array([m.decode(np.frombuffer(p, U4).tolist()) for p in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*kept, *(f.name for f in added)])
        m.forget()
        give_back()

    return rows.mapInArrow(encode, T.StructType([*(docs.schema[c] for c in kept), *added]))


def decoded(ids: str | Column, model_path: str | None = None) -> Column:
    """The text that the ids stand for."""

    def decode(rows: pa.Array) -> pa.Array:
        m = model(model_path)
        return pa.array([m.decode(x or []) for low in range(0, len(rows), 100) for x in rows[low : low + 100].to_pylist()], pa.string())

    return F.arrow_udf(decode, "string")(ids)


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of each document's ids, and whether decoding them gives the text back."""
    rows = encoded(id_and_text(documents(spark, sf_dir)), back_col="back")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), (F.col("back") == F.translate("text", SPACE, " ")).alias("lossless"))
