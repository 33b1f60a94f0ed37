"""Token-id files compressed by Re-Pair.

Documents are dealt out by ranges of doc_id, encoded, and written in ascending doc_id order as shards of about `shard_ids`
ids. Within a shard frequent pairs of neighbouring symbols become nonterminals, round after round, the more frequent of two that
overlap first, until no pair pays for its rule (three integers) any more; no pair crosses a document. A shard stores, as
little-endian unsigned 32-bit integers, the rules (left and right symbol), the length of each rule's expansion, the symbols, and
per document its id, its number of ids and its number of symbols. With those lengths a reader finds any document, or any id in it, and expands only what it needs.
A shard is one row of a Parquet table, so that any store that Spark writes to will do.

Null and empty texts have the end id alone. Null ids come first; rows of one id are ordered by a hash of their text. An empty
table gives no shards and no rows.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import byte_letters, collector_resting, documents, id_and_text, shared_dir

U4 = np.dtype("<u4")
SHARD_SCHEMA = "part long, shard long, base long, doc_ids array<long>, n_ids binary, n_symbols binary, rules binary, rule_lengths binary, symbols binary, total long"
MOST_CACHED, MOST_BYTES, MOST_SEEN, ROWS, CHARACTERS, TOGETHER, TOGETHER_BYTES = 1_500_000, 200_000_000, 600_000, 6_000, 20_000_000, 2_000, 500_000
#: A space and white space of another kind: they may be parts of one pretoken, so there is no cut before them.
MIXED = re.compile(r" [^\S ]")
SPACE, LINE_FEED, STAND_IN = 0x20, 0x0A, b" a"
ASCII_LETTER, SIGN, VISIBLE, LATIN_LEAD = np.zeros((4, 256), bool)
ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
SIGN[:0x80] = ~ASCII_LETTER[:0x80]
VISIBLE[0x21:0x7F] = True
LATIN_LEAD[0xC3:0xCA] = True


@lru_cache(2)
def tokenizer(path: str | None = None):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))


@lru_cache(2)
def words_tokenizer(path: str | None = None):
    """The same model over words that are cut at spaces and already written in the vocabulary's letters for bytes."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import CharDelimiterSplit

    out = Tokenizer(tokenizer(path).model)
    out.pre_tokenizer = CharDelimiterSplit(" ")
    return out


def units(text: str) -> list[str]:
    """The text cut before each single space that anything but white space follows; the tokenizer's own cuts contain all of these."""
    pieces = text.split(" ")
    out = [pieces[0]]
    for p in pieces[1:]:
        if p and not p[0].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to a letter of A-Z, a-z or U+00C0 to U+024F but for the two signs there; all versions of Unicode have these as letters."""
    out = ASCII_LETTER[data]
    lead = np.flatnonzero(LATIN_LEAD[data[:-1]])
    a, b = data[lead], data[lead + 1]
    lead = lead[~((a == 0xC3) & ((b == 0x97) | (b == 0xB7)) | (a == 0xC9) & (b > 0x8F))]
    out[lead] = out[lead + 1] = True
    return out


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where units of these texts begin: at each text, space, ASCII sign behind a letter, and ASCII letter behind a lone line feed.

    The tokenizer cuts at all of these, and what it makes of a unit doesn't depend on the others, in texts without a space that white space or
    the text's end follows.
    """
    out = SIGN[data]
    out[1:] &= letters(data)[:-1]
    out |= data == SPACE
    feed = np.flatnonzero(data[1:-1] == LINE_FEED) + 1
    out[feed[VISIBLE[data[feed - 1]] & ASCII_LETTER[data[feed + 1]]] + 1] = True
    out[starts] = True
    return np.flatnonzero(out)


def strings(data, offsets: np.ndarray) -> pa.Array:
    """Neighbouring strings of bytes, of which the last ends at the last offset."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64, copy=False)), pa.py_buffer(data)])


def content(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the strings, and their offsets, from 0 on."""
    _, offsets, data = a.buffers()
    offsets = np.frombuffer(offsets, np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Encoder:
    """Encodes texts with the library; units that were seen before come from a bounded memory.

    Texts are cut into units by their bytes and looked up many at a time. New units go to the library many at a time, side by side as in a
    text, and what comes back is cut by the bytes of its tokens.
    """

    def __init__(self, path: str | None = None):
        self.tok, self.seen = tokenizer(path), {}
        self.known, self.ids = pa.array([], pa.large_binary()), pa.array([], pa.large_binary())
        self.used, self.turn = np.zeros(0, np.int64), 0  # when each known unit was used last
        self.of_words = words_tokenizer(path)
        byte = byte_letters()
        self.plain_letters = dict(enumerate(byte)) | {SPACE: " "}
        self.letters = self.plain_letters | {SPACE: " " + byte[SPACE]}
        vocabulary = self.tok.get_vocab()
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.size[number] = len(token)  # a letter for each byte

    def learned(self, new: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
        """The new units, in another order, and their ids."""
        data, offsets = content(new)
        first, size = offsets[:-1], np.diff(offsets)
        head, strange = data[first], ~letters(data)
        spaced = head == SPACE
        strange[first[spaced]] = False
        strange = np.logical_or.reduceat(strange, first)
        order, found = [], []
        for which, encode in (
            (spaced & ~strange, self.spaced_words),
            (~spaced & ~strange, self.words),
            (spaced & strange, self.side_by_side),
            (~spaced & strange & SIGN[head], self.behind_a_word),
            (~spaced & strange & ~SIGN[head], self.each),
        ):
            at = np.flatnonzero(which)
            group = np.arange(len(at)) // TOGETHER + np.cumsum(size[at]) // TOGETHER_BYTES
            for part in np.split(at, np.flatnonzero(np.diff(group)) + 1) if len(at) else ():
                order.append(part)
                found.append(encode(new.take(pa.array(part))))
        return new.take(pa.array(np.concatenate(order))), found

    def spaced_words(self, units: pa.Array) -> pa.Array:
        """Spaces and words, which the tokenizer doesn't cut further; so it needn't look for where to."""
        data, offsets = content(units)
        return self.cut(self.of_words, data.tobytes().decode("latin-1").translate(self.letters)[1:], np.diff(offsets))

    def words(self, units: pa.Array) -> pa.Array:
        """Words without a space, likewise."""
        return self.cut(self.of_words, b" ".join(units.to_pylist()).decode("latin-1").translate(self.plain_letters), np.diff(content(units)[1]))

    def side_by_side(self, units: pa.Array) -> pa.Array:
        """Anything behind a space."""
        data, offsets = content(units)
        return self.cut(self.tok, data.tobytes().decode(), np.diff(offsets))

    def behind_a_word(self, units: pa.Array) -> pa.Array:
        """What a sign begins: behind a word that stands in, whose ids are left out."""
        text = STAND_IN + STAND_IN.join(units.to_pylist())
        sizes = np.full(2 * len(units), len(STAND_IN))
        sizes[1::2] = np.diff(content(units)[1])
        return self.cut(self.tok, text.decode(), sizes).take(pa.array(np.arange(1, len(sizes), 2)))

    def each(self, units: pa.Array) -> pa.Array:
        """The rest one by one."""
        found = self.tok.encode_batch_fast([x.decode() for x in units.to_pylist()], add_special_tokens=False)
        return pa.array([np.array(e.ids, U4).tobytes() for e in found], pa.large_binary())

    def cut(self, tok, text: str, sizes) -> pa.Array:
        """The ids of the text, cut behind as many bytes as each size says."""
        ids = np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, U4)
        ends = (np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(sizes)) + 1) * U4.itemsize
        return strings(ids.tobytes(), np.concatenate([[0], ends]))

    def numbers(self, units: pa.Array) -> np.ndarray:
        """The number of each unit among those known, which new ones are added to."""
        self.turn += 1
        if len(self.known) > MOST_CACHED or self.known.nbytes + self.ids.nbytes > MOST_BYTES:  # what wasn't used of late goes
            keep = self.used > self.turn - 4
            self.known, self.ids, self.used = self.known.filter(pa.array(keep)), self.ids.filter(pa.array(keep)), self.used[keep]
        found = pc.index_in(units, value_set=self.known)
        missing = found.is_null().to_numpy(zero_copy_only=False)
        out = found.fill_null(0).to_numpy(zero_copy_only=False)
        if missing.any():
            rest = units.filter(pa.array(missing))
            new, ids = self.learned(rest.unique())
            out = out.copy()
            out[missing] = pc.index_in(rest, value_set=new).to_numpy(zero_copy_only=False) + len(self.known)
            self.known, self.ids = pa.concat_arrays([self.known, new]), pa.concat_arrays([self.ids, *ids])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])
        self.used[out] = self.turn
        return out

    def of_texts(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of texts without a space that white space or the text's end follows."""
        size = np.array([len(x) for x in texts], np.int64)
        starts, data = np.cumsum(size) - size, b"".join(texts)
        first = cuts(np.frombuffer(data, np.uint8), starts[size > 0])
        numbers = self.numbers(strings(data, np.append(first, len(data))))
        every, offsets = content(self.ids.take(pa.array(numbers)))
        ends = offsets[np.append(np.searchsorted(first, starts), len(first))].tolist()
        return (every[a:z].tobytes() for a, z in zip(ends, ends[1:], strict=False))

    def unit(self, text: str) -> bytes:
        if (known := self.seen.get(text)) is None:
            known = self.seen[text] = array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        return known

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.seen) > MOST_SEEN:
            self.seen.clear()
        plain = [k for k, t in enumerate(texts) if not ("<|" in t or "  " in t or t[-1:] == " " or MIXED.search(t))]
        out = [b""] * len(texts)
        for k, ids in zip(plain, self.of_texts([texts[k].encode() for k in plain]), strict=True):
            out[k] = ids
        for k in set(range(len(texts))).difference(plain):
            t = texts[k]
            out[k] = array("I", self.tok.encode(t, add_special_tokens=False).ids).tobytes() if "<|" in t else b"".join(map(self.unit, units(t)))
        return out


def groups(texts: list[str], rows: int, characters: int) -> Iterator[tuple[int, int]]:
    """Bounds of neighbouring texts, each group of so many rows at most, and of so many characters but for its last text."""
    low = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if k + 1 - low == rows or size >= characters:
            yield low, k + 1
            low, size = k + 1, 0
    if low < len(texts):
        yield low, len(texts)


@lru_cache(1)
def shared_encoder(path: str | None = None) -> Encoder:
    """One for each worker process, so that its memory outlasts a task."""
    return Encoder(path)


RULE = 3  # integers that a rule costs


def compress(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rules as pairs, rule lengths, symbols, symbols of each document); ends are the positions after each document.

    A pair that was counted and doesn't pay never will, so a round looks at pairs that stand beside a new symbol, that paid but
    were overlapped, or whose slot of the hash counted another pair.
    """
    symbols = ids.astype(np.uint64)
    last = np.zeros(len(ids), bool)
    last[ends - 1] = True
    open_ = ~last
    rules = [np.zeros((0, 2), np.uint64)]
    factor, made = 1, 0
    number, holder = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.uint64)
    while len(at := np.flatnonzero(open_)):
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)  # a new hash each round
        bits = min(max(len(at).bit_length(), 10), 18)
        pair = symbols[at] << np.uint64(32) | symbols[at + 1]
        slot = ((pair * np.uint64(factor)) >> np.uint64(64 - bits)).astype(np.int64)
        holder[slot] = pair  # one pair of each slot is counted
        own = np.flatnonzero(holder[slot] == pair)
        counts = np.bincount(slot[own], minlength=1 << bits)
        open_[at[own]] = False
        own = own[counts[slot[own]] > RULE]
        at, slot = at[own], slot[own]
        counts = counts[slot]
        open_[at] = True
        # of overlapping pairs the more frequent; of equal ones every second from the left
        beside = at[1:] == at[:-1] + 1
        best = np.ones(len(at), bool)
        best[1:] &= ~beside | (counts[1:] >= counts[:-1])
        best[:-1] &= ~beside | (counts[:-1] >= counts[1:])
        at, slot = at[best], slot[best]
        run = np.arange(len(at)) - np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, np.arange(len(at)), 0))
        at, slot = at[run % 2 == 0], slot[run % 2 == 0]
        pays = np.bincount(slot, minlength=1 << bits) > RULE
        if not pays.any():
            open_[at] = False  # too few of each are free
            continue
        at, slot = at[pays[slot]], slot[pays[slot]]
        kinds = np.flatnonzero(pays)
        number[kinds] = np.arange(len(kinds)) + base + made
        rules.append(np.stack([holder[kinds] >> np.uint64(32), holder[kinds] & np.uint64(0xFFFFFFFF)], 1))
        made += len(kinds)
        symbols[at] = number[slot]
        last[at] = last[at + 1]
        open_[at] = ~last[at]
        before = at[at > 0] - 1
        open_[before] = ~last[before]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, last, open_ = symbols[keep], last[keep], open_[keep]
    lengths = np.ones(made, np.int64)
    low = 0
    for part in rules:  # a round's rules are made of those before
        for side in part.T.astype(np.int64):
            lengths[low : low + len(part)] += np.where(side >= base, lengths[np.maximum(side - base, 0)], 1) if made else 0
        lengths[low : low + len(part)] -= 1
        low += len(part)
    return np.concatenate(rules).astype(U4), lengths.astype(U4), symbols.astype(U4), np.diff(np.flatnonzero(last) + 1, prepend=0).astype(U4)


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The ids that the symbols stand for; lengths are those of the rules' expansions."""
    size_of = lambda s: np.where(s >= base, lengths[np.maximum(s - base, 0)], 1) if len(lengths) else np.ones(len(s), np.int64)
    left, right = rules.reshape(-1, 2).astype(np.int64).T
    lengths, open_ = lengths.astype(np.int64), symbols.astype(np.int64)
    size = size_of(open_)
    out, at = np.empty(size.sum(), U4), np.cumsum(size) - size
    while len(open_):
        deep = open_ >= base
        out[at[~deep]] = open_[~deep]
        rule, at = open_[deep] - base, at[deep]
        open_, at = np.concatenate([left[rule], right[rule]]), np.concatenate([at, at + size_of(left[rule])])
    return out


class Shard:
    """Reads one stored shard."""

    def __init__(self, row: dict):
        self.base, self.doc_ids = row["base"], row["doc_ids"]
        self.n_ids, self.n_symbols, rules, self.rule_lengths, self.symbols = (np.frombuffer(row[k], U4) for k in ("n_ids", "n_symbols", "rules", "rule_lengths", "symbols"))
        self.rules = rules.reshape(-1, 2)
        self.at = np.concatenate([[0], np.cumsum(self.n_symbols, dtype=np.int64)])

    def document(self, k: int) -> np.ndarray:
        return expand(self.symbols[self.at[k] : self.at[k + 1]], self.rules, self.rule_lengths, self.base)

    def ids(self, k: int, low: int, high: int) -> np.ndarray:
        """Ids low to high of document k, of which only the symbols that hold them are expanded."""
        own = self.symbols[self.at[k] : self.at[k + 1]].astype(np.int64)
        size = np.ones(len(own), np.int64)
        size[own >= self.base] = self.rule_lengths[own[own >= self.base] - self.base]
        ends = np.cumsum(size)
        a, b = np.searchsorted(ends, low, "right"), np.searchsorted(ends, high, "left") + 1
        skip = low - (ends[a - 1] if a else 0)
        return expand(own[a:b], self.rules, self.rule_lengths, self.base)[skip : skip + high - low]


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, shard_ids: int = 1_000_000, vocabulary_path: str | None = None) -> None:
    """Encodes docs and writes them to `path` as shards in ascending doc_id order."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(vocabulary_path)
        base = encoder.tok.get_vocab_size() + 1
        end = np.array([end_id], U4).tobytes()
        part, number, held, docs_held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def shard() -> pa.RecordBatch:
            n_ids = np.array([len(x) // 4 for x in held], np.int64)
            rules, lengths, symbols, n_symbols = compress(np.frombuffer(b"".join(held), U4), np.cumsum(n_ids), base)
            row = [part, number, base, docs_held, n_ids.astype(U4).tobytes(), n_symbols.tobytes(), rules.tobytes(), lengths.tobytes(), symbols.tobytes(), int(n_ids.sum())]
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] + [pa.binary()] * 5 + [pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], [x.split()[0] for x in SHARD_SCHEMA.split(", ")])

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for low, high in groups(texts, ROWS, CHARACTERS):
                with collector_resting():
                    found = encoder(texts[low:high])
                for i, x in zip(ids[low:high], found, strict=True):
                    held.append(x + end)
                    docs_held.append(i)
                    size += len(held[-1]) // 4
                    if size >= shard_ids:
                        yield shard()
                        number, held, docs_held, size = number + 1, [], [], 0
        if held:
            yield shard()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("doc_id", F.xxhash64("text"))
    dealt = id_and_text(docs, id_col, text_col).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt.mapInArrow(pack, SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                s = Shard(row)
                n = s.n_ids.astype(np.int64)
                every = expand(s.symbols, s.rules, s.rule_lengths, s.base)
                ends = np.cumsum(n)
                crc = [zlib.crc32(every[e - x : e].tobytes()) for e, x in zip(ends.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ([row["part"]] * len(n), [row["shard"]] * len(n), s.doc_ids, ends - n, n, crc)], ["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    totals = shards.select("part", "shard", "total")
    of_part = totals.groupBy("part").agg(F.sum("total").alias("n"))
    parts = of_part.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))  # one row for each partition of the writer
    inside = totals.select("part", "shard", (F.sum("total").over(W.partitionBy("part").orderBy("shard")) - F.col("total")).alias("skip"))
    starts = inside.join(parts, "part").select("part", "shard", (F.col("base") + F.col("skip")).alias("before"))
    rows = shards.mapInArrow(unpack, "part long, shard long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(starts.hint("merge"), ["part", "shard"]).select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token_files_{uuid.uuid4().hex}"
    write_token_files(documents(spark, sf_dir), path)
    return read_token_files(spark, path)
