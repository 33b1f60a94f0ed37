"""Records of large files, cut by all tasks that read a file.

A quoted CSV field may hold line feeds, and a JSON array may be one line, so where a record begins depends on all that stands before
it. Files are read by byte ranges as units: lines of CSV, and of JSON what stands between two closing braces. Three passes:

1. For each range, what it does to the state of the scan: for CSV, whether its end is inside quotes, for each way in; for JSON the
   parity of its quotes, and by how much it nests, for each way in.
2. These are composed from range to range of a file by running sums, which gives the state at each range's start. That is one row
   of some 30 bytes for each range; the driver holds a larger object for it to schedule its task, so it is sent to the tasks.
3. Each range cuts its records from there on. What crosses its ends goes on as fragments, at most one each way, that are joined by
   their order in the file; a record may span many ranges.

No string holds more than a record (and, of JSON, what stands beside it up to a brace). Compressed files are one range.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WHOLE, HEAD, TAIL = 0, 1, 2
RECORDS = "file {}, start long, kind int, first boolean, text string"
BACKSLASH, QUOTE, OPENING, CLOSING = ord("\\"), ord('"'), np.zeros(256, bool), np.zeros(256, bool)
OPENING[list(b"[{")] = CLOSING[list(b"]}")] = True


def units(spark: SparkSession, path: str, delimiter: str, pattern: str | None = None, named: bool = False) -> DataFrame:
    """(file, start, value): what stands between delimiters, by file (its path, or a hash of it) and first byte of the range, in order within a range."""
    reader = spark.read.option("lineSep", delimiter)
    if pattern:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.text(path).select((F.col("_metadata.file_path") if named else F.xxhash64("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, pa.Array]]:
    """(key of the range, whether it goes on, units): batches cut where another range begins. The key is every column but the last."""
    held = None
    for batch in batches:
        keys = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:2]]
        new = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])) + 1
        for a, z in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows], strict=True):
            if z > a:
                key = tuple(c[a].as_py() for c in batch.columns[:-1])
                if held:
                    yield held[0], held[0] == key, held[1]
                held = key, batch.columns[-1].slice(a, z - a)
    if held:
        yield held[0], False, held[1]


def stitched(cut: DataFrame, delimiter: str) -> DataFrame:
    """(file, text) of all records: whole ones, and those whose fragments are joined."""
    parts = cut.filter(F.col("kind") != WHOLE)
    by = W.partitionBy("file").orderBy("start", "kind")  # at most two fragments of a range; the head stands before the tail
    parts = parts.withColumn("number", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(by.rowsBetween(W.unboundedPreceding, 0)))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))), lambda x: x["text"])  # of one record
    joined = parts.groupBy("file", "number").agg(F.array_join(texts, delimiter).alias("text"), F.bool_or("first").alias("first"))
    return cut.filter((F.col("kind") == WHOLE) & ~F.col("first")).select("file", "text").unionByName(joined.filter("not first").select("file", "text"))


class Cutter:
    """Gathers the units of one range at a time into records."""

    def __init__(self, delimiter: str):
        self.delimiter, self.rows = delimiter, []

    def begin(self, key: tuple, inside: bool, first: bool) -> None:
        self.key, self.inside, self.first, self.pending = key, inside, first, []

    def add(self, text: str) -> None:
        """The last unit of a record."""
        self.put(HEAD if self.inside else WHOLE, [*self.pending, text])
        self.inside, self.pending = False, []

    def put(self, kind: int, parts: list[str]) -> None:
        self.rows.append((*self.key, kind, self.first and kind != HEAD, self.delimiter.join(parts)))
        self.first = self.first and kind == HEAD

    def end(self) -> None:
        """The end of the range: what is pending goes on in the next one."""
        if self.pending:
            self.put(HEAD if self.inside else TAIL, self.pending)

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        kinds = (None, pa.int64(), pa.int32(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["file", "start", "kind", "first", "text"])


def line_ends(lines: pa.Array, separator: str) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line ends inside quotes, if it begins outside them and if it begins inside. A quote opens a field at its start only."""
    s = re.escape(separator)
    field = rf'(?:"(?:[^"]|"")*"(?:[^"{s}][^{s}]*)?|[^"{s}][^{s}]*|)'
    opens = rf'(?s)^(?:{field}{s})*"(?:[^"]|"")*$'
    quoted = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
    out = np.zeros(len(lines), bool)
    inside = ~quoted
    if quoted.any():
        some = lines.filter(pa.array(quoted))
        out[quoted] = pc.match_substring_regex(some, opens).to_numpy(zero_copy_only=False)
        inside[quoted] = pc.match_substring_regex(pc.binary_join_element_wise('"', some, ""), opens).to_numpy(zero_copy_only=False)
    return out, inside


def inside_after(out: np.ndarray, inside: np.ndarray, start: bool) -> np.ndarray:
    """The state after each line: maps that don't depend on the way in set it, those that swap it are counted since."""
    swaps = np.cumsum(out & ~inside)
    last = np.maximum.accumulate(np.where(out == inside, np.arange(len(out)), -1))
    since = swaps - np.where(last < 0, 0, swaps[last])
    return np.where(last < 0, start, out[last]) ^ (since % 2 == 1)


def csv_states(lines: DataFrame, separator: str) -> DataFrame:
    """(file, start, inside): whether each range begins inside quotes."""

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = [False, True]
        for (file, start), goes_on, own in ranges(batches):
            out, inside = line_ends(own, separator)
            ends = [bool(inside_after(out, inside, e)[-1]) for e in ends]
            if not goes_on:
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([start], pa.int64()), *(pa.array([e]) for e in ends)], ["file", "start", "e0", "e1"])
                ends = [False, True]

    by = W.partitionBy("file").orderBy("start")
    before = by.rowsBetween(W.unboundedPreceding, -1)
    each = lines.mapInArrow(maps, f"file {lines.schema['file'].dataType.simpleString()}, start long, e0 boolean, e1 boolean")
    swap = F.when(F.col("e0") & ~F.col("e1"), 1).otherwise(0)
    each = each.withColumn("swaps", F.sum(swap).over(by.rowsBetween(W.unboundedPreceding, 0)))
    each = each.withColumn("fixed", F.last(F.when(F.col("e0") == F.col("e1"), F.struct("e0", "swaps")), ignorenulls=True).over(before)).withColumn("swapped", F.coalesce(F.lag("swaps").over(by), F.lit(0)))
    parity = (F.col("swapped") - F.coalesce(F.col("fixed.swaps"), F.lit(0))) % 2 == 1
    return each.select("file", "start", (F.coalesce(F.col("fixed.e0"), F.lit(False)) != parity).alias("inside"))


def csv_records(spark: SparkSession, path: str, separator: str, pattern: str | None = None, named: bool = False) -> DataFrame:
    """(file, text): the records of CSV files below their headers, with the quotes and line feeds in them; empty lines are none.

    Lines end in a line feed, with a carriage return before it or not. `file` is the file's path with `named`, else a hash of it.
    """
    lines = units(spark, path, "\n", pattern, named)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, now = Cutter("\n"), None
        for key, goes_on, own in ranges(batches):
            if now is None:
                now = key[2]
                cutter.begin(key[:2], now, key[1] == 0)
            after = inside_after(*line_ends(own, separator), now)
            if after.any() or now or cutter.first:
                for text, open_ in zip(own.to_pylist(), after.tolist(), strict=True):
                    if open_:
                        cutter.pending.append(text)
                    else:
                        cutter.add(text)
            else:  # each line is a record
                same = [pa.array(np.full(len(own), x)) if not isinstance(x, str) else pa.array([x] * len(own)) for x in key[:2]]
                yield pa.RecordBatch.from_arrays([*same, pa.array(np.full(len(own), WHOLE, np.int32)), pa.array(np.zeros(len(own), bool)), own], ["file", "start", "kind", "first", "text"])
            now = bool(after[-1])
            if not goes_on:
                cutter.end()
                now = None
            if cutter.rows:
                yield cutter.batch()

    states = F.broadcast(csv_states(lines, separator))  # a row for each range
    known = lines.join(states, ["file", "start"]).select("file", "start", "inside", "value")
    rows = stitched(known.mapInArrow(cut, RECORDS.format(lines.schema["file"].dataType.simpleString())), "\n")
    ended = F.expr("replace(substring(text, 1, length(text) - 1), '\\r\\n', '\\n')")
    return rows.select("file", F.when(F.endswith("text", F.lit("\r")), ended).otherwise(F.col("text")).alias("text")).filter("text <> ''")


class Structure:
    """Where the units of one piece of JSON nest, by numpy over all their bytes."""

    def __init__(self, own: pa.Array):
        data = pa.concat_arrays([own]).cast(pa.binary())
        offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1].astype(np.int64)
        whole = np.frombuffer(data.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        ends = offsets[1:] - offsets[0]
        # a brace stands behind each unit
        self.bytes = np.insert(whole, ends, ord("}"))
        self.ends = ends + np.arange(len(ends))
        quote = self.bytes == QUOTE
        back = np.flatnonzero(self.bytes == BACKSLASH)
        if len(back):
            first = np.ones(len(back), bool)
            first[1:] = np.diff(back) > 1
            number = np.arange(len(back)) - np.maximum.accumulate(np.where(first, np.arange(len(back)), 0))
            escaping = back[number % 2 == 0] + 1
            quote[escaping[escaping < len(quote)]] = False
        self.quotes = np.cumsum(quote)
        self.quote = quote

    def depth(self, parity: int) -> tuple[np.ndarray, np.ndarray]:
        """(places of the brackets outside strings, the depth after each, from 0)."""
        at = np.flatnonzero(OPENING[self.bytes] | CLOSING[self.bytes])
        at = at[(self.quotes[at] + parity) % 2 == 0]
        return at, np.cumsum(np.where(OPENING[self.bytes[at]], 1, -1))


def json_states(pieces: DataFrame) -> DataFrame:
    """(file, start, parity, depth, top): the state of the scan at the start of each range, and the byte of the file's first bracket."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, top = np.zeros(3, np.int64), None
        for (file, start), goes_on, own in ranges(batches):
            s = Structure(own)
            depths = []
            for parity in (0, 1):
                at, depth = s.depth(parity ^ int(total[0] & 1))
                depths.append(int(depth[-1]) if len(depth) else 0)
                if parity == 0 and top is None and len(at):
                    top = int(s.bytes[at[0]])
            total += (int(s.quotes[-1]), *depths)
            if not goes_on:
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (file, start, int(total[0] & 1), *total[1:].tolist(), top)], ["file", "start", "p", "d0", "d1", "top"])
                total, top = np.zeros(3, np.int64), None

    by = W.partitionBy("file").orderBy("start")
    before = by.rowsBetween(W.unboundedPreceding, -1)
    each = pieces.mapInArrow(sums, "file long, start long, p long, d0 long, d1 long, top long")
    each = each.withColumn("parity", F.coalesce(F.sum("p").over(before), F.lit(0)) % 2)
    each = each.withColumn("d", F.when(F.col("parity") == 0, F.col("d0")).otherwise(F.col("d1")))
    return each.select("file", "start", "parity", F.coalesce(F.sum("d").over(before), F.lit(0)).alias("depth"), F.first("top", ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("top"))


def openings(s: Structure, at: np.ndarray, depth: np.ndarray, base: int, field: re.Pattern | None) -> list[tuple[int, bool]]:
    """(place, whether records follow) of the brackets between which the records' own container begins and ends."""
    into = OPENING[s.bytes[at]]
    some = np.flatnonzero(((depth == base) & into) | ((depth == base - 1) & ~into))
    out = []
    for k in some.tolist():
        p = int(at[k])
        if not into[k]:
            out.append((p, False))
        elif field is None:
            out.append((p, True))
        else:
            unit = int(np.searchsorted(s.ends, p))
            low = int(s.ends[unit - 1]) + 1 if unit else 0
            out.append((p, bool(field.search(s.bytes[low:p].tobytes()))))
    return out


def json_records(spark: SparkSession, path: str, field: str | None = None, keyed: bool = False) -> DataFrame:
    """(file, text): of files that are an array, or an object with the array in a field, the elements as they stand, those that
    aren't objects beside the next that is one. With `keyed` the container is an object, and a text has keys and values.

    A file that should be an array and is an object is one record.
    """
    if field and "}" in field:
        raise ValueError("a field's name can't hold a brace")
    pieces = units(spark, path, "}")
    name = re.compile(rb'"' + re.escape(field.encode()) + rb'"\s*:\s*\Z') if field else None
    base_of: Callable[[int | None], int] = lambda top: 2 if field else 1 if keyed or top == ord("[") else 0
    states = json_states(pieces)

    if field:

        def last_events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state, event = None, None
            for key, goes_on, own in ranges(batches):
                parity, depth = state or key[2:4]
                s = Structure(own)
                at, deep = s.depth(parity)
                found = openings(s, at, deep + depth, 2, name)
                event = found[-1][1] if found else event
                state = (parity + int(s.quotes[-1])) % 2, depth + (int(deep[-1]) if len(deep) else 0)
                if not goes_on:
                    yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([event], pa.bool_())], ["file", "start", "event"])
                    state, event = None, None

        each = pieces.join(F.broadcast(states), ["file", "start"]).select("file", "start", "parity", "depth", "value").mapInArrow(last_events, "file long, start long, event boolean")
        before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
        states = states.join(each.select("file", "start", F.coalesce(F.last("event", ignorenulls=True).over(before), F.lit(False)).alias("within")), ["file", "start"])
    else:
        base = F.lit(1) if keyed else F.when(F.col("top") == ord("["), 1).otherwise(0)
        states = states.withColumn("within", F.when(F.col("parity") == 1, F.col("depth") >= base).otherwise((F.col("depth") >= base) & ((base > 0) | (F.col("start") > 0))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, state = Cutter("}"), None
        for key, goes_on, own in ranges(batches):
            base = base_of(key[5])
            if state is None:
                state = key[2], key[3], key[4] or base == 0
                cutter.begin(key[:2], bool(state[2] and (state[0] or state[1] > base)), False)
            parity, depth, within = state
            s = Structure(own)
            at, deep = s.depth(parity)
            deep = deep + depth
            events = openings(s, at, deep, base, name) if base else []
            last = np.full(len(s.ends), -1)
            closed = np.isin(at, s.ends)
            last[np.searchsorted(s.ends, at[closed])] = deep[closed]
            text, low = s.bytes.tobytes(), 0
            for end, after in zip(s.ends.tolist(), last.tolist(), strict=True):
                while events and events[0][0] <= end:
                    place, into = events.pop(0)
                    if within and not into:
                        cutter.add(text[low:place].decode())
                    cutter.pending, within, low = [], into, place + 1
                if within and low <= end:
                    cutter.pending.append(text[low:end].decode())
                    if after == base:
                        cutter.add("")
                low = end + 1
            state = (parity + int(s.quotes[-1])) % 2, int(deep[-1]) if len(deep) else depth, within
            if not goes_on:
                cutter.end()
                state = None
            if cutter.rows:
                yield cutter.batch()

    rows = pieces.join(F.broadcast(states), ["file", "start"]).select("file", "start", "parity", "depth", "within", "top", "value").mapInArrow(cut, RECORDS.format("long"))
    return stitched(rows, "}").select("file", F.regexp_replace("text", r"^[\s,]+|\s+$", "").alias("text")).filter("text <> ''")
