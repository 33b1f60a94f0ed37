"""Lightest repair of conversations whose turns are blank, repeated, cut off, or in the wrong order of roles.

A repaired conversation's role initials are `(s?(ua)+)?`. A derivation starts at the item (0 rows, nothing said) and combines an item
(rows so far, state of the roles) with an edit: Keep (0), Rerole to user or assistant (1), Delete (2), Insert an empty user or
assistant row (5); a cut-off row that isn't deleted adds 5, and blank or repeated rows can only be deleted. Its value is
(cost, audit), the audit being the edits' initials in order. Each deduction raises the cost or the number of rows, and as edits of
the same rows that cost the same are never one a prefix of the other, appending keeps their order: the functions are superior, and
Knuth's agenda, popped by (cost, rows, audit), finalises each item once, the first time that it comes up.

1. Rows are dealt out by ranges of (conversation, turn, role, text), so that a conversation of any size is spread over tasks, and
   cut there into segments of at most `SEGMENT` rows, a written table. Most conversations are one segment and end here.
2. For the others, a row's first occurrence is found by a digest of role and text over segments. Each segment derives its lightest
   edits from each state to each state (inserts stand before rows, so that segments concatenate in one way).
3. One pass over the segments of a conversation, in order, combines them: of the four states it holds cost, rank of the audit and
   a way back, no audits and no texts. Each segment then gets its own part of the lightest derivation and is repaired by itself.
4. The report streams over the parts in order. A hash of a whole text and the audit are one value of one row, so the parts of one
   conversation pass through one task for it, in bounded memory but for the audit's one byte a row.

Rows come by turn, null turns first; rows of one turn by role and then text. Null roles and texts are one space; a row with an empty
role has no initial and can't be kept. A null conversation id is a conversation of its own. Repeated rows are duplicates. Extra
columns don't matter. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

SEGMENT, SEGMENT_BYTES = 512, 4 << 20
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: States: nothing said, system said, the user spoke last, the assistant did. Moves by the initial of a role.
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ROLE_FOR = ("user", "user", "assistant", "user")
ACCEPTED = (0, 3)
WORD = re.compile(r"[^\x20\x09-\x0D]")
ROWS = "array<struct<turn:long,role:string,text:string>>"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digest(role: str, text: str) -> str:
    """As the column `digest_column`."""
    return hashlib.sha256((hashlib.sha256(role.encode()).hexdigest() + text).encode()).hexdigest()


def digest_column(row: Column) -> Column:
    return F.sha2(F.concat(F.sha2(row["role"].cast("binary"), 256), row["text"]).cast("binary"), 256)


def faults(rows: list[dict], seen: set[str]) -> str:
    """A letter for each row's first fault: blank, duplicate, truncated or none; `seen` has digests of what came before."""
    out, known = [], set()
    for r in rows:
        key = (r["role"], r["text"])
        if not WORD.search(r["text"]):
            out.append("b")
        elif key in known or (seen and digest(*key) in seen):
            out.append("d")
        else:
            out.append("t" if r["text"].rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?" else ".")
        known.add(key)
    return "".join(out)


def edits(state: int, fault: str, initial: str) -> Iterator[tuple[int, str, int]]:
    """(cost, letter, next state) of what can be done with a row."""
    yield DELETE, "D", state
    if fault not in "bd":
        more = CUT_OFF if fault == "t" else 0
        if initial in MOVES[state]:
            yield KEEP + more, "K", MOVES[state][initial]
        yield REROLE + more, "R", MOVES[state][ROLE_FOR[state][0]]


def lightest(marks: str, initials: list[str], start: int, whole: bool) -> dict[int, tuple[int, str]]:
    """(cost, audit) by the last state: of the whole conversation's one goal, or of each state after the rows of a segment."""
    n, agenda, final, out = len(marks), [(0, 0, "", start)], set(), {}
    while agenda:
        cost, i, audit, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == n:
            if not whole:
                out[state] = (cost, audit)
            elif state in ACCEPTED:
                return {state: (cost, audit)}
        else:
            for c, letter, to in edits(state, marks[i], initials[i]):
                if (i + 1, to) not in final:
                    heapq.heappush(agenda, (cost + c, i + 1, audit + letter, to))
        if i < n or whole:
            to = MOVES[state][ROLE_FOR[state][0]]
            if (i, to) not in final:
                heapq.heappush(agenda, (cost + INSERT, i, audit + "I", to))
    return out


def repaired(rows: list[dict], audit: str, state: int) -> list[tuple[str, str]]:
    """(role, text) of each row after the edits."""
    out, following = [], iter(rows)
    for letter in audit:
        row = None if letter == "I" else next(following)
        if letter == "D":
            continue
        role = row["role"] if letter == "K" else ROLE_FOR[state]
        out.append((role, row["text"] if row else ""))
        state = MOVES[state][role[0]]
    return out


def turns_of(rows: list[dict]) -> tuple[int | None, int | None, int]:
    """(first, last, number of different) turns of ordered rows, null ones left out."""
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    return (turns[0], turns[-1], len(set(turns))) if turns else (None, None, 0)


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def batch_of(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(schema)], [c for c, _ in schema])


def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            yield from batch.slice(low, 256).to_pylist()


class Repair:
    """The segments of a table of conversations, and their repair."""

    def __init__(self, conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"):
        self.spark, self.scratch = conversations.sparkSession, Scratch(conversations.sparkSession)
        space = lambda c: F.coalesce(conversations[c], F.lit(" "))
        source = conversations.select(conversations[conv_col].alias("conv"), conversations[turn_col].cast("long").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"))
        self.conv = source.schema["conv"].dataType.simpleString()
        self.slices = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        ordered = source.repartitionByRange(self.slices, "conv", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv", "turn", "role", "text")
        self.segments = self.scratch.write(ordered.mapInArrow(self.cut, f"conv {self.conv}, sid long, alone boolean, rows {ROWS}"))
        self.spread = self.segments.filter("not alone")

    @staticmethod
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments in order. Those that are a whole conversation for certain, having others of the partition on both sides, are alone."""
        sid, rows, size, now, number, kind = TaskContext.get().partitionId() << 32, [], 0, None, 0, None
        piece = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
        convs = segments = 0

        def made(alone: bool) -> pa.RecordBatch:
            return batch_of([("conv", kind), ("sid", pa.int64()), ("alone", pa.bool_()), ("rows", piece)], [(now, sid + number, alone, rows)])

        for batch in batches:
            kind = batch.schema.field(0).type
            for r in records([batch]):
                if convs and r["conv"] != now:
                    yield made(convs > 1 and not segments)
                    number, rows, size, segments = number + 1, [], 0, 0
                elif len(rows) == SEGMENT or size > SEGMENT_BYTES:
                    yield made(False)
                    number, rows, size, segments = number + 1, [], 0, segments + 1
                if not convs or r["conv"] != now:
                    now, convs = r["conv"], convs + 1
                rows.append({k: r[k] for k in ("turn", "role", "text")})
                size += len(r["text"])
        if rows:
            yield made(False)

    def spans(self) -> DataFrame:
        """Of each segment that may not be alone: its faults, and the lightest (cost, audit) from each state to each state."""
        each = self.spread.select("conv", "sid", F.explode(F.array_distinct(F.transform("rows", digest_column))).alias("digest"))
        first = each.groupBy("conv", "digest").agg(F.min("sid").alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.col("conv").alias("c"), F.col("digest").alias("d"), "first")
        later = each.join(first.hint("merge"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))).filter("sid > first")
        seen = later.groupBy("sid").agg(F.collect_list("digest").alias("seen"))  # at most one of each row of a segment
        kinds = f"conv {self.conv}, sid long, counts array<long>, first string, last string, turns array<long>, spans array<struct<a:int,z:int,cost:long,audit:string>>"

        def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kind = batch.schema.field(0).type
                schema = [("conv", kind), ("sid", pa.int64()), ("counts", pa.list_(pa.int64())), ("first", pa.string()), ("last", pa.string()), ("turns", pa.list_(pa.int64())), ("spans", pa.list_(pa.struct([("a", pa.int32()), ("z", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))]
                for r in records([batch]):
                    marks, initials = faults(r["rows"], set(r["seen"] or ())), [x["role"][:1] for x in r["rows"]]
                    every = [{"a": a, "z": z, "cost": c, "audit": t} for a in range(4) for z, (c, t) in lightest(marks, initials, a, False).items()]
                    yield batch_of(schema, [(r["conv"], r["sid"], [*map(marks.count, "bdt"), illegal(initials)], initials[0], initials[-1], turns_of(r["rows"]), every)])

        return self.scratch.write(self.spread.join(seen.hint("merge"), "sid", "left").select("conv", "sid", "rows", "seen").mapInArrow(derive, kinds))

    def chosen(self, spans: DataFrame) -> DataFrame:
        """(sid, a, z, tail, counts): the states before and after each segment in the lightest derivation; the last one has what follows it, and the counts."""

        def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = [("sid", pa.int64()), ("a", pa.int32()), ("z", pa.int32()), ("tail", pa.string()), ("counts", pa.list_(pa.int64()))]
            now, held = None, None

            def close() -> Iterator[pa.RecordBatch]:
                ends = []
                for state, (cost, rank) in held["states"].items():
                    more, to = 0, state
                    while to not in ACCEPTED:
                        more, to = more + 1, MOVES[to][ROLE_FOR[to][0]]
                    ends.append((cost + INSERT * more, rank, more, state))
                cost, _, more, state = min(ends)
                gaps = held["high"] - held["low"] + 1 - held["distinct"] if held["distinct"] else 0
                out = []
                for back, sid in reversed(held["ways"]):
                    out.append((sid, back[state], state, "", None))
                    state = back[state]
                out[0] = (*out[0][:3], "I" * more, [gaps, *held["counts"], cost])
                for low in range(0, len(out), 10_000):
                    yield batch_of(schema, out[low : low + 10_000])

            for r in records(batches):
                if held is None or r["conv"] != now:
                    if held:
                        yield from close()
                    now, held = r["conv"], {"states": {0: (0, 0)}, "ways": [], "counts": [0] * 4, "last": None, "low": None, "high": None, "distinct": 0}
                best: dict[int, tuple] = {}
                for s in r["spans"]:
                    if s["a"] in held["states"]:
                        cost, rank = held["states"][s["a"]]
                        value = (cost + s["cost"], rank, s["audit"], s["a"])
                        best[s["z"]] = min(best.get(s["z"], value), value)
                ranks = {x: k for k, x in enumerate(sorted({v[1:3] for v in best.values()}))}
                held["states"] = {z: (v[0], ranks[v[1:3]]) for z, v in best.items()}
                held["ways"].append(({z: v[3] for z, v in best.items()}, r["sid"]))
                held["counts"] = [x + y for x, y in zip(held["counts"], r["counts"], strict=True)]
                if held["last"] is not None:
                    held["counts"][3] += illegal([held["last"], r["first"]])
                held["last"] = r["last"]
                low, high, distinct = r["turns"]
                if distinct:
                    held["distinct"] += distinct - (held["high"] == low)
                    held["low"], held["high"] = low if held["low"] is None else held["low"], high
            if held:
                yield from close()

        ordered = spans.repartition(self.slices, "conv").sortWithinPartitions("conv", "sid")
        return self.scratch.write(ordered.mapInArrow(combine, "sid long, a int, z int, tail string, counts array<long>"))

    def parts(self) -> DataFrame:
        """(conv, sid, counts, audit, rows) of the segments of spread conversations, repaired; the last one of each has its counts."""
        spans = self.spans()
        own = spans.withColumnRenamed("counts", "_").join(self.chosen(spans).hint("merge"), "sid")
        audit = F.concat(F.filter("spans", lambda s: (s["a"] == F.col("a")) & (s["z"] == F.col("z")))[0]["audit"], F.col("tail"))
        edited = own.select("sid", "a", "counts", audit.alias("audit")).join(self.spread.hint("merge"), "sid").select("conv", "sid", "counts", "a", "audit", "rows")

        def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                schema = [("conv", batch.schema.field(0).type), ("sid", pa.int64()), ("counts", pa.list_(pa.int64())), ("audit", pa.string()), ("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))]
                for r in records([batch]):
                    rows = [{"role": x, "text": t} for x, t in repaired(r["rows"], r["audit"], r["a"])]
                    yield batch_of(schema, [(r["conv"], r["sid"], r["counts"], r["audit"], rows)])

        return edited.mapInArrow(render, f"conv {self.conv}, sid long, counts array<long>, audit string, rows array<struct<role:string,text:string>>")

    @staticmethod
    def alone(rows: list[dict]) -> tuple[list[int], str, list[tuple[str, str]]]:
        """(counts, audit, repaired rows) of a conversation of one segment."""
        marks, initials = faults(rows, set()), [x["role"][:1] for x in rows]
        ((cost, audit),) = lightest(marks, initials, 0, True).values()
        first, last, distinct = turns_of(rows)
        return [last - first + 1 - distinct if distinct else 0, *map(marks.count, "bdt"), illegal(initials), cost], audit, repaired(rows, audit, 0)

    def report(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row for each conversation."""
        schema = [*((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
        kinds = f"conv_id {self.conv}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"

        def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for r in records([batch]):
                    counts, audit, lines = Repair.alone(r["rows"])
                    rows.append((r["conv"], *counts, audit, hashlib.sha256("\n".join(f"{a}:{t}" for a, t in lines).encode()).hexdigest()))
                yield batch_of([("conv_id", batch.schema.field(0).type), *schema], rows)

        def large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashing, audit, begun = hashlib.sha256(), [], False
            for batch in batches:
                for r in records([batch]):
                    audit.append(r["audit"])
                    for x in r["rows"]:
                        hashing.update(f"{chr(10) if begun else ''}{x['role']}:{x['text']}".encode())
                        begun = True
                    if r["counts"]:
                        yield batch_of([("conv_id", batch.schema.field(0).type), *schema], [(r["conv"], *r["counts"], "".join(audit), hashing.hexdigest())])
                        hashing, audit, begun = hashlib.sha256(), [], False

        parts = self.parts().repartition(self.slices, "conv").sortWithinPartitions("conv", "sid")
        whole = self.segments.filter("alone").select("conv", "rows").mapInArrow(small, kinds)
        return whole.unionByName(parts.mapInArrow(large, kinds))

    def rows(self) -> DataFrame:
        """(conv_id, segment, position, role, text): the repaired rows; positions count within a segment, segments are ordered by number."""

        def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in records([batch]):
                    lines = Repair.alone(r["rows"])[2]
                    yield batch_of([("conv_id", batch.schema.field(0).type), ("segment", pa.int64()), ("position", pa.int32()), ("role", pa.string()), ("text", pa.string())], [(r["conv"], r["sid"], k, a, t) for k, (a, t) in enumerate(lines)])

        whole = self.segments.filter("alone").select("conv", "sid", "rows").mapInArrow(small, f"conv_id {self.conv}, segment long, position int, role string, text string")
        parts = self.parts().select(F.col("conv").alias("conv_id"), F.col("sid").alias("segment"), F.posexplode("rows").alias("position", "r"))
        return whole.unionByName(parts.select("conv_id", "segment", "position", "r.role", "r.text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that the checksum of conversation and turn names; a null counts as one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    body = F.when(kind == 1, "").when(kind == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text"))
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = conversations.filter(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(text("role")).alias("role"), body.alias("text"), times.alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("times").alias("_")).drop("_")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = Repair(damaged(conversations)).report().withColumnRenamed("conv_id", "c")
    every = conversations.select("conv_id").distinct()
    out = every.join(found.hint("merge"), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    zeros = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in COUNTS]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
