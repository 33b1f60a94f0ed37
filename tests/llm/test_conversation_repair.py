import hashlib
import re
import zlib
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwatch.llm import conversation_repair as cr

PATTERN = re.compile(r"(s?(ua)+)?")


def marks_of(rows):
    """First fault of each (turn, role, text)."""
    out, seen = [], []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.append((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) from the last row backwards, over all prefixes of the pattern by their last initials."""
    marks = marks_of(rows)

    @cache
    def best(i, said, inserts):
        some = []
        if i == len(rows):
            if PATTERN.fullmatch(said):
                some.append((0, "", ()))
        else:
            role, text = rows[i][1:]
            some.append((2, "D", i + 1, said, ()))
            if marks[i] not in ("blank", "duplicate"):
                more = 5 * (marks[i] == "truncated")
                if role:
                    some.append((more, "K", i + 1, said + role[0], ((role, text),)))
                some += [(1 + more, "R", i + 1, said + r[0], ((r, text),)) for r in ("user", "assistant")]
        if inserts < 2:
            some += [(5, "I", i, said + r[0], ((r, ""),)) for r in ("user", "assistant")]
        out = [x for x in some if len(x) == 3]
        for cost, letter, j, text_said, lines in (x for x in some if len(x) == 5):
            short = re.sub(r"^(s?)(?:ua)+(?=ua|u?$)", r"\1ua", text_said)  # what can follow depends on the end alone
            if any(PATTERN.fullmatch(text_said + t) for t in ("", "a", "ua")) and (rest := best(j, short, inserts + 1 if letter == "I" else 0)):
                out.append((cost + rest[0], letter + rest[1], lines + rest[2]))
        return min(out, key=lambda x: x[:2], default=None)

    return best(0, "", 0)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def reported(rows):
    marks, (cost, audit, lines) = marks_of(rows), cheapest(rows)
    turns = [t for t, _, _ in rows if t is not None]
    bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(marks.count, ("blank", "duplicate", "truncated")), bad, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in lines)))


def expected(table):
    found = {}
    for conv, turn, role, text in table:
        own = found.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return sorted((("" if c is None else c, *reported(sorted(own, key=order))) for c, own in found.items()), key=str)


rows_strategy = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "other", "s", "", "ux"]), st.sampled_from(["", " \n", "Hi.", "So", "x!", "y?  ", "."])), max_size=7)


@settings(max_examples=300, deadline=None)
@given(rows_strategy)
def test_alone_is_cheapest(rows):
    rows = [(k, *r) for k, r in enumerate(rows)]
    if rows:
        counts, audit, lines = cr.Repair.alone([{"turn": t, "role": r, "text": x} for t, r, x in rows])
        assert (*counts, audit, sha("\n".join(f"{r}:{t}" for r, t in lines))) == reported(rows)


def table(seed, n=60):
    rng = np.random.default_rng(seed)
    out = []
    for conv in [*range(n), None]:
        for turn in range(int(rng.integers(0, 12))):
            role = str(rng.choice(["system", "user", "assistant", "user", "assistant", "tool"]))
            text = str(rng.choice(["Hello.", "What?", "cut of", "é!", "", "  ", "Same."])) + str(rng.choice(["", "", f" {turn}."]))
            out.append((conv, None if rng.random() < 0.05 else int(turn + rng.integers(0, 2)), None if rng.random() < 0.03 else role, None if rng.random() < 0.03 else text))
    out += [(n + 1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t % 40}." if t % 7 else "again") for t in range(90)] + [(n + 2, 3, "user", "Twice.")] * 9 + [(n + 3, None, None, None)]
    return out


@pytest.mark.parametrize("seed,segment", [(1, 512), (2, 3), (3, 1)])
def test_query_equals_brute_force(spark, monkeypatch, tmp_path, seed, segment):
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rows = table(seed)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS sid", "1 AS conv", "2 AS cost").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in cr.op12_conversation_repair(spark, str(tmp_path)).collect()]
    assert sorted((("" if r[0] is None else r[0], *r[1:]) for r in got), key=str) == expected(rows)


def test_repaired_rows(spark):
    rows = [("x", 0, "user", "One."), ("x", 1, "user", "Two."), ("x", 2, "user", "Two."), ("y", 0, "assistant", "A" * 200_000)]
    docs = spark.createDataFrame(rows, "c string, t int, r string, b string")
    got = [tuple(r) for r in cr.Repair(docs, "c", "t", "r", "b").rows().orderBy("conv_id", "segment", "position").select("conv_id", "role", "text").collect()]
    assert got == [("x", "user", "One."), ("x", "assistant", "Two.")]
    assert {r.conv_id: (r.cost, r.audit) for r in cr.Repair(docs, "c", "t", "r", "b").report().collect()} == {"x": (3, "KRD"), "y": (2, "D")}
    assert cr.Repair(docs.limit(0), "c", "t", "r", "b").report().count() == 0
