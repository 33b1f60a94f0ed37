"""Readers by byte ranges: one file, many tasks, the rows of a reader that takes the file whole."""

import csv
import io
import json
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerwatch.sources import ranges as R
from ledgerwatch.sources import tables as S


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def states(lines, separator, start):
    """The state after each line, character by character."""
    out, inside = [], start
    for line in lines:
        field_start, k = not inside, 0
        while k < len(line):
            c = line[k]
            if inside:
                if c == '"':
                    if line[k + 1 : k + 2] == '"':
                        k += 1
                    else:
                        inside = False
            elif c == '"' and field_start:
                inside = True
            field_start = not inside and c == separator
            k += 1
        out.append(inside)
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", ";", '"', 'b""c', '";"', "é"]), max_size=7).map("".join), min_size=1, max_size=8), st.booleans())
def test_states_of_lines(lines, start):
    out, inside = R.line_ends(pa.array(lines), ";")
    assert R.inside_after(out, inside, start).tolist() == states(lines, ";", start)


def rows(n, seed=1):
    rng = random.Random(seed)
    words = ["x", "two\nlines", 'say "so"', "a;b", "", "é", "\n\n", '"', "\n;\"\n", "long " * 60, " s "]
    return [[str(k), *(rng.choice(words) for _ in range(3))] for k in range(n)]


@pytest.mark.parametrize("end,bom", [("\n", ""), ("\r\n", "﻿"), ("\n", "﻿")])
def test_csv_of_one_file(spark, small_ranges, tmp_path, end, bom):
    every = rows(60)
    for name, table in (("one", every), ("two", every[:1]), ("three", [])):
        text = io.StringIO(newline="")
        csv.writer(text, delimiter=";", lineterminator=end, quoting=csv.QUOTE_MINIMAL).writerows([["representants_id", "denomination", "ville", "other"], *table])
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-x.csv").write_bytes((bom + text.getvalue().replace("\r\n", "\n").replace("\n", end) if end == "\n" else bom + text.getvalue()).encode())
    lines = R.units(spark, str(tmp_path), "\n", "part-*.csv")
    assert lines.filter("start > 0").count() > 20
    got = S.read_register_csv(spark, str(tmp_path), "rep_info", "part-*.csv").select("representants_id", "denomination", "ville")
    whole = spark.read.options(sep=";", header=True, multiLine=True, escape='"', recursiveFileLookup=True, pathGlobFilter="part-*.csv").csv(str(tmp_path))
    key = lambda r: tuple("" if x is None else f"={x}" for x in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, whole.selectExpr("cast(representants_id as long)", "denomination", "ville").collect()))
    assert got.count() == 61


def test_meeting_csv_has_keywords(spark, small_ranges, tmp_path):
    head = "title,member_id,member_name,meeting_date,member_capacity,procedure_reference,attendees,lobbyist_id\n"
    for word, n in (("nicotine", 40), ("two words", 3)):
        (tmp_path / f"{word}.csv").write_text("﻿" + head + "".join(f'"A, b\n""{k}""",{k},N,2024-01-0{k % 9 + 1},Member,,a|b,\n' for k in range(n)))
    got = S.read_meeting_csv(spark, str(tmp_path))
    before = spark.read.schema(got.drop("keyword").schema).options(header=True, multiLine=True, escape='"').csv(str(tmp_path)).withColumn("keyword", F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.csv)?$", 1))
    assert sorted(map(str, got.collect())) == sorted(map(str, before.collect()))
    assert got.groupBy("keyword").count().count() == 2


VALUES = st.recursive(st.none() | st.booleans() | st.integers(-5, 5) | st.text('a}{][",:\\é\n', max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text('k}"\\', max_size=3), x, max_size=3), max_leaves=6)


@settings(max_examples=150, deadline=None)
@given(st.lists(VALUES, min_size=1, max_size=5), st.integers(0, 1))
def test_structure(values, parity):
    text = json.dumps(values, ensure_ascii=False)
    own = R.Structure(pa.array(text.split("}")))
    assert own.bytes.tobytes().decode() == text + "}"
    at, depth = own.depth(0)
    level, inside, k, want = 0, False, 0, []
    while k < len(text):
        c = text[k]
        if inside:
            k += c == "\\"
            inside = c != '"'
        elif c == '"':
            inside = True
        elif c in "[{]}":
            level += 1 if c in "[{" else -1
            want.append((len(text[:k].encode()), level))
        k += 1
    assert list(zip(at.tolist(), depth.tolist(), strict=True))[:-1] == want


def records(n):
    rng = random.Random(2)
    texts = ["}", "{", '"', "\\", '\\"}', "], [", "é", "x" * 250, "NaN", "a\nb"]
    return [{"id": k, "name": rng.choice(texts), "tags": [rng.choice(texts) for _ in range(k % 3)], "by": {rng.choice(texts): k}} for k in range(n)]


SCHEMA = "id bigint, name string, tags array<string>, by map<string,bigint>"


@pytest.mark.parametrize("indent", [None, 2])
def test_json_of_one_file(spark, small_ranges, tmp_path, indent):
    every = records(50)
    files = {"plain": every, "wrapped": {"meta": {"rows": [{"id": -1}], "of": {"a": {"b": []}}}, "rows": every, "after": {"rows": [{"id": -2}], "x": {}}}}
    for name, value in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text(json.dumps(value, indent=indent, ensure_ascii=False) + "\n" * (indent or 0))
        (tmp_path / name / "b.json").write_text(json.dumps([] if name == "plain" else {"rows": []}, indent=indent))
    assert R.units(spark, str(tmp_path / "plain"), "}").filter("start > 0").count() > 20
    want = sorted((r["id"], None if r["name"] == "NaN" else r["name"], r["tags"], r["by"]) for r in every)
    for name, field in (("plain", None), ("wrapped", "rows")):
        got = S.read_json_records(spark, str(tmp_path / name), SCHEMA, field)
        assert sorted((r.id, r.name, r.tags, r.by) for r in got.collect()) == want
        assert json_texts(spark, tmp_path / name, field) < 1500


def json_texts(spark, path, field):
    """The longest string that any task holds as a record."""
    return max(len(r.text) for r in R.json_records(spark, str(path), field).collect())


def test_json_of_one_object_and_of_nulls(spark, small_ranges, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 7, "by": {"a": 1}, "name": "%s"}\n' % ("}" * 300))
    (tmp_path / "b.json").write_text('[null, {"id": 8}, null, {"id": 9, "name": NaN}, null]')
    got = S.read_json_records(spark, str(tmp_path), SCHEMA)
    assert sorted((r.id or 0, r.name) for r in got.collect() if r.id) == [(7, "}" * 300), (8, None), (9, None)]


@pytest.mark.parametrize("field", [None, "organisations"])
def test_keyed_json_of_one_file(spark, small_ranges, tmp_path, field):
    every = {f"k{k}\\}}\"": {"error": "down"} if k % 7 == 0 else {"name": f"}}n{k}\"", "budget_by_year": [] if k % 3 == 0 else {"2023": k, "2024": None}} for k in range(60)}
    value = {"as_of": {"day": {"x": 1}}, "organisations": every, "then": [{"name": "no"}]} if field else every
    (tmp_path / "a.json").write_text(json.dumps(value, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({field: {}} if field else {}))
    got = S.read_keyed_json(spark, str(tmp_path), "struct<name:string,budget_by_year:map<string,double>>", field)
    want = sorted((k, v["name"], {y: None if b is None else float(b) for y, b in v["budget_by_year"].items()} or None if v["budget_by_year"] else None) for k, v in every.items() if "error" not in v)
    assert sorted((r.key, r.value.name, r.value.budget_by_year) for r in got.collect()) == want
    plain = S.read_keyed_json(spark, str(tmp_path), "map<string,string>", field)
    assert sorted(r.key for r in plain.collect()) == [k for k, _, _ in want]
