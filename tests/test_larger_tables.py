"""What shows on larger tables only: values that the small ones don't have, and how the work is dealt out."""

import os
import random
import re
import unicodedata
from html.parser import HTMLParser

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import extract as X
from ledgerwatch.operators import reconcile as R
from ledgerwatch.operators.html import Tree
from ledgerwatch.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def held_against_sql(spark, name, folder, **tables):
    """The query's rows over tables that are written to a folder, after they were found to be those of its SQL."""
    c = duckdb.connect()
    for t, rows in tables.items():
        pq.write_table(rows, f"{folder}/{t}.parquet")
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = registry.QUERIES[name](spark, str(folder))
    want = c.sql(registry.ORACLES[name])
    rows = [tuple(r) for r in got.select(*want.columns).collect()]
    assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr)
    return rows


def read(table, rows=None):
    found = pq.read_table(f"{SF}/{table}.parquet")
    return found if rows is None else found.slice(0, rows)


def test_budgets_of_half_a_unit(spark, tmp_path):
    """A balance between two whole numbers goes to the even one."""
    halves = [0.5, 1.5, 2.5, -0.5, -1.5, -2.5, 5678.5, 5679.5, 7.49, 7.51]
    keys = pa.array([3 * k + 1 for k in range(len(halves))], pa.int64())
    supplier = pa.table({"s_suppkey": keys, "s_name": pa.array(["s"] * len(keys)), "s_nationkey": pa.array([1] * len(keys), pa.int32()), "s_acctbal": pa.array(halves)})
    held_against_sql(spark, "j13_merge_entities", tmp_path, supplier=supplier, customer=read("customer"))


def listed(spark, rows):
    return spark.createDataFrame(rows, "k int, n int, name string")


def test_lists_of_names_meet_by_joins(spark):
    """The same as over arrays, with repeats, names without letters, null names and null keys; and the query compares no arrays."""
    r = random.Random(3)
    word = lambda: r.choice([None, "", "--", "é", "ab", "Abé", "lab", "xab y", "q", "Zoé & co", "zoe", "nobody", "a"])
    left, right = ([(r.choice([None, 1, 2, 3]), n, word()) for n in range(40)] for _ in range(2))
    left.append((4, 0, "alone"))
    got = {x.k: (x.left_only, x.right_only, x.mismatch) for x in R.reconcile_lists(listed(spark, left), listed(spark, right), ["k"], "n").collect()}
    arrays = [(k, [x[2] for x in left if x[0] == k], [x[2] for x in right if x[0] == k]) for k in (None, 1, 2, 3, 4)]
    want = spark.createDataFrame(arrays, "k int, a array<string>, b array<string>").select("k", R.reconcile_names(F.col("a"), F.col("b")).alias("r")).collect()
    assert got == {x.k: (x.r.left_only, x.r.right_only, x.r.mismatch) for x in want}
    norm = lambda s: " ".join(re.sub("[^a-z0-9]+", " ", "".join(c for c in unicodedata.normalize("NFD", s or "").lower() if c.isascii())).split())
    alone = lambda x, y: [a for a in x if not any(norm(a) and norm(b) and (norm(a) in norm(b) or norm(b) in norm(a)) for b in y)]
    assert {k: v[:2] for k, v in got.items()} == {k: (alone(a, b), alone(b, a)) for k, a, b in arrays}
    assert "exists(" not in registry.QUERIES["j12_reconcile_names"](spark, SF)._jdf.queryExecution().toString()


def test_sizes_without_names_or_without_a_size(spark, tmp_path):
    sizes = pa.array([None, None, 7, 8, 8, 9], pa.int32())
    part = pa.table({"p_partkey": pa.array([8, 15, 3, 1, 2, 4], pa.int64()), "p_name": ["hot bolt", "a bolt", "x y", "a ring", "big ring", "cold nut"], "p_size": sizes})
    rows = held_against_sql(spark, "j12_reconcile_names", tmp_path, part=part)
    assert (7, "", "", False) in rows and (None, "", "", False) in rows


@pytest.mark.parametrize("name", ["x1_parse_forms", "x3_parse_meeting_lists", "x4_extract_register_fields", "x5_extract_accredited", "x6_extract_search_results", "x7_extract_embedded_json"])
def test_rows_of_one_file_are_parsed_by_several_tasks(spark, name):
    """Tables of one small file stand for long texts."""
    assert registry.QUERIES[name](spark, SF).select(F.spark_partition_id().alias("task")).distinct().count() > 1


class Slow(Tree):
    """Without the short ways for plain tags."""

    parse_starttag, parse_endtag, updatepos = HTMLParser.parse_starttag, HTMLParser.parse_endtag, HTMLParser.updatepos


def test_short_ways_for_plain_tags_give_the_same_trees():
    flat = lambda n: (n.tag, n.attrs, [k if isinstance(k, str) else flat(k) for k in n.kids])
    r, tags = random.Random(1), "p li ul td tr table a div script style title textarea option br body plaintext".split()
    bits = ["a &amp; b", " ", "<", "</", "</>", "<!-- c -->", "<!doctype html>", "&", "<p", "<P>", "</P>", "<p/>", "</p >", "<a href='x>y'>", "<1>", "<script>if (a<b) '</p>'", "</script>"]
    for _ in range(5000):
        page = "".join(r.choice(bits) if r.random() < 0.4 else f"<{r.choice(['', '/'])}{r.choice(tags)}>" for _ in range(r.randint(0, 20)))
        assert flat(Tree(page).root) == flat(Slow(page).root), page


class Library(Slow):
    """Without the look-up of plain tags too."""

    feed = HTMLParser.feed


def test_looked_up_tags_give_the_same_trees():
    flat = lambda n: (n.tag, n.attrs, [k if isinstance(k, str) else flat(k) for k in n.kids])
    r, tags = random.Random(2), "p li ul td tr table div script style title textarea option br body plaintext".split()
    bits = ["a &amp; b", "&", "&am", "x > y", " ", "\r\n", "<", "</", "<1", "<!-- c -->", "<!doctype html>", "<P>", "<p/>", '<p class="a b">', '<p class="a" class="b">', '<a href="?x=1&amp;y=2&copy=3">', '<a href="x>y">', '<a href="x<y">', "<a href='x'>", '<a href="x"id="y">', '<td colspan="2" id="">', '<a href="', '<script src="x">', "</script>", "</p class='x'>"]
    for _ in range(5000):
        page = "".join(r.choice(bits) if r.random() < 0.5 else f"<{r.choice(['', '/'])}{r.choice(tags)}>" for _ in range(r.randint(0, 20)))
        assert flat(Tree(page).root) == flat(Library(page).root), page


def test_the_library_reads_each_plain_tag_once(monkeypatch):
    """The time of large tables was that of its search in each page's tags."""
    page = '<table><tr class="ecl-table__row"><td><strong>Objectifs &amp; mandat</strong></td><td>%s</td></tr></table>'
    first, calls, read = X.register_fields(Tree(page % 1).root), [], HTMLParser.parse_starttag
    monkeypatch.setattr(HTMLParser, "parse_starttag", lambda self, i: calls.append(i) or read(self, i))
    assert [X.register_fields(Tree(page % n).root)["objectives"] for n in (2, 3)] == ["2", "3"] and first["objectives"] == "1" and not calls
    assert Tree("<p><em data-n=5>").root.all("em")[0].attrs == {"data-n": "5"} and calls


def test_layout_forms_look_for_all_labels_at_once(spark):
    """Of two lines with a label the first counts; a line without the label word has no columns; and no kind takes a pass of its own."""
    lines = [(2, 1.0, "Montant total annuel € 9"), (1, 50.0, "Montant total annuel € 1 2,50 x"), (1, 90.0, "Montant total annuel € 7"), (1, 9.0, "Dénomination socialement"), (1, 20.0, "Dénomination sociale Ann Co")]
    words = [(f, page, n, text, 30.0 * n, 30.0 * n + (5.0 if text in ("€", "sociale") else 20.0), top) for f in ("a", "b") for page, top, line in lines for n, text in enumerate(line.split()) if f == "a" or top < 10]
    df = spark.createDataFrame(words, "file string, page int, ord int, text string, x0 double, x1 double, top double")
    got = {r.file: (r.org_name, r.employees, r.n_providers, r.total) for r in X.parse_layout_forms(df).collect()}
    assert got == {"a": (None, 12, 0, 12), "b": (None, 9, 0, 9)}
    plan = registry.QUERIES["x2_parse_layout_forms"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2


def test_words_of_lines_are_dealt_out_once_and_to_more_tasks(spark):
    plan = registry.QUERIES["w4_split_columns"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "REPARTITION_BY_NUM" in plan
