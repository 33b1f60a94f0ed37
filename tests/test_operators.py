"""Edge rows of the register operators, on hand-made fixtures with invented names."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerwatch.functions import keywords as K
from ledgerwatch.functions import predicates as P
from ledgerwatch.functions import schemas
from ledgerwatch.functions import text as X
from ledgerwatch.operators import exercises as E
from ledgerwatch.operators import extract as T
from ledgerwatch.operators import matching as M
from ledgerwatch.operators import meetings as A
from ledgerwatch.operators import providers as V
from ledgerwatch.operators import reconcile as R
from ledgerwatch.operators import registry as G
from ledgerwatch.operators import windows as W
from ledgerwatch.sources import tables as S
from ledgerwatch.streaming import incremental as I


def one(spark, column, value=None):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("x")).first().x


def test_amounts(spark):
    v = F.col("v")
    assert one(spark, X.parse_amount(v), "12 500 €") == 12500
    assert one(spark, X.parse_amount(v), "none") is None
    assert one(spark, X.parse_amount(v, "layout"), "1 234,56 €") == 1234
    assert one(spark, X.parse_amount(v, "strict"), "1 234 €") == 1234
    assert one(spark, X.parse_amount(v, "strict"), "about 5") is None


def test_fold_flavours(spark):
    assert one(spark, X.fold(F.col("v")), "Œuvre ÉTÉ ß") == "œuvre ete ß"
    assert one(spark, X.fold(F.col("v"), ascii_only=True), "Œuvre ÉTÉ ß") == "uvre ete "
    assert one(spark, X.fold_exact(F.col("v")), "ﬁn É") == "fin e"
    assert one(spark, X.norm_name(F.col("v")), "Bat_Co. & Fils") == "bat co fils"
    assert one(spark, X.fold(F.col("v"))) is None and one(spark, X.norm_name(F.col("v"))) == ""


def test_dates(spark):
    assert str(one(spark, X.iso_date(F.col("v")), "05/03/2024 at noon")) == "2024-03-05"
    assert one(spark, X.iso_date(F.col("v")), "31/02/2024") is None
    assert one(spark, X.register_ts(F.col("v")), "31-02-2024 10:00") is None
    assert str(one(spark, X.register_ts(F.col("v")), "01-01-2024 23:59")) == "2024-01-01 23:59:00"


def test_keyword_is_a_substring_and_null_is_none(spark):
    df = spark.createDataFrame([(1, "CIGARETTE"), (2, None), (3, "x cigar y"), (4, "Tabac électronique")], "i int, t string")
    assert [r.i for r in P.keyword_filter(df, ["t"], ["cigar"]).collect()] == [1, 3]
    assert [r.i for r in P.keyword_filter_folded(df, "t", ["electronique"]).collect()] == [4]
    assert P.keyword_filter(df, ["t"], []).count() == 0


def test_exercise_state_with_nulls(spark):
    df = spark.createDataFrame([(0, None, 0), (0, None, None), (0, None, 500), (None, None, 0), (0, 1.0, 0), (3, None, 0)], "nombre_activites int, nombre_salaries double, montant_depense_inf bigint")
    assert [r.s for r in df.select(P.exercise_state().alias("s")).collect()] == ["unpublished", "published", "means_only", "published", "published", "published"]
    assert P.drop_unpublished(df).count() == 5


def test_names_reconcile_both_ways(spark):
    df = spark.createDataFrame([(["Alpha Conseil", "Beta", ""], ["ALPHA", "Gamma", "Gamma"]), (None, None)], "a array<string>, b array<string>")
    first, none = (r.r for r in df.select(R.reconcile_names(F.col("a"), F.col("b")).alias("r")).collect())
    assert first.left_only == ["Beta", ""] and first.right_only == ["Gamma", "Gamma"] and first.mismatch
    assert not none.mismatch and none.left_only == []


@pytest.mark.parametrize("low,high,filed,want", [(1, 5, 3, False), (1, 5, 9, True), (None, None, 3, True), (1, 5, None, True), (None, None, None, False), (1, None, 3, False), (None, 5, None, False)])
def test_budget_mismatch(spark, low, high, filed, want):
    df = spark.createDataFrame([(low, high, filed)], "l bigint, h bigint, f bigint")
    assert df.select(R.budget_mismatch(F.col("l"), F.col("h"), F.col("f")).alias("x")).first().x is want


def test_active_years_bounds(spark):
    df = spark.createDataFrame([("a", "2024-12-31 23:59:00", None), ("b", "2025-01-01 00:00:00", None), ("c", None, "2024-01-01 00:00:00"), ("d", None, "2023-12-31 23:59:00")], "k string, s string, e string")
    rows = V.active_years(df.withColumn("start", F.col("s").cast("timestamp")).withColumn("provider_end", F.col("e").cast("timestamp")), [2024, 2025])
    assert sorted((r.k, r.year) for r in rows.collect()) == [("a", 2024), ("a", 2025), ("b", 2025), ("c", 2024)]


def test_people_and_aliases(spark):
    people = spark.createDataFrame([(1, "Roe", "Jan", 1), (1, " ROE", "jan ", 2), (1, "Roe", "Ann", 3)], "o int, s string, f string, _ord int")
    r = V.distinct_people(people, "o", "s", "f").first()
    assert r.people == ["Ann Roe", "Jan Roe"] and r.n_people == 2


def test_short_ids_start_with(spark):
    actors = spark.createDataFrame([("a", "123456789"), ("b", "1234"), ("c", None)], "actor string, identifiant_national string")
    rel = spark.createDataFrame([("12345678900017",), ("123499999",), (None,)], "identifiant_national_client string")
    got = sorted((r.actor, r.identifiant_national_client) for r in M.provider_relations(actors, rel).collect())
    assert got == [("a", "12345678900017"), ("b", "12345678900017"), ("b", "123499999")]


def test_more_exact_names_than_kept(spark):
    rows = [("q", n, "Q" if n in (1, 11, 12) else f"other {n}") for n in range(1, 15)]
    got = M.resolve_names(spark.createDataFrame([("q",)], "query string"), spark.createDataFrame(rows, "query string, rank int, name string")).collect()
    assert sorted(r.rank for r in got) == [1, 2, 3, 4, 5, 6, 7, 8, 11, 12]


def test_results_do_not_depend_on_partitions(spark):
    rows = [(i % 5, i % 3, f"n{i % 4}|n{i % 7}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, names string, _ord int").withColumn("names", X.split_pipe(F.col("names")))
    run = lambda d: sorted(A.dedupe_meetings(d, ["a", "b"], ["names"], []).collect())
    assert run(df.repartition(1)) == run(df.repartition(7))
    again = A.dedupe_meetings(df, ["a", "b"], ["names"], [])
    assert sorted(A.dedupe_meetings(again, ["a", "b"], ["names"], []).collect()) == sorted(again.collect())


def test_undated_meetings_come_last(spark):
    feed = spark.createDataFrame([(0, 1, None, "x"), (0, 2, "2024-01-01", "x"), (0, 3, "2024-01-01", "x"), (1, 1, "2025-01-01", "y")], "branch int, _ord int, d string, actor string")
    feed = feed.select("branch", "_ord", F.col("d").cast("date").alias("date"), "actor", F.lit("p").alias("institution"), F.lit(None).cast("string").alias("subject"))
    assert [(r.branch, r._ord) for r in A.latest_meetings(feed, None).collect()] == [(1, 1), (0, 2), (0, 1)]


def test_top_n_without_rest(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1)], "country string, n bigint")
    assert sorted((r.country, r.share) for r in A.top_n_with_other(df, 5).collect()) == [("a", 0.75), ("b", 0.25)]


def test_series_break_at_missing_years(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("b", 3)], "s string, y int")
    assert sorted((r.s, r.y, r.run) for r in W.contiguous_runs(df, "s", "y").collect()) == [("a", 1, 1), ("a", 2, 1), ("a", 4, 2), ("b", 3, 1)]


def test_layout_lines_and_gaps(spark):
    words = [("f", 1, i, t, x, x + 10.0, top) for i, (t, x, top) in enumerate([("a", 0.0, 10.0), ("b", 30.0, 12.5), ("c", 60.1, 10.0), ("d", 0.0, 12.6)])]
    lines = T.group_lines(spark.createDataFrame(words, schemas.WORD)).collect()
    assert sorted((r.text, r.line) for r in lines) == [("a", 10.0), ("b", 10.0), ("c", 10.0), ("d", 12.6)]
    cut = W.split_columns(spark.createDataFrame(words[:3], schemas.WORD), ["file"]).collect()
    assert sorted(r.text for r in cut) == ["a b", "c"]


def test_lines_are_found_in_word_order(spark):
    """A line's top is that of its first word: 12, 10, 14 are one line, 10, 12, 14 are two; on random pages by the rule itself."""
    rng = random.Random(4)
    pages = {("f", 1): [12.0, 10.0, 14.0], ("f", 2): [10.0, 12.0, 14.0]} | {("g", p): [rng.randrange(40) / 2 for _ in range(rng.randrange(1, 25))] for p in range(40)}
    words = [(f, p, i, "w", 0.0, 1.0, top) for (f, p), tops in pages.items() for i, top in enumerate(tops)]
    rng.shuffle(words)
    got = {(r.file, r.page, r.ord): r.line for r in T.group_lines(spark.createDataFrame(words, schemas.WORD).repartition(5)).collect()}
    for (f, p), tops in pages.items():
        lines = []
        for i, top in enumerate(tops):
            line = next((x for x in lines if abs(x - top) <= 2.5), None)
            if line is None:
                lines.append(line := top)
            assert got[f, p, i] == line
    assert {got["f", 1, i] for i in range(3)} == {12.0} and {got["f", 2, i] for i in range(3)} == {10.0, 14.0}


def test_provider_names_of_the_section_alone(spark):
    name = "Dénomination sociale de la Société prestataire\n"
    text = f"Dénomination sociale\nOrg\n{name}Before\nAvez-vous effectué des dÉpenses d'achats de prestations auprès en année 2024 ?\nOui\nMontant total annuel des achats de missions ou prestations x association\n5\n{name.replace('é', chr(0xE9))}Été SA\n8. Avantages en nature\n{name}After"
    r = T.parse_forms(spark.createDataFrame([(text,), (text.replace("Oui", "Non"),)], "text string")).select("providers").collect()
    assert [[tuple(p) for p in x.providers] for x in r] == [[("Été SA", 5)], []]


def test_history_keeps_actors_without_years(spark):
    ex = spark.createDataFrame([(1, 2020, 5, 1), (1, 2020, 7, 2)], "representants_id bigint, annee_fin int, montant_depense_inf bigint, _ord int")
    got = {r.representants_id: r.by_year for r in E.budget_history(spark.createDataFrame([(1,), (2,)], "representants_id bigint"), ex).collect()}
    assert got == {1: {2020: 7}, 2: {}}
    assert E.yearly_totals(ex, "annee_fin", "montant_depense_inf").first().total == 12


def test_merge_entities_zero_and_null(spark):
    kinds = "register_id string, budget_low bigint, budget_high bigint, people_involved int, nb_intermediaries int"
    seed = spark.createDataFrame([("1", 10, 10, 5, 1), ("2", 10, 10, 5, 1), (None, 10, 10, 5, 1)], kinds)
    live = spark.createDataFrame([("1", 0, None, 7, None, None, 3)], kinds + ", intermediaries array<string>, ep_meetings int")
    got = {r.register_id: r for r in G.merge_entities(seed, live).collect()}
    assert (got["1"].budget_low, got["1"].budget_high, got["1"].people_involved, got["1"].ep_meetings, got["1"].intermediaries) == (0, 10, 7, 3, [])
    assert got["2"].ep_meetings is None and got["2"].has_register_id and not got[None].has_register_id


def test_accreditations(spark):
    people = lambda rows: spark.createDataFrame(rows, schemas.ACCREDITED.replace("start_date date", "d string")).select("register_id", "surname", "first_name", F.col("d").cast("date").alias("start_date"))
    previous = people([("a", "Old", "X", "2024-01-01"), ("a", "Null", "X", None), ("f", "Old", "X", None)])
    current = people([("a", "Old", "X", "2024-01-01"), ("a", "Null", "X", None), ("a", "New", "X", None), ("a", "Seen", "X", None), ("e", "First", "X", None), ("n", "Base", "X", None), ("f", "New", "X", None)])
    seen = people([("a", "Seen", "X", None)])
    base = spark.createDataFrame([("a",), ("e",), ("f",)], "register_id string")
    fetched = spark.createDataFrame([("a", True), ("e", True), ("n", True), ("f", False)], "register_id string, ok boolean")
    got = sorted((r.register_id, r.surname) for r in I.detect_accreditations(previous, current, seen, base, fetched).collect())
    assert got == [("a", "New"), ("e", "First")]
    kept = {(r.register_id, r.surname) for r in I.next_baseline(previous, current, fetched).collect()}
    assert ("f", "Old") in kept and ("f", "New") not in kept and ("a", "New") in kept


def test_backfill_only_while_small(spark):
    results = spark.createDataFrame([("a", 0, "1", "none", None), ("b", 1, "1", "vape", None), ("b", 1, "2", "vape", None)], "keyword string, kw_ord int, id string, name string, objectives string").withColumn("registration_date", F.lit(None).cast("date"))
    small = spark.createDataFrame([], I.STORE)
    assert [r.id for r in I.backfill_registrants(results, small, ["vape"], "t").collect()] == ["2"]
    full = spark.createDataFrame([(str(i), "", None, "", "") for i in range(100, 110)], I.STORE)
    assert I.backfill_registrants(results, full, ["vape"], "t").count() == 0


def test_sources(spark, tmp_path):
    deep = tmp_path / "export" / "csv"
    deep.mkdir(parents=True)
    (deep / "1_informations_generales.csv").write_text('representants_id;denomination;identifiant_national;ville;dateCessation\n1;"Société\nÀ";00123;Lyon;\nx;B;NaN;;01-01-2024 10:00\n', encoding="utf-8")
    info = {r.denomination: r for r in S.read_register_csv(spark, str(tmp_path / "export"), "rep_info").collect()}
    assert info["Société\nÀ"].representants_id == 1 and info["Société\nÀ"].identifiant_national == "00123" and info["B"].representants_id is None
    (tmp_path / "snus.csv").write_text("﻿title,member_id,member_name,meeting_date,member_capacity,procedure_reference,attendees,lobbyist_id\nT,7,Jo,2024-01-02,Member,,a|b,\n", encoding="utf-8")
    r = S.read_meeting_csv(spark, str(tmp_path / "snus.csv")).first()
    assert (r.title, r.keyword, str(r.meeting_date)) == ("T", "snus", "2024-01-02")
    (tmp_path / "r.json").write_text('[{"a": "NaN", "b": 1}, {"a": "x"}]')
    assert [tuple(r) for r in S.read_json_records(spark, str(tmp_path / "r.json"), "a string, b bigint").collect()] == [(None, 1), ("x", None)]
    (tmp_path / "w.json").write_text(json.dumps({"meetings": [{"a": "p"}, {"a": "q"}]}))
    assert [r.a for r in S.read_json_records(spark, str(tmp_path / "w.json"), "a string", "meetings").collect()] == ["p", "q"]
    (tmp_path / "k.json").write_text(json.dumps({"organisations": {"1": {"name": "A", "budget_by_year": {"2023": 5}}, "2": {"name": "B", "budget_by_year": []}, "3": {"error": "down"}}}))
    got = {r.key: r.value for r in S.read_keyed_json(spark, str(tmp_path / "k.json"), "struct<name:string,budget_by_year:map<string,double>>", "organisations").collect()}
    assert got["1"].budget_by_year == {"2023": 5.0} and set(got) == {"1", "2"} and not got["2"].budget_by_year
    out = str(tmp_path / "years")
    frame = lambda rows: spark.createDataFrame(rows, "v int, source_year int")
    S.write_yearly(frame([(1, 2023), (2, 2024)]), out)
    S.write_yearly(frame([(3, 2024)]), out)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, 2023), (3, 2024)]
    assert S.read_pages(spark, str(tmp_path / "w.json")).first().text.startswith("{")


def test_keywords_of_actors(spark):
    actors = spark.createDataFrame([("a", ["vape", "é", None]), ("b", ["x"]), ("c", []), ("d", ["nicotine pouch"]), ("e", None)], "actor string, keywords array<string>")
    rows = [(1, 2020, "Vape shop", None), (2, 2020, "vapes x", "vape"), (3, 2021, None, "Nicotine"), (4, 2021, "a nicotine", "pouch"), (5, 2021, "x", ""), (6, 2022, None, None), (7, None, "vape", None)]
    records = spark.createDataFrame(rows, "_ord int, source_year int, one string, two string")
    got = sorted(((r.actor, r.source_year or 0, r._ord, r.one, r.n_matches) for r in M.match_by_keywords(actors, records, ["one", "two"]).collect()))
    assert got == [("a", 0, 7, "vape", 1), ("a", 2020, 1, "Vape shop", 2), ("b", 2020, 2, "vapes x", 1), ("b", 2021, 5, "x", 1), ("d", 2021, 4, "a nicotine", 1)]


def test_a_hundred_thousand_keywords(spark, monkeypatch):
    """As the nested loop, in one block of keywords and in several."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    keywords = {f"a{k}": [word(rng.randint(5, 9)) for _ in range(5)] for k in range(20_000)}
    texts = [word(60) for _ in range(150)] + [" ".join(rng.choice(list(keywords.values()))) for _ in range(50)] + ["", None]
    want = sorted((a, k) for k, t in enumerate(texts) for a, own in keywords.items() if t and any(w in t for w in own))
    actors = spark.createDataFrame(list(keywords.items()), "actor string, keywords array<string>")
    hay = spark.createDataFrame(list(enumerate(texts)), "k int, _hay string")
    for most in (K.MOST_CHARACTERS, 200_000):
        assert sorted((r.actor, r.k) for r in K.actors_in(actors, hay, most).collect()) == want and len(want) > 200


def test_long_lists_of_words(spark):
    """The automaton's predicates give what the built-in ones give."""
    df = spark.createDataFrame([(1, "Vape Shop"), (2, "none"), (3, None), (4, "nicotiné")], "k int, t string")
    many = [f"w{k}" for k in range(K.FEW)]
    for words in (["vape", "shop"], ["nicotine"], [""]):
        for few, long in ((words, words + many),):
            assert [tuple(r) for r in P.keyword_filter(df, ["t"], long, "m").collect()] == [tuple(r) for r in P.keyword_filter(df, ["t"], few, "m").collect()]
            assert [r.k for r in P.keyword_filter_folded(df, "t", long).collect()] == [r.k for r in P.keyword_filter_folded(df, "t", few).collect()]
            assert [r.k for r in P.exclude_names(df, "t", long).collect()] == [r.k for r in P.exclude_names(df, "t", few).collect()]


def test_one_client_with_most_relations_is_dealt_out(spark):
    actors = spark.createDataFrame([(1, "123456789" + "00011"), (2, "123456789" + "00022"), (3, "987654321x"), (4, "55"), (5, "")], "k int, identifiant_national string")
    rel = spark.range(2000).selectExpr("id AS r", "CASE WHEN id % 3 = 0 THEN '12345678900099' WHEN id % 5 = 0 THEN '987654321' WHEN id % 7 = 0 THEN '5599' ELSE cast(id AS string) END AS identifiant_national_client").repartition(4)
    plain, dealt = (M.provider_relations(actors, rel, heavy=n) for n in (10_000, 50))
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect())) and dealt.filter("k < 3").count() == 2 * 667
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = M.provider_relations(actors, rel, heavy=50).filter("k = 1").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 2 and M.provider_relations(actors, rel, heavy=10_000).filter("k = 1").select(F.spark_partition_id().alias("p")).distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_top_names_are_cut_before_they_meet(spark):
    queries = spark.createDataFrame([("A b",), ("none",), (None,)], "query string")
    rows = [("A b", k, f"n{k}", k * 2) for k in range(40)] + [("A b", 100 + k, " a B ", -k) for k in range(3)] + [("other", 1, "other", 0)] + [("none", 5, None, 1)]
    results = spark.createDataFrame(rows, "query string, rank int, name string, more int").repartition(4)
    got = M.resolve_names(queries, results)
    assert sorted((r.query, r.position, r.rank, r.exact) for r in got.collect()) == sorted([("A b", k + 1, 100 + k, True) for k in range(3)] + [("A b", k + 4, k, False) for k in range(7)] + [("none", 1, 5, False)])
    assert M.resolve_names(queries, results.filter("rank >= 100"), 2).count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_long_lists_of_names(spark):
    rng = random.Random(5)
    name = lambda: " ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 3)))
    left, right = ([(k % 3, i, rng.choice([name(), name().upper(), "", None])) for i, k in enumerate(range(200))] for _ in range(2))
    kinds = "key int, i int, name string"
    got = R.unmatched_names(spark.createDataFrame(left, kinds), spark.createDataFrame(right, kinds), ["key"])
    arrays = lambda rows, key: F.array(*(F.lit(n) for k, _, n in rows if k == key))
    for key in range(3):
        r = spark.range(1).select(R.reconcile_names(arrays(left, key), arrays(right, key)).alias("r")).first().r
        for side, want in (("left", r.left_only), ("right", r.right_only)):
            assert [x.name for x in got.filter(f"key = {key} and side = '{side}'").orderBy("i").collect()] == want


def test_ten_thousand_names_by_as_many(spark):
    rng = random.Random(6)
    names = lambda n: [(1, i, f"{rng.randrange(3000)} firm {rng.choice('abc')} {'x' * rng.randrange(3)}") for i in range(n)]
    left, right = names(10_000), [(1, i, n[2:] if i % 2 else n + " group") for _, i, n in names(10_000)]
    kinds = "key int, i int, name string"
    got = {(r.side, r.i) for r in R.unmatched_names(spark.createDataFrame(left, kinds), spark.createDataFrame(right, kinds), ["key"]).collect()}
    a, b = ([" ".join(n.split()) for _, _, n in rows] for rows in (left, right))
    hold = lambda xs, ys: {i for i, x in enumerate(xs) if not any(x in y or y in x for y in ys)}
    some = range(0, 10_000, 97)
    assert {i for s, i in got if s == "left" and i % 97 == 0} == {some[k] for k in hold([a[i] for i in some], set(b))}
    assert {i for s, i in got if s == "right" and i % 97 == 0} == {some[k] for k in hold([b[i] for i in some], set(a))}


def test_meeting_lists_without_header_or_date(spark):
    texts = [
        "1 A 01/02/2024 x\n5 not an entry\n2 nobody\n3 B-\nC, 03/04/2024 y\nReferences 4 z 01/01/1999",
        "Head 1 no\nSubject(s)\n\n 1\nAnn\u00a0 Example , 05/06/2023\n2 rooms 07/08/2023\n2 Cab, DG 09/10/2023",
        "Subject(s) nothing", "", None,
    ]
    got = [tuple(r) for r in T.parse_meeting_lists(spark.createDataFrame(list(enumerate(texts)), "register_id int, text string")).collect()]
    assert sorted(got) == [
        ("0", 1, "2024-02-01", "A", "x 5 not an entry"), ("0", 2, "2024-04-03", "B-C", "y"),
        ("1", 1, "2023-06-05", "Ann Example ", ""), ("1", 2, "2023-08-07", "rooms", "2 Cab, DG 09/10/2023"),
    ]


def test_register_rows(spark):
    row = "<tr class='ecl-table__row'><td><strong>%s</strong></td><td>%s</td></tr>"
    page = "<table>" + "".join(row % x for x in [
        ("Nombre total de personnes concernées :", "12"), ("Intermédiaires – exercice en cours", "none listed"), ("Estimation des coûts annuels", "<span><span>10\u00a0000\u202f€</span></span>"),
        ("Date d’enregistrement", "n/a"), ("Affiliation à des associations ou organismes", "<p>One</p><p>Two</p>"), ("Liste des membres et organisations", " n/a "),
    ]) + "</table>"
    r = T.extract_register_fields(spark.createDataFrame([(page,)], "html string")).first()
    assert (r.people_involved, r.nb_intermediaries, r.intermediaries, r.budget_low, r.budget_high) == (12, 0, [], 10000, 10000)
    assert (r.objectives, r.registration_date, r.associations, r.memberships) == (None, None, "One\nTwo", None)


def test_pages_without_fields(spark):
    df = spark.createDataFrame([("",), (None,), ("<tr class='ecl-table__row'><td><strong>Coûts annuels</strong></td><td></td></tr>",)], "html string")
    assert all(r.budget_low is None and r.intermediaries == [] for r in T.extract_register_fields(df).collect())
    assert T.extract_accredited(df).count() == 0 and T.extract_search_results(df).count() == 0
