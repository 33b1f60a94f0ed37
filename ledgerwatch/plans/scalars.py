"""Scalar functions and predicates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerwatch.functions import predicates as P
from ledgerwatch.functions import text as X

from .roles import EXERCISE_SQL, WORDS, exercises, query, table


@query("f1_fold", "SELECT doc_id, md5(lower(strip_accents(text))) AS folded FROM documents")
def f1(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(X.fold(F.col("text")).cast("binary")).alias("folded"))


@query("f1_fold_ascii", "SELECT doc_id, md5(regexp_replace(lower(strip_accents(text)), '[^\\x00-\\x7F]+', '', 'g')) AS folded FROM documents")
def f1b(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(X.fold(F.col("text"), ascii_only=True).cast("binary")).alias("folded"))


@query("f1_fold_exact", "SELECT doc_id, md5(regexp_replace(lower(strip_accents(text)), '[^\\x00-\\x7F]+', '', 'g')) AS folded FROM documents")
def f1c(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(X.fold_exact(F.col("text")).cast("binary")).alias("folded"))


@query("f2_norm_name", "SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^\\x00-\\x7F]+', '', 'g'), '[^a-z0-9]+', ' ', 'g'))) AS norm FROM documents")
def f2(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(X.norm_name(F.col("text")).cast("binary")).alias("norm"))


@query(
    "f3_parse_amount",
    """SELECT c_custkey, CAST(nullif(regexp_replace(t, '[^0-9]', '', 'g'), '') AS BIGINT) AS form,
 CAST(nullif(split_part(regexp_replace(t, '[^0-9,]', '', 'g'), ',', 1), '') AS BIGINT) AS layout,
 CASE WHEN regexp_full_match(replace(replace(t, ' ', ''), '€', ''), '[0-9]+') THEN CAST(replace(replace(t, ' ', ''), '€', '') AS BIGINT) END AS strict
 FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey || ' 000 €' WHEN c_custkey % 3 = 1 THEN c_custkey || ',50 €' ELSE c_mktsegment END AS t FROM customer)""",
)
def f3(spark, sf):
    k = F.col("c_custkey")
    t = F.when(k % 3 == 0, F.concat(k, F.lit(" 000 €"))).when(k % 3 == 1, F.concat(k, F.lit(",50 €"))).otherwise(F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", X.parse_amount(t).alias("form"), X.parse_amount(t, "layout").alias("layout"), X.parse_amount(t, "strict").alias("strict"))


@query(
    "f4_iso_date",
    "SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS day FROM orders",
)
def f4(spark, sf):
    t = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("le "), F.date_format("o_orderdate", "dd/MM/yyyy"))).otherwise(F.concat(F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" 10:00")))
    return table(spark, sf, "orders").select("o_orderkey", X.iso_date(t).cast("string").alias("day"))


@query("f5_register_ts", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 10:30:00' END AS at FROM orders")
def f5(spark, sf):
    day = F.date_format("o_orderdate", "dd-MM-yyyy")
    t = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("45-13-2020 "), day)).otherwise(F.concat(day, F.lit(" 10:30")))
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(X.register_ts(t), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "f6_unescape_html",
    "SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')) AS plain FROM (SELECT page_id, regexp_replace(html, '&(copy|middot);', '', 'g') AS html FROM pages)",
)
def f6(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(X.unescape_common(F.regexp_replace("html", "&(copy|middot);", "")).cast("binary")).alias("plain"))


#: The entities that the pages have, with or without a semicolon; the ampersand comes last.
ENTITIES_SQL = "html"
for _entity, _text in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
    ENTITIES_SQL = f"regexp_replace({ENTITIES_SQL}, '&{_entity};?', '{_text}', 'g')"


@query("f6_unescape_html_full", f"SELECT page_id, md5({ENTITIES_SQL}) AS plain FROM pages")
def f6b(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(X.unescape_html(F.col("html")).cast("binary")).alias("plain"))


@query(
    "f7_cabinet_label",
    "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'Cabinet de ' || s_name WHEN s_suppkey % 3 = 1 THEN s_name || ' & co' END AS label FROM supplier",
)
def f7(spark, sf):
    k = F.col("s_suppkey") % 3
    t = F.when(k == 0, F.concat(F.lit("Cabinet of Commissioner "), "s_name")).when(k == 1, F.concat("s_name", F.lit(" &amp; co"))).otherwise("")
    return table(spark, sf, "supplier").select("s_suppkey", X.cabinet_label(t).alias("label"))


@query(
    "f8_meeting_parts",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Cabinet de ' || c_mktsegment WHEN c_custkey % 3 = 1 THEN 'Unit B' ELSE c_name END AS dg,
 c_name AS person, CASE WHEN c_custkey % 3 = 0 THEN c_name || ' (Cabinet member of ' || c_mktsegment || ')' WHEN c_custkey % 3 = 1 THEN c_name || ' (Head, Unit B)' ELSE c_name END AS person_role FROM customer""",
)
def f8(spark, sf):
    k = F.col("c_custkey") % 3
    t = F.when(k == 0, F.concat("c_name", F.lit(", Cabinet member of "), "c_mktsegment")).when(k == 1, F.concat("c_name", F.lit(", Head,, Unit B "))).otherwise(F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", X.meeting_dg(t).alias("dg"), X.meeting_person(t).alias("person"), X.meeting_person_role(t).alias("person_role"))


@query("f9_join_hosts", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name || ' & x, ' || p_brand END AS hosts FROM part")
def f9(spark, sf):
    a = F.when(F.col("p_partkey") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat("p_name", F.lit(" &amp; x")), F.lit(""), F.col("p_brand")))
    return table(spark, sf, "part").select("p_partkey", X.join_hosts(a).alias("hosts"))


@query("f10_split_pipe", "SELECT p_partkey, p_name || '/' || p_type AS names, 2 AS n FROM part")
def f10(spark, sf):
    parts = X.split_pipe(F.concat(F.lit(" "), "p_name", F.lit(" | |"), "p_type", F.lit("|")))
    return table(spark, sf, "part").select("p_partkey", F.array_join(parts, "/").alias("names"), F.size(parts).alias("n"))


@query("f11_slug", "SELECT p_partkey, trim(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') AS slug, 'cab:' || lower(p_name) || ' ' || lower(p_brand) AS key, 'entite' AS none FROM part")
def f11(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.slug(F.concat_ws(" ", "p_name", "p_brand")).alias("slug"), X.provider_key(F.concat("p_name", F.lit("  \t"), "p_brand", F.lit(" "))).alias("key"), X.slug(F.lit("??")).alias("none"))


@query("f12_short_label", "SELECT p_partkey, p_name || ' (old) x' AS kept, p_name AS cut FROM part")
def f12(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.short_label(F.concat("p_name", F.lit(" (old) x"))).alias("kept"), X.short_label(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")  "))).alias("cut"))


@query("f13_map_value", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' ELSE c_mktsegment END AS mapped, c_mktsegment AS segment FROM customer")
def f13(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.map_value(F.col("c_mktsegment"), {"BUILDING": "B", "MACHINERY": "M"}).alias("mapped"), X.last_segment(F.concat(F.lit("def/"), "c_mktsegment", F.lit("//"))).alias("segment"))


@query("f14_blank_to_null", "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P', 'O') THEN NULL ELSE o_orderstatus END AS status FROM orders")
def f14(spark, sf):
    t = F.when(F.col("o_orderstatus") == "P", " n/a ").when(F.col("o_orderstatus") == "O", "  ").otherwise(F.col("o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", X.blank_to_null(t).alias("status"))


@query(
    "f15_declared_totals",
    "SELECT p_partkey, CAST(CASE WHEN p_size % 2 = 0 THEN 0 ELSE p_size END + p_partkey AS BIGINT) AS provider_total, CAST(CASE WHEN p_size % 2 = 0 THEN 0 ELSE p_size END + p_partkey + CASE WHEN p_size % 3 = 0 THEN 0 ELSE p_size END AS BIGINT) AS total, 2 AS n FROM part",
)
def f15(spark, sf):
    size = F.col("p_size").cast("bigint")
    providers = F.array(F.struct(F.col("p_name").alias("name"), F.when(size % 2 != 0, size).alias("amount")), F.struct(F.col("p_brand").alias("name"), F.col("p_partkey").alias("amount")))
    return table(spark, sf, "part").select("p_partkey", X.provider_total(providers).alias("provider_total"), X.declared_total(F.when(size % 3 != 0, size), providers, F.lit(None).cast("bigint")).alias("total"), F.size(providers).alias("n"))


@query("f16_zip_pairs", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name || '=' || p_size ELSE p_name || '=' || p_size || ';' || p_brand || '=1' END AS pairs FROM part")
def f16(spark, sf):
    amounts = F.when(F.col("p_size") % 2 == 0, F.array(F.col("p_size"))).otherwise(F.array(F.col("p_size"), F.lit(1), F.lit(2)))
    pairs = X.zip_pairs(F.array("p_name", "p_brand"), amounts)
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.transform(pairs, lambda x: F.concat_ws("=", x["name"], x["amount"])), ";").alias("pairs"))


@query("f17_pair_key", "SELECT least(l_suppkey, o_custkey) AS low, greatest(l_suppkey, o_custkey) AS high, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2")
def f17(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy(X.pair_key(F.col("l_suppkey"), F.col("o_custkey")).alias("k")).agg(F.count("*").alias("n")).select("k.low", "k.high", "n")


@query("f18_register_url", "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN 'https://register.example/view?id=' || c_custkey END AS url FROM customer")
def f18(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.register_url(F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey"))).alias("url"))


@query(
    "p1_keyword_filter",
    "SELECT p_partkey, CASE WHEN contains(t, 'widget') THEN 'widget' ELSE '' END || CASE WHEN contains(t, 'widget') AND contains(t, 'ring') THEN ',' ELSE '' END || CASE WHEN contains(t, 'ring') THEN 'ring' ELSE '' END AS matched FROM (SELECT p_partkey, lower(p_name || ' ' || p_type) AS t FROM part) WHERE contains(t, 'widget') OR contains(t, 'ring')",
)
def p1(spark, sf):
    return P.keyword_filter(table(spark, sf, "part"), ["p_name", "p_type"], WORDS, "m").select("p_partkey", F.array_join("m", ",").alias("matched"))


@query("p2_keyword_filter_folded", "SELECT doc_id FROM documents WHERE contains(lower(strip_accents(text)), 'cion') OR contains(lower(strip_accents(text)), 'ueb')")
def p2(spark, sf):
    return P.keyword_filter_folded(table(spark, sf, "documents"), "text", ["cion", "ueb"]).select("doc_id")


@query("p3_exclude_names", "SELECT c_custkey FROM customer WHERE NOT contains(lower(c_mktsegment), 'build') AND c_custkey % 3 <> 0")
def p3(spark, sf):
    rows = table(spark, sf, "customer").withColumn("names", F.array(F.col("c_name"), F.when(F.col("c_custkey") % 3 == 0, F.lit("Old FURNITURE Club"))))
    return P.exclude_names(P.exclude_names(rows, "c_mktsegment", ["Build"]), "names", ["furniture"]).select("c_custkey")


@query("p4_since", "SELECT user_id, count(*) AS total_count, count(*) FILTER (WHERE CAST(ts AS DATE) >= DATE '2024-01-15') AS since_count FROM events GROUP BY 1")
def p4(spark, sf):
    return P.since_counts(table(spark, sf, "events").withColumn("day", F.to_date("ts")), "user_id", "day", "2024-01-15")


@query("p5_exercise_scope", f"WITH {EXERCISE_SQL} SELECT exercices_id, annee_fin, montant_depense_inf FROM exercise WHERE annee_fin BETWEEN 1996 AND 1999 AND montant_depense_inf IS NOT NULL")
def p5(spark, sf):
    return P.exercise_scope(exercises(spark, sf), 1996, 1999).select("exercices_id", "annee_fin", "montant_depense_inf")


@query("p6_drop_unpublished", f"WITH {EXERCISE_SQL} SELECT exercices_id FROM exercise WHERE NOT coalesce(nombre_activites = 0 AND montant_depense_inf = 0 AND nombre_salaries IS NULL, false)")
def p6(spark, sf):
    return P.drop_unpublished(exercises(spark, sf)).select("exercices_id")


@query(
    "p7_exercise_state",
    f"WITH {EXERCISE_SQL} SELECT exercices_id, CASE WHEN nombre_activites = 0 AND montant_depense_inf = 0 AND nombre_salaries IS NULL THEN 'unpublished' WHEN nombre_activites = 0 AND montant_depense_inf <> 0 THEN 'means_only' ELSE 'published' END AS state FROM exercise",
)
def p7(spark, sf):
    return exercises(spark, sf).select("exercices_id", P.exercise_state().alias("state"))


@query("p8_nonzero_filings", f"WITH {EXERCISE_SQL} SELECT coalesce(montant_depense_inf > 0, false) AS positive, count(*) AS n, sum(montant_depense_inf) AS total FROM exercise GROUP BY 1")
def p8(spark, sf):
    good, other = P.nonzero_filings(exercises(spark, sf), "montant_depense_inf")
    return good.withColumn("positive", F.lit(True)).union(other.withColumn("positive", F.lit(False))).groupBy("positive").agg(F.count("*").alias("n"), F.sum("montant_depense_inf").alias("total"))


@query(
    "p9_categorize_entity",
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'harm_reduction' WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'manufacturer' ELSE 'trade_association' END AS category FROM customer",
)
def p9(spark, sf):
    s = F.col("c_mktsegment")
    return table(spark, sf, "customer").select("c_custkey", P.categorize_entity(F.when(s == "BUILDING", " Harm reduction / other"), F.when(s == "MACHINERY", "Big Manufacturer").when(s == "FURNITURE", "a distributor")).alias("category"))


@query(
    "p10_declaration_status",
    "SELECT c_custkey, CASE WHEN floor(c_acctbal) > 5000 THEN 'declared' WHEN c_mktsegment = 'BUILDING' THEN 'out_of_scope' WHEN c_mktsegment = 'MACHINERY' THEN 'via_third_party' ELSE 'none' END AS status FROM customer",
)
def p10(spark, sf):
    s, amount = F.col("c_mktsegment"), F.when(F.floor("c_acctbal") > 5000, F.floor("c_acctbal"))
    return table(spark, sf, "customer").select("c_custkey", P.declaration_status(amount, [(s == "BUILDING", "out_of_scope"), (s.isin("MACHINERY", "BUILDING"), "via_third_party")]).alias("status"))
