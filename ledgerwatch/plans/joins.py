"""Matching, exercises, providers and reconciliation over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerwatch.functions.predicates import keyword_filter_folded
from ledgerwatch.functions.text import fold
from ledgerwatch.operators import exercises as E
from ledgerwatch.operators import matching as M
from ledgerwatch.operators import providers as V
from ledgerwatch.operators import reconcile as R
from ledgerwatch.operators import registry as G
from ledgerwatch.operators import windows as O

from .roles import ACTIVITY_SQL, EXERCISE_SQL, MEETING_SQL, RELATION_SQL, YEARS, activities, exercises, meetings, query, relations, table

WATCH_SQL = "watch AS (SELECT 'org' || s_suppkey % 10 AS id, 'ORG ' || s_suppkey % 3 AS name FROM supplier UNION ALL SELECT '', NULL)"


def watch(spark, sf):
    return table(spark, sf, "supplier").select(F.concat(F.lit("org"), F.col("s_suppkey") % 10).alias("id"), F.concat(F.lit("ORG "), F.col("s_suppkey") % 3).alias("name")).union(spark.createDataFrame([("", None)], "id string, name string"))


MATCHED_SQL = "(contains(lower(strip_accents(objet_activite)), 'widget') OR contains(lower(strip_accents(objet_activite)), 'standard') OR contains(lower(strip_accents(objet_activite)), 'ring'))"
FLAGSHIP_SQL = f"""WITH {EXERCISE_SQL}, {ACTIVITY_SQL},
 matched AS (SELECT representants_id, annee_fin FROM activity JOIN exercise USING (exercices_id) WHERE {MATCHED_SQL}),
 found AS (SELECT representants_id, count(*) FILTER (WHERE annee_fin = 1996) AS matched_1996, count(*) FILTER (WHERE annee_fin = 1997) AS matched_1997 FROM matched WHERE annee_fin IN (1996, 1997) GROUP BY 1),
 totals AS (SELECT representants_id, CAST(coalesce(sum(nombre_activites) FILTER (WHERE annee_fin = 1996), 0) AS BIGINT) AS declared_1996, CAST(coalesce(sum(nombre_activites) FILTER (WHERE annee_fin = 1997), 0) AS BIGINT) AS declared_1997 FROM exercise GROUP BY 1)
 SELECT representants_id, matched_1996, matched_1997, declared_1996, declared_1997, matched_1996 = declared_1996 AND matched_1997 = declared_1997 AS specialised, c_name AS denomination FROM found JOIN totals USING (representants_id) JOIN customer ON c_custkey = representants_id"""


def activity_discovery(spark, sf):
    matched = M.activities_with_exercise(keyword_filter_folded(activities(spark, sf), "objet_activite", ["widget", "standard", "ring"]), exercises(spark, sf))
    info = table(spark, sf, "customer").select(F.col("c_custkey").alias("representants_id"), F.col("c_name").alias("denomination"))
    return E.activity_counts(matched, exercises(spark, sf), info, YEARS)


@query("flagship_activity_discovery", FLAGSHIP_SQL)
def flagship(spark, sf):
    return E.sort_by_activity(activity_discovery(spark, sf), YEARS, "representants_id")


@query("a2_activity_counts", FLAGSHIP_SQL)
def a2(spark, sf):
    return activity_discovery(spark, sf)


@query("l4_sort_by_activity", FLAGSHIP_SQL.replace("SELECT representants_id, matched_1996, matched_1997, declared_1996", "SELECT row_number() OVER (ORDER BY matched_1996 + matched_1997 DESC, representants_id) AS position, representants_id, matched_1996, matched_1997, declared_1996"))
def l4(spark, sf):
    return E.sort_by_activity(activity_discovery(spark, sf), [1996, 1997], "representants_id", "position")


@query("j1_outside_watchlist", f"WITH {MEETING_SQL}, {WATCH_SQL} SELECT _ord, attendees FROM meeting WHERE nullif(attendees, 'org3') IS NULL OR attendees NOT IN (SELECT id FROM watch WHERE id <> '')")
def j1(spark, sf):
    rows = meetings(spark, sf).withColumn("id", F.nullif("attendees", F.lit("org3")))
    return M.outside_watchlist(rows, watch(spark, sf), "id").select("_ord", "attendees")


LISTS_SQL = "lists AS (SELECT _ord, list_filter(list_transform(string_split(attendees, '|'), lambda x: trim(x)), lambda x: x <> '') AS names FROM meeting)"


@query("j2_outside_watchlist_multi", f"WITH {MEETING_SQL}, {WATCH_SQL}, {LISTS_SQL} SELECT _ord FROM lists WHERE NOT list_has_any(names, (SELECT list(id) FROM watch WHERE id <> ''))")
def j2(spark, sf):
    from ledgerwatch.functions.text import split_pipe

    return M.outside_watchlist_multi(meetings(spark, sf).withColumn("ids", split_pipe(F.col("attendees"))), watch(spark, sf), "ids", "_ord").select("_ord")


@query(
    "j3_outside_watchlist_named",
    f"WITH {MEETING_SQL}, {WATCH_SQL}, {LISTS_SQL} SELECT _ord FROM lists WHERE NOT list_has_any(names, (SELECT list(id) FROM watch WHERE id <> '')) AND NOT list_has_any(list_transform(names, lambda x: regexp_replace(lower(x), 'org', 'org ')), (SELECT list(lower(name)) FROM watch WHERE name IS NOT NULL))",
)
def j3(spark, sf):
    from ledgerwatch.functions.text import split_pipe

    rows = meetings(spark, sf).withColumn("ids", split_pipe(F.col("attendees"))).withColumn("names", F.transform("ids", lambda x: F.regexp_replace(x, "(?i)org", "Org. ")))
    return M.outside_watchlist_named(rows, watch(spark, sf), "ids", "names", "_ord").select("_ord")


@query("j4_activities_with_exercise", f"WITH {EXERCISE_SQL}, {ACTIVITY_SQL} SELECT representants_id, annee_fin, count(*) AS n FROM activity JOIN exercise USING (exercices_id) GROUP BY 1, 2")
def j4(spark, sf):
    return M.activities_with_exercise(activities(spark, sf), exercises(spark, sf)).groupBy("representants_id", "annee_fin").agg(F.count("*").alias("n"))


@query(
    "j5_lookup_actor",
    "WITH f AS (SELECT trim(p_name) AS n, min(p_partkey) AS k FROM part GROUP BY 1), a AS (SELECT DISTINCT p_name AS denomination FROM part UNION ALL SELECT 'nobody') SELECT denomination, p.p_partkey, p.p_type FROM a LEFT JOIN f ON denomination = n LEFT JOIN part p ON p.p_partkey = k",
)
def j5(spark, sf):
    part = table(spark, sf, "part")
    actors = part.select(F.col("p_name").alias("denomination")).distinct().union(spark.createDataFrame([("nobody",)], "denomination string"))
    info = part.select(F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("denomination"), "p_partkey", "p_type", F.col("p_partkey").alias("_ord"))
    return M.lookup_actor(actors, info)


ACTOR_SQL = "actors AS (SELECT * FROM (VALUES ('rings', 'ring'), ('rings', 'gear'), ('hot things', 'hot_'), ('none', 'zzz')) t(actor, kw))"


def word_actors(spark):
    return spark.createDataFrame([("rings", ["ring", "gear"]), ("hot things", ["hot_"]), ("none", ["zzz"])], "actor string, keywords array<string>")


@query(
    "j6_match_by_keywords",
    f"""WITH {ACTOR_SQL}, hits AS (SELECT DISTINCT actor, p_size, p_partkey FROM part JOIN actors ON contains(lower(p_brand || ' ' || replace(p_name, ' ', '_')), kw))
 SELECT actor, p_size, min(p_partkey) AS p_partkey, count(*) AS n_matches FROM hits GROUP BY 1, 2""",
)
def j6(spark, sf):
    rows = table(spark, sf, "part").withColumn("file", F.replace("p_name", F.lit(" "), F.lit("_"))).withColumn("empty", F.lit(""))
    return M.match_by_keywords(word_actors(spark), rows, ["p_brand", "empty", "file"], "p_size", "p_partkey", lambda c: fold(c, ascii_only=True)).select("actor", "p_size", "p_partkey", "n_matches")


@query(
    "j7_provider_relations",
    f"""WITH {RELATION_SQL} SELECT c_custkey, provider, count(*) AS n FROM customer JOIN relation ON client = c_custkey WHERE c_custkey % 10 <> 0 GROUP BY 1, 2
 UNION ALL SELECT c_custkey, provider, count(*) AS n FROM customer JOIN relation ON client // 10 = c_custkey // 10 WHERE c_custkey % 10 = 0 GROUP BY 1, 2""",
)
def j7(spark, sf):
    nine = lambda c: F.lpad(F.col(c).cast("string"), 9, "0")
    actors = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 10 == 0, F.substring(nine("c_custkey"), 1, 8)).otherwise(F.concat(nine("c_custkey"), F.lit("00099"))).alias("identifiant_national"))
    rel = relations(spark, sf).withColumn("identifiant_national_client", F.concat(nine("client"), F.lit("00017")))
    return M.provider_relations(actors, rel).groupBy("c_custkey", "provider").agg(F.count("*").alias("n"))


GONE_SQL = "CASE WHEN provider % 3 = 0 THEN TIMESTAMP '1998-01-01 00:00:00' END"


@query("j8_active_years", f"WITH {RELATION_SQL} SELECT y AS year, provider, count(*) AS n FROM relation, (VALUES (1996), (1998), (1999)) t(y) WHERE start <= make_timestamp(y, 12, 31, 23, 59, 59) AND coalesce({GONE_SQL} >= make_timestamp(y, 1, 1, 0, 0, 0), true) GROUP BY 1, 2")
def j8(spark, sf):
    rows = relations(spark, sf).withColumn("provider_end", F.when(F.col("provider") % 3 == 0, F.lit("1998-01-01 00:00:00").cast("timestamp")))
    return V.active_years(rows, [1996, 1998, 1999]).groupBy("year", "provider").agg(F.count("*").alias("n"))


@query("j9_current_providers", f"WITH {RELATION_SQL} SELECT DISTINCT client AS actor, s_name AS provider FROM relation JOIN supplier ON provider = s_suppkey WHERE ended IS NULL")
def j9(spark, sf):
    info = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("representants_id"), F.col("s_name").alias("denomination"))
    rel = relations(spark, sf).select(F.col("client").alias("actor"), F.col("provider").alias("representants_id"), F.col("ended").alias("dateCessation"))
    return V.current_providers(rel, info)


BUDGET_SQL = f"""WITH {EXERCISE_SQL},
 ex AS (SELECT representants_id AS actor, annee_fin AS year, arg_min(montant_depense_inf, _ord) FILTER (WHERE true) AS x, min(_ord) AS o FROM exercise GROUP BY 1, 2),
 first AS (SELECT ex.actor, ex.year, e.montant_depense_inf AS low, CASE WHEN e._ord % 11 <> 0 THEN e.montant_depense_sup END AS high FROM ex JOIN exercise e ON e._ord = o),
 filed AS (SELECT o_custkey AS actor, CAST(year(o_orderdate) AS INT) AS year, CAST(floor(max(o_totalprice)) AS BIGINT) AS filed FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
 both_ AS (SELECT c_custkey AS actor, y AS year, low, high, filed FROM customer CROSS JOIN (VALUES (1996), (1997)) t(y) LEFT JOIN first ON first.actor = c_custkey AND first.year = y LEFT JOIN filed ON filed.actor = c_custkey AND filed.year = y)
 SELECT actor, CAST(year AS INT) AS year, low, high, filed, CASE WHEN filed IS NOT NULL AND low IS NOT NULL AND high IS NOT NULL THEN NOT (filed BETWEEN low AND high) ELSE (filed IS NOT NULL) <> (low IS NOT NULL) END AS mismatch FROM both_"""


def budgets(spark, sf):
    first = O.first_per_key(exercises(spark, sf), ["representants_id", "annee_fin"], ["_ord"])
    ex = first.select(F.col("representants_id").alias("actor"), F.col("annee_fin").alias("year"), F.col("montant_depense_inf").alias("low"), F.when(F.col("_ord") % 11 != 0, F.col("montant_depense_sup")).alias("high"))
    filed = table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("actor"), F.year("o_orderdate").alias("year")).agg(F.floor(F.max("o_totalprice")).alias("filed"))
    return R.reconcile_budgets(table(spark, sf, "customer").select(F.col("c_custkey").alias("actor")), ex, filed, YEARS)


@query("j10_reconcile_budgets", BUDGET_SQL)
def j10(spark, sf):
    return budgets(spark, sf)


@query(
    "j11_reconcile_headcount",
    "WITH p AS (SELECT o_custkey AS actor, count(DISTINCT o_orderpriority) AS n_people FROM orders GROUP BY 1) SELECT c_custkey AS actor, 1996 AS year, CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 6 AS INT) END AS filed_people, coalesce(n_people, 0) AS n_people, coalesce(c_custkey % 3 <> 0 AND c_custkey % 6 <> coalesce(n_people, 0), false) AS mismatch FROM customer LEFT JOIN p ON actor = c_custkey",
)
def j11(spark, sf):
    people = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("actor")).agg(F.countDistinct("o_orderpriority").alias("n_people"))
    filings = table(spark, sf, "customer").select(F.col("c_custkey").alias("actor"), F.lit(1996).alias("year"), F.when(F.col("c_custkey") % 3 != 0, (F.col("c_custkey") % 6).cast("int")).alias("filed_people"))
    return R.reconcile_headcount(people, filings)


J12_SQL = """WITH n AS (SELECT p_size, list(p_name ORDER BY p_partkey) FILTER (WHERE p_partkey % 2 = 0) AS a, list(split_part(p_name, ' ', 2) ORDER BY p_partkey) FILTER (WHERE p_partkey % 7 = 1) AS b FROM part GROUP BY 1),
 m AS (SELECT p_size, coalesce(a, []) AS a, coalesce(b, []) AS b FROM n),
 r AS (SELECT p_size, list_filter(a, lambda x: len(list_filter(b, lambda y: contains(x, y) OR contains(y, x))) = 0) AS l, list_filter(b, lambda y: len(list_filter(a, lambda x: contains(x, y) OR contains(y, x))) = 0) AS rr FROM m)
 SELECT p_size, array_to_string(l, ',') AS left_only, array_to_string(rr, ',') AS right_only, len(l) > 0 OR len(rr) > 0 AS mismatch FROM r"""


@query("j12_reconcile_names", J12_SQL)
def j12(spark, sf):
    """Both lists as rows; a size with no name in either has two empty lists."""
    left, right = name_lists(spark, sf)
    out = R.reconcile_lists(left, right, ["p_size"], "p_partkey")
    every = table(spark, sf, "part").select(F.col("p_size").alias("_size")).distinct().join(out, F.col("_size").eqNullSafe(F.col("p_size")), "left")
    text = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return every.select(F.col("_size").alias("p_size"), F.lower(text("left_only")).alias("left_only"), text("right_only").alias("right_only"), F.coalesce("mismatch", F.lit(False)).alias("mismatch"))


def name_lists(spark, sf):
    part, key = table(spark, sf, "part"), F.col("p_partkey")
    left = part.filter(key % 2 == 0).select("p_size", "p_partkey", F.upper("p_name").alias("name"))
    return left, part.filter(key % 7 == 1).select("p_size", "p_partkey", F.split_part("p_name", F.lit(" "), F.lit(2)).alias("name"))


@query("j12_unmatched_names", J12_SQL)
def j12_long(spark, sf):
    """The rows left over, put together by the query."""
    part = table(spark, sf, "part")
    rows = R.unmatched_names(*name_lists(spark, sf), ["p_size"])
    listed = lambda side: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == side, F.struct("p_partkey", "name")))), lambda x: x["name"]), ",")
    found = rows.groupBy("p_size").agg(F.lower(listed("left")).alias("left_only"), listed("right").alias("right_only"))
    out = part.select("p_size").distinct().join(found, "p_size", "left")
    return out.select("p_size", F.coalesce("left_only", F.lit("")).alias("left_only"), F.coalesce("right_only", F.lit("")).alias("right_only"), F.col("left_only").isNotNull().alias("mismatch"))


LIVE_SQL = "live AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN 0 WHEN s_suppkey % 3 = 1 THEN CAST(s_acctbal AS BIGINT) END AS b, CAST(s_nationkey AS INT) AS people, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey % 4 AS INT) END AS ep FROM supplier)"


@query(
    "j13_merge_entities",
    f"WITH {LIVE_SQL} SELECT c_custkey, coalesce(b, CAST(floor(c_acctbal) AS BIGINT)) AS budget_low, coalesce(people, -1) AS people, ep AS ep_meetings, CASE WHEN k IS NULL OR k % 2 = 1 THEN 0 ELSE 2 END AS n_intermediaries, c_custkey % 5 <> 0 AS has_register_id FROM customer LEFT JOIN live ON c_custkey % 5 <> 0 AND k = c_custkey",
)
def j13(spark, sf):
    none, key = F.lit(None), F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey"))
    low = F.floor("c_acctbal").cast("bigint")
    seed = table(spark, sf, "customer").select("c_custkey", key.alias("register_id"), low.alias("budget_low"), low.alias("budget_high"), F.lit(-1).alias("people_involved"), none.cast("int").alias("nb_intermediaries"))
    k = F.col("s_suppkey")
    own = F.when(k % 3 == 0, F.lit(0).cast("bigint")).when(k % 3 == 1, F.rint("s_acctbal").cast("bigint"))  # a half goes to the even number, as in SQL's cast
    live = table(spark, sf, "supplier").select(k.alias("register_id"), own.alias("budget_low"), own.alias("budget_high"), F.col("s_nationkey").cast("int").alias("people_involved"), none.cast("int").alias("nb_intermediaries"), F.when(k % 2 == 0, F.array("s_name", "s_name")).alias("intermediaries"), F.when(k % 2 == 0, (F.col("s_nationkey") % 4).cast("int")).alias("ep_meetings"))
    return G.merge_entities(seed, live).select("c_custkey", "budget_low", F.col("people_involved").alias("people"), "ep_meetings", F.size("intermediaries").alias("n_intermediaries"), "has_register_id")


@query(
    "j15_resolve_names",
    """WITH r AS (SELECT p_type AS query, p_partkey AS rank, CASE WHEN p_partkey % 13 = 0 THEN ' ' || lower(p_type) ELSE p_name END AS name FROM part),
 x AS (SELECT *, lower(trim(name)) = lower(trim(query)) AS exact, row_number() OVER (PARTITION BY query ORDER BY CASE WHEN lower(trim(name)) = lower(trim(query)) THEN 0 ELSE 1 END, rank) AS position FROM r)
 SELECT query, rank, exact, CAST(position AS INT) AS position FROM x WHERE exact OR position <= 10""",
)
def j15(spark, sf):
    part = table(spark, sf, "part")
    rows = part.select(F.col("p_type").alias("query"), F.col("p_partkey").alias("rank"), F.when(F.col("p_partkey") % 13 == 0, F.concat(F.lit(" "), F.lower("p_type"))).otherwise(F.col("p_name")).alias("name"))
    return M.resolve_names(rows.select("query"), rows).select("query", "rank", "exact", "position")


@query(
    "j16_attach_filing",
    "WITH f AS (SELECT p_name, max(p_partkey) AS k FROM part GROUP BY 1), a AS (SELECT DISTINCT p_name AS folder FROM part UNION ALL SELECT NULL UNION ALL SELECT 'nobody') SELECT folder, CAST(p_size AS BIGINT) AS total_declare, p_partkey AS staff FROM a LEFT JOIN f ON folder = f.p_name LEFT JOIN part ON p_partkey = k",
)
def j16(spark, sf):
    part = table(spark, sf, "part")
    actors = part.select(F.col("p_name").alias("folder")).distinct().union(spark.createDataFrame([(None,), ("nobody",)], "folder string"))
    filings = part.select(F.col("p_name").alias("folder_org_name"), F.col("p_size").cast("bigint").alias("total_declare"), F.col("p_partkey").alias("montant_employes"), F.array().cast("array<string>").alias("cabinets"), F.lit(0).alias("montant_avantages"), F.col("p_partkey").alias("_ord"))
    return M.attach_filing(actors, filings).select("folder", "total_declare", F.col("detail.montant_employes").alias("staff"))


@query("a3_yearly_totals", f"WITH {EXERCISE_SQL} SELECT annee_fin, CAST(sum(montant_depense_inf) AS BIGINT) AS total, count(*) AS n_organisations FROM exercise WHERE montant_depense_inf IS NOT NULL GROUP BY 1")
def a3(spark, sf):
    return E.yearly_totals(exercises(spark, sf), "annee_fin", "montant_depense_inf")


HISTORY_SQL = f"""{EXERCISE_SQL}, last AS (SELECT representants_id, annee_fin, max(_ord) AS o FROM exercise WHERE montant_depense_inf IS NOT NULL GROUP BY 1, 2),
 hist AS (SELECT e.representants_id, e.annee_fin, e.montant_depense_inf AS amount FROM last JOIN exercise e ON e._ord = o)"""


def history(spark, sf):
    return E.budget_history(table(spark, sf, "customer").select(F.col("c_custkey").alias("representants_id")), exercises(spark, sf).filter("montant_depense_inf IS NOT NULL"))


@query("a4_budget_history", f"WITH {HISTORY_SQL} SELECT c_custkey AS representants_id, coalesce(string_agg(annee_fin || '=' || amount, ',' ORDER BY annee_fin), '') AS by_year FROM customer LEFT JOIN hist ON representants_id = c_custkey GROUP BY 1")
def a4(spark, sf):
    return history(spark, sf).select("representants_id", F.array_join(F.transform(F.map_entries("by_year"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("by_year"))


@query("a20_history_columns", f"WITH {HISTORY_SQL} SELECT c_custkey AS representants_id, max(amount) FILTER (WHERE annee_fin = 1996) AS y1996, max(amount) FILTER (WHERE annee_fin = 1997) AS y1997 FROM customer LEFT JOIN hist ON representants_id = c_custkey GROUP BY 1")
def a20(spark, sf):
    return E.history_columns(history(spark, sf), "by_year", YEARS)


@query("u6_history_series", f"WITH {HISTORY_SQL} SELECT CAST(c_custkey AS VARCHAR) AS series, annee_fin AS year, amount FROM customer LEFT JOIN hist ON representants_id = c_custkey UNION ALL SELECT 'total', annee_fin, CAST(sum(montant_depense_inf) AS BIGINT) FROM exercise WHERE montant_depense_inf IS NOT NULL GROUP BY annee_fin")
def u6(spark, sf):
    h = history(spark, sf).select(F.col("representants_id").cast("string").alias("actor"), "by_year")
    totals = E.yearly_totals(exercises(spark, sf), "annee_fin", "montant_depense_inf").withColumnRenamed("annee_fin", "year")
    return E.history_series(h, totals, h.select("actor"))


@query("u2_union_filings", "SELECT CAST(year(o_orderdate) AS INT) AS source_year, count(*) AS n, count(*) FILTER (WHERE year(o_orderdate) = 1997) AS with_people FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY 1")
def u2(spark, sf):
    base = table(spark, sf, "orders").select(F.year("o_orderdate").alias("source_year"), F.col("o_totalprice").alias("total"))
    both = E.union_filings(base.filter("source_year = 1996"), base.filter("source_year = 1997").withColumn("nb_personnels", F.lit(3)))
    return both.groupBy("source_year").agg(F.count("*").alias("n"), F.count("nb_personnels").alias("with_people"))


PROVIDER_YEARS_SQL = f"""WITH {RELATION_SQL}, named AS (SELECT DISTINCT client AS actor, CASE WHEN s_name = 'Supplier#000000001' THEN 'Supplier#000000002' ELSE s_name END AS provider, CAST(year(start) AS INT) AS y FROM relation JOIN supplier ON provider = s_suppkey),
 p AS (SELECT actor, provider, string_agg(CAST(y AS VARCHAR), '+' ORDER BY y) AS ys FROM named GROUP BY 1, 2) SELECT actor, string_agg(provider || ':' || ys, ',' ORDER BY provider) AS providers, count(*) AS n_providers FROM p GROUP BY 1"""


@query("a15_provider_years", PROVIDER_YEARS_SQL)
def a15(spark, sf):
    info = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("provider"), "s_name")
    rows = relations(spark, sf).join(info, "provider").select(F.col("client").alias("actor"), F.col("s_name").alias("provider"), F.year("start").alias("year"))
    out = V.provider_years(rows, {"Supplier#000000001": "Supplier#000000002"})
    text = F.transform("providers", lambda p: F.concat_ws(":", p["provider"], F.array_join(p["years"].cast("array<string>"), "+")))
    return out.select("actor", F.array_join(text, ",").alias("providers"), "n_providers")


@query(
    "a16_distinct_people",
    """WITH p AS (SELECT p_size AS owner, upper(p_type) AS s, upper(trim(p_name)) AS f, min(p_partkey) AS k FROM part GROUP BY 1, 2, 3), q AS (SELECT owner, CASE WHEN k % 2 = 0 THEN ' ' || p_name ELSE upper(p_name) END || ' ' || p_type AS shown FROM p JOIN part ON p_partkey = k)
 SELECT owner, md5(string_agg(shown, ',' ORDER BY shown)) AS people, count(*) AS n_people FROM q GROUP BY 1""",
)
def a16(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_size").alias("owner"), F.col("p_type").alias("surname"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" "), "p_name")).otherwise(F.upper("p_name")).alias("first"), F.col("p_partkey").alias("_ord"))
    return V.distinct_people(rows, "owner", "surname", "first").select("owner", F.md5(F.array_join("people", ",").cast("binary")).alias("people"), "n_people")


@query(
    "a8_summary_totals",
    f"""WITH {HISTORY_SQL}, a AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE CAST(c_custkey AS BIGINT) END AS lo, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE CAST(c_custkey + 10 AS BIGINT) END AS hi, CAST(c_nationkey AS BIGINT) AS n_people, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS BIGINT) END AS filed FROM customer)
 SELECT count(*) AS n_actors, CAST(sum(lo) FILTER (WHERE NOT (lo = 0 AND hi = 0)) AS BIGINT) AS low, CAST(sum(hi) FILTER (WHERE NOT (lo = 0 AND hi = 0)) AS BIGINT) AS high, CAST(sum(n_people) AS BIGINT) AS people, CAST(sum(filed) AS BIGINT) AS filed,
 (SELECT CAST(sum(amount) AS BIGINT) FROM hist WHERE annee_fin = 1996) AS y1996, (SELECT CAST(sum(amount) AS BIGINT) FROM hist WHERE annee_fin = 1790) AS y1790, (SELECT count(DISTINCT x) FROM (SELECT c_mktsegment AS x FROM customer UNION ALL SELECT 'p' || c_nationkey FROM customer)) AS n_providers FROM a""",
)
def a8(spark, sf):
    k, zero = F.col("c_custkey"), F.col("c_custkey") % 4 == 0
    info = table(spark, sf, "customer").select(k.alias("representants_id"), F.when(zero, F.lit(0)).otherwise(k).alias("budget_low"), F.when(zero, F.lit(0)).otherwise(k + 10).alias("budget_high"), F.col("c_nationkey").cast("bigint").alias("n_people"), F.when(k % 3 == 0, k).alias("total_declare"), F.array(F.col("c_mktsegment"), F.concat(F.lit("p"), "c_nationkey")).alias("providers"))
    return R.summary_totals(info.join(history(spark, sf), "representants_id"), [1996, 1790])


@query(
    "a21_nest_years",
    f"WITH b AS ({BUDGET_SQL}) SELECT actor, string_agg(year || ':' || coalesce(CAST(low AS VARCHAR), '-') || ':' || coalesce(CAST(filed AS VARCHAR), '-') || ':' || CASE WHEN mismatch THEN 'x' ELSE 'o' END || ':' || CASE WHEN actor % 2 = 0 THEN 'o' ELSE 'x' END, ',' ORDER BY year) AS years FROM b GROUP BY 1",
)
def a21(spark, sf):
    names = F.when(F.col("actor") % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("someone")))
    rows = budgets(spark, sf).withColumn("filed_people", F.lit(None).cast("int")).withColumn("n_people", F.lit(0)).withColumn("left_only", names).withColumn("right_only", F.array().cast("array<string>"))
    flag = lambda c: F.when(c, "x").otherwise("o")
    dash = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    text = F.transform(F.map_entries("years"), lambda e: F.concat_ws(":", e["key"], dash(e["value"]["register"]["low"]), dash(e["value"]["filing"]["filed"]), flag(e["value"]["mismatches"]["budget"]), flag(e["value"]["mismatches"]["providers"])))
    return R.nest_years(rows).select("actor", F.array_join(text, ",").alias("years"))


@query("w1_first_per_key", "SELECT p_type, min(p_partkey) AS first, max(p_partkey) AS last FROM part GROUP BY 1")
def w1(spark, sf):
    part = table(spark, sf, "part")
    first = O.first_per_key(part, ["p_type"], ["p_partkey"]).select("p_type", F.col("p_partkey").alias("first"))
    return first.join(O.first_per_key(part, ["p_type"], ["p_partkey"], last=True).select("p_type", F.col("p_partkey").alias("last")), "p_type")


@query(
    "w2_current_or_latest_mandate",
    "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END, CASE WHEN o_orderstatus = 'O' THEN o_orderkey END, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END DESC, o_orderkey) AS n FROM orders) WHERE n = 1",
)
def w2(spark, sf):
    rows = table(spark, sf, "orders").withColumn("end", F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")))
    return O.current_or_latest_mandate(rows, "o_custkey", "o_orderdate", "end", "o_orderkey").select("o_custkey", "o_orderkey")


@query("w5_rank_rows", "SELECT p_partkey, CAST(row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS INT) AS rank, CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS INT) AS rank_in_type FROM part")
def w5(spark, sf):
    order = [F.col("p_retailprice").desc(), F.col("p_partkey").asc()]
    return O.rank_rows(O.rank_rows(table(spark, sf, "part"), order), order, ["p_type"], "rank_in_type").select("p_partkey", "rank", "rank_in_type")


@query(
    "w6_contiguous_runs",
    """WITH s AS (SELECT DISTINCT o_custkey AS series, CAST(year(o_orderdate) AS INT) AS year FROM orders), i AS (SELECT year, row_number() OVER (ORDER BY year) AS i FROM (SELECT DISTINCT year FROM s)),
 p AS (SELECT series, year, i - row_number() OVER (PARTITION BY series ORDER BY year) AS island FROM s JOIN i USING (year)) SELECT series, year, CAST(dense_rank() OVER (PARTITION BY series ORDER BY island) AS INT) AS run FROM p""",
)
def w6(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("series"), F.year("o_orderdate").alias("year")).distinct()
    return O.contiguous_runs(rows, "series", "year").select("series", "year", "run")


@query("w4_split_columns", "SELECT l_orderkey, CAST(count(*) AS INT) AS n FROM (SELECT l_orderkey, pos, lag(pos + 5) OVER (PARTITION BY l_orderkey ORDER BY pos) AS p FROM (SELECT DISTINCT l_orderkey, CAST(l_partkey AS DOUBLE) AS pos FROM lineitem)) WHERE p IS NULL OR pos - p > 20 GROUP BY 1")
def w4(spark, sf):
    """Words that stand twice at one place of a line begin no column, so they needn't be made distinct first."""
    words = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").cast("double").alias("x0")).withColumn("x1", F.col("x0") + 5).withColumn("ord", F.col("x0")).withColumn("text", F.lit("w"))
    return O.split_columns(words, ["l_orderkey"]).groupBy("l_orderkey").agg(F.count("*").cast("int").alias("n"))


@query("l3_sort_by_budget", "SELECT CAST(row_number() OVER (ORDER BY CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END DESC NULLS LAST, c_custkey) AS INT) AS position, c_custkey FROM customer")
def l3(spark, sf):
    rows = table(spark, sf, "customer").withColumn("high", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")))
    return G.sort_by_budget(rows, "high", "c_custkey", "position").select("position", "c_custkey")
