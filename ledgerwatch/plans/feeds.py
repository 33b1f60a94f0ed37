"""Meetings, link graph, increments and extraction over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerwatch.functions.text import split_pipe
from ledgerwatch.operators import extract as X
from ledgerwatch.operators import graph as H
from ledgerwatch.operators import meetings as M
from ledgerwatch.operators import registry as G
from ledgerwatch.operators import windows as O
from ledgerwatch.sources.scratch import new_folder
from ledgerwatch.streaming import incremental as I
from ledgerwatch.streaming import stateful as Y

from .roles import MEETING_SQL, dealt, meetings, query, table

NAMES_SQL = "list_filter(list_transform(string_split(attendees, '|'), lambda x: trim(x)), lambda x: x <> '')"
EXCLUDED = ["ORG5"]
OUT_SQL = f"""{MEETING_SQL}, ep_out AS (SELECT *, {NAMES_SQL} AS names FROM meeting WHERE _ord % 2 = 0), ep_in AS (SELECT * FROM ep_out WHERE len(list_filter(names, lambda x: contains(lower(x), 'org5'))) = 0),
 ec_out AS (SELECT _ord, date, CASE WHEN _ord % 9 <> 0 THEN 'org' || (_ord % 20) END AS org, 'DG ' || title AS dg, CASE WHEN _ord % 4 <> 1 THEN 'Host ' || (_ord % 6) END AS host, title AS subject FROM meeting WHERE _ord % 2 = 1),
 ec_in AS (SELECT * FROM ec_out WHERE NOT coalesce(contains(lower(org), 'org5'), false))"""


def ep_out(spark, sf):
    m = meetings(spark, sf).filter(F.col("_ord") % 2 == 0)
    return m.withColumn("attendees", split_pipe(F.col("attendees"))).withColumn("procedure", F.lit(None).cast("string"))


def ec_out(spark, sf):
    m = meetings(spark, sf).filter(F.col("_ord") % 2 == 1)
    k = F.col("_ord")
    return m.select("_ord", "date", F.when(k % 9 != 0, F.concat(F.lit("org"), k % 20)).alias("org"), F.concat(F.lit("DG "), "title").alias("dg"), F.when(k % 4 != 1, F.concat(F.lit("Host "), k % 6)).alias("host"), F.col("title").alias("subject"))


@query(
    "a1_dedupe_meetings",
    f"""WITH {MEETING_SQL}, n AS (SELECT member_id, date, title, _ord, k, unnest({NAMES_SQL}) AS name FROM meeting), g AS (SELECT member_id, date, title, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM n GROUP BY 1, 2, 3),
 f AS (SELECT member_id, date, title, min(_ord) AS _ord FROM meeting GROUP BY 1, 2, 3) SELECT member_id, CAST(date AS VARCHAR) AS date, title, names, f._ord, m.k FROM g JOIN f USING (member_id, date, title) JOIN (SELECT _ord AS o, k FROM meeting) m ON m.o = f._ord""",
)
def a1(spark, sf):
    rows = meetings(spark, sf).withColumn("names", split_pipe(F.col("attendees")))
    return M.dedupe_meetings(rows, ["member_id", "date", "title"], ["names"], ["k"]).withColumn("names", F.array_join("names", ",")).withColumn("date", F.col("date").cast("string"))


@query("a5_global_totals", "SELECT count(*) AS n_organisations, CAST(sum(CASE WHEN c_custkey % 3 <> 0 THEN floor(c_acctbal) ELSE 0 END) AS BIGINT) AS budget_high, CAST(sum(c_nationkey) AS BIGINT) AS people_involved, CAST(0 AS BIGINT) AS ep_meetings, CAST(sum(c_custkey) AS BIGINT) AS ec_meetings FROM customer")
def a5(spark, sf):
    return G.global_totals(table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 3 != 0, F.floor("c_acctbal")).alias("budget_high"), F.col("c_nationkey").cast("bigint").alias("people_involved"), F.lit(None).cast("bigint").alias("ep_meetings"), F.col("c_custkey").alias("ec_meetings")))


@query("a6_combined_totals", f"WITH {OUT_SQL} SELECT (SELECT count(*) FROM customer) AS n, (SELECT sum(c_custkey)::BIGINT FROM customer) + (SELECT count(*) FROM ep_in) AS ep_meetings, (SELECT count(*) FROM ec_in) AS ec_meetings")
def a6(spark, sf):
    totals = table(spark, sf, "customer").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("ep_meetings"), F.lit(None).cast("bigint").alias("ec_meetings"))
    return M.combined_totals(totals, ep_out(spark, sf), ec_out(spark, sf), EXCLUDED)


@query("a7_distinct_actors", f"WITH {OUT_SQL} SELECT DISTINCT unnest(names) AS name FROM ep_out")
def a7(spark, sf):
    return M.distinct_actors(ep_out(spark, sf), "attendees")


@query(
    "a9_top_officials",
    f"""WITH {OUT_SQL}, r AS (SELECT member_name AS official, date, 'own' AS actor, title AS subject, 0 AS branch, _ord FROM meeting WHERE _ord % 2 = 1 UNION ALL SELECT member_name, date, array_to_string(names, ', '), title, 1, _ord FROM ep_in),
 c AS (SELECT official, count(*) AS n_meetings, min(branch * 1000000000 + _ord) AS first FROM r GROUP BY 1), l AS (SELECT *, row_number() OVER (PARTITION BY official ORDER BY date DESC, branch, _ord) AS n FROM r)
 SELECT official, n_meetings, CAST(date AS VARCHAR) AS date, actor, subject FROM c JOIN (SELECT * FROM l WHERE n = 1) USING (official) ORDER BY n_meetings DESC, first LIMIT 12""",
)
def a9(spark, sf):
    tracked = meetings(spark, sf).filter(F.col("_ord") % 2 == 1).select(F.col("member_name").alias("official"), "date", F.lit("own").alias("actor"), F.col("title").alias("subject"), "_ord")
    outside = ep_out(spark, sf).select(F.col("member_name").alias("official"), "date", "attendees", F.col("title").alias("subject"), "_ord")
    return M.top_officials(tracked, outside, EXCLUDED, 12).select("official", "n_meetings", F.col("latest.date").cast("string").alias("date"), "latest.actor", "latest.subject")


COUNTRY_SQL = f"WITH {MEETING_SQL}, c AS (SELECT _ord, coalesce(CASE WHEN c_nationkey % 4 <> 0 THEN n_name END, 'Non identifié') AS country FROM meeting LEFT JOIN customer ON CAST(member_id AS BIGINT) = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"


def with_country(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    names = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").cast("string").alias("member_id"), F.when(F.col("c_nationkey") % 4 != 0, F.col("n_name")).alias("country_name"))
    return M.with_country(meetings(spark, sf), names)


@query("j14_with_country", COUNTRY_SQL + " SELECT _ord, country FROM c")
def j14(spark, sf):
    return with_country(spark, sf).select("_ord", "country")


@query("a10_country_breakdown", COUNTRY_SQL + " SELECT country, count(*) AS n FROM c GROUP BY 1")
def a10(spark, sf):
    return M.country_breakdown(with_country(spark, sf))


@query(
    "a11_top_n_with_other",
    COUNTRY_SQL + """, g AS (SELECT country, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, country) AS r FROM c GROUP BY 1),
 t AS (SELECT CASE WHEN r <= 5 THEN country ELSE 'Autres' END AS country, CAST(sum(n) AS BIGINT) AS n FROM g GROUP BY 1) SELECT country, n, round(n / sum(n) OVER (), 6) AS share FROM t""",
)
def a11(spark, sf):
    return M.top_n_with_other(M.country_breakdown(with_country(spark, sf)), 5).withColumn("share", F.round("share", 6))


@query(
    "a12_last_contact",
    f"""WITH {OUT_SQL}, r AS (SELECT unnest(names) AS name, date, 'parliament' AS institution, member_name AS with_whom, title AS subject, 0 AS branch, _ord FROM ep_out UNION ALL SELECT org, date, 'commission', coalesce(host, dg), subject, 1, _ord FROM ec_out WHERE org IS NOT NULL),
 n AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY date DESC, branch, _ord) AS i FROM r WHERE NOT contains(lower(name), 'org5')) SELECT name, CAST(date AS VARCHAR) AS date, institution, with_whom, subject FROM n WHERE i = 1""",
)
def a12(spark, sf):
    return M.last_contact(ep_out(spark, sf), ec_out(spark, sf), EXCLUDED).withColumn("date", F.col("date").cast("string"))


@query(
    "a19_meetings_by_org",
    f"""WITH {MEETING_SQL}, r AS (SELECT 'org' || _ord % 20 AS register_id, *, CASE WHEN _ord % 6 <> 0 THEN member_id END AS m FROM meeting WHERE date >= DATE '2024-01-10') SELECT register_id, string_agg(date || '/' || coalesce(m, '-') || '/' || title, ',' ORDER BY date DESC, _ord) AS meetings, count(*) AS n_meetings FROM r GROUP BY 1""",
)
def a19(spark, sf):
    rows = meetings(spark, sf).withColumn("register_id", F.concat(F.lit("org"), F.col("_ord") % 20)).withColumn("member_id", F.when(F.col("_ord") % 6 != 0, F.col("member_id")).otherwise(" ")).withColumn("procedure", F.lit(""))
    text = F.transform("meetings", lambda m: F.concat_ws("/", m["date"].cast("string"), F.coalesce(m["member_id"], F.lit("-")), m["title"]))
    return M.meetings_by_org(rows, "2024-01-10").select("register_id", F.array_join(text, ",").alias("meetings"), "n_meetings")


FEED_SQL = f"""WITH {OUT_SQL}, tracked AS (SELECT *, 'Tracked ' || _ord % 3 AS name FROM meeting WHERE _ord % 5 = 0),
 feed AS (SELECT 0 AS branch, _ord, date, name AS actor, 'parliament' AS institution, NULL AS dg, member_name AS with_whom, title AS subject FROM tracked
 UNION ALL SELECT 1, _ord, date, name, 'commission', 'Unit ' || title, member_name || ' (Unit ' || title || ')', NULL FROM tracked
 UNION ALL SELECT 2, _ord, date, array_to_string(names, ', '), 'parliament', NULL, member_name, title FROM ep_in
 UNION ALL SELECT 3, _ord, date, coalesce(org, 'Acteur non identifié'), 'commission', dg, host, subject FROM ec_in),
 once AS (SELECT *, row_number() OVER (PARTITION BY date, institution, actor, subject ORDER BY branch, _ord) AS n FROM feed)"""


def feed(spark, sf):
    own = meetings(spark, sf).filter(F.col("_ord") % 5 == 0).withColumn("name", F.concat(F.lit("Tracked "), F.col("_ord") % 3)).withColumn("procedure", F.lit("")).withColumn("representative", F.concat("member_name", F.lit(", Unit "), "title"))
    return M.meeting_feed(own, own, ep_out(spark, sf), ec_out(spark, sf), EXCLUDED)


@query("u1_meeting_feed", FEED_SQL + " SELECT branch, _ord, CAST(date AS VARCHAR) AS date, actor, institution, dg, with_whom, subject FROM feed")
def u1(spark, sf):
    return feed(spark, sf).drop("procedure").withColumn("date", F.col("date").cast("string"))


@query("w3_dedupe_feed", FEED_SQL + " SELECT branch, _ord, institution, actor FROM once WHERE n = 1")
def w3(spark, sf):
    return O.dedupe_feed(feed(spark, sf).withColumn("_at", F.struct("branch", "_ord")), ["date", "institution", "actor", "subject"], "_at").select("branch", "_ord", "institution", "actor")


@query("l1_latest_meetings", FEED_SQL + " SELECT branch, _ord, CAST(date AS VARCHAR) AS date, actor FROM once WHERE n = 1 ORDER BY date DESC NULLS LAST, branch, _ord LIMIT 25")
def l1(spark, sf):
    return M.latest_meetings(feed(spark, sf), 25).select("branch", "_ord", F.col("date").cast("string").alias("date"), "actor")


@query("l2_recent_accreditations", "SELECT c_name AS name, o_orderpriority AS surname, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS start_date, CAST(o_orderkey AS VARCHAR) AS first_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' ORDER BY o_orderdate DESC, c_name, o_orderpriority, CAST(o_orderkey AS VARCHAR) LIMIT 20")
def l2(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    people = o.groupBy(F.col("c_name").alias("name")).agg(F.collect_list(F.struct(F.col("o_orderpriority").alias("surname"), F.col("o_orderkey").cast("string").alias("first_name"), F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("start_date"))).alias("accredited_persons"))
    return G.recent_accreditations(people, 20).withColumn("start_date", F.col("start_date").cast("string"))


@query("u3_remaining_ids", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events WHERE user_id % 10 <> 0 AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def u3(spark, sf):
    ids = table(spark, sf, "events").select(F.when(F.col("user_id") % 10 != 0, F.col("user_id").cast("string")).otherwise("").alias("member_id"))
    return M.remaining_ids(ids, table(spark, sf, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id")))


CANDIDATE_SQL = "cand AS (SELECT DISTINCT least(l_suppkey, o_custkey) AS source, greatest(l_suppkey, o_custkey) AS target, l_suppkey AS s, l_linenumber AS n, l_returnflag AS flag FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def candidates(spark, sf):
    """A distinct (supplier, customer, line number, flag) is evidence of a link, in this order."""
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.select("l_suppkey", "o_custkey", "l_linenumber", "l_returnflag").distinct()
    flag, n = F.col("l_returnflag"), F.col("l_linenumber")
    text = F.concat_ws(":", n.cast("string"), flag)
    evidence = F.when(flag != "R", F.array(F.struct(F.col("l_suppkey").cast("string").alias("org"), F.lit("f").alias("field"), text.alias("text"), F.lit(None).cast("string").alias("url"))))
    external = F.when(flag == "R", F.array(F.struct(text.alias("description"), F.lit("u").alias("url"))))
    return rows.select(F.col("l_suppkey").alias("source_id"), F.col("o_custkey").alias("target_id"), F.concat(F.lit("type "), n).alias("link_type"), F.when(flag == "A", "official register").when(flag == "R", "external press").otherwise("other").alias("source_type"), evidence.alias("evidence"), external.alias("external_sources"), F.struct(n.alias("a"), flag.alias("b"), F.col("l_suppkey").alias("c"), F.col("o_custkey").alias("d")).alias("_ord"))


EDGE_SQL = f"""{CANDIDATE_SQL}, types AS (SELECT source, target, n FROM cand GROUP BY 1, 2, 3),
 edge AS (SELECT source, target, (SELECT string_agg('type ' || n, '; ' ORDER BY n) FROM types t WHERE t.source = c.source AND t.target = c.target) AS link_type, bool_or(flag = 'A') AS official, bool_or(flag = 'R') AS external, string_agg(n || ':' || flag, ',' ORDER BY n, flag, s) AS evidence, CASE WHEN bool_or(flag = 'A') THEN 'solid' ELSE 'dashed' END AS style FROM cand c GROUP BY 1, 2)"""


@query("a13_consolidate_edges", f"WITH {EDGE_SQL} SELECT * FROM edge")
def a13(spark, sf):
    return H.consolidate_edges(candidates(spark, sf)).withColumn("evidence", F.array_join(F.transform("evidence", lambda e: e["text"]), ","))


@query("a14_node_degree", f"WITH {CANDIDATE_SQL}, e AS (SELECT DISTINCT source, target FROM cand) SELECT id, count(*) AS degree FROM (SELECT source AS id FROM e UNION ALL SELECT target FROM e) GROUP BY 1")
def a14(spark, sf):
    return H.node_degree(H.consolidate_edges(candidates(spark, sf)))


CITED_SQL = "cited AS (SELECT p_brand || '/' || p_size AS network_id, p_partkey AS org_id, CASE WHEN p_partkey % 5 = 0 THEN 'SKIP' WHEN p_partkey % 5 = 1 THEN 'member' END AS precision, p_name AS quote FROM part)"


@query("a17_network_edges", f"WITH {CITED_SQL}, r AS (SELECT * FROM cited WHERE coalesce(precision <> 'SKIP', true)) SELECT org_id AS source, network_id AS target, coalesce(precision, 'citation') AS link_type, quote FROM r WHERE network_id IN (SELECT network_id FROM r GROUP BY 1 HAVING count(*) >= 2)")
def a17(spark, sf):
    k = F.col("p_partkey") % 5
    rows = table(spark, sf, "part").select(F.concat_ws("/", "p_brand", "p_size").alias("network_id"), F.col("p_partkey").alias("org_id"), F.when(k == 0, "SKIP").when(k == 1, "member").alias("precision"), F.col("p_name").alias("quote"))
    return H.network_edges(rows)


@query("a18_category_counts", "SELECT c_mktsegment AS category, count(*) AS n FROM customer GROUP BY 1")
def a18(spark, sf):
    return H.category_counts(table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "category"))


@query(
    "u4_graph_nodes",
    f"""WITH {CANDIDATE_SQL}, e AS (SELECT DISTINCT source, target FROM cand), d AS (SELECT id, count(*) AS degree FROM (SELECT source AS id FROM e UNION ALL SELECT target FROM e) GROUP BY 1),
 ent AS (SELECT c_custkey - c_custkey % 3 AS id, c_name AS name, c_custkey AS o FROM customer), x AS (SELECT ent.*, coalesce(degree, 0) AS degree, row_number() OVER (PARTITION BY id ORDER BY o) AS n FROM ent LEFT JOIN d USING (id))
 SELECT id, name, degree, degree = 0 AS isolated FROM x WHERE degree > 0 OR n = 1 UNION ALL SELECT s_suppkey, s_name, coalesce(degree, 0), false FROM supplier LEFT JOIN d ON id = s_suppkey UNION ALL SELECT 2 * n_nationkey, n_name, coalesce(degree, 0), false FROM nation LEFT JOIN d ON id = 2 * n_nationkey""",
)
def u4(spark, sf):
    edges = H.consolidate_edges(candidates(spark, sf))
    shape = lambda df, key, name: df.select(key.alias("id"), F.col(name).alias("name"), F.lit("l").alias("label"), F.lit("c").alias("category"), F.lit("s").alias("shape"))
    c, s, n = (table(spark, sf, t) for t in ("customer", "supplier", "nation"))
    entities = c.select((F.col("c_custkey") - F.col("c_custkey") % 3).alias("id"), F.col("c_name").alias("name"), F.lit("l").alias("label"), F.lit("c").alias("category"), F.lit("s").alias("shape"), F.col("c_custkey").alias("_ord"))
    nodes, alone = H.graph_nodes(entities, shape(s, F.col("s_suppkey"), "s_name"), shape(n, 2 * F.col("n_nationkey"), "n_name"), edges)
    return nodes.withColumn("isolated", F.lit(False)).unionByName(alone.withColumn("isolated", F.lit(True))).select("id", "name", "degree", "isolated")


@query(
    "u5_provider_nodes_edges",
    "WITH r AS (SELECT p_partkey AS source, 'cab:' || lower(p_name) AS id, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS name FROM part), n AS (SELECT id, arg_min(name, source) AS name FROM r GROUP BY 1) SELECT id, n.name, (SELECT count(*) FROM r WHERE r.id = n.id) AS n_edges FROM n",
)
def u5(spark, sf):
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.replace("p_name", F.lit(" "), F.lit("  ")))
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("register_id"), F.array(F.lit(" "), F.regexp_replace(name, " +", " ")).alias("intermediaries"), F.col("p_partkey").alias("_ord"))
    nodes, edges = H.provider_nodes_edges(rows)
    return nodes.join(edges.groupBy(F.col("target").alias("id")).agg(F.count("*").alias("n_edges")), "id").select("id", "name", "n_edges")


@query("s8_quarantine", "SELECT o_orderkey, o_totalprice >= 1000 AS result, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN 'pending,large' WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_totalprice > 400000 THEN 'large' ELSE '' END AS issues FROM orders WHERE o_orderstatus = 'P' OR o_totalprice > 400000 OR o_totalprice < 1000")
def s8(spark, sf):
    good, bad = G.quarantine(table(spark, sf, "orders"), {"pending": "o_orderstatus = 'P'", "large": "o_totalprice > 400000"}, "o_totalprice >= 1000")
    return bad.join(good.select("o_orderkey", F.lit(True).alias("result")), "o_orderkey", "left").select("o_orderkey", F.coalesce("result", F.lit(False)).alias("result"), F.array_join("issues", ",").alias("issues"))


STORE_SQL = "store AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE doc_id % 4 = 0)"


def registrants(spark, sf):
    return registrants_of(table(spark, sf, "documents"))


def registrants_of(d):
    return d.select(F.col("doc_id").cast("string").alias("id"), F.concat_ws(" ", "lang", "source").alias("name"), F.lit("2024-01-01").cast("date").alias("registrationDate"), F.col("text").alias("objectives"), F.col("doc_id").alias("_ord"))


@query("t1_ingest_registrants", f"WITH {STORE_SQL} SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN contains(lang || ' ' || source, 'src7') THEN 'name' ELSE 'objectives' END AS match FROM documents WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT id FROM store) AND (contains(lang || ' ' || source, 'src7') OR contains(lower(text), 'src7') OR contains(lower(text), 'license'))")
def t1(spark, sf):
    """The feed as a stream of at most four micro-batches of the table's files, after a store that has every fourth id."""
    whole, path = registrants(spark, sf), new_folder(spark)
    stored = whole.filter(F.col("_ord") % 4 == 0).select("id", "name", "registrationDate", F.lit("name").alias("match"), F.lit("before").alias("detected_at"))
    source = table(spark, sf, "documents")
    files = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", -(-len(source.inputFiles()) // 4)).parquet(f"{sf}/documents.parque[t]")  # a pattern, as the table may be a single file
    found = Y.ingest_registrants(registrants_of(files), ["src7", "license"], "now", stored)
    return Y.appended(found, f"{path}/new", f"{path}/checkpoint").select("id", "match")


@query("t2_backfill_registrants", "SELECT CAST(doc_id AS VARCHAR) AS id, 'search:' || CASE WHEN doc_id % 3 = 0 THEN 'k0' ELSE 'k1' END || ':' || CASE WHEN contains(lang || ' ' || source, 'src7') THEN 'name' ELSE 'objectives' END AS match FROM documents WHERE contains(lang || ' ' || source, 'src7') OR contains(lower(text), 'license')")
def t2(spark, sf):
    d = registrants(spark, sf).withColumnRenamed("registrationDate", "registration_date")
    both = d.withColumn("kw_ord", F.lit(1)).unionByName(d.filter(F.col("_ord") % 3 == 0).withColumn("kw_ord", F.lit(0))).withColumn("keyword", F.concat(F.lit("k"), "kw_ord"))
    return I.backfill_registrants(both, spark.createDataFrame([], I.STORE), ["src7", "license"], "now").select("id", "match")


T3_SQL = """WITH p AS (SELECT DISTINCT user_id AS register_id, event_type AS surname, CASE WHEN event_id % 5 <> 0 THEN CAST(ts AS DATE) END AS d, CAST(ts AS DATE) < DATE '2024-01-20' AS old FROM events)
 SELECT DISTINCT CAST(register_id AS VARCHAR) AS register_id, surname, CAST(d AS VARCHAR) AS start_date FROM p c WHERE register_id % 7 <> 0 AND register_id % 5 <> 0 AND coalesce(d >= DATE '2024-01-10', true)
 AND NOT EXISTS (SELECT 1 FROM p o WHERE o.register_id = c.register_id AND o.surname = c.surname AND o.d IS NOT DISTINCT FROM c.d AND o.old) AND surname <> 'view'"""


@query("t3_detect_accreditations", T3_SQL)
def t3(spark, sf):
    """Two nights of snapshots as a stream that is stopped in between; persons named 'view' were reported before the first."""
    e = table(spark, sf, "events")
    person = F.struct(F.col("event_type").alias("surname"), F.lit("x").alias("first_name"), F.when(F.col("event_id") % 5 != 0, F.to_date("ts")).alias("start_date"))
    rows = e.select(F.col("user_id").cast("string").alias("register_id"), "user_id", person.alias("p"), F.to_date("ts").alias("day"))
    some = lambda condition: F.collect_set(F.when(condition, F.col("p")))
    start = F.col("p.start_date")
    each = rows.groupBy("register_id", "user_id").agg(some(F.col("day") < "2024-01-20").alias("before"), some(start.isNull() | (start >= "2024-01-10")).alias("now"), some(F.col("p.surname") == "view").alias("reported"))
    path = new_folder(spark)
    each.write.parquet(f"{path}/each")
    each = spark.read.parquet(f"{path}/each")
    nights = [
        each.filter("user_id % 7 <> 0").select("register_id", F.lit(1).cast("long").alias("at"), F.lit(True).alias("ok"), F.col("before").alias("persons")),
        each.select("register_id", F.lit(2).cast("long").alias("at"), (F.col("user_id") % 5 != 0).alias("ok"), F.col("now").alias("persons")),
    ]
    begun = each.select("register_id", F.lit(None).cast(Y.PERSONS).alias("persons"), "reported")
    for night in nights:
        night.write.mode("append").parquet(f"{path}/in")
        found = Y.watch_accreditations(spark.readStream.schema(Y.SNAPSHOT).parquet(f"{path}/in"), begun)
        out = Y.appended(found, f"{path}/new", f"{path}/checkpoint")
    return out.select("register_id", "surname", F.col("start_date").cast("string").alias("start_date"))


@query("t3_detect_accreditations_batch", T3_SQL)
def t3_batch(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select(F.col("user_id").cast("string").alias("register_id"), F.col("event_type").alias("surname"), F.lit("x").alias("first_name"), F.when(F.col("event_id") % 5 != 0, F.to_date("ts")).alias("start_date"), F.to_date("ts").alias("day"), "user_id")
    previous = rows.filter(F.col("day") < "2024-01-20")
    current = rows.filter(F.col("start_date").isNull() | (F.col("start_date") >= "2024-01-10"))
    ids = rows.select("register_id", "user_id").distinct()
    out = I.detect_accreditations(previous, current, rows.filter("surname = 'view'"), ids.filter("user_id % 7 <> 0"), ids.withColumn("ok", F.col("user_id") % 5 != 0))
    return out.select("register_id", "surname", F.col("start_date").cast("string").alias("start_date"))


X1_SQL = """SELECT *, employees + provider_total + CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 90 END AS total FROM (SELECT c_custkey, c_name AS org_name, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey * 1000 END AS employees, CASE WHEN c_custkey % 3 <> 0 THEN 4 END AS n_employees,
 CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'Firm A=12500' ELSE 'Firm A=12500,' || c_mktsegment || '=7' END AS providers, CAST(CASE c_custkey % 7 WHEN 0 THEN 0 WHEN 1 THEN 12500 ELSE 12507 END AS BIGINT) AS provider_total FROM customer)"""


@query("x1_parse_forms", X1_SQL)
def x1(spark, sf):
    """Forms with both answers, two, one or no provider, plain and no-break spaces in amounts, with or without the last section, and
    with a provider named before and behind the section of providers."""
    k = F.col("c_custkey")
    answer = lambda no: F.when(no, "Non").otherwise("Oui")
    missions = "Montant total annuel des achats de missions ou prestations de la société ou association\n"
    second = F.when(k % 7 > 1, F.concat(F.lit(f"{missions}7\nDénomination sociale de la société prestataire\n"), "c_mktsegment", F.lit("\n"))).otherwise("")
    given = F.when(k % 5 != 0, "Avez-vous versé des avantages en nature ou en espèces en année 2025 ?\nOui\nDénomination sociale de la société prestataire\nElse\nMontant total annuel\n90\n").otherwise("")
    parts = [
        F.lit("Dénomination sociale\n"), F.col("c_name"), F.lit("\nAvez-vous effectué des dépenses de rémunération des personnels employés en année 2025 ?\n"), answer(k % 3 == 0),
        F.lit("\nDénomination sociale de la société prestataire\nElse\nMontant total annuel brut\n"), k.cast("string"), F.when(k % 2 == 0, " 000").otherwise("\u202f000"), F.lit("\nNombre de personnels rémunérées\n4\n7. Dépenses d'achats\n"),
        F.lit("Avez-vous effectué des dépenses d'achats de prestations auprès des sociétés de conseil en année 2025 ?\n"), answer(k % 7 == 0), F.lit(f"\n{missions}"),
        F.when(k % 2 == 0, "12 500").otherwise("12\u00a0500"), F.lit("\nDénomination sociale de la société prestataire\nFirm A\n"), second,
        F.lit("8. Avantages en nature\n"), given, F.lit("9. Je confirme"),
    ]
    out = X.parse_forms(dealt(table(spark, sf, "customer"), "c_custkey").select("c_custkey", F.concat(*parts).alias("text")))
    return out.select("c_custkey", "org_name", "employees", "n_employees", F.array_join(F.transform("providers", lambda p: F.concat_ws("=", p["name"], p["amount"])), ",").alias("providers"), "provider_total", "total")


X2_SQL = """SELECT CAST(s_suppkey AS VARCHAR) AS file, s_name AS org_name, s_suppkey * 100 AS employees, CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Firm A=' || s_nationkey ELSE 'Firm A=' || s_nationkey || ',Firm B=5' END AS providers,
 CAST(CASE s_suppkey % 3 WHEN 0 THEN 0 WHEN 1 THEN s_nationkey ELSE s_nationkey + 5 END AS BIGINT) AS provider_total, CAST(s_suppkey * 100 + CASE s_suppkey % 3 WHEN 0 THEN 0 WHEN 1 THEN s_nationkey ELSE s_nationkey + 5 END AS BIGINT) AS total FROM supplier"""


@query("x2_parse_layout_forms", X2_SQL)
def x2(spark, sf):
    """Forms of two, one or no provider; the providers of every fourth stand on a second page. A line's words come from right to left,
    others above and below the first of them, further apart than a word may be from the first."""
    rows = [(1, "Dénomination", 10.0), (1, "sociale", 60.0), (1, None, 100.0), (2, "Montant", 10.0), (2, "total", 50.0), (2, "annuel", 80.0), (2, "€", 120.0), (2, "EMP", 135.0)]
    rows += [(3, "Dénomination", 10.0), (3, "sociale", 70.0), (3, "de", 110.0), (3, "la", 125.0), (3, "société", 135.0), (3, "prestataire", 170.0), (3, "Firm", 250.0), (3, "A", 275.0), (3, "Firm", 350.0), (3, "B", 375.0)]
    rows += [(4, "association", 10.0), (4, "NAT", 250.0), (4, "5,30", 350.0)]
    words = spark.createDataFrame([(-n, line, t, x, x + 20.0, line * 12.0 + (0.0 if n in (2, 7, 15, 17, 19, 20) else (2.0, -2.0)[n % 2])) for n, (line, t, x) in enumerate(rows)], "ord int, n int, w string, x0 double, x1 double, top double")
    k, later = F.col("s_suppkey"), F.col("n") > 2
    text = F.when(F.col("w").isNull(), F.col("s_name")).when(F.col("w") == "EMP", (k * 100).cast("string")).when(F.col("w") == "NAT", F.col("s_nationkey").cast("string")).otherwise(F.col("w"))
    pages = dealt(table(spark, sf, "supplier"), "s_suppkey").crossJoin(F.broadcast(words)).filter(~later | (k % 3 == 2) | ((k % 3 == 1) & (F.col("x0") < 300)))
    pages = pages.select(k.cast("string").alias("file"), F.when(later & (k % 4 == 0), 2).otherwise(1).alias("page"), "ord", text.alias("text"), "x0", "x1", "top")
    out = X.parse_layout_forms(pages)
    return out.select("file", "org_name", "employees", F.array_join(F.transform("providers", lambda p: F.concat_ws("=", p["name"], p["amount"])), ",").alias("providers"), "provider_total", "total")


X3_SQL = """SELECT CAST(s_suppkey AS VARCHAR) AS register_id, n, CASE n WHEN 1 THEN '2024-03-05' WHEN 2 THEN '2023-11-30' ELSE '2025-02-01' END AS date, CASE n WHEN 1 THEN 'Ann Example, DG-X' WHEN 2 THEN s_name ELSE 'Cab' END AS representative_or_dg,
 CASE n WHEN 1 THEN 'Brussels 7 topics' WHEN 2 THEN 'Online' ELSE 'Paris' END AS location_and_subject FROM supplier, (VALUES (1), (2), (3)) t(n) WHERE n < 3 OR s_suppkey % 3 = 0"""


@query("x3_parse_meeting_lists", X3_SQL)
def x3(spark, sf):
    """Lists with and without a header, an item without a date, numbers that are no items, and numbers on lines of their own."""
    k = F.col("s_suppkey")
    head = F.when(k % 2 == 0, "Head\n1 no\nSubject(s)\n").otherwise("")
    more = F.when(k % 3 == 0, "4\nCab 01/02/2025 Paris\n").otherwise("")
    text = F.concat(head, F.lit("1 Ann Example,\nDG-\nX 05/03/2024 Brussels\n7 topics\n2 "), "s_name", F.lit(" 30/11/2023 Online\n3 nobody\n"), more, F.lit("References\n5 x 01/01/2020 y"))
    return X.parse_meeting_lists(dealt(table(spark, sf, "supplier"), "s_suppkey").select("s_suppkey", text.alias("text")), "s_suppkey")


ROW = '<tr class="ecl-table__row"><td><strong>%s:</strong></td><td>%s</td></tr>'


@query("x4_extract_register_fields", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS BIGINT) END AS people_involved, 2 AS nb_intermediaries, c_custkey * 1000 AS budget_low, c_custkey * 1000 + CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 999 END AS budget_high, 'Aims & ends' AS objectives, '2020-02-01' AS registration_date, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS memberships FROM customer")
def x4(spark, sf):
    k = F.col("c_custkey")
    row = lambda label, *value: [F.lit(ROW.split("%s")[0] + label + ROW.split("%s")[1]), *value, F.lit(ROW.split("%s")[2])]
    html = F.concat(
        F.lit("<table><tbody>"),
        *row("Nombre de personnes (total)", F.when(k % 2 == 0, F.col("c_nationkey").cast("string")).otherwise("n.c.")),
        *row("Intermédiaires (exercice en cours)", F.lit("<table><tbody><tr><td>One</td></tr><tr><td>"), "c_name", F.lit("</td></tr><tr><td> </td></tr></tbody></table>")),
        *row("Estimation des coûts annuels", F.lit("<span><span>"), k.cast("string"), F.lit(" 000 €</span>"), F.when(k % 3 != 0, F.concat(F.lit("<span>"), (k * 1000 + 999).cast("string"), F.lit("</span>"))).otherwise(""), F.lit("</span>")),
        *row("Objectifs et mandat", F.lit("Aims &amp; ends")), *row("Date d'enregistrement", F.lit("01/02/2020 10:00")), *row("Organisations dont elle est membre", F.when(k % 2 == 0, F.col("c_mktsegment")).otherwise("N/A")), F.lit("</tbody></table>"),
    )
    html = F.when(k % 4 == 1, F.regexp_replace(html, "</(?:td|tr|tbody)>", "")).otherwise(html)  # nobody closes these
    out = X.extract_register_fields(dealt(table(spark, sf, "customer"), "c_custkey").select("c_custkey", html.alias("html")))
    return out.select("c_custkey", "people_involved", F.col("nb_intermediaries").cast("int").alias("nb_intermediaries"), "budget_low", "budget_high", "objectives", "registration_date", "memberships")


@query("x5_extract_accredited", "SELECT s_suppkey, s_name AS surname, 'Jo' AS first_name, '2024-01-02' AS start_date, CAST(NULL AS VARCHAR) AS end_date FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT s_suppkey, 'B', '', NULL, '2025-12-31' FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT s_suppkey, 'C', 'D', NULL, NULL FROM supplier WHERE s_suppkey % 3 = 1")
def x5(spark, sf):
    """Pages with full rows, with a short row too, and without the anchored heading."""
    k = F.col("s_suppkey")
    heading = F.when(k % 3 != 0, '<h2 id="persons-accredited-for-access-to-european-parliament-premises">x</h2>').otherwise("<h2>x</h2>")
    short = F.when(k % 3 == 1, "<tr><td>C</td><td>D</td></tr><tr><td>alone</td></tr>").otherwise("")
    html = F.concat(F.lit("<table><thead></thead><tbody><tr><td>no</td><td>no</td></tr></tbody></table>"), heading, F.lit("<table><tbody><tr><td><table><thead><tr><th>a</th></tr></thead><tbody><tr><td>"), "s_name", F.lit("</td><td> Jo </td><td>02/01/2024</td><td></td></tr><tr><td></td><td></td></tr><tr><td>B</td><td></td><td>?</td><td>31/12/2025</td></tr>"), short, F.lit("</tbody></table></td></tr></tbody></table>"))
    html = F.when(k % 4 == 1, F.regexp_replace(html, "</(?:td|tr|th|thead)>", "")).otherwise(html)
    return X.extract_accredited(dealt(table(spark, sf, "supplier"), "s_suppkey").select("s_suppkey", html.alias("html"))).drop("error")


@query("x6_extract_search_results", "SELECT s_suppkey, s_suppkey % 2 = 0 AS has_next, CAST(s_suppkey AS VARCHAR) || '-7' AS id, s_name || ' & co' AS name FROM supplier")
def x6(spark, sf):
    more = F.when(F.col("s_suppkey") % 2 == 0, '<a href="?page=2"> Suivant </a>').otherwise("")
    html = F.concat(F.lit('<article class="ecl-content-item x"><a class="ecl-link" href="/d?id='), "s_suppkey", F.lit('-7&amp;lang=fr"><span class="ecl-link__label">'), "s_name", F.lit(' &amp; co</span></a></article><article class="ecl-content-item">no link</article>'), more)
    html = F.when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("<ul>"), F.repeat(F.lit("<li><p>open"), 2000), F.lit("</ul>"), html)).otherwise(html)
    return X.extract_search_results(dealt(table(spark, sf, "supplier"), "s_suppkey").select("s_suppkey", html.alias("html"))).drop("error")


@query("x7_extract_embedded_json", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN '2023=' || s_nationkey || ',2024=7' WHEN s_suppkey % 4 = 1 THEN '' END AS by_year, CASE WHEN s_suppkey % 4 = 2 THEN 'bad JSON' END AS error FROM supplier")
def x7(spark, sf):
    k = F.col("s_suppkey") % 4
    inner = F.when(k == 0, F.concat(F.lit("{&quot;2023&quot;: "), "s_nationkey", F.lit(", &quot;2024&quot;: 7}"))).when(k == 1, " [] ").when(k == 2, "{bad")
    html = F.when(inner.isNotNull(), F.concat(F.lit('<p>x</p><div id="graph_info" hidden>'), inner, F.lit("</div>"))).otherwise("<p>none</p>")
    out = X.extract_embedded_json(dealt(table(spark, sf, "supplier"), "s_suppkey").select("s_suppkey", html.alias("html")))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("by_year")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("int"))), ",")
    return out.select("s_suppkey", text.alias("by_year"), "error")


@query("x0_page_links", "SELECT page_id, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang, len(regexp_extract_all(html, '<a [^>]*href=')) AS n_links FROM pages")
def x0(spark, sf):
    return X.extract_page_links(table(spark, sf, "pages")).select("page_id", "lang", F.size("links").cast("bigint").alias("n_links"))
