"""Sources and sinks by round trips: whole tables are landed as files of each format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerwatch.operators import registry as G
from ledgerwatch.sources import tables as S
from ledgerwatch.sources.scratch import new_folder
from ledgerwatch.streaming import stateful as Y

from .roles import meetings, query, table


@query("s1_read_register_csv", """SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS representants_id, c_name || chr(10) || '"' || c_mktsegment || '"; é' AS denomination, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS identifiant_national, CAST(NULL AS VARCHAR) AS ville FROM customer""")
def s1(spark, sf):
    k, path = F.col("c_custkey"), new_folder(spark)
    name = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('"; é'))
    rows = table(spark, sf, "customer").select(F.when(k % 7 == 0, "none").otherwise(k.cast("string")).alias("representants_id"), name.alias("denomination"), F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("identifiant_national"), F.lit("x").alias("unknown"))
    rows.write.option("sep", ";").option("header", True).option("escape", '"').csv(f"{path}/export/csv")
    return S.read_register_csv(spark, path, "rep_info", "part-*.csv").select("representants_id", "denomination", "identifiant_national", "ville")


@query("s2_read_meeting_csv", "SELECT event_type || ',' || chr(10) || event_id AS title, CAST(user_id AS VARCHAR) AS member_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS meeting_date, CASE WHEN event_id % 5 <> 0 THEN 'a|b' END AS attendees, true AS named FROM events")
def s2(spark, sf):
    m, path = meetings(spark, sf), new_folder(spark)
    rows = m.select(F.concat("title", F.lit(",\n"), "_ord").alias("title"), "member_id", "member_name", F.col("date").alias("meeting_date"), F.lit("Member").alias("member_capacity"), F.lit(None).cast("string").alias("procedure_reference"), F.when(F.col("_ord") % 5 != 0, "a|b").alias("attendees"), F.lit(None).cast("string").alias("lobbyist_id"))
    rows.write.option("header", True).option("escape", '"').csv(path)
    return S.read_meeting_csv(spark, path).select("title", "member_id", F.col("meeting_date").cast("string").alias("meeting_date"), "attendees", F.startswith("keyword", F.lit("part-")).alias("named"))


def arrays(spark, sf, rows, by, text):
    """One file for each group of a thousand rows, with the text of the group."""
    path = new_folder(spark)
    rows.groupBy(F.floor(F.col(by) / 1000).alias("g")).agg(text.alias("value")).repartition("g").write.partitionBy("g").text(path)
    return path


@query("s3_read_json_records", "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS c_name, c_nationkey + n AS c_nationkey, n FROM customer, (VALUES (0), (1)) t(n)")
def s3(spark, sf):
    c = table(spark, sf, "customer")
    listed = F.collect_list(F.struct("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "NaN").otherwise(F.col("c_name")).alias("c_name"), "c_nationkey"))
    kinds = "c_custkey bigint, c_name string, c_nationkey bigint"
    plain = S.read_json_records(spark, arrays(spark, sf, c, "c_custkey", F.to_json(listed)), kinds)
    inside = S.read_json_records(spark, arrays(spark, sf, c, "c_custkey", F.to_json(F.struct(listed.alias("meetings")))), kinds, "meetings")
    both = plain.withColumn("n", F.lit(0)).unionByName(inside.withColumn("n", F.lit(1)), allowMissingColumns=True)
    return both.select("c_custkey", "c_name", (F.col("c_nationkey") + F.col("n")).alias("c_nationkey"), "n")


@query("s4_read_keyed_json", "SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name, CASE WHEN s_suppkey % 3 = 1 THEN CAST(s_nationkey AS DOUBLE) END AS y2023 FROM supplier WHERE s_suppkey % 3 <> 2")
def s4(spark, sf):
    k = F.col("s_suppkey")
    years = F.when(k % 3 == 0, F.lit("[]")).otherwise(F.to_json(F.create_map(F.lit("2023"), F.col("s_nationkey"))))
    own = F.when(k % 3 == 2, F.lit('{"error": "down"}')).otherwise(F.concat(F.lit('{"name": '), F.to_json(F.array("s_name")).substr(F.lit(2), F.length(F.to_json(F.array("s_name"))) - 2), F.lit(', "budget_by_year": '), years, F.lit("}")))
    rows = table(spark, sf, "supplier").withColumn("entry", F.concat(F.lit('"'), k, F.lit('": '), own))
    text = F.concat(F.lit('{"organisations": {'), F.array_join(F.collect_list("entry"), ", "), F.lit("}}"))
    path = arrays(spark, sf, rows, "s_suppkey", text)
    return S.read_keyed_json(spark, path, "struct<name:string,budget_by_year:map<string,double>>", "organisations").select("key", "value.name", F.try_element_at("value.budget_by_year", F.lit("2023")).alias("y2023"))


@query("s5_read_pages", "SELECT md5(string_agg(page_id || html, chr(10) ORDER BY page_id) || chr(10)) AS text FROM pages GROUP BY page_id // 20")
def s5(spark, sf):
    path = new_folder(spark)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("page_id", "html"))), lambda x: F.concat(x["page_id"], x["html"]))
    documents = table(spark, sf, "pages").groupBy(F.floor(F.col("page_id") / 20).alias("g")).agg(F.array_join(listed, "\n").alias("value"))
    documents.repartition("g").write.partitionBy("g").text(path)
    return S.read_pages(spark, path).select(F.md5(F.col("text").cast("binary")).alias("text"))


@query("s6_write_yearly", "SELECT o_orderkey, o_custkey + CASE WHEN year(o_orderdate) = 1996 THEN 1 ELSE 0 END AS o_custkey, CAST(year(o_orderdate) AS INT) AS source_year FROM orders")
def s6(spark, sf):
    path = new_folder(spark)
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("source_year"))
    S.write_yearly(rows, path)
    S.write_yearly(rows.filter("source_year = 1996").withColumn("o_custkey", F.col("o_custkey") + 1), path)  # replaces that year alone
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "source_year")


LIVE_SQL = """SELECT coalesce(c_custkey, uk) AS k, CASE WHEN uk IS NULL OR s_suppkey % 3 = 0 THEN c_nationkey ELSE s_nationkey END AS people, CASE WHEN uk IS NULL THEN c_mktsegment WHEN s_suppkey % 4 <> 0 THEN s_name END AS meetings, c_name AS snapshot, CASE WHEN s_suppkey % 3 = 0 THEN 'failed' END AS detail_error
 FROM customer FULL JOIN (SELECT *, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey + 5 ELSE -s_suppkey END AS uk FROM supplier) ON c_custkey = uk"""
LIVE_GROUPS = {"detail": ["people"], "meetings": ["meetings"], "snapshot": ["snapshot"]}


def live(spark, sf):
    """(current, update): suppliers of even keys update a customer, those of odd keys are new."""
    none, k = F.lit(None).cast("string"), F.col("s_suppkey")
    current = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("people"), none.alias("detail_error"), F.col("c_mktsegment").alias("meetings"), none.alias("meetings_error"), F.col("c_name").alias("snapshot"), none.alias("snapshot_error"))
    update = table(spark, sf, "supplier").select(F.when(k % 2 == 0, k + 5).otherwise(-k).alias("k"), F.col("s_nationkey").alias("people"), F.when(k % 3 == 0, "failed").alias("detail_error"), F.col("s_name").alias("meetings"), F.when(k % 4 == 0, "failed").alias("meetings_error"))
    return current, update


@query("s7_merge_live", LIVE_SQL)
def s7(spark, sf):
    current, update = live(spark, sf)
    return G.merge_live(current, update, "k", LIVE_GROUPS).select("k", "people", "meetings", "snapshot", "detail_error")


@query("t4_upsert_live", LIVE_SQL)
def t4(spark, sf):
    """The same updates, landed as files and read as a stream of three micro-batches; the live table is the stream's state."""
    current, update = live(spark, sf)
    path = new_folder(spark)
    parts = max(3, len(update.inputFiles()))
    update.repartition(parts).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(update.schema).option("maxFilesPerTrigger", -(-parts // 3)).parquet(f"{path}/in")
    Y.appended(Y.upsert_live(stream, current, "k", LIVE_GROUPS), f"{path}/changes", f"{path}/checkpoint")
    return Y.state_table(spark, f"{path}/checkpoint", "live").select("k", "people", "meetings", "snapshot", "detail_error")
