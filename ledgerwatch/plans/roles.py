"""The driver's tables in the roles of the register tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Words of part names that stand for search words.
WORDS = ["widget", "ring"]
YEARS = [1996, 1997]


def query(name: str, sql: str | None = None):
    """Registers a query, and the SQL that gives the same rows."""

    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Short rows that stand for long texts or many words, dealt out before these are made of them: their files are small, so that one
    task would read them all and do all the work. A landed page is as long as its file says, and needs no such deal."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


EXERCISE_SQL = """exercise AS (SELECT o_orderkey AS exercices_id, o_custkey AS representants_id, CAST(year(o_orderdate) AS INT) AS annee_fin,
 CAST(day(o_orderdate) % 4 AS INT) AS nombre_activites, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 7 AS DOUBLE) END AS nombre_salaries,
 CASE WHEN day(o_orderdate) % 5 = 0 THEN 0 WHEN o_orderstatus = 'O' AND day(o_orderdate) % 7 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 10000) AS BIGINT) * 10000 END AS montant_depense_inf,
 CAST(floor(o_totalprice / 10000) AS BIGINT) * 10000 + 10000 AS montant_depense_sup, o_orderkey AS _ord FROM orders)"""


def exercises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2: an order is a fiscal exercise of its customer."""
    o, day, low = table(spark, sf_dir, "orders"), F.dayofmonth("o_orderdate"), F.floor(F.col("o_totalprice") / 10000).cast("bigint") * 10000
    return o.select(
        F.col("o_orderkey").alias("exercices_id"), F.col("o_custkey").alias("representants_id"), F.year("o_orderdate").alias("annee_fin"),
        (day % 4).alias("nombre_activites"), F.when(F.col("o_orderstatus") != "P", (F.col("o_orderkey") % 7).cast("double")).alias("nombre_salaries"),
        F.when(day % 5 == 0, F.lit(0).cast("bigint")).when((F.col("o_orderstatus") == "O") & (day % 7 == 0), F.lit(None).cast("bigint")).otherwise(low).alias("montant_depense_inf"),
        (low + 10000).alias("montant_depense_sup"), F.col("o_orderkey").alias("_ord"),
    )


ACTIVITY_SQL = "activity AS (SELECT l_orderkey AS exercices_id, p_name || ' ' || p_type AS objet_activite FROM lineitem JOIN part ON l_partkey = p_partkey)"


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: a line item with its part's name and type is an activity."""
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return l.join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("exercices_id"), F.concat_ws(" ", "p_name", "p_type").alias("objet_activite"))


RELATION_SQL = "relation AS (SELECT l_suppkey AS provider, o_custkey AS client, CAST(l_shipdate AS TIMESTAMP) AS start, CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS ended FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4: a supplier that ships for a customer's order has the customer as a client."""
    l, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_suppkey").alias("provider"), F.col("o_custkey").alias("client"), F.col("l_shipdate").cast("timestamp").alias("start"), F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("ended"))


MEETING_SQL = """meeting AS (SELECT event_id AS _ord, CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS member_id, 'Member ' || user_id AS member_name, event_type AS title,
 json_extract_string(props, '$.k') AS k, CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) % 3 = 0 THEN 'org' || (event_id % 20) || '| Org' || (event_id % 7) || ' |' ELSE 'org' || (event_id % 20) END AS attendees FROM events)"""


def meetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9: an event is a meeting; its key tells how many attend."""
    e, k = table(spark, sf_dir, "events"), F.get_json_object("props", "$.k")
    one, more = F.concat(F.lit("org"), F.col("event_id") % 20), F.concat(F.lit("| Org"), F.col("event_id") % 7, F.lit(" |"))
    return e.select(F.col("event_id").alias("_ord"), F.col("ts").cast("date").alias("date"), F.col("user_id").cast("string").alias("member_id"), F.concat(F.lit("Member "), F.col("user_id")).alias("member_name"), F.col("event_type").alias("title"), k.alias("k"), F.when(k.cast("int") % 3 == 0, F.concat(one, more)).otherwise(one).alias("attendees"))
