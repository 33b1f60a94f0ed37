"""The link graph between organisations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.text import provider_key, short_label

from .windows import first_per_key

EVIDENCE = "array<struct<org:string,field:string,text:string,url:string>>"


def consolidate_edges(candidates: DataFrame, order: str = "_ord") -> DataFrame:
    """One edge for each undirected pair: link types in order of first sight, official and external flags, all evidence.

    External sources become evidence rows. An edge is solid if some evidence is official, else dashed.
    """
    none = F.lit(None).cast("string")
    empty = F.array().cast(EVIDENCE)
    external = F.transform(F.coalesce("external_sources", F.array().cast("array<struct<description:string,url:string>>")), lambda s: F.struct(none.alias("org"), F.lit("external").alias("field"), s["description"].alias("text"), s["url"].alias("url")))
    rows = candidates.select(
        F.least("source_id", "target_id").alias("source"), F.greatest("source_id", "target_id").alias("target"), "link_type", order,
        F.contains(F.lower("source_type"), F.lit("official")).alias("official"), F.contains(F.lower("source_type"), F.lit("external")).alias("external"),
        F.concat(F.coalesce(F.col("evidence").cast(EVIDENCE), empty), external.cast(EVIDENCE)).alias("evidence"),
    )
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.struct(order, c))), lambda x: x[c])
    out = rows.groupBy("source", "target").agg(
        F.array_join(F.array_distinct(listed("link_type")), "; ").alias("link_type"),
        F.coalesce(F.bool_or("official"), F.lit(False)).alias("official"),
        F.coalesce(F.bool_or("external"), F.lit(False)).alias("external"),
        F.flatten(listed("evidence")).alias("evidence"),
    )
    return out.withColumn("style", F.when(F.col("official"), "solid").otherwise("dashed"))


def node_degree(edges: DataFrame) -> DataFrame:
    """Edges at each end; parallel edges count."""
    return edges.select(F.col("source").alias("id")).union(edges.select("target")).groupBy("id").agg(F.count("*").alias("degree"))


def network_edges(citations: DataFrame, least: int = 2) -> DataFrame:
    """An edge for each citation of a network that is cited often enough; rows marked SKIP don't count."""
    real = citations.filter(F.coalesce(F.col("precision") != "SKIP", F.lit(True)))
    often = real.groupBy("network_id").agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select("network_id")
    return real.join(often, "network_id", "left_semi").select(F.col("org_id").alias("source"), F.col("network_id").alias("target"), F.coalesce("precision", F.lit("citation")).alias("link_type"), "quote")


def category_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("category").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "category")


def provider_nodes_edges(entities: DataFrame, order: str = "_ord") -> tuple[DataFrame, DataFrame]:
    """Nodes of declared consultancies, one for each name in its first spelling, and an edge for each declaration.

    entities: register_id, intermediaries (array), _ord.
    """
    rows = entities.select("register_id", order, F.posexplode("intermediaries").alias("_pos", "name")).filter(F.trim("name") != "")
    rows = rows.withColumn("id", provider_key(F.col("name"))).withColumn("_at", F.struct(order, "_pos"))
    nodes = first_per_key(rows, ["id"], ["_at"]).select("id", F.trim("name").alias("name"), short_label(F.col("name")).alias("label"), F.lit("intermediary").alias("category"), F.lit("square").alias("shape"))
    return nodes, rows.select(F.col("register_id").alias("source"), F.col("id").alias("target"), F.lit("intermediary").alias("link_type"))


def graph_nodes(entities: DataFrame, networks: DataFrame, providers: DataFrame, edges: DataFrame, order: str = "_ord") -> tuple[DataFrame, DataFrame]:
    """(nodes with degree, isolated entities). Entities: id, name, label, category, shape, _ord; the others without _ord.

    An entity that no edge touches is isolated, once for each id; linked ones keep their repeats.
    """
    degrees = node_degree(edges)
    own = entities.join(degrees, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    linked, alone = own.filter("degree > 0").drop(order), own.filter("degree = 0")
    more = networks.unionByName(providers).join(degrees, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    return linked.unionByName(more), first_per_key(alone, ["id"], [order]).drop(order)
