"""Watchlists, name matching and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerwatch.functions.keywords import actors_in
from ledgerwatch.functions.text import fold, norm_name

from .windows import first_per_key


def outside_watchlist(df: DataFrame, watch: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id isn't tracked; null and empty ids count as outside. `watch` has one column, id."""
    ids = watch.select(F.col("id").alias("_w")).filter("_w <> ''").distinct()
    return df.join(ids, F.col(id_col) == F.col("_w"), "left_anti")


def outside_watchlist_multi(df: DataFrame, watch: DataFrame, ids_col: str, key: str) -> DataFrame:
    """Drops a row when any id of its array is tracked; `key` identifies the rows."""
    ids = watch.select(F.col("id").alias("_w")).filter("_w <> ''").distinct()
    tracked = df.select(F.col(key).alias("_k"), F.explode(ids_col).alias("_w")).join(ids, "_w", "left_semi").select("_k").distinct()
    return df.join(tracked, F.col(key) == F.col("_k"), "left_anti")


def outside_watchlist_named(df: DataFrame, watch: DataFrame, ids_col: str, names_col: str, key: str) -> DataFrame:
    """The same, and also drops rows that name a tracked organisation; `watch` has id and name."""
    by_id = df.select(F.col(key).alias("_k"), F.explode(ids_col).alias("_w")).join(watch.select(F.col("id").alias("_w")).filter("_w <> ''").distinct(), "_w", "left_semi")
    names = watch.select(norm_name(F.col("name")).alias("_w")).filter("_w <> ''").distinct()
    by_name = df.select(F.col(key).alias("_k"), F.explode(names_col).alias("_n")).select("_k", norm_name(F.col("_n")).alias("_w")).join(names, "_w", "left_semi")
    tracked = by_id.select("_k").union(by_name.select("_k")).distinct()
    return df.join(tracked, F.col(key) == F.col("_k"), "left_anti")


def activities_with_exercise(activities: DataFrame, exercises: DataFrame, key: str = "exercices_id", owner: str = "representants_id") -> DataFrame:
    """Each activity with its exercise; activities of no known representative are dropped."""
    return activities.join(exercises, key, "left").filter(F.col(owner).isNotNull())


def lookup_actor(actors: DataFrame, info: DataFrame, name: str = "denomination", order: str = "_ord") -> DataFrame:
    """Actors with the first register row of their exact trimmed name; unmatched actors stay with nulls."""
    first = first_per_key(info.withColumn("_name", F.trim(name)), ["_name"], [order]).drop(name, order)
    return actors.join(first, F.col(name) == F.col("_name"), "left").drop("_name")


def haystack(*cols: Column) -> Column:
    return F.concat_ws(" ", *(F.nullif(c, F.lit("")) for c in cols))


def match_by_keywords(actors: DataFrame, records: DataFrame, texts: list[str], year: str = "source_year", order: str = "_ord", normalize=None) -> DataFrame:
    """The first record of each (actor, year) whose texts hold one of the actor's keywords, with the number of such records.

    actors: actor, keywords (array). `order` tells the records apart. All keywords are one automaton, which reads each record's folded
    text once; what meets and is counted are the records' numbers, and only first records are fetched.
    """
    clean = normalize or (lambda c: fold(c, ascii_only=True))
    hits = actors_in(actors, records.select(F.col(year).alias("_y"), F.col(order).alias("_o"), clean(haystack(*map(F.col, texts))).alias("_hay")))
    first = hits.groupBy("actor", "_y").agg(F.min("_o").alias("_o"), F.count("*").alias("n_matches"))
    rest = [c for c in records.columns if c not in ("actor", year)]
    found = first.join(records.select(year, *rest), (F.col("_o") == F.col(order)) & F.col("_y").eqNullSafe(F.col(year)))
    return found.select("actor", year, *rest, "n_matches")


HEAVY = 1_000_000


def provider_relations(actors: DataFrame, relations: DataFrame, actor_id: str = "identifiant_national", client_id: str = "identifiant_national_client", digits: int = 9, heavy: int = HEAVY) -> DataFrame:
    """Relations whose client id starts with the first characters of the actor's id.

    A client id stands under its prefix of each length that some actor's has (up to `digits` lengths), and prefixes meet by equality.
    A prefix with more than `heavy` relations is dealt out in shares of that many, and its actors stand in each share; all others
    meet as they are.
    """
    a = actors.withColumn("_p", F.substring(actor_id, 1, digits)).filter("_p <> ''")
    lengths = a.agg(F.collect_set(F.length("_p")).alias("_lengths"))  # one row
    r = relations.filter(F.col(client_id) != "").crossJoin(F.broadcast(lengths)).withColumn("_n", F.explode("_lengths"))
    r = r.withColumn("_p", F.substring(client_id, F.lit(1), F.col("_n"))).filter(F.length("_p") == F.col("_n")).drop("_n", "_lengths")
    counts = r.groupBy("_p").agg(F.count("*").alias("_c")).filter(F.col("_c") > heavy)
    shares = F.broadcast(counts.select("_p", F.ceil(F.col("_c") / heavy).alias("_shares")))  # at most one row for each `heavy` relations
    dealt = r.join(shares, "_p", "left").withColumn("_share", F.when(F.col("_shares").isNotNull(), F.pmod(F.monotonically_increasing_id(), "_shares")).otherwise(F.lit(0))).drop("_shares")
    every = a.join(shares, "_p", "left").withColumn("_share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_shares", F.lit(1)) - 1))).drop("_shares")
    return every.join(dealt, ["_p", "_share"]).drop("_p", "_share")


def resolve_names(queries: DataFrame, results: DataFrame, kept: int = 10) -> DataFrame:
    """Candidates of each searched name: exact names first, then by rank until `kept` in all; never fewer than the exact ones.

    queries: query; results: query, rank, name, and more columns. Exact names and the others are numbered by themselves, so that
    of the others each task sends on `kept` of a query at most, and no task sorts all results of one.
    """
    same = F.coalesce(F.lower(F.trim("name")) == F.lower(F.trim("query")), F.lit(False))
    asked = results.join(queries.select("query").distinct(), "query", "left_semi").withColumn("exact", same)
    by = W.partitionBy("query").orderBy("rank")
    exact = asked.filter("exact").withColumn("position", F.row_number().over(by))
    rest = asked.filter("not exact").withColumn("position", F.row_number().over(by)).filter(F.col("position") <= kept)
    before = exact.groupBy("query").agg(F.count("*").cast("int").alias("_before"))
    rest = rest.join(before, "query", "left").withColumn("position", F.col("position") + F.coalesce("_before", F.lit(0))).filter(F.col("position") <= kept).drop("_before")
    return exact.unionByName(rest)


def attach_filing(actors: DataFrame, filings: DataFrame, folder: str = "folder", order: str = "_ord") -> DataFrame:
    """Actors with the filing of their folder name, the last of several; total and detail are null without one."""
    last = first_per_key(filings, ["folder_org_name"], [order], last=True)
    detail = F.struct("montant_employes", "cabinets", "montant_avantages")
    own = last.select(F.col("folder_org_name").alias("_f"), "total_declare", detail.alias("detail"))
    return actors.join(own, F.col(folder) == F.col("_f"), "left").drop("_f")
