"""Meeting feeds and what is counted over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerwatch.functions.parameters import OTHER, UNKNOWN_ACTOR, UNKNOWN_COUNTRY
from ledgerwatch.functions.predicates import exclude_names, is_excluded
from ledgerwatch.functions.text import meeting_dg, meeting_person_role

from .windows import dedupe_feed

FEED = "date date, actor string, institution string, dg string, with_whom string, subject string, procedure string"


def dedupe_meetings(rows: DataFrame, keys: list[str], sets: list[str], firsts: list[str], order: str = "_ord") -> DataFrame:
    """One row for each key, nulls equal: arrays united and sorted, other columns of the first row.

    Equal arrays of a key are collected once before the shuffle, then united; a meeting's arrays are few.
    """
    united = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in sets]
    return rows.groupBy(*keys).agg(*united, *(F.min_by(c, order).alias(c) for c in firsts), F.min(order).alias(order))


def distinct_actors(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct names of a column or of arrays, without blanks."""
    names = F.explode(col) if df.schema[col].dataType.typeName() == "array" else F.col(col)
    return df.select(names.alias("name")).filter(F.trim("name") != "").distinct().orderBy("name")


def meetings_by_org(meetings: DataFrame, since: str, key: str = "register_id") -> DataFrame:
    """Of each organisation its meetings since a day, newest first and undated last, and how many; blank member ids and procedures become null."""
    rows = meetings.filter(F.col("date") >= F.lit(since).cast("date")).withColumn("member_id", F.nullif(F.trim("member_id"), F.lit(""))).withColumn("procedure", F.nullif(F.trim("procedure"), F.lit("")))
    entry = F.struct(F.date_diff(F.lit("9999-12-31").cast("date"), F.col("date")).alias("_back"), "_ord", "date", "member_id", "title", "procedure")
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda m: m.dropFields("_back", "_ord"))
    return rows.groupBy(key).agg(listed.alias("meetings"), F.count("*").alias("n_meetings"))


def label(attendees: Column) -> Column:
    return F.when(F.size(attendees) > 0, F.array_join(attendees, ", ")).otherwise(UNKNOWN_ACTOR)


def meeting_feed(orgs_ep: DataFrame, orgs_ec: DataFrame, ep_out: DataFrame, ec_out: DataFrame, excluded: list[str]) -> DataFrame:
    """Tracked and outside meetings of both institutions in one shape; branch and _ord give the order of the sources.

    orgs_ep: name, date, member_name, title, procedure; orgs_ec: name, date, representative; ep_out: date, attendees (array),
    member_name, title, procedure; ec_out: date, org, dg, host, subject; all with _ord.
    """
    none = F.lit(None).cast("string")

    def shape(df: DataFrame, branch: int, actor, institution: str, dg, with_whom, subject, procedure) -> DataFrame:
        return df.select(F.lit(branch).alias("branch"), "_ord", "date", actor.alias("actor"), F.lit(institution).alias("institution"), dg.alias("dg"), with_whom.alias("with_whom"), subject.alias("subject"), procedure.alias("procedure"))

    empty = lambda c: F.nullif(F.col(c), F.lit(""))
    parts = [
        shape(orgs_ep, 0, F.col("name"), "parliament", none, empty("member_name"), empty("title"), empty("procedure")),
        shape(orgs_ec, 1, F.col("name"), "commission", meeting_dg(F.col("representative")), meeting_person_role(F.col("representative")), none, none),
        shape(exclude_names(ep_out, "attendees", excluded), 2, label(F.col("attendees")), "parliament", none, empty("member_name"), empty("title"), empty("procedure")),
        shape(exclude_names(ec_out, "org", excluded), 3, F.coalesce(empty("org"), F.lit(UNKNOWN_ACTOR)), "commission", empty("dg"), empty("host"), empty("subject"), none),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def latest_meetings(feed: DataFrame, n: int | None = 5) -> DataFrame:
    """The feed without repeats, newest first and undated last; the first n."""
    once = dedupe_feed(feed.withColumn("_at", F.struct("branch", "_ord")), ["date", "institution", "actor", "subject"], "_at").drop("_at")
    ordered = once.orderBy(F.col("date").desc_nulls_last(), "branch", "_ord")
    return ordered if n is None else ordered.limit(n)


def top_officials(tracked: DataFrame, outside: DataFrame, excluded: list[str], n: int) -> DataFrame:
    """The n officials with most meetings, and the latest of each; of equal dates the first seen.

    A meeting with several tracked organisations counts for each, an outside one once. tracked: official, date, actor, subject;
    outside: official, date, attendees, subject; both with _ord.
    """
    a = tracked.select("official", "date", "actor", "subject", F.lit(0).alias("branch"), "_ord")
    b = exclude_names(outside, "attendees", excluded).select("official", "date", label(F.col("attendees")).alias("actor"), "subject", F.lit(1).alias("branch"), "_ord")
    rows = a.unionByName(b).filter(F.col("official") != "")
    rank = F.struct(F.coalesce(F.col("date"), F.lit("0001-01-01").cast("date")), -F.col("branch"), -F.col("_ord"))
    out = rows.groupBy("official").agg(F.count("*").alias("n_meetings"), F.max_by(F.struct("date", "actor", "subject"), rank).alias("latest"), F.min(F.struct("branch", "_ord")).alias("_first"))
    return out.orderBy(F.col("n_meetings").desc(), "_first").limit(n).drop("_first")


def with_country(meetings: DataFrame, countries: DataFrame, key: str = "member_id") -> DataFrame:
    return meetings.join(countries.select(key, "country_name"), key, "left").withColumn("country", F.coalesce("country_name", F.lit(UNKNOWN_COUNTRY))).drop("country_name")


def country_breakdown(meetings: DataFrame) -> DataFrame:
    return meetings.groupBy("country").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "country")


def top_n_with_other(df: DataFrame, n: int, name: str = "country", count: str = "n") -> DataFrame:
    """The first n groups, the rest as one if there is any, and each one's share. df: one row for each group."""
    top = df.orderBy(F.col(count).desc(), name).limit(n)
    rest = df.join(top.select(name), name, "left_anti").agg(F.sum(count).alias(count)).filter(F.col(count) > 0).select(F.lit(OTHER).alias(name), count)
    both = top.select(name, count).unionByName(rest)
    return both.withColumn("share", F.col(count) / F.sum(count).over(W.partitionBy()))  # n + 1 rows at most


def last_contact(ep_out: DataFrame, ec_out: DataFrame, excluded: list[str]) -> DataFrame:
    """The latest meeting of each outside organisation; of equal dates the first seen, parliament before commission. Names are excluded one by one."""
    a = ep_out.select(F.explode("attendees").alias("name"), "date", F.lit("parliament").alias("institution"), F.nullif("member_name", F.lit("")).alias("with_whom"), F.nullif("title", F.lit("")).alias("subject"), F.lit(0).alias("branch"), "_ord")
    b = ec_out.select(F.col("org").alias("name"), "date", F.lit("commission").alias("institution"), F.coalesce(F.nullif("host", F.lit("")), F.nullif("dg", F.lit(""))).alias("with_whom"), F.nullif("subject", F.lit("")).alias("subject"), F.lit(1).alias("branch"), "_ord")
    rows = a.unionByName(b).filter((F.col("name") != "") & ~is_excluded(F.col("name"), excluded))
    rank = F.struct(F.coalesce(F.col("date"), F.lit("0001-01-01").cast("date")), -F.col("branch"), -F.col("_ord"))
    return rows.groupBy("name").agg(F.max_by(F.struct("date", "institution", "with_whom", "subject"), rank).alias("_l")).select("name", "_l.*")


def combined_totals(totals: DataFrame, ep_out: DataFrame, ec_out: DataFrame, excluded: list[str]) -> DataFrame:
    """One-row totals with the outside meetings of each institution added."""
    ep = exclude_names(ep_out, "attendees", excluded).agg(F.count("*").alias("_ep"))
    ec = exclude_names(ec_out, "org", excluded).agg(F.count("*").alias("_ec"))
    both = totals.crossJoin(ep).crossJoin(ec)  # one row each
    return both.withColumn("ep_meetings", F.coalesce("ep_meetings", F.lit(0)) + F.col("_ep")).withColumn("ec_meetings", F.coalesce("ec_meetings", F.lit(0)) + F.col("_ec")).drop("_ep", "_ec")


def remaining_ids(meetings: DataFrame, resolved: DataFrame, id_col: str = "member_id") -> DataFrame:
    """Sorted distinct ids that aren't blank and not resolved yet."""
    ids = meetings.select(F.col(id_col).cast("string").alias("id")).filter("id <> ''").distinct()
    return ids.join(resolved.select(F.col("id").cast("string").alias("id")), "id", "left_anti").orderBy("id")
