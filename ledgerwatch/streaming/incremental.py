"""Nightly increments as batch functions over tables; `stateful` has the same as streams that keep their tables as state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.predicates import contains_any
from ledgerwatch.operators.windows import first_per_key

STORE = "id string, name string, registrationDate date, match string, detected_at string"


def labelled(df: DataFrame, keywords: list[str]) -> DataFrame:
    """`match` says where a keyword was found: name first, then objectives; null without one."""
    hit = lambda c: F.coalesce(contains_any(F.lower(F.col(c)), keywords), F.lit(False))
    return df.withColumn("match", F.when(hit("name"), "name").when(hit("objectives"), "objectives"))


def new_registrants(feed: DataFrame, store: DataFrame, keywords: list[str], detected_at: str, order: str = "_ord") -> DataFrame:
    """Rows to append: ids not yet stored whose name or objectives match, the first of an id. Others are tested again next time."""
    fresh = feed.filter(F.col("id").isNotNull()).join(store.select("id"), "id", "left_anti")
    matched = labelled(fresh, keywords).filter(F.col("match").isNotNull())
    return first_per_key(matched, ["id"], [order]).select("id", "name", "registrationDate", "match", F.lit(detected_at).alias("detected_at"))


def backfill_registrants(results: DataFrame, store: DataFrame, keywords: list[str], detected_at: str, min_stock: int = 10) -> DataFrame:
    """While the store is small: search results of all keywords in order, each id judged once, under the first keyword that returned it.

    results: keyword, kw_ord, id, name, objectives, registration_date.
    """
    stock = store.select("id").distinct().agg((F.count("*") < min_stock).alias("_small"))
    once = first_per_key(results.filter(F.col("id").isNotNull()), ["id"], ["kw_ord"]).join(store.select("id"), "id", "left_anti")
    matched = labelled(once, keywords).filter(F.col("match").isNotNull()).crossJoin(stock).filter("_small")  # one row
    return matched.select("id", "name", F.col("registration_date").alias("registrationDate"), F.concat_ws(":", F.lit("search"), "keyword", "match").alias("match"), F.lit(detected_at).alias("detected_at"))


def detect_accreditations(previous: DataFrame, current: DataFrame, seen: DataFrame, baselines: DataFrame, fetched: DataFrame) -> DataFrame:
    """Persons in the current snapshot, in neither the previous one nor the reports so far.

    Only for organisations with a baseline (which may be empty) and a good fetch. Keys are null-safe.
    baselines: register_id; fetched: register_id, ok.
    """
    keys = ["register_id", "surname", "first_name", "start_date"]
    good = fetched.filter("ok").select("register_id").intersect(baselines.select("register_id"))
    out = current.select(*keys).distinct().join(good, "register_id", "left_semi")
    for known in (previous, seen):
        k = known.select(*(F.col(c).alias(f"_{c}") for c in keys)).distinct()
        same = F.lit(True)
        for c in keys:
            same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        out = out.join(k, same, "left_anti")
    return out


def next_baseline(previous: DataFrame, current: DataFrame, fetched: DataFrame) -> DataFrame:
    """The snapshot to compare with next time: the current one after a good fetch, else the previous one."""
    good = fetched.filter("ok").select("register_id").distinct()
    keys = ["register_id", "surname", "first_name", "start_date"]
    return current.select(*keys).join(good, "register_id", "left_semi").unionByName(previous.select(*keys).join(good, "register_id", "left_anti"))
