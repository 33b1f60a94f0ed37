"""Tracked organisations: seed list, current state, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import rank_rows

GROUPS = {"detail": True, "meetings": False, "snapshot": False}


def merge_entities(seed: DataFrame, live: DataFrame, key: str = "register_id") -> DataFrame:
    """Seed rows with their live state: a live value that isn't null wins, meeting counts have no fallback, missing lists are empty."""
    wins = ["budget_low", "budget_high", "people_involved", "nb_intermediaries"]
    lists = [c for c, t in live.dtypes if t.startswith("array")]
    counts = [c for c in ("ep_meetings", "ec_meetings") if c in live.columns]
    own = live.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_{c}") for c in wins), *(F.col(c).alias(f"_{c}") for c in lists + counts))
    out = seed.join(own, F.col(key) == F.col("_k"), "left")
    for c in wins:
        out = out.withColumn(c, F.coalesce(f"_{c}", c))
    for c in lists:
        out = out.withColumn(c, F.coalesce(F.col(f"_{c}"), F.array().cast(live.schema[c].dataType)))
    for c in counts:
        out = out.withColumn(c, F.col(f"_{c}"))
    return out.withColumn("has_register_id", F.col(key).isNotNull()).drop("_k", *(f"_{c}" for c in wins + lists + counts))


def global_totals(live: DataFrame) -> DataFrame:
    """Number of organisations and sums of upper budgets, people and meetings; nulls count as nothing."""
    total = lambda c: F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(0))), F.lit(0)).alias(c)
    return live.agg(F.count("*").alias("n_organisations"), *map(total, ("budget_high", "people_involved", "ep_meetings", "ec_meetings")))


def merge_live(current: DataFrame, update: DataFrame, key: str, groups: dict[str, list[str]], keep_on_error: dict[str, bool] | None = None) -> DataFrame:
    """The new version of the live table after one writer's update of its own column groups.

    update has the key, the groups' columns and for each group of it a column <group>_error, null after a good fetch. After a
    failed one a group with keep_on_error keeps its old values and takes the error; another group becomes null with the error.
    Groups that the update doesn't have, and rows that it doesn't name, stay.
    """
    keep = keep_on_error or GROUPS
    u = update.select(*(F.col(c).alias(f"_u_{c}") for c in update.columns), F.lit(True).alias("_u"))
    out = current.join(u, F.col(key) == F.col(f"_u_{key}"), "full_outer").withColumn(key, F.coalesce(key, f"_u_{key}"))
    named = F.coalesce(F.col("_u"), F.lit(False))
    for group, cols in groups.items():
        error = f"{group}_error"
        if f"_u_{error}" not in out.columns:
            continue
        failed = F.col(f"_u_{error}").isNotNull()
        for c in cols:
            new = F.when(failed, F.col(c) if keep.get(group, False) else F.lit(None)).otherwise(F.col(f"_u_{c}"))
            out = out.withColumn(c, F.when(named, new).otherwise(F.col(c)))
        out = out.withColumn(error, F.when(named, F.col(f"_u_{error}")).otherwise(F.col(error)))
    return out.select(*current.columns)


def quarantine(df: DataFrame, checks: dict[str, str], readable: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(results, anomalies): rows that fail a check go to the anomalies with the names of the checks, and stay results too if they can be read.

    checks: name to SQL condition of the fault; readable: SQL condition.
    """
    issues = F.array_compact(F.array(*(F.when(F.coalesce(F.expr(c), F.lit(False)), F.lit(n)) for n, c in checks.items())))
    marked = df.withColumn("issues", issues)
    ok = F.coalesce(F.expr(readable), F.lit(False)) if readable else F.lit(True)
    return marked.filter(ok).drop("issues"), marked.filter((F.size("issues") > 0) | ~ok)


def sort_by_budget(df: DataFrame, high: str = "budget_high", order: str = "_ord", position: str | None = None) -> DataFrame:
    """Highest first, unknown last; `position` names a column for each row's place."""
    keys = [F.col(high).desc_nulls_last(), F.col(order).asc()]
    return rank_rows(df, keys, name=position) if position else df.orderBy(*keys)


def recent_accreditations(orgs: DataFrame, n: int, name: str = "name") -> DataFrame:
    """The n persons accredited last; without a start date a person isn't listed."""
    people = orgs.select(name, F.explode("accredited_persons").alias("p")).select(name, "p.*").filter(F.col("start_date").isNotNull())
    return people.orderBy(F.col("start_date").desc(), name, "surname", "first_name").limit(n)
