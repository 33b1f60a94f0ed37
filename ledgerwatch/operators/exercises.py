"""Activities and budgets by year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import rank_rows


def activity_counts(matched: DataFrame, exercises: DataFrame, info: DataFrame, years: list[int], owner: str = "representants_id", year: str = "annee_fin", declared: str = "nombre_activites") -> DataFrame:
    """Matched rows and declared activities of each representative and year, for those with a match in one of the years.

    specialised: as many matched as declared in every year. info: one row for each representative.
    """
    found = matched.filter(F.col(year).isin(years)).groupBy(owner).agg(*(F.count_if(F.col(year) == y).alias(f"matched_{y}") for y in years))
    total = lambda y: F.coalesce(F.sum(F.when(F.col(year) == y, F.col(declared))), F.lit(0)).cast("long").alias(f"declared_{y}")
    totals = exercises.join(found.select(owner), owner, "left_semi").groupBy(owner).agg(*map(total, years))
    out = found.join(totals, owner, "left").na.fill(0, [f"declared_{y}" for y in years])
    same = F.lit(True)
    for y in years:
        same &= F.col(f"matched_{y}") == F.col(f"declared_{y}")
    return out.withColumn("specialised", same).join(info, owner)


def sort_by_activity(df: DataFrame, years: list[int], order: str, position: str | None = None) -> DataFrame:
    """Most matched activities of the years first; `position` names a column for each row's place."""
    keys = [sum((F.col(f"matched_{y}") for y in years), F.lit(0)).desc(), F.col(order).asc()]
    return rank_rows(df, keys, name=position) if position else df.orderBy(*keys)


def yearly_totals(df: DataFrame, year: str, amount: str) -> DataFrame:
    """Sum and number of organisations of each year; rows without an amount don't count."""
    return df.filter(F.col(amount).isNotNull()).groupBy(year).agg(F.sum(amount).alias("total"), F.count("*").alias("n_organisations"))


def budget_history(actors: DataFrame, exercises: DataFrame, owner: str = "representants_id", year: str = "annee_fin", amount: str = "montant_depense_inf", order: str = "_ord") -> DataFrame:
    """Each actor with a map from year to amount, empty without exercises; of a repeated year the last row counts."""
    last = exercises.groupBy(owner, year).agg(F.max_by(amount, order).alias("amount"))
    maps = last.groupBy(owner).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(year, "amount")))).alias("by_year"))
    empty = F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<bigint>"))
    return actors.join(maps, owner, "left").withColumn("by_year", F.coalesce(F.col("by_year").cast("map<int,bigint>"), empty))


def history_columns(actors: DataFrame, history: str, years: list[int]) -> DataFrame:
    """One column for each year of a map, null where the actor has no value."""
    return actors.select("*", *(F.try_element_at(history, F.lit(y)).alias(f"y{y}") for y in years)).drop(history)


def union_filings(*years: DataFrame) -> DataFrame:
    """Filings of years with different columns."""
    out = years[0]
    for more in years[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def history_series(history: DataFrame, totals: DataFrame, actors: DataFrame, name: str = "actor", total_name: str = "total") -> DataFrame:
    """(series, year, amount): a series for each charted actor, one row without a year if it has no history, and the total's.

    history: actor, by_year map; totals: year, total.
    """
    rows = history.select(F.col(name).alias("series"), F.explode_outer("by_year").alias("year", "amount"))
    own = actors.select(F.col(name).alias("series")).distinct().join(rows, "series", "left")
    return own.unionByName(totals.select(F.lit(total_name).alias("series"), F.col("year").cast("int").alias("year"), F.col("total").cast("bigint").alias("amount")))
