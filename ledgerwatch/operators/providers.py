"""Consultancies that work for an actor, and the people it declares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.text import map_value

from .windows import first_per_key


def active_years(relations: DataFrame, years: list[int], start: str = "start", provider_end: str = "provider_end") -> DataFrame:
    """A row for each year in which a relation is active: begun by its end, and the provider itself not gone by its begin.

    The relation's own end doesn't count. A null time is open.
    """
    year = F.explode(F.array(*map(F.lit, years))).alias("year")
    rows = relations.select("*", year)
    first = F.make_timestamp(F.col("year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    last = F.make_timestamp(F.col("year"), F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59))
    open_ = lambda c, test: F.col(c).isNull() | test
    return rows.filter(open_(start, F.col(start) <= last) & open_(provider_end, F.col(provider_end) >= first))


def current_providers(relations: DataFrame, info: DataFrame, actor: str = "actor", provider: str = "representants_id", end: str = "dateCessation") -> DataFrame:
    """(actor, provider name), distinct, of the relations that haven't ended; the other rule for the same question."""
    return relations.filter(F.col(end).isNull()).select(actor, provider).distinct().join(info, provider).select(actor, F.col("denomination").alias("provider")).distinct()


def provider_years(rows: DataFrame, aliases: dict[str, str] | None = None, actor: str = "actor", provider: str = "provider", year: str = "year") -> DataFrame:
    """Of each actor its providers sorted by name, each with its sorted years, after aliases are merged; and their number."""
    named = rows.select(actor, map_value(F.col(provider), aliases or {}).alias("provider"), year)
    by_provider = named.groupBy(actor, "provider").agg(F.array_sort(F.collect_set(year)).alias("years"))
    listed = F.array_sort(F.collect_list(F.struct("provider", "years")))
    return by_provider.groupBy(actor).agg(listed.alias("providers"), F.count("*").alias("n_providers"))


def distinct_people(people: DataFrame, owner: str, surname: str, first_name: str, order: str = "_ord") -> DataFrame:
    """People of each owner: equal in capitals and without outer blanks is one, in its first spelling; sorted list and number."""
    key = lambda c: F.upper(F.trim(F.coalesce(F.col(c), F.lit(""))))
    first = first_per_key(people.withColumn("_s", key(surname)).withColumn("_f", key(first_name)), [owner, "_s", "_f"], [order])
    shown: Column = F.concat_ws(" ", first_name, surname)
    return first.groupBy(owner).agg(F.array_sort(F.collect_list(shown)).alias("people"), F.count("*").alias("n_people"))
