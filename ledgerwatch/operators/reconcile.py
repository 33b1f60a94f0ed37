"""Two sources against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.text import norm_name


def spine(actors: DataFrame, years: list[int]) -> DataFrame:
    """A row for each actor and year."""
    return actors.select("*", F.explode(F.array(*map(F.lit, years))).alias("year"))


def budget_mismatch(low: Column, high: Column, filed: Column) -> Column:
    """The filed amount is out of the bracket, or just one source has a value; a missing upper end alone is no mismatch."""
    both = filed.isNotNull() & low.isNotNull() & high.isNotNull()
    return F.when(both, ~filed.between(low, high)).otherwise(filed.isNotNull() != low.isNotNull())


def reconcile_budgets(actors: DataFrame, exercises: DataFrame, filings: DataFrame, years: list[int]) -> DataFrame:
    """(actor, year, low, high, filed, mismatch). exercises: actor, year, low, high; filings: actor, year, filed; one row for each."""
    out = spine(actors.select("actor"), years).join(exercises.select("actor", "year", "low", "high"), ["actor", "year"], "left").join(filings.select("actor", "year", "filed"), ["actor", "year"], "left")
    return out.withColumn("mismatch", budget_mismatch(F.col("low"), F.col("high"), F.col("filed")))


def headcount_mismatch(filed: Column, counted: Column) -> Column:
    """The filing has a count, and it isn't the number of people."""
    return F.coalesce(filed.isNotNull() & (filed != F.coalesce(counted, F.lit(0))), F.lit(False))


def reconcile_headcount(people: DataFrame, filings: DataFrame) -> DataFrame:
    """(actor, year, filed_people, n_people, mismatch). people: actor, n_people; filings: actor, year, filed_people."""
    return filings.join(people, "actor", "left").withColumn("n_people", F.coalesce("n_people", F.lit(0))).withColumn("mismatch", headcount_mismatch(F.col("filed_people"), F.col("n_people")))


def names_overlap(a: Column, b: Column) -> Column:
    """One normalised name holds the other; the empty name meets none."""
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))


def reconcile_names(left: Column, right: Column) -> Column:
    """(left_only, right_only, mismatch) of two arrays of names, in their order and with repeats; for long lists see `reconcile_lists`.

    Different names are compared once. A lambda evaluates all that it holds for each element, so what is made once is bound by `let`.
    """
    empty = F.array().cast("array<string>")
    let = lambda f, **made: F.get(F.transform(F.array(F.struct(*(c.alias(n) for n, c in made.items()))), f), F.lit(0))
    with_norm = lambda names: F.transform(F.coalesce(names, empty), lambda n: F.struct(n.alias("name"), norm_name(n).alias("norm")))
    norms = lambda x: F.array_distinct(F.transform(x, lambda p: p["norm"]))
    alone = lambda x, y: F.filter(x, lambda p: ~F.exists(y, lambda q: names_overlap(p, q)))
    only = lambda x, found: F.transform(F.filter(x, lambda p: F.array_contains(found, p["norm"])), lambda p: p["name"])
    compared = lambda s: let(lambda t: F.struct(only(s["a"], t["a"]).alias("left_only"), only(s["b"], t["b"]).alias("right_only")), a=alone(s["x"], s["y"]), b=alone(s["y"], s["x"]))
    out = let(lambda s: let(compared, a=s["a"], b=s["b"], x=norms(s["a"]), y=norms(s["b"])), a=with_norm(left), b=with_norm(right))
    return let(lambda s: F.struct(s["r"]["left_only"].alias("left_only"), s["r"]["right_only"].alias("right_only"), ((F.size(s["r"]["left_only"]) > 0) | (F.size(s["r"]["right_only"]) > 0)).alias("mismatch")), r=out)


def distinct_grams(name: Column, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.length(name) - size + 1)
    return F.when(F.length(name) >= size, F.array_distinct(F.transform(starts, lambda k: F.substring(name, k, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def unmatched_names(left: DataFrame, right: DataFrame, keys: list[str], gram: int = 3) -> DataFrame:
    """The rows of both lists whose name overlaps none of the other list of the same keys, with a column `side` (left or right).

    left, right: keys, name, and more columns that both have. For lists too long to meet in one row: a name that another one holds
    stands there with all its grams, so it is looked for under the rarest of them among the names of its keys; names shorter than a
    gram under themselves. Different names are compared once, however often they stand in the lists.
    """
    both = left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right")))
    written = both.select(*keys, "side", "name").distinct().withColumn("_norm", norm_name(F.col("name"))).filter("_norm <> ''")
    names = written.select(*keys, "side", "_norm").distinct()
    matched = []
    for size in range(1, gram + 1):
        shorter = F.length("_norm") == size if size < gram else F.length("_norm") >= size
        held = names.select(*keys, F.col("side").alias("_in"), F.col("_norm").alias("_long"), F.explode(distinct_grams(F.col("_norm"), size)).alias("_gram"))
        counts = held.groupBy(*keys, "_gram").agg(F.count("*").alias("_n"))
        probes = names.filter(shorter).select(*keys, "side", "_norm", F.explode(distinct_grams(F.col("_norm"), size)).alias("_gram"))
        rarest = probes.join(counts, [*keys, "_gram"]).groupBy(*keys, "side", "_norm").agg(F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"))
        pairs = rarest.join(held, [*keys, "_gram"]).filter((F.col("side") != F.col("_in")) & F.contains("_long", F.col("_norm")))
        matched += [pairs.select(*keys, "side", "_norm"), pairs.select(*keys, F.col("_in").alias("side"), F.col("_long").alias("_norm"))]
    every = matched[0]
    for more in matched[1:]:
        every = every.unionByName(more)
    found = written.join(every.distinct(), [*keys, "side", "_norm"], "left_semi").drop("_norm")
    return both.join(found, [*keys, "side", "name"], "left_anti")


def reconcile_lists(left: DataFrame, right: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(keys, left_only, right_only, mismatch) of two lists of names as rows, in their order and with repeats; null keys are equal.

    left, right: keys, `order`, name. Names meet by joins (`unmatched_names`), and only those that are left over meet in one row.
    """
    of = lambda df: df.select(F.struct(*keys).alias("_keys"), order, "name")
    rows = unmatched_names(of(left), of(right), ["_keys"])
    own = lambda side: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == side, F.struct(order, "name")))), lambda x: x["name"]).alias(f"{side}_only")
    found = rows.groupBy("_keys").agg(own("left"), own("right"))
    every = of(left).select("_keys").union(of(right).select("_keys")).distinct().join(found, "_keys", "left")
    listed = [F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("left_only", "right_only")]
    return every.select("_keys.*", *listed, F.col("left_only").isNotNull().alias("mismatch"))


def summary_totals(actors: DataFrame, years: list[int], low: str = "budget_low", high: str = "budget_high", people: str = "n_people", filed: str = "total_declare", providers: str = "providers", history: str = "by_year") -> DataFrame:
    """One row: sums of the brackets that aren't (0, 0), of people and filings, number of distinct provider names, and by year the sum, null without a value."""
    real = ~((F.col(low) == 0) & (F.col(high) == 0))
    names = actors.select(F.explode(providers).alias("name")).agg(F.countDistinct("name").alias("n_providers"))
    by_year = [F.sum(F.try_element_at(history, F.lit(y))).alias(f"y{y}") for y in years]
    sums = actors.agg(F.count("*").alias("n_actors"), F.sum(F.when(real, F.col(low))).alias("low"), F.sum(F.when(real, F.col(high))).alias("high"), F.sum(people).alias("people"), F.sum(filed).alias("filed"), *by_year)
    return sums.crossJoin(names)  # one row each


def nest_years(rows: DataFrame) -> DataFrame:
    """(actor, years): a map from year to what both sources say. rows: actor, year, low, high, filed, filed_people, n_people, left_only, right_only."""
    low, high, filed = F.col("low"), F.col("high"), F.col("filed")
    entry = F.struct(
        F.struct("low", "high").alias("register"),
        F.struct("filed", "filed_people").alias("filing"),
        F.struct(
            budget_mismatch(low, high, filed).alias("budget"),
            headcount_mismatch(F.col("filed_people"), F.col("n_people")).alias("people"),
            ((F.size("left_only") > 0) | (F.size("right_only") > 0)).alias("providers"),
        ).alias("mismatches"),
        "left_only",
        "right_only",
    )
    return rows.groupBy("actor").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("year", entry)))).alias("years"))
