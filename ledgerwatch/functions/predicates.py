"""Filters and row states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keywords import FEW, contains_any, matched_words
from .text import fold


def joined_text(cols: list[str]) -> Column:
    return F.lower(F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols)))


def keyword_filter(df: DataFrame, cols: list[str], keywords: list[str], matched: str | None = None) -> DataFrame:
    """Rows of which the joined columns hold a keyword, as a substring in any case; `matched` names a column for the keywords found."""
    text = joined_text(cols)
    out = df.filter(contains_any(text, keywords))
    return out.withColumn(matched, matched_words(text, keywords)) if matched else out


def keyword_filter_folded(df: DataFrame, col: str, keywords: list[str]) -> DataFrame:
    """The same after accents have been removed; a null text doesn't match. A text is folded once, for a pattern of all words or the automaton."""
    if len(keywords) > FEW:
        return df.filter(contains_any(fold(F.col(col)), keywords))
    quoted = ["\\Q" + k.replace("\\E", "\\E\\\\E\\Q") + "\\E" for k in keywords]
    return df.filter(F.rlike(fold(F.col(col)), F.lit("|".join(quoted))) if keywords else F.lit(False))


def is_excluded(name: Column, names: list[str]) -> Column:
    return F.coalesce(contains_any(F.lower(name), [n.lower() for n in names]), F.lit(False))


def exclude_names(df: DataFrame, col: str, names: list[str]) -> DataFrame:
    """Drops rows with an excluded name; in an array one such entry drops the row."""
    if df.schema[col].dataType.typeName() == "array":
        return df.filter(~F.coalesce(F.exists(col, lambda x: is_excluded(x, names)), F.lit(False)))
    return df.filter(~is_excluded(F.col(col), names))


def since(df: DataFrame, date_col: str, day: str) -> DataFrame:
    return df.filter(F.col(date_col) >= F.lit(day).cast("date"))


def since_counts(df: DataFrame, key: str, date_col: str, day: str) -> DataFrame:
    """Rows of each key in all and from that day on."""
    return df.groupBy(key).agg(F.count("*").alias("total_count"), F.count_if(F.col(date_col) >= F.lit(day).cast("date")).alias("since_count"))


def exercise_scope(df: DataFrame, low: int, high: int, year: str = "annee_fin", budget: str = "montant_depense_inf") -> DataFrame:
    return df.filter(F.col(year).between(low, high) & F.col(budget).isNotNull())


def unpublished(activities: str = "nombre_activites", budget: str = "montant_depense_inf", staff: str = "nombre_salaries") -> Column:
    """No activity, a zero budget and no staff figure; a missing activity count or budget isn't a zero."""
    return F.coalesce((F.col(activities) == 0) & (F.col(budget) == 0) & F.col(staff).isNull(), F.lit(False))


def drop_unpublished(df: DataFrame, **cols: str) -> DataFrame:
    return df.filter(~unpublished(**cols))


def exercise_state(activities: str = "nombre_activites", budget: str = "montant_depense_inf", staff: str = "nombre_salaries") -> Column:
    """unpublished, means_only or published; the first that holds."""
    return F.when(unpublished(activities, budget, staff), "unpublished").when((F.col(activities) == 0) & (F.col(budget) != 0), "means_only").otherwise("published")


def nonzero_filings(df: DataFrame, total: str = "total_declare") -> tuple[DataFrame, DataFrame]:
    """Filings with a positive total, and the others."""
    positive = F.coalesce(F.col(total) > 0, F.lit(False))
    return df.filter(positive), df.filter(~positive)


def categorize_entity(section: Column, kind: Column) -> Column:
    """The category of a tracked organisation from its register section and type."""
    text = F.lower(F.coalesce(kind, F.lit("")))
    return F.when(F.startswith(F.trim(F.coalesce(section, F.lit(""))), F.lit("Harm reduction")), "harm_reduction").when(contains_any(text, ["manufacturer", "tobacco company", "distributor"]), "manufacturer").otherwise("trade_association")


def declaration_status(amount: Column, rules: list[tuple[Column, str]]) -> Column:
    """declared with an amount, else the status of the first rule that holds, else none."""
    out = F.lit("none")
    for condition, status in reversed(rules):
        out = F.when(condition, status).otherwise(out)
    return F.when(F.coalesce(amount, F.lit(0)) != 0, "declared").otherwise(out)
