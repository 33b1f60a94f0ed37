"""Window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerwatch.sources.scratch import checkpointed


SHARES = 4


def first_per_key(df: DataFrame, keys: list[str], order: list[Column] | list[str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key. An aggregate of the smallest row, so that partial results meet, not whole groups."""
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    own = F.struct(*df.columns)
    pick = F.max_by if last else F.min_by
    return df.groupBy(*keys).agg(pick(own, F.struct(*by)).alias("_row")).select("_row.*")


def current_or_latest_mandate(df: DataFrame, member: str, start: str, end: str, order: str) -> DataFrame:
    """Of each member the first open mandate, or else the one that started last."""
    open_ = F.col(end).isNull()
    by = W.partitionBy(member).orderBy(open_.desc(), F.when(open_, F.col(order)).asc(), F.when(~open_, F.col(start)).desc_nulls_last(), F.col(order))
    return df.withColumn("_n", F.row_number().over(by)).filter("_n = 1").drop("_n")


def dedupe_feed(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key; nulls are equal."""
    return first_per_key(df, keys, [order])


def split_columns(words: DataFrame, line: list[str], gap: float = 20.0) -> DataFrame:
    """Words of each line joined to columns; a gap wider than `gap` begins a new one.

    A task sorts its words and holds its columns at the same time, so lines are dealt to `SHARES` times as many tasks as other keys are.
    """
    words = words.repartition(SHARES * int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), *line)
    by = W.partitionBy(*line).orderBy("x0", "ord")
    wide = F.coalesce(F.col("x0") - F.lag("x1").over(by) > gap, F.lit(False))
    numbered = words.withColumn("column", F.sum(wide.cast("int")).over(by.rowsBetween(W.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "ord", "text"))), lambda w: w["text"]), " ")
    return numbered.groupBy(*line, "column").agg(text.alias("text"), F.min("x0").alias("x0"))


def rank_rows(df: DataFrame, order: list[Column], groups: list[str] | None = None, name: str = "rank") -> DataFrame:
    """1-based position within the groups. Without groups, rows are counted by ranges first, so that no task sorts them all."""
    if groups:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*groups).orderBy(*order)))
    dealt = checkpointed(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))  # both uses see one dealing
    inside = dealt.withColumn("_n", F.row_number().over(W.partitionBy("_part").orderBy(*order)))
    sizes = inside.groupBy("_part").agg(F.max("_n").alias("_size"))
    before = sizes.withColumn("_before", F.sum("_size").over(W.orderBy("_part")) - F.col("_size")).drop("_size")
    return inside.join(F.broadcast(before), "_part").withColumn(name, (F.col("_n") + F.col("_before")).cast("int")).drop("_part", "_n", "_before")


def contiguous_runs(df: DataFrame, series: str, year: str) -> DataFrame:
    """Numbers the runs of each series that no year breaks; the years are those of all series together.

    The distinct years are ranked in one task and sent to all: for columns of few values, such as years.
    """
    years = df.select(year).distinct()
    index = years.withColumn("_i", F.row_number().over(W.orderBy(year)))  # one row for a year
    placed = df.join(F.broadcast(index), year)
    run = F.col("_i") - F.row_number().over(W.partitionBy(series).orderBy(year))
    return placed.withColumn("_island", run).withColumn("run", F.dense_rank().over(W.partitionBy(series).orderBy("_island"))).drop("_i", "_island")
