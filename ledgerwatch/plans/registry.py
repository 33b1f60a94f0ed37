"""All queries of the register operators, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import feeds, joins, landed, scalars
from .roles import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship", "feeds", "joins", "landed", "scalars"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["flagship_activity_discovery"](spark, sf_dir)
