"""Reading the landed files, and writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions import schemas

from .ranges import csv_records, json_records


CSV = {"escape": '"', "multiLine": "true"}


def read_register_csv(spark: SparkSession, path: str, table: str, pattern: str | None = None) -> DataFrame:
    """A table of the register export, wherever it lies below the path: UTF-8, semicolons, quoted fields over several lines.

    `pattern` names the files where they don't have the export's own name. A file is read by as many tasks as it has byte ranges.
    """
    name, schema = schemas.REGISTER_FILES[table]
    names = spark.read.options(sep=";", header=True, **CSV).option("recursiveFileLookup", True).option("pathGlobFilter", pattern or name).csv(path).columns
    texts = csv_records(spark, path, ";", pattern or name)
    rows = texts.select(F.from_csv("text", ", ".join(f"`{c.replace('`', '``')}` string" for c in names), {"sep": ";", **CSV}).alias("r")).select("r.*") if names else texts
    wanted = T.StructType.fromDDL(schema)
    return rows.select(*((F.col(f.name).try_cast(f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted.fields))


def read_meeting_csv(spark: SparkSession, path: str) -> DataFrame:
    """Search exports, one file for each keyword; the keyword is the file's name. A file is read by as many tasks as it has byte ranges."""
    rows = csv_records(spark, path, ",", named=True).select("file", F.from_csv("text", schemas.EP_ROW, CSV).alias("r")).select("r.*", "file")
    return rows.withColumn("keyword", F.regexp_extract("file", r"([^/]+?)(?:\.csv)?$", 1)).drop("file")


def read_json_records(spark: SparkSession, path: str, schema: str, wrapped_in: str | None = None) -> DataFrame:
    """A file that is one array of records, or an object that has it in a field; a bare NaN in a text column becomes null.

    A file is read by as many tasks as it has byte ranges.
    """
    kind = f"array<struct<{', '.join(struct_fields(schema))}>>"
    rows = json_records(spark, path, wrapped_in).select(F.explode(F.from_json(F.concat(F.lit("["), "text", F.lit("]")), kind)).alias("r")).select("r.*")
    return rows.select(*((F.when(~F.col(c).isin("NaN", "\"NaN\""), F.col(c)) if t == "string" else F.col(c)).alias(c) for c, t in rows.dtypes))


def struct_fields(schema: str) -> list[str]:
    return [f"`{f.name}`:{f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema).fields]


def read_keyed_json(spark: SparkSession, path: str, value: str, field: str | None = None) -> DataFrame:
    """(key, value) of an object keyed by id, or of one of its fields. Inner maps written as [] are null; rows with an error field are dropped.

    A file is read by as many tasks as it has byte ranges, and each entry is parsed once if its value is a struct.
    """
    kind = T.StructType.fromDDL(f"v {value}")["v"].dataType
    entries = F.concat(F.lit("{"), "text", F.lit("}"))
    texts = json_records(spark, path, field, keyed=True)
    if isinstance(kind, T.StructType) and "error" not in kind.names:
        more = T.MapType(T.StringType(), T.StructType([*kind.fields, T.StructField("error", T.StringType())]))
        rows = texts.select(F.explode(F.from_json(entries, more)).alias("key", "value")).filter("value.error IS NULL")
        return rows.withColumn("value", F.when(F.col("value").isNotNull(), F.col("value").dropFields("error")))
    raw = F.try_element_at(F.from_json(entries, "map<string,string>"), "key")
    rows = texts.select(F.explode(F.from_json(entries, f"map<string,{value}>")).alias("key", "value"), "text")
    return rows.filter(F.coalesce(F.get_json_object(raw, "$.error").isNull(), F.lit(True))).drop("text")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): a row for each document."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def write_yearly(df: DataFrame, path: str, year: str = "source_year", kind: str = "parquet") -> None:
    """One folder for each year; only the years in df are replaced. Rows meet by year, and a large year is split, so that files are neither many nor huge."""
    df.hint("rebalance", F.col(year)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).format(kind).save(path)
