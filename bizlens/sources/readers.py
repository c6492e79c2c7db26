"""Scans: delimited text with a declared schema, tables, previews, counts and schema listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_SCHEMA = "position int, column_name string, data_type string, nullable boolean"


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True, **options) -> DataFrame:
    """Comma-separated UTF-8 text.  The schema is given, so the files are read once; fields that do not
    fit their type become null."""
    reader = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
    return reader.options(**options).csv(path)


def table(spark: SparkSession, name: str) -> DataFrame:
    """A catalogue table, or a Parquet path when ``name`` looks like one."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def column_count(df: DataFrame) -> int:
    return len(df.columns)


def describe_schema(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of every column; reads no data."""
    fields = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(fields, _SCHEMA)


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count("*").alias("total_rows"), F.lit(len(df.columns)).alias("total_columns"))
