"""Joins: rows with a value of their key, normalised tables, grouped frames.

Joins of tables leave broadcast or sort-merge to the sizes Spark finds.  :func:`attach` is for rows and an
aggregate of the same rows, where the adaptive skew join does not step in because the aggregate is already
partitioned by the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.operators.scale import GROUP_ROWS, is_small, settled

#: Most keys that can count as hot, and so most rows of the broadcast list of them.
HOT_KEYS = 10_000


def _dealt(rows: DataFrame, table: DataFrame, key: str, size: str, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows with a salt, and the table (key column ``_key``) with a copy of its row for every salt of a key."""
    limit = F.greatest(F.lit(float(hot_rows)), table.agg(F.sum(size)).scalar() / F.lit(float(HOT_KEYS)))
    blocks = F.greatest(F.ceil(F.col(size) / limit).cast("int"), F.lit(1))
    hot = table.where(F.col(size) > limit).select(F.col("_key").alias("_hot"), blocks.alias("_blocks"))
    salt = F.pmod(F.xxhash64(*rows.columns) + F.spark_partition_id(), F.coalesce("_blocks", F.lit(1))).cast("int")
    marked = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), "left")
    copies = table.withColumn("_copy", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return marked.withColumn("_salt", salt).drop("_hot", "_blocks"), copies


def attach(
    rows: DataFrame, table: DataFrame, key: str, size: str, how: str = "inner", hot_rows: int = GROUP_ROWS,
    small_bytes: int | None = None,
) -> DataFrame:
    """Rows with the columns of a table that has one row per key and the key's number of rows in ``size``.

    A key with more than ``hot_rows`` rows (or a 10,000th of all rows, so that there are at most 10,000
    such keys) is salted: its rows are dealt over several join keys and its table row is copied to each.
    The salt is a hash of the row and its partition, so a repeated task deals the same way.  Null keys match.
    """
    table = table.withColumnRenamed(key, "_key")
    match = F.col(key).eqNullSafe(F.col("_key"))
    if is_small(rows, small_bytes):
        return rows.join(table, match, how).drop("_key", size)
    dealt, copies = _dealt(rows, settled(table), key, size, hot_rows)
    return dealt.join(copies, match & (F.col("_salt") == F.col("_copy")), how).drop("_key", size, "_salt", "_copy")


def with_group_value(df: DataFrame, key: str, value: Column, name: str, **scale) -> DataFrame:
    """Every row with an aggregate of its key's rows.

    An aggregate and a join: a window over the key would bring all rows of a key into one task.
    """
    return with_group_values(df, key, {name: value}, **scale)


def with_group_values(df: DataFrame, key: str, values: dict[str, Column], **scale) -> DataFrame:
    """Every row with several aggregates of its key's rows, from one grouping."""
    grouped = df.groupBy(key).agg(*[v.alias(name) for name, v in values.items()], F.count("*").alias("_rows"))
    return attach(df, grouped, key, "_rows", **scale)


def denormalize(
    products: DataFrame, categories: DataFrame, suppliers: DataFrame, category_key: str = "category_id",
    supplier_key: str = "supplier_id",
) -> DataFrame:
    """Products with their category and supplier columns."""
    return products.join(categories, category_key).join(suppliers, supplier_key)


def join_aggregates(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join of two already grouped frames."""
    return left.join(right, list(on), how)
