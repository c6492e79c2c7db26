"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.llm.text import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = "mix-1"
#: Hexadecimal digits of the draw that name a document's cell; only one cell per source is sorted.
CELL_DIGITS = 4


def source_key(source: str) -> Column:
    """Sources as text that sorts by code point with null last."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("t"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """One row per ``key`` with source_size and target, from rows of (key, size).

    Each source gets ``level * weight``, clamped at ``epochs`` times its size.  What a clamped source leaves is
    shared by weight among the others: the level rises until no further source reaches its clamp.  Each round is
    one aggregate of the sources, and a round that clamps no new source is the last.  The weights repeat in the
    order of the keys, for which one row per source is numbered.
    """
    place = (F.row_number().over(Window.orderBy("key")) - 1) % len(weights)
    table = stored(
        sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("long")),
        "sources")
    limit = epochs * F.col("source_size")
    budget = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, clamped = 0.0, -1
    while True:
        full = F.lit(level) * F.col("weight") >= limit if clamped >= 0 else F.lit(False)
        row = table.agg(
            F.sum(F.when(full, limit)).alias("used"), F.count(F.when(full, 1)).alias("clamped"),
            F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if row.clamped == clamped or not row.open:
            break
        clamped, level = row.clamped, (budget - (row.used or 0)) / row.open
    target = F.least(F.lit(float(level)) * F.col("weight"), limit.cast("double"))
    return table.select("key", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", weights=WEIGHTS,
    share: float = SHARE, epochs: int = EPOCHS, seed: str = SEED,
) -> DataFrame:
    """``docs`` with size, source_size, target and taken (how many of a document's words the mix takes).

    A source whose target is ``w`` times its size and a rest takes every document ``w`` times whole, and once more
    the documents with the lowest seeded draws until the rest is reached; the document at which it is reached
    gives the missing words only, so a source takes its rounded target.  The draw is a digest of seed and
    id, and rows with the same id follow by size: a rerun takes the same.  Documents are dealt into cells by
    their draw; sums of cells show in which cell the rest ends, and only that cell is sorted.

    Null ids draw as the empty text, null sources are a source of their own (last), a document without words has size 0 and gives nothing,
    and an empty table gives no rows.  Columns of ``docs`` named like an added column are replaced.
    """
    added = ["size", "source_size", "target", "taken"]
    draw = F.md5(F.concat_ws("/", F.lit(seed), F.col(id_col).cast("string")))
    kept = [c for c in docs.columns if c not in added]
    own = [F.col(f"`{c}`") for c in kept]
    drawn = docs.select(*own, size.cast("long").alias("size"), source_key(source_col).alias("_key"), draw.alias("_draw"))
    cell = F.substring("_draw", 1, CELL_DIGITS)
    cells = stored(drawn.groupBy(F.col("_key").alias("key"), cell.alias("cell")).agg(F.sum("size").alias("size")), "cells")
    targets = stored(source_targets(cells, weights, share, epochs), "targets")
    rest = F.floor(F.col("target") + 0.5) - F.col("whole") * F.col("source_size")
    before = F.sum("size").over(Window.partitionBy("key").orderBy("cell")) - F.col("size")
    ends = (
        cells.join(targets.withColumn("whole", F.floor(F.when(F.col("source_size") > 0, F.floor(F.col("target") + 0.5) / F.col("source_size")).otherwise(0))), "key")
        .withColumn("rest", rest).withColumn("before", before)
        .where("before <= rest and rest < before + size")
        .select("key", F.col("cell").alias("_cell"), (F.col("rest") - F.col("before")).alias("_rest"))
    )
    plan = stored(
        targets.withColumn("_whole", F.floor(F.when(F.col("source_size") > 0, F.floor(F.col("target") + 0.5) / F.col("source_size")).otherwise(0)))
        .join(ends, "key", "left").select(F.col("key").alias("_key"), "source_size", "target", "_whole", "_cell", "_rest"), "plan")
    placed = drawn.join(plan, "_key")
    at_end = F.coalesce(cell == F.col("_cell"), F.lit(False))
    whole = F.col("_whole") * F.col("size")
    clear = placed.where(~at_end).withColumn("taken", whole + F.when(cell < F.col("_cell"), F.col("size")).otherwise(0))
    earlier = F.sum("size").over(Window.partitionBy("_key").orderBy("_draw", id_col, "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    split = placed.where(at_end).withColumn(
        "taken", whole + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - earlier)))
    columns = [*own, *map(F.col, added)]
    return clear.select(*columns).unionByName(split.select(*columns))
