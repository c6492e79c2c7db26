"""Places of rows in the order of their group, without a window that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bizlens.llm.text import stored

#: Rows of a slice, on average.
SLICE_ROWS = 200_000


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``place``, from 0 in their group by ``order`` (total, nulls first), and ``total``, the group's rows; stored.

    Rows are dealt into sorted slices of the whole order; a group, however large, lies in consecutive slices.  Per group and slice
    the first mark and the number of rows give what the group has in earlier slices; a group has at most one such row a slice.
    Group columns must not be null.  ``rows`` is read twice, so it should be a stored table.
    """
    spark = rows.sparkSession
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // SLICE_ROWS))
    keys = [*group, *order]
    dealt = rows.repartitionByRange(slices, *keys).sortWithinPartitions(*keys)
    marked = stored(dealt.withColumn("mark", F.monotonically_increasing_id()), name)
    slice_ = F.shiftright("mark", 33)
    runs = marked.groupBy(*group, slice_.alias("slice")).agg(F.min("mark").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*group, "slice", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("n").over(Window.partitionBy(*group)).alias("total"))
    joined = marked.withColumn("slice", slice_).join(runs, [*group, "slice"])
    return joined.select(*rows.columns, (F.col("mark") + F.col("shift")).alias("place"), "total")
