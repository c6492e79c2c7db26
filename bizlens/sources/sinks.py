"""Views, saved tables, period reports, CSV export and model files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bizlens.operators.scale import settled


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


#: Rows of a bucket, on average.
BUCKET_ROWS = 2_000_000


def save_table(
    df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None, bucket_by: str | None = None,
    buckets: int | None = None, partition_by: str | None = None,
) -> DataFrame:
    """Save as a Parquet table.

    Bucketing by a key spares later reports the shuffle on it, as long as they read the table by its name.  Without ``buckets``
    their number follows from the counted rows.  Rows are dealt by the key first, so a bucket is one file.
    """
    if bucket_by:
        df = settled(df)
        buckets = buckets or max(1, -(-df.count() // BUCKET_ROWS))
        df = df.repartition(buckets, bucket_by)
    writer = df.write.format("parquet").mode(mode)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def stage(df: DataFrame, name: str | None = None) -> DataFrame:
    """An intermediate result used more than once: checkpointed unless it is cheap to read again."""
    kept = settled(df)
    return register_view(kept, name) if name else kept


def append_report(df: DataFrame, path: str, key: str = "report_month") -> DataFrame:
    """Write one period's rows to its own partition and return the whole report.

    Only the partitions present in ``df`` are replaced, so a rerun of a month does not duplicate it.
    """
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    )
    return read_report(df.sparkSession, path, df)


def read_report(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, quote: str = '"', single_file: bool = False) -> str:
    """A directory of comma-separated parts; ``single_file`` is for results known to be small."""
    out = df.repartition(1) if single_file else df  # not coalesce: that would pull the last aggregate into one task
    out.write.mode("overwrite").option("header", header).option("quote", quote).csv(path)
    return path


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
