"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; all but the last return the
columns of documents.  ``run`` writes each stage to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm import bpe, crf, jaccard, mix, substrings
from bizlens.llm.meet import order_id, settle
from bizlens.llm.queries import HELD_OUT
from bizlens.llm.text import WORD

KEPT_FROM = 0.7


def _with_text(docs: DataFrame, text: Column, columns: list[str]) -> DataFrame:
    """The documents' columns with a new text and its number of characters."""
    changed = docs.withColumn("text", text)
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.length("text").cast("long"))
    return changed.select(*[F.col(f"`{c}`") for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines the random field holds for good; null texts score as empty ones."""
    model = crf.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~F.expr(HELD_OUT))
    scored = crf.score_quality(docs, model, score_col="_score")
    return scored.where(F.col("_score") >= (KEPT_FROM if model is not None else 0.0)).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal or near texts the row with the smallest id (null last) stays; of rows with equal id and text one.

    Each different pair of id and text is a document of its own, so different texts of an id, or without id, all stay.
    """
    node = F.xxhash64(F.col("doc_id").isNull(), order_id("doc_id"), F.col("text").isNull(), F.coalesce("text", F.lit("")))
    rows = settle(docs.withColumn("_node", node).dropDuplicates(["_node"]), "nodes")
    found = jaccard.linked_components(rows.select(F.col("_node").alias("id"), "text")).withColumnRenamed("id", "_node")
    first = rows.select("_node", order_id("doc_id").alias("_id")).join(found, "_node").groupBy("component").agg(
        F.min(F.struct("_id", "_node")).alias("first"))
    gone = found.join(first.select(F.col("first._node").alias("_node")), "_node", "left_anti")
    return rows.join(gone, "_node", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that also start earlier; a text may become empty."""
    return _with_text(substrings.remove_repeats(docs), F.col("kept_text"), docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; where it takes a part, the first words."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    mixed = mix.mix_sources(docs, size).where("taken > 0")
    turns = F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))
    rows = mixed.withColumn("_turn", F.explode(turns))
    words = F.least(F.col("size"), F.col("taken") - (F.col("_turn") - 1) * F.col("size")).cast("int")
    part = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), words), " ")
    return _with_text(rows, F.when(words < F.col("size"), part).otherwise(F.col("text")), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (32-bit each) of every document, and the digest of what they decode to."""
    coded = bpe.encode(docs)
    return coded.select("doc_id", "n_tokens", "ids", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", mixing),
    ("byte-level BPE", tokens),
]
#: A trained classifier and BPE are not SQL; tests compare the stages with plain programs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = settle(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
