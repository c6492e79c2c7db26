"""Quality rules as DataFrame expressions: repeated text, then a hashed n-gram likelihood ratio.

The ratio compares two multinomials over hashed words and word pairs, one of trusted texts and one of all texts.  A text's
score is the mean of its n-grams' log ratios; texts below a fixed threshold go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.llm.text import WORD, stored

BUCKETS = 1 << 16
#: Up to so many trusted ids (counted) are broadcast; more meet the texts in a shuffle.
BROADCAST_IDS = 1_000_000
SMOOTHING = 1.0
#: Mean log ratio from which a text is kept.
THRESHOLD = -0.3
SYMBOLS = "#*$%&|<>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (an expression inside a lambda would be computed per element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _covered(windows: Column) -> Column:
    """Words in the windows (of five words, given as hashes by place) that occur twice or more."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        def twin(x, k):
            return F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])
        return F.sort_array(F.filter(F.transform(s, twin), lambda p: p.isNotNull()))

    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("total"))

    def add(acc, p):
        begin = p.cast("bigint")
        return F.struct((begin + 5).alias("end"), (acc["total"] + begin + 5 - F.greatest(begin, acc["end"])).alias("total"))

    return let(placed, lambda s: F.aggregate(places(s), zero, add, lambda acc: acc["total"]))


def _repeat_words(words: Column) -> Column:
    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - 5), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)]))

    none = F.lit(0).cast("bigint")
    counted = let(words, lambda w: F.when(F.size(w) < 6, none).otherwise(
        let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(_covered(h)))))
    return counted


def _grams(text: Column) -> Column:
    """Buckets of the lower-cased words of a text and of neighbouring pairs."""
    def bucket(*parts):
        return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")

    return let(words_of(F.lower(text)), lambda w: F.concat(
        F.transform(w, lambda x: bucket(x)),
        F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: bucket(F.get(w, i - 1), F.get(w, i)))).otherwise(F.array().cast("array<int>"))))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = docs.withColumn("_words", words_of(text))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    counted = words.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("_words")),
    })
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def log_ratios(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, ratio): the log of a bucket's share in trusted texts over its share in all texts, both smoothed, in millionths.

    ``trusted_ids`` has one column of ids, which all count.  All texts are counted in the tasks, bucket by bucket: at most
    ``BUCKETS`` rows leave a task.
    """
    name = trusted_ids.columns[0]
    chosen = stored(trusted_ids.where(F.col(name).isNotNull()).select(F.col(name).alias("_trusted")).distinct(), "trusted")
    if chosen.count() <= BROADCAST_IDS:
        chosen = F.broadcast(chosen)
    grams = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        chosen, F.col("_id") == F.col("_trusted"), "left").select(
        F.col("_trusted").isNotNull().cast("int").alias("t"), _grams(F.col("_text")).alias("_grams"))
    grams = grams.select("t", F.explode_outer("_grams").alias("bucket")).where("bucket is not null")
    counts = stored(grams.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("t").alias("t")), "grams")
    total = counts.agg(F.sum("n"), F.sum("t")).first()
    every, trusted = ((x or 0) + SMOOTHING * BUCKETS for x in total)
    return counts.select("bucket", F.round(1e6 * (
        F.log((F.col("t") + SMOOTHING) / trusted) - F.log((F.col("n") + SMOOTHING) / every))).cast("long").alias("ratio"))


def rule_quality(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the measures, llr (mean log ratio, 0 without words) and kept.

    The n-grams of a text meet the ratios (at most ``BUCKETS`` rows, broadcast) and are averaged in the same task; one row per text is
    shuffled.  Null and empty texts have no words and fail.  Columns of ``docs`` named like an added column are replaced.
    """
    key = [F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_hash")]
    ratios = log_ratios(docs, trusted_ids, id_col, text_col)
    # the key first: beside the explode it would be computed for every n-gram; an inner explode would compute the n-grams again in
    # filters that the optimizer puts before it (not null, not empty)
    grams = docs.select(*key, _grams(F.col(text_col)).alias("_grams")).select("_id", "_hash", F.explode_outer("_grams").alias("bucket"))
    scores = grams.join(F.broadcast(ratios), "bucket").groupBy("_id", "_hash").agg((F.sum("ratio") / F.count("*") / 1e6).alias("_llr"))
    rows = measured(docs, text_col).drop("_words").withColumns({"_key": F.col(id_col), "_text_hash": F.xxhash64(F.col(text_col))})
    joined = rows.join(scores, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left")
    scored = joined.withColumn("llr", F.coalesce("_llr", F.lit(0.0)))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)).drop("_key", "_text_hash", "_id", "_hash", "_llr")
