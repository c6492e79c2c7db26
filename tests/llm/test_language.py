"""Languages with samples of very different size."""

from pyspark.sql import functions as F

from bizlens.llm import langid, queries


def test_small_languages_do_not_shorten_others(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "", "e0"), (-2, " \n7", "e1"), (-3, "ok", "s0"), (-4, "zq vx", "s1"), (-5, "ωψ φχ", "s2")], docs.schema)
    learned = docs.where(~F.expr(queries.HELD_OUT)).unionByName(odd)
    langs, parsers = langid.fit_parsers(learned, "text", "lang", F.xxhash64("doc_id"))
    assert {"s0", "s1", "s2"} <= set(langs) and not {"e0", "e1"} & set(langs)
    truth = {r.doc_id: r.lang for r in docs.unionByName(odd).collect()}
    held = docs.where(F.expr(queries.HELD_OUT) & F.col("lang").isNotNull())
    found = {r.doc_id: r.lang_pred for r in langid.identify(held.unionByName(odd), langs, parsers).collect()}
    assert all(found[i] == truth[i] for i in (-3, -4, -5)) and found[-1] == found[-2] == "und"
    large = [i for i in found if i >= 0]
    assert sum(found[i] == truth[i] for i in large) >= 0.95 * len(large)
