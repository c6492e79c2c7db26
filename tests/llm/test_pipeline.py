"""Stages of the corpus pipeline."""

import corpus_pipeline


def test_near_duplicates_keeps_different_texts_of_an_id(spark):
    def text(name, n=40):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [
        (7, text("a"), "x"), (None, text("a") + " end", "x"), (None, text("b"), "x"), (None, text("c"), "y"), (None, text("c") + " end", "y"),
        (3, text("d"), "x"), (3, text("e"), "x"), (3, text("e"), "x"), (9, text("d"), "x"), (4, "", "x"), (None, None, "x"), (2**40, text("b"), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert kept.columns == df.columns
    kept = [tuple(r)[:2] for r in kept.collect()]
    one_of = {(None, text("c")), (None, text("c") + " end")}
    assert len(one_of & set(kept)) == 1
    assert sorted(map(str, set(kept) - one_of)) == sorted(map(str, [
        (7, text("a")), (3, text("d")), (3, text("e")), (4, ""), (None, None), (2**40, text("b"))]))
    assert len(kept) == 7
