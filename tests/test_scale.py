"""The distributed rank, quantile and running-sum paths against plain windows and numpy."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from bizlens.operators import features, joins, scale, summary

DISTRIBUTED = {"small_bytes": 0}


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows; a third has key 0, and the values have heavy ties and nulls."""
    return spark.range(20_000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("key"),
        F.when(F.col("id") % 101 != 0, F.pmod(F.xxhash64("id"), F.lit(7))).alias("few"),
        F.when(F.col("id") % 97 != 0, F.rand(5)).alias("wide")).checkpoint()


@pytest.fixture(scope="module", autouse=True)
def folder(spark):
    from bizlens.session import checkpoint_folder

    checkpoint_folder(spark)


@pytest.mark.parametrize("column, ascending", [("few", True), ("few", False), ("wide", True), ("wide", False)])
def test_ntile_equals_the_window_function(skewed, column, ascending):
    key = scale.sort_key((column, ascending), ("id", True))
    found = scale.global_ntile(skewed, {"tile": key}, 5, bracket_rows=100, sample_rows=400, **DISTRIBUTED)
    order = F.asc_nulls_first(column) if ascending else F.desc_nulls_last(column)
    plain = skewed.withColumn("expected", F.ntile(5).over(Window.orderBy(order, "id")))
    wrong = found.join(plain.select("id", "expected"), "id").where("tile <> expected")
    assert wrong.count() == 0


@pytest.mark.parametrize("rows, sizes", [(7, [2, 2, 1, 1, 1]), (5, [1] * 5), (3, [1, 1, 1])])
def test_ntile_sizes(spark, rows, sizes):
    frame = spark.range(rows)
    for options in ({}, DISTRIBUTED):
        tiled = scale.global_ntile(frame, {"t": scale.sort_key(("id", True))}, 5, **options)
        counts = {r["t"]: r["count"] for r in tiled.groupBy("t").count().collect()}
        assert [counts[t] for t in sorted(counts)] == sizes


def test_ntile_of_nothing(spark):
    empty = spark.range(0)
    assert scale.global_ntile(empty, {"t": scale.sort_key(("id", True))}, 5, **DISTRIBUTED).count() == 0


def test_quantiles_equal_numpy(skewed):
    points = (0.0, 0.1, 0.5, 0.75, 0.999, 1.0)
    values = [r[0] for r in skewed.select("wide").where("wide is not null").collect()]
    found = scale.exact_quantiles(skewed, {"wide": "wide"}, points, bracket_rows=64, sample_rows=300, **DISTRIBUTED)
    assert np.allclose(found["wide"], np.quantile(values, points), rtol=0, atol=1e-12)
    assert scale.exact_quantiles(skewed, {"wide": "wide"}, points)["wide"] == pytest.approx(found["wide"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=40))
def test_median_of_any_list(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v int")
    found = scale.exact_quantiles(frame, {"v": "v"}, (0.5,), bracket_rows=4, sample_rows=6, **DISTRIBUTED)
    assert found["v"] == [float(np.median(values))]


def test_quantiles_between_heavy_ties_at_default_sizes(spark):
    """Nearly all rows hold one of two values, so both pivots of a round can be whole ties."""
    frame = spark.range(1_200_000).select(F.when(F.col("id") % 2000 == 0, F.rand(7)).otherwise(F.col("id") % 2).alias("v"))
    points = (0.0, 0.25, 0.4999, 0.5, 0.5001, 0.75, 1.0)
    found = scale.exact_quantiles(frame, {"v": "v"}, points, **DISTRIBUTED)["v"]
    expected = frame.agg(F.percentile("v", F.lit(list(points)))).first()[0]
    assert found == pytest.approx(expected, abs=1e-12)


def test_a_sample_alone_finds_ranks_between_ties(spark):
    frame = spark.range(400_000).select(F.when(F.col("id") % 1000 == 0, F.rand(7)).otherwise(F.col("id") % 2).alias("v"))
    ranks = [("v", r) for r in (0, 199_799, 199_800, 200_000, 200_200, 399_999)]
    found = scale.order_statistics(frame, {"v": F.col("v")}, ranks, {"v": 400_000}, bracket_rows=50_000)
    values = sorted(r[0] for r in frame.collect())
    assert found == [values[r] for _, r in ranks]


def test_a_bracket_holds_neither_of_its_ends(spark):
    frame = spark.createDataFrame([(v,) for v in [0] * 50 + [1] * 50], "v int")
    found = scale.order_statistics(frame, {"v": F.col("v")}, [("v", 49), ("v", 50)], {"v": 100}, bracket_rows=1, sample_rows=4)
    assert found == [0, 1]


def test_three_passes_over_the_rows(spark, monkeypatch):
    """One aggregate for sketch and counts, one around the sketch's pivots, one sort of what lies between."""
    taken = []
    monkeypatch.setattr(scale, "_sampled_pivots", lambda *a: taken.append(a))
    frame = spark.range(600_000).select(F.rand(3).alias("v"))
    found = scale.quantiles_and(frame, {"v": "v"}, (0.5,), [F.max("v").alias("top")], small_bytes=0, bracket_rows=1_000)
    values = sorted(r[0] for r in frame.collect())
    assert found[0]["v"] == [pytest.approx((values[299_999] + values[300_000]) / 2)] and found[1]["top"] == values[-1]
    assert not taken


def test_quantiles_of_nulls(spark):
    frame = spark.createDataFrame([(None,)], "v double")
    assert scale.exact_quantiles(frame, {"v": "v"}, (0.5,), **DISTRIBUTED)["v"] == [None]


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_running_sums_equal_the_window(skewed, keys):
    values = {"total": F.col("few"), "place": F.lit(1)}
    found = scale.running(skewed, keys, ["id"], values, group_rows=10, slices=7, **DISTRIBUTED)
    window = Window.partitionBy(*keys).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumns({"e1": F.sum("few").over(window), "e2": F.row_number().over(window)})
    both = found.join(plain.select("id", "e1", "e2"), "id")
    assert found.count() == 20_000
    assert both.where("place <> e2 OR coalesce(total, 0) <> coalesce(e1, 0)").count() == 0


def test_running_sums_over_leading_nulls(spark):
    frame = spark.range(40).select("id", F.when(F.col("id") % 4 == 3, F.col("id")).alias("v"))
    found = scale.running(frame, [], ["id"], {"s": F.col("v")}, group_rows=2, slices=13, **DISTRIBUTED)
    plain = scale.running(frame, [], ["id"], {"s": F.col("v")})
    assert found.exceptAll(plain).count() == 0 and found.where("s is null").count() == 3


def test_long_series_are_cut_into_chunks(skewed):
    options = {"group_rows": 50, "small_bytes": 0}
    lagged = features.add_lags(skewed, ["key"], "id", "few", [1, 7], **options)
    rolled = features.add_rolling(lagged, ["key"], "id", "few", [3, 30], **options)
    plain = features.add_rolling(features.add_lags(skewed, ["key"], "id", "few", [1, 7]), ["key"], "id", "few", [3, 30])
    assert rolled.count() == 20_000
    assert rolled.exceptAll(plain.select(rolled.columns)).count() == 0


def test_pareto_over_many_groups(skewed):
    frame = skewed.withColumn("amount", F.col("few").cast("decimal(18,2)"))
    found = summary.pareto(frame, ["id"], "amount", group_rows=100, slices=5, small_bytes=0)
    plain = summary.pareto(frame, ["id"], "amount")
    assert found.exceptAll(plain).count() == 0 and found.count() == 20_000


def test_settled_keeps_small_input_and_checkpoints_large(spark, skewed):
    frame = spark.range(10).groupBy((F.col("id") % 2).alias("k")).count()
    assert scale.settled(frame) is frame
    kept = scale.settled(frame, reread_bytes=-1)
    assert kept is not frame and kept.count() == 2
    assert scale.settled(kept, reread_bytes=-1) is kept


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_salted_without_changing_the_join(skewed, how):
    sizes = skewed.withColumn("key", F.when(F.col("id") % 5 != 0, F.col("key"))).groupBy("key").agg(
        F.sum("few").alias("total"), F.count("*").alias("n"))
    table = sizes if how == "inner" else sizes.where("key IS NULL OR key < 20")
    found = joins.attach(skewed, table, "key", "n", how, hot_rows=300, **DISTRIBUTED)
    plain = joins.attach(skewed, table, "key", "n", how, small_bytes=1 << 60)
    assert found.count() == plain.count() > 0
    assert found.exceptAll(plain.select(found.columns)).count() == 0


def test_rows_of_a_hot_key_are_dealt_out(skewed):
    table = skewed.groupBy("key").agg(F.count("*").alias("n")).withColumnRenamed("key", "_key")
    dealt, copies = joins._dealt(skewed, table, "key", "n", 300)
    groups = dealt.groupBy("key", "_salt").count()
    assert groups.agg(F.max("count")).first()[0] < 450 and groups.where("key = 0").count() == 24
    assert copies.where("_key = 0").count() == 24 and copies.where("_key = 2").count() <= 2
