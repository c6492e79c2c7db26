"""n-th dates, splits and saved tables: plans without the steps that do not scale, and odd rows."""

import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from bizlens.operators import cohort, features
from bizlens.plans import REPORTS
from bizlens.sources import sinks


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_nth_date_of_every_key(spark):
    r = random.Random(2)
    rows = [(r.choice([1, 2, 3, 4, None]), r.choice([None, dt.date(2020, 1, 1) + dt.timedelta(r.randrange(900))])) for _ in range(400)]
    rows += [(9, dt.date(2021, 1, 31)), (9, dt.date(2021, 1, 31)), (9, dt.date(1969, 12, 31)), (10, dt.date(2021, 2, 1))]
    frame = spark.createDataFrame(rows, "k int, d date")
    for n in (1, 2, 3, 40):
        found = cohort.nth_event(frame, "k", "d", n)
        days = {}
        for k, d in rows:
            if d:
                days.setdefault(k, set()).add(d)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(((k, sorted(v)[n - 1]) for k, v in days.items() if len(v) >= n), key=str)
        assert "Window" not in plan(found)
    assert cohort.nth_event(frame.limit(0), "k", "d", 1).count() == 0


def test_nth_purchase_cohort_needs_no_window(spark):
    frame = spark.createDataFrame([(1, dt.date(2020, 1, d), 10) for d in (1, 1, 5, 9)] + [(1, dt.date(2020, 3, 1), 7), (2, dt.date(2020, 1, 1), 5)], "k int, d date, a int")
    found = cohort.nth_purchase_cohort(frame, "k", "d", "a", 3)
    assert sorted(map(tuple, found.collect())) == [(dt.date(2020, 1, 1), dt.date(2020, 1, 1), 1, 40), (dt.date(2020, 1, 1), dt.date(2020, 3, 1), 1, 7)]
    assert "Window" not in plan(found)


@pytest.mark.parametrize("spread", [6.0, 0.01])
def test_split_is_the_rank_by_digest(spark, spread):
    rows = [(i, [0, 0, 0, 1, 1, None, 7][i % 7], i % 3) for i in range(3_000)] + [(5_000, 8, 0), (None, 1, 1), (None, 1, 1), (None, None, 2)]
    frame = spark.createDataFrame(rows, "id long, label int, x int")
    train, test = features.stratified_split(frame, "label", "id", 0.2, 42, spread, small_bytes=0)
    assert train.columns == test.columns == frame.columns
    assert sorted(map(tuple, train.unionByName(test).collect()), key=str) == sorted(rows, key=str)
    got = {}
    for r in test.collect():
        got.setdefault(r["label"], []).append(r["id"])
    by = {}
    for i, label, _ in rows:
        by.setdefault(label, []).append(i)
    for label, ids in by.items():
        ids.sort(key=lambda i: hashlib.md5(f"{'' if i is None else i}:42".encode()).hexdigest())
        wanted = math.ceil(0.2 * (len(ids) - 1))
        assert sorted(got.get(label, []), key=str) == sorted(ids[:wanted], key=str)


def test_split_sorts_only_rows_near_the_edge(spark):
    frame = spark.range(200_000).select("id", (F.col("id") % 2).alias("label"))
    train, test = features.stratified_split(frame, "label", "id")
    assert test.count() == 2 * math.ceil(0.2 * 99_999) and train.count() + test.count() == 200_000


def test_split_of_nothing(spark):
    train, test = features.stratified_split(spark.createDataFrame([], "id long, label int"), "label", "id")
    assert train.count() == test.count() == 0


def test_saved_buckets_are_grouped_without_a_shuffle(spark, sf_dir, monkeypatch):
    found = REPORTS["saved_customer_totals"].run(spark, sf_dir)
    assert "Exchange" not in plan(found) and found.count() > 10
    monkeypatch.setattr(sinks, "BUCKET_ROWS", 100)
    again = REPORTS["saved_customer_totals"].run(spark, sf_dir)
    assert "Exchange" not in plan(again) and again.exceptAll(found).count() == 0
    listed = spark.sql("DESCRIBE EXTENDED bizlens_orders_by_customer").where("col_name = 'Num Buckets'").first().data_type
    assert int(listed) == -(-spark.read.parquet(f"{sf_dir}/orders.parquet").count() // 100)


@pytest.mark.parametrize("cell_rows", [4_000, 20])
def test_nearest_rows_are_exact(spark, cell_rows):
    r = random.Random(4)
    rows = [(i, float(r.randrange(12)), r.random()) for i in range(150)] + [(200, 3.0, 0.5), (201, 3.0, 0.5)]
    frame = spark.createDataFrame(rows, "id long, a double, b double")
    got = {}
    for row in features.nearest_rows(frame, ["a", "b"], "id", 4, cell_rows).orderBy("id", "place").collect():
        got.setdefault(row.id, []).append(row.distance)
    for i, a, b in rows:
        assert got[i] == pytest.approx(sorted((a - x) ** 2 + (b - y) ** 2 for j, x, y in rows if j != i)[:4], abs=1e-12)
