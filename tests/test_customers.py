"""RFM rules, cohorts, churn, baskets on small frames."""

import collections
import datetime
import itertools
import math
import re

import pytest
from pyspark.sql import functions as F

from bizlens.operators import basket, churn, cohort, rfm, summary
from bizlens.sources import readers, sinks


def standard(r, f, m):
    if r >= 4 and f >= 4 and m >= 4:
        return "Champions"
    if r >= 4 and f >= 3:
        return "Loyal Customers"
    if r >= 3 and f >= 3:
        return "Potential Loyalist"
    if r >= 3 and m <= 2:
        return "Recent Customers"
    if r <= 2 and f >= 4:
        return "At Risk"
    return "Lost" if r == 1 and m <= 2 else "Others"


def detailed(r, f, m):
    if min(r, f, m) >= 4:
        return "Champions"
    if r >= 4 and f >= 3:
        return "Loyal Customers"
    if min(r, f, m) >= 3:
        return "Potential Loyalists"
    if r == 5 and f <= 2:
        return "Recent Customers"
    if r == 3 and f <= 2:
        return "Promising"
    if r <= 2 and f >= 4:
        return "At Risk"
    return "Lost" if r == f == 1 else "Needs Attention"


def billing(r, f, m):
    if min(r, f, m) >= 4:
        return "Top Customers (Gold)"
    if min(r, f, m) >= 3:
        return "Loyal (Silver)"
    if r <= 2:
        return "Need Attention" if f >= 3 else "At Risk"
    return "Regular"


@pytest.mark.parametrize("name, expected", [("standard", standard), ("detailed", detailed), ("billing", billing)])
def test_all_score_triples(spark, name, expected):
    triples = list(itertools.product(range(1, 6), repeat=3))
    frame = spark.createDataFrame(triples, "r_score int, f_score int, m_score int")
    for row in rfm.rfm_segment(frame, name).collect():
        assert row.segment == expected(row.r_score, row.f_score, row.m_score)
        assert row.segment != "Churned"
        assert row.rfm_code == f"{row.r_score}{row.f_score}{row.m_score}"


def orders(spark, rows):
    return spark.createDataFrame(rows, "c string, d string, a double, o int").withColumn("d", F.col("d").cast("date"))


@pytest.fixture(scope="module")
def shop(spark):
    return orders(spark, [
        ("x", "2024-01-31", 10.0, 1), ("x", "2024-01-31", 10.0, 1), ("x", "2024-03-01", 5.0, 2),
        ("y", "2024-01-05", 1.0, 3), ("y", "2024-02-05", 2.0, 4), ("z", "2024-03-31", 7.0, 5), ("z", None, 9.0, 6)])


def test_rfm_base_and_best_score(shop):
    base = {r.c: r for r in rfm.rfm_base(shop, "c", "d", "a", order_id="o").collect()}
    assert (base["x"].frequency, float(base["x"].monetary), base["x"].recency_days) == (2, 25.0, 30)
    scored = {r.c: r for r in rfm.rfm_score(rfm.rfm_base(shop, "c", "d", "a"), "c", 3).collect()}
    assert scored["z"].r_score == 3 and scored["y"].r_score == 1
    turned = {r.c: r for r in rfm.rfm_score(rfm.rfm_base(shop, "c", "d", "a"), "c", 3, best_is_high=False).collect()}
    assert turned["z"].r_score == 1


def test_cohorts(shop):
    kept = {(str(r.cohort_month), r.cohort_index): r for r in cohort.cohort_retention(shop, "c", "d", size="first").collect()}
    assert kept["2024-01-01", 0].retention_pct == 100.0 and kept["2024-03-01", 0].active == 1
    assert kept["2024-01-01", 1].active == 1 and kept["2024-01-01", 2].retention_pct == 50.0
    rows = cohort.cohort_index(shop, "c", "d", base=1)
    assert rows.count() == 7 and rows.where("c = 'y'").agg(F.max("cohort_index")).first()[0] == 2
    third = cohort.nth_event(shop, "c", "d", 2).collect()
    assert {(r.c, str(r.d)) for r in third} == {("x", "2024-03-01"), ("y", "2024-02-05")}


def test_hot_key_keeps_its_cohort(spark):
    rows = [("hot", f"2024-{1 + i % 12:02d}-01", 1.0, i) for i in range(600)] + [
        (f"c{i}", f"2024-{1 + i % 12:02d}-15", 1.0, i) for i in range(1200)]
    kept = cohort.cohort_retention(orders(spark, rows), "c", "d")
    january = {r.cohort_index: r.active for r in kept.where("cohort_month = '2024-01-01'").collect()}
    assert january[0] == 101 and all(january[i] == 1 for i in range(1, 12))


def test_period_report(spark):
    bills = spark.createDataFrame(
        [("a", "2024-01"), ("b", "2024-01"), ("b", "2024-01"), ("b", "2024-03"), ("c", "2024-03"), ("q", "2023-01")],
        "c string, m string")
    row = churn.retention_churn_report(bills, "c", "m").first()
    assert (row.report_month, row.total_customers, row.new_customers, row.retained_customers, row.churned_customers) == (
        "2024-03", 2, 1, 1, 1)
    assert float(row.churn_rate) == 50.0 and float(row.retention_rate) == 50.0
    assert [r.c for r in churn.lost_members(bills, "c", "m").collect()] == ["a"]
    assert [r.c for r in churn.new_members(bills, "c", "m").collect()] == ["c"]
    alone = churn.retention_churn_report(bills.where("m = '2023-01'"), "c", "m").first()
    assert alone.total_customers == 1 and alone.churn_rate is None and alone.new_customers == 1


def test_a_rerun_replaces_its_month(spark, tmp_path):
    bills = spark.createDataFrame([("a", "2024-01"), ("b", "2024-02")], "c string, m string")
    path = str(tmp_path / "report")
    for last in ("2024-01", "2024-02", "2024-02"):
        stored = churn.run_retention_churn_report(bills.where(F.col("m") <= last), "c", "m", path, "2025-01-01 00:00:00")
    assert sorted(r.report_month for r in stored.collect()) == ["2024-01", "2024-02"]


def test_inactive_list_at_any_size(spark, shop):
    row = churn.inactive_summary(shop, "c", "d", 40, "2024-03-31").first()
    assert (row.tracked, row.inactive) == (3, 1)
    assert [tuple(r) for r in churn.inactive_list(shop, "c", "d", 40, "2024-03-31").collect()] == [(1, 1, "y")]
    many = spark.range(10_001).selectExpr("format_string('k%05d', id) AS c", "DATE '2024-01-01' AS d")
    parts = sorted(churn.inactive_list(many, "c", "d", 40, "2024-03-31").collect())
    assert [(r.part, r.members) for r in parts] == [(i, 1000) for i in range(1, 11)] + [(11, 1)]
    assert ", ".join(r.inactive_list for r in parts) == ", ".join(f"k{i:05d}" for i in range(10_001))


def test_rows_without_a_key_are_no_member(spark):
    bills = spark.createDataFrame([(None, "2024-01"), ("a", "2024-01"), (None, "2024-02"), ("b", "2024-02")], "c string, m string")
    row = churn.retention_churn_report(bills, "c", "m").first()
    assert (row.total_customers, row.new_customers, row.retained_customers, row.churned_customers) == (1, 1, 0, 1)
    assert churn.retained_members(bills, "c", "m").count() == 0
    kept = cohort.cohort_retention(bills.withColumn("d", F.to_date(F.concat("m", F.lit("-01")))), "c", "d")
    assert {(str(r.cohort_month), r.active) for r in kept.collect()} == {("2024-01-01", 1), ("2024-02-01", 1)}


def test_churn_of_customers_and_of_rows(shop):
    labelled = churn.churn_label(shop, "c", "d", "2024-03-31", 50)
    assert labelled.count() == 7
    features = churn.customer_features(shop, "c", "d", "o", "a", "2024-03-31", 50)
    assert churn.churn_rate(features).first()[0] == 33.33
    assert churn.churn_rate(labelled).first()[0] == 28.57


def test_box_stats_of_few_and_many_groups(spark, monkeypatch):
    frame = spark.range(400).select((F.col("id") % 4).alias("g"), F.pow("id", F.lit(2)).alias("v"))
    few = sorted(churn.box_stats(frame, "g", "v").collect(), key=lambda r: r.g)
    monkeypatch.setattr(churn, "SIDE_BY_SIDE", 1)
    many = sorted(churn.box_stats(frame, "g", "v").collect(), key=lambda r: r.g)
    assert len(few) == len(many) == 4
    for a, b in zip(few, many):
        assert tuple(a) == pytest.approx(tuple(b))


def brute_pairs(rows, by_rows):
    baskets = collections.defaultdict(list)
    for txn, product in rows:
        baskets[txn].append(product)
    counts = collections.Counter()
    for items in baskets.values():
        items = items if by_rows else sorted(set(items))
        for a, b in itertools.product(items, repeat=2):
            if a < b:
                counts[a, b] += 1
    return counts


@pytest.mark.parametrize("by_rows", [True, False])
@pytest.mark.parametrize("block", [4, 1000])
def test_pairs_with_one_giant_basket(spark, by_rows, block):
    rows = [(0, p) for p in range(60)] + [(0, 3)] + [(t, (t * 7 + i * i) % 23) for t in range(1, 40) for i in range(3)]
    frame = spark.createDataFrame(rows, "t int, p int")
    expected = brute_pairs(rows, by_rows)
    found = {(r.product_a, r.product_b): r.pair_count for r in basket.pair_counts(
        frame, "t", "p", by_rows=by_rows, block=block).collect()}
    assert found == dict(expected)
    best = sorted(expected.items(), key=lambda item: (-item[1], item[0]))[:7]
    top = basket.pair_counts(frame, "t", "p", n=7, by_rows=by_rows, block=block, probe=5).collect()
    assert [((r.product_a, r.product_b), r.pair_count) for r in top] == best
    often = basket.pair_counts(frame, "t", "p", min_count=3, by_rows=by_rows, block=block)
    assert {(r.product_a, r.product_b): r.pair_count for r in often.collect()} == {
        k: v for k, v in expected.items() if v >= 3}


def test_rollup_and_shares(spark):
    frame = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4)], "r string, n string, v int")
    levels = collections.Counter(r.level for r in summary.rollup_summary(frame, ["r", "n"], {"v": F.col("v")}).collect())
    assert levels == {0: 1, 1: 2, 2: 3}
    shares = summary.contribution(frame, ["r"], "v").agg(F.sum("revenue_pct")).first()[0]
    assert shares == pytest.approx(100, abs=0.02)


def test_even_median_does_not_double_sums(spark):
    frame = spark.createDataFrame([(1,), (2,), (3,), (10,)], "v int")
    row = summary.describe_measure(frame, "v").first()
    assert (row.n, row.total, row["median"]) == (4, 16, 2.5)


def test_csv_and_tables(spark, tmp_path):
    frame = spark.createDataFrame([(1, 'a "b", c', datetime.date(2024, 1, 2)), (2, None, None)], "i int, t string, d date")
    path = sinks.write_csv(frame, str(tmp_path / "csv"))
    assert sorted(readers.read_csv(spark, path, "i int, t string, d date").collect()) == sorted(frame.collect())
    (tmp_path / "bad.csv").write_text("i,d\n1,2024-01-02\nx,nope\n")
    rows = readers.read_csv(spark, str(tmp_path / "bad.csv"), "i int, d date").collect()
    assert [tuple(r) for r in rows] == [(1, datetime.date(2024, 1, 2)), (None, None)]
    saved = sinks.save_table(frame, "bizlens_test_table", path=str(tmp_path / "table"), partition_by="i")
    assert saved.count() == 2
    assert [r.column_name for r in readers.describe_schema(frame).collect()] == ["i", "t", "d"]


def test_baskets_are_dealt_by_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(basket, "TASK_PAIRS", 10)
    rows = [(t, p) for t in range(30) for p in range(t % 3, 5)] + [(None, 1), (1, None)]
    frame = spark.createDataFrame(rows, "t int, p int").coalesce(1)
    expected = brute_pairs([r for r in rows if None not in r], True)
    parts = math.ceil(10 * (10 + 6 + 3) / 10)
    for block in (256, 2):
        counted = basket.pair_counts(frame, "t", "p", block=block)
        plan = counted._jdf.queryExecution().optimizedPlan().toString()
        assert re.findall(r"RepartitionByExpression \[_txn[^\]]*\], (\d+)", plan) == [str(parts)] * (1 if block == 256 else 2)
        assert "Inner" not in plan  # the products of a basket are not joined with each other
        assert {(r.product_a, r.product_b): r.pair_count for r in counted.collect()} == dict(expected)
