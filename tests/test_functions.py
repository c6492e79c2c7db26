"""Column functions on literal rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from bizlens import functions as f
from bizlens.operators import clean, quality, segment


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def day(text):
    return F.lit(text).cast("date")


@pytest.mark.parametrize("start, end, elapsed, calendar", [
    ("2024-01-31", "2024-02-29", 0, 1), ("2024-01-15", "2024-03-15", 2, 2), ("2024-01-15", "2024-03-14", 1, 2),
    ("2024-03-15", "2024-01-15", -2, -2), ("2023-12-01", "2024-01-01", 1, 1)])
def test_three_kinds_of_months(spark, start, end, elapsed, calendar):
    assert one(spark, f.whole_months(day(start), day(end))) == elapsed
    assert one(spark, f.months_apart(day(start), day(end))) == calendar


@pytest.mark.parametrize("text, year", [
    ("1980-12-26", "1980-1981"), ("1981-03-31", "1980-1981"), ("1981-04-01", "1981-1982")])
def test_fiscal_year_begins_in_april(spark, text, year):
    assert one(spark, f.fiscal_year_label(day(text))) == year


@pytest.mark.parametrize("text, expected", [
    ("03/04/2024", "2024-04-03"), ("2024-04-03", "2024-04-03"), ("03-Apr-2024", "2024-04-03"),
    ("03-Apr-24", "2024-04-03"), (" 03/04/2024 ", "2024-04-03"), ("31/02/2024", None), ("junk", None), (None, None)])
def test_day_first_dates(spark, text, expected):
    found = one(spark, f.parse_date(F.lit(text).cast("string")))
    assert (str(found) if found else None) == expected


def test_month_first_dates(spark):
    assert one(spark, f.parse_date(F.lit("03/04/2024"), day_first=False)) == datetime.date(2024, 3, 4)


@pytest.mark.parametrize("start, as_of, text", [
    ("2020-02-29", "2025-02-28", "5 years 0 months 0 days"), ("2024-01-30", "2024-02-28", "0 years 0 months 29 days"),
    ("2024-01-31", "2024-02-29", "0 years 1 months 0 days"), ("2023-05-20", "2025-01-15", "1 years 7 months 26 days"),
    ("2025-01-15", "2025-01-15", "0 years 0 months 0 days")])
def test_tenure(spark, start, as_of, text):
    none = F.lit(None).cast("date")
    assert one(spark, f.tenure(day(start), none, as_of)) == text
    assert one(spark, f.tenure(day(start), day(as_of), as_of)) is None


@pytest.mark.parametrize("text, plain, signed", [
    ("$1,234.50", 1234.5, 1234.5), ("-3", 3.0, -3.0), ("USD -12.5", 12.5, -12.5), ("n/a", None, None), ("", None, None),
    ("1.2.3", None, None), (None, None, None)])
def test_numbers_from_text(spark, text, plain, signed):
    column = F.lit(text).cast("string")
    assert one(spark, f.clean_number(column)) == plain
    assert one(spark, f.clean_number(column, keep_sign=True)) == signed


def test_labels_are_trimmed_then_mapped(spark):
    names = {"Mktg": "Marketing"}
    assert [one(spark, f.map_labels(F.lit(t), names)) for t in (" Mktg ", "Ops", " x")] == ["Marketing", "Ops", "x"]


@pytest.mark.parametrize("value, label", [
    (None, "No purchases"), (0, "0-30"), (30, "0-30"), (31, "31-90"), (90, "31-90"), (180, "91-180"), (365, "181-365"),
    (366, "365+")])
def test_recency_zero_is_a_purchase(spark, value, label):
    assert one(spark, f.recency_bucket(F.lit(value).cast("int"))) == label


@pytest.mark.parametrize("value, label", [
    (0, None), (1, "a"), (30, "a"), (31, "b"), (500, "b"), (501, None), (None, None)])
def test_cut_is_closed_on_the_right(spark, value, label):
    assert one(spark, f.cut(F.lit(value).cast("int"), [0, 30, 500], ["a", "b"])) == label


def test_cut_can_include_the_lowest(spark):
    assert one(spark, f.cut(F.lit(0), [0, 30], ["a"], include_lowest=True)) == "a"
    with pytest.raises(ValueError):
        f.cut(F.lit(0), [0, 30], ["a", "b"])


@pytest.mark.parametrize("value, label", [
    (4999.99, "A"), (5000, "B"), (14999.995, "B"), (15000, "C"), (30000, "D"), (None, "Unknown")])
def test_value_buckets_have_no_gaps(spark, value, label):
    found = f.value_bucket(F.lit(value).cast("double"), [5000, 15000, 30000], ["A", "B", "C", "D"])
    assert one(spark, found) == label


@pytest.mark.parametrize("value, label", [(1, "Growth"), (-1, "Decline"), (0, "No Change"), (None, "No Change")])
def test_direction(spark, value, label):
    assert one(spark, f.direction(F.lit(value).cast("int"))) == label


@pytest.mark.parametrize("value, low", [(0, 0.0), (254.99, 0.0), (255, 255.0), (-1, -255.0)])
def test_fixed_width_bins(spark, value, low):
    assert one(spark, f.bin_floor(F.lit(value), 255)) == low


def test_rates_of_nothing_are_null(spark):
    row = spark.range(0).agg(f.rate(F.col("id") > 1).alias("a"), f.mean("id").alias("b")).first()
    assert (row.a, row.b) == (None, None)


def test_numeric_text(spark):
    frame = spark.createDataFrame([("12.5",), ("-3",), ("abc",), (None,), ("7",), ("7.",)], "t string")
    assert {r.t for r in quality.non_numeric(frame, "t").collect()} == {"-3", "abc", None, "7."}


def test_late_needs_more_than_the_limit(spark):
    frame = spark.createDataFrame([("2024-01-01", "2024-01-06"), ("2024-01-01", "2024-01-07"), ("2024-01-01", None)],
                                  "s string, e string").select(F.col("s").cast("date"), F.col("e").cast("date"))
    assert [r.delivery for r in clean.late_flag(frame, "s", "e").collect()] == ["On Time", "Late", "On Time"]


def test_fill_and_dedupe(spark):
    frame = spark.createDataFrame(
        [(1, 1.0, None), (2, 2.0, "m"), (3, 3.0, "f"), (4, 10.0, "f"), (5, None, "f")], "id int, age double, g string")
    filled = {r.id: r for r in clean.fill_missing(frame, {"age": "median", "g": "Unknown"}).collect()}
    assert filled[5].age == 2.5 and filled[1].g == "Unknown"
    means = {r.id: r for r in clean.fill_missing(frame, {"age": "mean"}).collect()}
    assert means[5].age == 4.0
    twice = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3)], "k int, v string, o int")
    assert {(r.k, r.v) for r in clean.dedupe_by(twice, ["k"], ["o"]).collect()} == {(1, "a"), (2, "c")}
    assert {(r.k, r.v) for r in clean.dedupe_by(twice, ["k"], ["o"], "last").collect()} == {(1, "b"), (2, "c")}


def test_median_date(spark):
    frame = spark.createDataFrame([("2024-01-01",), ("2024-01-04",), (None,)], "d string").select(F.col("d").cast("date"))
    assert datetime.date(2024, 1, 2) in [r.d for r in clean.fill_median_date(frame, "d").collect()]


def test_equal_width_histogram_of_one_value(spark):
    frame = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    counts = {r.bin: r.n for r in segment.equal_width_histogram(frame, "v", 4).collect()}
    assert sum(counts.values()) == 2 and len(counts) == 4


def test_qcut_first_bin_is_closed(spark):
    frame = spark.range(9).select(F.col("id").cast("double").alias("v"))
    counts = segment.qcut(frame, "v", 3, ["Low", "Medium", "High"]).groupBy("bin").count()
    assert {r["bin"]: r["count"] for r in counts.collect()} == {"Low": 3, "Medium": 3, "High": 3}
