"""Reports once more with every threshold lowered, so that the paths for large data run on the test tables."""

import pytest

from bizlens.operators import joins, scale
from bizlens.plans import REPORTS
from test_reports import duck, ordered  # noqa: F401  (fixture)

NAMES = (
    "rfm_scores", "rfm_segment_counts", "cohort_rows", "churn_label", "customer_pareto", "event_box_by_user",
    "spend_by_churn_box", "rolling_features", "lag_features", "discount_profit", "order_with_customer_total",
    "spend_terciles", "filled_missing", "roc_auc", "precision_recall_curve", "class_weights", "split_sizes")


@pytest.fixture
def lowered(monkeypatch):
    """Defaults of the scale helpers: nothing counts as small, groups of 100 rows are large."""
    monkeypatch.setattr(scale, "SMALL_BYTES", -1)
    monkeypatch.setattr(scale.settled, "__defaults__", (-1,))
    monkeypatch.setattr(scale.running, "__defaults__", (100, None, None))
    monkeypatch.setattr(scale.series_columns, "__defaults__", (100, None))
    monkeypatch.setattr(scale.global_ntile, "__defaults__", (50, 200, None))
    monkeypatch.setattr(scale.exact_quantiles, "__defaults__", (200, 500, None, False))
    monkeypatch.setattr(joins.attach, "__defaults__", ("inner", 100, None))


@pytest.mark.parametrize("name", NAMES)
def test_large_paths_give_the_same_rows(spark, duck, sf_dir, lowered, name):  # noqa: F811
    df = REPORTS[name].run(spark, sf_dir)
    cursor = duck.execute(REPORTS[name].sql)
    names = [d[0] for d in cursor.description]
    assert ordered(df.select(*names).collect()) == ordered(cursor.fetchall())
