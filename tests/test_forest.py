"""Forests as node tables against the library's own scores and against plain programs."""

import hashlib

import pytest
from pyspark.sql import functions as F

from bizlens.operators import forest, models
from bizlens.sources import sinks


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(600).select(
        "id", F.round(F.randn(1), 2).alias("a"), F.round(F.rand(2) * 9, 1).alias("b"), (F.col("id") % 4).cast("double").alias("c")).withColumn(
        "y", F.round(F.col("a") * 3 + F.when(F.col("b") > 4, 5).otherwise(0), 2)).withColumn("hit", (F.col("y") > 3).cast("int")).checkpoint()


@pytest.fixture(scope="module", autouse=True)
def folder(spark):
    from bizlens.session import checkpoint_folder

    checkpoint_folder(spark)


NAMES = ["a", "b", "c"]


def plain_forest(rows, label, trees, depth, bins, per_split, seed=42):
    """Nodes by trying every split of every node."""
    import numpy as np

    data = {f: [float(r[f]) for r in rows] for f in NAMES}
    edges = {f: sorted(set(np.quantile(data[f], [i / bins for i in range(1, bins)]).tolist())) for f in NAMES}
    md5 = lambda *parts: hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()
    nodes = {}

    def grow(tree, node, members, left):
        w, s = sum(x for _, x in members), sum(x * float(r[label]) for r, x in members)
        found = []
        for f, name in enumerate(NAMES):
            for b, edge in enumerate(edges[name]):
                low = [(r, x) for r, x in members if r[name] <= edge]
                wl, sl = sum(x for _, x in low), sum(x * float(r[label]) for r, x in low)
                if wl >= 1 and w - wl >= 1 and any(sum(e < r[name] for e in edges[name]) == b for r, _ in low):
                    gain = sl * sl / wl + (s - sl) ** 2 / (w - wl) - s * s / w
                    if gain > 1e-9:
                        found.append((-gain, f, b))
        if per_split:
            able = sorted({f for _, f, _ in found}, key=lambda f: md5(tree, node, f, seed))[:per_split]
            found = [x for x in found if x[1] in able]
        if not found or not left:
            nodes[tree, node] = (w, s, None, None)
            return
        gain, f, b = min(found)
        nodes[tree, node] = (w, s, NAMES[f], edges[NAMES[f]][b])
        for child, side in ((2 * node, True), (2 * node + 1, False)):
            grow(tree, child, [(r, x) for r, x in members if (r[NAMES[f]] <= edges[NAMES[f]][b]) == side], left - 1)

    for tree in range(1, trees + 1):
        drawn = [(r, sum(int(md5(r["id"], tree, seed)[:4], 16) >= u for u in forest.DRAWS)) for r in rows]
        grow(tree, 1, [(r, x) for r, x in drawn if x], depth)
    return nodes


@pytest.mark.parametrize("label, per_split", [("hit", 2), ("y", None)])
def test_grown_forest_equals_a_plain_program(rows, label, per_split):
    nodes = forest.grow_forest(rows, NAMES, label, "id", trees=3, depth=3, bins=6, per_split=per_split)
    got = {(r.tree, r.node): (r.weight, pytest.approx(r.total, abs=1e-6), r.feature, pytest.approx(r.threshold) if r.threshold is not None else None) for r in nodes.collect()}
    assert got == plain_forest(rows.collect(), label, 3, 3, 6, per_split)
    assert sorted(map(tuple, forest.grow_forest(rows.repartition(5), NAMES, label, "id", 3, 3, 6, per_split).select("tree", "node", "feature").collect())) == sorted(
        (t, n, v[2]) for (t, n), v in got.items())


def test_scores_follow_the_nodes(rows, monkeypatch):
    nodes = forest.grow_forest(rows, NAMES, "y", "id", trees=4, depth=4, bins=8)
    table = {(r.tree, r.node): r for r in nodes.collect()}
    expected = {}
    for r in rows.collect():
        values = []
        for tree in range(1, 5):
            node = table[tree, 1]
            while node.feature:
                node = table[tree, 2 * node.node + (r[node.feature] > node.threshold)]
            values.append(node.total / node.weight)
        expected[r.id] = sum(values) / 4
    for most in (forest.BROADCAST_NODES, 0):
        monkeypatch.setattr(forest, "BROADCAST_NODES", most)
        assert {r.id: r.score for r in forest.score_forest(rows, nodes, NAMES, ["id"]).collect()} == pytest.approx(expected)
    parts = {r.feature: r.importance for r in forest.importances(nodes).collect()}
    assert sum(parts.values()) == pytest.approx(1) and parts["a"] > parts.get("c", 0)


def test_nodes_of_a_library_forest_give_its_predictions(spark, rows, tmp_path):
    model = models.fit_forest_regressor(rows, NAMES, "y", trees=6, depth=30)
    loaded = sinks.load_model(sinks.save_model(model, str(tmp_path / "m")))
    nodes = forest.load_forest(spark, forest.save_forest(forest.nodes_of(loaded, NAMES), str(tmp_path / "n")))
    theirs = {r.id: r.prediction for r in models.score(model, rows, ["id"]).collect()}
    assert {r.id: r.score for r in forest.score_forest(rows, nodes, NAMES, ["id"]).collect()} == pytest.approx(theirs)
    listed = {r.feature: r.importance for r in models.feature_importance(model, NAMES, spark).collect()}
    assert {r.feature: r.importance for r in forest.importances(nodes).collect()} == pytest.approx(listed, abs=1e-9)


def test_classifier_nodes_give_its_scores(spark, rows):
    model = models.fit_forest_classifier(rows, NAMES, "hit", trees=5, depth=5)
    theirs = {r.id: r.score for r in models.score(model, rows, ["id"]).collect()}
    found = forest.score_forest(rows, forest.nodes_of(model, NAMES), NAMES, ["id"])
    assert {r.id: r.score for r in found.collect()} == pytest.approx(theirs)


def test_nothing_one_class_and_nulls(spark, rows):
    assert forest.grow_forest(rows.limit(0), NAMES, "y", "id", 2, 2).count() == 0
    alone = forest.grow_forest(rows.where("hit = 1"), NAMES, "hit", "id", 2, 2)
    assert alone.where("feature is not null").count() == 0 and alone.count() == 2
    odd = rows.withColumn("a", F.when(F.col("id") % 2 == 0, F.col("a")))
    assert forest.grow_forest(odd, NAMES, "y", "id", 1, 0).first().weight < 330
    assert forest.score_forest(rows, alone.limit(0), NAMES, ["id"]).where("score is not null").count() == 0
