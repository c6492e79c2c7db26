"""Random forests as tables of nodes: grown level by level, scored by joins, saved and read like any table.

A node is a row (tree, node, weight, total, feature, threshold, gain); node ``n`` has children ``2 n`` (values up to the threshold)
and ``2 n + 1``, a node without feature is a leaf, and its value is ``total / weight``.  Each level of all trees is one aggregate:
weights and label sums by node, feature and bin are added up in the tasks, so the shuffle holds sums and not rows.  Rows draw their
weight in a tree from a digest of their key, so the same rows give the same forest, however they are dealt.

For a 0/1 label the split that lowers the squares most is the one that lowers the Gini impurity most.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bizlens.operators.scale import exact_quantiles, settled
from bizlens.session import checkpoint_folder

#: From these values of 16 bits on a row counts once more in a tree: the distribution of draws with replacement (Poisson, mean 1).
DRAWS = (24109, 48218, 60273, 64291, 65296, 65497, 65530)
#: Nodes of a forest that are sent to every task; larger forests are joined by a shuffle.
BROADCAST_NODES = 1_000_000
NODE = "tree int, node long, weight double, total double, feature string, threshold double, gain double"


def draw(key: Column, tree: Column, seed: int) -> Column:
    """How often a row counts in a tree."""
    digest = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), tree.cast("string"), F.lit(str(seed))))
    value = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")
    return reduce(lambda a, b: a + b, [(value >= limit).cast("int") for limit in DRAWS])


def bin_edges(df: DataFrame, features: Sequence[str], bins: int, **scale) -> dict[str, list[float]]:
    """Distinct quantiles of each feature: the thresholds that splits choose from."""
    found = exact_quantiles(df, {f: f for f in features}, [i / bins for i in range(1, bins)], **scale)
    return {f: sorted({v for v in found[f] if v is not None}) for f in features}


def _best_splits(level: DataFrame, per_split: int | None, least: float, seed: int) -> DataFrame:
    """(tree, node, f, bin, gain) of the best split of each node that has one."""
    sums = level.select("tree", "node", "w", "wy", F.posexplode("bins").alias("f", "bin")).groupBy("tree", "node", "f", "bin").agg(
        F.sum("w").alias("w"), F.sum("wy").alias("wy"))
    every = Window.partitionBy("tree", "node", "f")
    upto = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    found = sums.select("tree", "node", "f", "bin", *[F.sum(c).over(w).alias(n) for c, w, n in (
        ("w", upto, "wl"), ("wy", upto, "sl"), ("w", every, "wt"), ("wy", every, "st"))])
    wl, sl, wt, st = (F.col(c) for c in ("wl", "sl", "wt", "st"))
    gain = sl * sl / wl + (st - sl) * (st - sl) / (wt - wl) - st * st / wt
    found = found.where((wl >= least) & (wt - wl >= least)).withColumn("gain", gain).where("gain > 1e-9")
    if per_split is not None:
        order = F.md5(F.concat_ws(":", "tree", "node", "f", F.lit(str(seed))))
        found = found.withColumn("turn", F.dense_rank().over(Window.partitionBy("tree", "node").orderBy(order))).where(F.col("turn") <= per_split)
    best = F.row_number().over(Window.partitionBy("tree", "node").orderBy(F.desc("gain"), "f", "bin"))
    return found.withColumn("best", best).where("best = 1").select("tree", "node", "f", "bin", "gain")


def _kept(df: DataFrame) -> DataFrame:
    """A checkpoint, whatever the size: a level is built on the level before it."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def grow_forest(
    df: DataFrame, features: Sequence[str], label: str, key: str, trees: int = 100, depth: int = 8, bins: int = 32,
    per_split: int | None = None, least: float = 1.0, seed: int = 42, **scale,
) -> DataFrame:
    """The nodes of a forest for a numeric or 0/1 label.

    ``bins`` equal parts of each feature give the thresholds, ``per_split`` of the features that could split a node, drawn by digest,
    are looked at (all by default), ``least`` is the least weight of a child.  Rows with a null feature or label are left out.
    Rows with equal keys get equal weights.  Without rows there are no nodes.
    """
    names = list(features)
    known = settled(df.select(F.col(key).alias("_key"), F.col(label).cast("double").alias("_y"), *[F.col(f).cast("double").alias(f) for f in names]).dropna(
        subset=["_y", *names]))
    edges = bin_edges(known, names, bins, **scale)
    cells = F.array(*[_bin(F.col(f), edges[f]) for f in names])
    spread = known.select("_key", "_y", cells.alias("bins"), F.explode(F.sequence(F.lit(1), F.lit(trees))).alias("tree"))
    weighed = spread.withColumn("w", draw(F.col("_key"), F.col("tree"), seed).cast("double")).where("w > 0")
    rows = _kept(weighed.select("tree", F.lit(1).cast("long").alias("node"), "w", (F.col("w") * F.col("_y")).alias("wy"), "bins"))
    table = F.map_from_arrays(F.array(*[F.lit(i) for i in range(len(names))]), F.array(*[F.array(*[F.lit(e) for e in edges[f]]).cast("array<double>") for f in names]))
    named = F.array(*[F.lit(f) for f in names])
    levels = []
    for at in range(depth + 1):
        totals = rows.groupBy("tree", "node").agg(F.sum("w").alias("weight"), F.sum("wy").alias("total"))
        if at == depth:
            best = df.sparkSession.createDataFrame([], "tree int, node long, f int, bin int, gain double")
        else:
            best = _kept(_best_splits(rows, per_split, least, seed))
        split = totals.join(best, ["tree", "node"], "left").select(
            "tree", "node", "weight", "total", F.get(named, F.col("f")).alias("feature"),
            F.get(F.element_at(table, F.col("f")), F.col("bin")).alias("threshold"), "gain")
        levels.append(_kept(split))
        if at < depth:
            if best.isEmpty():
                break
            child = F.col("node") * 2 + (F.get("bins", F.col("f")) > F.col("bin")).cast("long")
            rows = _kept(rows.join(_small(best), ["tree", "node"]).select("tree", child.alias("node"), "w", "wy", "bins"))
    return reduce(DataFrame.unionByName, levels)


def _bin(value: Column, edges: Sequence[float]) -> Column:
    """How many of the edges lie below the value."""
    return reduce(lambda a, b: a + b, [(value > F.lit(e)).cast("int") for e in edges], F.lit(0))


def _small(nodes: DataFrame) -> DataFrame:
    return F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes


def score_forest(rows: DataFrame, nodes: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep``, which must identify a row, and ``score``: the mean of the trees' leaf values.

    Rows meet the nodes level by level; a row whose node is a leaf stays there.
    """
    nodes = settled(nodes)
    depth = nodes.agg(F.max(F.floor(F.log2("node")))).first()[0]
    if depth is None:
        return rows.select(*keep, F.lit(None).cast("double").alias("score"))
    table = _small(nodes.select("tree", "node", "feature", "threshold", (F.col("total") / F.col("weight")).alias("value")))
    values = F.create_map(*[x for f in features for x in (F.lit(f), F.col(f).cast("double"))]).alias("x")
    at = rows.select(*keep, values).join(_small(nodes.select("tree").distinct())).withColumn("node", F.lit(1).cast("long"))
    for _ in range(int(depth)):
        met = at.join(table, ["tree", "node"])
        child = F.col("node") * 2 + (F.element_at("x", F.col("feature")) > F.col("threshold")).cast("long")
        at = met.select(*keep, "x", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(child).alias("node"))
    return at.join(table, ["tree", "node"]).groupBy(*keep).agg(F.avg("value").alias("score"))


def importances(nodes: DataFrame) -> DataFrame:
    """feature, importance: the gains of a feature as a part of its tree's, averaged over the trees with a split."""
    gains = nodes.where("feature is not null").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    shared = gains.withColumn("part", F.col("gain") / F.sum("gain").over(Window.partitionBy("tree")))
    trees = F.lit(1.0) * gains.agg(F.count_distinct("tree")).scalar()
    return shared.groupBy("feature").agg((F.sum("part") / F.max(trees)).alias("importance"))


def save_forest(nodes: DataFrame, path: str) -> str:
    nodes.write.mode("overwrite").parquet(path)
    return path


def load_forest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NODE).parquet(path)


def nodes_of(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """The nodes of a forest that the library has fitted, numbered like those that are grown here.

    The model's own structure is read tree by tree on the driver, where the fitted model already is.  Leaf values are predicted values, for
    a classifier the share of class 1; gains are weighted by the node's rows.
    """
    rows = []

    def visit(tree: int, number: int, node) -> None:
        stats = node.impurityStats()
        weight = float(stats.count())
        classes = [float(x) for x in stats.stats()]
        value = classes[1] / sum(classes) if classifier and sum(classes) else float(node.prediction())
        if node.subtreeDepth() == 0:
            rows.append((tree, number, weight, weight * value, None, None, None))
            return
        split = node.split()
        rows.append((tree, number, weight, weight * value, features[split.featureIndex()], float(split.threshold()), float(node.gain()) * weight))
        visit(tree, 2 * number, node.leftChild())
        visit(tree, 2 * number + 1, node.rightChild())

    fitted = model.stages[-1]
    classifier = hasattr(fitted, "numClasses")
    for i, tree in enumerate(fitted.trees, 1):
        visit(i, 1, tree._call_java("rootNode"))
    return SparkSession.active().createDataFrame(rows, NODE)
