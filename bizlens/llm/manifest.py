"""Merkle manifest of a dataset: a tree of rows per group, a tree of groups, and a proof for every row.

Trees are cut into superblocks of ``BLOCK`` consecutive leaves.  A superblock is reduced to one node; those nodes are the leaves of a
smaller tree, which is treated the same way, so that no task holds more than a superblock, however many rows a group has.
On the way down leaves and the outer nodes that their superblock needs are cogrouped: one function reduces the
superblock again, joins the proofs of its inside and of the outside, and folds every leaf up to the root.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.llm.places import placed
from bizlens.llm.text import stored

#: Leaves of a superblock, a power of two.
BLOCK = 4096
PATH = "siblings array<string>, lefts array<boolean>"


def node(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def reduce_block(digests: list[str], total: int, block: int) -> list[list[str]]:
    """Levels of nodes above ``digests``: until one node is left, or, if the tree goes on, up to the superblock's level."""
    levels, depth = [digests], block.bit_length() - 1
    while len(levels[-1]) > 1 or (total > block and len(levels) <= depth):
        below = levels[-1]
        levels.append([node(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def path_inside(levels: list[list[str]], place: int) -> tuple[list[str | None], list[bool]]:
    """Sibling (None where a node has none) and whether it stands left, for each level below the last."""
    siblings, lefts = [], []
    for nodes in levels[:-1]:
        other = place ^ 1
        siblings.append(nodes[other] if other < len(nodes) else None)
        lefts.append(bool(place & 1))
        place >>= 1
    return siblings, lefts


def fold(digest: str, siblings, lefts) -> str:
    for sibling, left in zip(siblings, lefts):
        digest = node(digest) if sibling is None else node(sibling, digest) if left else node(digest, sibling)
    return digest


def _tops(nodes: DataFrame, block: int, name: str) -> DataFrame:
    """One node per superblock: (tree, place, total, digest), the leaves of the next smaller tree; stored."""
    def reduce(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        total = int(frame["total"].iloc[0])
        top = reduce_block(frame["digest"].tolist(), total, block)[-1][0]
        return pd.DataFrame({"tree": frame["tree"].iloc[:1].tolist(), "place": [int(frame["block"].iloc[0])],
                             "total": [-(-total // block)], "digest": [top]})

    blocks = nodes.select("tree", F.expr(f"place div {block}").alias("block"), "place", "total", "digest")
    return stored(blocks.groupBy("tree", "block").applyInPandas(reduce, "tree string, place long, total long, digest string"), name)


def paths(nodes: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """For the superblocks of ``nodes`` (tree, place, total, digest): (tree, block, siblings, lefts, root) and the roots (tree, root).

    ``root`` is that of the tree; the path leads from the superblock's node to it.
    """
    tops = _tops(nodes, block, "tops")
    if (tops.agg(F.max("total")).first()[0] or 1) == 1:
        outer = tops.select("tree", F.col("place").alias("block"), F.array().cast("array<string>").alias("siblings"),
                            F.array().cast("array<boolean>").alias("lefts"), F.col("digest").alias("root"))
        return outer, outer.select("tree", "root")
    above, roots = paths(tops, block)

    def extend(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, outer = left.sort_values("place"), right.iloc[0]
        levels = reduce_block(left["digest"].tolist(), int(left["total"].iloc[0]), block)
        inside = [path_inside(levels, i) for i in range(len(left))]
        return pd.DataFrame({"tree": left["tree"].to_numpy(), "block": left["place"].to_numpy(),
                             "siblings": [[*s, *outer["siblings"]] for s, _ in inside],
                             "lefts": [[*x, *map(bool, outer["lefts"])] for _, x in inside], "root": outer["root"]})

    cut = tops.withColumn("block", F.expr(f"place div {block}")).groupBy("tree", "block")
    both = cut.cogroup(above.groupBy("tree", "block")).applyInPandas(extend, f"tree string, block long, {PATH}, root string")
    return stored(both, "outer"), roots


def manifest(rows: DataFrame, id_col: str, group_col: str, original: Column, claimed: Column, block: int = BLOCK) -> DataFrame:
    """Per row of ``rows``: the id, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded_root`` and ``verified``.

    ``original`` is the digest of a row as listed, ``claimed`` that of the row as found now.  Rows ascend in their group by id (null
    first), equal ids by both digests; groups ascend bytewise, null first.  ``proof`` lists the siblings from the leaf up to the
    root, where a node without sibling adds none.  ``folded_root`` is folded from ``claimed`` and the proof.

    Nulls are values of their own; a lone row is its own subroot, a lone group's subroot is the root; an empty table gives no rows;
    repeated rows are leaves of their own.  Other columns of ``rows`` take no part.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = stored(rows.select(tree.alias("tree"), F.col(id_col).alias("id"), original.alias("digest"), claimed.alias("claimed")), "leaves")
    at = placed(leaves, ["tree"], ["id", "digest", "claimed"], "placed")
    outer, subroots = paths(at.select("tree", "place", "total", "digest"), block)
    groups = placed(stored(subroots.select(F.lit("").alias("all"), "tree", F.col("root").alias("digest")), "subroots"), ["all"], ["tree"], "groups")
    group_nodes = groups.select(F.col("all").alias("tree"), "place", "total", "digest")
    group_outer, _ = paths(group_nodes, block)

    def finish_group(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, above = left.sort_values("place"), right.iloc[0]
        levels = reduce_block(left["digest"].tolist(), int(left["total"].iloc[0]), block)
        inside = [path_inside(levels, i) for i in range(len(left))]
        return pd.DataFrame({"tree": left["tree"].to_numpy(), "up": [[*s, *above["siblings"]] for s, _ in inside],
                             "up_lefts": [[*x, *map(bool, above["lefts"])] for _, x in inside], "whole": above["root"]})

    cut = groups.select("all", "tree", "place", "total", "digest", F.expr(f"place div {block}").alias("block")).groupBy("all", "block")
    above = group_outer.select(F.col("tree").alias("all"), "block", "siblings", "lefts", "root").groupBy("all", "block")
    ups = cut.cogroup(above).applyInPandas(finish_group, "tree string, up array<string>, up_lefts array<boolean>, whole string")
    around = outer.join(stored(ups, "ups"), "tree")

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, out = left.sort_values("place"), right.iloc[0]
        digests = left["digest"].tolist()
        levels = reduce_block(digests, int(left["total"].iloc[0]), block)
        outside, outside_lefts = [*out["siblings"], *out["up"]], [*out["lefts"], *out["up_lefts"]]
        given = [s for s in outside if s is not None]
        known: dict[str, str] = {}
        proofs, folded = [], []
        for i, claimed in enumerate(left["claimed"]):
            siblings, lefts = path_inside(levels, i)
            top = fold(claimed, siblings, lefts)
            if top not in known:  # most leaves of a superblock fold to the same node
                known[top] = fold(top, outside, outside_lefts)
            folded.append(known[top])
            proofs.append([s for s in siblings if s is not None] + given)
        return pd.DataFrame({"id": left["id"].to_numpy(), "leaf": digests, "subroot": out["root"], "root": out["whole"],
                             "proof": proofs, "folded_root": folded, "verified": [f == out["whole"] for f in folded]})

    cut = at.withColumn("id", F.col("id").cast("string")).withColumn("block", F.expr(f"place div {block}")).groupBy("tree", "block")
    found = cut.cogroup(around.groupBy("tree", "block")).applyInPandas(
        finish, "id string, leaf string, subroot string, root string, proof array<string>, folded_root string, verified boolean")
    return found.withColumn("id", F.col("id").cast(rows.schema[id_col].dataType)).withColumnRenamed("id", id_col)
