"""The Merkle manifest against a plain program: one list per tree, node by node."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from bizlens.llm import manifest, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string, place long, root int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def build(digests):
    """Levels of the whole tree, leaves first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def climb(levels, at):
    """(siblings, left or right) from a leaf to the top."""
    steps = []
    for nodes in levels[:-1]:
        other = at ^ 1
        steps.append((nodes[other] if other < len(nodes) else None, at % 2 == 1))
        at //= 2
    return steps


def folded(digest, steps):
    for sibling, left in steps:
        digest = h(digest) if sibling is None else h(sibling, digest) if left else h(digest, sibling)
    return digest


def plain(rows):
    """Expected rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    groups = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
        leaf = h(*map(field, (doc_id, source, lang, n_chars, text)))
        claimed = h(*map(field, (doc_id, source, lang, n_chars + 1, text))) if tampered else leaf
        groups.setdefault((lang is not None, (lang or "").encode()), []).append((doc_id is not None, doc_id or 0, leaf, claimed, doc_id))
    trees = {key: build([r[2] for r in sorted(found, key=lambda r: r[:4])]) for key, found in groups.items()}
    order = sorted(trees)
    top = build([trees[k][-1][0] for k in order])
    expected = []
    for n, key in enumerate(order):
        for at, row in enumerate(sorted(groups[key], key=lambda r: r[:4])):
            steps = climb(trees[key], at) + climb(top, n)
            got = folded(row[3], steps)
            expected.append((row[4], row[2], trees[key][-1][0], top[-1][0], h(*[s for s, _ in steps if s]), got, got == top[-1][0]))
    return expected


def run(spark, rows, monkeypatch, tmp_path, block):
    path = str(tmp_path / "sf")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    monkeypatch.setattr(manifest.manifest, "__defaults__", (block,))
    found = queries.op11_merkle_manifest(spark, path)
    return [tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


def odd_rows():
    extra = ("x", "y", 1, 2)  # columns that the operator has names for
    rows = [(i, f"text {i} é日本", ["de", "en", None, "", "zz"][i % 5 if i % 3 else 1], f"s{i % 4}", 10 + i, *extra) for i in range(150)]
    rows += [(None, None, None, None, None, *extra), (None, "a", "en", None, 3, *extra), (7, "", "en", "", None, *extra)]
    return rows + [rows[4], rows[4], (500, "long " * 40_000, "lone", "s", 200_000, *extra)]


@pytest.mark.parametrize("block", [2, 8, 4096])
def test_trees_proofs_and_folds(spark, monkeypatch, tmp_path, block):
    rows = odd_rows()
    got = run(spark, rows, monkeypatch, tmp_path, block)
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_many_groups_need_superblocks_of_their_own(spark, monkeypatch, tmp_path):
    rows = [(i, "t", f"lang{i % 23}", "s", 1, None, None, None, None) for i in range(70)]
    assert sorted(run(spark, rows, monkeypatch, tmp_path, 4)) == sorted(plain(rows))


@pytest.mark.parametrize("n", [0, 1])
def test_none_and_one(spark, monkeypatch, tmp_path, n):
    rows = odd_rows()[:n]
    got = run(spark, rows, monkeypatch, tmp_path, 4096)
    assert got == plain(rows)
    if n:
        assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")


def test_a_lone_last_node_is_digested_again():
    assert manifest.reduce_block(["a", "b", "c"], 3, 8)[-1] == [h(h("a", "b"), h("c"))]
    assert manifest.reduce_block(["a"], 9, 4)[-1] == [h(h("a"))] and manifest.reduce_block(["a"], 1, 4) == [["a"]]


def test_places_of_a_hot_group(spark):
    from bizlens.llm.places import placed

    rows = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, "b").otherwise(F.concat(F.lit("a"), F.col("id") % 5)).alias("g"), F.xxhash64("id").alias("v"))
    found = {}
    for g, v, place, total in placed(rows, ["g"], ["v"], "t").collect():
        found.setdefault(g, []).append((place, v, total))
    for got in found.values():
        got.sort()
        assert [p for p, _, _ in got] == list(range(len(got))) and [v for _, v, _ in got] == sorted(v for _, v, _ in got)
        assert {t for _, _, t in got} == {len(got)}
