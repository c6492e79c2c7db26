"""Packed lists and pairs, and the pairs of whole-numbered products that travel packed."""

import collections
import itertools
import random

import numpy as np
import pytest

from bizlens.operators import basket, packed

RANGES = [(0, 300), (-5, 5), (0, 2**40), (-(2**63), 2**63 - 1)]


def counted_pairs(rows, by_rows):
    baskets = collections.defaultdict(list)
    for txn, product in rows:
        if txn is not None and product is not None:
            baskets[txn].append(product)
    lists = (items if by_rows else sorted(set(items)) for items in baskets.values())
    return collections.Counter((a, b) for items in lists for a, b in itertools.product(items, repeat=2) if a < b)


def found(df):
    return {(r.product_a, r.product_b): r.pair_count for r in df.collect()}


@pytest.mark.parametrize("low,high", RANGES)
def test_lists_and_pairs_come_back(low, high):
    random_ = np.random.default_rng(5)
    lists = [np.unique(random_.integers(low, high, random_.integers(1, 9))) for _ in range(200)]
    starts = np.concatenate([[0], np.cumsum([len(one) for one in lists])])
    columns = [np.concatenate(lists), random_.integers(1, 2**40, starts[-1])]
    for fields in (1, 2):
        back, at = packed.unpack_lists(packed.pack_lists(columns[:fields], starts).slice(3), fields)
        assert list(at) == list(starts[3:] - starts[3])
        assert all((a == b[starts[3]:]).all() for a, b in zip(back, columns))
    ends = random_.integers(low, high, (2, 2000))
    first, second = ends.min(0)[ends[0] != ends[1]], ends.max(0)[ends[0] != ends[1]]
    expected = collections.Counter(zip(first.tolist(), second.tolist()))
    for parts in (1, 2, 211):
        rows = packed.dealt(packed.added([first, second, None]), parts).to_pylist()
        back = [zip(*(c.tolist() for c in packed.unpack_pairs(r["_pairs"], r["_part"], parts))) for r in rows]
        assert sum(r["_part"] < parts for r in rows) == len(rows) == len({r["_part"] for r in rows})
        assert collections.Counter({(a, b): n for one in back for a, b, n in one}) == expected


def test_the_pairs_of_a_frequent_product_go_to_all_parts():
    second = np.arange(1, 20_001)
    rows = packed.dealt([np.zeros(20_000, np.int64), second, np.ones(20_000, np.int64)], 19).to_pylist()
    sizes = [len(packed.unpack_pairs(r["_pairs"], r["_part"], 19)[0]) for r in rows]
    assert len(sizes) == 19 and max(sizes) <= 20_000 // 19 + 1


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("by_rows", [True, False])
def test_any_ids_and_steps(spark, monkeypatch, kind, by_rows):
    """Baskets of several lists, steps of a few pairs, far and negative ids; products that are no numbers are counted too."""
    monkeypatch.setattr(basket, "BASKET_ROWS", 20)
    monkeypatch.setattr(basket, "LIST_ROWS", 30)
    monkeypatch.setattr(basket, "TASK_PAIRS", 100)
    random_ = random.Random(3)
    ids = [-(2**62), -7, 0, 1, 2**33] + [random_.randrange(-(2**40), 2**62) for _ in range(55)]
    ids = ids if kind == "bigint" else [str(i) for i in ids]
    rows = [("big", p) for p in ids] + [("big", p) for p in ids[:9]] + [("b", p) for p in ids[10:37]] + [
        (f"t{i % 30}", random_.choice(ids[:25])) for i in range(150)] + [(None, ids[0]), ("big", None), ("alone", ids[1])]
    frame = spark.createDataFrame(rows, f"t string, p {kind}").repartition(3)
    expected = dict(counted_pairs(rows, by_rows))
    assert found(basket.pair_counts(frame, "t", "p", by_rows=by_rows, block=4)) == expected
    often = basket.pair_counts(frame, "t", "p", min_count=3, by_rows=by_rows, block=4)
    assert often.schema["product_a"].dataType == frame.schema["p"].dataType
    assert found(often) == {k: n for k, n in expected.items() if n >= 3}
    best = sorted(expected.items(), key=lambda item: (-item[1], item[0]))[:9]
    assert list(found(basket.pair_counts(frame, "t", "p", n=9, by_rows=by_rows, block=4, probe=12)).items()) == best


def test_tasks_that_hold_few_pairs(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packed, "HELD_PAIRS", 10)
    monkeypatch.setattr(packed, "STEP_PAIRS", 4)
    monkeypatch.setattr(packed, "STEP_BYTES", 5)
    lists = [[1, 2, 3, 4, 5, 6], [2, 9], [-4], [1, 3], [2, 4, 6]]
    one = packed.pack_lists([np.array(sum(lists, []))], np.cumsum([0, *map(len, lists)])).to_pylist()
    cells = pa.array([[one[0]], [one[1], one[3]], [one[2]], [one[2], one[4]], [one[4]]], pa.list_(pa.binary()))
    batch = pa.RecordBatch.from_arrays([cells], ["_lists"])
    expected = collections.Counter(itertools.combinations(lists[0], 2)) + collections.Counter(itertools.combinations(lists[4], 2))
    expected += collections.Counter((min(p), max(p)) for p in itertools.chain(itertools.product(lists[1], lists[3]), itertools.product(lists[2], lists[4])))
    counts, rows = collections.Counter(), 0
    for out in packed.pairs(iter([batch, batch.slice(0, 0)]), 1, False, 1, 3):
        for part, data in zip(out.column("_part").to_pylist(), out.column("_pairs").to_pylist()):
            rows += 1
            for a, b, n in zip(*packed.unpack_pairs(data, part, 3)):
                counts[int(a), int(b)] += int(n)
    assert counts == expected and rows > 3


def written_bytes(df):
    """Bytes that the shuffles of a collected frame wrote."""

    def visit(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return visit(node.plan())
        metric, children = node.metrics().get("shuffleBytesWritten"), node.children()
        own = metric.get().value() if node.nodeName() == "Exchange" and metric.isDefined() else 0
        return own + sum(visit(children.apply(i)) for i in range(children.size()))

    return visit(df._jdf.queryExecution().executedPlan())


def test_pairs_are_not_shuffled_as_rows(spark, monkeypatch):
    monkeypatch.setattr(basket, "TASK_PAIRS", 20_000)
    random_ = random.Random(11)
    rows = [(t, p) for t in range(300) for p in random_.sample(range(5_000), 40)]
    counted = basket.pair_counts(spark.createDataFrame(rows, "t bigint, p bigint"), "t", "p", min_count=2, by_rows=False, block=8)
    expected = counted_pairs(rows, False)
    assert found(counted) == {k: n for k, n in expected.items() if n >= 2}
    assert 0 < written_bytes(counted) < 6 * sum(expected.values())  # as rows, 12 bytes a pair
