"""Repair of conversations against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from bizlens.llm import queries, turns

SCHEMA = "conv_id long, turn long, role string, text string, place long, conv string, letter string, total long"
INK = r"[^\x20\x09-\x0D]"


def cheapest(rows):
    """(cost, audit, lines) of ``rows`` (role, text, fault): every edit tried at every place, least by cost and then audit."""
    pattern = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    @lru_cache(None)
    def best(at, state, room):
        found = []
        if at == len(rows):
            if state in (0, 3):
                found.append((0, "", ()))
        else:
            role, text, fault = rows[at]
            cut = int(fault == 3)
            cost, audit, lines = best(at + 1, state, 3)
            found.append((3 + cost, "D" + audit, lines))
            if fault in (0, 3):
                if role[:1] in pattern[state]:
                    cost, audit, lines = best(at + 1, pattern[state][role[:1]], 3)
                    found.append((cut + cost, "K" + audit, (f"{role}:{text}", *lines)))
                for name in ("user", "assistant"):
                    if name[0] in pattern[state]:
                        cost, audit, lines = best(at + 1, pattern[state][name[0]], 3)
                        found.append((2 + cut + cost, "R" + audit, (f"{name}:{text}", *lines)))
        if room:
            for name in ("user", "assistant"):
                if name[0] in pattern[state]:
                    cost, audit, lines = best(at, pattern[state][name[0]], room - 1)
                    found.append((2 + cost, "I" + audit, (f"{name}:", *lines)))
        return min(found, default=(10**9, "", ()))

    return best(0, 0, 3)


def plain(rows):
    """Expected rows of the query, from undamaged (conv_id, turn, role, text)."""
    convs = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        way = zlib.crc32(key.encode()) % 20
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        found = (turn is not None, turn or 0, "user" if way == 4 else role, text, turn)
        convs[conv] += [] if way == 0 else [found] * (1 + (way == 3))
    expected = []
    for conv, found in convs.items():
        found.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        seen, marked = set(), []
        for _, _, role, text, _ in found:
            ink = re.findall(INK, text)
            marked.append((role, text, 1 if not ink else 2 if (role, text) in seen else 3 if ink[-1] not in ".!?" else 0))
            seen.add((role, text))
        numbers = [r[4] for r in found if r[4] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = cheapest(tuple(marked))
        faults = [m[2] for m in marked]
        expected.append((conv, gaps, *[faults.count(f) for f in (1, 2, 3)], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return expected


def run(spark, rows, tmp_path, monkeypatch, block):
    path = str(tmp_path / "sf")
    extra = (9, "c", "x", 9)  # columns that the operator has names for
    spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA).repartition(3).write.parquet(f"{path}/conversations.parquet")
    monkeypatch.setattr(turns.repair, "__defaults__", (block,))
    found = queries.op12_turn_repair(spark, path)
    return [tuple(r) for r in found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]


def odd_rows():
    draw = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["One.", "Two!", "three", " \t\n", "", None, "Four? \x0b", "é。", "One.", "Fünf.\r\n", "six ...  "]
    rows = [(c, t, draw.choice(roles), draw.choice(texts)) for c in range(60) for t in range(draw.randint(1, 9))]
    rows += [(None, t, "user", "a.") for t in (None, 1, 1, 5)] + [(70, None, None, None), (71, None, "user", "x."), (71, None, "assistant", "y.")]
    rows += [(99, t, draw.choice(roles), f"{draw.choice(texts)}{draw.choice(['', t])}") for t in range(120)]
    rows += [(98, 1, "user", "long. " * 30_000), (98, 2, "assistant", "ok.")]
    return rows + rows[:3]


@pytest.mark.parametrize("block", [3, 4096])
def test_repairs_are_the_cheapest(spark, tmp_path, monkeypatch, block):
    rows = odd_rows()
    got = run(spark, rows, tmp_path, monkeypatch, block)
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


def test_no_conversation(spark, tmp_path, monkeypatch):
    assert run(spark, [], tmp_path, monkeypatch, 4096) == []


def test_walk_equals_the_search_and_keeps_few_costs():
    draw = random.Random(3)
    for _ in range(300):
        letters = "".join(chr(65 + draw.randrange(16)) for _ in range(draw.randint(1, 12)))
        rows = tuple(("suao"[(ord(x) - 65) % 4], "t", (ord(x) - 65) // 4) for x in letters)
        walks, due = turns.walk(letters, turns.END, [0], True)
        assert (due[0], "".join(walks[0][0])) == cheapest(rows)[:2]
    step, kept = turns.checkpoints("A" * 10_000, turns.END)
    assert step == 100 and len(kept) == 101


def test_repaired_roles_follow_the_pattern(spark):
    rows = spark.createDataFrame([(1, i, r, "t.") for i, r in enumerate(["user", "user", "tool", "system", "user"])], SCHEMA.rsplit(", place", 1)[0])
    edited, _ = turns.repair(rows, block=2)
    roles = [r["role"] for r in turns.repaired_turns(edited).orderBy("place", "step").collect()]
    assert re.fullmatch("s?(ua)+", "".join(r[0] for r in roles))
