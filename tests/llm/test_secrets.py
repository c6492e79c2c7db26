"""Secret spans against Python's expressions; the automaton's arrays and lanes."""

import random
import re

import numpy as np
import pytest

from bizlens.llm import automaton, queries, secret_scan

WORDS = ["token", "=", ":", ",", " ", "  ", "'", '"', "secret", "PassWord", "pass", "word", "api_key", "apikey", "APIkey", "passwd", "AKIA", "0a1b2c3d4e5f", "abc", "DEADBEEF99",
         "ghp_", "xyz0123456789abcdef0123456789abcdef01234", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "é", "\n", ".", "sk_live_", "xoxb-", "日本", "ſ", "K", "/+-"]


def plain(text):
    """(kind, start, end) of all rules, kinds in their order; bytes are code points of the text."""
    found = []
    for rule in secret_scan.RULES:
        for match in re.finditer(f"({rule.head})(?:{rule.body})", text):
            if match.end() - match.end(1) >= rule.least:
                found.append((match.start(), rule.kind, match.end()))
    kinds = [r.kind for r in secret_scan.RULES]
    return [(k, s, e) for s, k, e in sorted(found, key=lambda m: (m[0], kinds.index(m[1])))]


def texts():
    draw = random.Random(11)
    made = ["".join(draw.choice(WORDS) for _ in range(draw.randint(0, 70))) for _ in range(400)]
    made += ["", None, "a" * 30_000, "token=" + " " * 5_000 + "'abcdefg", "AKIA" + "B7" * 40_000 + " x", "éé" * 600 + " secret: abcdef",
             "token=token: abcdefgh", "secret==abcdefgh", "password = abc", "x" * 511 + "token=abcdefgh", "deadbeef" * 3, "deadbeef" * 3 + "0" * 511 + "g"]
    return made + made[:5]


def test_spans_equal_regular_expressions(spark):
    rows = [(i, t, "spans", i) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "row long, text string, spans string, start long").repartition(3)
    found = secret_scan.find_secrets(docs)
    assert found.columns == ["row", "text", "start", "spans"]
    got = {r["row"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in found.collect()}
    assert got == {i: plain(t or "") for i, t, *_ in rows}
    assert sum(map(len, got.values())) > 100


def test_query_and_empty_table(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts()[:100])] + [(None, None)]
    for name, part in (("all", rows), ("none", [])):
        path = str(tmp_path / name)
        spark.createDataFrame(part, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
        got = {r["doc_id"]: r for r in queries.op13_secret_spans(spark, path).collect()}
        assert set(got) == {r[0] for r in part}
        for doc_id, text in part:
            spans = plain(text or "")
            assert got[doc_id]["spans"] == ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
            assert [got[doc_id][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]


def test_minimal_automaton():
    both = automaton.compile_rules(["ab", "cb"])
    assert both.states == 5  # nothing, behind a, behind c, and two ends that differ in their rule
    assert automaton.compile_rules(["(ab|cb)"]).states == 3
    assert automaton.compile_rules(["a{3}b?"], anchored=True).states == 6  # dead, start, a, aa, aaa, aaab


@pytest.mark.parametrize("lane", [4, 512])
def test_lanes_follow_the_states(monkeypatch, lane):
    monkeypatch.setattr(automaton, "LANE", lane)
    machine = automaton.compile_rules(["ab+c", "[b-c]{3}"])
    draw = np.random.default_rng(2)
    for size in (0, 1, 7, 2_000):
        symbols = machine.symbol[draw.choice([97, 98, 99, 120], size, p=[0.1, 0.6, 0.2, 0.1]).astype(np.uint8)]
        state, expected = 0, []
        for s in symbols:
            state = machine.step[state * machine.width + s]
            expected.append(state)
        assert automaton.states_after(machine, symbols).tolist() == expected
