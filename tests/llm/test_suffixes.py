"""Repeated byte strings against a count of all strings of 200 bytes."""

import hashlib
import random
from collections import Counter

from bizlens.llm import queries, suffixes


def brute(rows):
    """(id, n_bytes, n_removed, n_spans, sha256) by counting every string."""
    texts = [(row[1] or "").encode() for row in rows]
    count = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for row, t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if count[t[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((row[0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def prose(seed, n):
    r = random.Random(seed)
    return "".join(r.choice("abcdefgh éü") for _ in range(n))


def test_cover():
    for d in range(1, suffixes.PERIOD):
        assert any((a - b) % suffixes.PERIOD == d for a in suffixes.COVER for b in suffixes.COVER)


def test_small_cases(spark):
    a, b, c = prose(1, 199), prose(2, 260), prose(3, 900)
    exact = "x" * 100 + "y" * 100
    rows = [
        (5, prose(10, 50) + b + prose(11, 40)), (1, b), (2, prose(12, 333) + b[:230]), (3, a), (4, a), (None, c), (7, c), (8, c[:700]), (9, None), (10, ""),
        (11, "z" * 199), (12, "k" * 200), (13, "m" * 201), (14, prose(20, 1500) + c[100:450] + prose(21, 77) + c[300:650]), (15, exact), (16, "q" + exact),
        (17, prose(30, 400)), (17, prose(30, 400)), (18, (prose(40, 150) + "|") * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(suffixes.remove_strings(df)) == brute(rows)


def test_passages_at_all_offsets(spark, monkeypatch):
    passage, r = prose(5, 420), random.Random(3)
    rows = []
    for i in range(260):
        low = r.randrange(0, 200)
        rows.append((i, prose(1000 + i, i) + passage[low:low + r.randrange(190, 420)] + prose(5000 + i, r.randrange(300))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    assert found(suffixes.remove_strings(df)) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    assert suffixes.remove_strings(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    clash = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id long, text string, spans string, n_bytes int")
    row = suffixes.remove_strings(clash).first()
    assert (row.spans, row.n_bytes, bytes(row.kept)) == ("x", 3, b"a b")


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(queries.QUERIES["op3_repeated_strings"](spark, sf_dir)) == brute(rows)
