"""Repeated word windows against a dictionary of all windows."""

import hashlib
import re

import pytest

from bizlens.llm import queries, substrings

WORD = re.compile("[^\x20\x09-\x0d]+")
PASSAGE = " ".join(f"p{i}" for i in range(45))
OTHER = " ".join(f"q{i}" for i in range(25))


def brute(rows):
    """(id, n_words, n_removed, sha256) by looking up every window; rows are (id, text)."""
    words = {row: WORD.findall(row[1] or "") for row in rows}
    first = {}
    for row in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        for p in range(len(words[row]) - 19):
            first.setdefault(tuple(words[row][p:p + 20]), (row, p))
    out = []
    for row in rows:
        gone = set()
        for p in range(len(words[row]) - 19):
            if first[tuple(words[row][p:p + 20])] != (row, p):
                gone |= set(range(p, p + 20))
        kept = " ".join(w for k, w in enumerate(words[row]) if k not in gone)
        out.append((row[0], len(words[row]), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_small_cases(spark):
    rows = [
        (3, f"a b c {PASSAGE} x y"), (1, f"{PASSAGE}\n z"), (7, f"k {OTHER} l m n o {OTHER} r"), (None, f"{OTHER} {PASSAGE}"), (9, None), (10, ""),
        (11, "only few words"), (12, " ".join(["ha"] * 90)), (13, f"{PASSAGE}\n z"), (13, f"{PASSAGE}\n z"), (14, "w " * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("x", "y")
    assert found(substrings.remove_repeats(df)) == brute(rows)


def test_many_steps(spark, monkeypatch):
    rows = [(i, f"s{i} t{i} {PASSAGE if i % 2 else OTHER} u{i} v{i % 5} " + " ".join(f"e{i % 7}x{k}" for k in range(i % 60))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    assert found(substrings.remove_repeats(df)) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(empty).count() == 0
    clash = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id long, text string, names string, n_words int")
    row = substrings.remove_repeats(clash).first()
    assert (row.names, row.n_words, row.kept_text) == ("x", 2, "a b")


def test_kept_text_keeps_its_spacing(spark):
    rows = [(1, f"{PASSAGE}"), (2, f"one  two\n{PASSAGE}\nthree\tfour ")]
    kept = {r.doc_id: r.kept_text for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {1: PASSAGE, 2: "one  two\nthree\tfour "}


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(queries.QUERIES["op8_repeated_windows"](spark, sf_dir)) == brute(rows)
    assert any(r[2] for r in brute(rows))


@pytest.mark.parametrize("own", [None, 7])
def test_rows_of_one_id_get_their_own_answers(spark, monkeypatch, own):
    """Many rows without id, or of one id: each meets the names of its own text only."""
    rows = [(own, f"h{i} {PASSAGE} t{i}") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    sizes = []
    repeated = substrings.repeated_windows

    def seen(hit, parts):
        sizes.extend(r[0] for r in hit.selectExpr("size(array_distinct(names))").collect())
        return repeated(hit, parts)

    monkeypatch.setattr(substrings, "repeated_windows", seen)
    out = found(substrings.remove_repeats(df))
    assert len(sizes) == len(rows) and max(sizes) < 60
    assert sorted(r[2] for r in out) == [0] + [45] * 119  # one row, by a hash of the texts, comes first
