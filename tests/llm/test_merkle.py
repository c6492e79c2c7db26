"""Fingerprints and likeness against a plain program, and the next row of every row."""

import hashlib
import random
import re

import pytest
import xxhash

from bizlens.llm import merkle

ODD = ["", None, "a", "One. Two! Three?", "x" * 300, "line\n\nline\n", "é" * 70 + ".!?\n日本。", "\n".join(f"p{i}. q" for i in range(40)), "long words " * 20_000]


def digest(text):
    return f"{xxhash.xxh64(text.encode(), seed=42).intdigest():016x}"


def plain(text):
    paragraphs = [[digest(p) for p in re.findall(merkle.PIECE, line)] for line in (text or "").split("\n")]
    nodes, sections, section = [digest(" ".join(p)) for p in paragraphs], [], []
    for i, node in enumerate(nodes):
        section.append(node)
        if node[-1] in "08" or i == len(nodes) - 1:
            sections.append(digest(" ".join(section)))
            section = []
    root = hashlib.sha256(" ".join(sections).encode()).hexdigest()
    return "|".join([root, " ".join(sections), " ".join(nodes), " ".join(x for p in paragraphs for x in p)])


def alike(a, b):
    if a[:64] == b[:64]:
        return 1.0
    x, y = (set(p.split("|")[3].split()) for p in (a, b))
    return len(x & y) / max(len(x | y), 1)


def expected(rows):
    """Rows of the operator in the order of descending ids, nulls last, equal ids by text."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    found = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        a, b, c = map(plain, (text, edited, after))
        found.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, alike(a, b), alike(a, c)))
    return sorted(found, key=repr)


def got(df):
    return sorted(map(tuple, merkle.edit_likeness(df).collect()), key=repr)


def test_fingerprints_and_likeness(spark):
    draw = random.Random(4)
    rows = list(enumerate(ODD)) + [(1_000 + 7 * i, "\n".join(draw.choice(["One. Two.", "b c d", "", "Three! é", f"u{i}"]) for _ in range(draw.randrange(30)))) for i in range(150)]
    rows += [(None, "null id"), (2**62, "far"), (-5, "minus"), (-(2**62), "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, tie string, part int").repartition(5)
    assert got(df) == expected(rows)


def test_repeated_ids_and_rows(spark):
    rows = [(3, "b"), (3, "a. c."), (3, "a. c."), (None, "n. m."), (None, None), (None, "o"), (1, "z")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == expected(rows)


@pytest.mark.parametrize("n", [0, 1])
def test_none_and_one(spark, n):
    rows = [(7, "Only one. Row.")][:n]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_a_hot_id_is_cut_by_its_texts(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HOT_ID", 20)
    monkeypatch.setattr(merkle, "SLICE_ROWS", 10)
    rows = [(5, f"text {i}. more {i}.") for i in range(100)] + [(i, f"other {i}") for i in range(30) if i != 5] + [(2**63 - 1, f"top {i}") for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    parts = merkle.parts_of(df.withColumnRenamed("doc_id", "id"))
    sizes = {r["part"]: r["count"] for r in parts.where("id = 5").groupBy("part").count().collect()}
    assert len(sizes) == 10 and max(sizes.values()) < 25
    assert parts.where("id != 5 and part in (" + ",".join(map(str, sizes)) + ")").count() == 0
    # rows of the hot id follow each other by a hash of the text: each is followed by one of them, all but one once
    follow = [(r.text, r.next_text) for r in merkle.with_next(df).where("id = 5").collect()]
    inner = [b for _, b in follow if b.startswith("text")]
    assert len(inner) == 99 == len(set(inner)) and sorted(a for a, _ in follow) == sorted(t for i, t in rows if t.startswith("text"))
    everyone = [r.next_text for r in merkle.with_next(df).collect()]
    assert sorted(everyone) == sorted(t for _, t in rows)


def test_texts_are_dealt_once(spark, sf_dir):
    plan = merkle.edit_likeness(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("Exchange hashpartitioning") == 1 and physical.count("FileScan") == 1 and "Python" not in physical
