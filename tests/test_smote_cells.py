"""Oversampling with and without cells."""

import random

import numpy as np

from bizlens.operators import features


def test_cells_do_not_change_synthetic_rows(spark):
    r = random.Random(4)
    rows = [(i, float(r.randrange(40)), r.gauss(0, 1), 1) for i in range(200)]
    rows += [(1000 + i, 5.0, 0.5, 1) for i in range(30)]  # copies of one point
    rows += [(5000 + i, r.random(), r.random(), 0) for i in range(900)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y int").repartition(5)

    def made(cell_rows):
        out = features.smote(df, ["a", "b"], "y", "k", cell_rows=cell_rows)
        return sorted((x.a, x.b) for x in out.where("k is null").collect())

    whole = made(4_000)
    assert len(whole) == 670
    assert made(25) == whole


def test_neighbours_are_the_nearest(spark):
    r = random.Random(6)
    points = [(r.gauss(0, 1), float(r.randrange(9)), r.random()) for _ in range(150)]
    df = spark.createDataFrame([(str(i), 1, *p) for i, p in enumerate(points)], "_key string, _copies long, a double, b double, c double")
    cells = features._cells(df, ["a", "b", "c"], "_key", 20)
    space = np.array(points)
    for row in features._neighbours(cells, ["a", "b", "c"], 5).collect():
        gaps = ((space - space[int(row["_key"])]) ** 2).sum(1)
        gaps[int(row["_key"])] = np.inf
        assert {tuple(p) for p in row["_near"]} == {points[i] for i in np.argsort(gaps)[:5]}
