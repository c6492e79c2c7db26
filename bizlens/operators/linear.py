"""Linear and logistic regression from sums over the rows: closed normal equations, and Newton steps.

Both need one narrow aggregate per fit or step, whatever the number of rows: every task adds up products, the partial sums
are merged, and a system with one equation per column is solved on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.operators.scale import settled

#: Newton steps at most, and the largest change of a coefficient that ends them.
STEPS, SETTLED = 50, 1e-12


def solve(matrix: Sequence[Sequence], right: Sequence) -> list:
    """``matrix`` x = ``right`` by elimination with the largest pivot; an unknown that others determine becomes 0."""
    rows = [[*row, b] for row, b in zip(matrix, right)]
    size, pivots = len(rows), {}
    scale = max((abs(v) for row in matrix for v in row), default=0)
    least = 0 if isinstance(scale, Fraction) else scale * 1e-14
    used: set[int] = set()
    for column in range(size):
        best = max((i for i in range(size) if i not in used), key=lambda i: abs(rows[i][column]), default=None)
        if best is None or abs(rows[best][column]) <= least:
            continue
        used.add(best)
        pivots[column] = best
        for i in range(size):
            if i != best and rows[i][column]:
                factor = rows[i][column] / rows[best][column]
                rows[i] = [a - factor * b for a, b in zip(rows[i], rows[best])]
    return [rows[pivots[c]][size] / rows[pivots[c]][c] if c in pivots else scale * 0 for c in range(size)]


@dataclass(frozen=True)
class Gram:
    """Number of rows, sums and sums of products of some columns, as exact fractions."""

    columns: tuple[str, ...]
    rows: int
    sums: dict[str, Fraction]
    products: dict[tuple[str, str], Fraction]

    def covariance(self, a: str, b: str) -> Fraction:
        """Sum of products of the differences from the means."""
        product = self.products.get((a, b), self.products.get((b, a)))
        return product - self.sums[a] * self.sums[b] / self.rows

    def correlation(self, a: str, b: str) -> float | None:
        """Pearson correlation; none for a constant column."""
        spread = self.covariance(a, a) * self.covariance(b, b)
        return float(self.covariance(a, b)) / math.sqrt(spread) if spread else None

    def correlations(self, spark: SparkSession) -> DataFrame:
        """x, y, correlation of every pair, both ways."""
        rows = [(x, y, self.correlation(x, y)) for x in self.columns for y in self.columns]
        return spark.createDataFrame(rows, "x string, y string, correlation double")


def gram(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> Gram:
    """All cross products of ``columns`` over the rows where none of them is null, in one aggregate.

    With ``digits`` the columns are rounded to so many decimals and added up exactly, so the result does not depend on how the rows
    are dealt; sums beyond 38 decimal digits raise.  Else they are sums of doubles.
    """
    kind = f"decimal(18,{digits})" if digits is not None else "double"
    cells = [F.col(c).cast(kind) for c in columns]
    narrow = df.select(*[c.alias(f"c{i}") for i, c in enumerate(cells)]).dropna()
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    row = narrow.agg(
        F.count("*").alias("n"), *[F.try_sum(f"c{i}").alias(f"s{i}") for i in range(len(columns))],
        *[F.try_sum(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"p{i}_{j}") for i, j in pairs]).first()
    found = {name: row[name] for name in row.asDict() if name != "n"}
    if row["n"] and any(v is None for v in found.values()):
        raise OverflowError("a sum of products has more than 38 decimal digits; leave digits out")
    value = {name: Fraction(v) if v is not None else Fraction(0) for name, v in found.items()}
    return Gram(tuple(columns), row["n"], {c: value[f"s{i}"] for i, c in enumerate(columns)},
                {(columns[i], columns[j]): value[f"p{i}_{j}"] for i, j in pairs})


@dataclass(frozen=True)
class Coefficients:
    """A fitted line, or the log-odds of one."""

    features: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]
    logistic: bool = False

    def line(self) -> Column:
        value = F.lit(self.intercept)
        for name, weight in zip(self.features, self.weights):
            value = value + F.lit(weight) * F.col(name).cast("double")
        return value

    def score(self) -> Column:
        """The predicted value; for log-odds the probability of class 1."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.line())) if self.logistic else self.line()

    def table(self, spark: SparkSession) -> DataFrame:
        """name, value; the intercept has the name ``(intercept)``."""
        rows = [("(intercept)", self.intercept), *zip(self.features, self.weights)]
        return spark.createDataFrame(rows, "name string, value double")

    def save(self, spark: SparkSession, path: str) -> str:
        places = [(i, name, value, self.logistic) for i, (name, value) in enumerate([("", self.intercept), *zip(self.features, self.weights)])]
        spark.createDataFrame(places, "place int, name string, value double, logistic boolean").write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> Coefficients:
        rows = spark.read.parquet(path).orderBy("place").collect()
        return Coefficients(tuple(r["name"] for r in rows[1:]), rows[0]["value"], tuple(r["value"] for r in rows[1:]), rows[0]["logistic"])


def fit_line(df: DataFrame, features: Sequence[str], label: str, digits: int | None = None) -> Coefficients:
    """Least squares with an intercept, from one :func:`gram`; complete rows only.

    The equations are solved in exact fractions.  A feature that earlier ones determine (or a constant one) gets weight 0; without
    rows everything is 0.
    """
    sums = gram(df, [*features, label], digits)
    if not sums.rows:
        return Coefficients(tuple(features), 0.0, (0.0,) * len(features))
    weights = solve([[sums.covariance(a, b) for b in features] for a in features], [sums.covariance(a, label) for a in features])
    intercept = (sums.sums[label] - sum(w * sums.sums[f] for w, f in zip(weights, features))) / sums.rows
    return Coefficients(tuple(features), float(intercept), tuple(map(float, weights)))


def _newton_sums(rows: DataFrame, at: Sequence[float]) -> tuple[float, list[float], list[list[float]]]:
    """Loss, gradient and Hessian of the log-likelihood (without a penalty) at the coefficients ``at``, intercept first."""
    size = len(at)
    cells = [F.lit(1.0), *[F.col(f"x{i}") for i in range(1, size)]]
    line = sum((F.lit(float(b)) * x for b, x in zip(at, cells)), F.lit(0.0))
    # log(1 + exp(z)) without overflow
    loss = F.greatest(F.col("z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z")
    scored = rows.withColumn("z", line).withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z"))))
    slope, bend = F.col("p") - F.col("y"), F.col("p") * (F.lit(1.0) - F.col("p"))
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    row = scored.agg(F.sum(loss).alias("loss"), *[F.sum(slope * cells[i]).alias(f"g{i}") for i in range(size)],
                     *[F.sum(bend * cells[i] * cells[j]).alias(f"h{i}_{j}") for i, j in pairs]).first()
    bends = [[row[f"h{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(size)] for i in range(size)]
    return row["loss"] or 0.0, [row[f"g{i}"] or 0.0 for i in range(size)], bends


def fit_log_odds(df: DataFrame, features: Sequence[str], label: str, c: float = 1.0, steps: int = STEPS) -> Coefficients:
    """Logistic regression with the L2 penalty ``|weights|^2 / (2 c)`` on the sum of the losses, the intercept left free.

    Newton steps from 0; each is one aggregate of loss, gradient and Hessian over the rows, which are read again rather than
    kept in memory.  A step that does not lower the loss is halved.  Rows with a null are left out; one class only
    ends when the steps do, with finite coefficients.
    """
    rows = settled(df.select(F.col(label).cast("double").alias("y"), *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features, 1)]).dropna())
    size = len(features) + 1
    penalty = [0.0] + [1.0 / c] * len(features)

    def measure(at):
        loss, slopes, bends = _newton_sums(rows, at)
        return (loss + sum(p * b * b for p, b in zip(penalty, at)) / 2, [g + p * b for g, p, b in zip(slopes, penalty, at)],
                [[h + (penalty[i] if i == j else 0.0) for j, h in enumerate(line)] for i, line in enumerate(bends)])

    at = [0.0] * size
    loss, slopes, bends = measure(at)
    for _ in range(steps):
        move = solve(bends, slopes)
        if max(map(abs, move), default=0.0) <= SETTLED * max(1.0, *map(abs, at)):
            break
        part = 1.0
        while True:
            there = [b - part * m for b, m in zip(at, move)]
            found = measure(there)
            if found[0] <= loss + 1e-12 * abs(loss) or part < 1e-6:
                break
            part /= 2
        if part < 1e-6:
            break
        at, (loss, slopes, bends) = there, found
    return Coefficients(tuple(features), at[0], tuple(at[1:]), True)
