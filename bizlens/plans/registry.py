"""The list of reports: a Spark query each, with the SQL that gives the same rows.

``columns`` names the result columns and their kinds for both sides: ``i`` whole number, ``f`` double,
``f2`` double rounded to 2 digits, ``s`` text (dates as ``yyyy-MM-dd``), ``b`` boolean.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.plans.inputs import SQL_VIEWS, Tables


@dataclass(frozen=True)
class Report:
    name: str
    items: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REPORTS: dict[str, Report] = {}


def _kinds(columns: str) -> list[tuple[str, str]]:
    return [tuple(part.split(":")) for part in columns.split()]


def _spark_column(name: str, kind: str) -> Column:
    column = F.col(f"`{name}`")
    if kind[0] == "f":
        column = column.cast("double")
        return (F.round(column, int(kind[1:])) if kind[1:] else column).alias(name)
    return column.cast({"i": "bigint", "s": "string", "b": "boolean"}[kind]).alias(name)


def _sql_column(name: str, kind: str) -> str:
    if kind[0] == "f" and kind[1:]:
        digits = f"CAST(CAST(CAST({name} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,15))"
        return f"CAST(round({digits}, {kind[1:]}) AS DOUBLE) AS {name}"
    return f"CAST({name} AS {dict(i='BIGINT', f='DOUBLE', s='VARCHAR', b='BOOLEAN')[kind[0]]}) AS {name}"


def _with_views(sql: str) -> str:
    """Prefix the views that the text mentions, and those the views need."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in SQL_VIEWS.items():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(body)
                needed.append(name)

    visit(sql)
    views = ",\n".join(f"{name} AS ({SQL_VIEWS[name]})" for name in needed)
    return f"WITH {views}\n" if views else ""


def report(name: str, items: str, columns: str, sql: str | None = None):
    """Register a query; ``items`` are the identifiers of the survey's inventory it covers."""
    kinds = _kinds(columns)

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir)).select(*[_spark_column(n, k) for n, k in kinds])

        full = None
        if sql is not None:
            listed = ", ".join(_sql_column(n, k) for n, k in kinds)
            full = f"{_with_views(sql)}SELECT {listed}\nFROM ({sql.strip()}) AS answer"
        if name in REPORTS:
            raise ValueError(f"report {name} is registered twice")
        REPORTS[name] = Report(name, tuple(items.split()), run, full)
        return build

    return register
