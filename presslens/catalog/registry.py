"""Registration of queries and assembly of their oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from presslens.catalog.inputs import DRIVER_TABLES, VIEWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Intermediate tables of the oracles, in DuckDB SQL; names may refer to views and to each other.
TABLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the body of its oracle when there is one."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return function

    return register


def needed(sql: str, known: dict[str, str]) -> list[str]:
    """Known names used in ``sql``, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z][a-z0-9_]*\b", text)):
            if word in known and word not in order:
                visit(known[word])
                if word not in order:
                    order.append(word)

    visit(sql)
    return order


def with_tables(body: str) -> str:
    """``body`` preceded by a WITH clause for every view and table it uses."""
    known = {**VIEWS, **TABLES}
    names = needed(body, known)
    if not names:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({known[n].strip()})" for n in names)
    return f"WITH {ctes}\n{body.strip()}"


#: Plans of views already analysed, by application, folder and view.  Plans only, no data.
_PLANS: dict[tuple[str, str, str], DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """A view of the test tables as a DataFrame."""
    key = (spark.sparkContext.applicationId, sf_dir, view)
    if key not in _PLANS:
        sql = with_tables_of(view)
        used = [t for t in DRIVER_TABLES if re.search(rf"\b{t}\b", sql)]
        for table in used:
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
        _PLANS[key] = spark.sql(sql)
    return _PLANS[key]


def with_tables_of(view: str) -> str:
    names = needed(VIEWS[view], VIEWS)
    ctes = [f"{n} AS ({VIEWS[n].strip()})" for n in names]
    head = "WITH " + ",\n".join(ctes) + "\n" if ctes else ""
    return head + VIEWS[view].strip()
