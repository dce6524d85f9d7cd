"""Relational sources and parameterised queries."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower: int = 0,
    upper: int = 0,
    partitions: int = 1,
) -> DataFrame:
    """A table of a database; the schema comes from the database.

    ``partition_column`` with its bounds splits the read into ``partitions`` parallel range
    queries.  Filters and column selections are pushed into them.
    """
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=dict(properties or {}))
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=dict(properties or {}),
    )


def read_snapshot(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The same table as a parquet snapshot."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def param_query(
    spark: SparkSession,
    query: str,
    args: Mapping[str, Any],
    tables: Mapping[str, DataFrame] | None = None,
    require_rows: bool = False,
) -> DataFrame:
    """Run a query with named parameters (``:name``) and DataFrames as ``{table}`` references.

    Parameters are bound as literals, never pasted into the text.  ``require_rows`` raises when
    nothing is found.
    """
    result = spark.sql(query, args=dict(args), **dict(tables or {}))
    if require_rows and result.isEmpty():
        raise ValueError("the query returned no data")
    return result
