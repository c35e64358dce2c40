"""Relational reads and appends, and parameterised SQL over DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidewatch import schema


def run_query(spark: SparkSession, query: str, params: Mapping[str, Any] | None = None,
              **tables: DataFrame) -> DataFrame:
    """SQL with `:name` parameters over tables written as `{table}` in the text."""
    return spark.sql(query, args=dict(params or {}), **tables)


def jdbc_options(url: str, query: str, partition_column: str | None = None,
                 bounds: tuple[Any, Any] | None = None, partitions: int | None = None,
                 **options: Any) -> dict[str, Any]:
    """Reader options for a query: one connection, or one per range of `partition_column`.

    The bounds only place the ranges; rows outside them belong to the first and the last.
    """
    if partition_column is None:
        return {"url": url, "query": query, **options}
    if bounds is None or partitions is None:
        raise ValueError("a partition column needs bounds and a number of partitions")
    return {"url": url, "dbtable": f"({query}) AS asked", "partitionColumn": partition_column,
            "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": partitions, **options}


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str | None = None,
              bounds: tuple[Any, Any] | None = None, partitions: int | None = None,
              **options: Any) -> DataFrame:
    """Rows of a query run by the database, in parallel where a partition column is given."""
    chosen = jdbc_options(url, query, partition_column, bounds, partitions, **options)
    return spark.read.format("jdbc").options(**chosen).load()


def append_jdbc(rows: DataFrame, url: str, table: str, **options: Any) -> None:
    """Append rows in multi-row batches, one connection per partition."""
    (rows.write.format("jdbc").mode("append")
     .options(url=url, dbtable=table, **{"batchsize": schema.INSERT_BATCH, **options}).save())
