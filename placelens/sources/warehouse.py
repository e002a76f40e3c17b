"""Reading a query from a SQL warehouse over JDBC."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 32,
    fetch_size: int = 10_000,
    user_variable: str = "WAREHOUSE_USER",
    password_variable: str = "WAREHOUSE_PASSWORD",
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    With a partition column the query is wrapped as a table so that executors read
    ranges in parallel; without one it is a single read. Credentials come from the
    environment, never from code.
    """
    text = query.strip().rstrip(";")
    options = {"url": url, "fetchsize": str(fetch_size)}
    for option, variable in (("user", user_variable), ("password", password_variable)):
        if variable in os.environ:
            options[option] = os.environ[variable]
    if partition_column is None:
        return options | {"query": text}
    if lower is None or upper is None:
        raise ValueError("a partitioned read needs lower and upper bounds")
    return options | {
        "dbtable": f"({text}) AS q",
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_warehouse(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load()
