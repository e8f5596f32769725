"""Readers for stored tables: SQL text with parameters, and partitioned JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def fetch(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL text with ``:name`` parameters over ``{name}`` DataFrames.

    Values never become part of the text, and errors are raised.
    """
    return spark.sql(text, args=args, **frames)


def jdbc_options(
    url: str,
    table: str,
    driver: str,
    split_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    **credentials: str,
) -> dict[str, str]:
    """Options of a JDBC scan, read in parallel ranges of ``split_column`` when given."""
    options = {"url": url, "dbtable": table, "driver": driver, **credentials}
    if split_column is not None:
        if lower is None or upper is None:
            raise ValueError("a split column needs both bounds")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **settings) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**settings)).load()
