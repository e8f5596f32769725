"""Literal rows as a local relation, whose size the optimizer knows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    T.StringType: pa.string(),
    T.IntegerType: pa.int32(),
    T.LongType: pa.int64(),
    T.DoubleType: pa.float64(),
}


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A DataFrame of a few given rows (lookups, headings, a caller's list)."""
    columns = [
        pa.array([row[i] for row in rows], _ARROW[type(field.dataType)])
        for i, field in enumerate(schema)
    ]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)
