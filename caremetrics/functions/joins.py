"""Join sides of measured size, and joins that spread a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of rows, as their types declare them, that may be sent to every task.
SMALL_BYTES = 16 << 20
# Tasks that the rows of one key are spread over.
SALTS = 16


def row_bytes(df: DataFrame) -> int:
    """Size of a row as Spark estimates it from the column types."""
    return sum(f.dataType().defaultSize() for f in df._jdf.schema().fields()) + 8


def small_side(df: DataFrame, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Mark a stored ``df`` for broadcast if its rows are few bytes, else return it as is.

    All rows are counted, in parallel; ``df`` should be checkpointed or read from a
    table, so that the count does not compute it again.
    """
    return F.broadcast(df) if df.count() * row_bytes(df) <= max_bytes else df


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], spread_by: Column, salts: int = SALTS) -> DataFrame:
    """Inner join on ``keys``; the rows of a key of ``left`` go to up to ``salts`` tasks.

    ``right`` has one small row per key, which is repeated for every salt. What is
    grouped by the keys afterwards is combined in two steps, as its rows are apart.
    """
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(copies, [*keys, "_salt"]).drop("_salt")
