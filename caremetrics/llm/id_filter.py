"""Dropping texts that no row of another table asks for, before they are shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits of the filter; a fixed size, 2 MB. The more ids there are, the less it drops.
BITS = 1 << 24


def passing(
    texts: DataFrame, ids: DataFrame, id_col: str = "id", then: Callable | None = None, then_schema: str | None = None
) -> DataFrame:
    """The rows of ``texts`` whose id may be in ``ids``: all that are, and some that share their bits.

    ``then`` gets the batches of rows that pass, in the same Python process, and makes rows of ``then_schema``.

    ``ids`` is read here and should be checkpointed. The bits are combined in the
    tasks and sent to all of them; the join that decides comes afterwards and has
    fewer texts to move.
    """
    bit = F.pmod(F.xxhash64(id_col), F.lit(BITS))
    marked = ids.select(bit.alias("bit")).select(
        F.shiftright("bit", 5).alias("part"), F.expr("shiftleft(1L, cast(bit & 31 as int))").alias("bits")
    )
    found = marked.groupBy("part").agg(F.bit_or("bits").alias("bits")).toPandas()  # at most BITS / 32 rows
    bits = np.zeros(BITS // 32, dtype=np.int64)
    bits[found["part"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    shared = texts.sparkSession.sparkContext.broadcast(bits)
    names, schema = texts.columns, texts.schema

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("bit__").to_numpy()
            yield batch.filter(pa.array(shared.value[at >> 5] >> (at & 31) & 1 == 1)).select(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return kept(batches) if then is None else then(kept(batches))

    return texts.withColumn("bit__", bit).mapInArrow(run, schema if then is None else then_schema)
