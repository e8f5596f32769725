"""Packed arrays that move between runs of documents and shares of hash values.

A row holds an array for one run (documents a task handled together) and one
bucket (a share of the hash values), instead of a row per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

PACKED = "bucket int, kind int, run long, body binary"
NAMES = ["bucket", "kind", "run", "body"]


def rows_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)


def run_numbers() -> Iterator[int]:
    """Numbers no other task gives out, the same if the task is run again."""
    base = TaskContext.get().partitionId() << 32
    at = 0
    while True:
        yield base | at
        at += 1


def by_bucket(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, index of its hashes in order) for every bucket that has some."""
    share = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(share, kind="stable")
    edges = np.searchsorted(share[order], np.arange(buckets + 1))
    for bucket in np.flatnonzero(np.diff(edges)):
        yield int(bucket), order[edges[bucket] : edges[bucket + 1]]


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows of one key together, in the order of their kinds."""
    return df.repartition(key).sortWithinPartitions(key, "kind")


def squeezed(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Size and zstd body of each text, null as empty; blocks of an exchange are packed far less."""
    rows = pc.cast(pc.fill_null(texts, ""), pa.binary() if pa.types.is_string(texts.type) else pa.large_binary())
    bodies = [pa.compress(row.as_buffer(), "zstd", asbytes=True) for row in rows]
    return pc.binary_length(rows).cast(pa.int64()), pa.array(bodies, pa.binary())


def unsqueezed(sizes: pa.Array, bodies: pa.Array) -> pa.Array:
    """The texts that ``squeezed`` packed."""
    pairs = zip(sizes.to_pylist(), bodies)
    return pa.array([pa.decompress(b.as_buffer(), n, "zstd", asbytes=True) if n else b"" for n, b in pairs], pa.large_string())
