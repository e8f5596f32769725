"""Exact duplicates by sorting contents.

Copies within one Arrow batch are merged where they lie, so a text held by a
third of all rows reaches the sort as one row per batch. What is left is dealt
out by range: Spark samples the splitters from (leading characters, digest),
which puts equal texts next to each other, sorts each range externally, and
neighbours are compared in full. The key that is sampled is of bounded length
whatever the length of the texts; the texts themselves travel along.

Texts are equal if they are identical without ASCII white space (null counts as
empty). Of equal texts the row with the most code points stays, then the one
with the smallest id (null ids last, then the first met). Repeated rows and
repeated ids are rows like any other: exactly one row per group stays. An empty
table gives an empty result; other columns are carried unread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremetrics.session import checkpointed

_DELETED = b"\x20\x09\x0a\x0b\x0c\x0d"
# Leading characters in the sort key; the digest that follows tells the rest apart.
LEAD = 24
_LEAD, _SHA, _LENGTH, _BEST, _MEMBERS = "lead__", "sha256__", "length__", "best__", "members__"
_HELPERS = T.StructType(
    [
        T.StructField(_LEAD, T.StringType()),
        T.StructField(_SHA, T.StringType()),
        T.StructField(_LENGTH, T.LongType()),
        T.StructField(_BEST, T.IntegerType()),
        T.StructField(_MEMBERS, T.ArrayType(T.LongType())),
    ]
)
_RUNS = "keep_id long, text_sha256 string, run string, kept_at int, members array<long>"


def _normal(text: str | None) -> bytes:
    return (text or "").encode().translate(None, _DELETED)


def _merge_in_batches(id_col: str, text_col: str):
    """Per batch and text: the best row, and the ids of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(id_col).to_pylist()
            groups: dict[bytes, list] = {}
            for row, text in enumerate(batch.column(text_col)):
                text = text.as_py()
                normal = _normal(text)
                rank = (-len(text or ""), ids[row] is None, ids[row])
                group = groups.setdefault(normal, [rank, row, 0, []])
                if rank < group[0]:
                    group[:3] = rank, row, len(group[3])
                group[3].append(ids[row])
            best = batch.take(pa.array([g[1] for g in groups.values()], pa.int64()))
            added = [
                pa.array([n[: 4 * LEAD].decode(errors="ignore")[:LEAD] for n in groups], pa.string()),
                pa.array([hashlib.sha256(n).hexdigest() for n in groups], pa.string()),
                pa.array([-g[0][0] for g in groups.values()], pa.int64()),
                pa.array([g[2] for g in groups.values()], pa.int32()),
                pa.array([g[3] for g in groups.values()], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*best.columns, *added], [*best.schema.names, *_HELPERS.fieldNames()])

    return run


def _content_sorted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, *_HELPERS.fields])
    merged = docs.mapInArrow(_merge_in_batches(id_col, text_col), schema)
    ranged = merged.repartitionByRange(_LEAD, _SHA)
    return ranged.sortWithinPartitions(_LEAD, _SHA, F.desc(_LENGTH), F.asc_nulls_last(id_col))


def _neighbours(batch: pa.RecordBatch, text_col: str, seen: dict) -> Iterator[tuple[int, str, str, bool]]:
    """(row, digest, run, is first) by full comparison with what came just before.

    ``seen`` holds the texts under the current digest: one, unless two texts
    should ever share a digest.
    """
    shas = batch.column(_SHA).to_pylist()
    for row, text in enumerate(batch.column(text_col)):
        if seen.get("sha") != shas[row]:
            seen.clear()
            seen.update(sha=shas[row], texts=[])
        normal, texts = _normal(text.as_py()), seen["texts"]
        new = normal not in texts
        if new:
            texts.append(normal)
        at = texts.index(normal)
        yield row, shas[row], f"{shas[row]}.{at}" if at else shas[row], new


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, keep_id, group_size, kept, text_sha256."""
    needed = docs.select(F.col(id_col).cast("long").alias(id_col), text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        keepers: dict[str, int | None] = {}
        for batch in batches:
            ids, best = batch.column(id_col).to_pylist(), batch.column(_BEST).to_pylist()
            keep, shas, names, kept = [], [], [], []
            for row, sha, name, new in _neighbours(batch, text_col, seen):
                if new:
                    keepers = {k: v for k, v in keepers.items() if k.startswith(sha)}
                    keepers[name] = ids[row]
                keep.append(keepers[name])
                shas.append(sha)
                names.append(name)
                kept.append(best[row] if new else -1)
            columns = [pa.array(keep, pa.int64()), pa.array(shas, pa.string()), pa.array(names, pa.string()), pa.array(kept, pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column(_MEMBERS)], ["keep_id", "text_sha256", "run", "kept_at", "members"]
            )

    # A row per batch and text, without the texts; read twice below.
    runs = checkpointed(_content_sorted(needed, id_col, text_col).mapInArrow(run, _RUNS))
    sizes = runs.groupBy("run").agg(F.sum(F.size("members")).cast("long").alias("group_size"))
    rows = runs.join(sizes, "run").select(
        F.posexplode("members").alias("at", id_col), "keep_id", "group_size", "kept_at", "text_sha256"
    )
    return rows.select(
        id_col, "keep_id", "group_size", (F.col("at") == F.col("kept_at")).alias("kept"), "text_sha256"
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: one pass, nothing joined back."""
    own = {c: f"own_{c}" for c in docs.columns}
    renamed = docs.toDF(*own.values())
    names, schema, text = renamed.columns, renamed.schema, own[text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            first = [row for row, _, _, new in _neighbours(batch, text, seen) if new]
            yield batch.take(pa.array(first, pa.int64())).select(names)

    kept = _content_sorted(renamed, own[id_col], text).mapInArrow(run, schema)
    return kept.select(*[F.col(o).alias(c) for c, o in own.items()])
