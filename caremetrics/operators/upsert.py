"""Appending unseen keys and flagging what was stored."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremetrics.functions.membership import key_filter, may_hold, words_for
from caremetrics.schemas import TABLES
from caremetrics.session import work_dir
from caremetrics.sources.versions import VersionedTable


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Keep one row per non-null key: the smallest by its remaining columns.

    The aggregate combines copies before the shuffle, so a key repeated any
    number of times costs each task one row.
    """
    others = [c for c in df.columns if c != key]
    kept = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*others)).alias("_row"))
    )
    return kept.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def new_rows(incoming: DataFrame, existing: DataFrame, key: str, within: str | None = None) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``, each key once.

    ``within`` names a column that the key determines (the dataset id of an
    item). Its lowest and highest incoming value are looked up first (one row),
    and the stored table is read only in between: as literals they reach the
    Parquet scan, which skips row groups by their statistics. Of the keys in
    between, those that a filter of the incoming keys rules out are dropped before the
    shuffle. ``incoming`` is read three times for this and should be kept.
    """
    if key not in incoming.columns:
        raise ValueError(f"incoming rows have no key column {key!r}")
    if within is not None:
        low, high, keys = incoming.agg(F.min(within), F.max(within), F.count(key)).first()
        existing = existing.where(F.col(within).between(low, high))
        words = words_for(keys)
        if words is not None:
            existing = existing.where(may_hold(key_filter(incoming, key, words), F.col(key), words))
    unseen = one_row_per_key(incoming, key).join(existing.select(key), key, "left_anti")
    return unseen.select(*incoming.columns)


def append_new(table: str, incoming: DataFrame) -> None:
    """Append the unseen rows to a registered table, in one job."""
    spec = TABLES[table]
    spark = incoming.sparkSession
    columns = spec.schema.fieldNames()
    within = spec.bucket_by if spec.bucket_by not in (None, spec.key) else None
    kept = incoming.persist(StorageLevel.MEMORY_AND_DISK) if within else incoming
    try:
        fresh = new_rows(kept, spark.table(table), spec.key, within).select(*columns)
        _write(fresh, table, "append")
    finally:
        if within:
            kept.unpersist()


def _write(rows: DataFrame, table: str, mode: str) -> None:
    """Write to a registered table: one file per bucket that has rows, or few files."""
    column = TABLES[table].bucket_by
    if column is None:
        rows.coalesce(1).write.mode(mode).format("parquet").saveAsTable(table)
        return
    # The shuffle deals rows out as the buckets do, so each task writes one bucket.
    buckets = _buckets(rows.sparkSession, table)
    gathered = rows.repartition(buckets, column)
    gathered.write.mode(mode).format("parquet").bucketBy(buckets, column).saveAsTable(table)


def _buckets(spark, table: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").where(F.col("col_name") == "Num Buckets")
    return int(rows.first()["data_type"])


def store_flags(ids: DataFrame) -> None:
    """Write a new version of the ``datasets`` table in which ``ids`` count as stored.

    The version is written in full beside the old one; then the table is pointed to it,
    which is one step in the catalogue. Until then, and after a failure, the old one is read.
    """
    spark = ids.sparkSession
    marked = mark_stored(spark.table("datasets"), ids)
    folder, name = work_dir(spark, "datasets"), f"datasets_{uuid.uuid4().hex}"
    column, buckets = TABLES["datasets"].bucket_by, _buckets(spark, "datasets")
    gathered = marked.repartition(buckets, column).write.format("parquet").option("path", folder)
    gathered.bucketBy(buckets, column).saveAsTable(name)
    _point_to(spark, "datasets", folder)
    spark.sql(f"DROP TABLE {name}")  # files of a table with a path stay


def _point_to(spark, table: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def add_datasets(table: VersionedTable, incoming: DataFrame) -> None:
    """Add the datasets that a table in versions does not have yet; its own rows stay as they are."""

    def combine(stored: DataFrame, delta: DataFrame) -> DataFrame:
        return stored.unionByName(new_rows(delta, stored, "datasetid").select(*stored.columns))

    table.merge(incoming.where("datasetid IS NOT NULL"), combine)


def mark_stored(datasets: DataFrame, ids: DataFrame) -> DataFrame:
    """A new version of ``datasets`` in which the given ids count as stored."""
    hits = ids.select("datasetid").distinct().withColumn("_hit", F.lit(True))
    flag = F.col("stored") | F.coalesce(F.col("_hit"), F.lit(False))
    marked = datasets.join(hits, "datasetid", "left").withColumn("stored", flag)
    return marked.select(*datasets.columns)
