"""Items arriving as files: unseen ones are stored, bad ones put aside, complete datasets flagged."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from caremetrics.operators.item_store import ItemStore
from caremetrics.operators.upsert import mark_stored
from caremetrics.schemas import TABLES
from caremetrics.sources import feeds
from caremetrics.sources.versions import LevelledTable, MarkedTable, VersionedTable

_STORED_IDS = T.StructType([T.StructField("datasetid", T.LongType())])
_REJECTED = "source_file string, reason string, record string, epoch long"
# Micro-batches that a running stream lets the cube wait for.
CUBE_EVERY = 8


def item_store(spark: SparkSession, path: str, **options) -> ItemStore:
    """The store that the stream below ``path`` writes."""
    return ItemStore(spark, path, **options)


def read_items_table(spark: SparkSession, path: str) -> DataFrame:
    """The item table written by the stream."""
    return item_store(spark, path).rows()


def stored_ids(spark: SparkSession, path: str, buckets: int = 64) -> LevelledTable:
    """Ids of datasets of which all records that arrived were stored."""
    return LevelledTable(spark, f"{path}/stored_ids", _STORED_IDS, ["datasetid"], buckets, DataFrame.distinct)


def read_stored_ids(spark: SparkSession, path: str) -> DataFrame:
    return stored_ids(spark, path).read()


def datasets_table(spark: SparkSession, path: str, buckets: int = 64) -> MarkedTable:
    """The catalogue of datasets, whose flags a stream may keep."""
    return MarkedTable(spark, path, TABLES["datasets"].schema, ["datasetid"], buckets, mark_stored)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Records that were put aside, with file, reason and epoch."""
    if not VersionedTable(spark, path, T.StructType([]))._files_in("rejected"):
        return spark.createDataFrame([], _REJECTED)
    return spark.read.schema(_REJECTED).parquet(f"{path}/rejected")


def ingest_epoch(
    batch: DataFrame, epoch: int, path: str, writer: str = "stream", datasets: MarkedTable | None = None, store: ItemStore | None = None,
    cube_every: int = 1,
) -> None:
    """Take in one micro-batch of raw records.

    Every step can be repeated: rejected records overwrite those of the same epoch, and
    items, ids and flags are versions that count an epoch of a writer once. A dataset with a
    rejected record in one of its files stays pending; its good items are stored. The cube is
    brought up to date once ``cube_every`` deliveries are not in it.
    """
    spark = batch.sparkSession
    store = store or item_store(spark, path, with_cube=datasets is not None)
    judged = feeds.judged_items(batch).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        feeds.rejected(judged).write.mode("overwrite").parquet(f"{path}/rejected/epoch={epoch}")
        items = feeds.accepted(judged)
        store.add(items, epoch, writer)
        complete = items.where("datasetid IS NOT NULL AND reportingunitcode IS NOT NULL").select("datasetid").distinct()
        complete = complete.join(feeds.incomplete_datasets(judged), "datasetid", "left_anti")
        complete = complete.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stored_ids(spark, path).add(complete, writer, epoch)
            if datasets is not None:
                datasets.mark(complete, writer, epoch)
                store.refresh_cube(datasets.read(), cube_every)
        finally:
            complete.unpersist()
    finally:
        judged.unpersist()


def run_items_stream(
    spark: SparkSession, landing: str, path: str, checkpoint: str, files_per_trigger: int = 1000,
    datasets: MarkedTable | None = None, store: ItemStore | None = None,
) -> None:
    """Ingest all files that have landed, then stop; a later call continues from there.

    With ``datasets`` their flags follow every micro-batch, and the cube of the items every
    ``CUBE_EVERY``; what is left when all files are in, or was left by a run that failed, it takes in at the end.
    Epochs are counted per checkpoint, which therefore names the writer.
    """
    own = store or item_store(spark, path, with_cube=datasets is not None)
    query = (
        feeds.stream_raw_items(spark, landing, files_per_trigger)
        .writeStream.foreachBatch(lambda batch, epoch: ingest_epoch(batch, epoch, path, checkpoint, datasets, own, CUBE_EVERY))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if datasets is not None:
        own.refresh_cube(datasets.read())
