"""Normalising the feeds: dimension/fact split, item keys, batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremetrics.functions.ordering import with_ordinal
from caremetrics.operators.upsert import append_new, store_flags
from caremetrics.session import checkpointed


def split_datasets(catalogue: DataFrame) -> DataFrame:
    """The ``datasets`` rows of a catalogue, none of them stored yet."""
    return catalogue.select(
        F.try_to_date("reportingstartdate", "yyyy-MM-dd").alias("reportingstartdate"),
        "reportedmeasurecode",
        "datasetid",
        "measurecode",
        "datasetname",
        F.lit(False).alias("stored"),
    )


def split_dim(catalogue: DataFrame, code: str, name: str) -> DataFrame:
    """One row per code; where a code comes with several names the first in order stays."""
    return catalogue.where(F.col(code).isNotNull()).groupBy(code).agg(F.min(name).alias(name))


def with_item_id(items: DataFrame) -> DataFrame:
    """Add the item key ``datasetid|unit``; rows lacking either part have no key and are left out."""
    keyed = items.where(F.col("datasetid").isNotNull() & F.col("reportingunitcode").isNotNull())
    return keyed.select(
        "datasetid",
        "reportingunitcode",
        "value",
        "caveats",
        F.concat_ws("|", F.col("datasetid").cast("string"), "reportingunitcode").alias("id"),
    )


def pending(datasets: DataFrame) -> DataFrame:
    """Datasets whose items are still to be fetched."""
    return datasets.where(~F.col("stored")).select("datasetid")


# Fixed value: datasets fetched per batch.
BATCH_SIZE = 20


def batches(ids: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Chunk ids, in order, into batches numbered from 0."""
    numbered = with_ordinal(ids, "datasetid")
    return numbered.select(
        "datasetid", F.floor((F.col("ordinal") - 1) / size).cast("long").alias("batch_id")
    )


def ingest_day(
    spark: SparkSession, directory: DataFrame, catalogue: DataFrame, items_of: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """One daily run over the registered tables; returns the ids it stored.

    Appends unseen hospitals, codes and datasets, asks ``items_of`` for the items of
    the datasets still pending (ids in, items out), appends those, and flags every
    dataset of which an item was written. A second run finds nothing pending but
    what had no items, and appends nothing twice.
    """
    append_new("hospitals", directory)
    append_new("measurements", split_dim(catalogue, "measurecode", "measurename"))
    append_new("reported_measurements", split_dim(catalogue, "reportedmeasurecode", "reportedmeasurename"))
    append_new("datasets", split_datasets(catalogue))
    wanted = checkpointed(pending(spark.table("datasets")))
    append_new("info", with_item_id(items_of(wanted)))
    stored = spark.table("info").join(wanted, "datasetid", "left_semi").select("datasetid").distinct()
    stored = checkpointed(stored)
    store_flags(stored)
    return stored
