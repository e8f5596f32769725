"""Distributions within panels: ranking, histogram, box statistics, heatmap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caremetrics.functions.joins import salted_join, small_side
from caremetrics.functions.numbers import mean_of
from caremetrics.functions.quantiles import exact_percentiles
from caremetrics.operators.measures import PANEL
from caremetrics.session import checkpointed, stored

# Fixed value: number of histogram bins.
BINS = 20


def ranking(cube: DataFrame) -> DataFrame:
    """Mean per hospital and its rank in the panel, highest first.

    A window holds one row per hospital of the panel, after the means are formed.
    """
    means = cube.groupBy(*PANEL, "hospital_name").agg(
        mean_of(F.sum("total"), F.sum("n")).alias("mean_value")
    )
    highest_first = Window.partitionBy(*PANEL).orderBy(F.desc("mean_value"))
    return means.withColumn("rank", F.rank().over(highest_first).cast("long"))


def heatmap(cube: DataFrame) -> DataFrame:
    """Total value per hospital and date."""
    return cube.groupBy(*PANEL, "hospital_name", "reportingstartdate").agg(
        F.sum("total").cast("double").alias("total")
    )


def histogram(panel_rows: DataFrame, bins: int = BINS) -> DataFrame:
    """Equal-width bins between each panel's extremes; the last bin is closed.

    The extremes (a row per panel) are found in a first pass and kept, so that
    the second can bin the rows where they are: what is shuffled is at most
    ``bins`` rows per panel and task. Empty bins are part of the result.
    """
    values = panel_rows.select(*PANEL, "value")
    limits = values.groupBy(*PANEL).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    limits = limits.withColumn("_width", (F.col("_hi") - F.col("_lo")) / bins)
    limits = checkpointed(limits)
    position = F.when(
        F.col("_width") > 0,
        F.least(F.floor((F.col("value") - F.col("_lo")) / F.col("_width")), F.lit(bins - 1)),
    ).otherwise(F.lit(0))
    sided = small_side(limits)
    binned = values.join(sided, PANEL) if sided is not limits else salted_join(values, limits, PANEL, F.col("value"))
    counted = (
        binned
        .groupBy(*PANEL, position.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    every_bin = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every_bin.join(counted, [*PANEL, "bin"], "left").select(
        *PANEL,
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("lo"),
        F.when(F.col("bin") == bins - 1, F.col("_hi"))
        .otherwise(F.col("_lo") + (F.col("bin") + 1) * F.col("_width"))
        .alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box(panel_rows: DataFrame) -> DataFrame:
    """Quartiles, whiskers and number of outliers per hospital.

    Whiskers are the extreme values within 1.5 interquartile ranges of the box.
    The rows are joined once and stored; a hospital of any size is worked on by all
    tasks that read its rows (see ``functions.quantiles``).
    """
    keys = [*PANEL, "hospital_name"]
    values = stored(panel_rows.select(*keys, F.col("value").cast("double").alias("value")), "box")
    quartiles = checkpointed(exact_percentiles(values, keys, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    sided = small_side(quartiles)
    met = values.join(sided, keys) if sided is not quartiles else salted_join(values, quartiles, keys, F.col("value"))
    return (
        met.groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("lo_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("hi_whisker"),
            F.count_if(~inside).alias("outliers"),
        )
    )
