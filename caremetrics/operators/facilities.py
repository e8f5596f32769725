"""Questions over the hospital directory.

Hospitals without coordinates are left out throughout, as on a map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremetrics.functions.numbers import text_or_na
from caremetrics.sources.literals import literal_rows

# Population by state.
POPULATION = {
    "New South Wales": 7317500,
    "Victoria": 5640900,
    "Queensland": 4599400,
    "Western Australia": 2366900,
    "South Australia": 1659800,
    "Tasmania": 511000,
    "Australian Capital Territory": 366900,
    "Northern Territory": 231200,
}
_PEOPLE = T.StructType(
    [T.StructField("state", T.StringType()), T.StructField("population", T.LongType())]
)


def mapped(hospitals: DataFrame) -> DataFrame:
    return hospitals.na.drop(subset=["latitude", "longitude"])


def points(hospitals: DataFrame) -> DataFrame:
    """Map points."""
    return mapped(hospitals).select(
        "name", F.col("latitude").cast("double"), F.col("longitude").cast("double")
    )


def state_sector(hospitals: DataFrame) -> DataFrame:
    return (
        mapped(hospitals)
        .na.drop(subset=["state", "sector"])
        .groupBy("state", "sector")
        .agg(F.count("*").alias("n"))
    )


def sector_wide(counts: DataFrame) -> DataFrame:
    """Private and public counts per state, 0 where a state has none of one kind."""
    of = lambda sector: F.sum(F.when(F.col("sector") == sector, F.col("n")).otherwise(0))
    return (
        counts.where(F.col("sector").isin("Private", "Public"))
        .groupBy("state")
        .agg(of("Private").alias("n_private"), of("Public").alias("n_public"))
    )


def by_state_status(hospitals: DataFrame, state: str, status: str) -> DataFrame:
    return mapped(hospitals).where((F.col("state") == state) & (F.col("open_closed") == status))


def sector_share(filtered: DataFrame) -> DataFrame:
    """Hospitals per sector, most frequent first."""
    return (
        filtered.where(F.col("sector").isNotNull())
        .groupBy("sector")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "sector")
    )


def density(
    spark: SparkSession,
    hospitals: DataFrame,
    status: str = "Open",
    population: dict[str, int] | None = None,
) -> DataFrame:
    """Hospitals of a status per state and per 1,000 people; ``N/A`` where no population is known."""
    lookup = POPULATION if population is None else population
    people = literal_rows(spark, list(lookup.items()), _PEOPLE)
    counts = (
        mapped(hospitals)
        .where(F.col("state").isNotNull())
        .groupBy("state")
        .agg(F.count_if(F.col("open_closed") == status).alias("n"))
    )
    known = F.col("population").isNotNull()
    rate = F.col("n") / F.col("population") * 1000
    return counts.join(people, "state", "left").select(
        "state",
        "n",
        "population",
        rate.alias("per_1000"),
        text_or_na(known, F.format_number("population", 0)).alias("population_text"),
        text_or_na(known, F.format_string("%.2f", rate)).alias("per_1000_text"),
    )
