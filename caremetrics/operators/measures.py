"""Star-join questions over the reporting tables.

A *panel* is one (measure, reported measure, state). Everything is computed for
all panels at once; a user's selection is a filter on the panel columns.

The value cube below collapses the facts to one row per (measure, reported
measure, unit, date) before the directory is joined, so the national unit, which
owns a row of every dataset, is combined inside the map tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremetrics.functions.joins import small_side
from caremetrics.functions.numbers import mean, mean_of, percent_text, total_of
from caremetrics.operators.facilities import mapped
from caremetrics.schemas import NATIONAL_UNIT
from caremetrics.session import checkpointed
from caremetrics.sources.literals import literal_rows
from caremetrics.sources.standins import CareTables
from caremetrics.sources.tables import fetch

MEASURE = ["measurename", "reportedmeasurename"]
PANEL = [*MEASURE, "state"]
FACT = [*MEASURE, "reportingstartdate", "reportingunitcode", "value"]
PANEL_ROW = [
    "value",
    "reportingstartdate",
    "reportingunitcode",
    "hospital_name",
    "latitude",
    "longitude",
]


def storage_overview(datasets: DataFrame) -> DataFrame:
    """How many datasets there are and what share of them is stored."""
    counts = datasets.agg(F.count("*").alias("total"), F.count_if("stored").alias("stored"))
    share = F.when(F.col("total") > 0, F.col("stored") / F.col("total")).otherwise(F.lit(0.0))
    return counts.select("total", "stored", share.alias("pct"), percent_text(share).alias("pct_text"))


# --- catalogue and option lists ----------------------------------------------


def enrich(datasets: DataFrame, measurements: DataFrame, reported: DataFrame) -> DataFrame:
    """Stored datasets with both measure names, where known."""
    return (
        datasets.where("stored")
        .join(measurements, "measurecode", "left")
        .join(reported, "reportedmeasurecode", "left")
        .select(*datasets.columns, "measurename", "reportedmeasurename")
    )


def _named_codes(tables: CareTables) -> DataFrame:
    """The few distinct code pairs of stored datasets, with their names."""
    codes = tables.datasets.where("stored").select("measurecode", "reportedmeasurecode").distinct()
    return codes.join(tables.measurements, "measurecode", "left").join(
        tables.reported_measurements, "reportedmeasurecode", "left"
    )


def _options(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def measure_options(tables: CareTables) -> DataFrame:
    return _options(_named_codes(tables), "measurename")


def reported_options(tables: CareTables, measure: str) -> DataFrame:
    return _options(_named_codes(tables).where(F.col("measurename") == measure), "reportedmeasurename")


def hospital_states(hospitals: DataFrame) -> DataFrame:
    """States of all hospitals that can be put on the map, open or not."""
    return _options(mapped(hospitals), "state")


def hospital_statuses(hospitals: DataFrame) -> DataFrame:
    return _options(mapped(hospitals), "open_closed")


def open_states(hospitals: DataFrame) -> DataFrame:
    return _options(hospitals.where(F.col("open_closed") == "Open"), "state")


# --- facts and panels ----------------------------------------------------------


def _items(tables: CareTables) -> DataFrame:
    # A NaN counts as a missing value.
    value = F.when(~F.isnan("value"), F.col("value")).alias("value")
    return tables.info.select("datasetid", "reportingunitcode", value)


def stored_facts(tables: CareTables) -> DataFrame:
    """Items of all stored datasets with measure names and reporting date.

    Datasets are named first, so that the facts are joined once.
    """
    named = (
        tables.datasets.where("stored")
        .select("datasetid", "reportingstartdate", "measurecode", "reportedmeasurecode")
        .join(tables.measurements, "measurecode")
        .join(tables.reported_measurements, "reportedmeasurecode")
    )
    return _items(tables).join(named, "datasetid").select(*FACT)


def chosen_facts(tables: CareTables, measures: DataFrame) -> DataFrame:
    """As ``stored_facts``, for the wanted measures only.

    ``measures`` has a measure name and perhaps a reported measure name per row.
    The matching datasets are found first. If they are few, they are broadcast
    and the fact table is filtered where it is read; otherwise both are shuffled.
    """
    chosen = (
        enrich(tables.datasets, tables.measurements, tables.reported_measurements)
        .join(measures.distinct(), measures.columns, "left_semi")
        .where(F.col("reportedmeasurename").isNotNull())
        .select("datasetid", "reportingstartdate", *MEASURE)
    )
    return _items(tables).join(small_side(checkpointed(chosen)), "datasetid").select(*FACT)


def _directory(tables: CareTables) -> DataFrame:
    return tables.hospitals.select(
        F.col("code").alias("reportingunitcode"),
        F.col("name").alias("hospital_name"),
        "state",
        "latitude",
        "longitude",
    )


def _mapped(directory: DataFrame) -> DataFrame:
    """Hospitals that a panel keeps: a panel row with any null is dropped."""
    return directory.na.drop(subset=["hospital_name", "latitude", "longitude", "state"])


def panels(tables: CareTables) -> DataFrame:
    """Complete rows of all panels."""
    facts = stored_facts(tables).na.drop("any")
    return facts.join(_mapped(_directory(tables)), "reportingunitcode").select(*PANEL, *PANEL_ROW)


_PANEL_TEXT = """
SELECT f.value, f.reportingstartdate, f.reportingunitcode, h.hospital_name, h.latitude, h.longitude
FROM {facts} f JOIN {directory} h USING (reportingunitcode)
"""
_MEASURE_TEXT = "SELECT :measure AS measurename, :reported AS reportedmeasurename"
_STATE_TEXT = "SELECT * FROM {directory} WHERE state = :state"


def panel(spark: SparkSession, tables: CareTables, measure: str, reported: str, state: str) -> DataFrame:
    """One panel by name, as parameterised SQL, oldest first."""
    wanted = fetch(spark, _MEASURE_TEXT, {"measure": measure, "reported": reported})
    here = fetch(spark, _STATE_TEXT, {"state": state}, directory=_mapped(_directory(tables)))
    facts = chosen_facts(tables, wanted)
    rows = fetch(spark, _PANEL_TEXT, facts=facts, directory=here)
    return rows.na.drop("any").orderBy("reportingstartdate")


def panel_or_national(tables: CareTables, requested: DataFrame) -> DataFrame:
    """Rows of each requested panel, or the national rows where a panel has none.

    Whether a panel has rows is decided before incomplete rows are dropped.
    National rows need only a value: the national unit has no coordinates.
    ``requested`` is the caller's list of panels, one row each.
    """
    wanted = requested.select(*PANEL).distinct()
    facts = chosen_facts(tables, wanted.select(*MEASURE))
    rows = facts.join(_directory(tables), "reportingunitcode").join(wanted, PANEL)
    missing = wanted.join(rows.select(*PANEL).distinct(), PANEL, "left_anti")
    # `code` is a key, so the national entry of the directory is at most one row.
    national_entry = (
        _directory(tables).where(F.col("reportingunitcode") == NATIONAL_UNIT).drop("state")
    )
    national = (
        facts.where((F.col("reportingunitcode") == NATIONAL_UNIT) & F.col("value").isNotNull())
        .join(missing, MEASURE)
        .join(F.broadcast(national_entry), "reportingunitcode", "left")
    )
    columns = [*PANEL, *PANEL_ROW]
    return (
        rows.na.drop(subset=PANEL_ROW)
        .select(*columns, F.lit(False).alias("is_national"))
        .unionByName(national.select(*columns, F.lit(True).alias("is_national")))
    )


# --- series ---------------------------------------------------------------------


def value_cube(facts: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Total and count per (measure, reported measure, unit, date)."""
    return facts.groupBy(*MEASURE, "reportingunitcode", "reportingstartdate").agg(
        total_of("value", exact_scale).alias("total"), F.count("value").alias("n")
    )


def panel_cube(tables: CareTables, facts: DataFrame | None = None, exact_scale: int | None = None) -> DataFrame:
    """The value cube of mapped hospitals, with panel columns and hospital name."""
    facts = stored_facts(tables) if facts is None else facts
    cube = value_cube(facts.na.drop("any"), exact_scale)
    return cube.join(_mapped(_directory(tables)), "reportingunitcode").select(
        *PANEL, "hospital_name", "reportingstartdate", "total", "n"
    )


def kept_panel_cube(tables: CareTables, cube: DataFrame) -> DataFrame:
    """As ``panel_cube``, from a kept cube (by codes) instead of the facts."""
    return (
        cube.where("n > 0 AND reportingstartdate IS NOT NULL")
        .join(tables.measurements, "measurecode")
        .join(tables.reported_measurements, "reportedmeasurecode")
        .na.drop(subset=MEASURE)
        .join(_mapped(_directory(tables)), "reportingunitcode")
        .select(*PANEL, "hospital_name", "reportingstartdate", "total", "n")
    )


def series(cube: DataFrame) -> DataFrame:
    """Mean value per panel and reporting date."""
    value = mean_of(F.sum("total"), F.sum("n"))
    return cube.groupBy(*PANEL, "reportingstartdate").agg(value.alias("mean_value"))


def national_series(tables: CareTables, exact_scale: int | None = None) -> DataFrame:
    """National mean per measure, reported measure and date."""
    national = stored_facts(tables).where(F.col("reportingunitcode") == NATIONAL_UNIT)
    return national.groupBy(*MEASURE, "reportingstartdate").agg(
        mean("value", exact_scale).alias("national_mean")
    )


def with_national(panel_series: DataFrame, national: DataFrame) -> DataFrame:
    """Each state series next to the national one."""
    return panel_series.join(national, [*MEASURE, "reportingstartdate"], "left").select(
        *PANEL, "reportingstartdate", "mean_value", "national_mean"
    )


def pair(tables: CareTables, measure: str, other: str, exact_scale: int | None = None) -> DataFrame:
    """Two measures side by side by date, for every reported measure and state.

    The second measure is averaged over all its reported measures and over
    hospitals without coordinates too; only dates that both series have remain.
    """
    names = literal_rows(tables.info.sparkSession, [(measure,), (other,)], _NAMES)
    facts = chosen_facts(tables, names)
    first = series(panel_cube(tables, facts.where(F.col("measurename") == measure), exact_scale)).select(
        "reportedmeasurename", "state", "reportingstartdate", F.col("mean_value").alias("value_a")
    )
    second = (
        value_cube(facts.where(F.col("measurename") == other), exact_scale)
        .join(_directory(tables).select("reportingunitcode", "state"), "reportingunitcode")
        .groupBy("state", "reportingstartdate")
        .agg(mean_of(F.sum("total"), F.sum("n")).alias("value_b"))
    )
    return first.join(second, ["state", "reportingstartdate"]).select(
        "state", "reportedmeasurename", "reportingstartdate", "value_a", "value_b"
    )


_NAMES = T.StructType([T.StructField("measurename", T.StringType())])
