"""Every named query over the given tables: key -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremetrics.operators import (
    distributions,
    facilities,
    ingest,
    measures,
    models,
    penalty,
    sheets,
    timeseries,
    upsert,
)
from caremetrics.operators.item_store import ItemStore
from caremetrics.schemas import create_tables
from caremetrics.session import stored as stored_rows
from caremetrics.session import work_dir
from caremetrics.sources import feeds, standins
from caremetrics.sources.literals import literal_rows
from caremetrics.streaming import items as stream

Query = Callable[[SparkSession, str], DataFrame]

# Selections used by the queries that answer one choice of a user.
MEASURE, OTHER_MEASURE, REPORTED, STATE = "URGENT", "HIGH", "Final", "ASIA"
REQUESTED = [
    ("URGENT", "Final", "ASIA"),
    ("URGENT", "Final", "EXTERNAL TERRITORY"),
    ("LOW", "Open", "EUROPE"),
    ("LOW", "Open", "EXTERNAL TERRITORY"),
]
# Made-up region populations; MIDDLE EAST has none on purpose.
REGION_POPULATION = {"AFRICA": 1200000, "AMERICA": 3400000, "ASIA": 5600000, "EUROPE": 780000}
# Prices of the given tables have two decimals, so their sums can be exact.
CENTS = 2
UNITS = ["AFRICA", "AMERICA", "ASIA", "MIDDLE EAST", "NAT"]
FEATURES = ["l_quantity", "l_discount", "l_tax"]
TARGETS = ["l_extendedprice", "net_price"]
LINE_KEY = ["l_orderkey", "l_linenumber"]

_REGISTRY: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _catalogue(spark, sf_dir):
    return feeds.lower_names(standins.catalogue_file(spark, sf_dir))


def _lineitem(spark, sf_dir):
    return standins.given(spark, sf_dir, "lineitem")


# --- feeds and ingestion ---------------------------------------------------------


@_query
def scan_catalogue(spark, sf_dir):
    landing = work_dir(spark, "catalogue")
    feeds.publish(standins.catalogue_file(spark, sf_dir), landing)
    return feeds.read_catalogue(spark, landing)


@_query
def scan_items(spark, sf_dir):
    landing = work_dir(spark, "items")
    feeds.publish(standins.items_file(spark, sf_dir), landing)
    return feeds.read_items(spark, landing)


@_query
def scan_hospitals(spark, sf_dir):
    return feeds.read_hospitals(standins.directory_cells(spark, sf_dir))


@_query
def item_ids(spark, sf_dir):
    return ingest.with_item_id(standins.info(spark, sf_dir).drop("id"))


@_query
def catalogue_datasets(spark, sf_dir):
    return ingest.split_datasets(_catalogue(spark, sf_dir))


@_query
def dim_measures(spark, sf_dir):
    return ingest.split_dim(_catalogue(spark, sf_dir), "measurecode", "measurename")


@_query
def dim_reported_measures(spark, sf_dir):
    return ingest.split_dim(_catalogue(spark, sf_dir), "reportedmeasurecode", "reportedmeasurename")


@_query
def upsert_new_rows(spark, sf_dir):
    t = standins.tables(spark, sf_dir)
    stored = t.datasets.where("stored").select("datasetid")
    existing = t.info.join(stored, "datasetid", "left_semi")
    return upsert.new_rows(t.info, existing, "id")


@_query
def mark_stored(spark, sf_dir):
    t = standins.tables(spark, sf_dir)
    return upsert.mark_stored(t.datasets, t.info.select("datasetid"))


@_query
def pending_datasets(spark, sf_dir):
    return ingest.pending(standins.datasets(spark, sf_dir))


@_query
def dataset_batches(spark, sf_dir):
    return ingest.batches(ingest.pending(standins.datasets(spark, sf_dir)))


def _streamed(spark, sf_dir):
    """Feed all items as files, the first delivery twice, and ingest them."""
    base = work_dir(spark, "stream")
    parts = standins.items_file(spark, sf_dir)
    feeds.publish(parts, f"{base}/landing")
    feeds.publish(parts.where(F.col("ReportingUnitCode") == "NAT"), f"{base}/landing")
    stream.run_items_stream(spark, f"{base}/landing", f"{base}/table", f"{base}/checkpoint", 12)
    return f"{base}/table"


def _own_tables(spark, sf_dir):
    """A database of its own for one run of a query, in the shared working folder."""
    name = f"care_{uuid.uuid4().hex}"
    before = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_dir(spark, 'tables')}'")
    spark.catalog.setCurrentDatabase(name)
    create_tables(spark, buckets=8)
    return name, before


@_query
def append_twice(spark, sf_dir):
    """The items, appended in two overlapping deliveries and read back."""
    name, before = _own_tables(spark, sf_dir)
    try:
        items = standins.info(spark, sf_dir)
        upsert.append_new("info", items.where("datasetid % 3 > 0"))
        upsert.append_new("info", items)
        return spark.table(f"{name}.info")
    finally:
        spark.catalog.setCurrentDatabase(before)


def _daily(spark, sf_dir):
    name, before = _own_tables(spark, sf_dir)
    try:
        items = standins.info(spark, sf_dir).drop("id")
        items_of = lambda ids: items.join(ids, "datasetid", "left_semi")
        directory = feeds.read_hospitals(standins.directory_cells(spark, sf_dir))
        for _ in range(2):
            ingest.ingest_day(spark, directory, _catalogue(spark, sf_dir), items_of)
        return name
    finally:
        spark.catalog.setCurrentDatabase(before)


@_query
def daily_ingest(spark, sf_dir):
    """The datasets with their flags after two daily runs over the same feeds."""
    return spark.table(f"{_daily(spark, sf_dir)}.datasets")


@_query
def stream_items_upsert(spark, sf_dir):
    return stream.read_items_table(spark, _streamed(spark, sf_dir))


@_query
def stream_mark_stored(spark, sf_dir):
    ids = stream.read_stored_ids(spark, _streamed(spark, sf_dir))
    return upsert.mark_stored(standins.datasets(spark, sf_dir), ids).select("datasetid", "stored")


def _broken_stream(spark, sf_dir):
    """A stream over good files, broken ones, and files without a header; returns its folder and the datasets it flags.

    Of every seventh dataset the national record has a text for a value; the same
    datasets are delivered once more with ids that are no numbers, and once without header.
    """
    base = work_dir(spark, "broken-stream")
    seventh = F.col("DataSetId") % 7 == 0
    national = F.col("ReportingUnitCode") == "NAT"
    items = standins.items_file(spark, sf_dir)
    feeds.publish(items.where(~seventh), f"{base}/landing")
    empty, text = F.lit(None).cast("string"), F.when(national, "n/a")
    broken = items.where(seventh).withColumns({"Value": text, "Caveats": empty})
    feeds.publish(broken.repartition("DataSetId"), f"{base}/landing")
    broken = broken.where(national)
    feeds.publish(broken.withColumns({"DataSetId": F.concat(F.lit("D"), "DataSetId"), "Value": empty}), f"{base}/landing")
    broken.withColumn("Value", F.lit("1")).write.mode("append").option("header", "false").csv(f"{base}/landing")
    flags = stream.datasets_table(spark, f"{base}/datasets", 16)
    upsert.add_datasets(flags, standins.datasets(spark, sf_dir))
    stream.run_items_stream(spark, f"{base}/landing", f"{base}/table", f"{base}/checkpoint", 12, flags)
    return f"{base}/table", flags


@_query
def rejected_items(spark, sf_dir):
    """Records put aside by the stream, with the reason."""
    return stream.read_rejected(spark, _broken_stream(spark, sf_dir)[0]).select("reason", "record")


@_query
def pending_after_rejects(spark, sf_dir):
    """Flags kept by the stream itself: datasets with a rejected record stay as they were."""
    return _broken_stream(spark, sf_dir)[1].read().select("datasetid", "stored")


def _kept_store(spark, sf_dir):
    """Items of stored datasets and their cube after three overlapping deliveries."""
    store = ItemStore(spark, work_dir(spark, "kept"), cube_buckets=16, exact_scale=CENTS)
    items = stored_rows(standins.info(spark, sf_dir).drop("id"))  # delivered three times
    stored = standins.datasets(spark, sf_dir).where("stored")
    for number, part in enumerate(("datasetid % 3 > 0", "datasetid % 5 > 0", "true")):
        store.add(items.where(part), number)
        store.refresh_cube(stored)
    return store


@_query
def cube_after_appends(spark, sf_dir):
    cube = _kept_store(spark, sf_dir).cube.read()
    return cube.withColumn("total", F.col("total").cast("double"))


@_query
def series_from_cube(spark, sf_dir):
    """As ``measure_series``, without a scan of the facts."""
    kept = _kept_store(spark, sf_dir).cube.read()
    return measures.series(measures.kept_panel_cube(standins.tables(spark, sf_dir), kept))


@_query
def ranking_from_cube(spark, sf_dir):
    """As ``hospital_ranking``, without a scan of the facts."""
    kept = _kept_store(spark, sf_dir).cube.read()
    return distributions.ranking(measures.kept_panel_cube(standins.tables(spark, sf_dir), kept))


# --- measures --------------------------------------------------------------------


@_query
def storage_overview(spark, sf_dir):
    return measures.storage_overview(standins.datasets(spark, sf_dir))


@_query
def catalogue_enriched(spark, sf_dir):
    t = standins.tables(spark, sf_dir)
    return measures.enrich(t.datasets, t.measurements, t.reported_measurements)


@_query
def measure_options(spark, sf_dir):
    return measures.measure_options(standins.tables(spark, sf_dir))


@_query
def reported_measure_options(spark, sf_dir):
    return measures.reported_options(standins.tables(spark, sf_dir), MEASURE)


@_query
def open_states(spark, sf_dir):
    return measures.open_states(standins.hospitals(spark, sf_dir))


@_query
def hospital_states(spark, sf_dir):
    return measures.hospital_states(standins.hospitals(spark, sf_dir))


@_query
def hospital_statuses(spark, sf_dir):
    return measures.hospital_statuses(standins.hospitals(spark, sf_dir))


@_query
def measure_panel(spark, sf_dir):
    return measures.panel(spark, standins.tables(spark, sf_dir), MEASURE, REPORTED, STATE)


@_query
def panel_with_fallback(spark, sf_dir):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in measures.PANEL])
    requested = literal_rows(spark, REQUESTED, schema)
    return measures.panel_or_national(standins.tables(spark, sf_dir), requested)


@_query
def measure_series(spark, sf_dir):
    return measures.series(measures.panel_cube(standins.tables(spark, sf_dir), exact_scale=CENTS))


@_query
def national_average(spark, sf_dir):
    return measures.national_series(standins.tables(spark, sf_dir), CENTS)


@_query
def series_vs_national(spark, sf_dir):
    t = standins.tables(spark, sf_dir)
    return measures.with_national(
        measures.series(measures.panel_cube(t, exact_scale=CENTS)), measures.national_series(t, CENTS)
    )


@_query
def measure_pair(spark, sf_dir):
    return measures.pair(standins.tables(spark, sf_dir), MEASURE, OTHER_MEASURE, CENTS)


# --- distributions -----------------------------------------------------------------


@_query
def hospital_ranking(spark, sf_dir):
    return distributions.ranking(measures.panel_cube(standins.tables(spark, sf_dir), exact_scale=CENTS))


@_query
def value_histogram(spark, sf_dir):
    return distributions.histogram(measures.panels(standins.tables(spark, sf_dir)))


@_query
def box_stats(spark, sf_dir):
    stats = distributions.box(measures.panels(standins.tables(spark, sf_dir)))
    return stats.withColumns({q: F.round(q, 6) for q in ("q1", "median", "q3")})


@_query
def hospital_date_heatmap(spark, sf_dir):
    return distributions.heatmap(measures.panel_cube(standins.tables(spark, sf_dir), exact_scale=CENTS))


# --- facilities ----------------------------------------------------------------------


@_query
def hospital_points(spark, sf_dir):
    return facilities.points(standins.hospitals(spark, sf_dir))


@_query
def state_sector_counts(spark, sf_dir):
    return facilities.state_sector(standins.hospitals(spark, sf_dir))


@_query
def sector_by_state(spark, sf_dir):
    return facilities.sector_wide(facilities.state_sector(standins.hospitals(spark, sf_dir)))


@_query
def hospitals_by_state_status(spark, sf_dir):
    return facilities.by_state_status(standins.hospitals(spark, sf_dir), STATE, "Open")


@_query
def sector_share(spark, sf_dir):
    return facilities.sector_share(
        facilities.by_state_status(standins.hospitals(spark, sf_dir), STATE, "Open")
    )


@_query
def hospital_density(spark, sf_dir):
    return facilities.density(
        spark, standins.hospitals(spark, sf_dir), population=REGION_POPULATION
    )


# --- sheets ------------------------------------------------------------------------------


@_query
def sheet_tidy(spark, sf_dir):
    return sheets.tidy_sheet(standins.expenditure_cells(spark, sf_dir), sheets.BY_STATE)


@_query
def length_of_stay_long(spark, sf_dir):
    return sheets.length_of_stay(standins.stay_cells(spark, sf_dir))


@_query
def spend_prices(spark, sf_dir):
    return sheets.spend_prices(standins.expenditure_cells(spark, sf_dir))


@_query
def spend_prices_long(spark, sf_dir):
    return sheets.spend_prices_long(spend_prices(spark, sf_dir))


@_query
def spend_by_state(spark, sf_dir):
    return sheets.spend_by_state(standins.expenditure_cells(spark, sf_dir))


@_query
def gdp_ratio(spark, sf_dir):
    return sheets.gdp_ratio(standins.expenditure_cells(spark, sf_dir))


@_query
def budget_table(spark, sf_dir):
    return sheets.budget_table(standins.expenditure_cells(spark, sf_dir))


# --- time series -------------------------------------------------------------------------


def _comparable(df, *columns):
    """Seven significant digits, whatever the size of the value."""
    return df.withColumns({c: F.format_string("%.6e", c).cast("double") for c in columns})


def _rounded(df, noise, *columns):
    """Four places. The noise of a sum is rounded off first, so that it decides no tie."""
    return df.withColumns({c: F.floor(F.round(c, noise) * 10000 + 0.5) / 10000 for c in columns})


@_query
def seasonal_decompose(spark, sf_dir):
    parts = timeseries.decompose(measure_series(spark, sf_dir), measures.PANEL)
    return _rounded(parts, 9, "trend", "seasonal", "resid")


@_query
def holt_forecast(spark, sf_dir):
    forecast = timeseries.holt(measure_series(spark, sf_dir), measures.PANEL)
    return _rounded(forecast, 8, "forecast")


@_query
def holt_refined(spark, sf_dir):
    series = measure_series(spark, sf_dir)
    return timeseries.holt(series, measures.PANEL, rounds=timeseries.ROUNDS)


# --- models --------------------------------------------------------------------------------


def _budget_training(spark, sf_dir):
    return models.budget_population(
        sheets.budget_wide(standins.expenditure_cells(spark, sf_dir)),
        sheets.population(standins.population_cells(spark, sf_dir)),
    )


@_query
def population_shares(spark, sf_dir):
    return models.state_population(sheets.population(standins.population_cells(spark, sf_dir)))


@_query
def budget_population(spark, sf_dir):
    return _budget_training(spark, sf_dir)


@_query
def budget_regression(spark, sf_dir):
    line = models.budget_line(spark, models.fit_budget(_budget_training(spark, sf_dir)))
    return line.select(F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


@_query
def predict_scenarios(spark, sf_dir):
    model = models.fit_budget(_budget_training(spark, sf_dir))
    future = sheets.projections(standins.population_cells(spark, sf_dir))
    scored = models.score_scenarios(model, future)
    return scored.withColumn("prediction", F.round("prediction", 2))


@_query
def wide_targets(spark, sf_dir):
    return models.wide_targets(standins.info_states(spark, sf_dir), UNITS)


@_query
def lm_design(spark, sf_dir):
    budget = sheets.budget_wide(standins.expenditure_cells(spark, sf_dir))
    return models.lm_design(budget, wide_targets(spark, sf_dir))


@_query
def train_test_split(spark, sf_dir):
    ids = standins.datasets(spark, sf_dir).select("datasetid")
    return models.split(ids, ["datasetid"])


@_query
def standardize(spark, sf_dir):
    lines = _lineitem(spark, sf_dir).select(*LINE_KEY, *FEATURES)
    scaled = models.standardize(lines, FEATURES)
    return scaled.select(*LINE_KEY, *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in FEATURES])


def _split_lines(spark, sf_dir):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = _lineitem(spark, sf_dir).select(
        *LINE_KEY, *FEATURES, "l_extendedprice", net.alias("net_price")
    )
    return models.split(lines, LINE_KEY)


def _training_lines(spark, sf_dir):
    return _split_lines(spark, sf_dir).where("is_train")


@_query
def lm_multi(spark, sf_dir):
    fitted = models.fit_targets(_training_lines(spark, sf_dir), TARGETS, FEATURES)
    return _comparable(fitted, "coefficient")


@_query
def lm_elastic_net(spark, sf_dir):
    scaled = models.standardize(_training_lines(spark, sf_dir), FEATURES)
    names = [f"{c}_scaled" for c in FEATURES]
    fitted = models.fit_targets(scaled, TARGETS, names, 0.1, models.ELASTIC_NET)
    return _comparable(fitted, "coefficient")


# Two of the eight features of the design: with a dozen rows, all eight would fit the noise.
DESIGN_FEATURES = ["x_NAT", "x_NSW"]


@_query
def lm_targets(spark, sf_dir):
    return _comparable(models.fit_long(lm_design(spark, sf_dir), DESIGN_FEATURES), "coefficient")


@_query
def lm_targets_chosen(spark, sf_dir):
    """All eight features of the design, held in check by a penalty chosen by cross-validation."""
    design = lm_design(spark, sf_dir)
    features = [c for c in design.columns if c.startswith("x_")]
    fitted = penalty.fit_chosen(design, features, ["year"])
    return _comparable(fitted, "strength", "cv_error", "coefficient")


@_query
def lm_penalty_choice(spark, sf_dir):
    """The chosen strength per target of the line items, and its error on rows left out."""
    lines = models.long_targets(_training_lines(spark, sf_dir), TARGETS, FEATURES, *LINE_KEY)
    chosen = penalty.fit_chosen(lines, FEATURES, LINE_KEY).where("feature = '(intercept)'")
    return _comparable(chosen.select("target", "n", "strength", "cv_error"), "strength", "cv_error")


@_query
def heldout_error(spark, sf_dir):
    fitted = models.fit_targets(_training_lines(spark, sf_dir), TARGETS, FEATURES)
    heldout = models.long_targets(_split_lines(spark, sf_dir).where("NOT is_train"), TARGETS, FEATURES)
    return _comparable(models.heldout_error(fitted, heldout, FEATURES), "rmse", "mae", "r2")
