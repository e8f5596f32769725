"""Panels, fallback, series and distributions on small literal tables."""

import math

import pytest
from pyspark.sql import functions as F

from caremetrics.operators import distributions, facilities, measures
from caremetrics.sources import standins
from caremetrics.sources.standins import CareTables
from tests.conftest import SF, day, executed_plan, rows

JAN, FEB = day("2020-01-01"), day("2020-02-01")


def _tables(spark, info, hospitals, datasets=None):
    datasets = datasets or [
        (JAN, "R", 1, "M", "one", True),
        (FEB, "R", 2, "M", "two", True),
        (FEB, "R", 3, "M", "three", False),
        (FEB, "X", 4, "M", "four", True),
    ]
    return CareTables(
        spark.createDataFrame(
            datasets,
            "reportingstartdate date, reportedmeasurecode string, datasetid long, "
            "measurecode string, datasetname string, stored boolean",
        ),
        spark.createDataFrame(
            hospitals,
            "code string, name string, type string, latitude double, longitude double, "
            "sector string, open_closed string, state string, lhn string, phn string",
        ),
        spark.createDataFrame([("M", "Stay"), ("N", "Wait")], "measurecode string, measurename string"),
        spark.createDataFrame([("R", "Days")], "reportedmeasurecode string, reportedmeasurename string"),
        spark.createDataFrame(
            [(*row, None, f"{row[0]}|{row[1]}") for row in info],
            "datasetid long, reportingunitcode string, value double, caveats string, id string",
        ),
    )


def _hospital(code, state, lat=1.0, sector="Public", status="Open"):
    return (code, f"Hospital {code}", "Hospital", lat, 2.0, sector, status, state, None, None)


INFO = [
    (1, "a", 10.0),
    (1, "b", 20.0),
    (1, "c", 90.0),
    (1, "NAT", 5.0),
    (2, "a", None),
    (2, "b", float("nan")),
    (2, "NAT", 7.0),
    (3, "a", 1000.0),
    (4, "a", 1000.0),
]
HOSPITALS = [_hospital("a", "NSW"), _hospital("b", "NSW"), _hospital("c", "NSW", lat=None)]


@pytest.fixture(scope="module")
def tables(spark):
    return _tables(spark, INFO, HOSPITALS)


def test_panel_leaves_out_incomplete_unstored_and_unnamed_rows(spark, tables):
    got = measures.panel(spark, tables, "Stay", "Days", "NSW")
    assert got.columns == measures.PANEL_ROW
    assert rows(got.select("reportingunitcode", "value")) == [("a", 10.0), ("b", 20.0)]
    assert rows(measures.panels(tables).select(*measures.PANEL_ROW)) == rows(got)


def test_names_are_matched_as_values(spark, tables):
    assert measures.panel(spark, tables, "Stay' OR '1'='1", "Days", "NSW").count() == 0


def test_series_and_national(tables):
    series = measures.series(measures.panel_cube(tables))
    assert rows(series) == [("Stay", "Days", "NSW", JAN, 15.0)]
    national = measures.national_series(tables)
    assert rows(national) == [("Stay", "Days", JAN, 5.0), ("Stay", "Days", FEB, 7.0)]
    assert rows(measures.with_national(series, national)) == [("Stay", "Days", "NSW", JAN, 15.0, 5.0)]


def _requested(spark, *states):
    return spark.createDataFrame(
        [("Stay", "Days", s) for s in states],
        "measurename string, reportedmeasurename string, state string",
    )


def test_fallback_needs_no_directory_entry(spark, tables):
    got = measures.panel_or_national(tables, _requested(spark, "NSW", "VIC", "VIC"))
    picked = rows(got.select("state", "reportingunitcode", "value", "hospital_name", "is_national"))
    assert picked == [
        ("NSW", "a", 10.0, "Hospital a", False),
        ("NSW", "b", 20.0, "Hospital b", False),
        ("VIC", "NAT", 5.0, None, True),
        ("VIC", "NAT", 7.0, None, True),
    ]


def test_no_fallback_for_a_panel_with_only_incomplete_rows(spark):
    tables = _tables(spark, [(2, "a", None), (2, "NAT", 7.0)], HOSPITALS)
    assert measures.panel_or_national(tables, _requested(spark, "NSW")).count() == 0


def test_national_entry_of_the_directory_is_used(spark):
    tables = _tables(spark, INFO, [*HOSPITALS, _hospital("NAT", "All")])
    got = measures.panel_or_national(tables, _requested(spark, "VIC"))
    assert {r["hospital_name"] for r in got.collect()} == {"Hospital NAT"}


def test_pair_keeps_common_dates_and_unmapped_hospitals_of_the_second(spark):
    datasets = [
        (JAN, "R", 1, "M", "one", True),
        (JAN, "R", 2, "N", "two", True),
        (FEB, "R", 3, "N", "three", True),
    ]
    info = [(1, "a", 10.0), (2, "a", 1.0), (2, "c", 3.0), (3, "a", 9.0)]
    tables = _tables(spark, info, HOSPITALS, datasets)
    assert rows(measures.pair(tables, "Stay", "Wait")) == [("NSW", "Days", JAN, 10.0, 2.0)]


def test_overview_of_nothing(tables):
    empty = tables.datasets.where(F.lit(False))
    assert rows(measures.storage_overview(empty)) == [(0, 0, 0.0, "0.00%")]
    assert rows(measures.storage_overview(tables.datasets)) == [(4, 3, 0.75, "75.00%")]


def test_enriched_keeps_unknown_codes_and_options_drop_them(tables):
    got = measures.enrich(tables.datasets, tables.measurements, tables.reported_measurements)
    assert rows(got.select("datasetid", "reportedmeasurename")) == [(1, "Days"), (2, "Days"), (4, None)]
    assert rows(measures.measure_options(tables)) == [("Stay",)]
    assert rows(measures.reported_options(tables, "Stay")) == [("Days",)]


def _panel_rows(spark, values, name="H"):
    return spark.createDataFrame(
        [("Stay", "Days", "NSW", float(v), name) for v in values],
        "measurename string, reportedmeasurename string, state string, value double, hospital_name string",
    )


def test_histogram_has_every_bin_and_a_closed_last_one(spark):
    got = distributions.histogram(_panel_rows(spark, [0, 0.5, 5, 20, 20])).orderBy("bin").collect()
    assert [r["bin"] for r in got] == list(range(20))
    counts = {r["bin"]: r["n"] for r in got if r["n"]}
    assert counts == {0: 2, 5: 1, 19: 2}
    assert got[-1]["hi"] == 20.0


def test_histogram_of_one_value(spark):
    got = distributions.histogram(_panel_rows(spark, [3, 3])).where("n > 0").collect()
    assert [(r["bin"], r["n"]) for r in got] == [(0, 2)]


def test_box_counts_outliers_beyond_the_whiskers(spark):
    values = [1, 2, 3, 4, 5, 6, 7, 8, 100, 100, -90]
    got = distributions.box(_panel_rows(spark, values)).first()
    assert (got["q1"], got["median"], got["q3"]) == (2.5, 5.0, 7.5)
    assert (got["lo_whisker"], got["hi_whisker"], got["outliers"]) == (1.0, 8.0, 3)


def test_facilities(spark):
    hospitals = _tables(
        spark,
        INFO,
        [
            _hospital("a", "NSW"),
            _hospital("b", "NSW", sector="Private", status="Closed"),
            _hospital("c", "NSW", lat=None),
            _hospital("d", "VIC"),
            _hospital("e", "NT", sector="Other"),
        ],
    ).hospitals
    assert rows(facilities.points(hospitals).select("name")) == [(f"Hospital {c}",) for c in "abde"]
    counts = facilities.state_sector(hospitals)
    assert rows(facilities.sector_wide(counts)) == [("NSW", 1, 1), ("VIC", 0, 1)]
    open_nsw = facilities.by_state_status(hospitals, "NSW", "Open")
    assert rows(facilities.sector_share(open_nsw)) == [("Public", 1)]
    density = facilities.density(spark, hospitals, population={"NSW": 4_000, "VIC": 1_234_567})
    assert rows(density.select("state", "n", "population_text", "per_1000_text")) == [
        ("NSW", 1, "4,000", "0.25"),
        ("NT", 1, "N/A", "N/A"),
        ("VIC", 1, "1,234,567", "0.00"),
    ]


def test_facts_are_merged_before_the_directory_is_joined(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = executed_plan(measures.panel_cube(standins.tables(spark, SF)))
    merge = plan.index("partial_sum(")
    assert plan.index("SortMergeJoin [reportingunitcode") < merge  # printed parent first


def test_hot_unit_is_split_at_runtime(spark, with_conf):
    with_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    info = [(1, "a" if i % 3 == 0 else f"u{i % 997}", float(i)) for i in range(60_000)]
    tables = _tables(spark, info, [_hospital("a", "NSW"), *[_hospital(f"u{i}", "VIC") for i in range(997)]])
    plan = executed_plan(measures.panels(tables))
    assert "skew=true" in plan
    assert measures.panels(tables).count() == len(info)


def test_nan_never_reaches_a_mean(spark, tables):
    means = [r["national_mean"] for r in measures.national_series(tables).collect()]
    assert not any(math.isnan(m) for m in means)
