"""Exact percentiles by narrowing brackets, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from caremetrics.functions import quantiles
from caremetrics.functions.quantiles import exact_percentiles
from tests.test_item_store import _shuffled

FRACTIONS = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q3": 0.75, "high": 1.0}


def _expected(groups):
    return {k: {n: np.percentile(v, 100 * f) for n, f in FRACTIONS.items()} for k, v in groups.items()}


@pytest.mark.parametrize("small_rows", [quantiles.SMALL_ROWS, 50])
def test_percentiles_of_groups_of_all_kinds(spark, small_rows):
    rng = np.random.default_rng(11)
    groups = {
        "one": [3.5],
        "two": [1.0, 2.0],
        "same": [7.0] * 400,
        "copies": [1.0] * 700 + list(range(2, 100)) + [50.0] * 900,
        "normal": list(rng.normal(0, 1e6, 3000)),
        "skewed": list(np.exp(rng.normal(0, 5, 2000))),
        "ends": [-1.0] * 500 + [1.0] * 500,
        "negative": list(-rng.integers(0, 9, 800).astype(float)),
    }
    data = [(k, float(v)) for k, values in groups.items() for v in values] + [("one", None), ("two", float("nan")), ("none", None)]
    df = spark.createDataFrame(data, "k string, v double").repartition(7)
    got = {r["k"]: r for r in exact_percentiles(df, ["k"], "v", FRACTIONS, small_rows).collect()}
    expected = _expected(groups)
    assert set(got) - {"none"} == set(groups)
    for k, wanted in expected.items():
        for n in FRACTIONS:
            assert got[k][n] == pytest.approx(wanted[n], rel=1e-12, abs=1e-12), (k, n)


def test_a_hot_group_is_narrowed_where_it_lies(spark, with_conf, monkeypatch):
    """Nine tenths of the rows are one group: of 300 tasks that read them each does its share, and few rows move."""
    with_conf(spark__sql__adaptive__enabled="false")
    seen = []
    plain = quantiles.stored
    monkeypatch.setattr(quantiles, "stored", lambda df, name: seen.append(plain(df, name)) or seen[-1])
    df = spark.range(0, 60_000, 1, 300).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"),
        F.pmod(F.col("id") * 7919, F.lit(60_013)).cast("double").alias("v"),
    )
    assert df.where("k = 'hot'").select(F.spark_partition_id()).distinct().count() == 300
    got = exact_percentiles(df, ["k"], "v", {"mid": 0.5}, small_rows=3000)
    row = {r["k"]: r["mid"] for r in got.collect()}
    held = [r["v"] for r in df.where("k = 'hot'").collect()]
    assert row["hot"] == np.median(held) and len(row) == 98
    # The first round left a few hundredths of the group, the sketches one row a task and group.
    assert seen and seen[0].count() < 60_000 * 0.06
    assert _shuffled(df.where("k = 'hot'").groupBy("k").agg(F.percentile_approx("v", [0.5], 1000))) == 300


def test_no_rows_and_no_groups(spark):
    none = spark.createDataFrame([], "k string, v double")
    assert exact_percentiles(none, ["k"], "v", {"mid": 0.5}).collect() == []
