"""Join sides by measured bytes, hot keys spread, and values of any size."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caremetrics.functions import joins, numbers
from caremetrics.functions.ordering import linear_percentiles, slots_for
from caremetrics.operators import distributions, measures
from caremetrics.sources import standins
from tests.conftest import SF, executed_plan, rows

PANEL_TYPES = "measurename string, reportedmeasurename string, state string, hospital_name string"


def test_small_side_measures_bytes(spark):
    left = spark.range(100)
    right = spark.range(10)
    size = 10 * joins.row_bytes(right)
    small = left.join(joins.small_side(right, size), "id")
    large = joins.small_side(right, size - 1)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert large is right


@pytest.mark.parametrize("limit", [0, 1 << 40])
def test_selection_is_the_same_with_few_and_many_datasets(spark, monkeypatch, with_conf, limit):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    sized = lambda df: joins.small_side(df, limit)
    monkeypatch.setattr(measures, "small_side", sized)
    tables = standins.tables(spark, SF)
    one = measures.panel(spark, tables, "URGENT", "Final", "ASIA")
    every = measures.panels(tables).where(
        "measurename = 'URGENT' AND reportedmeasurename = 'Final' AND state = 'ASIA'"
    )
    assert rows(one) == rows(every.select(*measures.PANEL_ROW))
    assert one.count() > 0


def test_salted_join_is_an_inner_join(spark):
    left = spark.createDataFrame([(i % 3, i) for i in range(50)], "k long, v long")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (7, "c")], "k long, name string")
    assert rows(joins.salted_join(left, right, ["k"], F.col("v"), 4)) == rows(left.join(right, "k"))


def test_hot_key_is_spread_over_tasks(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16",
              spark__sql__adaptive__enabled="false")
    hot = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    keys = hot.select("k").distinct().withColumn("limit", F.lit(1))
    joined = joins.salted_join(hot, keys, ["k"], F.col("v"))
    used = joined.where("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    assert used >= 6
    assert joined.count() == 20_000


def test_cut_points_grow_with_the_table():
    assert slots_for(1000) == 256
    assert slots_for(10**12) >= 10**6
    assert slots_for(10**12) & (slots_for(10**12) - 1) == 0


@pytest.mark.parametrize("unit", [1e-7, 1.0, 1e13])
def test_box_mean_and_heatmap_keep_values_of_any_size(spark, unit):
    random.seed(3)
    values = [unit * random.choice([1, 2, 3, 5, 8, 13, 40]) for _ in range(60)]
    names = ("m", "r", "s", "h")
    panel = spark.createDataFrame([(*names, v) for v in values], f"{PANEL_TYPES}, value double")
    got = distributions.box(panel).first()
    q1, median, q3 = np.percentile(values, [25, 50, 75])
    assert (got["q1"], got["median"], got["q3"]) == pytest.approx((q1, median, q3), rel=1e-12)
    fine = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert (got["lo_whisker"], got["hi_whisker"]) == pytest.approx((min(fine), max(fine)), rel=1e-12)
    assert got["outliers"] == len(values) - len(fine)
    mean = panel.agg(numbers.mean("value").alias("x")).first()["x"]
    assert mean == pytest.approx(sum(values) / len(values), rel=1e-12)
    cube = panel.groupBy(*PANEL_TYPES.replace(" string", "").split(", ")).agg(
        numbers.total_of("value").alias("total"), F.count("value").alias("n")
    )
    assert distributions.ranking(cube).first()["mean_value"] == pytest.approx(mean, rel=1e-12)
    dated = cube.withColumn("reportingstartdate", F.lit("2020-01-01"))
    assert distributions.heatmap(dated).first()["total"] == pytest.approx(sum(values), rel=1e-12)


def test_percentiles_of_one_hot_group_match_without_broadcast(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    data = [("hot", float(i % 997)) for i in range(5000)] + [("cold", 1.0), ("cold", 2.0)]
    values = spark.createDataFrame(data, "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))
    got = {r["k"]: r["q"] for r in linear_percentiles(values, ["k"], "v", "n", {"q": 0.25}).collect()}
    assert got["hot"] == pytest.approx(np.percentile([v for k, v in data if k == "hot"], 25))
    assert got["cold"] == 1.25


def test_whole_counts_need_no_single_task_of_rows(spark):
    plan = executed_plan(joins.small_side(spark.range(10_000).repartition(4)).agg(F.count("*")))
    assert "LocalLimit" not in plan
