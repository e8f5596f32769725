"""Design tables, deterministic split, scaling and fits."""

import numpy as np
import pytest

from caremetrics.operators import models
from tests.conftest import rows


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2] + [0, 10, 3]
    y = 4 + x @ [2.0, -1.0, 0.0] + rng.normal(size=400) * 0.1
    data = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id long, a double, b double, c double, y double"), x, y


def test_ordinary_least_squares(sample):
    df, x, y = sample
    got = {r["feature"]: r["coefficient"] for r in models.fit_targets(df, ["y"], ["a", "b", "c"]).collect()}
    wanted, *_ = np.linalg.lstsq(np.c_[x, np.ones(len(x))], y, rcond=None)
    assert [got[k] for k in ("a", "b", "c", "(intercept)")] == pytest.approx(list(wanted), abs=1e-8)


def test_penalty_pulls_the_unused_feature_to_zero(sample):
    df, _, _ = sample
    scaled = models.standardize(df, ["a", "b", "c"])
    names = ["a_scaled", "b_scaled", "c_scaled"]
    got = {
        r["feature"]: r["coefficient"]
        for r in models.fit_targets(scaled, ["y"], names, reg_param=0.1, elastic_net=0.8).collect()
    }
    assert got["c_scaled"] == 0.0
    assert 0 < got["a_scaled"] < 2.0 and got["b_scaled"] < 0


def test_rows_lacking_one_target_serve_the_others(spark):
    data = [(1.0, 2.0, 1.0), (2.0, 4.0, None), (3.0, 6.0, 3.0), (None, 9.0, 9.0)]
    df = spark.createDataFrame(data, "x double, p double, q double")
    got = rows(models.fit_targets(df, ["p", "q"], ["x"]))
    assert [(t, f, round(c, 9) + 0.0) for t, f, c in got] == [
        ("p", "(intercept)", 0.0),
        ("p", "x", 2.0),
        ("q", "(intercept)", 0.0),
        ("q", "x", 1.0),
    ]


def test_long_fit_and_heldout_error(spark, sample):
    df, x, y = sample
    long = models.long_targets(df, ["y"], ["a", "b"], "id")
    fitted = models.fit_long(long.where("id < 300"), ["a", "b"])
    design = np.c_[x[:, :2], np.ones(len(x))]
    wanted, *_ = np.linalg.lstsq(design[:300], y[:300], rcond=None)
    got = {r["feature"]: r["coefficient"] for r in fitted.collect()}
    assert [got[k] for k in ("a", "b", "(intercept)")] == pytest.approx(list(wanted), abs=1e-8)
    error = models.heldout_error(fitted, long.where("id >= 300"), ["a", "b"]).first()
    miss = y[300:] - design[300:] @ wanted
    assert error["n"] == 100 and error["rmse"] == pytest.approx(np.sqrt((miss**2).mean()))
    assert error["mae"] == pytest.approx(np.abs(miss).mean())
    assert error["r2"] == pytest.approx(1 - (miss**2).mean() / y[300:].var())


def test_scaling(spark, sample):
    df, x, _ = sample
    got = np.array(models.standardize(df, ["a", "b"]).orderBy("id").select("a_scaled", "b_scaled").collect())
    wanted = (x[:, :2] - x[:, :2].mean(0)) / x[:, :2].std(0, ddof=1)
    np.testing.assert_allclose(got, wanted, atol=1e-9)
    flat = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert rows(models.standardize(flat, ["v"])) == [(1.0, 0.0), (1.0, 0.0)]


def test_split_is_repeatable_and_near_its_share(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    one = models.split(df, ["k"])
    other = models.split(df.repartition(11), ["k"])
    assert one.exceptAll(other).count() == 0
    assert 0.79 < one.where("is_train").count() / 20_000 < 0.81
    assert models.split(df, ["k"], 0.0).where("is_train").count() == 0


def test_targets_are_labelled_in_id_order_without_the_last(spark):
    info = [(30, "NAT", 3.0), (10, "NAT", 1.0), (10, "b c", 9.0), (20, "b c", 8.0), (20, "zz", 1.0), (40, "NAT", 4.0)]
    df = spark.createDataFrame(info, "datasetid long, reportingunitcode string, value double")
    got = models.wide_targets(df, ["b c", "NAT"])
    assert got.columns == ["year", "NAT_values", "b c_values"]
    assert rows(got) == [(2011, 1.0, 9.0), (2012, None, 8.0), (2013, 3.0, None)]


def test_design_is_long_and_complete(spark):
    budget = spark.createDataFrame([(2011, 1.0, 2.0), (2012, None, 3.0)], "year int, NAT double, NSW double")
    targets = spark.createDataFrame([(2011, 5.0, None), (2012, 6.0, 7.0)], "year int, `u v` double, w double")
    got = models.lm_design(budget, targets)
    assert got.columns == ["year", "target", "y", "x_NAT", "x_NSW"]
    assert rows(got) == [(2011, "u v", 5.0, 1.0, 2.0)]


def test_budget_line_and_scenarios(spark):
    training = spark.createDataFrame(
        [(2011, 25.0, 10.0), (2012, 45.0, 20.0), (2013, 65.0, 30.0)], "year int, nat double, total_population double"
    )
    model = models.fit_budget(training)
    assert list(models.budget_line(spark, model).first()) == pytest.approx([2.0, 5.0])
    future = spark.createDataFrame(
        [(2030, 50.0, 40.0, 30.0, 1.0)],
        "year int, high double, medium double, low double, zero_migration double",
    )
    got = {r["scenario"]: r["prediction"] for r in models.score_scenarios(model, future).collect()}
    assert got == pytest.approx({"high": 105.0, "medium": 85.0, "low": 65.0})


def test_population_is_split_by_fixed_shares(spark):
    df = spark.createDataFrame([(2011, 1000.0)], "year int, total_population double")
    got = {s: p for _, s, p in rows(models.state_population(df))}
    assert sum(got.values()) == pytest.approx(1000.0) and got["NSW"] == pytest.approx(310.0)
