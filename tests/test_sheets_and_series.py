"""Positional sheets, decomposition and forecast."""

import datetime

import numpy as np
import pandas as pd
import pytest

from caremetrics.operators import sheets, timeseries
from caremetrics.schemas import CELLS
from caremetrics.sources.literals import literal_rows
from tests.conftest import day, rows


def _cells(spark, workbook, sheet, grid):
    return literal_rows(
        spark,
        [
            (workbook, sheet, r, c, None if v is None else str(v))
            for r, line in grid.items()
            for c, v in enumerate(line)
        ],
        CELLS,
    )


def test_prices_end_with_the_last_year_and_are_lenient_numbers(spark):
    grid = {0: ["Title"], 3: ["x", 1, 2, None, 3, 4]}
    grid |= {4 + i: [f"{2011 + i}–{12 + i}", 100 + i, "n.p.", "r", i, None] for i in range(14)}
    grid |= {18: ["Note: n.p. is not published", 1, 2], 19: ["Source", 3]}
    wide = sheets.spend_prices(_cells(spark, "Expenditure", "Table 1", grid))
    got = rows(wide)
    assert len(got) == 14
    assert got[0] == ("2011–12", 100.0, None, 0.0, None)
    long = sheets.spend_prices_long(wide)
    assert long.count() == 56 and long.where("type = 'real_growth' AND value IS NULL").count() == 14


def test_length_of_stay_melts_both_blocks(spark):
    grid = {
        2: [None, "2011–12", "2012–13", "Average since 2018–19", "Since 2021–22"],
        3: ["Public hospitals"],
        10: ["All hospitals", 9, 9, 9, 9],
    }
    grid |= {4 + i: ["Acute Subacute Other".split()[i % 3], i, f"{i}.5", 8, 8] for i in range(6)}
    got = rows(sheets.length_of_stay(_cells(spark, "Admitted Patients", "Table 2.9", grid)))
    assert len(got) == 12
    assert ("Public", "Acute", "2011–12", 0.0) in got and ("Private", "Other", "2012–13", 5.5) in got


def test_length_of_stay_keeps_empty_cells(spark):
    grid = {2: [None, "2011–12", "2012–13"], 5: ["Subacute", "1.5"]}
    grid |= {r: [f"type {r}"] for r in (4, 6, 7, 8, 9)}
    cells = _cells(spark, "Admitted Patients", "Table 2.9", grid)
    got = rows(sheets.length_of_stay(cells.where("cell IS NOT NULL")))
    assert len(got) == 12
    assert [r for r in got if r[3] is not None] == [("Public", "Subacute", "2011–12", 1.5)]


def test_gdp_years_are_integers_and_bad_years_raise(spark):
    good = {3: ["2011–12", None, None, None, "1,0", None, 9.5]}
    assert rows(sheets.gdp_ratio(_cells(spark, "Expenditure", "Table 7", good))) == [(2011, None, 9.5)]
    bad = {3: ["total", None, None, None, 1, None, 2], 4: ["2012–13", None, None, None, 1, None, 2]}
    with pytest.raises(Exception):
        sheets.gdp_ratio(_cells(spark, "Expenditure", "Table 7", bad)).collect()


def test_population_uses_the_last_column_and_skips_notes(spark):
    grid = {1: ["Year", "M", "Persons"], 2: [2011, 1, 30], 3: [2012, 2, 40], 9: ["Source: census"]}
    got = sheets.population(_cells(spark, "Population", "Sheet 1", grid))
    assert rows(got) == [(2011, 30.0), (2012, 40.0)]


def test_budget_years_are_counted_from_2011(spark):
    line = [None] * 24
    for no in (1, 4, 7, 10, 13, 16, 19, 22):
        line[no] = no
    grid = {5: ["2011–12", *line[1:]], 6: ["2012–13", *line[1:]], 7: line}
    cells = _cells(spark, "Expenditure", "Table 5", grid)
    wide = sheets.budget_wide(cells)
    assert wide.columns == ["year", "NAT", "NSW", "NT", "Qld", "SA", "Tas", "Vic", "WA"]
    assert [r["year"] for r in wide.orderBy("year").collect()] == [2011, 2012]
    assert sheets.budget_table(cells).where("state = 'NAT'").count() == 2


def test_one_state_can_be_picked(spark):
    grid = {2: ["2011–12", 1, None, 2, None, 3, None, 4, None, 5, None, 6, None, 7, None, 8, None, 36]}
    cells = _cells(spark, "Expenditure", "Table 4", grid)
    assert rows(sheets.spend_by_state(cells, "VIC")) == [("2011–12", "VIC", 2.0)]
    assert sheets.spend_by_state(cells).count() == 9


def _months(n):
    return [d.date() for d in pd.date_range("2015-01-01", periods=n, freq="MS")]


def _series(spark, **series):
    data = [(k, d, float(v)) for k, values in series.items() for d, v in zip(_months(len(values)), values)]
    return spark.createDataFrame(data, "k string, reportingstartdate date, mean_value double")


def _classical(values, period=12):
    """Brute force: moving average, phase means, remainder."""
    y = np.asarray(values, float)
    half = period // 2
    weights = np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(len(y), np.nan)
    for i in range(half, len(y) - half):
        trend[i] = np.dot(weights, y[i - half : i + half + 1])
    phase = np.array([np.nanmean((y - trend)[p::period]) for p in range(period)])
    phase -= phase.mean()
    seasonal = np.resize(phase, len(y))
    return trend, seasonal, y - trend - seasonal


@pytest.mark.parametrize("n", [24, 25, 41])
def test_decomposition_equals_brute_force(spark, n):
    rng = np.random.default_rng(n)
    y = 50 + np.arange(n) * 0.3 + 9 * np.sin(np.arange(n) / 2) + rng.normal(size=n)
    got = timeseries.decompose(_series(spark, a=y, short=y[:23]), ["k"]).orderBy("reportingstartdate")
    frame = pd.DataFrame([tuple(r) for r in got.collect()], columns=got.columns)
    assert set(frame["k"]) == {"a"} and len(frame) == n
    for name, expected in zip(("trend", "seasonal", "resid"), _classical(y)):
        np.testing.assert_allclose(frame[name].astype(float), expected, atol=1e-6)


def test_forecast_continues_a_straight_line_from_the_last_month(spark):
    line = [3 + 2 * i for i in range(20)]
    got = timeseries.holt(_series(spark, a=line, short=line[:11]), ["k"], horizon=3).orderBy("step").collect()
    assert [(r["k"], r["step"]) for r in got] == [("a", 1), ("a", 2), ("a", 3)]
    assert [r["forecast"] for r in got] == pytest.approx([43.0, 45.0, 47.0])
    # Month ends, beginning with that of the last observed month (2016-08).
    assert [r["date"] for r in got] == [day("2016-08-31"), day("2016-09-30"), day("2016-10-31")]


def _run(y, alpha, beta):
    level, slope, sse = y[1], y[1] - y[0], 0.0
    for value in y[2:]:
        expected = level + slope
        sse += (value - expected) ** 2
        new = alpha * value + (1 - alpha) * expected
        slope = beta * (new - level) + (1 - beta) * slope
        level = new
    return sse, level + slope


def test_refined_weights_follow_a_compass_search_from_the_grids_best(spark):
    rng = np.random.default_rng(11)
    series = {f"s{n}": np.cumsum(rng.normal(size=20 + n)) + 50 for n in range(8)}
    series["line"] = np.arange(24.0)  # no error at all, and nothing to gain
    got = {r["k"]: r for r in timeseries.holt(_series(spark, **series), ["k"], horizon=1, rounds=40).collect()}
    grid = [i / 10 for i in range(1, 10)]
    gained = 0
    for name, y in series.items():
        coarse = best = min((_run(y, a, b)[0], a, b) for a in grid for b in grid)
        step = timeseries.FIRST_STEP
        for _ in range(40):
            _, a, b = best
            near = [(a + step, b), (a - step, b), (a, b + step), (a, b - step)]
            near = [tuple(min(max(w, 0.0), 1.0) for w in pair) for pair in near]
            better = min((_run(y, *pair)[0], *pair) for pair in near)
            if better < best:
                best = better
            else:
                step /= 2
        row = got[name]
        error = _run(y, row["alpha"], row["beta"])[0]
        assert error <= coarse[0] * (1 + 1e-12)
        assert error == pytest.approx(best[0], rel=1e-9, abs=1e-12)
        assert row["forecast"] == pytest.approx(_run(y, row["alpha"], row["beta"])[1], abs=1e-6)
        gained += error < coarse[0] * (1 - 1e-6)
    assert gained >= 5


def test_forecast_picks_the_best_pair(spark):
    rng = np.random.default_rng(5)
    y = np.cumsum(rng.normal(size=30)) + 20
    got = timeseries.holt(_series(spark, a=y), ["k"], horizon=1).first()

    grid = [i / 10 for i in range(1, 10)]
    best = min((_run(y, a, b)[0], a, b) for a in grid for b in grid)
    assert (got["alpha"], got["beta"]) == best[1:]
    assert got["forecast"] == pytest.approx(_run(y, *best[1:])[1], abs=1e-6)


def test_gaps_are_left_out_of_a_series(spark):
    data = [("a", d, None if i == 3 else float(i)) for i, d in enumerate(_months(12))]
    df = spark.createDataFrame(data, "k string, reportingstartdate date, mean_value double")
    assert timeseries.holt(df, ["k"]).count() == 0
    assert isinstance(data[0][1], datetime.date)


@pytest.mark.parametrize("sizes", [(3, 3), (4, 5), (5, 4), (1, 2)])
@pytest.mark.parametrize("between", ["title", "nothing"])
def test_blocks_of_any_length_come_out_whole(spark, sizes, between):
    cells = [(0, 0, "Average length of stay"), (2, 1, "2011–12"), (2, 2, "2012–13"), (2, 9, "Since 2021–22"), (3, 0, "Public hospitals")]
    at, wanted = 4, []
    for name, size in zip(("Public", "Private"), sizes):
        for k in range(size):
            cells += [(at, 0, f"kind {k}"), (at, 1, f"{at}.5"), (at, 9, "1.0")]
            wanted += [(name, f"kind {k}", "2011–12", at + 0.5), (name, f"kind {k}", "2012–13", None)]
            at += 1
        if between == "title" and name == "Public":
            cells.append((at, 0, "Private hospitals"))
            at += 1
    # A third block, and notes, stay out.
    cells += [(at + 1, 0, "All"), (at + 1, 1, "7.0"), (at + 3, 0, "Note: days are rounded."), (at + 4, 1, "n.a.")]
    df = spark.createDataFrame([("Admitted Patients", "Table 2.9", r, c, v) for r, c, v in cells], CELLS)
    assert rows(sheets.length_of_stay(df)) == rows(spark.createDataFrame(wanted, "b string, h string, y string, d double"))
