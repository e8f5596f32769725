"""Decomposition and forecast of many monthly series at once.

A series is a group of (date, value) rows. Its length is bounded by the number
of reporting dates, never by the number of facts, so a series may sit in one
task; the work spreads over the series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Season length and shortest series for each method.
PERIOD = 12
MIN_DECOMPOSE = 24
MIN_FORECAST = 12
HORIZON = 12
# First step and number of rounds of the refinement of weights.
FIRST_STEP = 0.05
ROUNDS = 30


def decompose(
    df: DataFrame,
    keys: Sequence[str],
    date: str = "reportingstartdate",
    value: str = "mean_value",
    period: int = PERIOD,
    min_n: int = MIN_DECOMPOSE,
) -> DataFrame:
    """Additive trend, seasonal and residual parts of every long enough series.

    The trend is the centred moving average over an even ``period`` with half
    weights at both ends; the season is the mean detrended value by position,
    centred on zero. All windows share the partitioning by ``keys``.
    """
    half = period // 2
    group = Window.partitionBy(*keys)
    ordered = group.orderBy(date)
    around = ordered.rowsBetween(-half, half)
    y = F.col(value)
    ends = F.lag(value, half).over(ordered) + F.lead(value, half).over(ordered)
    phase_group = Window.partitionBy(*keys, "_phase")
    first_season = F.col("_row") <= period
    return (
        df.where(y.isNotNull())
        .withColumn("_n", F.count("*").over(group))
        .where(F.col("_n") >= min_n)
        .withColumn("_row", F.row_number().over(ordered))
        .withColumn("trend", (F.sum(value).over(around) - 0.5 * ends) / period)
        .withColumn("_phase", (F.col("_row") - 1) % period)
        .withColumn("_phase_mean", F.avg(y - F.col("trend")).over(phase_group))
        .withColumn(
            "_level", F.sum(F.when(first_season, F.col("_phase_mean"))).over(group) / period
        )
        .withColumn("seasonal", F.col("_phase_mean") - F.col("_level"))
        .select(
            *keys,
            date,
            value,
            "trend",
            "seasonal",
            (y - F.col("trend") - F.col("seasonal")).alias("resid"),
        )
    )


def _smooth(values: Column, alpha: Column, beta: Column, step: Column) -> Column:
    """Squared one-step error, weights, last level and slope, and the search step handed in.

    Starts from the second value and the first difference. The result is built where
    the last state is bound, so that the run over the values is evaluated once.
    """
    start = F.struct(
        values[1].alias("level"),
        (values[1] - values[0]).alias("slope"),
        F.lit(0.0).alias("sse"),
    )

    def update(state: Column, y: Column) -> Column:
        # Error-correction form of the two smoothing equations.
        expected = state["level"] + state["slope"]
        error = y - expected
        return F.struct(
            (expected + alpha * error).alias("level"),
            (state["slope"] + alpha * beta * error).alias("slope"),
            (state["sse"] + error * error).alias("sse"),
        )

    def fitted(state: Column) -> Column:
        return F.struct(
            state["sse"].alias("sse"),
            alpha.alias("alpha"),
            beta.alias("beta"),
            state["level"].alias("level"),
            state["slope"].alias("slope"),
            step.alias("step"),
        )

    return F.aggregate(F.slice(values, 3, F.size(values)), start, update, fitted)


def _refined(values: Column, fit: Column, rounds: int) -> Column:
    """Compass search from a fit: the best of four neighbours, or half the step if none is better.

    A fit competes with its neighbours in every round, so the error never rises.
    Weights stay between 0 and 1.
    """

    def within(weight: Column) -> Column:
        return F.least(F.greatest(weight, F.lit(0.0)), F.lit(1.0))

    def turn(best: Column, _: Column) -> Column:
        step = best["step"]
        moves = F.array(
            *[
                F.struct(within(best["alpha"] + a * step).alias("alpha"), within(best["beta"] + b * step).alias("beta"))
                for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))
            ]
        )
        tries = F.transform(moves, lambda m: _smooth(values, m["alpha"], m["beta"], step))
        return F.array_min(F.array_append(tries, best.withField("step", step / 2)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), fit, turn)


def holt(
    df: DataFrame,
    keys: Sequence[str],
    date: str = "reportingstartdate",
    value: str = "mean_value",
    horizon: int = HORIZON,
    min_n: int = MIN_FORECAST,
    grid: Sequence[float] = tuple(i / 10 for i in range(1, 10)),
    rounds: int = 0,
) -> DataFrame:
    """Forecast with additive-trend exponential smoothing.

    The smoothing weights are the pair of grid values with the least one-step
    squared error; with ``rounds`` a compass search refines both from there.
    Forecast dates are month ends, the first being that of the last observed month.
    """
    if horizon < 1:
        raise ValueError("horizon must be at least one month")
    # Many steps per value make this heavy in time and light in bytes, so the
    # series are spread by number and not merged into few tasks by size.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    history = (
        df.where(F.col(value).isNotNull())
        .repartition(tasks, *keys)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct(date, value))).alias("_history"))
        .where(F.size("_history") >= min_n)
        .select(
            *keys,
            F.col("_history")[value].alias("_values"),
            F.element_at("_history", -1)[date].alias("_last"),
        )
    )
    pairs = F.array(
        *[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta")) for a in grid for b in grid]
    )

    def fit(pair: Column) -> Column:
        return _smooth(F.col("_values"), pair["alpha"], pair["beta"], F.lit(FIRST_STEP))

    best = history.withColumn("_fit", F.array_min(F.transform(pairs, fit)))
    if rounds:
        best = best.withColumn("_fit", _refined(F.col("_values"), F.col("_fit"), rounds))
    steps = best.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.select(
        *keys,
        "step",
        F.last_day(F.add_months("_last", F.col("step") - 1)).alias("date"),
        F.col("_fit.alpha").alias("alpha"),
        F.col("_fit.beta").alias("beta"),
        (F.col("_fit.level") + F.col("step") * F.col("_fit.slope")).alias("forecast"),
    )
