"""Design tables and linear models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremetrics.operators.sheets import SCENARIOS, year_ordinals
from caremetrics.session import checkpointed
from caremetrics.sources.literals import literal_rows

# Share of the population by state.
POPULATION_SHARES = {
    "NSW": 0.31,
    "Vic": 0.25,
    "Qld": 0.20,
    "WA": 0.10,
    "SA": 0.07,
    "Tas": 0.02,
    "NT": 0.01,
    "ACT": 0.04,
}
# Share of rows a model is trained on, and the L1/L2 mix.
TRAIN_SHARE = 0.8
ELASTIC_NET = 0.8
_LINE = T.StructType(
    [T.StructField("slope", T.DoubleType()), T.StructField("intercept", T.DoubleType())]
)


def state_population(population: DataFrame, shares: dict[str, float] | None = None) -> DataFrame:
    """Total population split over the states by fixed shares: (year, state, population)."""
    items = (POPULATION_SHARES if shares is None else shares).items()
    pairs = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(p).alias("share")) for s, p in items])
    return population.select("year", "total_population", F.explode(pairs).alias("_part")).select(
        "year",
        F.col("_part.state").alias("state"),
        (F.col("total_population") * F.col("_part.share")).alias("population"),
    )


def budget_population(budget: DataFrame, population: DataFrame) -> DataFrame:
    """National spending next to the population of the year: (year, nat, total_population)."""
    national = budget.select("year", F.col("NAT").alias("nat")).where(F.col("nat").isNotNull())
    return national.join(population, "year").select("year", "nat", "total_population")


def _assembled(df: DataFrame, columns: Sequence[str], *others: str) -> DataFrame:
    # The assembler records the vector length, which saves the fit a job.
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    return assembler.transform(df).select("features", *others)


def fit_budget(training: DataFrame) -> LinearRegressionModel:
    """Spending explained by population, by ordinary least squares."""
    design = _assembled(training, ["total_population"], "nat")
    return LinearRegression(featuresCol="features", labelCol="nat", solver="normal").fit(design)


def budget_line(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    line = [(float(model.coefficients[0]), float(model.intercept))]
    return literal_rows(spark, line, _LINE)


def score_scenarios(model: LinearRegressionModel, projections: DataFrame) -> DataFrame:
    """Predicted spending per year and population scenario, all scenarios in one pass."""
    long = projections.unpivot(["year"], list(SCENARIOS), "scenario", "total_population")
    assembler = VectorAssembler(inputCols=["total_population"], outputCol="features", handleInvalid="skip")
    return model.transform(assembler.transform(long)).select("year", "scenario", "prediction")


def wide_targets(info: DataFrame, units: Sequence[str]) -> DataFrame:
    """One row per dataset with a value column per unit, labelled by year.

    Years follow the order of dataset ids, and the last dataset is left out.
    """
    ordered = sorted(units)
    wide = (
        info.where(F.col("reportingunitcode").isin(*ordered))
        .groupBy("datasetid")
        .pivot("reportingunitcode", ordered)
        .agg(F.max("value"))
    )
    # A row per reporting year, read several times below.
    wide = checkpointed(wide)
    newest = wide.agg(F.max("datasetid")).scalar()
    kept = year_ordinals(wide.where(F.col("datasetid") < newest), "datasetid")
    return kept.select("year", *[F.col(f"`{u}`").alias(f"{u}_values") for u in ordered])


def lm_design(budget: DataFrame, targets: DataFrame) -> DataFrame:
    """Long design table: (year, target, y, x_<state> …), rows with gaps left out."""
    features = [c for c in budget.columns if c != "year"]
    names = [c for c in targets.columns if c != "year"]
    long = targets.unpivot(["year"], names, "target", "y")
    xs = [F.col(c).cast("double").alias(f"x_{c}") for c in features]
    return (
        budget.select("year", *xs)
        .join(long, "year")
        .select("year", "target", F.col("y").cast("double").alias("y"), *[f"x_{c}" for c in features])
        .na.drop("any")
    )


def split(df: DataFrame, key: Sequence[str], share: float = TRAIN_SHARE) -> DataFrame:
    """Add ``is_train``: the same rows on every run, about ``share`` of the keys.

    The first 32 bits of the key's digest are compared with the same fraction of
    their range, both as hexadecimal text.
    """
    limit = f"{int(share * 2**32):08x}"
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    return df.withColumn("is_train", F.substring(F.md5(text), 1, 8) < limit)


def column_scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample standard deviation per column: one pass, one row to the driver."""
    row = df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_samp(c).alias(f"{c}_std") for c in columns],
    ).first()
    return {c: (row[f"{c}_mean"], row[f"{c}_std"]) for c in columns}


def standardize(
    df: DataFrame, columns: Sequence[str], scales: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Add ``<column>_scaled`` = (x − mean) / sample deviation; 0 for a constant column.

    Scales learned from other rows may be given, as for a held-out part.
    """
    known = column_scales(df, columns) if scales is None else scales
    scaled = {}
    for column in columns:
        mean, deviation = known[column]
        shifted = (F.col(column) - mean) / deviation if deviation else F.lit(0.0)
        scaled[f"{column}_scaled"] = shifted
    return df.withColumns(scaled)


def _moments(features: Sequence[str]) -> list[Column]:
    """Means, variances and covariances of the features and of ``y``, by name."""
    names = [*features, "y"]
    sums = [F.avg(c).alias(f"mean {c}") for c in names]
    for i, one in enumerate(names):
        sums += [F.covar_pop(one, other).alias(f"{one} with {other}") for other in names[i:]]
    return sums


def _solve(moments: dict, features: Sequence[str], reg_param: float, elastic_net: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept from one target's moments.

    Least squares takes the shortest solution if features depend on each other.
    With a penalty, features and target are scaled to unit deviation first, as the
    penalty is meant for those, and coordinates are improved in turn until they rest.
    """
    k = len(features)
    names = [*features, "y"]
    full = np.empty((k + 1, k + 1))
    for i in range(k + 1):
        for j in range(i, k + 1):
            full[i, j] = full[j, i] = moments[f"{names[i]} with {names[j]}"]
    inner, with_y, spread = full[:k, :k], full[:k, k], np.sqrt(np.diag(full)[:k])
    deviation = np.sqrt(full[k, k])
    weights = np.zeros(k)
    alive = np.flatnonzero(spread > 0)
    if reg_param == 0 or deviation == 0:
        scale = spread[alive]
        scaled = inner[np.ix_(alive, alive)] / np.outer(scale, scale)
        weights[alive] = np.linalg.lstsq(scaled, with_y[alive] / scale, rcond=1e-12)[0] / scale
    else:
        scale = spread[alive]
        scaled, aim = inner[np.ix_(alive, alive)] / np.outer(scale, scale), with_y[alive] / scale / deviation
        lasso, ridge = reg_param * elastic_net / deviation, reg_param * (1 - elastic_net) / deviation
        w = np.zeros(len(alive))
        for _ in range(10_000):
            before = w.copy()
            for j in range(len(alive)):
                rest = aim[j] - scaled[j] @ w + w[j]
                w[j] = np.sign(rest) * max(abs(rest) - lasso, 0) / (1 + ridge)
            if np.abs(w - before).max(initial=0) <= 1e-14:
                break
        weights[alive] = w * deviation / scale
    means = np.array([moments[f"mean {f}"] for f in features])
    return weights, float(moments["mean y"] - means @ weights)


def fit_long(
    design: DataFrame, features: Sequence[str], reg_param: float = 0.0, elastic_net: float = 0.0
) -> DataFrame:
    """Fit one linear model per value of ``target`` in a long table (target, y, features).

    One pass for all targets: tasks add up moments, which combine before the
    shuffle, and each target is solved from its one row of them, where it lies.
    Returns (target, feature, coefficient); the intercept is feature ``(intercept)``.
    Rows with a null are left out.
    """
    features = list(features)
    typed = design.select("target", *[F.col(c).cast("double").alias(c) for c in [*features, "y"]]).na.drop("any")
    moments = typed.groupBy("target").agg(*_moments(features))

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.to_dict("records"):
                weights, intercept = _solve(row, features, reg_param, elastic_net)
                rows += [(row["target"], f, float(w)) for f, w in zip(features, weights)]
                rows.append((row["target"], "(intercept)", intercept))
            yield pd.DataFrame(rows, columns=["target", "feature", "coefficient"])

    return moments.mapInPandas(solved, _COEFFICIENTS)


def long_targets(df: DataFrame, targets: Sequence[str], features: Sequence[str], *keys: str) -> DataFrame:
    """Target columns as rows: (keys, features, target, y)."""
    typed = df.select(*keys, *features, *[F.col(t).cast("double").alias(t) for t in targets])
    return typed.unpivot([*keys, *features], list(targets), "target", "y")


def fit_targets(
    design: DataFrame,
    targets: Sequence[str],
    features: Sequence[str],
    reg_param: float = 0.0,
    elastic_net: float = 0.0,
) -> DataFrame:
    """As ``fit_long``, for a table with one column per target. Rows with a null
    target serve the others."""
    return fit_long(long_targets(design, targets, features), features, reg_param, elastic_net)


def heldout_error(fitted: DataFrame, heldout: DataFrame, features: Sequence[str]) -> DataFrame:
    """Root mean square error, mean absolute error and R² per target on a long table.

    ``fitted`` comes from ``fit_long``: a row per target and feature, which are few
    and joined as one row per target.
    """
    of = lambda name: F.max(F.when(F.col("feature") == name, F.col("coefficient")))
    lines = fitted.groupBy("target").agg(
        F.array(*[of(f) for f in features]).alias("_weights"), of("(intercept)").alias("_start")
    )
    complete = heldout.select("target", "y", *features).na.drop("any")
    predicted = F.col("_start")
    for i, feature in enumerate(features):
        predicted = predicted + F.col("_weights")[i] * F.col(feature)
    scored = complete.join(F.broadcast(lines), "target").withColumn("_miss", F.col("y") - predicted)
    squared = F.avg(F.col("_miss") * F.col("_miss"))
    return scored.groupBy("target").agg(
        F.count("*").alias("n"),
        F.sqrt(squared).alias("rmse"),
        F.avg(F.abs("_miss")).alias("mae"),
        F.when(F.var_pop("y") > 0, 1 - squared / F.var_pop("y")).alias("r2"),
    )


_COEFFICIENTS = T.StructType(
    [
        T.StructField("target", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("coefficient", T.DoubleType()),
    ]
)
