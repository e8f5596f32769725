"""Choosing the strength of a penalty by cross-validation, in one pass over the rows.

Rows are dealt to folds by a hash of their key, and each target's moments are summed by fold.
Moments of folds can be merged, so those of all rows but a fold's are at hand without
another pass, and the error of a line on a fold follows from the fold's moments. A
target is fitted from its few rows of moments: strengths go from the one that leaves no
feature downwards, and every fit starts from the weights of the one before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDS = 5
# Strengths of a path, and the last one as a share of the first.
STRENGTHS, LAST = 30, 1e-4
# Share of the absolute part of the penalty.
ELASTIC_NET = 0.8

_CHOSEN = T.StructType(
    [
        T.StructField("target", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("strength", T.DoubleType()),
        T.StructField("cv_error", T.DoubleType()),
        T.StructField("feature", T.StringType()),
        T.StructField("coefficient", T.DoubleType()),
    ]
)


class _Sums:
    """Count, means and summed cross products of some rows; the last column is the target."""

    def __init__(self, n: int, means: np.ndarray, products: np.ndarray):
        self.n, self.means, self.products = n, means, products

    def merged(self, other: _Sums) -> _Sums:
        n = self.n + other.n
        apart = other.means - self.means
        shift = np.outer(apart, apart) * (self.n * other.n / n)
        return _Sums(n, self.means + apart * other.n / n, self.products + other.products + shift)

    def without_target(self) -> tuple[np.ndarray, np.ndarray]:
        """Covariances of the features, and theirs with the target."""
        covariances = self.products / self.n
        return covariances[:-1, :-1], covariances[:-1, -1]

    def error(self, weights: np.ndarray, intercept: float) -> float:
        """Summed squared error of a line on these rows."""
        line = np.append(-weights, 1.0)
        return float(line @ self.products @ line + self.n * (line @ self.means - intercept) ** 2)


def _merged(parts: Sequence[_Sums]) -> _Sums:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.merged(part)
    return whole


def _path(sums: _Sums, strengths: Sequence[float], elastic_net: float) -> Iterator[tuple[np.ndarray, float]]:
    """Weights and intercept for every strength, each fit started from the one before.

    Features and target are scaled to unit deviation, as the penalty is meant for those.
    """
    inner, with_y = sums.without_target()
    spread, deviation = np.sqrt(np.diag(inner)), np.sqrt(max(sums.products[-1, -1] / sums.n, 0.0))
    alive = np.flatnonzero(spread > 1e-12 * max(1.0, spread.max(initial=0.0))) if deviation > 0 else np.empty(0, int)
    scale = spread[alive]
    scaled = inner[np.ix_(alive, alive)] / np.outer(scale, scale)
    aim = with_y[alive] / scale / deviation if len(alive) else np.empty(0)
    w = np.zeros(len(alive))
    for strength in strengths:
        lasso, ridge = strength * elastic_net, strength * (1 - elastic_net)
        for _ in range(10_000):
            moved = 0.0
            for j in range(len(alive)):
                rest = aim[j] - scaled[j] @ w + w[j]
                new = np.sign(rest) * max(abs(rest) - lasso, 0.0) / (1 + ridge)
                moved, w[j] = max(moved, abs(new - w[j])), new
            if moved <= 1e-12:
                break
        weights = np.zeros(len(spread))
        weights[alive] = w * deviation / scale
        weights += 0.0  # no negative zeros
        yield weights, float(sums.means[-1] - sums.means[:-1] @ weights)


def _strengths(sums: _Sums, elastic_net: float) -> np.ndarray:
    """From the strength that leaves no feature downwards, in equal ratios."""
    inner, with_y = sums.without_target()
    spread = np.sqrt(np.diag(inner) * sums.products[-1, -1] / sums.n)
    most = np.max(np.abs(with_y[spread > 0]) / spread[spread > 0], initial=0.0)
    return max(most, 1e-12) / max(elastic_net, 1e-3) * LAST ** (np.arange(STRENGTHS) / (STRENGTHS - 1))


def _choose(folds: list[_Sums], elastic_net: float) -> tuple[float, float, np.ndarray, float]:
    """Strength, its error per row on rows left out, and the weights and intercept from all rows."""
    whole = _merged(folds)
    strengths = _strengths(whole, elastic_net)
    errors = np.zeros(len(strengths))
    for k, fold in enumerate(folds):
        others = folds[:k] + folds[k + 1 :]
        for i, line in enumerate(_path(_merged(others) if others else whole, strengths, elastic_net)):
            errors[i] += fold.error(*line)
    # Of equal errors the strongest penalty, which comes first.
    best = int(np.argmin(errors))
    *_, line = _path(whole, strengths[: best + 1], elastic_net)
    return float(strengths[best]), float(errors[best] / whole.n), *line


def _fold_sums(features: list[str], rows: list[dict]) -> list[_Sums]:
    names = [*features, "y"]
    out = []
    for row in rows:
        products = np.empty((len(names), len(names)))
        for i, one in enumerate(names):
            for j in range(i, len(names)):
                products[i, j] = products[j, i] = row[f"{one} with {names[j]}"] * row["n"]
        out.append(_Sums(int(row["n"]), np.array([row[f"mean {c}"] for c in names]), products))
    return out


def fit_chosen(
    design: DataFrame, features: Sequence[str], key: Sequence[str], folds: int = FOLDS, elastic_net: float = ELASTIC_NET
) -> DataFrame:
    """One penalised model per ``target`` of a long table, with the strength that predicts left-out rows best.

    Returns (target, n, strength, cv_error, feature, coefficient), a row per feature and
    one for ``(intercept)``. Rows with a null are left out. Rows of one key are in one
    fold. Only moments are shuffled: ``folds`` rows per target and task.
    """
    features = list(features)
    names = [*features, "y"]
    fold = F.pmod(F.xxhash64(*key), F.lit(folds)).alias("fold")
    typed = design.select("target", fold, *[F.col(c).cast("double").alias(c) for c in names]).na.drop("any")
    sums = [F.count("*").alias("n"), *[F.avg(c).alias(f"mean {c}") for c in names]]
    for i, one in enumerate(names):
        sums += [F.covar_pop(one, other).alias(f"{one} with {other}") for other in names[i:]]
    by_fold = typed.groupBy("target", "fold").agg(*sums)
    columns = [c for c in by_fold.columns if c != "target"]
    packed = by_fold.groupBy("target").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("folds"))

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for target, held in zip(batch["target"], batch["folds"]):
                parts = _fold_sums(features, [dict(r.asDict() if hasattr(r, "asDict") else r) for r in held])
                strength, error, weights, intercept = _choose(parts, elastic_net)
                about = (target, sum(p.n for p in parts), strength, error)
                rows += [(*about, f, float(w)) for f, w in zip(features, weights)]
                rows.append((*about, "(intercept)", intercept))
            yield pd.DataFrame(rows, columns=_CHOSEN.fieldNames())

    return packed.mapInPandas(solved, _CHOSEN)
