"""The chosen penalty against plain refits of every fold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from caremetrics.operators import penalty

FEATURES = ["x1", "x2", "x3"]


def _net(x, y, strength, mix):
    """Elastic net by plain proximal steps on the rows themselves, features and target at unit deviation."""
    mx, my, sx, sy = x.mean(0), y.mean(), x.std(0), y.std()
    live = sx > 0
    z, t = (x[:, live] - mx[live]) / sx[live], (y - my) / sy
    w = np.zeros(live.sum())
    step = 1 / (np.linalg.norm(z, 2) ** 2 / len(y) + strength * (1 - mix))
    for _ in range(20_000):
        moved = w - step * (z.T @ (z @ w - t) / len(y) + strength * (1 - mix) * w)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * strength * mix, 0)
        if np.abs(new - w).max(initial=0) < 1e-13:
            break
        w = new
    full = np.zeros(len(live))
    full[live] = w * sy / sx[live]
    return full, my - mx @ full


def test_choice_and_fit_match_plain_refits(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(5, 2, (240, 3))
    rows = [(k, "lin", *map(float, r), float(3 * r[0] - r[1] + rng.normal(0, 2))) for k, r in enumerate(x)]
    rows += [(k, "noise", *map(float, r), float(rng.normal(0, 2))) for k, r in enumerate(x)]
    rows += [(999, "lin", None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k long, target string, x1 double, x2 double, x3 double, y double").repartition(5)
    fold = {r[0]: r[1] for r in df.select("k", F.pmod(F.xxhash64("k"), F.lit(4))).distinct().collect()}
    got = {}
    for r in penalty.fit_chosen(df, FEATURES, ["k"], folds=4).collect():
        got.setdefault(r["target"], {})[r["feature"]] = r
    for target in ("lin", "noise"):
        part = np.array([r[2:] for r in rows if r[1] == target and r[2] is not None])
        place = np.array([fold[r[0]] for r in rows if r[1] == target and r[2] is not None])
        xs, ys = part[:, :3], part[:, 3]
        cov = np.abs(np.corrcoef(part.T)[:3, 3]).max()
        strengths = cov / 0.8 * penalty.LAST ** (np.arange(penalty.STRENGTHS) / (penalty.STRENGTHS - 1))
        errors = []
        for s in strengths:
            total = 0.0
            for f in range(4):
                w, b = _net(xs[place != f], ys[place != f], s, 0.8)
                total += ((ys[place == f] - xs[place == f] @ w - b) ** 2).sum()
            errors.append(total / len(ys))
        best = int(np.argmin(errors))
        some = got[target]["(intercept)"]
        assert some["n"] == 240
        assert some["strength"] == pytest.approx(strengths[best], rel=1e-9)
        assert some["cv_error"] == pytest.approx(errors[best], rel=1e-7)
        w, b = _net(xs, ys, strengths[best], 0.8)
        assert [got[target][f]["coefficient"] for f in FEATURES] == pytest.approx(list(w), rel=1e-6, abs=1e-8)
        assert some["coefficient"] == pytest.approx(b, rel=1e-6, abs=1e-7)
    # The noise is left alone as far as the rows tell, the line is found.
    assert abs(got["lin"]["x1"]["coefficient"] - 3) < 0.3
    assert got["noise"]["(intercept)"]["strength"] > got["lin"]["(intercept)"]["strength"]


def test_constant_columns_few_rows_and_none(spark):
    rows = [(1, "a", 1.0, 2.0, 3.0, 5.0), (2, "a", 1.0, 2.5, 3.0, 6.0), (1, "b", 1.0, 1.0, 1.0, 4.0), (2, "c", 1.0, 1.0, 1.0, 4.0), (3, "c", 2.0, 1.0, 1.0, 4.0)]
    df = spark.createDataFrame(rows, "k long, target string, x1 double, x2 double, x3 double, y double")
    got = penalty.fit_chosen(df, FEATURES, ["k"]).collect()
    assert len(got) == 12
    assert all(np.isfinite(r["coefficient"]) and np.isfinite(r["cv_error"]) for r in got)
    assert {r["target"]: r["coefficient"] for r in got if r["feature"] == "(intercept)" and r["target"] != "a"} == {"b": 4.0, "c": 4.0}
    assert penalty.fit_chosen(df.limit(0), FEATURES, ["k"]).count() == 0
