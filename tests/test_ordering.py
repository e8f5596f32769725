"""Range-wise ordering against brute force, with hot keys, ties and tiny groups."""

import random
from collections import defaultdict

import numpy as np
import pytest

from caremetrics.functions import ordering
from tests.conftest import rows


def _groups(seed):
    rng = random.Random(seed)
    data = [("hot", rng.gauss(0, 1000)) for _ in range(3000)]
    data += [("tied", float(rng.randint(-3, 3))) for _ in range(1500)]
    data += [("spread", 10.0 ** rng.uniform(-8, 8)) for _ in range(1000)]
    data += [(f"small{i}", rng.random()) for i in range(40)]
    data += [("single", 7.5)]
    return [(k, round(v, 6)) for k, v in data]


def _by_key(data):
    grouped = defaultdict(list)
    for key, value in data:
        grouped[key].append(value)
    return grouped


@pytest.fixture(scope="module")
def grouped(spark):
    data = _groups(1)
    return data, spark.createDataFrame(data, "k string, v double")


@pytest.mark.parametrize("descending", [False, True])
def test_value_ranks(grouped, descending):
    data, df = grouped
    expected = []
    for key, values in _by_key(data).items():
        ordered = sorted(values, reverse=descending)
        first = {}
        for position, value in enumerate(ordered, 1):
            first.setdefault(value, position)
        expected += [(key, v, first[v]) for v in values]
    got = ordering.value_ranks(df, ["k"], "v", descending).select("k", "v", "rank")
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_percentiles_equal_linear_interpolation(grouped):
    data, df = grouped
    merged = df.groupBy("k", "v").count().withColumnRenamed("count", "n")
    fractions = {"p0": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "p1": 1.0}
    got = {r["k"]: r for r in ordering.linear_percentiles(merged, ["k"], "v", "n", fractions).collect()}
    wanted = _by_key(data)
    assert set(got) == set(wanted)
    for key, values in wanted.items():
        for name, fraction in fractions.items():
            assert got[key][name] == pytest.approx(np.percentile(values, fraction * 100), rel=1e-12)


def test_ordinals_cover_the_table(spark):
    # A third of the ids are packed closely, the others are far apart.
    ids = list(range(10**12, 10**12 + 700)) + [i * 10**14 + 3 for i in range(1400)]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(7)
    got = {r["id"]: r["ordinal"] for r in ordering.with_ordinal(df, "id").collect()}
    assert got == {value: n for n, value in enumerate(sorted(ids), 1)}


def test_ordinals_of_nothing(spark):
    assert ordering.with_ordinal(spark.createDataFrame([], "id long"), "id").count() == 0


def test_cut_points_do_not_depend_on_row_order(spark, grouped):
    _, df = grouped
    merged = df.groupBy("k", "v").count().withColumnRenamed("count", "n")
    one = rows(ordering._cut_points(merged, ["k"], "v", "n"))
    other = rows(ordering._cut_points(merged.repartition(13, "v"), ["k"], "v", "n"))
    assert one == other
    assert max(len(r[1]) for r in one) <= ordering.SLOTS


def test_no_range_holds_a_large_part_of_a_hot_group(grouped):
    _, df = grouped
    merged = df.groupBy("k", "v").count().withColumnRenamed("count", "n")
    hot = merged.where("k = 'hot'")
    largest = ordering._with_ranges(hot, ["k"], "v", "n").groupBy("_range").count().agg({"count": "max"})
    assert largest.first()[0] < hot.count() / 20
