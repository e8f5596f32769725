"""Raking against plain Python, at both plans, and when targets are far or contradict each other."""

import time

import pytest
from pyspark.sql import functions as F

from caremetrics.llm import mixing
from caremetrics.llm.components import connected
from tests.llm.conftest import ODD, SHAPE

CELLS = "source__cell string, lang__cell string, topic__cell string, tokens double"


def _parts(cells, at, target):
    held = {}
    for cell in cells:
        held[cell[at]] = held.get(cell[at], 0.0) + cell[3]
    held = {v: n for v, n in held.items() if n > 0}
    if isinstance(target, dict):
        given = {v: target[v] for v in held if v in target}
        rest = sum(n for v, n in held.items() if v not in given) or 1
        spare = max(0.0, 1 - sum(given.values()))
        parts = {v: given[v] if v in given else n / rest * spare for v, n in held.items()}
    else:
        parts = {v: n**target for v, n in held.items()}
    whole, total = sum(parts.values()), sum(c[3] for c in cells)
    return {v: p / whole * total for v, p in parts.items()}


def _ipf(cells, targets, sweeps):
    weights = [c[3] for c in cells]
    aims = [_parts(cells, at, target) for at, target in enumerate(targets)]
    for _ in range(sweeps):
        for at, aim in enumerate(aims):
            held = {}
            for cell, w in zip(cells, weights):
                held[cell[at]] = held.get(cell[at], 0.0) + w
            weights = [w * aim[c[at]] / held[c[at]] if held[c[at]] else w for c, w in zip(cells, weights)]
    return {c[:3]: w for c, w in zip(cells, weights)}


TABLE = [(s, l, t, float(50 + 37 * i % 211)) for i, (s, l, t) in enumerate((s, l, t) for s in "abcd" for l in "xyz" for t in "pq") if i % 5]


@pytest.mark.parametrize("small_cells", [mixing.SMALL_CELLS, 0])
def test_raking_matches_plain_python(spark, small_cells):
    targets = {"source": {"a": 0.4, "d": 0.1}, "lang": 0.5, "topic": 0.8}
    df = spark.createDataFrame(TABLE, CELLS)
    raked = mixing.rake(df, targets, tolerance=1e-6, small_cells=small_cells)
    got = {tuple(r)[:3]: r["weight"] for r in raked.collect()}
    assert got == pytest.approx(_ipf(TABLE, list(targets.values()), 200), rel=1e-4)


def test_many_sweeps_end(spark):
    # No cell joins b and x, so that the cell of a and y has to vanish, which takes ever smaller steps.
    cells = [("a", "x", "p", 1000.0), ("a", "y", "p", 1000.0), ("b", "y", "p", 1000.0)]
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.5, "y": 0.5}, "topic": 1.0}
    start = time.time()
    raked = mixing.rake(spark.createDataFrame(cells, CELLS), targets, tolerance=0.012)
    got = {tuple(r)[:3]: r["weight"] for r in raked.collect()}
    assert time.time() - start < 60
    assert _ipf(cells, list(targets.values()), 36)["a", "y", "p"] > got["a", "y", "p"] > 0
    held = got["a", "x", "p"] + got["a", "y", "p"]
    assert held == pytest.approx(1500, rel=0.012) and got["a", "x", "p"] == pytest.approx(1500, rel=0.012)


def test_contradicting_targets_are_told(spark):
    cells = [("a", "x", "p", 10.0), ("b", "y", "p", 10.0)]
    df = spark.createDataFrame(cells, CELLS)
    with pytest.warns(UserWarning, match="not met"):
        raked = mixing.rake(df, {"source": {"a": 0.2, "b": 0.8}, "lang": {"x": 0.7, "y": 0.3}}).collect()
    assert {r["lang__cell"]: round(r["weight"], 6) for r in raked} == {"x": 14.0, "y": 6.0}


def test_no_helper_column_clashes(spark, odd):
    names = ("expected", "cell_source", "held", "part", "given", "before", "aim", "factor", "tokens", "documents")
    got = mixing.mixed(odd.withColumns({n: F.lit(n) for n in names}))
    rows = got.collect()
    assert len(rows) == len(ODD) and all(r[n] == n for r in rows for n in names)


def test_topics_are_the_most_frequent_marks(spark):
    texts = {
        "none": [None, "", " \t\n"],
        "prose": ["Plain words only.", "one"],
        "license": ["Permission is granted under this license, without warranty."],
        "contact": ["Write to someone@example.org or phone us"],
        "table": ["a | b | c | d"],
        "code": ["def f() {\n return x;\n}\n"],
        "web": ["see https://example.org and click"],
        "list": ["one\n- two\n- three"],
        "question": ["who? what?"],
    }
    rows = [(name, text) for name, group in texts.items() for text in group]
    df = spark.createDataFrame(rows, "name string, text string")
    assert [tuple(r) for r in df.select("name", mixing.topic_of(F.col("text"))).collect() if r[0] != r[1]] == []


def test_components_of_a_long_chain_end(spark):
    start = time.time()
    chain = spark.range(5000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected(chain)
    assert got.where("label != 0").count() == 0 and got.select("id").distinct().count() == 5001
    assert time.time() - start < 60


def test_the_mix_of_an_empty_table(spark):
    assert mixing.mixed(spark.createDataFrame([], SHAPE)).count() == 0
