"""The corpus pipeline and the registered queries of the subpackage."""

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from caremetrics.llm.oracle import oracle
from caremetrics.llm.queries import registry
from tests.conftest import SF
from tests.llm.test_exact_and_leaks import _expected, _normal
from tests.llm.test_similarity_and_repeats import _components
from tools.check import compare, open_tables

NATIVE = ["op1_mixing", "op2_license_scan", "op4_url_filters", "op11_order_minhash"]


@pytest.fixture(scope="module")
def con():
    return open_tables(SF)


@pytest.mark.parametrize("key", sorted(oracle()))
def test_same_as_sql(spark, con, key):
    assert compare(registry()[key](spark, SF), con, oracle()[key]) == ""


@pytest.mark.parametrize("key", NATIVE)
def test_native_queries_run_no_python(spark, key):
    df = registry()[key](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_queries_are_registered_and_cover_every_row(spark):
    keys = [k for k in entry_points.queries() if k.startswith("op") and k[2].isdigit()]
    assert sorted(int(k[2:].split("_")[0]) for k in keys) == list(range(1, 14))
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert registry()["op9_quality"](spark, SF).count() == documents
    assert registry()["op1_mixing"](spark, SF).count() == documents


def test_pipeline_matches_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    best = {}
    for i, text in rows:
        key = _normal(text)
        best[key] = min(best.get(key, (0, 1 << 62)), (-len(text), i))
    kept = {i for _, i in best.values()}
    rows = [(i, t) for i, t in rows if i in kept]
    component = _components(rows, 5, 80)
    rows = [(i, t) for i, t in rows if component[i] == i]
    clean = {i for i, t in rows if not _expected(t, items)[-1]}
    result = corpus_pipeline.run(spark, SF)
    assert result.columns == [*docs.columns, "topic", "n_tokens", "weight", "probability", "copies"]
    got = result.collect()
    ids = [r["doc_id"] for r in got]
    assert len(ids) == len(set(ids)) and set(ids) <= clean
    # What the mix leaves out is drawn, and little of it.
    assert len(clean) * 0.5 < len(ids)
    assert all(r["copies"] >= 1 for r in got)


def test_stages_keep_columns_and_stand_an_empty_table(spark, odd, nothing):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, nothing, SF).columns == nothing.columns, name
        assert stage(spark, nothing, SF).count() == 0, name
        assert stage(spark, odd, SF).columns == odd.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, nothing, SF).count() == 0
