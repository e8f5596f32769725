"""What the physical plans of all queries must and must not contain."""

import re

import pytest

from caremetrics.plans.queries import registry
from tests.conftest import SF

# These run jobs while the plan is built (files are written or models fitted).
EAGER = {
    "scan_catalogue",
    "scan_items",
    "stream_items_upsert",
    "stream_mark_stored",
    "append_twice",
    "daily_ingest",
    "budget_regression",
    "predict_scenarios",
    "wide_targets",
    "lm_design",
    "lm_multi",
    "lm_elastic_net",
    "lm_targets",
    "heldout_error",
}
QUERIES = {k: q for k, q in registry().items() if k not in EAGER}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_no_cross_join(spark, key):
    plan = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize(
    "key, columns",
    [
        ("storage_overview", "struct<o_orderkey:bigint>"),
        ("pending_datasets", "struct<o_orderkey:bigint>"),
        ("train_test_split", "struct<o_orderkey:bigint>"),
        ("state_sector_counts", "struct<s_suppkey:bigint,s_nationkey:int>"),
    ],
)
def test_scans_read_only_what_is_used(spark, key, columns):
    plan = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: {columns}" in plan


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_one_task_gathers_partial_sums_only(spark, key):
    """What goes to a single task is one row per task, the partial result of an
    aggregate, or the counts of value ranges, whose number is bounded."""
    lines = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert re.search(r"Aggregate\(keys=\[(\], functions=\[partial_|_range#\d+\])", lines[at + 1]), lines[at + 1]
