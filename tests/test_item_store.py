"""Tables in versions, the levelled item store with its cube, and the key filter."""

import datetime

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremetrics.functions import membership
from caremetrics.operators import item_store, upsert
from caremetrics.operators.item_store import ItemStore
from caremetrics.sources.versions import LevelledTable, VersionedTable
from tests.conftest import day, rows, rows_scanned

ITEM = "datasetid long, reportingunitcode string, value double, caveats string"
DATASET = "datasetid long, measurecode string, reportedmeasurecode string, reportingstartdate date"


def _items(spark, ids, units=3):
    return spark.createDataFrame([(i, f"H{u}", float(i * 10 + u), None) for i in ids for u in range(units)], ITEM)


def _datasets(spark, n):
    return spark.createDataFrame([(i, f"m{i % 2}", "r", day("2020-01-01") + datetime.timedelta(i % 40)) for i in range(n)], DATASET)


def _summed(store, datasets):
    """The cube recomputed from all items."""
    return rows(item_store.delta_cube(store.rows(), datasets, store.exact_scale))


@pytest.mark.parametrize("exact_scale", [2, None])
def test_the_cube_equals_a_recompute_after_overlapping_deliveries(spark, tmp_path, exact_scale):
    store, datasets = ItemStore(spark, str(tmp_path), 8, exact_scale), _datasets(spark, 60)
    for number, ids in enumerate([range(0, 30), range(20, 50), range(0, 60), []]):
        assert store.add(_items(spark, ids), number)
        store.refresh_cube(datasets)
        assert rows(store.cube.read()) == _summed(store, datasets)
    assert not store.add(_items(spark, range(70)), 2)
    assert store.rows().count() == 180
    # Refreshing again, or late, counts nothing twice.
    before = store.cube.version().number
    store.refresh_cube(datasets)
    assert store.cube.version().number == before
    store.add(_items(spark, range(5), units=5), 4)
    store.add(_items(spark, range(5), units=6), 5)
    store.refresh_cube(datasets)
    assert rows(store.cube.read()) == _summed(store, datasets)


def test_a_delivery_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    store, datasets = ItemStore(spark, str(tmp_path), 32), _datasets(spark, 60)
    store.add(_items(spark, range(40)), 0)
    store.refresh_cube(datasets)
    before = {f["path"] for f in store.cube.version().files}
    store.add(_items(spark, [41]), 1)
    store.refresh_cube(datasets)
    after = {f["path"] for f in store.cube.version().files}
    assert len(before) > 10 and len(before - after) <= 1 and len(after - before) == 1


def test_values_that_are_missing_are_not_counted(spark, tmp_path):
    store = ItemStore(spark, str(tmp_path), 4)
    store.add(spark.createDataFrame([(1, "H1", float("nan"), None), (1, "H2", None, None), (1, "H3", 2.0, None), (None, "H4", 1.0, None)], ITEM), 0)
    store.refresh_cube(_datasets(spark, 3))
    assert [tuple(r)[2:] for r in store.cube.read().collect()] == [("H3", day("2020-01-02"), 2.0, 1)]
    assert store.rows().count() == 3


def test_a_hundred_deliveries_leave_few_files_and_level_reads(spark, tmp_path, monkeypatch):
    store = ItemStore(spark, str(tmp_path), fan=4, rows_per_file=100, with_cube=False)
    scanned = []
    plain = item_store.new_rows

    def counted(keyed, met, key, within=None):
        scanned.append(sum(1 for _ in met.inputFiles()))
        return plain(keyed, met, key, within)

    monkeypatch.setattr(item_store, "new_rows", counted)
    for number in range(100):
        # Ids do not come in order, and one dataset in each delivery was there before.
        ids = [(number * 37) % 101 + 1000 * number % 7, (number * 37 + 64) % 101]
        store.add(_items(spark, ids, 2), number)
    files = store.items.version().files
    assert len({f["run"] for f in files}) <= 3 * 4 + 1 and len(files) <= 3 * 4 + 400 // 50
    assert max(f["level"] for f in files) >= 3
    assert max(scanned[60:]) <= 2 * 3 * 4
    whole = rows(store.rows())
    assert len(whole) == len({r[-1] for r in whole})
    for number in (3, 99):
        store.add(_items(spark, [number], 2), number)
    store.add(_items(spark, [(99 * 37) % 101 + 99000 % 7], 2), 100)
    assert rows(store.rows()) == whole
    assert len(store.items.vacuum()) > 50
    assert rows(store.rows()) == whole
    assert len(store.items.version_numbers()) == 2


@pytest.mark.parametrize("step", ["write_sorted", "commit"])
def test_a_failure_before_the_swap_changes_nothing(spark, tmp_path, monkeypatch, step):
    store, datasets = ItemStore(spark, str(tmp_path), 4), _datasets(spark, 20)
    store.add(_items(spark, range(5)), 0)
    store.refresh_cube(datasets)
    items, cube = rows(store.rows()), rows(store.cube.read())
    plain = getattr(VersionedTable, step)

    def fail(self, *args, **kwargs):
        if step == "write_sorted":
            plain(self, *args, **kwargs)
        raise RuntimeError("lost")

    def refuse(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, step, fail)
        with pytest.raises(RuntimeError, match="lost"):
            store.add(_items(spark, range(9)), 1)
    assert rows(store.rows()) == items and rows(store.cube.read()) == cube
    # The items are in, the cube is not: it catches up.
    store.add(_items(spark, range(9)), 1)
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "commit", refuse)
        with pytest.raises(RuntimeError, match="lost"):
            store.refresh_cube(datasets)
    assert rows(store.cube.read()) == cube
    store.refresh_cube(datasets)
    assert rows(store.cube.read()) == _summed(store, datasets)
    assert store.items.vacuum(keep=1) and store.rows().count() == 27


def test_a_second_writer_is_refused(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), spark.range(1).schema, ["id"], 4)
    base = table.version()
    table.merge(spark.range(10), lambda old, new: old.union(new))
    with pytest.raises(RuntimeError, match="another writer"):
        table.commit(base, [])
    assert rows(table.read()) == [(i,) for i in range(10)]
    old = table.version()
    table.merge(spark.range(10, 12), lambda old, new: old.union(new))
    assert table.read(table.version(old.number).files).count() == 10


def test_the_key_filter_never_misses(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) AS key")
    words = membership.words_for(5000)
    asked = spark.range(100_000).selectExpr("concat('k', id) AS key", "id")
    kept = asked.where(membership.may_hold(membership.key_filter(keys, "key", words), F.col("key"), words))
    assert kept.where("id < 5000").count() == 5000
    assert kept.where("id >= 5000").count() < 95_000 * 0.05
    assert membership.words_for(1 << 30) is None
    none = membership.key_filter(keys.limit(0), "key", 64)
    assert asked.where(membership.may_hold(none, F.col("key"), 64)).count() == 0


def _shuffled(df):
    """Rows written to shuffles by an executed plan."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        elif name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_the_filter_spares_the_stored_side_its_shuffle(spark, tmp_path, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    path = str(tmp_path / "stored")
    spark.range(40_000).selectExpr("id AS datasetid", "concat(id, '|H') AS id").write.parquet(path)
    stored = spark.read.parquet(path)
    incoming = spark.range(0, 40_000, 100).selectExpr("id AS datasetid", "if(id % 200 = 0, concat(id, '|H'), concat(id, '|X')) AS id")
    plain = incoming.join(stored.select("id"), "id", "left_anti")
    got = upsert.new_rows(incoming, stored, "id", within="datasetid")
    assert rows(got.select("datasetid", "id")) == rows(plain.select("datasetid", "id"))
    assert _shuffled(upsert.new_rows(incoming, stored, "id", within="datasetid")) < 4_000 < 40_000 <= _shuffled(upsert.new_rows(incoming, stored, "id"))
    assert rows_scanned(got) >= 40_000


def test_a_delivery_to_all_buckets_leaves_earlier_sums_in_place(spark, tmp_path):
    store, datasets = ItemStore(spark, str(tmp_path), 2, fan=3), _datasets(spark, 60)
    for number in range(7):
        before = {f["path"] for f in store.cube.version().files}
        store.add(_items(spark, range(8 * number, 8 * number + 8)), number)
        store.refresh_cube(datasets)
        after = store.cube.version().files
        if number in (1, 3, 4):  # no level is full
            assert before < {f["path"] for f in after}
        assert rows(store.cube.read()) == _summed(store, datasets)
    assert len(after) <= 2 * 2 * 3 and max(f["level"] for f in after) >= 1
    assert store.cube.vacuum(keep=1) and rows(store.cube.read()) == _summed(store, datasets)


def test_a_run_is_written_by_as_many_tasks_as_its_rows_are_worth(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(item_store, "ROWS_PER_TASK", 100)
    store = ItemStore(spark, str(tmp_path), with_cube=False)
    store.add(_items(spark, range(200)), 0)
    files = store.items.version().files
    assert len(files) == min(6, spark.sparkContext.defaultParallelism)
    assert sum(f["rows"] for f in files) == 600


def test_distinct_values_in_levels(spark, tmp_path):
    table = LevelledTable(spark, str(tmp_path), spark.range(1).schema, ["id"], 4, DataFrame.distinct, fan=2)
    for number in range(5):
        table.add(spark.range(10 * number, 10 * number + 15), "w", number)
    table.add(spark.range(99), "w", 3)  # was there before
    assert sorted(r[0] for r in table.read().collect()) == list(range(55))


def test_copies_of_a_delivery_are_merged_once(spark, tmp_path, monkeypatch):
    merged = []
    plain = upsert.one_row_per_key

    def counted(df, key):
        merged.append(key)
        return plain(df, key)

    monkeypatch.setattr(upsert, "one_row_per_key", counted)
    monkeypatch.setattr(item_store, "one_row_per_key", counted)
    store = ItemStore(spark, str(tmp_path), with_cube=False)
    twice = _items(spark, range(10)).unionByName(_items(spark, range(5)))
    for number in range(2):
        merged.clear()
        store.add(twice.unionByName(_items(spark, range(100 * number, 100 * number + 9))), number)
        assert merged == ["id"]
    whole = rows(store.rows())
    assert len(whole) == len({r[-1] for r in whole}) == 3 * 19
