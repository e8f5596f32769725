"""Dimension split, keys, upserts, stored flags and the item stream."""

import pytest
from pyspark.sql import functions as F

from caremetrics.operators import ingest, item_store, upsert
from caremetrics.schemas import TABLES, create_tables
from caremetrics.sources import feeds
from caremetrics.streaming import items as stream
from tests.conftest import day, executed_plan, rows, rows_scanned

ITEM = "datasetid long, reportingunitcode string, value double, caveats string"


def test_dimension_has_one_row_per_code(spark):
    df = spark.createDataFrame(
        [("A", "b"), ("A", "a"), ("A", "a"), ("B", None), (None, "x")], "code string, name string"
    )
    assert rows(ingest.split_dim(df, "code", "name")) == [("A", "a"), ("B", None)]


def test_dates_that_do_not_parse_become_null(spark):
    df = spark.createDataFrame(
        [("2020-03-01", "r", 1, "m", "n"), ("1995-1", "r", 2, "m", "n")],
        "reportingstartdate string, reportedmeasurecode string, datasetid long, measurecode string, datasetname string",
    )
    got = ingest.split_datasets(df)
    assert rows(got.select("datasetid", "reportingstartdate", "stored")) == [
        (1, day("2020-03-01"), False),
        (2, None, False),
    ]


def test_item_keys_do_not_collide_and_are_never_null(spark):
    df = spark.createDataFrame(
        [(1, "2H", 1.0, None), (12, "H", 2.0, None), (None, "H", 3.0, None), (4, None, 4.0, None)], ITEM
    )
    assert rows(ingest.with_item_id(df).select("id")) == [("12|H",), ("1|2H",)]


def test_batches_of_twenty_in_id_order(spark):
    df = spark.createDataFrame([(i * 7,) for i in range(45)], "datasetid long")
    got = dict(ingest.batches(df).collect())
    assert got == {i * 7: i // 20 for i in range(45)}


def test_new_rows_keeps_each_unseen_key_once(spark):
    incoming = spark.createDataFrame(
        [("a", 1), ("b", 5), ("b", 2), ("b", 5), (None, 9), ("c", None)], "id string, x int"
    )
    existing = spark.createDataFrame([("a",), ("z",)], "id string")
    assert rows(upsert.new_rows(incoming, existing, "id")) == [("b", 2), ("c", None)]
    with pytest.raises(ValueError):
        upsert.new_rows(incoming.drop("id"), existing, "id")


def test_one_anti_join_and_map_side_merge(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    incoming = spark.range(1000).select((F.col("id") % 7).alias("id"), F.lit("x").alias("x"))
    plan = executed_plan(upsert.new_rows(incoming, spark.range(3), "id"))
    assert plan.count("LeftAnti") == 1
    assert "partial_min" in plan
    # The merge and the join share one shuffle of the incoming rows.
    assert plan.count("Exchange hashpartitioning") == 2


def test_range_of_incoming_ids_reaches_the_stored_files(spark, tmp_path):
    path = str(tmp_path / "stored")
    stored = spark.range(0, 8000, 1, 8).selectExpr("id AS datasetid", "concat(id, '|H') AS id")
    stored.write.parquet(path)
    incoming = spark.createDataFrame([(5, "5|H"), (7, "7|X")], "datasetid long, id string")
    got = upsert.new_rows(incoming, spark.read.parquet(path), "id", within="datasetid")
    assert rows(got) == [(7, "7|X")]
    assert rows_scanned(got) == 1000  # one file of eight


def test_tables_are_created_once_and_appended_to(spark):
    create_tables(spark, buckets=4)
    create_tables(spark, buckets=4)
    assert {t.name for t in spark.catalog.listTables()} >= set(TABLES)
    for name, spec in TABLES.items():
        assert spark.table(name).schema == spec.schema
    items = ingest.with_item_id(
        spark.createDataFrame([(i % 9, f"H{i}", float(i), None) for i in range(60)], ITEM)
    )
    upsert.append_new("info", items.where("datasetid < 5"))
    upsert.append_new("info", items.union(items))
    assert rows(spark.table("info")) == rows(items)


def test_an_append_writes_one_file_per_bucket(spark):
    spark.sql("DROP TABLE IF EXISTS info")
    create_tables(spark, buckets=4)
    items = ingest.with_item_id(spark.createDataFrame([(i, "H", 1.0, None) for i in range(500)], ITEM))
    upsert.append_new("info", items.where("datasetid < 250").repartition(7))
    upsert.append_new("info", items.repartition(9))
    assert len(spark.table("info").inputFiles()) == 8
    assert spark.table("info").count() == 500
    spark.sql("DROP TABLE info")
    assert "CLUSTERED" not in TABLES["hospitals"].ddl(4) and "CLUSTERED" in TABLES["datasets"].ddl(4)


def test_bucketed_tables_join_without_shuffling(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    create_tables(spark, buckets=4)
    joined = spark.table("info").join(spark.table("datasets").where("stored"), "datasetid")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_only_given_ids_become_stored(spark):
    datasets = spark.createDataFrame([(1, False), (2, True), (3, False)], "datasetid long, stored boolean")
    ids = spark.createDataFrame([(3,), (3,), (8,)], "datasetid long")
    assert rows(upsert.mark_stored(datasets, ids)) == [(1, False), (2, True), (3, True)]


def _land(spark, landing, items):
    df = spark.createDataFrame(items, "DataSetId long, ReportingUnitCode string, Value double, Caveats string")
    feeds.publish(df.coalesce(1), landing)


def test_stream_appends_unseen_items_and_survives_redelivery(spark, tmp_path):
    landing, table, ckpt = (str(tmp_path / n) for n in ("landing", "table", "ckpt"))
    first = [(1, "H1", 1.0, None), (1, "NAT", 2.0, "x"), (1, "NAT", 2.0, "x")]
    _land(spark, landing, first)
    stream.run_items_stream(spark, landing, table, ckpt)
    _land(spark, landing, [*first, (2, "H1", None, None), (None, "H9", 3.0, None), (3, None, 1.0, None)])
    stream.run_items_stream(spark, landing, table, ckpt, files_per_trigger=1)
    stream.run_items_stream(spark, landing, table, ckpt)
    got = stream.read_items_table(spark, table)
    expected = [
        (1, "H1", 1.0, None, "1|H1"),
        (1, "NAT", 2.0, "x", "1|NAT"),
        (2, "H1", None, None, "2|H1"),
    ]
    assert rows(got) == expected
    # Dataset 3 had no usable item, so it does not count as stored.
    assert rows(stream.read_stored_ids(spark, table)) == [(1,), (2,)]


def _raw(spark, items, name="file:/a.csv"):
    """Raw records as the stream hands them on."""
    header = ("DataSetId", "ReportingUnitCode", "Value", "Caveats", None, name)
    texts = [(*[None if v is None else str(v) for v in i], None, name) for i in items]
    return spark.createDataFrame([header, *texts], "datasetid string, reportingunitcode string, value string, caveats string, record string, source_file string")


def test_a_micro_batch_counts_once(spark, tmp_path):
    landing, table, ckpt = (str(tmp_path / n) for n in ("landing", "table", "ckpt"))
    _land(spark, landing, [(1, "H1", 1.0, None)])
    stream.run_items_stream(spark, landing, table, ckpt)
    batch = _raw(spark, [(1, "H1", 1.0, None), (2, "H2", 2.0, None)])
    for _ in range(3):
        stream.ingest_epoch(batch, 7, table)
    assert rows(stream.read_items_table(spark, table).select("id")) == [("1|H1",), ("2|H2",)]
    assert rows(stream.read_stored_ids(spark, table)) == [(1,), (2,)]


def test_bad_records_are_put_aside_by_file(spark, tmp_path):
    landing, table, ckpt = (tmp_path / n for n in ("landing", "table", "ckpt"))
    landing.mkdir()
    head = "DataSetId,ReportingUnitCode,Value,Caveats\n"
    (landing / "good.csv").write_text(head + '1,H1,1.5,"two\nlines, and ""quotes"""\n2,H1,,\n')
    (landing / "bad.csv").write_text(head + "3,H1,1,\n3,H2,many,\n4,H1\n4,H2,1,x,y\nfive,H1,1,\n")
    (landing / "bare.csv").write_text("6,H1,1,\n")
    (landing / "empty.csv").write_text("")
    flags = stream.datasets_table(spark, str(tmp_path / "datasets"), 4)
    catalogue = [(day("2020-01-01"), "r", i, "m", f"d{i}", False) for i in range(1, 7)]
    upsert.add_datasets(flags, spark.createDataFrame(catalogue, TABLES["datasets"].schema))
    stream.run_items_stream(spark, str(landing), str(table), str(ckpt), datasets=flags)
    got = rows(stream.read_rejected(spark, str(table)).selectExpr("regexp_extract(source_file, '[a-z]+.csv', 0)", "reason", "record"))
    assert got == [
        ("bad.csv", "columns", "4,H1"), ("bad.csv", "columns", "4,H2,1,x,y"), ("bad.csv", "dataset id", "five,H1,1,"),
        ("bad.csv", "value", "3,H2,many,"), ("bare.csv", "header", "6,H1,1,"),
    ]
    items = rows(stream.read_items_table(spark, str(table)))
    assert items == [(1, "H1", 1.5, 'two\nlines, and "quotes"', "1|H1"), (2, "H1", None, None, "2|H1"), (3, "H1", 1.0, None, "3|H1")]
    assert rows(flags.read().where("stored").select("datasetid")) == [(1,), (2,)]
    # A good delivery afterwards completes the dataset.
    (landing / "again.csv").write_text(head + "3,H1,1,\n3,H2,2,\n")
    stream.run_items_stream(spark, str(landing), str(table), str(ckpt), datasets=flags)
    assert rows(flags.read().where("stored").select("datasetid")) == [(1,), (2,), (3,)]
    assert stream.read_items_table(spark, str(table)).count() == 4


def test_micro_batches_leave_the_rows_of_datasets_and_sum_the_cube_once(spark, tmp_path):
    flags = stream.datasets_table(spark, str(tmp_path / "datasets"), 4)
    catalogue = [(day("2020-01-01"), "r", i, "m", f"d{i}", None if i == 3 else i == 5) for i in range(12)]
    upsert.add_datasets(flags, spark.createDataFrame(catalogue, TABLES["datasets"].schema))
    before = flags.version().files
    landing, table, ckpt = (str(tmp_path / n) for n in ("landing", "table", "ckpt"))
    for i in range(10):
        _land(spark, landing, [(i, "H1", 1.0, None), (i, "NAT", 2.0, None), (i + 90, "H1", 3.0, None)])
    stream.run_items_stream(spark, landing, table, ckpt, 1, flags)
    assert set(map(str, before)) <= set(map(str, flags.version().files))
    assert len([f for f in flags.version().files if f.get("marks")]) <= 4 * 8
    assert rows(flags.read().select("datasetid", "stored")) == rows(spark.createDataFrame([(i, i < 10) for i in range(12)], "datasetid long, stored boolean"))
    store = stream.item_store(spark, table)
    assert store.cube.version().done == {ckpt: store.items.version().done[ckpt]}
    assert len({f["path"].split("/")[0] for f in store.cube.version().files}) == 2  # of eight batches, and of two at the end
    assert rows(store.cube.read()) == rows(item_store.delta_cube(store.rows(), flags.read()))


def test_marks_count_once_and_only_for_rows_that_were_there(spark, tmp_path):
    flags = stream.datasets_table(spark, str(tmp_path), 2)
    listed = lambda ids: spark.createDataFrame([(day("2020-01-01"), "r", i, "m", "d", False) for i in ids], TABLES["datasets"].schema)
    marks = lambda *ids: spark.createDataFrame([(i,) for i in ids], "datasetid long")
    upsert.add_datasets(flags, listed([1, 2, 3]))
    flags.mark(marks(1, 1, 77, None), "a", 0)
    number = flags.mark(marks(2), "a", 1).number
    assert flags.mark(marks(3), "a", 1).number == number
    upsert.add_datasets(flags, listed([1, *range(70, 90)]))  # touches every bucket
    assert not [f for f in flags.version().files if f.get("marks")]
    assert rows(flags.read().where("stored").select("datasetid")) == [(1,), (2,)]
    assert flags.read().count() == 23


def test_a_failed_swap_leaves_the_old_flags_readable(spark, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS datasets")
    create_tables(spark, buckets=4)
    catalogue = [(day("2020-01-01"), "r", i, "m", f"d{i}", False) for i in range(9)]
    upsert.append_new("datasets", spark.createDataFrame(catalogue, TABLES["datasets"].schema))
    before = rows(spark.table("datasets"))
    ids = spark.createDataFrame([(2,), (3,)], "datasetid long")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(upsert, "_point_to", fail)
        with pytest.raises(RuntimeError, match="lost"):
            upsert.store_flags(ids)
    assert rows(spark.table("datasets")) == before
    upsert.store_flags(ids)
    assert rows(spark.table("datasets").where("stored").select("datasetid")) == [(2,), (3,)]
    upsert.append_new("datasets", spark.createDataFrame([(day("2020-01-01"), "r", 77, "m", "d", False)], TABLES["datasets"].schema))
    assert spark.table("datasets").count() == 10 and len(spark.table("datasets").inputFiles()) >= 4
    spark.sql("DROP TABLE datasets")
