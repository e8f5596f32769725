"""Text feeds: headers, quoting, strictness, bounded files."""

import os

import pytest

from caremetrics.schemas import CELLS
from caremetrics.schemas import ITEMS_FILE
from caremetrics.sources import feeds
from caremetrics.sources.literals import literal_rows
from caremetrics.sources.tables import fetch, jdbc_options
from tests.conftest import rows

HEADER = "DataSetId,ReportingUnitCode,Value,Caveats"


def _write(folder, *texts):
    folder.mkdir(exist_ok=True)
    for i, text in enumerate(texts):
        (folder / f"{i}.csv").write_bytes(text.encode())
    return str(folder)


def test_each_file_owns_its_header_and_final_newline_is_optional(spark, tmp_path):
    path = _write(tmp_path / "in", f"{HEADER}\n1,H1,2.5,\n2,H2,,low", f"{HEADER}\n3,NAT,4,\n")
    got = feeds.read_items(spark, path)
    assert got.columns == ["datasetid", "reportingunitcode", "value", "caveats"]
    assert rows(got) == [(1, "H1", 2.5, None), (2, "H2", None, "low"), (3, "NAT", 4.0, None)]


def test_quoted_text_and_windows_line_ends(spark, tmp_path):
    path = _write(
        tmp_path / "in", f'{HEADER}\r\n1,H1,1,"two\nlines, a ""quote"""\r\n2,H2,2,plain\r\n'
    )
    assert rows(feeds.read_items(spark, path)) == [
        (1, "H1", 1.0, 'two\nlines, a "quote"'),
        (2, "H2", 2.0, "plain"),
    ]


@pytest.mark.parametrize(
    "text",
    [
        "ReportingUnitCode,DataSetId,Value,Caveats\nH1,1,2,\n",  # other column order
        f"{HEADER}\n1,H1,many,\n",  # not a number
    ],
)
def test_unexpected_content_fails(spark, tmp_path, text):
    with pytest.raises(Exception):
        feeds.read_items(spark, _write(tmp_path / "in", text)).collect()


def test_published_files_are_bounded_and_read_back(spark, tmp_path):
    landing = str(tmp_path / "landing")
    df = spark.range(25).selectExpr(
        "id AS DataSetId", "'H' AS ReportingUnitCode", "id / 4 AS Value", "'a\"b\n,c' AS Caveats"
    )
    feeds.publish(df.coalesce(1), landing, records_per_file=10)
    feeds.publish(df.coalesce(1).limit(0), landing)
    files = [f for f in os.listdir(landing) if f.endswith(".csv")]
    assert len(files) >= 3
    assert rows(feeds.read_items(spark, landing)) == rows(df)


def test_directory_columns_are_found_by_header_text(spark):
    heads = list(feeds.DIRECTORY_COLUMNS)[::-1]  # another column order than usual
    values = dict(zip(feeds.DIRECTORY_COLUMNS, "H1,Alpha,Hospital,-1.5,130,Public,Open,NSW,L,P".split(",")))
    cells = [("Directory", "Hospitals", 3, i, h) for i, h in enumerate(heads)]
    cells += [("Directory", "Hospitals", 4, i, values[h]) for i, h in enumerate(heads)]
    cells += [("Directory", "Hospitals", 0, 0, "Title"), ("Other", "Hospitals", 4, 0, "no")]
    got = feeds.read_hospitals(literal_rows(spark, cells, CELLS))
    assert rows(got) == [("H1", "Alpha", "Hospital", -1.5, 130.0, "Public", "Open", "NSW", "L", "P")]


def test_bad_coordinate_raises(spark):
    cells = [
        ("Directory", "Hospitals", 3, 0, "Code"),
        ("Directory", "Hospitals", 3, 1, "Latitude"),
        ("Directory", "Hospitals", 4, 0, "H1"),
        ("Directory", "Hospitals", 4, 1, "north"),
    ]
    with pytest.raises(Exception):
        feeds.read_hospitals(literal_rows(spark, cells, CELLS)).collect()


def test_sql_parameters_are_values(spark):
    df = spark.createDataFrame([("O'Neil",), ("x' OR '1'='1",)], "name string")
    text = "SELECT name FROM {people} WHERE name = :wanted"
    assert rows(fetch(spark, text, {"wanted": "O'Neil"}, people=df)) == [("O'Neil",)]
    assert rows(fetch(spark, text, {"wanted": "' OR '1'='1"}, people=df)) == []


def test_jdbc_scan_is_split():
    options = jdbc_options(
        "jdbc:x", "info", "d.Driver", "datasetid", lower=0, upper=100, partitions=8, user="u"
    )
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "datasetid"
    assert options["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "info", "d.Driver", "datasetid")


def test_judging_files_moves_no_records(spark, tmp_path, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    landing = str(tmp_path / "landing")
    items = spark.createDataFrame([(i, "H1", float(i), None) for i in range(50)], ITEMS_FILE)
    feeds.publish(items, landing)
    judged = feeds.judged_items(feeds.read_raw_items(spark, landing))
    assert judged.count() == 50
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
