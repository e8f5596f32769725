"""Reporting tables derived from the given star-schema tables.

Every stand-in is a lazy DataFrame over the whole Parquet inputs, so the work of
a query grows with them. The SQL twins live in ``plans/oracle.py``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremetrics.schemas import CELLS, NATIONAL_UNIT
from caremetrics.sources.literals import literal_rows

# Declared, so that planning a query opens no file footers.
_GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


@dataclass(frozen=True)
class CareTables:
    datasets: DataFrame
    hospitals: DataFrame
    measurements: DataFrame
    reported_measurements: DataFrame
    info: DataFrame


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_GIVEN[table]).parquet(f"{sf_dir}/{table}.parquet")


def hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = F.col("s_suppkey") % 20 != 0
    return (
        given(spark, sf_dir, "supplier")
        .join(given(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(given(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("code"),
            F.col("s_name").alias("name"),
            F.lit("Hospital").alias("type"),
            F.when(located, (-10 - F.col("s_suppkey") % 34).cast("double")).alias("latitude"),
            F.when(located, (113 + F.col("s_suppkey") % 40).cast("double")).alias("longitude"),
            F.when(F.col("r_name") == "EUROPE", "Public")
            .when(F.col("s_suppkey") % 3 == 0, "Private")
            .otherwise("Public")
            .alias("sector"),
            F.when(F.col("s_acctbal") < 0, "Closed").otherwise("Open").alias("open_closed"),
            F.col("r_name").alias("state"),
            F.col("n_name").alias("lhn"),
            F.lit(None).cast("string").alias("phn"),
        )
    )


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "orders").select(
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("reportingstartdate"),
        F.col("o_orderstatus").alias("reportedmeasurecode"),
        F.col("o_orderkey").alias("datasetid"),
        F.col("o_orderpriority").alias("measurecode"),
        F.concat("o_orderpriority", F.lit(" / "), "o_orderstatus").alias("datasetname"),
        (F.col("o_orderkey") % 4 != 0).alias("stored"),
    )


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        given(spark, sf_dir, "orders")
        .select(F.col("o_orderpriority").alias("measurecode"))
        .distinct()
        .withColumn("measurename", F.expr("substring(measurecode, 3)"))
    )


def reported_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("reportedmeasurecode")
    return (
        given(spark, sf_dir, "orders")
        .select(F.col("o_orderstatus").alias("reportedmeasurecode"))
        .where(code != "P")
        .distinct()
        .withColumn("reportedmeasurename", F.when(code == "F", "Final").otherwise("Open"))
    )


def info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (dataset, unit) and one national row per dataset."""
    lines = given(spark, sf_dir, "lineitem")
    order, unit = F.col("l_orderkey"), F.col("l_suppkey").cast("string")
    per_unit = lines.groupBy("l_orderkey", "l_suppkey").agg(F.min("l_extendedprice").alias("price"))
    per_order = lines.groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("price"))
    units = per_unit.select(
        order.alias("datasetid"),
        unit.alias("reportingunitcode"),
        F.when(order % 53 != 0, F.col("price")).alias("value"),
        F.when(order % 10 == 0, "estimated").alias("caveats"),
        F.concat_ws("|", order.cast("string"), unit).alias("id"),
    )
    national = per_order.select(
        order.alias("datasetid"),
        F.lit(NATIONAL_UNIT).alias("reportingunitcode"),
        F.col("price").alias("value"),
        F.lit(None).cast("string").alias("caveats"),
        F.concat_ws("|", order.cast("string"), F.lit(NATIONAL_UNIT)).alias("id"),
    )
    return units.unionByName(national)


def tables(spark: SparkSession, sf_dir: str) -> CareTables:
    return CareTables(
        datasets(spark, sf_dir),
        hospitals(spark, sf_dir),
        measurements(spark, sf_dir),
        reported_measurements(spark, sf_dir),
        info(spark, sf_dir),
    )


def catalogue_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the catalogue feed: mixed-case names, dates as text, some malformed."""
    month = F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "month"), "yyyy-MM-dd")
    return given(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 97 == 0, "1995-1").otherwise(month).alias("ReportingStartDate"),
        F.col("o_orderstatus").alias("ReportedMeasureCode"),
        F.when(F.col("o_orderstatus") == "F", "Final")
        .when(F.col("o_orderstatus") == "O", "Open")
        .alias("ReportedMeasureName"),
        F.col("o_orderpriority").alias("MeasureCode"),
        F.expr("substring(o_orderpriority, 3)").alias("MeasureName"),
        F.col("o_orderkey").alias("DataSetId"),
        F.concat("o_orderpriority", F.lit(" / "), "o_orderstatus").alias("DataSetName"),
    )


def items_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the data-items feed."""
    return info(spark, sf_dir).select(
        F.col("datasetid").alias("DataSetId"),
        F.col("reportingunitcode").alias("ReportingUnitCode"),
        F.col("value").alias("Value"),
        F.col("caveats").alias("Caveats"),
    )


# --- workbooks -------------------------------------------------------------

# The eight state labels a customer's nation is mapped to, in sheet order.
STATES = ["NSW", "VIC", "QLD", "SA", "WA", "TAS", "ACT", "NT"]
# Column labels of the per-person sheet, in sheet order (no ACT there).
PER_PERSON_STATES = ["NSW", "VIC", "QLD", "WA", "SA", "TAS", "NT"]


def half_year(date: Column) -> Column:
    """0 for the first half of 1995, 1 for the second, …"""
    return ((F.year(date) - 1995) * 2 + F.when(F.month(date) > 6, 1).otherwise(0)).cast("int")


def year_label(period: Column) -> Column:
    """Period 0 -> ``2011–12`` and so on, with an en dash."""
    start = 2011 + period
    return F.concat(
        start.cast("string"), F.lit("–"), F.lpad(((start + 1) % 100).cast("string"), 2, "0")
    )


def _money(df: DataFrame, *keys: str) -> DataFrame:
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
    return df.groupBy(*keys).agg(total.alias("total"), F.count("*").alias("n"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "orders").withColumn(
        "period", half_year(F.col("o_orderdate").cast("date"))
    )


def period_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(_orders(spark, sf_dir), "period")


def state_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(period, state, total). Orders are summed per customer's nation."""
    customers = given(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    per_nation = _money(
        _orders(spark, sf_dir).join(customers, F.col("o_custkey") == F.col("c_custkey")),
        "period",
        "c_nationkey",
    )
    labels = F.array(*[F.lit(s) for s in STATES])
    state = F.element_at(labels, (F.col("c_nationkey") % 8 + 1).cast("int"))
    return per_nation.groupBy("period", state.alias("state")).agg(F.sum("total").alias("total"))


def _grid(df: DataFrame, workbook: str, sheet: str, row_no: Column, cells: dict[int, Column]) -> DataFrame:
    """Turn each row of ``df`` into the cells of one sheet row."""
    pairs = F.array(
        *[
            F.struct(F.lit(col_no).alias("col_no"), text.cast("string").alias("cell"))
            for col_no, text in cells.items()
        ]
    )
    return df.select(row_no.cast("int").alias("row_no"), F.explode(pairs).alias("pair")).select(
        F.lit(workbook).alias("workbook"),
        F.lit(sheet).alias("sheet"),
        "row_no",
        F.col("pair.col_no").alias("col_no"),
        F.col("pair.cell").alias("cell"),
    )


def _notes(spark: SparkSession, workbook: str, sheet: str, rows: dict[int, list[str | None]]) -> DataFrame:
    """Literal heading and note rows of one sheet."""
    cells = [
        (workbook, sheet, row_no, col_no, text)
        for row_no, texts in rows.items()
        for col_no, text in enumerate(texts)
    ]
    return literal_rows(spark, cells, CELLS)


def directory_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hospital directory sheet: three lead rows, a header row, one row per hospital."""
    header = [
        "Code",
        "Name",
        "Type",
        "Latitude",
        "Longitude",
        "Sector",
        "Open/Closed",
        "State",
        "Local Hospital Network (LHN)",
        "Primary Health Network area (PHN)",
    ]
    base = hospitals(spark, sf_dir)
    columns = {i: F.col(name) for i, name in enumerate(base.columns)}
    rows = _grid(base, "Directory", "Hospitals", F.col("code").cast("int") + 4, columns)
    lead = {0: ["Hospital directory"], 1: ["Updated monthly"], 2: [None], 3: header}
    return _notes(spark, "Directory", "Hospitals", lead).unionByName(rows)


def stay_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table 2.9: two blocks of three hospital types by year, averages at the right."""
    period = half_year(F.col("l_shipdate").cast("date"))
    per_cell = (
        given(spark, sf_dir, "lineitem")
        .groupBy(
            period.alias("period"),
            F.when(F.col("l_linestatus") == "O", 0).otherwise(1).alias("block"),
            F.when(F.col("l_returnflag") == "A", 0)
            .when(F.col("l_returnflag") == "N", 1)
            .otherwise(2)
            .alias("kind"),
        )
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("days"), F.count("*").alias("n"))
    )
    hundredths = F.expr("days * 100 div n").cast("decimal(18,0)")
    text = (hundredths * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")
    body = per_cell.select(
        F.lit("Admitted Patients").alias("workbook"),
        F.lit("Table 2.9").alias("sheet"),
        (4 + F.col("block") * 3 + F.col("kind")).cast("int").alias("row_no"),
        (1 + F.col("period")).cast("int").alias("col_no"),
        text.cast("string").alias("cell"),
    )
    header = per_cell.select("period").distinct().select(
        F.lit("Admitted Patients").alias("workbook"),
        F.lit("Table 2.9").alias("sheet"),
        F.lit(2).alias("row_no"),
        (1 + F.col("period")).cast("int").alias("col_no"),
        year_label(F.col("period")).alias("cell"),
    )
    kinds = ["Acute", "Subacute", "Other"]
    rows: dict[int, list[str | None]] = {
        0: ["Average length of stay"],
        1: [None],
        3: ["Public hospitals"],
        10: ["All hospitals"],
    }
    for i in range(6):
        rows[4 + i] = [kinds[i % 3]]
    # The two summary columns at the right edge of the sheet.
    summary = [
        ("Admitted Patients", "Table 2.9", row_no, col_no, text)
        for col_no, head in ((98, "Average since 2018–19"), (99, "Since 2021–22"))
        for row_no, text in ((2, head), *((r, "0.0") for r in range(4, 10)))
    ]
    side = literal_rows(spark, summary, CELLS)
    notes = _notes(spark, "Admitted Patients", "Table 2.9", rows)
    return notes.unionByName(side).unionByName(header).unionByName(body)


def expenditure_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables 1, 4, 5 and 7 of the expenditure workbook."""
    book = "Expenditure"
    totals = period_totals(spark, sf_dir)
    period, total, n = F.col("period"), F.col("total"), F.col("n")
    unpublished = F.lit("n.p.")

    table_1 = _grid(
        totals,
        book,
        "Table 1",
        4 + period,
        {
            0: year_label(period),
            1: total,
            2: (total * 2).cast("decimal(38,2)"),
            3: F.lit(None),
            4: F.when(period == 0, unpublished).otherwise((n * 2).cast("string")),
            5: F.when(period % 3 == 0, unpublished).otherwise(n.cast("string")),
        },
    )
    notes_1 = {
        0: ["Health spending"],
        1: ["Year", "Current prices", "Constant prices", None, "Nominal", "Real"],
        2: [None, "$ million", "$ million", None, "%", "%"],
        3: [None],
    }

    states = state_totals(spark, sf_dir)
    order_4 = F.array(*[F.lit(s) for s in STATES])
    figure = F.when((F.col("state") == "NT") & (period % 5 == 0), unpublished).otherwise(
        total.cast("string")
    )
    cells_4 = states.select(
        F.lit(book).alias("workbook"),
        F.lit("Table 4").alias("sheet"),
        (2 + period).cast("int").alias("row_no"),
        (F.array_position(order_4, F.col("state")) * 2 - 1).cast("int").alias("col_no"),
        figure.alias("cell"),
    )
    spacers_4 = {col_no: F.lit(None) for col_no in range(2, 17, 2)}
    rows_4 = _grid(totals, book, "Table 4", 2 + period, {0: year_label(period), 17: total, **spacers_4})
    notes_4 = {0: ["Spending by state"], 1: ["Year", "NSW", None, "Vic"]}

    order_5 = F.array(*[F.lit(s) for s in PER_PERSON_STATES])
    cells_5 = states.where(F.col("state") != "ACT").select(
        F.lit(book).alias("workbook"),
        F.lit("Table 5").alias("sheet"),
        (5 + period).cast("int").alias("row_no"),
        (F.array_position(order_5, F.col("state")) * 3 - 2).cast("int").alias("col_no"),
        total.cast("string").alias("cell"),
    )
    rows_5 = _grid(
        totals,
        book,
        "Table 5",
        5 + period,
        {0: year_label(period), 2: F.lit("r"), 3: F.lit(None), 22: total, 23: F.lit("r")},
    )
    notes_5 = {0: ["Spending per person"], 2: ["Year", "NSW"], 3: [None], 4: [None, "$"]}

    table_7 = _grid(
        totals,
        book,
        "Table 7",
        3 + period,
        {
            0: year_label(period),
            1: F.lit(None),
            4: total,
            5: F.lit(None),
            6: F.when(period % 4 == 0, unpublished).otherwise(n.cast("string")),
        },
    )
    notes_7 = {0: ["Ratio to GDP"], 1: ["Year"], 2: [None], 40: ["Source: national accounts"]}

    parts = [
        _notes(spark, book, "Table 1", notes_1),
        table_1,
        _notes(spark, book, "Table 4", notes_4),
        rows_4,
        cells_4,
        _notes(spark, book, "Table 5", notes_5),
        rows_5,
        cells_5,
        _notes(spark, book, "Table 7", notes_7),
        table_7,
    ]
    cells = parts[0]
    for part in parts[1:]:
        cells = cells.unionByName(part)
    return cells


def population_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population by year (total in the last column) and three-way projections."""
    totals = period_totals(spark, sf_dir)
    period, n = F.col("period"), F.col("n")
    history = _grid(
        totals,
        "Population",
        "Sheet 1",
        2 + period,
        {0: (2011 + period).cast("string"), 1: F.expr("n div 2"), 2: F.expr("n - n div 2"), 3: n},
    )
    notes = {0: ["Population"], 1: ["Year", "Males", "Females", "Persons"], 60: ["Source: census"]}
    base = totals.agg(F.expr("sum(n) div 14").alias("base"))
    future = base.select("base", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("step"))
    projected = _grid(
        future,
        "Population Projections",
        "Sheet 1",
        2 + F.col("step"),
        {
            0: 2025 + F.col("step"),
            1: F.expr("base * (110 + 10 * step) div 100"),
            2: F.expr("base * (105 + 5 * step) div 100"),
            3: F.expr("base * (100 + step) div 100"),
            4: F.expr("base * (100 - step) div 100"),
        },
    )
    heads = {0: ["Projections"], 1: ["Year", "High", "Medium", "Low", "Zero net overseas migration"]}
    return (
        _notes(spark, "Population", "Sheet 1", notes)
        .unionByName(history)
        .unionByName(_notes(spark, "Population Projections", "Sheet 1", heads))
        .unionByName(projected)
    )


def info_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean value per (half-year, state) and per half-year nationally, shaped like ``info``."""
    t = tables(spark, sf_dir)
    dated = t.info.join(t.datasets.select("datasetid", "reportingstartdate"), "datasetid").select(
        (half_year(F.col("reportingstartdate")) + 1).alias("period"), "reportingunitcode", "value"
    )
    # Collapse to (period, unit) before the directory is joined.
    per_unit = dated.groupBy("period", "reportingunitcode").agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("total"), F.count("value").alias("n")
    )
    directory = t.hospitals.select(F.col("code").alias("reportingunitcode"), "state")
    unit = F.when(F.col("reportingunitcode") == NATIONAL_UNIT, NATIONAL_UNIT).otherwise(F.col("state"))
    return (
        per_unit.join(directory, "reportingunitcode", "left")
        .groupBy("period", unit.alias("unit"))
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .where(F.col("unit").isNotNull())
        .select(
            F.col("period").cast("int").alias("datasetid"),
            F.col("unit").alias("reportingunitcode"),
            (F.col("total").cast("double") / F.col("n")).alias("value"),
        )
    )
