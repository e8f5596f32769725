"""Tidy tables from positional workbook cells.

Input is the long cell table ``(workbook, sheet, row_no, col_no, cell)`` with
zero-based positions. Cells of one sheet row are gathered by conditional
aggregates with a fixed column list, which combine inside the map tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremetrics.functions.numbers import leading_year, lenient_number
from caremetrics.functions.ordering import with_ordinal


@dataclass(frozen=True)
class Sheet:
    """Where the body of a sheet is: first row, and column numbers by name.

    It ends with ``last_row``, if given. Else, with ``by_years``, it ends with the
    last row whose first cell is a year label, so that notes below stay out
    however many years there are.
    """

    workbook: str
    sheet: str
    first_row: int
    last_row: int | None = None
    columns: dict[str, int] = field(default_factory=dict)
    by_years: bool = True


# A year, or two years joined by a dash.
YEAR_LABEL = "^ *[0-9]{4} *([–-] *[0-9]{2,4} *)?$"
# Positions of the sheets in use.
LENGTH_OF_STAY = Sheet("Admitted Patients", "Table 2.9", 3, by_years=False)
LENGTH_OF_STAY_HEADER = 2
LENGTH_OF_STAY_SKIPPED = ["Average since 2018–19", "Since 2021–22"]
LENGTH_OF_STAY_BLOCKS = ["Public", "Private"]
LENGTH_OF_STAY_TITLES = ["Public hospitals", "Private hospitals", "All hospitals"]
PRICES = Sheet(
    "Expenditure",
    "Table 1",
    4,
    None,
    {"year": 0, "current_price": 1, "constant_price": 2, "nominal_change": 4, "real_growth": 5},
)
BY_STATE = Sheet(
    "Expenditure",
    "Table 4",
    2,
    None,
    {
        "year": 0,
        "NSW": 1,
        "VIC": 3,
        "QLD": 5,
        "SA": 7,
        "WA": 9,
        "TAS": 11,
        "ACT": 13,
        "NT": 15,
        "Australia": 17,
    },
)
PER_CAPITA = Sheet(
    "Expenditure",
    "Table 5",
    5,
    None,
    {"NSW": 1, "Vic": 4, "Qld": 7, "WA": 10, "SA": 13, "Tas": 16, "NT": 19, "NAT": 22},
)
GDP = Sheet("Expenditure", "Table 7", 3, None, {"year": 0, "gdp": 4, "ratio": 6})
FIRST_BUDGET_YEAR = 2011


_SHEET = ["workbook", "sheet"]


def sheet_body(cells: DataFrame, sheet: Sheet) -> DataFrame:
    """The cells of the body rows of one sheet."""
    here = (F.col("workbook") == sheet.workbook) & (F.col("sheet") == sheet.sheet)
    body = cells.where(here & (F.col("row_no") >= sheet.first_row)).select(*_SHEET, "row_no", "col_no", "cell")
    if sheet.last_row is not None:
        return body.where(F.col("row_no") <= sheet.last_row)
    if not sheet.by_years:
        return body
    # A window over the sheet, which its format bounds, reads it once.
    label = F.when((F.col("col_no") == 0) & F.col("cell").rlike(YEAR_LABEL), F.col("row_no"))
    ended = body.withColumn("end", F.max(label).over(Window.partitionBy(*_SHEET)))
    return ended.where(F.col("row_no") <= F.col("end")).drop("end")


def tidy_sheet(cells: DataFrame, sheet: Sheet) -> DataFrame:
    """One row per sheet row with the named columns as text; other columns are dropped."""
    wanted = sheet_body(cells, sheet).where(F.col("col_no").isin(*sheet.columns.values()))
    return wanted.groupBy("row_no").agg(
        *[F.max(F.when(F.col("col_no") == no, F.col("cell"))).alias(name) for name, no in sheet.columns.items()]
    )


def _long(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(ids, columns, name, value)


def sheet_blocks(body: DataFrame, titles: list[str]) -> DataFrame:
    """(row_no, label, block_no) of the rows of a body's blocks, numbered from 1.

    A block is a run of rows with a label in their first cell, some of which have more
    cells: empty rows end it, and a run of labels alone (notes) is none. As the blocks of
    some sheets follow each other, so does a row with one of ``titles``, or with the label that
    its run began with. A title without further cells is not a row of its block.
    The windows run over one sheet, which its format bounds.
    """
    filled = F.col("cell").isNotNull() & (F.trim("cell") != "")
    rows = body.where(filled).groupBy(*_SHEET, "row_no").agg(
        F.max(F.when(F.col("col_no") == 0, F.col("cell"))).alias("label"), F.max(F.col("col_no") > 0).alias("has_data")
    )
    is_title = F.col("label").isin(titles)
    sheet, in_order = Window.partitionBy(*_SHEET), Window.partitionBy(*_SHEET).orderBy("row_no")
    cut = F.coalesce(F.col("row_no") - F.lag("row_no").over(in_order) > 1, F.lit(True)) | is_title | F.lag(is_title).over(in_order)
    runs = rows.where("label IS NOT NULL").withColumn("run", F.sum(cut.cast("int")).over(in_order))
    first = F.first("label").over(Window.partitionBy(*_SHEET, "run").orderBy("row_no"))
    blocks = runs.withColumn("again", F.sum((F.col("label") == first).cast("int")).over(Window.partitionBy(*_SHEET, "run").orderBy("row_no")))
    used = blocks.withColumn("used", F.max("has_data").over(Window.partitionBy(*_SHEET, "run", "again"))).where("used")
    number = F.dense_rank().over(sheet.orderBy("run", "again"))
    return used.select("row_no", "label", number.alias("block_no"))


def length_of_stay(cells: DataFrame) -> DataFrame:
    """(block, hospital_type, year, days) of both hospital blocks, summary columns left out."""
    spec = LENGTH_OF_STAY
    header_row = Sheet(spec.workbook, spec.sheet, LENGTH_OF_STAY_HEADER, LENGTH_OF_STAY_HEADER)
    # The header has one row per sheet column and the blocks a row per label: both are
    # bounded by the layout of the sheet. Every label gets every year of the
    # header, and the days that the sheet has for them, if any.
    header = (
        sheet_body(cells, header_row)
        .where((F.col("col_no") > 0) & ~F.col("cell").isin(*LENGTH_OF_STAY_SKIPPED))
        .groupBy("col_no")
        .agg(F.max("cell").alias("year"))
    )
    body = sheet_body(cells, spec)
    names = F.array(*[F.lit(name) for name in LENGTH_OF_STAY_BLOCKS])
    labels = sheet_blocks(body, LENGTH_OF_STAY_TITLES).where(F.col("block_no") <= len(LENGTH_OF_STAY_BLOCKS)).select(
        "row_no", F.col("label").alias("hospital_type"), F.get(names, (F.col("block_no") - 1).cast("int")).alias("block")
    )
    years = header.agg(F.collect_list(F.struct("col_no", "year"))).scalar()
    places = labels.select("row_no", "block", "hospital_type", F.explode(years).alias("head"))
    places = places.select("row_no", "block", "hospital_type", F.col("head.col_no").alias("col_no"), F.col("head.year").alias("year"))
    days = body.where(F.col("col_no") > 0).groupBy("row_no", "col_no").agg(F.max("cell").alias("cell"))
    return (
        places.join(days, ["row_no", "col_no"], "left")
        .select("block", "hospital_type", "year", lenient_number(F.col("cell")).alias("days"))
    )


def _numbers(df: DataFrame, *columns: str) -> list[Column]:
    return [lenient_number(F.col(c)).alias(c) for c in columns]


def spend_prices(cells: DataFrame) -> DataFrame:
    """Spending in current and constant prices with both rates of change."""
    rows = tidy_sheet(cells, PRICES)
    return rows.select(
        "year", *_numbers(rows, "current_price", "constant_price", "nominal_change", "real_growth")
    )


def spend_prices_long(wide: DataFrame) -> DataFrame:
    """Prices and rates as (year, type, value); unpublished figures stay as nulls."""
    measures = ["current_price", "constant_price", "nominal_change", "real_growth"]
    return _long(wide, ["year"], measures, "type", "value")


def spend_by_state(cells: DataFrame, state: str | None = None) -> DataFrame:
    """(year, state, amount) with the national total as state ``Australia``; one state on request."""
    rows = tidy_sheet(cells, BY_STATE)
    states = [c for c in BY_STATE.columns if c != "year"]
    long = _long(rows.select("year", *_numbers(rows, *states)), ["year"], states, "state", "amount")
    return long if state is None else long.where(F.col("state") == state)


def gdp_ratio(cells: DataFrame) -> DataFrame:
    """GDP and the ratio of health spending to it; the year is the label's first part."""
    rows = tidy_sheet(cells, GDP)
    return rows.select(leading_year(F.col("year")).alias("year"), *_numbers(rows, "gdp", "ratio"))


def budget_wide(cells: DataFrame) -> DataFrame:
    """Spending per person: year, then the states and the nation in alphabetical order.

    Years are counted from 2011 in sheet order, whatever their labels say.
    """
    rows = tidy_sheet(cells, PER_CAPITA)
    year = (F.col("row_no") - PER_CAPITA.first_row + FIRST_BUDGET_YEAR).cast("int")
    return rows.select(year.alias("year"), *_numbers(rows, *sorted(PER_CAPITA.columns)))


def budget_table(cells: DataFrame) -> DataFrame:
    """Spending per person as (year, state, per_capita)."""
    return _long(budget_wide(cells), ["year"], sorted(PER_CAPITA.columns), "state", "per_capita")


def population(cells: DataFrame, workbook: str = "Population", sheet: str = "Sheet 1") -> DataFrame:
    """(year, total_population): first and last column; rows with a gap are notes."""
    body = sheet_body(cells, Sheet(workbook, sheet, 2, by_years=False))
    last = body.agg(F.max("col_no")).scalar()
    total_text = F.max(F.when(F.col("col_no") == F.col("_last"), F.col("cell")))
    year_text = F.max(F.when(F.col("col_no") == 0, F.col("cell")))
    rows = (
        body.withColumn("_last", last)
        .groupBy("row_no")
        .agg(year_text.alias("_year"), total_text.alias("_total"))
        .na.drop(subset=["_year", "_total"])
    )
    return rows.select(
        F.col("_year").cast("int").alias("year"),
        F.col("_total").cast("double").alias("total_population"),
    )


# Scenario columns of the projections sheet. The fourth is read
# but never scored.
SCENARIOS = {"high": 1, "medium": 2, "low": 3}
PROJECTIONS = Sheet("Population Projections", "Sheet 1", 2, None, {"year": 0, **SCENARIOS, "zero_migration": 4})


def projections(cells: DataFrame) -> DataFrame:
    """(year, high, medium, low, zero_migration) as numbers."""
    rows = tidy_sheet(cells, PROJECTIONS)
    return rows.select(
        F.col("year").cast("int").alias("year"),
        *[F.col(c).cast("double").alias(c) for c in PROJECTIONS.columns if c != "year"],
    )


def year_ordinals(df: DataFrame, key: str, first_year: int = FIRST_BUDGET_YEAR) -> DataFrame:
    """Label rows with consecutive years in key order."""
    numbered = with_ordinal(df, key)
    return numbered.withColumn("year", (F.col("ordinal") + (first_year - 1)).cast("int")).drop("ordinal")
