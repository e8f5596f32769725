"""Declared schemas and keys of the reporting tables, and their DDL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_STR, _INT, _LONG, _DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


@dataclass(frozen=True)
class TableSpec:
    """One reporting table: its columns, its key, and the column it is bucketed by, if any."""

    name: str
    schema: T.StructType
    key: str
    bucket_by: str | None = None

    def ddl(self, buckets: int) -> str:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema)
        clustered = f" CLUSTERED BY ({self.bucket_by}) INTO {buckets} BUCKETS" if self.bucket_by else ""
        return f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet{clustered}"


# Table names, column names, types and keys of the data model.
# datasetid is widened to bigint. info and datasets are bucketed alike so that
# the star join on datasetid needs no shuffle of the fact table.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "datasets",
            _fields(
                reportingstartdate=T.DateType(),
                reportedmeasurecode=_STR,
                datasetid=_LONG,
                measurecode=_STR,
                datasetname=_STR,
                stored=T.BooleanType(),
            ),
            key="datasetid",
            bucket_by="datasetid",
        ),
        TableSpec(
            "hospitals",
            _fields(
                code=_STR,
                name=_STR,
                type=_STR,
                latitude=_DBL,
                longitude=_DBL,
                sector=_STR,
                open_closed=_STR,
                state=_STR,
                lhn=_STR,
                phn=_STR,
            ),
            key="code",
        ),
        TableSpec(
            "measurements",
            _fields(measurecode=_STR, measurename=_STR),
            key="measurecode",
        ),
        TableSpec(
            "reported_measurements",
            _fields(reportedmeasurecode=_STR, reportedmeasurename=_STR),
            key="reportedmeasurecode",
        ),
        TableSpec(
            "info",
            _fields(
                datasetid=_LONG, reportingunitcode=_STR, value=_DBL, caveats=_STR, id=_STR
            ),
            key="id",
            bucket_by="datasetid",
        ),
    )
}

# Headers of the two text feeds, in file order.
CATALOGUE_FILE = _fields(
    ReportingStartDate=_STR,
    ReportedMeasureCode=_STR,
    ReportedMeasureName=_STR,
    MeasureCode=_STR,
    MeasureName=_STR,
    DataSetId=_LONG,
    DataSetName=_STR,
)
ITEMS_FILE = _fields(DataSetId=_LONG, ReportingUnitCode=_STR, Value=_DBL, Caveats=_STR)

# Positional content of workbooks.
CELLS = _fields(workbook=_STR, sheet=_STR, row_no=_INT, col_no=_INT, cell=_STR)

# Fixed value: the unit code that carries the national figure.
NATIONAL_UNIT = "NAT"


def create_tables(spark: SparkSession, buckets: int = 16) -> None:
    """Create the five tables where they do not exist yet.

    ``buckets`` should be sized so that one bucket of ``info`` fits a task
    (a few thousand at the 100 TB scale). The directory and the two code lists
    are small and not bucketed.
    """
    for spec in TABLES.values():
        spark.sql(spec.ddl(buckets))
