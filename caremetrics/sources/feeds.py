"""Text feeds: landing-directory writer and typed readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremetrics.schemas import CATALOGUE_FILE, ITEMS_FILE

# A quoted line break makes a CSV file unsplittable, so files stay small instead.
RECORDS_PER_FILE = 1_000_000


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def csv_options(multi_line: bool = True) -> dict[str, str]:
    """How the feeds are read: header checked, no inference, bad records fail the job.

    Without ``multi_line`` quoted line breaks are not allowed and files can be split.
    """
    many = str(multi_line).lower()
    return {"header": "true", "enforceSchema": "false", "multiLine": many, "mode": "FAILFAST", "escape": '"'}


def publish(df: DataFrame, landing: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Add the rows to the landing directory as CSV files of bounded size.

    Files appear when the write commits; readers skip unfinished ones, and lost
    tasks are retried by Spark.
    """
    (
        df.write.mode("append")
        .option("header", "true")
        .option("escape", '"')
        .option("maxRecordsPerFile", records_per_file)
        .csv(landing)
    )


def _read_feed(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    return lower_names(spark.read.schema(schema).options(**csv_options(multi_line)).csv(path))


def read_catalogue(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The listing of datasets; dates stay text until ``split_datasets``."""
    return _read_feed(spark, path, CATALOGUE_FILE, multi_line)


def read_items(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Data items of any number of datasets, each file with its own header."""
    return _read_feed(spark, path, ITEMS_FILE, multi_line)


def stream_items(spark: SparkSession, path: str, files_per_trigger: int, multi_line: bool = True) -> DataFrame:
    """The landing directory as a stream of data items."""
    return lower_names(
        spark.readStream.schema(ITEMS_FILE)
        .options(**csv_options(multi_line))
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(path)
    )


_RAW_ITEMS = T.StructType([T.StructField(f.name.lower(), T.StringType()) for f in ITEMS_FILE] + [T.StructField("record", T.StringType())])


def _raw_items(reader, path: str, multi_line: bool) -> DataFrame:
    """Every record of the item files as text, header rows among them, with the file it is from."""
    many = str(multi_line).lower()
    options = {"header": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "record", "multiLine": many, "escape": '"'}
    return reader.schema(_RAW_ITEMS).options(**options).csv(path).select("*", F.col("_metadata.file_path").alias("source_file"))


def read_raw_items(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return _raw_items(spark.read, path, multi_line)


def stream_raw_items(spark: SparkSession, path: str, files_per_trigger: int, multi_line: bool = True) -> DataFrame:
    return _raw_items(spark.readStream.option("maxFilesPerTrigger", files_per_trigger), path, multi_line)


def judged_items(raw: DataFrame) -> DataFrame:
    """Raw records with their typed columns and, for those that cannot be used, the reason.

    A record is rejected if it has too few or too many columns, a dataset id or a value
    that is no number, or if its file lacks the header. Nothing is dropped but header rows;
    nothing fails the job. Files are judged by their name, one row each, and those without header
    are sent to the records, so that no task gets a whole file; ``raw`` is read twice. Only
    records with a reason get their text back.
    """
    names = [f.name for f in ITEMS_FILE]
    is_header = F.lit(True)
    for name in names:
        is_header = is_header & F.col(name.lower()).eqNullSafe(F.lit(name))
    headless = (
        raw.groupBy("source_file").agg(F.max(is_header).alias("headed")).where("NOT headed").select("source_file", F.lit(True).alias("headless"))
    )
    value, dataset = F.col("value").try_cast("double"), F.col("datasetid").try_cast("long")
    reason = (
        F.when(F.col("headless"), "header")
        .when(F.col("record").isNotNull(), "columns")
        .when(F.col("datasetid").isNotNull() & dataset.isNull(), "dataset id")
        .when(F.col("value").isNotNull() & value.isNull(), "value")
    )
    text = F.coalesce("record", F.concat_ws(",", *[F.coalesce(n.lower(), F.lit("")) for n in names]))
    return (
        raw.where(~is_header)
        .join(F.broadcast(headless), "source_file", "left")
        .select(dataset.alias("datasetid"), "reportingunitcode", value.alias("value"), "caveats", "source_file", reason.alias("reason"), F.when(reason.isNotNull(), text).alias("record"))
    )


def accepted(judged: DataFrame) -> DataFrame:
    """Items as ``read_items`` gives them."""
    return judged.where("reason IS NULL").select("datasetid", "reportingunitcode", "value", "caveats")


def rejected(judged: DataFrame) -> DataFrame:
    return judged.where("reason IS NOT NULL").select("source_file", "reason", "record")


def incomplete_datasets(judged: DataFrame) -> DataFrame:
    """Ids of datasets with a record in a file of which a record was rejected."""
    files = judged.where("reason IS NOT NULL").select("source_file").distinct()
    return judged.join(F.broadcast(files), "source_file", "left_semi").where("datasetid IS NOT NULL").select("datasetid").distinct()


def named_sheet(
    cells: DataFrame, workbook: str, sheet: str, header_row: int, columns: dict[str, str]
) -> DataFrame:
    """Rows below ``header_row``, with columns found by header text.

    ``columns`` maps header text to output name. The header has one row per
    sheet column, so the broadcast side is bounded by the width of a sheet.
    """
    here = cells.where((F.col("workbook") == workbook) & (F.col("sheet") == sheet))
    header = (
        here.where((F.col("row_no") == header_row) & F.col("cell").isin(*columns))
        .groupBy("col_no")
        .agg(F.max("cell").alias("_head"))
    )
    body = here.where(F.col("row_no") > header_row).join(F.broadcast(header), "col_no")
    picks = [F.max(F.when(F.col("_head") == head, F.col("cell"))).alias(name) for head, name in columns.items()]
    return body.groupBy("row_no").agg(*picks)


# Headers of the directory sheet and the row they stand in.
DIRECTORY_HEADER_ROW = 3
DIRECTORY_COLUMNS = {
    "Code": "code",
    "Name": "name",
    "Type": "type",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Sector": "sector",
    "Open/Closed": "open_closed",
    "State": "state",
    "Local Hospital Network (LHN)": "lhn",
    "Primary Health Network area (PHN)": "phn",
}


def read_hospitals(cells: DataFrame, workbook: str = "Directory", sheet: str = "Hospitals") -> DataFrame:
    """The hospital directory with declared names and types; bad coordinates raise."""
    texts = named_sheet(cells, workbook, sheet, DIRECTORY_HEADER_ROW, DIRECTORY_COLUMNS)
    numeric = {"latitude", "longitude"}
    return texts.select(
        *[F.col(c).cast("double").alias(c) if c in numeric else F.col(c) for c in DIRECTORY_COLUMNS.values()]
    )
