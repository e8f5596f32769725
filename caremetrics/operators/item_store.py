"""Items that keep arriving: stored once each in sorted levels, with the sums of their values kept up to date.

Every delivery is a run of files sorted by dataset id, of which the store knows the range of ids.
Once ``FAN`` runs of a level have come together they are merged into one run
of the next, so that the files stay few and each row is rewritten a number of times that
grows with the logarithm of the deliveries. A delivery is compared only with files whose range holds one of its ids:
in each run at most one file per id, unless an id fills several.

The cube has total and count of the values by measure, reported measure, unit and
date, in buckets of measure and date. The unseen items of a delivery are summed and written beside
the sums of earlier ones, which are added up when the cube is read and, level by level, once a bucket
has ``FAN`` of them; nothing else is read. Deliveries are numbered by their
writer and count once, so a run that failed at any point can be repeated.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import groupby

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremetrics.functions.numbers import total_of
from caremetrics.operators.ingest import with_item_id
from caremetrics.operators.upsert import new_rows, one_row_per_key
from caremetrics.schemas import TABLES
from caremetrics.sources.versions import LevelledTable, Version, VersionedTable

# Runs of a level that are merged into one of the next.
FAN = 8
# Rows of a file, about.
ROWS_PER_FILE = 10_000_000
# Rows that are worth a task of their own when a run is written.
ROWS_PER_TASK = 1_000_000
# Ids of a delivery, about, that files are chosen by one by one; of more ids only the range is used.
LISTED_IDS = 20_000

CUBE_KEY = ["measurecode", "reportedmeasurecode", "reportingunitcode", "reportingstartdate"]


def cube_schema(exact_scale: int | None = None) -> T.StructType:
    total = T.DoubleType() if exact_scale is None else T.DecimalType(28, exact_scale)
    types = [T.StringType(), T.StringType(), T.StringType(), T.DateType(), total, T.LongType()]
    return T.StructType([T.StructField(n, t) for n, t in zip([*CUBE_KEY, "total", "n"], types)])


class ItemStore:
    """Items below one shared folder and, unless ``with_cube`` is off, their cube.

    Deliveries that the cube has not taken in yet are listed in every version of the items.
    """

    def __init__(
        self, spark: SparkSession, root: str, cube_buckets: int = 64, exact_scale: int | None = None,
        fan: int = FAN, rows_per_file: int = ROWS_PER_FILE, with_cube: bool = True,
    ):
        self.items = VersionedTable(spark, f"{root}/items", TABLES["info"].schema)
        self.cube = LevelledTable(
            spark, f"{root}/cube", cube_schema(exact_scale), ["measurecode", "reportedmeasurecode", "reportingstartdate"], cube_buckets, _added, fan
        )
        self.exact_scale, self.fan, self.rows_per_file, self.with_cube = exact_scale, fan, rows_per_file, with_cube

    def rows(self) -> DataFrame:
        return self.items.read()

    def add(self, items: DataFrame, number: int, writer: str = "items") -> bool:
        """Store the unseen items of a delivery; False if the delivery is in already."""
        base = self.items.version()
        if number <= base.done.get(writer, -1):
            return False
        # The delivery is looked up as it came; its copies are merged once, where it is compared or written.
        keyed = with_item_id(items)
        if base.files:
            keyed = keyed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            met = self._files_met(keyed, base)
            unseen = new_rows(keyed, self.items.read(met), "id", within="datasetid") if met else one_row_per_key(keyed, "id")
            fresh = unseen.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                count = fresh.count()
                files = self.items.write_sorted(fresh, ["datasetid", "id"], self._pieces(count), 0) if count else []
            finally:
                fresh.unpersist()
        finally:
            keyed.unpersist()
        log = []
        if self.with_cube:
            taken = self.cube.version().done
            log = [entry for entry in base.log if entry["number"] > taken.get(entry["writer"], -1)]
            log.append({"writer": writer, "number": number, "files": files})
        self._compact(self.items.commit(base, [*base.files, *files], {writer: number}, log))
        return True

    def _pieces(self, count: int) -> int:
        """Files of a run: as many as its rows need, and as tasks can run at once if each gets enough rows."""
        tasks = min(self.items.spark.sparkContext.defaultParallelism, count // ROWS_PER_TASK)
        return max(1, tasks, -(-count // self.rows_per_file))

    def _files_met(self, keyed: DataFrame, base: Version) -> list[dict]:
        """Stored files that may hold an item of the delivery."""
        if not base.files:
            return []
        low, high, ids = keyed.agg(F.min("datasetid"), F.max("datasetid"), F.approx_count_distinct("datasetid")).first()
        if low is None:
            return []
        if ids > LISTED_IDS:
            return [f for f in base.files if f["lo"] <= high and f["hi"] >= low]
        values = sorted(r[0] for r in keyed.select("datasetid").distinct().collect())
        return [f for f in base.files if _holds(values, f["lo"], f["hi"])]

    def _compact(self, base: Version) -> Version:
        """Merge full levels, lowest first."""
        level = 0
        while True:
            here = [f for f in base.files if f["level"] == level]
            if not here and level >= max((f["level"] for f in base.files), default=0):
                return base
            if len({f["run"] for f in here}) >= self.fan:
                pieces = self._pieces(sum(f["rows"] for f in here))
                merged = self.items.write_sorted(self.items.read(here), ["datasetid", "id"], pieces, level + 1)
                others = [f for f in base.files if f["level"] != level]
                base = self.items.commit(base, [*others, *merged])
            level += 1

    def refresh_cube(self, datasets: DataFrame, waiting: int = 1) -> None:
        """Bring the cube up to the last delivery, if at least ``waiting`` deliveries are not in it.

        Deliveries of a writer that follow one another are summed together, so that all of
        ``datasets`` is joined once for them. Items of datasets that it does not have yet are
        not counted: list the datasets first.
        """
        taken = self.cube.version().done
        log = [entry for entry in self.items.version().log if entry["number"] > taken.get(entry["writer"], -1)]
        if len(log) < waiting:
            return
        for writer, run in groupby(log, lambda entry: entry["writer"]):
            entries = list(run)
            items = self.items.read([f for entry in entries for f in entry["files"]])
            self.cube.add(delta_cube(items, datasets, self.exact_scale), writer, entries[-1]["number"])


def _holds(values: list[int], low: int, high: int) -> bool:
    """Whether one of the ascending values is between the bounds."""
    at = bisect_left(values, low)
    return at < len(values) and values[at] <= high


def delta_cube(items: DataFrame, datasets: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """Total and count of the values of some items, by the columns of the cube."""
    value = F.when(~F.isnan("value"), F.col("value")).alias("value")
    named = datasets.select("datasetid", "measurecode", "reportedmeasurecode", "reportingstartdate")
    facts = items.select("datasetid", "reportingunitcode", value).where("value IS NOT NULL").join(named, "datasetid")
    sums = facts.groupBy(*CUBE_KEY).agg(total_of("value", exact_scale).alias("total"), F.count("value").alias("n"))
    return sums.select(*CUBE_KEY, F.col("total").cast(cube_schema(exact_scale)["total"].dataType).alias("total"), "n")


def _added(sums: DataFrame) -> DataFrame:
    total = F.sum("total").cast(sums.schema["total"].dataType).alias("total")
    return sums.groupBy(*CUBE_KEY).agg(total, F.sum("n").alias("n"))
