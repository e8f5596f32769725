"""Tables in versions: new files are written aside, and a version that names them is put in place last.

A version is one small file: the data files that make up the table, with what is known of
each (bucket or range of keys, level, rows), and how far each writer has come. Readers
take the highest version, so they see a write whole or not at all, whatever fails
between; files that no version names are rubbish until ``vacuum``. A file is never changed.
The list of files must fit the driver; files should have hundreds of megabytes.

There is one writer at a time: a second one that started from the same version is refused.

A ``LevelledTable`` holds rows that combine, such as sums: what comes is written beside what
is stored, and combined when it is read, so a delivery costs what it brings. A ``MarkedTable``
holds rows that are marked by their key: the keys are written beside the rows in the same way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Version:
    """What one version consists of: files (dictionaries with at least ``path``) and the last number of each writer.

    ``log`` names deliveries, with their files, that something else still has to take in.
    """

    number: int = -1
    files: tuple[dict, ...] = ()
    done: dict[str, int] = field(default_factory=dict)
    log: tuple[dict, ...] = ()


class VersionedTable:
    """A table of Parquet files below ``root``; ``bucket_by`` names what its buckets are hashed from."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, bucket_by: Iterable[str] = (), buckets: int = 1):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.bucket_by, self.buckets = list(bucket_by), buckets

    # --- versions ----------------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files_in(self, name: str) -> list[str]:
        path = self._path(name)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = fs.listStatus(path) if fs.exists(path) else []
        return sorted(f.getPath().getName() for f in found)

    def version_numbers(self) -> list[int]:
        return [int(name) for name in self._files_in("versions") if name.isdigit()]

    def version(self, number: int | None = None) -> Version:
        """The given version, or the current one; an empty one before the first write."""
        numbers = self.version_numbers()
        if not numbers and number is None:
            return Version()
        name = f"{self.root}/versions/{max(numbers) if number is None else number:012d}"
        text = self.spark.read.text(name, wholetext=True).first()[0]
        held = json.loads(text)
        return Version(held["number"], tuple(held["files"]), held["done"], tuple(held["log"]))

    def commit(
        self, base: Version, files: Iterable[dict], done: dict[str, int] | None = None, log: Iterable[dict] | None = None
    ) -> Version:
        """Put the version after ``base`` in place; what is not given stays as it was."""
        new = Version(base.number + 1, tuple(files), {**base.done, **(done or {})}, base.log if log is None else tuple(log))
        text = json.dumps(asdict(new))
        aside, final = self._path(f"versions/.{uuid.uuid4().hex}"), self._path(f"versions/{new.number:012d}")
        fs = final.getFileSystem(self.spark._jsc.hadoopConfiguration())
        out = fs.create(aside, False)
        out.write(bytearray(text, "utf-8"))
        out.close()
        if fs.exists(final) or not fs.rename(aside, final):
            raise RuntimeError(f"version {new.number} of {self.root} was written by another writer")
        return new

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete versions but the last ``keep``, and folders that none of those names; returns the folders."""
        numbers = self.version_numbers()
        versions = [self.version(n) for n in numbers[-keep:]]
        paths = [f["path"] for v in versions for f in (*v.files, *(f for entry in v.log for f in entry["files"]))]
        named = {path.split("/")[0] for path in paths}
        rubbish = [name for name in self._files_in("data") if name not in named]
        for name in [f"data/{f}" for f in rubbish] + [f"versions/{n:012d}" for n in numbers[:-keep]]:
            path = self._path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return rubbish

    # --- rows --------------------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def read(self, files: Iterable[dict] | None = None) -> DataFrame:
        """The rows of the given files, or of the current version."""
        paths = [f"{self.root}/data/{f['path']}" for f in (self.version().files if files is None else files)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write_buckets(self, rows: DataFrame, columns: list[str] | None = None) -> list[dict]:
        """Write rows aside, a file per bucket that has some; returns the files."""
        folder = uuid.uuid4().hex
        dealt = rows.select(*(columns or self.schema.fieldNames())).withColumn("bucket", self.bucket()).repartition(self.buckets, "bucket")
        dealt.write.partitionBy("bucket").parquet(f"{self.root}/data/{folder}")
        names = [n for n in self._files_in(f"data/{folder}") if n.startswith("bucket=")]
        return [{"path": f"{folder}/{n}", "bucket": int(n.split("=")[1])} for n in names]

    def write_sorted(self, rows: DataFrame, by: list[str], pieces: int, level: int) -> list[dict]:
        """Write rows aside in ranges of ``by``; each file comes with the least and greatest of the first column."""
        folder, key = uuid.uuid4().hex, by[0]
        ranged = rows.select(*self.schema.fieldNames()).repartitionByRange(pieces, *by).sortWithinPartitions(*by)
        ranged.write.parquet(f"{self.root}/data/{folder}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{folder}")
        name = F.col("_metadata.file_name").alias("name")
        about = written.groupBy(name).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("rows"))
        return [
            {"path": f"{folder}/{r['name']}", "level": level, "run": folder, "lo": r["lo"], "hi": r["hi"], "rows": r["rows"]}
            for r in about.collect()  # one row per file written
        ]

    def merge(
        self, delta: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], writer: str = "", number: int | None = None
    ) -> Version:
        """Combine rows with those stored; only buckets that ``delta`` has rows in are read and written again.

        ``combine`` gets the stored rows of these buckets and the delta. A numbered delta of a
        writer is taken in once, however often it comes. The bucket numbers (at most
        ``buckets``) reach the driver, the rows do not.
        """
        base = self.version()
        if number is not None and number <= base.done.get(writer, -1):
            return base
        delta = delta.persist(StorageLevel.MEMORY_AND_DISK)  # asked for its buckets, then combined
        try:
            touched = {r[0] for r in delta.select(self.bucket().alias("b")).distinct().collect()}
            old = [f for f in base.files if f["bucket"] in touched]
            files = self.write_buckets(combine(self.read(old), delta)) if touched else []
        finally:
            delta.unpersist()
        kept = [f for f in base.files if f["bucket"] not in touched]
        return self.commit(base, [*kept, *files], None if number is None else {writer: number})

    def _levelled(self, base: Version, fan: int, chosen: Callable[[dict], bool], combined: Callable[[list[dict]], list[dict]]) -> Version:
        """Combine full levels of buckets, lowest first, among the chosen files."""
        level = 0
        while level <= max((_level(f) for f in base.files if chosen(f)), default=-1):
            here: dict[int, list[dict]] = {}
            for f in base.files:
                if chosen(f) and _level(f) == level:
                    here.setdefault(f["bucket"], []).append(f)
            full = [f for held in here.values() if len(held) >= fan for f in held]
            if full:
                merged = [{**f, "level": level + 1} for f in combined(full)]
                base = self.commit(base, [*(f for f in base.files if f not in full), *merged])
            level += 1
        return base


class LevelledTable(VersionedTable):
    """A bucketed table of rows that ``combine`` (sums, distinct values), in any order and any number of times.

    Every delta is a file of level 0 in each bucket it has rows in. Once ``fan`` files of a
    level have come together in a bucket, they are combined into one of the next, so a row
    is rewritten a number of times that grows with the logarithm of the deltas.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, bucket_by: Iterable[str], buckets: int,
        combine: Callable[[DataFrame], DataFrame], fan: int = 8,
    ):
        super().__init__(spark, root, schema, bucket_by, buckets)
        self.combine, self.fan = combine, fan

    def read(self, files: Iterable[dict] | None = None) -> DataFrame:
        """The combined rows of the given files, or of the current version."""
        held = list(self.version().files if files is None else files)
        stored = super().read(held)
        return stored if len({f["bucket"] for f in held}) == len(held) else self.combine(stored)

    def add(self, delta: DataFrame, writer: str = "", number: int | None = None) -> Version:
        """Take in combined rows; a numbered delta of a writer counts once, however often it comes."""
        base = self.version()
        if number is not None and number <= base.done.get(writer, -1):
            return base
        files = [{**f, "level": 0} for f in self.write_buckets(delta)]
        return self._compact(self.commit(base, [*base.files, *files], None if number is None else {writer: number}))

    def _compact(self, base: Version) -> Version:
        return self._levelled(base, self.fan, lambda f: True, lambda full: self.write_buckets(self.read(full)))


class MarkedTable(VersionedTable):
    """A bucketed table whose rows are marked by ``bucket_by``; ``marked`` gets rows and distinct marks.

    Marks are kept in levels beside the rows, so a delivery of them costs what it brings
    however many rows there are; they are applied to the rows when these are read. They
    count for the rows that were there before them: ``merge`` writes a bucket's rows as marked,
    and its marks are gone.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, bucket_by: Iterable[str], buckets: int,
        marked: Callable[[DataFrame, DataFrame], DataFrame], fan: int = 8,
    ):
        super().__init__(spark, root, schema, bucket_by, buckets)
        self.marked, self.fan = marked, fan
        self._marks_schema = T.StructType([schema[c] for c in self.bucket_by])

    def read(self, files: Iterable[dict] | None = None) -> DataFrame:
        """The rows of the given files, or of the current version, as marked."""
        held = list(self.version().files if files is None else files)
        rows = super().read([f for f in held if not _marks(f)])
        marks = [f for f in held if _marks(f)]
        return self.marked(rows, self._read_marks(marks)) if marks else rows

    def mark(self, marks: DataFrame, writer: str = "", number: int | None = None) -> Version:
        """Mark the rows that are stored; numbered marks of a writer count once, however often they come."""
        base = self.version()
        if number is not None and number <= base.done.get(writer, -1):
            return base
        files = [{**f, "level": 0} for f in self._write_marks(marks)]
        base = self.commit(base, [*base.files, *files], None if number is None else {writer: number})
        return self._levelled(base, self.fan, _marks, lambda full: self._write_marks(self._read_marks(full)))

    def _read_marks(self, files: list[dict]) -> DataFrame:
        return self.spark.read.schema(self._marks_schema).parquet(*(f"{self.root}/data/{f['path']}" for f in files)).distinct()

    def _write_marks(self, marks: DataFrame) -> list[dict]:
        return [{**f, "marks": True} for f in self.write_buckets(marks, self.bucket_by)]


def _marks(file: dict) -> bool:
    return file.get("marks", False)


def _level(file: dict) -> int:
    return file.get("level", 0)
