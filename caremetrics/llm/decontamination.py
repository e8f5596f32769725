"""Benchmark decontamination with a stored positional inverted index.

``build_index`` cuts the documents into runs of ``RUN_BYTES`` and stores, for every
run, its terms with their postings (word positions), in the shared folder. Nothing of
the benchmark goes into it, so one index serves any number of benchmarks.

``search`` takes windows of consecutive item words. The runs' term lists tell how often
a term occurs; a window with a term that occurs nowhere is dropped, any other is sent,
by a join on its rarest term, to the runs that have that term. There the lists of its
terms are intersected from the rarest outwards, each moved by the term's offset in the
window; what survives is an exact phrase. A proximity match is weaker: every term of the
window has a posting within ``slop`` words of the rarest one.

Windows, terms and postings move by shuffles only. What every task gets is a filter of
``BITS`` bits that leaves out lists of terms no window has; it decides nothing.

Null texts and null item texts have no words. Items with fewer words than a
window are one window. Repeated items count once (``n_items`` counts distinct
ids); repeated documents each give a row. Without documents the result is empty;
without a benchmark nothing is hit. Null item ids are left out of the item list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremetrics.llm.packing import run_numbers
from caremetrics.llm.words import ALNUM_LOWER, Words, pieces, rolling
from caremetrics.session import stored

# Words per window.
WINDOW = 10
# Distance from the rarest term within which the others count as near.
SLOP = 15
# Bytes of text in one run of the index, unless one document has more.
RUN_BYTES = 4 << 20
# Bits of the filter of terms; a fixed size, 2 MB.
BITS = 1 << 24
# Candidate places looked at together.
_TOGETHER = 1 << 20

_LISTS = "run long, kind int, terms array<long>, counts array<int>, bounds binary, positions binary"
_WINDOWS = "window long, item string, terms array<long>"
_HITS = "run long, place int, n_hit long, spans array<array<long>>, n_near long, windows array<long>"
_FOUND = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "item_ids", "spans", "n_near")


def _planes(positions: np.ndarray) -> bytes:
    """First bytes of all positions, then second ones: rising lists compress well so."""
    return positions.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _positions(planes: bytes) -> np.ndarray:
    whole = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T)
    return whole.view("<u4").ravel().astype(np.int64)


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def build_index(docs: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """The stored index: a row per run with its terms, postings, and its documents' ``columns``."""
    needed = docs.select(*dict.fromkeys([*columns, text_col]))
    row = T.StructType([*(needed.schema[c] for c in columns), T.StructField("n_words", T.LongType())])
    schema = T.StructType(
        [
            T.StructField("run", T.LongType()),
            T.StructField("terms", T.ArrayType(T.LongType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
            T.StructField("bounds", T.BinaryType()),
            T.StructField("positions", T.BinaryType()),
            T.StructField("documents", T.ArrayType(row)),
        ]
    )
    names = row.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = run_numbers()
        for batch in batches:
            for part, data, offsets in pieces(batch, text_col, RUN_BYTES):
                words = Words(data, offsets, ALNUM_LOWER)
                hashes = words.hashes()
                order = np.argsort(hashes, kind="stable")
                terms, counts = np.unique(hashes[order], return_counts=True)
                members = pa.StructArray.from_arrays(
                    [*(part.column(c) for c in columns), pa.array(words.counts(), pa.int64())], names
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([next(numbers)], pa.int64()),
                        _lists(terms.view(np.int64), np.array([len(terms)]), pa.int64()),
                        _lists(counts, np.array([len(terms)]), pa.int32()),
                        pa.array([words.bounds.astype("<u4").tobytes()], pa.binary()),
                        pa.array([_planes(order)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), members),
                    ],
                    schema.fieldNames(),
                )

    return stored(needed.mapInArrow(run, schema), "postings")


def item_windows(
    benchmark: DataFrame, width: int = WINDOW, item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """A row per window of each item: its hash, the item's id as text, its terms in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, "text"):
                words = Words(data, offsets, ALNUM_LOWER)
                hashes, item = words.hashes(), part.column("item").to_pylist()
                for d in np.flatnonzero(words.counts()):
                    own = hashes[words.bounds[d] : words.bounds[d + 1]]
                    size = min(width, len(own))
                    ids = rolling(own, size)
                    terms = np.lib.stride_tricks.sliding_window_view(own, size).reshape(-1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids.view(np.int64), pa.int64()),
                            pa.array([item[d]] * len(ids), pa.string()),
                            _lists(terms.view(np.int64), np.full(len(ids), size), pa.int64()),
                        ],
                        ["window", "item", "terms"],
                    )

    texts = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return stored(texts.where("text IS NOT NULL").mapInArrow(run, _WINDOWS), "item-windows")


class Postings:
    """The lists of one run."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, bounds: np.ndarray):
        self.terms, self.positions, self.bounds = terms, positions, bounds
        self.begin = np.concatenate([[0], np.cumsum(counts)])
        self.lengths = np.diff(self.begin)
        self.term_at = np.full(bounds[-1] if len(bounds) else 0, -1, dtype=np.int64)
        self.term_at[positions] = np.repeat(np.arange(len(terms)), counts)
        self.document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.keys: np.ndarray | None = None

    def numbered(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows as rows of term numbers, padded with -1, and which of them have all terms here."""
        width = int(sizes.max(initial=1))
        inside = np.arange(width) < sizes[:, None]
        numbers = np.full(inside.shape, -1, dtype=np.int64)
        if not len(self.terms):
            return numbers, np.zeros(len(sizes), dtype=bool)
        at = np.minimum(np.searchsorted(self.terms, flat), len(self.terms) - 1)
        numbers[inside] = np.where(self.terms[at] == flat, at, -1)
        return numbers, ~((numbers < 0) & inside).any(axis=1)

    def rarest(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and list length of each window's rarest term in this run."""
        lengths = np.where(windows >= 0, self.lengths[np.maximum(windows, 0)], np.iinfo(np.int64).max)
        place = lengths.argmin(axis=1)
        return place, lengths[np.arange(len(place)), place]

    def candidates(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, place of its rarest term, position) for every posting of that term."""
        place, counts = self.rarest(windows)
        rows = np.arange(len(place))
        chosen = np.repeat(rows, counts)
        within = np.arange(len(chosen)) - np.repeat(np.cumsum(counts) - counts, counts)
        return chosen, place[chosen], self.positions[self.begin[windows[rows, place]][chosen] + within]

    def phrases(self, windows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of all exact occurrences."""
        chosen, place, position = self.candidates(windows)
        start = position - place
        doc = self.document[position]
        fits = (start >= self.bounds[doc]) & (start + sizes[chosen] <= self.bounds[doc + 1])
        chosen, start = chosen[fits], start[fits]
        for k in range(windows.shape[1]):
            term = windows[chosen, k]
            ok = term < 0
            inside = np.flatnonzero(~ok)
            ok[inside] = self.term_at[start[inside] + k] == term[inside]
            chosen, start = chosen[ok], start[ok]
        return chosen, start

    def near(self, windows: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, position of its rarest term) where all its terms lie within ``slop`` words."""
        chosen, _, position = self.candidates(windows)
        span = len(self.term_at) + 1
        if self.keys is None:
            self.keys = self.term_at[self.positions] * span + self.positions
        for k in range(windows.shape[1]):
            term = windows[chosen, k]
            doc = self.document[position]
            low = np.maximum(position - slop, self.bounds[doc])
            high = np.minimum(position + slop, self.bounds[doc + 1] - 1)
            base = np.maximum(term, 0) * span
            some = np.searchsorted(self.keys, base + high, side="right") > np.searchsorted(self.keys, base + low)
            ok = (term < 0) | some
            chosen, position = chosen[ok], position[ok]
        return chosen, position


class _Tally:
    """What the windows sent to one run hit in its documents."""

    def __init__(self, run: int, index: Postings, slop: int | None):
        self.run, self.index, self.slop = run, index, slop
        n = len(index.bounds) - 1
        self.edges = np.zeros(len(index.term_at) + 1, dtype=np.int64)
        self.near = np.zeros(n, dtype=np.int64)
        self.windows: list[list] = [[] for _ in range(n)]

    def add(self, ids: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        numbers, whole = self.index.numbered(flat, sizes)
        ids, numbers, sizes = ids[whole], numbers[whole], sizes[whole]
        if not len(ids):
            return
        upto = np.cumsum(self.index.rarest(numbers)[1])
        edges = np.searchsorted(upto, np.arange(_TOGETHER, upto[-1], _TOGETHER))
        for rows in np.split(np.arange(len(ids)), np.unique(edges)):
            if len(rows):
                self._add(ids[rows], numbers[rows], sizes[rows])

    def _add(self, ids: np.ndarray, numbers: np.ndarray, sizes: np.ndarray) -> None:
        chosen, starts = self.index.phrases(numbers, sizes)
        np.add.at(self.edges, starts, 1)
        np.add.at(self.edges, starts + sizes[chosen], -1)
        n = len(self.near)
        exact = np.unique(chosen * n + self.index.document[starts])
        for pair in exact.tolist():
            self.windows[pair % n].append(int(ids[pair // n]))
        if self.slop is not None:
            close, at = self.index.near(numbers, self.slop)
            loose = np.setdiff1d(close * n + self.index.document[at], exact)
            self.near += np.bincount(loose % n, minlength=n)

    def rows(self) -> pa.RecordBatch:
        bounds, covered = self.index.bounds, np.cumsum(self.edges[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(covered)])
        hit = total[bounds[1:]] - total[bounds[:-1]]
        told = np.flatnonzero((hit > 0) | (self.near > 0))
        spans = []
        for doc in told:
            inside = covered[bounds[doc] : bounds[doc + 1]].astype(np.int8)
            spans.append(np.flatnonzero(np.diff(inside, prepend=0, append=0)).reshape(-1, 2).tolist())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(told), self.run), pa.int64()),
                pa.array(told, pa.int32()),
                pa.array(hit[told], pa.int64()),
                pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                pa.array(self.near[told], pa.int64()),
                pa.array([self.windows[doc] for doc in told], pa.list_(pa.int64())),
            ],
            ["run", "place", "n_hit", "spans", "n_near", "windows"],
        )


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column as terms, and the lengths of its rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), np.diff(
        column.offsets.to_numpy()
    )


def _wanted_lists(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Runs with the lists of those terms that may be wanted."""
    bit = F.col("term").bitwiseAND(BITS - 1)
    marked = terms.select(
        F.shiftright(bit, 5).alias("part"), F.expr("shiftleft(1L, cast(term & 31 as int))").alias("bits")
    )
    found = marked.groupBy("part").agg(F.bit_or("bits").alias("bits")).toPandas()  # at most BITS / 32 rows
    bits = np.zeros(BITS // 32, dtype=np.int64)
    bits[found["part"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    shared = index.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                terms, _ = _flat(row.column("terms"))
                counts = row.column("counts").flatten().to_numpy().astype(np.int64)
                at = (terms & np.uint64(BITS - 1)).astype(np.int64)
                keep = shared.value[at >> 5] >> (at & 31) & 1 == 1
                positions = _positions(row.column("positions")[0].as_py())[np.repeat(keep, counts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column("run"),
                        pa.array([0], pa.int32()),
                        _lists(terms[keep].view(np.int64), np.array([keep.sum()]), pa.int64()),
                        _lists(counts[keep], np.array([keep.sum()]), pa.int32()),
                        row.column("bounds"),
                        pa.array([_planes(positions)], pa.binary()),
                    ],
                    ["run", "kind", "terms", "counts", "bounds", "positions"],
                )

    return index.select("run", "terms", "counts", "bounds", "positions").mapInArrow(run, _LISTS)


def search(index: DataFrame, windows: DataFrame, slop: int | None = SLOP) -> DataFrame:
    """Documents of the index that have windows: hit words, spans, near windows, windows found.

    A document is named by its run and its place there. Without ``slop`` phrases only.
    """
    distinct = windows.groupBy("window").agg(F.first("terms").alias("terms"))
    wanted = stored(distinct.select("window", F.explode("terms").alias("term")).distinct(), "window-terms")
    terms = wanted.select("term").distinct()
    entries = index.select("run", F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    entries = entries.select("run", F.col("e.terms").alias("term"), F.col("e.counts").alias("n"))
    directory = stored(entries.join(terms, "term", "left_semi"), "directory")
    totals = directory.groupBy("term").agg(F.sum("n").alias("total"))
    rarest = (
        wanted.join(totals, "term", "left")
        .groupBy("window")
        .agg(
            F.min(F.struct("total", "term"))["term"].alias("term"),
            F.count_if(F.col("total").isNull()).alias("absent"),
        )
        .where("absent = 0")
    )
    sent = directory.select("run", "term").join(rarest.select("window", "term"), "term").select("run", "window")
    sent = stored(sent.join(distinct, "window"), "sent-windows")
    lists = _wanted_lists(index, terms).withColumn("window", F.lit(None).cast("long"))
    both = lists.unionByName(
        sent.select("run", F.lit(1).alias("kind"), "terms", "window"), allowMissingColumns=True
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tally = None, None
        for batch in batches:
            runs, kinds = batch.column("run").to_numpy(), batch.column("kind").to_numpy()
            changes = np.flatnonzero((np.diff(runs) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *changes], [*changes, batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                flat, sizes = _flat(part.column("terms"))
                if kinds[lo] == 1:
                    tally = tally or _Tally(int(runs[lo]), held, slop)
                    tally.add(part.column("window").to_numpy(), flat, sizes)
                    continue
                if tally is not None:
                    yield tally.rows()
                    tally = None
                counts = part.column("counts").flatten().to_numpy().astype(np.int64)
                bounds = np.frombuffer(part.column("bounds")[0].as_py(), "<u4").astype(np.int64)
                held = Postings(flat, counts, _positions(part.column("positions")[0].as_py()), bounds)
        if tally is not None:
            yield tally.rows()

    return stored(both.repartition("run").sortWithinPartitions("run", "kind").mapInArrow(probe, _HITS), "hits")


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    columns: list[str],
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
    slop: int | None = SLOP,
) -> DataFrame:
    """``columns`` of each document, its words, hit words, items, word spans hit, and near windows.

    ``n_near`` counts windows whose terms lie near each other without being a phrase.
    Columns of the input named like a result are left out.
    """
    columns = [c for c in columns if c not in _FOUND]
    index = build_index(docs, columns, text_col)
    windows = item_windows(benchmark, width, item_col, item_text_col)
    hits = search(index, windows, slop)
    owners = windows.where("item IS NOT NULL").select("window", "item").distinct()
    items = (
        hits.select("run", "place", F.explode("windows").alias("window"))
        .join(owners, "window")
        .groupBy("run", "place")
        .agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    )
    hits = hits.drop("windows").join(items, ["run", "place"], "left")
    documents = index.select("run", F.posexplode("documents").alias("place", "document"))
    none = F.array().cast("array<string>")
    names = F.coalesce("item_ids", none)
    return documents.join(hits, ["run", "place"], "left").select(
        *[F.col("document")[c].alias(c) for c in columns],
        F.col("document")["n_words"].alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        names.alias("item_ids"),
        F.coalesce("spans", F.array().cast("array<array<bigint>>")).alias("spans"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows without any benchmark window, unchanged.

    Texts are named by their 128-bit digest, so equal texts go or stay together.
    """
    own = {c: f"own_{c}" for c in docs.columns}
    named = docs.toDF(*own.values()).withColumn("digest", F.md5(own[text_col]))
    found = matches(named, benchmark, ["digest"], own[text_col], slop=None)
    hit = stored(found.where("contaminated").select("digest").distinct(), "hit-texts")
    return named.join(hit, "digest", "left_anti").select(*[F.col(o).alias(c) for c, o in own.items()])
