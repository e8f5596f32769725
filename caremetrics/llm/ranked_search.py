"""Ranked lexical search over blocked posting lists.

Documents are cut into segments of bounded size. In a segment every term that a query asks for has a
posting list, and every list is cut into blocks by likeness: some documents of the list
are centres, and the others go to the centre whose projected term vector points most nearly their way.
A block stores the documents it holds and its summary, the coordinatewise maximum of
their term impacts (in 31 levels, rounded up). The index is a table in the shared folder, one row a segment.

A query visits its lists from the one that can add most. A block is skipped only if the
summary's score for the query, which no document inside can exceed, is below the tenth
best score found so far; lists are left out once all that remain cannot reach it
together. The documents of other blocks are scored in full. So results are exact.

Queries are dealt into slices of bounded size. One slice is sent to all tasks; more are joined to the
segments by shuffles, each segment meeting every slice. Segments hand on at most ``k`` rows per query.

Impacts and weights are those of ``impact`` and ``weighted``: integers, so that no order of
summing matters. Null and empty texts have no terms: such documents do not count and are
not ranked, such items get no rows. Rows of one item id are one query, that of all their terms. Rows of
one document id are ranked each. Equal scores are in ascending order of the id, a null id last. An
empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caremetrics.llm.words import ALNUM_LOWER, Words, pieces
from caremetrics.session import work_dir

# Rows given out per query.
BEST = 10
# A segment ends at so many documents or bytes of text.
SEGMENT_DOCS, SEGMENT_BYTES = 2048, 4 << 20
# Documents per block, about, and most blocks of a list.
BLOCK_DOCS, LIST_BLOCKS = 32, 12
# Dimensions that term vectors are projected to before they are compared.
PROJECTED = 32
# Query terms of one slice (24 bytes each).
SLICE_TERMS = 200_000
# Segments in a file of the index: readers and writers hold a file's rows together.
SEGMENTS_PER_FILE = 2
# Segments that meet one copy of a slice where there are several slices.
SEGMENTS_PER_COPY = 64
# Bits of the filter that drops terms no query has; a fixed size, 2 MB.
_FILTER_BITS = 24
_LEVELS = 31

_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    shift = starts - (np.cumsum(sizes) - sizes)
    return np.repeat(shift, sizes) + np.arange(int(sizes.sum()))


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers that are not negative, in as few bytes each as the largest needs; high bytes together, so that they compress."""
    width = next(w for w in (1, 2, 4, 8) if int(numbers.max(initial=0)) < 1 << (8 * w - (w == 8)))
    raw = numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return bytes([width]) + raw.T.tobytes()


def _unpacked(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    body = np.frombuffer(batch.column(name)[row].as_buffer(), dtype=np.uint8)
    width = int(body[0])
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}[width]
    return np.ascontiguousarray(body[1:].reshape(width, -1).T).view(kind).ravel()


def _one_row(columns: dict[str, tuple[pa.DataType, object]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for t, v in columns.values()], list(columns))


def _column(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


# --- queries -----------------------------------------------------------------------


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item__, term (a 64-bit hash), each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, "text__"):
                words = Words(data, offsets, ALNUM_LOWER)
                owner = pa.array(words.documents())
                terms = pa.array(words.hashes().view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("item__").take(owner), terms], ["item__", "term"])

    picked = queries.select(F.col(id_col).alias("item__"), F.col(text_col).alias("text__"))
    kind = picked.schema["item__"].dataType.simpleString()
    return picked.mapInArrow(run, f"item__ {kind}, term long").distinct()


def _asked(terms: DataFrame) -> np.ndarray:
    """Bits of the terms' leading hash bits. At most 2^19 rows reach the driver, however many terms there are."""
    lead = F.shiftrightunsigned("term", 64 - _FILTER_BITS)
    parts = terms.select(F.shiftright(lead, 5).alias("part"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(term, {64 - _FILTER_BITS}) & 31 AS int))").alias("bit"))
    found = parts.groupBy("part").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(1 << (_FILTER_BITS - 5), dtype=np.int64)
    bits[found["part"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bits


# --- segments ----------------------------------------------------------------------


class _Segment:
    """Documents of a segment as they are read: lengths, and asked terms with their frequency."""

    def __init__(self):
        self.docs = self.bytes = self.counted = self.total = 0
        self.ids, self.lengths, self.sizes, self.terms, self.tfs = [], [], [], [], []

    def add(self, ids: pa.Array, data: np.ndarray, offsets: np.ndarray, bits: np.ndarray) -> None:
        words = Words(data, offsets, ALNUM_LOWER)
        lengths = words.counts()
        self.counted += int((lengths > 0).sum())
        self.total += len(words)
        hashes, owner = words.hashes(), words.documents()
        lead = (hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)
        kept = np.flatnonzero(bits[lead >> 5] >> (lead & 31) & 1)
        vocabulary, at = np.unique(hashes[kept].view(np.int64), return_inverse=True)
        pairs, tfs = np.unique(owner[kept] * max(len(vocabulary), 1) + at, return_counts=True)
        holder, at = np.divmod(pairs, max(len(vocabulary), 1))
        sizes = np.bincount(holder, minlength=len(lengths))
        some = np.flatnonzero(sizes)
        self.ids.append(ids.take(pa.array(some)))
        self.lengths.append(lengths[some])
        self.sizes.append(sizes[some])
        self.terms.append(vocabulary[at])
        self.tfs.append(tfs)
        self.docs += len(some)
        self.bytes += len(data)

    def row(self) -> pa.RecordBatch:
        terms = np.concatenate(self.terms)
        vocabulary, coords = np.unique(terms, return_inverse=True)
        ids = pa.concat_arrays(self.ids)
        return _one_row(
            {
                "ids": (pa.list_(ids.type), ids),
                "lengths": (_LONGS, np.concatenate(self.lengths)),
                "sizes": (pa.binary(), _packed(np.concatenate(self.sizes))),
                "vocabulary": (_LONGS, vocabulary),
                "held_by": (_INTS, np.bincount(coords, minlength=len(vocabulary))),
                "coords": (pa.binary(), _packed(coords)),
                "tfs": (pa.binary(), _packed(np.concatenate(self.tfs))),
                "counted": (pa.int64(), self.counted),
                "total": (pa.int64(), self.total),
            }
        )


def segments(docs: DataFrame, bits: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """A row per segment: its documents' ids, lengths and term frequencies, and the counts of all its documents."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = _Segment()
        for batch in batches:
            for part, data, offsets in pieces(batch, "text__"):
                segment.add(part.column("id__"), data, offsets, shared.value)
                if segment.docs >= SEGMENT_DOCS or segment.bytes >= SEGMENT_BYTES:
                    yield segment.row()
                    segment = _Segment()
        if segment.bytes:
            yield segment.row()

    picked = docs.select(F.col(id_col).alias("id__"), F.col(text_col).alias("text__"))
    kind = picked.schema["id__"].dataType.simpleString()
    shape = (
        f"ids array<{kind}>, lengths array<bigint>, sizes binary, vocabulary array<bigint>, held_by array<int>, "
        "coords binary, tfs binary, counted long, total long"
    )
    return picked.mapInArrow(run, shape)


def impact(tf: np.ndarray, n: np.ndarray, counted: int, total: int) -> np.ndarray:
    """What a term adds to the score of a document, apart from the term's weight."""
    m = 100 - 90 + (90 * n * counted) // max(total, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weighted(terms: DataFrame, parts: DataFrame, counted: int) -> DataFrame:
    """item__, term, w: queries with their terms' weights; terms that no document has are gone."""
    held = parts.select(F.explode(F.arrays_zip("vocabulary", "held_by")).alias("v"))
    df = held.groupBy(F.col("v.vocabulary").alias("term")).agg(F.sum("v.held_by").alias("df"))
    ratio = F.lit(float(2 * counted + 2)) / (2 * F.col("df") + 1).cast("double")
    return terms.join(df, "term").select("item__", "term", F.floor(1000 * F.log(ratio)).cast("long").alias("w"))


# --- blocks ------------------------------------------------------------------------


def _directions(starts: np.ndarray, coords: np.ndarray, impacts: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Unit vectors of the documents, projected by the bits of the terms' hashes."""
    held_by = np.bincount(coords, minlength=len(vocabulary))
    rarity = np.log1p(len(starts) / held_by).astype(np.float32)
    signs = ((vocabulary[:, None] >> np.arange(PROJECTED)) & 1).astype(np.float32) * 2 - 1
    found = np.add.reduceat((impacts * rarity[coords]).astype(np.float32)[:, None] * signs[coords], starts, axis=0)
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)


def _clusters(docs: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Block of each document of a list: the centre, itself in the list, that it is most like."""
    n = min(LIST_BLOCKS, len(docs) // BLOCK_DOCS)
    if n < 2:
        return np.zeros(len(docs), dtype=np.int64)
    centres = docs[np.arange(n) * len(docs) // n]
    nearest = (directions[docs] @ directions[centres].T).argmax(axis=1)
    return np.unique(nearest, return_inverse=True)[1]


def _summaries(keys: np.ndarray, levels: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys below ``size``, ascending, and the highest level of each."""
    if len(keys) * 8 > size:
        highest = np.zeros(size, dtype=np.uint8)
        np.maximum.at(highest, keys, levels)
        held = np.flatnonzero(highest)
        return held, highest[held]
    order = np.argsort(keys, kind="stable")
    held, first = np.unique(keys[order], return_index=True)
    return held, np.maximum.reduceat(levels[order], first)


def _blocked(batch: pa.RecordBatch, row: int, counted: int, total: int) -> dict[str, tuple[pa.DataType, object]]:
    """The index row of a segment."""
    sizes, coords = (_unpacked(batch, c, row).astype(np.int64) for c in ("sizes", "coords"))
    vocabulary = _column(batch, "vocabulary", row)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    impacts = impact(_unpacked(batch, "tfs", row).astype(np.int64), _column(batch, "lengths", row)[owner], counted, total)
    step = max(1, -(-int(impacts.max(initial=0)) // _LEVELS))
    levels = (-(-impacts // step)).astype(np.uint8)
    directions = _directions(starts, coords, impacts, vocabulary)
    order = np.argsort(coords, kind="stable")
    edges = np.searchsorted(coords[order], np.arange(len(vocabulary) + 1))
    held, blocks, block_sizes, places, block_levels, summary_sizes = [], [], [], [], [], []
    before = 0
    for t in range(len(vocabulary)):
        docs = owner[order[edges[t] : edges[t + 1]]]
        block = _clusters(docs, directions)
        n = int(block.max(initial=0)) + 1
        held.append(docs[np.argsort(block, kind="stable")])
        blocks.append(n)
        block_sizes.append(np.bincount(block, minlength=n))
        entries = _ranges(starts[docs], sizes[docs])
        keys = np.repeat(block, sizes[docs]) * len(vocabulary) + coords[entries]
        found, highest = _summaries(keys, levels[entries], n * len(vocabulary))
        places.append(found + before * len(vocabulary))
        block_levels.append(highest)
        summary_sizes.append(np.bincount(found // len(vocabulary), minlength=n))
        before += n
    ids = batch.column("ids")[row].values
    arrays = {
        "sizes": sizes,
        "coords": coords,
        "impacts": impacts,
        "held": np.concatenate(held),
        "blocks": np.array(blocks),
        "block_sizes": np.concatenate(block_sizes),
        "summary_sizes": np.concatenate(summary_sizes),
        # Block and coordinate as one ascending number, of which the gaps take least room.
        "summary_gaps": np.diff(np.concatenate(places), prepend=0),
        "summary_levels": np.concatenate(block_levels),
    }
    return {
        "ids": (pa.list_(ids.type), ids),
        "vocabulary": (_LONGS, vocabulary),
        "step": (pa.int64(), step),
        **{name: (pa.binary(), _packed(numbers)) for name, numbers in arrays.items()},
    }


_INDEX = (
    "vocabulary array<bigint>, step long, sizes binary, coords binary, impacts binary, held binary, blocks binary, "
    "block_sizes binary, summary_sizes binary, summary_gaps binary, summary_levels binary"
)


def blocked_index(parts: DataFrame, counted: int, total: int) -> DataFrame:
    """Segments with blocked posting lists and their summaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                if len(batch.column("ids")[row].values):
                    yield _one_row(_blocked(batch, row, counted, total))

    kind = parts.schema["ids"].dataType.simpleString()
    return parts.drop("held_by", "counted", "total").mapInArrow(run, f"ids {kind}, {_INDEX}")


# --- search ------------------------------------------------------------------------


class _Index:
    """One segment of the index, ready to be searched."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        get = lambda name: _unpacked(batch, name, row).astype(np.int64)
        self.ids = batch.column("ids")[row].values
        self.vocabulary = _column(batch, "vocabulary", row)
        self.sizes, self.coords, self.impacts = get("sizes"), get("coords"), get("impacts")
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.held, self.blocks, self.block_sizes = get("held"), get("blocks"), get("block_sizes")
        self.first_block = np.cumsum(self.blocks) - self.blocks
        self.block_starts = np.cumsum(self.block_sizes) - self.block_sizes
        self.summary_sizes = get("summary_sizes")
        places = np.cumsum(_unpacked(batch, "summary_gaps", row), dtype=np.int64)
        self.summary_coords = (places % len(self.vocabulary)).astype(np.int32)
        self.summary_starts = np.cumsum(self.summary_sizes) - self.summary_sizes
        self.summary_levels = _unpacked(batch, "summary_levels", row)
        self.step = batch.column("step")[row].as_py()
        self.highest = np.zeros(len(self.vocabulary), dtype=np.int64)
        np.maximum.at(self.highest, self.coords, self.impacts)
        # Weight of each coordinate for the query at hand.
        self.asked = np.zeros(len(self.vocabulary), dtype=np.int64)

    def _bounds(self, blocks: np.ndarray) -> np.ndarray:
        """The score that no document of a block can exceed."""
        sizes = self.summary_sizes[blocks]
        entries = _ranges(self.summary_starts[blocks], sizes)
        worth = self.summary_levels[entries] * self.asked[self.summary_coords[entries]]
        return np.add.reduceat(worth, np.cumsum(sizes) - sizes) * self.step

    def _scores(self, docs: np.ndarray) -> np.ndarray:
        sizes = self.sizes[docs]
        entries = _ranges(self.starts[docs], sizes)
        return np.add.reduceat(self.impacts[entries] * self.asked[self.coords[entries]], np.cumsum(sizes) - sizes)

    def search(self, coords: np.ndarray, weights: np.ndarray, best: list[tuple], k: int) -> list[tuple]:
        """``best`` (negated score, id is null, id), with this segment's documents taken in."""
        reach = weights * self.highest[coords]
        order = np.argsort(-reach, kind="stable")
        left = np.cumsum(reach[order][::-1])[::-1]
        least = -best[-1][0] if len(best) == k else 1
        self.asked[coords] = weights
        seen = np.zeros(len(self.sizes), dtype=bool)
        for coord, possible in zip(coords[order], left):
            if possible < least:
                break
            blocks = np.arange(self.first_block[coord], self.first_block[coord] + self.blocks[coord])
            blocks = blocks[self._bounds(blocks) >= least]
            docs = self.held[_ranges(self.block_starts[blocks], self.block_sizes[blocks])]
            docs = docs[~seen[docs]]
            if not len(docs):
                continue
            seen[docs] = True
            scores = self._scores(docs)
            good = np.flatnonzero(scores >= least)
            if len(good):
                names = self.ids.take(pa.array(docs[good])).to_pylist()
                found = [(-s, i is None, i) for s, i in zip(scores[good].tolist(), names)]
                best = heapq.nsmallest(k, [*best, *found], key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))
                least = -best[-1][0] if len(best) == k else 1
        self.asked[coords] = 0
        return best


class _Slice:
    """The queries of one slice and the best documents found for each."""

    def __init__(self, batch: pa.RecordBatch, row: int, k: int):
        self.k = k
        items = batch.column("items")[row].values.dictionary_encode("encode")
        self.items = items.dictionary
        owner = items.indices.to_numpy()
        order = np.argsort(owner, kind="stable")
        self.terms, self.weights = _column(batch, "terms", row)[order], _column(batch, "weights", row)[order]
        self.edges = np.searchsorted(owner[order], np.arange(len(self.items) + 1))
        self.best: list[list[tuple]] = [[] for _ in range(len(self.items))]

    def search(self, index: _Index) -> None:
        at = np.minimum(np.searchsorted(index.vocabulary, self.terms), len(index.vocabulary) - 1)
        known = (index.vocabulary[at] == self.terms) & (self.weights > 0)
        for q in range(len(self.items)):
            here = np.arange(self.edges[q], self.edges[q + 1])
            here = here[known[here]]
            if len(here):
                self.best[q] = index.search(at[here], self.weights[here], self.best[q], self.k)

    def rows(self, id_type: pa.DataType) -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(self.best)), [len(b) for b in self.best])
        flat = [r for b in self.best for r in b]
        ids = pa.array([r[2] for r in flat], id_type)
        scores = pa.array([-r[0] for r in flat], pa.int64())
        return pa.RecordBatch.from_arrays([self.items.take(pa.array(owner)), ids, scores], ["item__", "id__", "score"])


def slices_of(queries: DataFrame, slice_terms: int = SLICE_TERMS) -> tuple[DataFrame, int]:
    """Rows of at most about ``slice_terms`` query terms each, and their number."""
    n = max(1, -(-queries.count() // slice_terms))
    dealt = queries.withColumn("slice", F.pmod(F.xxhash64("item__"), F.lit(n)))
    packed = dealt.groupBy("slice").agg(F.collect_list(F.struct("item__", "term", "w")).alias("q"))
    return packed.select(
        "slice", F.col("q.item__").alias("items"), F.col("q.term").alias("terms"), F.col("q.w").alias("weights")
    ), n


def _best_rows(found: DataFrame, keys: list, k: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id__").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, k: int = BEST, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """item__, rank, id__, score: the ``k`` best documents of every query."""
    slices, n = slices_of(queries, slice_terms)
    met = index.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    if n == 1:
        met = met.join(F.broadcast(slices), "slice")
    else:
        copies = max(1, index.count() // SEGMENTS_PER_COPY)
        numbers = F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))
        dealt = met.withColumn("copy", F.pmod(F.xxhash64(F.get("ids", F.lit(0)), F.size("ids")), F.lit(copies)))
        met = dealt.join(slices.withColumn("copy", F.explode(numbers)), ["slice", "copy"]).drop("copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, number, id_type = None, None, None
        for batch in batches:
            id_type = batch.column("ids").type.value_type
            for row in range(batch.num_rows):
                if batch.column("slice")[row].as_py() != number:
                    if state is not None:
                        yield state.rows(id_type)
                    state, number = _Slice(batch, row, k), batch.column("slice")[row].as_py()
                state.search(_Index(batch, row))
        if state is not None:
            yield state.rows(id_type)

    item = queries.schema["item__"].dataType.simpleString()
    name = index.schema["ids"].dataType.elementType.simpleString()
    found = met.mapInArrow(run, f"item__ {item}, id__ {name}, score long")
    # In two steps, so that a query's rows from all segments need not meet in one task.
    part = F.pmod(F.xxhash64("id__"), F.lit(64))
    return _best_rows(_best_rows(found, ["item__", part], k), ["item__"], k)


def build(docs: DataFrame, queries: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str) -> tuple[DataFrame, DataFrame]:
    """The blocked index of ``docs`` for the terms of ``queries``, and the weighted queries; both stored."""
    spark = docs.sparkSession
    folder = work_dir(spark, "ranked-search")

    def stored(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
        written = df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
        written.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    terms = stored(query_terms(queries, item_col, item_text_col), "terms")
    parts = stored(segments(docs, _asked(terms), id_col, text_col), "segments")
    counted, total = parts.agg(F.sum("counted"), F.sum("total")).first()
    counted, total = counted or 0, total or 0
    asked = stored(weighted(terms, parts, counted), "queries")
    return stored(blocked_index(parts, counted, total), "index", SEGMENTS_PER_FILE), asked


def rank(
    docs: DataFrame, queries: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """item, rank, id, score: the ``k`` best documents of every item, best first."""
    index, asked = build(docs, queries, id_col, text_col, item_col, item_text_col)
    found = search(index, asked, k)
    return found.select(
        F.col("item__").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id__").alias(id_col), "score"
    )
