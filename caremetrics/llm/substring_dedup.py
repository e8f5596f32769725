"""Repeated passages by fixed-block anchors.

A window of ``window`` words that occurs earlier in the table (smaller id, or
earlier in the same document) marks its words for removal. Any window holds a
whole aligned block of half its length, wherever its document puts it. So:

1. Every document's non-overlapping blocks are indexed by their hash.
2. Every rolling block-long window of every document probes the index. Hashes
   are dealt out by value; a task reads the index of its share first, then
   streams the probes past it. The indexed blocks come last: they are hit if
   another block or a probe has their hash.
3. Hits are extended: only windows around a hit can repeat. For those the hash of
   the whole window is compared. A task keeps the first occurrence per hash of
   its own documents and sends only that one; the earliest of all stays, the
   rest are repeats, and runs of them are the maximal exact repeats.

What moves are packed arrays per run of documents and share of the hashes, not a
row per word; texts with hits move packed, too. A passage in a third of all documents is one index entry in step 2
and one window per run of documents in step 3; no pairs are formed.

Blocks are matched by 32 bits of hash besides their share (a chance match costs a
look in step 3), windows by 64 bits.

Null and empty texts have no words. A null id counts as the largest. Rows with
the same id and text are the same place and do not remove one another's words.
Very long documents are packed like others, on their own. An empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremetrics.llm.id_filter import passing
from caremetrics.llm.packing import NAMES, PACKED, by_bucket, dealt, rows_batch, run_numbers, squeezed, unsqueezed
from caremetrics.llm.words import SPACED, Words, column_bytes, id_array, pieces, rolling, window_mask
from caremetrics.session import checkpointed

# Words per window.
WINDOW = 20
# Bytes of text packed together; more make longer arrays and fewer rows.
_RUN = 4 << 20
_INDEX, _PROBES, _BLOCKS, _DOCUMENTS = 0, 1, 2, 9
_LAST_ID = (1 << 63) - 1
# Of zstd, for the texts of a run; a tenth smaller than at its default.
_LEVEL = 3


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers by byte significance, so that leading zeros compress."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(body: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(body.reshape(4, -1).T).view("<u4").reshape(-1)


def _pack(hashes: np.ndarray, at: np.ndarray) -> bytes:
    low = (hashes & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
    return low + _planes(np.diff(at, prepend=0))


def _unpack(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(body, np.uint8)
    half = len(raw) // 2
    return raw[:half].view("<u4"), np.cumsum(_from_planes(raw[half:]), dtype=np.int64)


def _pack_places(hashes: np.ndarray, key: np.ndarray, start: np.ndarray) -> bytes:
    """Windows in the order of the text; steps of the ids, and starts, by byte significance."""
    both = np.stack([np.diff(key, prepend=0), start]).astype("<i8")
    return hashes.astype("<u8").tobytes() + np.ascontiguousarray(both.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack_places(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(body) // 24
    planes = np.frombuffer(body, np.uint8, 16 * n, 8 * n).reshape(8, -1)
    steps, start = np.ascontiguousarray(planes.T).view("<i8").reshape(2, n)
    return np.frombuffer(body, "<u8", n), np.cumsum(steps), start


def _anchors(window: int, buckets: int):
    """Step 1 and the probes of step 2, packed per run of documents."""
    block = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = run_numbers()
        for batch in batches:
            for part, data, offsets in pieces(batch, "text", _RUN):
                words = Words(data, offsets, SPACED)
                rolled = rolling(words.hashes(), block)
                long_enough = np.repeat(words.counts() >= window, words.counts())[: len(rolled)]
                usable = window_mask(words.bounds, block, len(rolled)) & long_enough
                aligned = usable & (words.places()[: len(rolled)] % block == 0)
                number, rows = next(numbers), []
                for bucket, chosen in by_bucket(rolled[at := np.flatnonzero(aligned)], buckets):
                    low = (rolled[at[chosen]] & np.uint64(0xFFFFFFFF)).astype("<u4")
                    rows.append((bucket, _INDEX, number, low.tobytes()))
                    rows.append((bucket, _BLOCKS, number, _pack(rolled[at[chosen]], at[chosen])))
                for bucket, chosen in by_bucket(rolled[at := np.flatnonzero(usable & ~aligned)], buckets):
                    rows.append((bucket, _PROBES, number, _pack(rolled[at[chosen]], at[chosen])))
                if rows:
                    owners = np.concatenate([id_array(part.column("key")), words.bounds]).astype("<i8").tobytes()
                    yield rows_batch([*rows, (number % buckets, _DOCUMENTS, number, owners)])

    return run


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2 for the shares of one task, rows ordered by bucket and kind."""
    current, index = None, []
    keys = several = probed = np.empty(0)
    for batch in batches:
        out = []
        for bucket, kind, number, body in zip(*(batch.column(c).to_pylist() for c in NAMES)):
            if bucket != current:
                current, index, keys = bucket, [], None
            if kind == _DOCUMENTS:
                out.append((bucket, _DOCUMENTS, number, body))
                continue
            if kind == _INDEX:
                index.append(np.frombuffer(body, "<u4"))
                if len(index) > 1000:  # kept twice at most, which is all that counts
                    merged, n = np.unique(np.concatenate(index), return_counts=True)
                    index = [merged, merged[n > 1]]
                continue
            if keys is None:
                keys, n = np.unique(np.concatenate(index or [np.empty(0, "<u4")]), return_counts=True)
                several, probed, index = n > 1, np.zeros(len(keys), dtype=bool), []
            if not len(keys):
                continue
            low, at = _unpack(body)
            place = np.minimum(np.searchsorted(keys, low), len(keys) - 1)
            hit = keys[place] == low
            if kind == _PROBES:
                probed[place[hit]] = True
            else:
                hit &= several[place] | probed[place]
            if hit.any():
                out.append((bucket, _PROBES, number, at[hit].astype("<i8").tobytes()))
        yield rows_batch(out)


def _hits_by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits of a run, which arrive in parts, as word places of its documents."""
    current, parts, owners = None, [], None

    def told() -> list[tuple]:
        if owners is None or not parts:
            return []
        n = (len(owners) - 1) // 2
        ids, bounds = owners[:n], owners[n:]
        at = np.unique(np.concatenate(parts))
        doc = np.searchsorted(bounds, at, side="right") - 1
        edges = np.searchsorted(doc, np.arange(n + 1))
        return [(int(ids[d]), (at[edges[d] : edges[d + 1]] - bounds[d]).astype(np.int32)) for d in np.unique(doc)]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        keys, places = zip(*rows) if rows else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(places, pa.list_(pa.int32()))], ["key", "hits"])

    for batch in batches:
        for kind, number, body in zip(*(batch.column(c).to_pylist() for c in NAMES[1:])):
            if number != current:
                yield batch_of(told())
                current, parts, owners = number, [], None
            values = np.frombuffer(body, "<i8")
            if kind == _DOCUMENTS:
                owners = values
            else:
                parts.append(values)
    yield batch_of(told())


class _Windows:
    """All whole windows of a run of documents, and which of them repeat inside the run."""

    def __init__(self, keys: np.ndarray, data: np.ndarray, offsets: np.ndarray, window: int, wanted: np.ndarray | None = None):
        self.words = Words(data, offsets, SPACED)
        rolled = rolling(self.words.hashes(), window)
        usable = window_mask(self.words.bounds, window, len(rolled))
        if wanted is not None:
            usable &= wanted[: len(rolled)]
        self.at = np.flatnonzero(usable)
        self.hash = rolled[self.at]
        self.key = keys[self.words.documents()[self.at]]
        self.start = self.words.places()[self.at]
        self.first, self.later = _firsts(self.hash, self.key, self.start)


def _firsts(hashes: np.ndarray, key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first place per hash, and a mask of the places after it."""
    order = np.lexsort((start, key, hashes))
    new = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]) if len(order) else np.empty(0, dtype=bool)
    first = order[new]
    leader = first[np.cumsum(new) - 1] if len(order) else order
    later = np.zeros(len(order), dtype=bool)
    later[order] = (key[order] != key[leader]) | (start[order] != start[leader])
    return first, later


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, _, _ in pieces(batch, "text", _RUN):
            yield pa.RecordBatch.from_arrays([part.column("key"), *squeezed(part.column("text"))], ["key", "size", "body"])


def _candidates(window: int, buckets: int):
    """Step 3: windows around hits; the first of each hash is sent on, with the texts for the end."""
    block = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, packer = run_numbers(), pa.Codec("zstd", compression_level=_LEVEL)
        for batch in batches:
            unpacked = [batch.column("key"), unsqueezed(batch.column("size"), batch.column("body")), batch.column("hits")]
            batch = pa.RecordBatch.from_arrays(unpacked, ["key", "text", "hits"])
            for part, data, offsets in pieces(batch, "text", _RUN):
                words = Words(data, offsets, SPACED)
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                for d, hits in enumerate(part.column("hits")):
                    lo, hi = words.bounds[d], words.bounds[d + 1]
                    at = lo + hits.values.to_numpy()
                    at = at[at < hi]
                    np.add.at(edges, np.maximum(at - (window - block), lo), 1)
                    np.add.at(edges, at + 1, -1)
                keys = id_array(part.column("key"))
                found = _Windows(keys, data, offsets, window, np.cumsum(edges[:-1]) > 0)
                number, rows = next(numbers), []
                sent = np.sort(found.first)  # in the order of the text, which packs well
                for bucket, chosen in by_bucket(found.hash[sent], buckets):
                    picked = sent[chosen]
                    rows.append((bucket, _PROBES, number, _pack_places(found.hash[picked], found.key[picked], found.start[picked])))
                head = np.concatenate([[len(keys)], keys, offsets]).astype("<i8").tobytes()
                texts = packer.compress(data.tobytes(), asbytes=True)
                yield rows_batch([*rows, (number % buckets, _DOCUMENTS, number, head + texts)])

    return run


def _earliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: tell each run which of its first windows occur earlier elsewhere."""
    current, held = None, []

    def told() -> list[tuple]:
        if not held:
            return []
        hashes, key, start = (np.concatenate(x) for x in zip(*(_unpack_places(body) for _, body in held)))
        number = np.repeat([n for n, _ in held], [len(body) // 24 for _, body in held])
        _, later = _firsts(hashes, key, start)
        numbers, hashes = number[later], hashes[later]
        order = np.argsort(numbers, kind="stable")
        some, at = np.unique(numbers[order], return_index=True)
        return [(current, _PROBES, int(n), h.tobytes()) for n, h in zip(some, np.split(hashes[order], at[1:]))]

    for batch in batches:
        out = []
        for bucket, kind, number, body in zip(*(batch.column(c).to_pylist() for c in NAMES)):
            if bucket != current:
                out += told()
                current, held = bucket, []
            if kind == _DOCUMENTS:
                out.append((bucket, kind, number, body))
            else:
                held.append((number, body))
        yield rows_batch(out)
    yield rows_batch(told())


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _removals(window: int):
    """Per document with repeated windows: what is left of it."""
    names = ["key", "whole_sha256", "n_removed", "kept_sha256"]

    def finished(body: bytes, repeated: list[np.ndarray]) -> list[tuple]:
        n = int(np.frombuffer(body[:8], "<i8")[0])
        head = np.frombuffer(body[: 8 * (2 * n + 2)], "<i8")
        keys, offsets = head[1 : n + 1], head[n + 1 :]
        texts = pa.decompress(body[8 * (2 * n + 2) :], int(offsets[-1]), "zstd", asbytes=True)
        data = np.frombuffer(texts, np.uint8)
        found = _Windows(keys, data, offsets, window)
        gone = found.later | np.isin(found.hash, np.concatenate(repeated or [np.empty(0, "<u8")]))
        words = found.words
        edges = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(edges, found.at[gone], 1)
        np.add.at(edges, found.at[gone] + window, -1)
        kept = np.cumsum(edges[:-1]) == 0
        rows = []
        for d in range(n):
            mine = kept[words.bounds[d] : words.bounds[d + 1]]
            if not mine.all():
                body = data[offsets[d] : offsets[d + 1]].tobytes().split()
                rows.append((int(keys[d]), _digest(body), int((~mine).sum()), _digest(list(compress(body, mine)))))
        return rows

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * 4
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, repeated, body = None, [], None
        for batch in batches:
            for i, (kind, number) in enumerate(zip(batch.column("kind").to_pylist(), batch.column("run").to_pylist())):
                if number != current:
                    if body is not None:
                        yield batch_of(finished(body, repeated))
                    current, repeated, body = number, [], None
                value = batch.column("body")[i].as_py()
                if kind == _DOCUMENTS:
                    body = value
                else:
                    repeated.append(np.frombuffer(value, "<u8"))
        if body is not None:
            yield batch_of(finished(body, repeated))

    return run


def _whole(id_col: str):
    """Per document: words, and the digest of all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            split = (data[a:b].tobytes().split() for a, b in zip(offsets[:-1], offsets[1:]))
            n, digests = zip(*[(len(w), _digest(w)) for w in split]) if batch.num_rows else ((), ())
            arrays = [batch.column(id_col), batch.column("key"), pa.array(n, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [id_col, "key", "n_words", "whole_sha256"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256. ``window`` must be even."""
    if window % 2:
        raise ValueError("a window must have an even number of words")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = docs.select(
        F.col(id_col).cast("long").alias(id_col),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("key"),
        F.col(text_col).alias("text"),
    )
    keyed = needed.select("key", "text")

    packed = keyed.mapInArrow(_anchors(window, buckets), PACKED)
    probed = dealt(packed, "bucket").mapInArrow(_probe, PACKED)
    hits = dealt(probed, "run").mapInArrow(_hits_by_document, "key long, hits array<int>")
    # A few numbers per document, read twice. Rows of one id share their hits.
    merged = checkpointed(hits.groupBy("key").agg(F.flatten(F.collect_list("hits")).alias("hits")))
    texts = passing(keyed, merged.select("key"), "key", _packed_texts, "key long, size long, body binary")
    around = texts.join(merged, "key").mapInArrow(_candidates(window, buckets), PACKED)
    compared = dealt(around, "bucket").mapInArrow(_earliest, PACKED)
    removed = dealt(compared, "run").mapInArrow(
        _removals(window), "key long, whole_sha256 string, n_removed long, kept_sha256 string"
    )
    # One id with one text has one outcome, however often the row occurs.
    removed = removed.groupBy("key", "whole_sha256").agg(
        F.max("n_removed").alias("n_removed"), F.max("kept_sha256").alias("kept_sha256")
    )
    whole = needed.mapInArrow(_whole(id_col), f"{id_col} long, key long, n_words long, whole_sha256 string")
    return whole.join(removed, ["key", "whole_sha256"], "left").select(
        id_col,
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )
