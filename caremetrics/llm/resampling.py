"""Importance resampling towards a target distribution, by bit-sliced sums.

Features are runs of one and two words, hashed into buckets. The gain of a bucket is
the scaled logarithm of how much more frequent it is in the target texts than in the
documents. A document's weight is the mean gain of its features, and a share of the
documents is drawn by weight plus Gumbel noise from a hash of the id, which draws
without replacement in proportion to the exponential of the weights.

Sums are bit-sliced. A document's bucket counts become planes: plane ``i`` has one
bit per bucket, bit ``i`` of its count. The gains become planes likewise, apart for
gains above and below zero. A count plane and a gain plane are combined by AND, the
bits left are counted, and the counts are summed times the two planes' powers of two.
That is the exact sum of count times gain over all buckets.

The corpus is counted in one pass (a task hands on at most one number per bucket),
weighed in a second one that moves nothing but ids and numbers, and the draw is
numbered in ranges of the score, so that no task orders the whole table.

Null and empty texts have no words, no features and weight 0. Rows repeated under an
id are weighed and ranked each. A null id takes the noise of an empty id and comes
first among equal scores. Without target texts every target count is 0; an empty
table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremetrics.functions.ordering import with_ordinal
from caremetrics.llm.words import ALNUM_LOWER, Words, pieces
from caremetrics.session import checkpointed

BUCKETS = 10_000
SEED = 7
# Words that a document needs to be drawn, and the share that is drawn.
LEAST_WORDS = 20
PERCENT = 25

# Words of more bytes are hashed one by one.
_SHORT = 64
# Documents whose planes are held at once.
_TOGETHER = 128


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The byte table of CRC-32, and for every number of zero bytes up to ``_SHORT`` what they do to a checksum."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    moved = [np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]]
    for _ in range(_SHORT):
        moved.append(table[moved[-1] & 255] ^ (moved[-1] >> 8))
    return table, np.stack(moved)


_TABLE, _MOVED = _crc_tables()


def _step(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _TABLE[(state ^ byte) & 255] ^ (state >> 8)


def checksums(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of every word, and of every word followed by a space."""
    lengths = words.ends - words.starts
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = words.starts[order], lengths[order]
    state = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    short = np.searchsorted(-sizes, -_SHORT)
    for at in range(int(sizes[short]) if short < len(sizes) else 0):
        upto = np.searchsorted(-sizes, -at)
        state[short:upto] = _step(state[short:upto], words.mapped[starts[short:upto] + at])
    for k in range(short):
        body = words.mapped[starts[k] : starts[k] + sizes[k]].tobytes()
        state[k] = zlib.crc32(body) ^ 0xFFFFFFFF
    plain = np.empty(len(order), dtype=np.uint32)
    spaced = np.empty(len(order), dtype=np.uint32)
    plain[order] = ~state
    spaced[order] = ~_step(state, 0x20)
    return plain, spaced


def _joined(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksum of two strings in a row, from theirs and the bytes of the second."""
    first = first.copy()
    left = size.copy()
    while (left > _SHORT).any():
        more = left > _SHORT
        first[more] = _moved(first[more], np.full(more.sum(), _SHORT))
        left[more] -= _SHORT
    return _moved(first, left) ^ second


def _moved(state: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = _MOVED[size, 0, state & 255]
    for k in range(1, 4):
        out ^= _MOVED[size, k, (state >> (8 * k)) & 255]
    return out


def feature_buckets(words: Words, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every run of one or two words."""
    plain, spaced = checksums(words)
    owner = words.documents()
    pairs = np.flatnonzero(owner[:-1] == owner[1:])
    lengths = (words.ends - words.starts)[pairs + 1]
    twos = _joined(spaced[pairs], plain[pairs + 1], lengths)
    documents = np.concatenate([owner, owner[pairs]])
    return documents, (np.concatenate([plain, twos]) % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts by bucket, where there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, data, offsets in pieces(batch, "text__"):
                _, found = feature_buckets(Words(data, offsets, ALNUM_LOWER), buckets)
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    counted = texts.select(F.col(text_col).alias("text__")).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(
    docs: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS
) -> np.ndarray:
    """Gain of every bucket. One number per bucket reaches the driver, whatever the size of the tables."""
    spark = docs.sparkSession
    held = bucket_counts(docs, text_col, buckets).withColumnRenamed("n", "s")
    aimed = bucket_counts(target, text_col, buckets).withColumnRenamed("n", "t")
    both = spark.range(buckets).withColumnRenamed("id", "bucket").join(held, "bucket", "left").join(aimed, "bucket", "left")
    both = checkpointed(both.select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")]))
    sums = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = ((F.col("t") + 1) * F.lit(sums["s"] + buckets)) / ((F.col("s") + 1) * F.lit(sums["t"] + buckets))
    rows = both.select("bucket", F.floor(F.lit(1000) * F.log(ratio)).cast("long").alias("gain")).collect()
    gains = np.zeros(buckets, dtype=np.int64)
    for bucket, gain in rows:
        gains[bucket] = gain
    return gains


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    raw = np.packbits(bits, axis=1, bitorder="little")
    padded = np.zeros((len(raw), -(-raw.shape[1] // 8) * 8), dtype=np.uint8)
    padded[:, : raw.shape[1]] = raw
    return padded.view(np.uint64)


def planes_of(numbers: np.ndarray) -> np.ndarray:
    """Bit planes (plane, word) of one row of numbers that are not negative."""
    size = int(numbers.max(initial=0)).bit_length()
    return _packed((numbers[None, :] >> np.arange(size)[:, None]) & 1 == 1)


class GainPlanes:
    """Signed planes of gains, to be met by planes of counts."""

    def __init__(self, gains: np.ndarray):
        self.signed = [(1, planes_of(np.maximum(gains, 0))), (-1, planes_of(np.maximum(-gains, 0)))]

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """For every row of counts the sum of count times gain."""
        total = np.zeros(len(counts), dtype=np.int64)
        highest = counts.max(axis=1)
        for i in range(int(highest.max(initial=0)).bit_length()):
            rows = np.flatnonzero(highest >> i)
            plane = _packed((counts[rows] >> i) & 1 == 1)
            for sign, gain_planes in self.signed:
                for j, gain_plane in enumerate(gain_planes):
                    left = np.bitwise_count(plane & gain_plane).sum(axis=1, dtype=np.int64)
                    total[rows] += sign * (left << (i + j))
        return total


_WEIGHED = ["n_words", "n_features", "weight"]


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_features, weight of every row."""
    buckets = len(gains)
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = GainPlanes(shared.value)
        for batch in batches:
            for part, data, offsets in pieces(batch, "text__"):
                words = Words(data, offsets, ALNUM_LOWER)
                owner, found = feature_buckets(words, buckets)
                order = np.argsort(owner, kind="stable")
                owner, found = owner[order], found[order]
                n_words = words.counts()
                n_features = np.maximum(2 * n_words - 1, 0)
                sums = np.zeros(len(n_words), dtype=np.int64)
                for lo in range(0, len(n_words), _TOGETHER):
                    hi = min(lo + _TOGETHER, len(n_words))
                    a, b = np.searchsorted(owner, (lo, hi))
                    cells = np.bincount((owner[a:b] - lo) * buckets + found[a:b], minlength=(hi - lo) * buckets)
                    sums[lo:hi] = planes.sums(cells.reshape(hi - lo, buckets))
                weight = sums // np.maximum(n_features, 1)
                arrays = [part.column("id__"), *(pa.array(c, pa.int64()) for c in (n_words, n_features, weight))]
                yield pa.RecordBatch.from_arrays(arrays, ["id__", *_WEIGHED])

    picked = docs.select(F.col(id_col).alias("id__"), F.col(text_col).alias("text__"))
    kind = picked.schema["id__"].dataType.simpleString()
    return picked.mapInArrow(run, f"id__ {kind}, n_words long, n_features long, weight long").withColumnRenamed("id__", id_col)


def noise(id_: Column, seed: int = SEED) -> Column:
    """A thousandfold Gumbel variate from a hash of the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """id, n_words, n_features, weight, score and rank of every row; what is not drawn has no rank."""
    gains = bucket_gains(docs, target, text_col, buckets)
    scored = weigh(docs, gains, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col(id_col), seed))
    scored = checkpointed(scored)
    fits = F.col("n_words") >= least_words
    wanted = scored.where(fits).count() * percent // 100
    key = F.struct((-F.col("score")).alias("score"), F.col(id_col).alias("id"))
    placed = with_ordinal(scored.where(fits).withColumn("key__", key), "key__", out="at__")
    rank = F.when(F.col("at__") <= wanted, F.col("at__")).cast("long")
    columns = [id_col, *_WEIGHED, "score"]
    return placed.select(*columns, rank.alias("rank")).union(
        scored.where(~fits).select(*columns, F.lit(None).cast("long").alias("rank"))
    )


def drawn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose id was drawn."""
    ids = resample(docs, target, id_col=id_col, **options).where("rank IS NOT NULL").select(F.col(id_col).alias("drawn__"))
    return docs.join(ids, F.col(id_col) == F.col("drawn__"), "left_semi")
