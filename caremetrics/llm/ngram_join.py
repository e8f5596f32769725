"""Jaccard join of documents on word n-grams, filtered under several token orders.

A document's set holds its distinct shingles. If two sets reach the similarity,
then under *any* order of all shingles their prefixes (the first
``size - required overlap + 1`` shingles) share one. Order 1 goes from rare to
frequent and generates candidates; orders 2 and 3 are by hash and must agree: a
candidate goes on only if its prefixes share a shingle in each of them and do
not already differ in more shingles than the similarity allows. The rest is
verified on the full sets. Sets of equal digest are one class from the start.

Every set also has a parity sketch: each shingle flips one of 512 bits. Shingles
that two sets have in common cancel out, so the bits in which two sketches
differ never outnumber the shingles in which the sets do, and a pair whose
sketches differ more than the similarity allows cannot link. With sketches folded
to 128 bits this is a condition of the join that makes candidates across
components, so most such pairs never become rows; then whole sketches are compared.

Links between classes are found without listing all pairs of a group. First
every member of a posting list is verified against a few pivots of the list;
links give components. Pairs inside one component are settled by that. Then, and
for lists that still hold several components only, every pair across components
is compared, filtered and verified. So every link that joins two components is
found, whatever the size of the list, and the components are exact. Long lists are
split: a part of a list meets the whole list in a task of its own.

Verification streams: candidates of a pivot are dealt over several tasks, each
of which reads the pivot's set once and its members one at a time.

Null and empty texts have empty sets, which link with nothing. A document with
fewer words than a shingle has its whole sequence as its only one. Documents
with the same id count as one with respect to components. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremetrics.llm.components import connected
from caremetrics.llm.id_filter import passing
from caremetrics.llm.words import SPACED_LOWER, Words, mix, pieces, rolling, window_mask
from caremetrics.session import checkpointed, work_dir

# Slots of the frequency sketch that orders shingles; a fixed size.
SLOTS = 1 << 16
# Members verified per copy of a pivot's set.
SHARE = 500
# Sets of more shingles than this keep 32 bits of the ordering hashes, others 16.
WIDE = 1 << 14
# Words of 64 bits of a parity sketch.
SKETCH = 8
# Words to which sketches are folded where they travel with every posting.
FOLDED = 2
# Members of a posting list that meet the whole list in one task.
PART = 1000
_ORDERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Threshold:
    """Similarity at least ``percent`` of the union, in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1

    def difference(self, a, b):
        """The largest symmetric difference that two sets of these sizes may have."""
        return a + b - 2 * (-(-self.percent * (a + b) // (100 + self.percent)))

    def reached(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)


def _sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a piece."""
    words = Words(data, offsets, SPACED_LOWER)
    hashes = words.hashes()
    rolled = rolling(hashes, width)
    for lo, hi in zip(words.bounds[:-1], words.bounds[1:]):
        if hi - lo >= width:
            yield np.unique(rolled[lo : hi - width + 1])
        elif hi > lo:
            yield mix(rolling(hashes[lo:hi], hi - lo) + np.uint64(hi - lo))
        else:
            yield np.empty(0, dtype=np.uint64)


def _frequencies(docs: DataFrame, text_col: str, width: int) -> np.ndarray:
    """How many documents' shingles fall into each slot: a fixed number of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for _, data, offsets in pieces(batch, text_col):
                words = Words(data, offsets, SPACED_LOWER)
                hashes = words.hashes()
                rolled = rolling(hashes, width)[window_mask(words.bounds, width, len(hashes) - width + 1)]
                total += np.bincount(rolled & np.uint64(SLOTS - 1), minlength=SLOTS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["slot", "n"])

    slots = docs.select(text_col).mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    rows = slots.toPandas()  # at most SLOTS rows
    counts = np.zeros(SLOTS, dtype=np.int64)
    counts[rows["slot"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts


def _bits(n: int) -> int:
    """Bits that a set of this size keeps of an ordering hash: more where 16 would mostly collide."""
    return 16 if n <= WIDE else 32


def _leading(found: np.ndarray, order: np.uint64, p: int) -> bytes:
    """The first ``p`` shingles under a hash order: ascending numbers as differences, low bytes first, which packs well."""
    bits = _bits(len(found))
    ordered = np.sort((mix(found ^ order) >> np.uint64(64 - bits)).astype(f"u{bits // 8}"))[:p]
    steps = np.diff(ordered, prepend=ordered.dtype.type(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, bits // 8).T).tobytes()


def _read(body: bytes, bits: int) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(bits // 8, -1).T).view(f"u{bits // 8}").reshape(-1)
    return np.cumsum(steps, dtype=steps.dtype)


def _allowed(a: bytes, b: bytes, n: int, other_n: int, most: int) -> bool:
    """Whether two prefixes share a number and do not already differ in more than ``most`` shingles.

    Numbers are counted as often as they occur, so shingles that collide never add to the
    difference. At the smaller of the last numbers a prefix may end between equal ones,
    so the difference counts those below it only, which both prefixes hold in full.
    """
    x, y = _read(a, _bits(n)), _read(b, _bits(other_n))
    if _bits(n) < _bits(other_n):
        y = (y >> 16).astype(x.dtype)
    elif _bits(n) > _bits(other_n):
        x = (x >> 16).astype(y.dtype)
    cut = min(x[-1], y[-1])
    held = [np.unique(v[v <= cut], return_counts=True) for v in (x, y)]
    common, at, other_at = np.intersect1d(held[0][0], held[1][0], assume_unique=True, return_indices=True)
    below = common < cut
    shared = np.minimum(held[0][1][at[below]], held[1][1][other_at[below]]).sum()
    return len(common) > 0 and (x < cut).sum() + (y < cut).sum() - 2 * shared <= most


def _parities(found: np.ndarray) -> np.ndarray:
    """The parity sketch of a set: bit ``j`` tells whether an odd number of shingles falls on ``j``."""
    bits = np.bincount((mix(found) >> np.uint64(32)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


_SIGNATURE = [
    T.StructField("n", T.LongType()),
    T.StructField("digest", T.StringType()),
    T.StructField("prefix", T.ArrayType(T.LongType())),
    T.StructField("second", T.BinaryType()),
    T.StructField("third", T.BinaryType()),
    T.StructField("sketch", T.ArrayType(T.LongType())),
]


def _signatures(docs: DataFrame, id_col: str, text_col: str, width: int, threshold: Threshold) -> DataFrame:
    """Per document: set size, digest, prefix under order 1, under orders 2 and 3, and parity sketch.

    Prefixes 2 and 3 are leading bits of the ordering hash; two shingles that agree in
    them count as the same, which only weakens the filter.
    """
    counts = docs.sparkSession.sparkContext.broadcast(_frequencies(docs, text_col, width))
    needed = docs.select(F.col(id_col).cast("long").alias("id"), text_col)

    def row(found: np.ndarray) -> tuple:
        n = len(found)
        p = threshold.prefix(n) if n else 0
        rarity = counts.value[(found & np.uint64(SLOTS - 1)).astype(np.int64)]
        first = found[np.lexsort((found, rarity))[:p]]
        others = [_leading(found, o, p) for o in _ORDERS]
        return n, hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest(), first.view(np.int64), *others, _parities(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, text_col):
                columns = list(zip(*[row(found) for found in _sets(data, offsets, width)]))
                arrays = [pa.array(c, f) for c, f in zip(columns, (pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int64())))]
                yield pa.RecordBatch.from_arrays([part.column("id"), *arrays], ["id", *[f.name for f in _SIGNATURE]])

    return needed.mapInArrow(run, T.StructType([T.StructField("id", T.LongType()), *_SIGNATURE]))


def _postings(signatures: DataFrame, threshold: Threshold) -> DataFrame:
    """token, id, n, place in the prefix, and the length band, for tokens that several sets hold.

    Sets whose sizes can match lie in one band or in neighbouring ones.
    """
    step = float(np.log(100 / threshold.percent)) * (1 + 1e-9)  # an exact quotient stays within one step
    band = F.floor(F.log("n") / F.lit(step)).cast("int")
    listed = signatures.select("id", F.col("n").cast("int").alias("n"), band.alias("band"), F.posexplode("prefix").alias("place", "token"))
    shared = listed.groupBy("token").agg(F.count("*").alias("held")).where("held > 1").select("token")
    return listed.join(shared, "token", "left_semi").select("token", "band", "id", "n", "place")


def _lengths_fit(threshold: Threshold, a: str = "n", b: str = "other_n"):
    return (F.col(a) * 100 >= F.col(b) * threshold.percent) & (F.col(b) * 100 >= F.col(a) * threshold.percent)


def _most(threshold: Threshold):
    """``Threshold.difference`` of the columns ``n`` and ``other_n``."""
    both = F.col("n") + F.col("other_n")
    return both - 2 * F.ceil(both * threshold.percent / (100 + threshold.percent))


def _sketches_fit(threshold: Threshold, words: int = SKETCH):
    """Whether two sketches differ in no more bits than the sets may differ in shingles."""
    differ = F.lit(0)
    for i in range(words):
        differ = differ + F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("other_sketch")[i]))
    return differ <= _most(threshold)


def _places_fit(threshold: Threshold):
    """Whether two sets may be similar that share the shingle at these places of one order.

    Of the shingles before it, and of those after it, the longer side holds some that the other lacks.
    """
    ahead = F.col("place") - F.col("other_place")
    return F.abs(ahead) + F.abs(F.col("n") - F.col("other_n") - ahead) <= _most(threshold)


def _folded(words: int):
    """The parity sketch of the same set in fewer words: words laid on one another cancel like shingles."""
    kept = []
    for i in range(words):
        word = F.col("sketch")[i]
        for j in range(i + words, SKETCH, words):
            word = word.bitwiseXOR(F.col("sketch")[j])
        kept.append(word)
    return F.array(*kept)


def _star_pairs(postings: DataFrame, threshold: Threshold) -> DataFrame:
    """Members of a posting list with two pivots of their band."""
    scrambled = F.xxhash64("id")
    per_list = postings.groupBy("token", "band").agg(
        F.count("*").alias("held"),
        F.min(F.struct("id", "n")).alias("low"),
        F.min(F.struct(scrambled.alias("h"), "id", "n")).alias("any"),
    )
    joined = postings.join(per_list.where("held > 1"), ["token", "band"])
    pivots = F.array(*[F.struct(F.col(f"{p}.id").alias("id"), F.col(f"{p}.n").alias("n")) for p in ("low", "any")])
    pairs = joined.select("id", "n", F.explode(F.array_distinct(pivots)).alias("pivot"))
    pairs = pairs.select("id", "n", F.col("pivot.id").alias("other"), F.col("pivot.n").alias("other_n"))
    return pairs.where((F.col("id") != F.col("other")) & _lengths_fit(threshold)).select("id", "other").distinct()


def _cross_pairs(postings: DataFrame, labels: DataFrame, sketches: DataFrame, threshold: Threshold) -> DataFrame:
    """All pairs of a posting list that lie in different components and whose places and sketches fit.

    Up to the last shared token of the two prefixes, both sets are known in full:
    what they do not share there must not exceed the difference that the similarity
    allows (positional filter). The smaller set of a pair (of equal ones, that of the
    smaller id) meets larger ones of its own band and of the next.
    """
    placed = postings.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    parts = F.ceil(F.count("*") / PART).cast("int").alias("parts")
    mixed = placed.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b"), parts).where("a < b")
    listed = placed.join(mixed.select("token", "parts"), "token").join(sketches, ["id", "n"])
    left = listed.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
    near = F.array(F.col("band") - 1, F.col("band"))
    right = listed.withColumn("band", F.explode(near)).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = right.select("token", "band", "part", *[F.col(c).alias(f"other_{c}") for c in ("id", "n", "place", "label", "sketch")])
    pairs = left.join(right, ["token", "band", "part"]).where(
        ((F.col("n") < F.col("other_n")) | ((F.col("n") == F.col("other_n")) & (F.col("id") < F.col("other_id"))))
        & (F.col("label") != F.col("other_label"))
        & _lengths_fit(threshold)
        & _places_fit(threshold)
        & _sketches_fit(threshold, FOLDED)
    )
    seen = pairs.groupBy("id", F.col("other_id").alias("other"), _most(threshold).alias("most")).agg(
        F.max(F.col("place") + F.col("other_place") + 2).alias("known"), F.count("*").alias("shared")
    )
    return seen.where("known - 2 * shared <= most").select("id", "other")


def _agree(pairs: DataFrame, signatures: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs whose sketches, and prefixes under orders 2 and 3, allow the similarity."""
    mine = signatures.where("n > 0").select("id", "n", "second", "third", "sketch")
    other = signatures.select(*[F.col(c).alias("other" if c == "id" else f"other_{c}") for c in mine.columns])
    joined = pairs.join(mine, "id").join(other, "other").where(_sketches_fit(threshold)).drop("sketch", "other_sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            kept = [
                i
                for i, (a, b) in enumerate(zip(c["n"], c["other_n"]))
                if _allowed(c["second"][i], c["other_second"][i], a, b, threshold.difference(a, b))
                and _allowed(c["third"][i], c["other_third"][i], a, b, threshold.difference(a, b))
            ]
            yield batch.take(pa.array(kept, pa.int64())).select(["id", "other"])

    return joined.mapInArrow(run, "id long, other long")


def _verified(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, width: int, threshold: Threshold) -> DataFrame:
    """The pairs (id, other) whose whole sets, read from the texts again, reach the similarity.

    ``other`` is the pivot. Its set is sent to one task per ``SHARE`` members.
    """
    shares = pairs.groupBy("other").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    members = pairs.join(shares, "other").select(
        "id", "other", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int").alias("share"), F.lit(1).alias("role")
    )
    pivots = shares.select(
        F.col("other").alias("id"), "other", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("role")
    )
    wanted = pivots.union(members)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = passing(texts, pairs.select("id").union(pairs.select("other")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, "text"):
                found = pa.array([s.tobytes() for s in _sets(data, offsets, width)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "other", "share", "role")), found], ["id", "other", "share", "role", "shingles"])

    sets = texts.join(wanted, "id").mapInArrow(read, "id long, other long, share int, role int, shingles binary")
    dealt = sets.repartition("other", "share").sortWithinPartitions("other", "share", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = np.empty(0, dtype=np.uint64)
        for batch in batches:
            ids, others = batch.column("id").to_pylist(), batch.column("other").to_pylist()
            kept = []
            for i, (role, shingles) in enumerate(zip(batch.column("role").to_pylist(), batch.column("shingles"))):
                own = np.frombuffer(shingles.as_buffer(), np.uint64)
                if role == 0:
                    pivot = own
                    continue
                at = np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)
                if threshold.reached(int((pivot[at] == own).sum()), len(own), len(pivot)):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in kept], pa.int64()), pa.array([others[i] for i in kept], pa.int64())], ["id", "other"]
            )

    return dealt.mapInArrow(run, "id long, other long")


def _links(docs, pairs, signatures, threshold, id_col, text_col, width) -> DataFrame:
    agreed = checkpointed(_agree(pairs, signatures, threshold).distinct())
    return checkpointed(_verified(docs, agreed, id_col, text_col, width, threshold))


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90
) -> DataFrame:
    """Per document: id, n_shingles, component_id (the smallest id reachable by links)."""
    spark, threshold = docs.sparkSession, Threshold(percent)
    folder = work_dir(spark, "shingles")
    _signatures(docs, id_col, text_col, width, threshold).write.parquet(folder)
    stored = spark.read.parquet(folder)

    # One member per digest and size stands for all documents with that set.
    classes = checkpointed(stored.where("n > 0").groupBy("digest", "n").agg(F.min("id").alias("stand_in")))
    stand_ins = classes.select(F.col("stand_in").alias("id"))
    signatures = stored.where("n > 0").select("id", "n", "prefix").join(stand_ins, "id", "left_semi")
    shared = f"{folder}-postings"
    _postings(signatures, threshold).write.parquet(shared)
    postings = spark.read.parquet(shared)

    near = _links(docs, _star_pairs(postings, threshold), stored, threshold, id_col, text_col, width)
    labels = connected(near.select(F.col("id").alias("a"), F.col("other").alias("b")))
    folded = stored.where("n > 0").select("id", F.col("n").cast("int").alias("n"), _folded(FOLDED).alias("sketch"))
    crossing = _cross_pairs(postings, labels, folded, threshold)
    far = _links(docs, crossing, stored, threshold, id_col, text_col, width)
    edges = labels.select(F.col("id").alias("a"), F.col("label").alias("b")).union(far.select("id", "other"))
    labels = connected(edges)

    placed = classes.join(labels.withColumnRenamed("id", "stand_in"), "stand_in", "left")
    placed = placed.select("digest", "n", F.coalesce("label", "stand_in").alias("component_id"))
    rows = stored.select("id", "n", "digest").join(placed, ["digest", "n"], "left")
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


def keep_one_per_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of the smallest id of each component, unchanged; rows without an id stay."""
    found = similar_documents(docs, id_col, text_col, width, percent)
    others = found.where(F.col("component_id") != F.col(id_col)).select(id_col).distinct()
    return docs.join(others, id_col, "left_anti").select(docs.columns)
