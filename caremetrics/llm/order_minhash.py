"""Order MinHash fingerprints: likeness of texts that also falls when their order changes.

A text is a sequence of symbols: runs without white space, cut after twelve code
points. Its k-mers are ``K`` symbols in a row, hashed; equal ones are numbered in
text order, and hash and number together get a new hash, which orders them. That
order is cut into ``BINS`` ranges. From each range the ``PER_TUPLE`` smallest k-mers are
selected, put back into text order, and hashed as a tuple; the tuples are the signature. The
likeness of two signatures is the share of ranges, used by either, that hold equal
tuples. A tuple stays the same only if its k-mers stay and keep their order, so the share
falls with the edit distance and not just with the set of k-mers.

One permutation in ranges stands for many permutations, so a text of n symbols costs
two sorts of n numbers whatever the length of the signature. All of it is array functions within
a row; rows meet only to get the head of the next document and its signature.

Null counts as an empty text. A text without symbols has an empty fingerprint, like
1 to others of its kind and 0 to the rest; one with fewer symbols than a k-mer is one k-mer.
The next document is that with the next larger id, the first one for the last. Several
rows may have one id: each is fingerprinted, and the one whose text has the smallest 64-bit
hash is what the document before meets. A row without an id has no next document:
its tail is cut off and its likeness to the next is null. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremetrics.functions.ordering import with_ordinal
from caremetrics.session import checkpointed

# Symbols of a k-mer, k-mers of a tuple, tuples of a signature (a power of two, 64 at most).
K = 3
PER_TUPLE = 2
BINS = 64
SYMBOL = r"[^\x20\x09-\x0D]{1,12}"

# A packed number: 31 bits of hash above 32 bits of position.
_POSITION = (1 << 32) - 1
_HASH = (1 << 31) - 1
_TUPLE_BITS = 25


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), body)[0]


def _packed(digest: Column, position: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(digest, 33), 32).bitwiseOR(position.cast("long"))


def _hash_of(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, 32)


def _indexes(values: Column) -> Column:
    """0 to the last index; empty for an empty array."""
    none = F.array().cast("array<int>")
    return F.when(F.size(values) == 0, none).otherwise(F.sequence(F.lit(0), F.size(values) - 1))


def _runs(values: Column, group: Callable[[Column], Column], make: Callable[[Column, Column], Column]) -> Column:
    """``make`` (group, its values) for every run of neighbours of one group."""

    def starts_run(i: Column) -> Column:
        return (i == 0) | (group(F.get(values, i)) != group(F.get(values, i - 1)))

    def each(starts: Column) -> Column:
        def run(start: Column, j: Column) -> Column:
            size = F.coalesce(F.get(starts, j + 1), F.size(values)) - start
            return make(group(F.get(values, start)), F.slice(values, start + 1, size))

        return F.transform(starts, run)

    return _let(F.filter(_indexes(values), starts_run), each)


def _kmers(symbols: Column, k: int) -> Column:
    """Packed hash and start of every k-mer, in order of hash and start."""
    last = F.greatest(F.size(symbols) - k, F.lit(0))
    found = F.transform(
        F.sequence(F.lit(0), last), lambda i: _packed(F.xxhash64(F.slice(symbols, i + 1, k)), i)
    )
    return F.sort_array(F.when(F.size(symbols) == 0, F.array().cast("array<bigint>")).otherwise(found))


def _numbered(kmers: Column) -> Column:
    """Packed hash of (k-mer, number of the occurrence) and start, in order of the hash."""

    def renamed(kmer: Column, places: Column) -> Column:
        return F.transform(places, lambda x, o: _packed(F.xxhash64(kmer, o), x.bitwiseAND(_POSITION)))

    return F.sort_array(F.flatten(_runs(kmers, _hash_of, renamed)))


def _bin(bins: int) -> Callable[[Column], Column]:
    """The range that a packed number belongs to."""
    return lambda packed: F.shiftrightunsigned(packed, 63 - (bins.bit_length() - 1))


def _tuples(numbered: Column, per_tuple: int, bins: int) -> Column:
    """One number per used range: the range, and a hash of its smallest k-mers in text order."""
    bin_of = _bin(bins)
    selected = F.filter(
        numbered, lambda x, i: (i < per_tuple) | (bin_of(x) != bin_of(F.get(numbered, i - per_tuple)))
    )

    def tuple_of(place: Column, members: Column) -> Column:
        by_position = F.sort_array(
            F.transform(members, lambda x: F.shiftleft(x.bitwiseAND(_POSITION), 31).bitwiseOR(_hash_of(x)))
        )
        digest = F.xxhash64(F.transform(by_position, lambda y: y.bitwiseAND(_HASH)))
        return F.shiftleft(place, _TUPLE_BITS).bitwiseOR(digest.bitwiseAND((1 << _TUPLE_BITS) - 1)).cast("int")

    return _let(selected, lambda kept: _runs(kept, bin_of, tuple_of))


def signature(text: Column, k: int = K, per_tuple: int = PER_TUPLE, bins: int = BINS) -> Column:
    """The tuples of a text, an integer per used range in ascending order."""
    if bins & (bins - 1) or not 1 < bins <= 64:
        raise ValueError("bins must be a power of two up to 64")
    symbols = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SYMBOL), F.lit(0))
    hashed = F.transform(symbols, lambda s: F.xxhash64(s))
    return _let(
        hashed,
        lambda h: _let(_kmers(h, k), lambda s: _let(_numbered(s), lambda v: _tuples(v, per_tuple, bins))),
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of the ranges used by either signature that hold equal tuples."""
    ranges = [F.transform(s, lambda x: F.shiftrightunsigned(x, _TUPLE_BITS)) for s in (a, b)]
    equal = F.size(F.array_intersect(a, b))
    return F.when(a == b, 1.0).otherwise(equal / F.size(F.array_union(*ranges)))


def fingerprint(tuples: Column) -> Column:
    """A signature as text: eight hexadecimal digits a tuple."""
    return F.array_join(F.transform(tuples, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id__, prev__, next__ and half__ (code points that the previous document's tail takes) for every id."""
    n = F.char_length(F.coalesce(F.col(text_col), F.lit("")))
    sizes = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id__")).agg(F.max(n).alias("n__"))
    placed = checkpointed(with_ordinal(checkpointed(sizes), "id__", out="at__"))
    total = placed.count()
    before = placed.select(
        (F.col("at__") % F.lit(max(total, 1)) + 1).alias("at__"), F.col("id__").alias("prev__"),
        F.floor(F.col("n__") / 2).cast("int").alias("half__"),
    )
    after = placed.select(
        F.when(F.col("at__") == 1, F.lit(total)).otherwise(F.col("at__") - 1).alias("at__"), F.col("id__").alias("next__")
    )
    return checkpointed(placed.join(before, "at__").join(after, "at__").select("id__", "prev__", "next__", "half__"))


def with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id__, text__, hash__, next__ and edited__: the text whose last half is the next document's start."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("id__"), text.alias("text__"))
    half = F.floor(F.char_length("text__") / 2).cast("int")
    kept = F.substring("text__", F.lit(1), F.char_length("text__") - half)
    digest = F.xxhash64("text__").alias("hash__")
    placed = own.where("id__ IS NOT NULL").join(neighbours(docs, id_col, text_col), "id__")
    heads = (
        placed.select(F.col("prev__").alias("id__"), F.substring("text__", F.lit(1), F.col("half__")).alias("head__"), digest)
        .groupBy("id__").agg(F.min_by("head__", "hash__").alias("head__"))
    )
    edited = F.concat(kept, F.substring("head__", F.lit(1), half)).alias("edited__")
    alone = own.where("id__ IS NULL").select(
        "id__", "text__", digest, F.col("id__").alias("next__"), kept.alias("edited__")
    )
    return placed.join(heads, "id__").select("id__", "text__", digest, "next__", edited).union(alone)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, per_tuple: int = PER_TUPLE,
    bins: int = BINS,
) -> DataFrame:
    """Every row's id, n_chars, edited_sha256, both fingerprints, near_edited and near_next.

    Texts move once to meet the start of the next one. Signatures are computed once, kept
    in the shared folder, and are what meets the next document's.
    """
    made = with_edited(docs, id_col, text_col).select(
        "id__",
        "hash__",
        "next__",
        F.char_length("text__").cast("long").alias("n_chars"),
        F.sha2("edited__", 256).alias("edited_sha256"),
        signature(F.col("text__"), k, per_tuple, bins).alias("tuples__"),
        signature(F.col("edited__"), k, per_tuple, bins).alias("edited_tuples__"),
    )
    made = checkpointed(made)
    following = (
        made.where("id__ IS NOT NULL").groupBy(F.col("id__").alias("next__"))
        .agg(F.min_by("tuples__", "hash__").alias("next_tuples__"))
    )
    known = made.where("next__ IS NOT NULL").join(following, "next__")
    both = known.unionByName(made.where("next__ IS NULL"), allowMissingColumns=True)
    return both.select(
        F.col("id__").alias(id_col),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("tuples__")).alias("fingerprint"),
        fingerprint(F.col("edited_tuples__")).alias("edited_fingerprint"),
        likeness(F.col("tuples__"), F.col("edited_tuples__")).alias("near_edited"),
        F.when(F.col("next_tuples__").isNotNull(), likeness(F.col("tuples__"), F.col("next_tuples__"))).alias("near_next"),
    )
