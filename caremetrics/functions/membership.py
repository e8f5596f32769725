"""A mergeable Bloom filter of keys, made and asked by column functions alone.

Spark prunes the large side of an inner join by the keys of the small one, but not that
of an anti join. The filter does: stored keys that are surely not among the incoming ones
are dropped where they are read, before the shuffle. Three bits of one 64-bit word stand
for a key; words are combined by OR, in the map tasks first. The filter is one array,
of bounded size, that a scalar subquery hands to the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys per 64-bit word, and the most words (32 MB). Of more keys no filter is made.
KEYS_PER_WORD = 4
MAX_WORDS = 1 << 22


def words_for(keys: int) -> int | None:
    """Words of a filter for so many keys, a power of two; None if they would be too many."""
    words = 1 << max(6, (keys // KEYS_PER_WORD).bit_length())
    return words if words <= MAX_WORDS else None


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _bits(key: Column) -> Column:
    digest = F.xxhash64(key)
    found = F.lit(0).cast("long")
    for start in (40, 46, 52):
        place = F.shiftrightunsigned(digest, start).bitwiseAND(63).cast("int")
        found = found.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return found


def key_filter(keys: DataFrame, key: str, words: int) -> Column:
    """The filter of a column of keys, as a scalar subquery."""
    held = keys.select(_word(F.col(key), words).alias("id"), _bits(F.col(key)).alias("bits"))
    held = held.groupBy("id").agg(F.bit_or("bits").alias("bits"))
    dense = keys.sparkSession.range(words).join(held, "id", "left")
    entry = F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return dense.agg(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["bits"]).alias("filter")).scalar()


def may_hold(filter_: Column, key: Column, words: int) -> Column:
    """Whether the key may be in the filter; never false for one that is."""
    bits = _bits(key)
    return F.get(filter_, _word(key, words).cast("int")).bitwiseAND(bits) == bits
