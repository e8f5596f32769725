"""Exact global ordering without putting a whole group into one task.

``row_number``/``rank`` over a group, and exact percentiles, send the group to a
single task. Here the group is cut into value ranges first: some of its own values
(hundreds, more for a large ungrouped table) serve as cut points, rows are counted per range, the short table
of counts is prefix-summed, and only the rows inside one range are ordered in
one task. Cut points only steer the balance; every result is exact.

Inputs hold one row per (keys, value): equal values are merged beforehand and
carry a weight, so a value shared by a third of all rows is a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremetrics.functions.joins import salted_join

# Cut points of a group, at least; and rows of an ungrouped table per cut point.
SLOTS = 256
ROWS_PER_SLOT = 1_000_000


def slots_for(rows: int) -> int:
    """Cut points for a table of so many rows: a power of two that grows with it."""
    return max(SLOTS, 1 << max(0, rows // ROWS_PER_SLOT).bit_length())


def _cut_points(df: DataFrame, keys: Sequence[str], value: str, weight: str, slots: int = SLOTS) -> DataFrame:
    """Per key at most ``slots`` of its values, chosen by hash.

    The choice depends on the values alone (not on row order), so branches of
    a plan and retried tasks agree on it. The filter holds for every row; naming
    the weight keeps the input equal in all branches, so its shuffle is reused.
    """
    digest = F.xxhash64(F.col(value))
    picked = df.where(F.col(weight) > 0).groupBy(*keys, F.pmod(digest, F.lit(slots)).alias("_slot")).agg(
        F.min_by(value, digest).alias("_cut")
    )
    return picked.groupBy(*keys).agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))


def _range_no(placed: DataFrame, value: str, slots: int = SLOTS) -> DataFrame:
    """Replace ``_cuts`` by ``_range``: the number of cut points at or below the value.

    A bisection written as one column per halving step, each built on the one
    before, which stays inside generated code. A position past the end of the
    array reads as null and is not taken.
    """
    names = ["_at"]
    steps = [F.lit(0).alias("_at")]
    for k in reversed(range(slots.bit_length())):
        at, step = F.col(names[-1]), 1 << k
        taken = F.get("_cuts", at + (step - 1)) <= F.col(value)
        names.append(f"_at{k}")
        steps.append((at + F.when(taken, step).otherwise(0)).alias(names[-1]))
    kept = [F.col(c) for c in placed.columns if c != "_cuts"]
    return placed.select("*", *steps).select(*kept, F.col(names[-1]).alias("_range"))


def _with_ranges(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    if keys:
        # A group of any size meets its cut points in several tasks.
        cuts = _cut_points(df, keys, value, weight)
        return _range_no(salted_join(df, cuts, keys, F.col(value)), value)
    # Without keys the cut points are one row: a scalar subquery, not a join.
    slots = slots_for(df.count())
    cuts = _cut_points(df, keys, value, weight, slots)
    return _range_no(df.withColumn("_cuts", cuts.scalar()), value, slots)


def _range_offsets(ranged: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Per (keys, range): weight of all lower ranges, of this one, and of the key.

    At most ``SLOTS + 1`` rows per key, which bounds each window partition.
    """
    per_range = ranged.groupBy(*keys, "_range").agg(F.sum(weight).alias("_range_weight"))
    whole = Window.partitionBy(*keys)
    return per_range.select(
        *keys,
        "_range",
        "_range_weight",
        (F.sum("_range_weight").over(whole.orderBy("_range")) - F.col("_range_weight")).alias("_lower"),
        F.sum("_range_weight").over(whole).alias("_total"),
    )


def _attach_offsets(ranged: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not keys:
        offsets = F.broadcast(offsets)  # at most SLOTS + 1 rows
    return ranged.join(offsets, [*keys, "_range"])


def _running(keys: Sequence[str], value: str, weight: str) -> Column:
    inside = Window.partitionBy(*keys, "_range").orderBy(value)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.col("_lower") + F.sum(weight).over(upto) - F.col(weight)


def weight_before(
    df: DataFrame, keys: Sequence[str], value: str, weight: str, out: str = "before"
) -> DataFrame:
    """Add the total weight of strictly smaller values within ``keys``.

    ``df`` has one row per (keys, value) and no null values. With weight 1 the
    result is the zero-based position; with row counts it is ``rank - 1``.
    """
    ranged = _with_ranges(df, keys, value, weight)
    offsets = _range_offsets(ranged, keys, weight).drop("_range_weight", "_total")
    return (
        _attach_offsets(ranged, offsets, keys)
        .withColumn(out, _running(keys, value, weight))
        .drop("_range", "_lower")
    )


def with_ordinal(df: DataFrame, unique_key: str, out: str = "ordinal") -> DataFrame:
    """Number rows 1, 2, 3 … in the order of a unique key over the whole table."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    placed = weight_before(ones, [], unique_key, "_one", out=out)
    return placed.withColumn(out, F.col(out) + 1).drop("_one")


def value_ranks(
    df: DataFrame, keys: Sequence[str], value: str, descending: bool = False, out: str = "rank"
) -> DataFrame:
    """SQL ``rank()`` of ``value`` within ``keys``, for groups of any size."""
    signed = (-F.col(value) if descending else F.col(value)).alias("_by")
    levels = df.groupBy(*keys, signed).agg(F.count("*").alias("_rows"))
    ranked = weight_before(levels, keys, "_by", "_rows", out=out)
    ranked = ranked.select(*keys, "_by", (F.col(out) + 1).alias(out))
    return df.withColumn("_by", signed).join(ranked, [*keys, "_by"]).drop("_by")


def linear_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, weight: str, fractions: dict[str, float]
) -> DataFrame:
    """Exact percentiles with linear interpolation between neighbouring rows.

    Returns one row per key with a column per entry of ``fractions``. Only the
    value ranges that hold a wanted position are ordered.
    """
    ranged = _with_ranges(df, keys, value, weight)
    spots = []
    for name, fraction in fractions.items():
        exact = F.lit(fraction) * (F.col("_total") - 1)
        spots += [(f"_{name}_lo", F.floor(exact)), (f"_{name}_hi", F.ceil(exact))]
    offsets = _range_offsets(ranged, keys, weight).withColumns(dict(spots))
    wanted = F.lit(False)
    for name, _ in spots:
        here = F.col(name)
        wanted = wanted | ((here >= F.col("_lower")) & (here < F.col("_lower") + F.col("_range_weight")))
    placed = _attach_offsets(ranged, offsets.where(wanted), keys).withColumn(
        "_before", _running(keys, value, weight)
    )
    covers = lambda name: (F.col(name) >= F.col("_before")) & (
        F.col(name) < F.col("_before") + F.col(weight)
    )
    found = placed.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[F.max(F.when(covers(name), F.col(value))).alias(name) for name, _ in spots],
    )
    out = [*keys]
    for name, fraction in fractions.items():
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        exact = F.lit(fraction) * (F.col("_total") - 1)
        out.append((low + (high - low) * (exact - F.floor(exact))).alias(name))
    return found.select(*out)
