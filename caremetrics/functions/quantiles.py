"""Exact percentiles of groups of any size, by narrowing brackets.

Groups of few rows are given to Spark's exact percentile, which merges counts of equal
values. A wanted position of a large group starts with the bracket of all values. A
sketch of the bracket's values (quantiles at ``GRID`` steps, merged from the map tasks)
gives narrower bounds around the position; rows below and inside them are counted, and bounds
that the counts do not confirm are not taken. The rows inside are kept and go through
the next round, some fifty times fewer each time, until few are left to be put in order.

So no row of a large group is shuffled before it is known to be near a wanted position: all tasks
that read a group share its work, however many they are. The sketch only steers;
results are exact. Nulls and NaN count as no value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremetrics.functions.joins import small_side
from caremetrics.session import checkpointed, stored

# Rows of a group that one task may put in order.
SMALL_ROWS = 200_000
# Steps of the quantile grid, and how many times finer its sketch is.
GRID, FINER = 128, 8
# Rounds after which what is left is ordered: equal values are merged first, so only copies can be left.
MAX_ROUNDS = 12


def _interpolated(low: Column, high: Column, part: Column) -> Column:
    return low + (high - low) * part


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, fractions: dict[str, float], small_rows: int = SMALL_ROWS
) -> DataFrame:
    """One row per key with a column per entry of ``fractions``, interpolated linearly between rows.

    ``df`` is read several times and should be stored.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("value__")).where("value__ IS NOT NULL AND NOT isnan(value__)")
    sizes = checkpointed(rows.groupBy(*keys).agg(F.count("*").alias("n__")))
    large = sizes.where(F.col("n__") > small_rows)
    wanted = F.array(*[F.lit(f) for f in fractions.values()])
    picks = [F.col("found__")[i].alias(name) for i, name in enumerate(fractions)]
    if large.isEmpty():
        return rows.groupBy(*keys).agg(F.percentile("value__", wanted).alias("found__")).select(*keys, *picks)
    few = rows.join(small_side(large.select(*keys)), keys, "left_anti")
    exact = few.groupBy(*keys).agg(F.percentile("value__", wanted).alias("found__")).select(*keys, *picks)
    return exact.unionByName(_narrowed(rows, large, keys, fractions, small_rows))


def _targets(large: DataFrame, fractions: dict[str, float]) -> DataFrame:
    """A row per group and percentile: position, weight of the next row, and the bracket of all values."""
    entries = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(f)).alias("fraction")) for n, f in fractions.items()])
    exact = F.col("e__.fraction") * (F.col("n__") - 1)
    spread = large.withColumn("e__", F.explode(entries))
    position = F.floor(exact).cast("long")
    return spread.select(
        *[c for c in large.columns if c != "n__"],
        F.col("e__.name").alias("name__"), position.alias("at__"), (exact - position).alias("part__"),
        F.lit(float("-inf")).alias("lo__"), F.lit(float("inf")).alias("hi__"),
        F.lit(0).cast("long").alias("below__"), F.col("n__").alias("inside__"),
    )


def _in_bracket() -> Column:
    return (F.col("value__") >= F.col("lo__")) & (F.col("value__") <= F.col("hi__"))


def _narrowed(rows: DataFrame, large: DataFrame, keys: list[str], fractions: dict[str, float], small_rows: int) -> DataFrame:
    targets = checkpointed(_targets(large, fractions))
    bracket = [*keys, "lo__", "hi__"]
    # A row per large group, percentile and grid step: few, but their size is looked at.
    held = rows.join(small_side(large.select(*keys)), keys, "left_semi")
    most = targets.agg(F.max("inside__")).first()[0]
    for _ in range(MAX_ROUNDS):
        if most <= small_rows:
            break
        grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
        asked = targets.select(*bracket).distinct()
        inside = held.join(small_side(asked), keys).where(_in_bracket())
        sketch = F.percentile_approx("value__", grid, F.lit(GRID * FINER)).alias("grid__")
        sketched = checkpointed(inside.groupBy(*bracket).agg(sketch))
        step = F.floor((F.col("at__") - F.col("below__")) * GRID / F.col("inside__")).cast("int")
        low = F.when(step >= 2, F.get("grid__", step - 1)).otherwise(F.col("lo__"))
        high = F.when(step + 2 < GRID, F.get("grid__", step + 2)).otherwise(F.col("hi__"))
        tried = targets.join(sketched, bracket).withColumns({"low__": low, "high__": high}).drop("grid__")
        tried = checkpointed(tried)
        met = held.join(small_side(tried.select(*bracket, "name__", "low__", "high__")), keys).where(_in_bracket())
        counts = met.groupBy(*keys, "name__").agg(
            F.count_if(F.col("value__") < F.col("low__")).alias("under__"),
            F.count_if(F.col("value__") <= F.col("high__")).alias("upto__"),
        )
        at = F.col("at__") - F.col("below__")
        low_holds, high_holds = F.col("under__") <= at, (F.col("upto__") >= at + 2) | (F.col("upto__") == F.col("inside__"))
        under = F.when(low_holds, F.col("under__")).otherwise(0)
        upto = F.when(high_holds, F.col("upto__")).otherwise(F.col("inside__"))
        targets = checkpointed(
            tried.join(counts, [*keys, "name__"]).select(
                *keys, "name__", "at__", "part__",
                F.when(low_holds, F.col("low__")).otherwise(F.col("lo__")).alias("lo__"),
                F.when(high_holds, F.col("high__")).otherwise(F.col("hi__")).alias("hi__"),
                (F.col("below__") + under).alias("below__"),
                (upto - under).alias("inside__"),
            )
        )
        before, most = most, targets.agg(F.max("inside__")).first()[0]
        spans = targets.groupBy(*keys).agg(F.collect_set(F.struct("lo__", "hi__")).alias("spans__"))
        near = F.exists("spans__", lambda s: (F.col("value__") >= s["lo__"]) & (F.col("value__") <= s["hi__"]))
        held = stored(held.join(small_side(checkpointed(spans)), keys).where(near).select(*keys, "value__"), "brackets")
        if most > before // 2:
            break
    return _ordered(held.join(small_side(targets), keys).where(_in_bracket()), keys, list(fractions))


def _ordered(inside: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """The wanted rows, from the rows inside the last brackets; equal values are one row."""
    levels = inside.groupBy(*keys, "name__", "at__", "part__", "below__", "value__").agg(F.count("*").alias("n__"))
    upto = F.sum("n__").over(Window.partitionBy(*keys, "name__").orderBy("value__").rowsBetween(Window.unboundedPreceding, 0))
    placed = levels.withColumn("end__", F.col("below__") + upto).withColumn("start__", F.col("end__") - F.col("n__"))

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("start__") <= place) & (place < F.col("end__")), F.col("value__")))

    found = placed.groupBy(*keys, "name__", "part__").agg(at(F.col("at__")).alias("low__"), at(F.col("at__") + 1).alias("high__"))
    # The last row of a group has no next one, and then its weight is 0.
    result = _interpolated(F.col("low__"), F.coalesce("high__", "low__"), F.col("part__"))
    picks = [F.max(F.when(F.col("name__") == n, result)).alias(n) for n in names]
    return found.groupBy(*keys).agg(*picks)
