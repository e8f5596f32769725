"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed into cells (source, language, topic). The cells' weights are
raked: scaled dimension by dimension until each dimension's sums meet its
targets. A document's expected number of copies is its cell's weight over the
cell's tokens, times the wanted size of the sample; its whole part is certain and
the rest is drawn by a hash of the id, so that a run can be repeated. Only cells
are raked, never documents, and sums combine before each shuffle.

A target is given as shares of some values, or as an exponent: shares are then in
proportion to the tokens of a value to that power (1 keeps the mix, 0 makes all
values equal). Values without a given share keep their part of what is left.
Targets that contradict each other cannot be met; the last dimension is met then,
and a warning names the distance of the others.

A topic is the one of which most marks occur in the text, in order of ``TOPICS`` if
equal, and ``prose`` without any.

A null source or language is the value ``unknown``; a null or empty text has no
tokens and topic ``none``, is in no way special otherwise, and is drawn by its
cell's factor (1 for a cell without tokens). Rows with one id are drawn alike. An
empty table gives an empty result. Columns named like an added one are replaced.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremetrics.session import checkpointed, stored

DIMENSIONS = ["source", "lang", "topic"]
# Exponents or shares that the production mix aims at.
TARGETS: dict[str, float | dict[str, float]] = {
    "source": 0.5,
    "lang": 0.7,
    "topic": {"license": 0.05, "contact": 0.05},
}
# Tokens of the sample over tokens of the table.
SIZE = 1.0
# Farthest that a sum may be from its target, as a share; change of a weight below which a sweep changed nothing.
TOLERANCE = 1e-3
SETTLED = 1e-9
# Sweeps after which targets count as contradictory, and sweeps between two looks at the sums.
MAX_SWEEPS = 1000
SWEEPS_A_JOB = 4
# Cells raked in one partition and sent to every task; more are dealt out and joined by shuffles.
SMALL_CELLS = 20_000
SEED = 20240229
_DRAWS = 1 << 40


# Marks of the topics, looked for in lower-cased text. Literal, as patterns cost seven times the scan.
TOPICS = {
    "license": ["license", "copyright", "warranty", "permission is"],
    "contact": ["@", "phone", "e-mail"],
    "table": [" | ", "\t"],
    "code": ["{", "return ", "def ", "=>"],
    "web": ["http://", "https://", "www.", "cookie"],
    "list": ["\n- ", "\n* ", "\n1. "],
    "question": ["?"],
}


def topic_of(text: Column) -> Column:
    """The topic of which most marks occur in the whole text."""
    present = F.coalesce(text, F.lit(""))

    def ranked_marks(lowered: Column) -> Column:
        # The earlier of two equal counts is the larger number.
        return F.greatest(*[
            sum((F.contains(lowered, F.lit(m)).cast("int") for m in marks), F.lit(0)) * len(TOPICS) + (len(TOPICS) - 1 - k)
            for k, marks in enumerate(TOPICS.values())
        ])

    # As the variable of a lambda the lower-cased text is made once, not once per mark.
    ranked = F.transform(F.array(F.lower(present)), ranked_marks)[0]
    names = F.array(*[F.lit(name) for name in reversed(TOPICS)])
    return (
        F.when(~F.rlike(present, F.lit(r"[^\x20\x09-\x0D]")), "none")
        .when(ranked < len(TOPICS), "prose")
        .otherwise(F.get(names, F.pmod(ranked, F.lit(len(TOPICS)))))
    )


def described(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents with n_tokens, and their source, language and topic as cell columns."""
    n = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return docs.withColumns(
        {
            "n_tokens": n,
            "source__cell": F.coalesce(F.col("source").cast("string"), F.lit("unknown")),
            "lang__cell": F.coalesce(F.col("lang").cast("string"), F.lit("unknown")),
            "topic__cell": topic_of(F.col(text_col)),
        }
    )


_CELL = [f"{d}__cell" for d in DIMENSIONS]


def _target_sums(cells: DataFrame, dimension: str, target: float | dict[str, float]) -> DataFrame:
    """value, target tokens: one row per value of the dimension that has tokens."""
    column = f"{dimension}__cell"
    sums = cells.groupBy(column).agg(F.sum("tokens").alias("held")).where("held > 0")
    if not isinstance(target, dict):
        return sums.select(column, F.pow("held", F.lit(float(target))).alias("part"))
    given = F.lit(None).cast("double")
    for value, share in sorted(target.items()):
        given = F.when(F.col(column) == value, F.lit(float(share))).otherwise(given)
    listed = sums.withColumn("given", given)
    total = listed.agg(
        F.sum(F.coalesce("given", F.lit(0.0))).alias("given"),
        F.sum(F.when(F.col("given").isNull(), F.col("held"))).alias("rest"),
    ).first()
    spare = max(0.0, 1.0 - (total["given"] or 0.0))
    part = F.coalesce("given", F.col("held") / F.lit(float(total["rest"] or 1)) * F.lit(spare))
    return listed.select(column, part.alias("part"))


def _scaled(targets: DataFrame, column: str, total: float) -> DataFrame:
    parts = targets.agg(F.sum("part")).first()[0] or 1.0
    return targets.select(column, (F.col("part") / F.lit(float(parts)) * F.lit(float(total))).alias("aim"))


def _swept(weighed: DataFrame, dimensions: list[str], few: bool) -> DataFrame:
    """One sweep: the weights scaled to the sums of one dimension after the other."""
    for dimension in dimensions:
        column, aim = f"{dimension}__cell", F.col(f"{dimension}__aim")
        if few:
            held = F.sum("weight").over(Window.partitionBy(column))
        else:
            # A value may hold a third of all cells, so sums combine before they meet.
            sums = weighed.groupBy(column).agg(F.sum("weight").alias("held__"))
            weighed, held = weighed.join(sums, column), F.col("held__")
        scaled = F.when(aim.isNotNull() & (held > 0), F.col("weight") * aim / held).otherwise(F.col("weight"))
        weighed = weighed.withColumn("weight", scaled).drop("held__")
    return weighed


def _distance(weighed: DataFrame, dimensions: list[str]) -> float:
    """The farthest that a sum is from its target, as a share of the target."""
    worst = 0.0
    for dimension in dimensions:
        aim = F.max(f"{dimension}__aim")
        apart = F.when(aim > 0, F.abs(F.sum("weight") / aim - 1)).otherwise(0.0)
        sums = weighed.groupBy(f"{dimension}__cell").agg(apart.alias("apart"))
        worst = max(worst, sums.agg(F.max("apart")).first()[0] or 0.0)
    return worst


def rake(
    cells: DataFrame, targets: dict[str, float | dict[str, float]], tolerance: float = TOLERANCE,
    max_sweeps: int = MAX_SWEEPS, small_cells: int = SMALL_CELLS,
) -> DataFrame:
    """Add ``weight`` to cells: tokens scaled until every dimension meets its targets.

    Ends when all sums are within ``tolerance`` of their targets, or when sweeps change
    nothing any more, which happens if targets contradict each other.
    """
    cells = checkpointed(cells)
    few = cells.count() <= small_cells
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    weighed = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d, target in targets.items():
        aims = _scaled(_target_sums(cells, d, target), f"{d}__cell", total)
        weighed = weighed.join(aims.withColumnRenamed("aim", f"{d}__aim"), f"{d}__cell", "left")
    dimensions, columns = list(targets), [*_CELL, "tokens", "weight", *[f"{d}__aim" for d in targets]]
    # One partition meets every grouping, so that sweeps over few cells have no exchange.
    keep = (lambda df: checkpointed(df.coalesce(1))) if few else (lambda df: stored(df, "cells"))
    weighed = keep(weighed.select(*columns))
    for done in range(0, max_sweeps, SWEEPS_A_JOB if few else 1):
        swept = weighed.withColumn("before__", F.col("weight"))
        for _ in range(SWEEPS_A_JOB if few else 1):
            swept = _swept(swept, dimensions, few)
        swept = keep(swept.select(*columns, "before__"))
        distance = _distance(swept, dimensions)
        change = F.abs(F.col("weight") / F.col("before__") - 1)
        moved = swept.where("before__ > 0").agg(F.max(change)).first()[0] or 0.0
        weighed = swept.drop("before__")
        if distance <= tolerance or moved <= SETTLED:
            break
    if total and distance > tolerance:
        warnings.warn(f"targets of the mix are not met: a sum is {distance:.3g} of its target away", stacklevel=2)
    return weighed.select(*_CELL, "tokens", "weight")


def mixed(
    docs: DataFrame, targets: dict[str, float | dict[str, float]] = TARGETS, size: float = SIZE,
    id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` (all by default) of every row, with topic, n_tokens, weight, probability and copies.

    ``weight`` is the expected number of copies, ``probability`` that of at least one.
    """
    placed = described(docs, text_col)
    cells = placed.groupBy(*_CELL).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"))
    raked = rake(cells.select(*_CELL, "tokens"), targets)
    factor = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(1.0) * F.lit(float(size))
    factors = checkpointed(raked.select(*_CELL, factor.alias("expected__")))
    if factors.count() <= SMALL_CELLS:
        factors = F.broadcast(factors)
    kept = [c for c in (columns or docs.columns) if c not in ("topic", "n_tokens", "weight", "probability", "copies")]
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(_DRAWS)) / F.lit(float(_DRAWS))
    expected = F.col("expected__")
    copies = F.floor(expected) + F.when(draw < expected - F.floor(expected), 1).otherwise(0)
    return placed.join(factors, _CELL, "left").select(
        *kept,
        F.col("topic__cell").alias("topic"),
        "n_tokens",
        expected.alias("weight"),
        F.least(F.lit(1.0), expected).alias("probability"),
        copies.cast("long").alias("copies"),
    )
