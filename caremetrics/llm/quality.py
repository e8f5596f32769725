"""Quality by hierarchical empirical Bayes.

Three sources are combined into one posterior probability of good quality:

* the document: its text is measured (share of distinct words, capitals, marks,
  digits, repeated lines and so on), each measure falls into a bin, and labelled
  documents give every bin a log likelihood ratio. Measures overlap, so their sum
  is tempered by a factor fitted on the same labelled rows;
* its site and, within the site, its section: their share of good documents,
  shrunk towards the level above. How strongly is estimated from the data: with
  ``k`` pseudo-documents, where ``k`` follows from the variance between groups
  that exceeds what chance alone gives. Sparse or unlabelled groups fall back
  on their parent, down to the global prior.

Everything is grouped sums: of bins (a fixed number) and of groups (combined
before the shuffle, so one site may hold any share of the rows). All labelled
rows teach; nothing is sampled, and only bins and three numbers reach the driver.

A null or empty text has measures of zero and is judged by them like any other.
A null site or section is a group of its own. Several labels of one id all count;
rows with one id are judged one by one. Without labels every probability is 0.5.
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremetrics.llm.words import SPACED_LOWER, Words, pieces
from caremetrics.session import checkpointed

MEASURES = [
    "distinct", "capitals", "marks", "digits", "top_word", "repeats", "word_length", "lines", "size", "high_bytes",
]
# Bins per measure: twentieths of a share, or powers of two of a size.
BINS = 24
# Rows added to a measure, split over bins and classes as the labelled rows are, so
# that a bin never seen says nothing.
SMOOTHING = 20.0
# Probability from which a document is kept.
KEEP = 0.5


def _measure(words: Words, hashes: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per document, one column per measure, as bins."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    count = words.counts().astype(np.float64)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(size, 1)

    letters = ((data | 32) >= 97) & ((data | 32) <= 122)
    capital = (data >= 65) & (data <= 90)
    digit = (data >= 48) & (data <= 57)
    mark = (data < 128) & (data > 32) & ~letters & ~digit
    distinct, top, lines = np.zeros(n), np.zeros(n), np.zeros(n)
    same = np.concatenate([[False], hashes[1:] == hashes[:-1]]) if len(hashes) else np.empty(0, dtype=bool)
    repeats = np.zeros(n)
    for d in range(n):
        lo, hi = words.bounds[d], words.bounds[d + 1]
        if hi > lo:
            _, times = np.unique(hashes[lo:hi], return_counts=True)
            # Long texts repeat words by nature: the expected number grows like the root.
            distinct[d] = min(1.0, len(times) / (hi - lo) ** 0.75)
            top[d] = times.max() / (hi - lo)
            repeats[d] = same[lo + 1 : hi].mean() if hi - lo > 1 else 0.0
            body = data[offsets[d] : offsets[d + 1]].tobytes().split(b"\n")
            lines[d] = 1 - len(set(body)) / len(body)
    shares = np.stack(
        [distinct, share(capital), share(mark), share(digit), top, repeats, np.minimum(size / np.maximum(count, 1), 40) / 40, lines]
    )
    fine = np.minimum(np.floor(shares * 20), BINS - 1)
    sizes = np.minimum(np.floor(np.log2(count + 1)), BINS - 1)
    return np.concatenate([fine, [sizes], [np.minimum(np.floor(share(data >= 128) * 20), BINS - 1)]]).T.astype(np.int32)


def measured(docs: DataFrame, text_col: str, columns: list[str]) -> DataFrame:
    """``columns`` of every row and ``bins``, its measures, read from the whole text."""
    needed = docs.select(*columns, text_col)
    kept = [needed.schema[c] for c in columns]
    schema = T.StructType([*kept, T.StructField("bins", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, text_col):
                words = Words(data, offsets, SPACED_LOWER)
                bins = _measure(words, words.hashes(), data, offsets)
                flat = pa.array(bins.reshape(-1), pa.int32())
                ends = pa.array(np.arange(len(bins) + 1) * len(MEASURES), pa.int32())
                arrays = [*(part.column(c) for c in columns), pa.ListArray.from_arrays(ends, flat)]
                yield pa.RecordBatch.from_arrays(arrays, [*columns, "bins"])

    return needed.mapInArrow(run, schema)


def _evidence(labelled: DataFrame) -> tuple[list[list[float]], float, float]:
    """Log likelihood ratio of every bin, the prior, and the number of labelled rows."""
    counted = (
        labelled.select("good", F.posexplode("bins").alias("measure", "bin"))
        .groupBy("measure", "bin")
        .agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
        .collect()  # at most len(MEASURES) * BINS rows
    )
    good, bad = np.zeros((len(MEASURES), BINS)), np.zeros((len(MEASURES), BINS))
    for r in counted:
        good[r["measure"], r["bin"]], bad[r["measure"], r["bin"]] = r["good"], r["bad"]
    n_good, n_bad = good[0].sum(), bad[0].sum()
    prior = float((n_good + 1) / (n_good + n_bad + 2))
    usual = (good + bad + 0.5) / (n_good + n_bad + 0.5 * BINS)

    def likely(seen: np.ndarray, n: float, share: float) -> np.ndarray:
        return np.log((seen + SMOOTHING * share * usual) / (n + SMOOTHING * share))

    ratio = likely(good, n_good, prior) - likely(bad, n_bad, 1 - prior)
    return ratio.tolist(), prior, float(n_good + n_bad)


def _score(ratios: list[list[float]]) -> Column:
    flat = F.array(*[F.lit(x) for row in ratios for x in row])
    places = F.transform(F.col("bins"), lambda bin, at: F.get(flat, at * BINS + bin))
    return F.aggregate(places, F.lit(0.0), lambda total, x: total + x)


def _tempering(scored: DataFrame, prior: float) -> float:
    """The factor in (0, 1] under which the evidence fits the labels best.

    One pass of sums for a fixed list of factors.
    """
    factors = [k / 10 for k in range(1, 11)]
    base = log(prior / (1 - prior))
    losses = [F.sum(F.log1p(F.exp(F.when(F.col("good") == 1, -1).otherwise(1) * (F.col("evidence") * f + base)))).alias(f"f{i}") for i, f in enumerate(factors)]
    row = scored.agg(*losses).first()
    found = [row[f"f{i}"] for i in range(len(factors))]
    return factors[int(np.argmin(found))] if found[0] is not None else 1.0


def _strength(groups: DataFrame, rate: str, over: str) -> float:
    """Pseudo-documents of the level above, by the method of moments.

    Between groups of ``n`` documents chance alone scatters the share by p(1-p)/n;
    what exceeds it is real variance v, and k = p(1-p)/v - 1.
    """
    p = F.col(over)
    row = groups.where("n > 1").agg(
        F.sum(F.col("n") * (F.pow(F.col(rate) - p, F.lit(2.0)) - p * (1 - p) / F.col("n"))).alias("excess"),
        F.sum(F.col("n") * p * (1 - p)).alias("scale"),
        F.sum("n").alias("n"),
    ).first()
    if not row["n"] or not row["scale"]:
        return 10.0
    v = max(row["excess"], 1e-3 * row["scale"]) / row["scale"]
    return min(1000.0, max(1.0, 1 / v - 1))


def posteriors(
    docs: DataFrame, labels: DataFrame, site: Column, section: Column, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "quality", keep: float = KEEP, places: DataFrame | None = None,
) -> DataFrame:
    """Per row: id, site, section, evidence, site_prior, section_prior, probability, keep.

    ``places`` (id, site, section; one row per id) goes before the columns ``site`` and
    ``section``, which then serve the documents that it lacks.
    """
    own = docs.withColumns({"site": F.coalesce(site.cast("string"), F.lit("")), "section": F.coalesce(section.cast("string"), F.lit(""))})
    # Measures only, a few bytes per document; read three times.
    bins = measured(own, text_col, [id_col, "site", "section"])
    if places is not None:
        given = places.select(F.col(id_col).alias("_id"), F.struct("site", "section").alias("_place"))
        bins = bins.join(given, F.col(id_col) == F.col("_id"), "left")
        own_place = F.coalesce("_place", F.struct("site", "section"))
        bins = bins.select(id_col, own_place["site"].alias("site"), own_place["section"].alias("section"), "bins")
    bins = checkpointed(bins)
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), (F.col(label_col) > 0).cast("int").alias("good"))
    labelled = bins.join(known, F.col(id_col) == F.col("_id"))
    ratios, prior, n = _evidence(labelled)
    if not n:
        ratios, prior = [[0.0] * BINS for _ in MEASURES], 0.5
    factor = _tempering(labelled.withColumn("evidence", _score(ratios)), prior)

    sums = labelled.groupBy("site", "section").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    sites = sums.groupBy("site").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    sites = sites.select("site", "n", (F.col("good") / F.col("n")).alias("rate"), F.lit(prior).alias("over"))
    k = _strength(sites, "rate", "over")
    shrunk = sites.select("site", ((F.col("n") * F.col("rate") + k * prior) / (F.col("n") + k)).alias("site_prior"))
    sections = sums.join(shrunk, "site").select(
        "site", "section", "n", (F.col("good") / F.col("n")).alias("rate"), F.col("site_prior")
    )
    k = _strength(sections, "rate", "site_prior")
    section_prior = (F.col("n") * F.col("rate") + k * F.col("site_prior")) / (F.col("n") + k)
    sections = sections.select("site", "section", section_prior.alias("section_prior"))

    # One row per site, and per site and section; the optimizer sees their size.
    judged = bins.withColumn("evidence", _score(ratios) * factor).drop("bins")
    judged = judged.join(shrunk, "site", "left").join(sections, ["site", "section"], "left")
    site_prior = F.coalesce("site_prior", F.lit(prior))
    start = F.coalesce("section_prior", "site_prior", F.lit(prior))
    chance = 1 / (1 + F.exp(-(F.log(start / (1 - start)) + F.col("evidence"))))
    return judged.select(
        id_col, "site", "section", "evidence", site_prior.alias("site_prior"), start.alias("section_prior"),
        chance.alias("probability"), (chance >= keep).alias("keep"),
    )
