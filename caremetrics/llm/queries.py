"""The queries of this subpackage: key -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from caremetrics.llm import (
    decontamination,
    exact_dedup,
    language_id,
    licenses,
    lm_scoring,
    mixing,
    ngram_join,
    order_minhash,
    quality,
    ranked_search,
    resampling,
    substring_dedup,
    url_rules,
)

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


@_query
def op10_decontamination(spark, sf_dir):
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@_query
def op5_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


@_query
def op3_ngram_join(spark, sf_dir):
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


@_query
def op2_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def _numbered(pages: DataFrame) -> DataFrame:
    """page_id, url, and as doc_id the number that the path ends with."""
    number = F.regexp_extract(url_rules.split_url(F.col("url"))["path"], r"/([0-9]{1,18})[^/0-9]*/?$", 1)
    return pages.select("page_id", "url", F.when(number != "", number.cast("long")).alias("doc_id"))


def document_places(pages: DataFrame) -> DataFrame:
    """doc_id, its page's host (site), and the path before the document's number (section).

    Of several pages of a document the one with the smallest url counts.
    """
    first = _numbered(pages).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("url").alias("url"))
    parts = url_rules.split_url(F.col("url"))
    section = F.regexp_replace(parts["path"], r"[^/]*/?$", "")
    return first.select("doc_id", parts["host"].alias("site"), section.alias("section")).where("site != ''")


@_query
def op4_url_filters(spark, sf_dir):
    """Pages are labelled by the document whose number their path ends with."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    verdict = F.when(bad, url_rules.BLOCK).when(F.col("quality") == 1, url_rules.ALLOW)
    verdicts = _numbered(pages).join(labels, "doc_id").select("page_id", verdict.alias("verdict"))
    return url_rules.judge(pages, verdicts)


@_query
def op1_mixing(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents"), columns=["doc_id", "source", "lang"])


@_query
def op9_quality(spark, sf_dir):
    """Site and section: host and path prefix of the document's page, without one its source and language."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    source = F.concat(F.lit("source "), F.coalesce("source", F.lit("")))
    places = document_places(table(spark, sf_dir, "pages"))
    return quality.posteriors(docs, labels, source, F.col("lang"), places=places)


@_query
def op6_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@_query
def op7_lm_scoring(spark, sf_dir):
    return lm_scoring.score(table(spark, sf_dir, "documents"))


@_query
def op11_order_minhash(spark, sf_dir):
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


@_query
def op12_ranked_search(spark, sf_dir):
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op13_resampling(spark, sf_dir):
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@_query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
