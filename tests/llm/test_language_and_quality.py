"""Language profiles and site posteriors."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caremetrics.llm import language_id, quality, queries
from tests.conftest import SF
from tests.llm.conftest import ODD, fold


def test_profile_order_and_prediction_match_plain_python(spark):
    train = spark.createDataFrame([("aab ab", "x"), ("zz zz zy", "y")], "text string, lang string")
    learned = {(r["lang"], r["gram"]): r["place"] for r in language_id.profiles(train).collect()}

    def grams(text):
        counts = {}
        for word in text.split():
            padded = f"\0{word}\0"
            found = [(c, None, None) for c in word]
            found += [(padded[i], padded[i + 1], None) for i in range(len(padded) - 1)]
            found += [tuple(padded[i : i + 3]) for i in range(len(padded) - 2)]
            for g in found:
                code = 0
                for part in (*g, *[None] * (3 - len(g))):
                    code = code << 21 | ((1 << 21) - 1 if part is None else ord(part))
                counts[code] = counts.get(code, 0) + 1
        return [g for g, _ in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))]

    for lang, text in (("x", "aab ab"), ("y", "zz zz zy")):
        assert {g: p for (l, g), p in learned.items() if l == lang} == {g: p for p, g in enumerate(grams(text))}
    docs = spark.createDataFrame([(1, "ab ab"), (2, "zy"), (3, "!")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language_id.predict(docs, language_id.profiles(train), ["doc_id"]).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["x", "y", "und"]
    own = grams("ab ab")
    place = {g: p for p, g in enumerate(grams("aab ab"))}
    distance = sum(abs(place[g] - p) if g in place else language_id.DEPTH for p, g in enumerate(own))
    assert got[1]["score"] == pytest.approx(1 - distance / (language_id.DEPTH * len(own)))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.count() > 20
    assert got.where(F.col("lang_pred") == F.col("lang")).count() >= 0.95 * got.count()


def test_odd_rows(odd, nothing):
    got = language_id.identify(odd).collect()
    assert len(got) == len(ODD)
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} >= {1, 2, 3, 15}
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in got)
    assert language_id.identify(nothing).count() == 0
    kept = language_id.keep_identified(odd)
    assert kept.columns == odd.columns and kept.where("doc_id IN (1, 2, 3, 15)").count() == 0
    assert {4, 5, 6, 7, 8, 9} <= {r["doc_id"] for r in kept.collect()}


def test_sparse_sites_shrink_to_the_level_above(spark):
    rows, labels = [], []
    for i in range(400):
        site = "good" if i % 2 else "bad"
        rows.append((i, "plain words in a plain text of no kind", site, f"s{i % 4}"))
        if i < 380:
            labels.append((i, int(i % 10 > 0) if site == "good" else int(i % 10 < 4)))
    rows += [(1000, "plain words in a plain text of no kind", "new", "s0"), (1001, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, site_name string, part string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.posteriors(docs, known, F.col("site_name"), F.col("part")).collect()}
    prior = (sum(q for _, q in labels) + 1) / (len(labels) + 2)
    assert got[1000]["site_prior"] == pytest.approx(prior) and got[1000]["section_prior"] == pytest.approx(prior)
    assert got[0]["site_prior"] < prior < got[1]["site_prior"]
    raw = sum(q for i, q in labels if i % 2 == 0) / sum(i % 2 == 0 for i, _ in labels)
    assert raw < got[0]["site_prior"] < prior
    assert 1001 in got and 0 < got[1001]["probability"] < 1


def test_quality_catches_junk_and_keeps_clean_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.posteriors(docs, labels, F.col("source"), F.col("lang")).join(labels, "doc_id")
    assert got.where("quality = 1 AND keep").count() >= 0.97 * got.where("quality = 1").count()
    assert got.where("quality = 0 AND NOT keep").count() >= 0.7 * got.where("quality = 0").count()


def test_hosts_and_paths_of_pages_reach_the_documents(spark, tmp_path):
    docs = [(i, "plain words in a plain text of no kind", "en", "crawl") for i in range(403)] + [(None, "plain words", "en", "crawl")]
    urls = [(i, f"https://{'Good' if i % 2 else 'bad'}.net/{'news' if i % 4 < 2 else 'shop'}/{i}.html?x") for i in range(402)]
    urls += [(900, "https://zzz.net/late/1"), (901, None), (902, "no url /7")]
    labels = [(i, int(i % 10 > 0) if i % 2 else int(i % 10 < 4), 0) for i in range(380)]
    for name, rows, shape in (
        ("documents", docs, "doc_id long, text string, lang string, source string"),
        ("pages", urls, "page_id long, url string"),
        ("labels", labels, "doc_id long, quality int, toxic int"),
    ):
        spark.createDataFrame(rows, shape).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r["doc_id"]: r for r in queries.op9_quality(spark, str(tmp_path)).collect()}
    assert len(got) == len(docs)
    assert (got[0]["site"], got[0]["section"]) == ("bad.net", "/news/")
    assert (got[3]["site"], got[3]["section"]) == ("good.net", "/shop/")
    assert got[1]["site"] == "good.net"  # the smallest of its two urls
    assert (got[402]["site"], got[402]["section"]) == (got[None]["site"], got[None]["section"]) == ("source crawl", "en")
    assert got[400]["site_prior"] < got[402]["site_prior"] < got[401]["site_prior"]


def test_quality_without_labels_or_rows(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    site, part = F.col("source"), F.col("lang")
    assert {r["probability"] for r in quality.posteriors(odd, none, site, part).collect()} == {0.5}
    assert quality.posteriors(nothing, none, site, part).count() == 0


def test_memory_of_language_tasks_is_a_small_multiple_of_a_piece():
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abcdefghijklmnop "), 4000)) for _ in range(500)]  # 2 MB
    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * len(texts)), pa.array(texts)], ["lang", "text"])
    language_id._is_letter()
    tracemalloc.start()
    try:
        found = list(language_id._count_grams("lang", "text")(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(sum(b.column("n").to_pylist()) for b in found) > 2 * 2_000_000
    assert peak < 64 << 20
