"""Order MinHash, ranked search and importance resampling against plain Python."""

import hashlib
import math
import re
import struct
import zlib

import numpy as np
import pytest
import xxhash

from caremetrics.llm import order_minhash, ranked_search, resampling
from tests.conftest import SF
from tests.llm.conftest import ODD, alnum

# --- order MinHash -----------------------------------------------------------------


def _h(values, seed=42):
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<q", v)
        seed = xxhash.xxh64(raw, seed=seed).intdigest()
    return seed


def _signed(h):
    return h - (1 << 64) if h >> 63 else h


def _int_hash(h, number):
    """A hash of a long and then an int, as Spark chains them."""
    first = xxhash.xxh64(struct.pack("<q", h), seed=42).intdigest()
    return xxhash.xxh64(struct.pack("<i", number), seed=first).intdigest()


def _signature(text, k=3, per_tuple=2, bins=64):
    symbols = [_signed(_h([s])) for s in re.findall(r"[^\x20\x09-\x0D]{1,12}", text or "")]
    starts = range(max(len(symbols) - k, 0) + 1) if symbols else ()
    seen, numbered = {}, []
    for i in starts:
        kmer = _h(symbols[i : i + k]) >> 33
        n = seen[kmer] = seen.get(kmer, -1) + 1
        numbered.append((_int_hash(kmer, n) >> 33, i))
    out = []
    for b in range(bins):
        mine = sorted(p for p in numbered if p[0] >> 25 == b)[:per_tuple]
        if mine:
            ordered = [h for h, _ in sorted(mine, key=lambda p: (p[1], p[0]))]
            out.append(b << 25 | _h(ordered) & (1 << 25) - 1)
    return out


def _like(a, b):
    if a == b:
        return 1.0
    return len(set(a) & set(b)) / len({x >> 25 for x in a} | {x >> 25 for x in b})


TEXTS = [t for _, t, _, _ in ODD if t != ODD[7][1]] + ["a b " * 50, "x " * 30 + "y z", "w" * 100]


def test_signatures_match_plain_python(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = dict(df.select("i", order_minhash.signature(F.col("text"))).collect())
    for i, text in enumerate(TEXTS):
        assert got[i] == _signature(text), text


def test_fingerprints_of_a_table_match_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(5)
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    ids = sorted(text)
    got = {r["doc_id"]: r for r in order_minhash.fingerprints(docs).collect()}
    assert sorted(got) == ids
    for a, b in zip(ids, ids[1:] + ids[:1]):
        n = len(text[a])
        edited = text[a][: n - n // 2] + text[b][: n // 2]
        row = got[a]
        assert row["n_chars"] == n and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, other = _signature(text[a]), _signature(edited)
        assert row["fingerprint"] == "".join(f"{x:08x}" for x in own)
        assert row["edited_fingerprint"] == "".join(f"{x:08x}" for x in other)
        assert row["near_edited"] == pytest.approx(_like(own, other))
        assert row["near_next"] == pytest.approx(_like(own, _signature(text[b])))


def test_moved_passages_lower_the_likeness(spark):
    from pyspark.sql import functions as F

    words = [f"w{i}" for i in range(600)]
    texts = [(1, " ".join(words), " ".join(words[:300] + ["new"] + words[301:])), (2, " ".join(words), " ".join(words[300:] + words[:300]))]
    df = spark.createDataFrame(texts, "i int, a string, b string")
    near = dict(df.select("i", order_minhash.likeness(*[order_minhash.signature(F.col(c)) for c in "ab"])).collect())
    # The same k-mers but for three, once in place and once with both halves exchanged.
    assert near[1] > 0.9 and 0.3 < near[2] < 0.8


def test_fingerprints_of_odd_rows(spark, odd, nothing):
    assert order_minhash.fingerprints(nothing).count() == 0
    rows = order_minhash.fingerprints(odd).collect()
    assert len(rows) == len(ODD)
    by_text = {}
    text_of = {(i, len(t or "")): t for i, t, _, _ in ODD}
    for r in rows:
        by_text.setdefault(text_of[r["doc_id"], r["n_chars"]] or "", set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1
        assert r["near_next"] is None if r["doc_id"] is None else 0 <= r["near_next"] <= 1
    assert all(len(v) == 1 for v in by_text.values())
    alone = [r for r in rows if r["doc_id"] is None and r["n_chars"]]
    assert [r["edited_sha256"] for r in alone] == [hashlib.sha256(b"The quick ").hexdigest()]
    one = order_minhash.fingerprints(odd.where("doc_id = 11")).first()
    assert one["near_next"] == 1.0


# --- ranked search -----------------------------------------------------------------


def _ranking(docs, items, k=10):
    words = [(i, alnum(t)) for i, t in docs]
    counted, total = sum(1 for _, w in words if w), sum(len(w) for _, w in words)
    df = {}
    for _, w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(alnum(text))
    out = []
    for item, terms in asked.items():
        found = []
        for i, w in words:
            score = 0
            for t in terms & set(w):
                m = 100 - 90 + (90 * len(w) * counted) // total
                weight = math.floor(1000 * math.log((2 * counted + 2) / (2 * df[t] + 1)))
                score += weight * ((1000000000 * w.count(t)) // (1000 * w.count(t) + 8 * m))
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, n + 1, i, -s) for n, (s, _, i) in enumerate(sorted(found, key=lambda r: (r[0], r[1], r[2] or 0))[:k])]
    return out


ITEMS = [(1, "The quick, brown FOX"), (2, "word961 shared3 shared4 a"), (3, None), (4, "--"), (None, "fox one"), (5, "two"), (5, "漢字"), (6, "nowhere")]


def _key(row):
    return (row[0] is None, row[0] or 0, row[1])


def test_ranking_of_odd_rows_matches_plain_python(spark, odd, nothing):
    items = spark.createDataFrame([(*r, "clash", 1) for r in ITEMS], "item_id long, text string, doc_id string, score int")
    got = [tuple(r) for r in ranked_search.rank(odd, items).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=_key) == sorted(_ranking([r[:2] for r in ODD], ITEMS), key=_key)
    assert ranked_search.rank(nothing, items).count() == 0
    assert ranked_search.rank(odd, items.limit(0)).count() == 0


def test_slices_and_blocks_do_not_change_the_ranking(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    index, asked = ranked_search.build(docs, items, "doc_id", "text", "item_id", "text")
    columns = ["item__", "rank", "id__", "score"]
    whole = sorted(tuple(r) for r in ranked_search.search(index, asked).select(*columns).collect())
    sliced = ranked_search.search(index, asked, slice_terms=100).select(*columns)
    assert sorted(tuple(r) for r in sliced.collect()) == whole
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert whole == sorted(_ranking(pairs, [tuple(r) for r in items.select("item_id", "text").collect()]))


def test_summaries_bound_every_document_and_blocks_are_skipped(spark):
    """Two languages of made-up words: a query of one must not score blocks of the other."""
    rng = np.random.default_rng(5)
    texts = [(i, " ".join(f"{'ab'[i % 2]}{w}" for w in rng.integers(0, 40, 60)) + " common") for i in range(900)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "a1 a2 a3 common"), (2, "b5 b6 b7 common")], "item_id long, text string")
    stored, asked = ranked_search.build(docs, items, "doc_id", "text", "item_id", "text")
    batch = stored.toArrow().combine_chunks().to_batches()[0]
    index = ranked_search._Index(batch, 0)
    assert len(index.block_sizes) > 3 * len(index.vocabulary)
    part = next(iter(ranked_search.slices_of(asked)[0].toArrow().combine_chunks().to_batches()))
    queries = ranked_search._Slice(part, 0, 10)
    at = np.searchsorted(index.vocabulary, queries.terms)
    for q in range(len(queries.items)):
        here = slice(queries.edges[q], queries.edges[q + 1])
        index.asked[:] = 0
        index.asked[at[here]] = queries.weights[here]
        bounds = index._bounds(np.arange(len(index.block_sizes)))
        for b, bound in enumerate(bounds):
            held = index.held[index.block_starts[b] : index.block_starts[b] + index.block_sizes[b]]
            assert index._scores(held).max() <= bound
    index.asked[:] = 0
    scored = []
    plain = ranked_search._Index._scores
    ranked_search._Index._scores = lambda self, docs: scored.append(len(docs)) or plain(self, docs)
    try:
        queries.search(index)
    finally:
        ranked_search._Index._scores = plain
    assert sum(scored) < 2 * 900 * 0.75
    got = [(int(item), n + 1, i, -s) for item, best in zip(queries.items.to_pylist(), queries.best) for n, (s, _, i) in enumerate(best)]
    assert sorted(got) == sorted(_ranking(texts, [(1, "a1 a2 a3 common"), (2, "b5 b6 b7 common")]))


# --- resampling --------------------------------------------------------------------


def _features(text):
    words = alnum(text)
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in runs]


def _resampled(docs, items):
    held, aimed = np.zeros(10_000, dtype=int), np.zeros(10_000, dtype=int)
    rows = [(i, *_features(t)) for i, t in docs]
    for _, _, found in rows:
        np.add.at(held, found, 1)
    for text in items:
        np.add.at(aimed, _features(text)[1], 1)
    s, t = int(held.sum()), int(aimed.sum())
    gain = [math.floor(1000 * math.log((int(b) + 1) * (s + 10_000) / ((int(a) + 1) * (t + 10_000)))) for a, b in zip(held, aimed)]
    out = []
    for i, n, found in rows:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fits = sorted((-r[4], r[0]) for r in out if r[1] >= 20)
    places = {}
    for k, (_, i) in enumerate(fits[: 25 * len(fits) // 100]):
        places.setdefault(i, []).append(k + 1)
    return out, places


def test_resampling_of_odd_rows_matches_plain_python(spark, odd, nothing):
    items = spark.createDataFrame([(1, "shared1 shared2 the quick", "x"), (2, None, "y"), (3, "", "z")], "item_id long, text string, bucket string")
    got = resampling.resample(odd, items).collect()
    expected, places = _resampled([r[:2] for r in ODD], [r["text"] for r in items.collect()])
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(expected, key=order)
    assert {r["doc_id"]: [r["rank"]] for r in got if r["rank"] is not None} == places
    assert resampling.resample(nothing, items).count() == 0
    assert resampling.resample(odd, items.limit(0)).count() == len(ODD)
    kept = resampling.drawn(odd, items)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == set(places)


def test_bit_sliced_sums_are_exact():
    rng = np.random.default_rng(3)
    gains = rng.integers(-9000, 9000, 10_000)
    counts = np.zeros((7, 10_000), dtype=np.int64)
    for row in range(1, 7):
        np.add.at(counts[row], rng.integers(0, 10_000, 10**row), 1)
    counts[6, 5] = 1 << 40
    assert resampling.GainPlanes(gains).sums(counts).tolist() == [int(c) for c in counts @ gains]


def test_checksums_of_long_and_wide_words():
    import pyarrow as pa

    from caremetrics.llm.words import ALNUM_LOWER, Words, column_bytes

    texts = ["x" * 64 + " " + "y" * 65 + " z", "ñandú 漢字 " + "q" * 1000 + " end " + "r" * 300, ""]
    words = Words(*column_bytes(pa.array(texts)), ALNUM_LOWER)
    owner, found = resampling.feature_buckets(words)
    for d, text in enumerate(texts):
        assert sorted(found[owner == d].tolist()) == sorted(_features(text)[1])
