"""The n-gram join, repeated passages and components against plain Python."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from caremetrics.llm import ngram_join, substring_dedup
from caremetrics.llm.components import connected
from caremetrics.llm.packing import unsqueezed
from tests.conftest import rows
from tests.llm.conftest import ODD, lower, spaced


def _shingles(text, width):
    words = spaced(lower(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def _components(docs, width, percent):
    sets = {}
    for i, text in docs:
        sets.setdefault(i, []).append(_shingles(text, width))
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
                one, two = find(a), find(b)
                parent[max(one, two)] = min(one, two)
    return {i: find(i) for i in ids}


def _near_copies(seed, groups=6, copies=14):
    random.seed(seed)
    docs = []
    for g in range(groups):
        base = [f"w{random.randrange(400)}" for _ in range(random.choice([40, 90, 150]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(random.choice([0, 1, 1, 2, 4])):
                words[random.randrange(len(words))] = f"v{random.randrange(10**6)}"
            docs.append(" ".join(words + ["tail"] * random.choice([0, 0, 1])))
    random.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_components_match_plain_python(spark, width, percent):
    docs = _near_copies(width)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = ngram_join.similar_documents(df, width=width, percent=percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == _components(docs, width, percent)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(_shingles(t, width)) for i, t in docs}


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_near_copies_of_very_long_texts_are_linked(spark, width, percent):
    words = [f"w{i}" for i in range(210_000)]
    near, far = list(words), list(words)
    near[::20_000] = ["v"] * len(near[::20_000])
    far[::7] = ["x"] * len(far[::7])
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate((words, near, far))], "doc_id long, text string")
    got = ngram_join.similar_documents(df, width=width, percent=percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {0: 0, 1: 0, 2: 2}
    assert min(r["n_shingles"] for r in got) > 200_000


def test_hash_orders_never_rule_out_a_similar_pair():
    rng = np.random.default_rng(5)
    for n in (3, 30, 500, ngram_join.WIDE - 40, 150_000):
        for percent in (50, 80, 90):
            threshold = ngram_join.Threshold(percent)
            for _ in range(20 if n < 10_000 else 2):
                pool = np.unique(rng.integers(0, 2**63, 2 * n + 10).astype(np.uint64))
                rng.shuffle(pool)
                gone = threshold.difference(n, n) // 2
                # As different as the similarity allows: the first set, and one with ``gone`` exchanged or added.
                for b in (pool[gone : n + gone], pool[: min(100 * n // percent, len(pool))]):
                    a, b = np.sort(pool[:n]), np.sort(b)
                    assert threshold.reached(len(np.intersect1d(a, b)), len(a), len(b))
                    for order in ngram_join._ORDERS:
                        one, two = (ngram_join._leading(s, order, threshold.prefix(len(s))) for s in (a, b))
                        assert ngram_join._allowed(one, two, len(a), len(b), threshold.difference(len(a), len(b)))


def test_odd_rows_of_the_join(odd, nothing):
    got = ngram_join.similar_documents(odd).collect()
    assert len(got) == len(ODD)
    wanted = _components([(i, t) for i, t, _, _ in ODD if i is not None], 3, 90)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == wanted
    assert ngram_join.similar_documents(nothing).count() == 0
    kept = ngram_join.keep_one_per_group(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} >= {1, 2, 3, 4, 7, None}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (200, 199)]
    got = dict(rows(connected(spark.createDataFrame(links, "a long, b long"))))
    assert {v for k, v in got.items() if k <= 60} == {0}
    assert {v for k, v in got.items() if 100 <= k < 150} == {100}
    assert got[200] == got[199] == 199


def _kept(docs, window):
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    first = {}
    for i, text in order:
        words = spaced(text)
        for at in range(len(words) - window + 1):
            key = (i is None, i or 0, at)
            first[tuple(words[at : at + window])] = min(first.get(tuple(words[at : at + window]), key), key)
    out = []
    for i, text in docs:
        words = spaced(text)
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] < (i is None, i or 0, at):
                gone.update(range(at, at + window))
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(map(repr, out))


def test_repeats_match_plain_python(odd):
    got = substring_dedup.remove_repeats(odd)
    assert sorted(repr(tuple(r)) for r in got.collect()) == _kept([(i, t) for i, t, _, _ in ODD], 20)


@pytest.mark.parametrize("window", [4, 20])
def test_planted_passages_at_any_offset(spark, window):
    random.seed(window)
    passages = [[f"p{k}x{j}" for j in range(random.randrange(window - 1, 4 * window))] for k in range(5)]
    docs = []
    for i in range(40):
        words = [f"u{i}y{j}" for j in range(random.randrange(0, 30))]
        for _ in range(random.randrange(0, 3)):
            passage = random.choice(passages)
            cut = random.randrange(0, 3)
            at = random.randrange(0, len(words) + 1)
            words[at:at] = passage[cut:]
        docs.append((i * 3, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = substring_dedup.remove_repeats(df, window=window)
    assert sorted(repr(tuple(r)) for r in got.collect()) == _kept(docs, window)


def test_repeats_of_an_empty_table(nothing):
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_parity_sketches_never_differ_more_than_their_sets():
    rng = np.random.default_rng(11)
    for n in (1, 12, 200, 3_000):
        pool = np.unique(rng.integers(0, 2**63, 3 * n).astype(np.uint64))
        rng.shuffle(pool)
        for moved in {0, 1, n // 10, n // 2, n}:
            a, b = np.sort(pool[:n]), np.sort(pool[moved : n + moved])
            differ = (ngram_join._parities(a) ^ ngram_join._parities(b)).view(np.uint64)
            bits = sum(int(x).bit_count() for x in differ)
            folded = sum(int(np.bitwise_xor.reduce(differ[i :: ngram_join.FOLDED])).bit_count() for i in range(ngram_join.FOLDED))
            assert folded <= bits <= len(np.setxor1d(a, b))
            assert (bits == 0) == (moved == 0)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_large_group_of_loose_copies_makes_few_candidates(spark, monkeypatch, width, percent):
    """Copies of one text that mostly do not link: lists are split, and pairs too far apart are no rows."""
    monkeypatch.setattr(ngram_join, "PART", 16)
    made, agree = [], ngram_join._agree
    monkeypatch.setattr(ngram_join, "_agree", lambda pairs, *rest: made.append(pairs.count()) or agree(pairs, *rest))
    random.seed(3)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(120):
        words = list(base)
        for at in random.sample(range(len(words)), 1 if i % 10 == 0 else 14):
            words[at] = f"v{i} {at}"
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = ngram_join.similar_documents(df, width=width, percent=percent).collect()
    expected = _components(docs, width, percent)
    assert {r["doc_id"]: r["component_id"] for r in got} == expected
    assert 1 < len(set(expected.values())) < len(docs)
    assert made[-1] < len(docs) * 10


def test_places_rule_out_only_sets_that_differ_too_much(spark):
    """Shared shingles of sets in one order: similar sets keep all, others lose those that are too far apart."""
    rng = np.random.default_rng(3)
    listed, wanted = [], {}
    for pair in range(60):
        percent_kept = (60, 90, 97)[pair % 3]
        whole = rng.permutation(400)[: rng.integers(20, 300)]
        a = set(whole.tolist())
        b = {x for x in a if rng.integers(100) < percent_kept} | set(rng.integers(400, 420, 2).tolist())
        placed = [{x: i for i, x in enumerate(sorted(s))} for s in (a, b)]
        wanted[pair] = 100 * len(a & b) >= 90 * len(a | b)
        listed += [(pair, len(a), len(b), placed[0][x], placed[1][x]) for x in a & b]
    df = spark.createDataFrame(listed, "pair int, n int, other_n int, place int, other_place int")
    fits = df.groupBy("pair").agg({"*": "count"}).join(df.where(ngram_join._places_fit(ngram_join.Threshold(90))).groupBy("pair").count(), "pair", "left").collect()
    assert all(r["count"] == r["count(1)"] for r in fits if wanted[r["pair"]])
    assert any(wanted.values()) and sum(r["count"] or 0 for r in fits) < len(listed)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_texts_with_repeats_move_packed_and_whole(kind):
    dice = random.Random(3)
    words = ["".join(dice.choice("etaoinshrdlu") for _ in range(dice.randint(2, 9))) for _ in range(300)]
    texts = [None, "", "é\0\n x", *(" ".join(dice.choice(words) for _ in range(600)) for _ in range(50))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, kind)], ["key", "text"])
    moved = list(substring_dedup._packed_texts(iter([batch.slice(0, 9), batch.slice(9)])))
    back = [t for b in moved for t in unsqueezed(b.column("size"), b.column("body")).to_pylist()]
    assert back == [t or "" for t in texts]
    assert [k for b in moved for k in b.column("key").to_pylist()] == list(range(len(texts)))
    assert sum(b.column("body").nbytes for b in moved) < 0.6 * sum(len(t) for t in back)


def test_a_row_without_text_shares_the_id_of_a_repeat(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (2, text), (2, None), (2, ""), (3, None)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.remove_repeats(docs).collect())
    assert got == [(1, 30, 0), (2, 0, 0), (2, 0, 0), (2, 30, 30), (3, 0, 0)]


def test_places_of_windows_pack_small_and_come_back():
    dice = np.random.default_rng(1)
    key = np.sort(dice.integers(0, 1 << 40, 3000))
    key[:2], key[-1] = (-(1 << 63), -5), (1 << 63) - 1
    hashes, start = dice.integers(0, 1 << 64, 3000, dtype=np.uint64), dice.integers(0, 900, 3000)
    for n in (3000, 1, 0):
        back = substring_dedup._unpack_places(substring_dedup._pack_places(hashes[:n], key[:n], start[:n]))
        assert all((a == b[:n]).all() and len(a) == n for a, b in zip(back, (hashes, key, start)))
    key = np.sort(dice.integers(0, 100_000, 3000))
    plain = b"".join(x.astype("<i8").tobytes() for x in (key, start))
    packed = substring_dedup._pack_places(hashes, key, start)[8 * 3000 :]
    assert len(pa.compress(packed, "lz4_raw", asbytes=True)) < 0.5 * len(pa.compress(plain, "lz4_raw", asbytes=True))
