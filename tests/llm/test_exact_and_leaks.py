"""Exact dedup and decontamination against plain Python."""

import hashlib
import re

from caremetrics.llm import decontamination, exact_dedup
from tests.llm.conftest import ODD, alnum


def _normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_groups_match_plain_python(odd):
    got = exact_dedup.duplicate_groups(odd).collect()
    assert len(got) == len(ODD)
    groups = {}
    for i, text, _, _ in ODD:
        groups.setdefault(_normal(text), []).append((-len(text or ""), i is None, i or 0))
    for normal, members in groups.items():
        digest = hashlib.sha256(normal.encode()).hexdigest()
        mine = [r for r in got if r["text_sha256"] == digest]
        assert len(mine) == len(members) and {r["group_size"] for r in mine} == {len(members)}
        best = min(members)
        assert {r["keep_id"] for r in mine} == {None if best[1] else best[2]}
        assert [r["doc_id"] for r in mine if r["kept"]] == [None if best[1] else best[2]]


def test_kept_rows_keep_all_columns(odd):
    kept = exact_dedup.drop_duplicates(odd)
    assert kept.columns == odd.columns
    texts = [_normal(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({_normal(t) for _, t, _, _ in ODD})


def test_a_hot_text_over_many_partitions_leaves_one_row(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) AS text").repartition(20)
    got = exact_dedup.duplicate_groups(docs)
    assert got.where("group_size = 1000 AND keep_id = 0").count() == 1000
    assert got.where("kept").count() == 2001
    assert exact_dedup.drop_duplicates(docs).count() == 2001


ITEMS = [
    (1, "shared3 shared4 shared5 shared6 shared7 shared8 shared9 shared10 shared11 shared12 shared13"),
    (2, "Quick, brown"),
    (3, "a a a a a a a a a a a"),
    (4, None),
    (5, "--"),
    (6, "not anywhere at all in any of these documents as far as known"),
    (7, "quick brown"),
    (None, "fox"),
]


def _expected(text, items, width=10):
    words, hit, names = alnum(text), set(), set()
    for name, item in items:
        own = alnum(item)
        size = min(width, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[k : k + size]:
                    hit.update(range(at, at + size))
                    names.update([] if name is None else [str(name)])
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(words), len(hit), len(names), digest, bool(hit)


def test_windows_match_plain_python(spark, odd, monkeypatch):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    wanted = sorted(map(repr, ((i, *_expected(t, ITEMS)) for i, t, _, _ in ODD if i != 7 and i != 8)))
    for size, together in ((decontamination.RUN_BYTES, decontamination._TOGETHER), (40, 3)):  # one run a batch, and many
        monkeypatch.setattr(decontamination, "RUN_BYTES", size)
        monkeypatch.setattr(decontamination, "_TOGETHER", together)
        found = decontamination.matches(odd, benchmark, ["doc_id"]).where("doc_id IS NULL OR doc_id NOT IN (7, 8)")
        got = found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
        assert sorted(repr(tuple(r)) for r in got) == wanted


def test_a_benchmark_as_large_as_the_documents_is_searched_without_collecting_it(spark, monkeypatch):
    texts = [" ".join(f"w{(d * 7 + k * k) % 53}" for k in range(40)) for d in range(120)]
    texts += [" ".join(["common"] * 30 + [f"rare{d}"]) for d in range(60)]  # one term holds most places
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    items = [(d, " ".join(t.split()[3:25])) for d, t in enumerate(texts)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(5)
    monkeypatch.setattr(decontamination, "RUN_BYTES", 2000)
    monkeypatch.setattr(type(benchmark), "toLocalIterator", None)
    got = decontamination.matches(docs, benchmark, ["doc_id"])
    rows = got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    wanted = [(d, *_expected(t, items)) for d, t in enumerate(texts)]
    assert sorted(tuple(r) for r in rows) == wanted


def test_one_index_serves_several_benchmarks(spark, odd):
    index = decontamination.build_index(odd, ["doc_id"])
    for text, ids in ((ITEMS[0][1], {9, 10}), ("the quick brown fox", {4, 5, 6, None}), ("absent words", set())):
        windows = decontamination.item_windows(spark.createDataFrame([(1, text)], "item_id long, text string"))
        hits = decontamination.search(index, windows, slop=None).where("n_hit > 0").select("run", "place")
        documents = index.selectExpr("run", "posexplode(documents) AS (place, document)")
        assert {r[0] for r in documents.join(hits, ["run", "place"]).select("document.doc_id").collect()} == ids


def test_near_windows_are_told_from_phrases(spark):
    docs = spark.createDataFrame([(1, "alpha x beta y gamma"), (2, "alpha beta gamma"), (3, "alpha beta")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["n_near"], r["spans"]) for r in decontamination.matches(docs, benchmark, ["doc_id"]).collect()}
    assert got == {1: (False, 1, []), 2: (True, 0, [[0, 3]]), 3: (False, 0, [])}


def test_dropping_keeps_clean_rows_and_columns(spark, odd):
    benchmark = spark.createDataFrame([(1, ITEMS[0][1])], "item_id long, text string")
    kept = decontamination.drop_contaminated(odd, benchmark)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _, _, _ in ODD} - {9, 10}


def test_empty_tables(spark, odd, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert exact_dedup.duplicate_groups(nothing).count() == 0
    assert exact_dedup.drop_duplicates(nothing).count() == 0
    assert decontamination.matches(nothing, none, ["doc_id"]).count() == 0
    assert decontamination.matches(odd, none, ["doc_id"]).where("contaminated").count() == 0
