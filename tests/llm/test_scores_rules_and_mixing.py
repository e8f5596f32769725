"""LM scores, license scans, URL rules and mixing."""

import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caremetrics.llm import attention, licenses, lm_scoring, mixing, subwords, url_rules
from tests.llm.conftest import ODD, alnum, fold, lower, spaced


@pytest.fixture(scope="module")
def scored(odd):
    return lm_scoring.score(odd).collect()


def test_base_score_matches_plain_python(scored):
    train = [spaced(lower(t)) for i, t, _, _ in ODD if i is not None and fold(i, 7) != 2]
    counts = Counter(w for words in train for w in words)
    counts["\n"] = len(train)  # the end
    n, v = sum(counts.values()), len(counts)
    wanted = []
    for i, text, _, _ in ODD:
        words = [*spaced(lower(text)), "\n"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        known = sum(counts[w] > 0 for w in words)
        wanted.append((i, i is not None and fold(i, 7) == 2, len(words), known, n, round(base, 6)))
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    got = [tuple(round(r[c], 6) if c == "base_score" else r[c] for c in columns) for r in scored]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))


def test_model_scores_are_probabilities_and_alike_for_equal_texts(scored):
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in scored)
    same = {round(r["score"], 4) for r in scored if r["doc_id"] in (4, 6)}
    assert len(same) == 1


def test_every_id_of_the_training_texts_is_learned_from():
    texts = [" ".join(f"word{k} of text {i}" for k in range(40 * i)) for i in range(9)] + ["", "one"]
    batches = [pa.RecordBatch.from_pydict({"text": texts[:4]}), pa.RecordBatch.from_pydict({"text": texts[4:]})]
    learned = [b.to_pydict() for b in lm_scoring._learn_from(lm_scoring.VOCABULARY)(iter(batches))]
    windows = [w for b in learned for w in b["window"] if w is not None]
    counts = {i: n for b in learned for i, n in zip(b["id"], b["n"]) if i is not None}
    assert Counter(i for w in windows for i in w[1:] if i >= 0) == counts
    assert counts[lm_scoring.END] == len(texts)
    assert all(i >= 0 for w in windows for i in w[:2])


def test_scoring_an_empty_table(nothing):
    assert lm_scoring.score(nothing).count() == 0


def test_windows_score_every_place_once_and_only_look_back():
    weights = attention.initial(np.ones(attention.CLASSES)) + np.float32(0.2)
    scorer = attention.Scorer(weights)
    rng = np.random.default_rng(1)
    classes = rng.integers(0, attention.CLASSES, 100)
    bounds = np.array([0, 1, 1, 41, 100])
    whole = scorer.stream(classes, 0, bounds)
    changed = classes.copy()
    changed[70] = (changed[70] + 1) % attention.CLASSES
    again = scorer.stream(changed, 0, bounds)
    assert np.allclose(whole[:70], again[:70], atol=1e-6) and not np.isclose(whole[70], again[70])
    assert (whole < 0).all()
    # All classes together have probability one, at every place of a window.
    seen = rng.integers(0, attention.CLASSES, (3, attention.WINDOW))
    total = sum(np.exp(scorer.windows(seen, np.full_like(seen, c))) for c in range(attention.CLASSES))
    assert np.allclose(total, 1, atol=1e-4)


def test_gradient_matches_differences_and_training_helps():
    rng = np.random.default_rng(2)
    weights = attention.initial(np.ones(attention.CLASSES)).astype(np.float64)
    seen = rng.integers(0, attention.CLASSES, (8, attention.WINDOW))
    aim = (seen + 1) % attention.CLASSES
    counted = np.ones(seen.shape)

    def loss(w):
        return -attention.Scorer(w).windows(seen, aim).mean()

    slope = attention.gradient(weights, seen, aim, counted)
    step = slope / np.linalg.norm(slope) * 1e-2
    assert (loss(weights + step) - loss(weights - step)) / 2 == pytest.approx(float(slope @ step), rel=0.05)
    trainer = attention.Trainer(weights.astype(np.float32), 0.01)
    for _ in range(60):
        trainer.step(seen, aim, counted)
    assert loss(trainer.weights) < loss(weights) - 0.5


def test_a_training_step_makes_no_large_arrays():
    rng = np.random.default_rng(3)
    seen, aim = rng.integers(0, attention.CLASSES, (2, 64, attention.WINDOW))
    trainer = attention.Trainer(attention.initial(np.ones(attention.CLASSES)), 0.01)
    trainer.step(seen, aim, np.ones(seen.shape, bool))
    tracemalloc.start()
    for _ in range(3):
        trainer.step(seen, aim, np.ones(seen.shape, bool))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100_000  # 1,024 places of 32 classes alone are 131,072 bytes


@pytest.mark.parametrize("times", [1, 12])
def test_partly_counted_windows_and_steep_weights(times):
    rng = np.random.default_rng(4)
    weights = attention.initial(np.ones(attention.CLASSES)).astype(np.float64) * times
    seen, aim = rng.integers(0, attention.CLASSES, (2, 8, attention.WINDOW))
    counted = rng.random(seen.shape) < 0.6
    w = attention.unpacked(weights)
    x = w["E"][seen] + w["P"]
    met = (x @ w["Q"]) @ (x @ w["K"]).transpose(0, 2, 1) / 4
    met[:, ~np.tri(attention.WINDOW, dtype=bool)] = -np.inf
    shares = np.exp(met - met.max(axis=-1, keepdims=True))
    h = x + (shares / shares.sum(axis=-1, keepdims=True)) @ x @ w["V"] @ w["O"]
    logits = h @ w["U"] + w["b"]
    logits -= logits.max(axis=-1, keepdims=True)
    told = logits - np.log(np.exp(logits).sum(axis=-1, keepdims=True))
    scorer = attention.Scorer(weights)
    assert scorer.safe == (times == 1)
    for skip in (0, 4):
        got = scorer.windows(seen, aim[:, skip:], skip)
        assert np.allclose(got, np.take_along_axis(told, aim[..., None], -1)[:, skip:, 0], rtol=1e-3, atol=1e-3)
    wrong = np.exp(told) - np.eye(attention.CLASSES)[aim]
    wrong *= counted[..., None] / counted.sum()
    slope = attention.unpacked(attention.gradient(weights, seen, aim, counted))
    assert np.allclose(slope["b"], wrong.sum(axis=(0, 1)))
    assert np.allclose(slope["U"], np.einsum("wpd,wpc->dc", h, wrong))


def test_packed_runs_give_back_ids_and_windows_of_training_texts():
    texts = ["One two  one", "", "three\u00a0four two", "held one out"] * 3
    train = [True, True, True, False] * 3
    columns = {"id": pa.array([None, *range(1, 12)], pa.int64()), "train": train, "text": texts}
    (batch,) = lm_scoring._encode(lm_scoring.VOCABULARY)(iter([pa.RecordBatch.from_pydict(columns)]))
    run = lm_scoring.Run(batch.column("body")[0].as_buffer())
    assert run.ids[1:].tolist() == list(range(1, 12)) and run.null.tolist() == [True] + [False] * 11
    encode = lm_scoring._encoder(lm_scoring.VOCABULARY)[0]
    wanted = [[i for w in spaced(lower(t)) for i in encode(" " + w)] + [lm_scoring.END] for t in texts]
    ids, bounds = run.stream()
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == wanted
    learned = [i for t, taught in zip(wanted, train) if taught for i in t]
    windows = run.windows()
    assert [i for i in windows[:, 1:].reshape(-1).tolist() if i >= 0] == learned
    assert windows.reshape(-1)[:1].tolist() == [lm_scoring.END] and (windows[1:, 0] == windows[:-1, -1]).all()
    assert dict(enumerate(run.id_counts().tolist())) == dict.fromkeys(range(lm_scoring.IDS), 0) | Counter(learned)


PHRASES = {("under", "the", "mit", "license"): "mit", ("apache", "license", "version", "2"): "apache-2", ("cc", "by", "nc"): "cc-by-nc"}
NOTICES = [
    (1, "Released under the MIT License.\nUNDER the-MIT license, under the mit LICENSE"),
    (2, "text\nThis work is licensed under the GNU General Public License, version 3."),
    (3, "apache license version 2 apache license version 2 CC BY-NC cc_by_nc"),
    (4, "under the mit licenses; xcc by nc; Apache License Version 20"),
    (5, "This work is licensed under the GNU Public License version 3, more or less"),
    (6, "K ſ cc by nc é"),
]


def test_license_places_match_plain_python(spark, odd):
    rows = [(i, t) for i, t, _, _ in ODD if i not in (6, None)] + [(100 + i, t) for i, t in NOTICES]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        words = alnum(text)
        found = [(k, label) for p, label in PHRASES.items() for k in range(len(words)) if tuple(words[k : k + len(p)]) == p]
        starts = [k for k, _ in found]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(found)), i
        assert (r["first_word"], r["last_word"]) == ((min(starts), max(starts)) if starts else (None, None)), i
        labels = {label for _, label in found}
        assert r["base_labels"] == ",".join(sorted(labels)) and labels <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
    assert got[102]["labels"] == "gpl-3" and got[102]["score"] == 1.0
    assert got[105]["labels"] == "gpl-3" and 0.8 <= got[105]["score"] < 1


def test_license_join_finds_every_block_over_the_threshold(spark):
    templates = [("a", "alpha beta gamma delta epsilon"), ("b", "alpha zeta"), ("c", "eta theta iota kappa")]
    lines = ["alpha beta gamma delta", "alpha beta gamma", "zeta alpha beta gamma delta epsilon", "theta iota kappa eta", "alpha", ""]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, None)], "doc_id long, text string")
    got = {(r["block"], r["label"]): r["share"] for r in licenses.contained(docs, templates, 0.8).collect()}
    wanted = {}
    for k, line in enumerate(lines):
        for label, text in templates:
            own = set(text.split())
            share = len(own & set(line.split())) / len(own)
            if share >= 0.8:
                wanted[k, label] = share
    assert got == wanted


def test_wrapped_notices_are_found(spark):
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that"
    mpl = "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy"
    one_a_line = "text before\n\n" + "\n".join(licenses.TEMPLATES[1][1].split()) + "\nafter"
    apart = "Redistribution and use in source and binary forms\n" + "other words here\n" * 20 + "with or without modification are permitted"
    docs = spark.createDataFrame(list(enumerate((bsd, "a\nb c\n" + mpl, one_a_line, apart))), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(docs).collect()}
    assert got == {0: ("bsd-3", 1.0), 1: ("mpl-2", 1.0), 2: ("mit", 1.0), 3: ("", 0.0)}


def test_licenses_of_odd_and_empty_tables(odd, nothing):
    assert licenses.scan(odd).count() == len(ODD)
    assert licenses.scan(nothing).count() == 0


URLS = [
    (1, "http://a.example.org/es/1"), (2, "https://EXAMPLE.org/en/12?x"), (3, "http://x.org/"), (4, "http://org/#f"),
    (5, "http://www.a.com/de/3.html"), (6, "http://a.com/fr/1"), (7, "http://badexample.org/es/1"), (8, "no scheme"),
    (9, None), (10, "ftp://a.net?q=1"), (11, "http://a.com://b.org/es/"), (12, "http://x.org"), (12, "http://x.org"),
]


def _judged(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = lower(rest[:cut]), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fit = [(len(s + p), s + p, v) for s, p, v in url_rules.GIVEN_RULES if (host == s or host.endswith("." + s)) and path.startswith(p)]
    return host, path, *(max(fit)[1:] if fit else (None, None))


def test_given_rules_match_plain_python(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, verdict string")
    got = url_rules.judge(pages, none).select("page_id", "host", "path", "rule", "verdict").collect()
    wanted = [(i, *_judged(u)[:3], _judged(u)[3] or "allow") for i, u in URLS]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, wanted))
    assert url_rules.judge(pages.limit(0), none).count() == 0


def test_mined_rules_decide_the_rest(spark):
    rows = [(i, f"http://{'spam' if i % 2 else 'fine'}.net/p{i % 3}/{i}", "block" if i % 2 else "allow") for i in range(60)]
    pages = spark.createDataFrame([(i, u) for i, u, _ in rows] + [(100, "http://spam.net/new"), (101, "http://else.net/")], "page_id long, url string")
    labels = spark.createDataFrame([(i, v) for i, _, v in rows], "page_id long, verdict string")
    got = {r["page_id"]: r for r in url_rules.judge(pages, labels).collect()}
    assert all(got[i]["verdict"] == v for i, _, v in rows)
    assert got[100]["verdict"] == "block" and "spam.net" in got[100]["mined_rule"]


def test_rules_on_the_last_tokens_of_deep_urls(spark):
    path = "/".join(f"part{'abcdefghi'[k]}" for k in range(9))
    rows = [(i, f"http://a.deep.net/{path}?{'bad' if i % 2 else 'good'}={i}&once{i}", "block" if i % 2 else "allow") for i in range(40)]
    pages = spark.createDataFrame([(i, u) for i, u, _ in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, v) for i, _, v in rows], "page_id long, verdict string")
    got = {r["page_id"]: r for r in url_rules.judge(pages, labels, support=0.1).collect()}
    assert all((got[i]["verdict"], got[i]["confidence"]) == (v, 1.0) for i, _, v in rows)
    assert "query bad" in got[1]["mined_rule"] and "query good" in got[0]["mined_rule"]


def test_raked_sums_meet_their_targets(spark):
    cells = [(s, l, t, float(100 + 13 * i)) for i, (s, l, t) in enumerate((s, l, t) for s in "abc" for l in "xy" for t in "pq")]
    df = spark.createDataFrame(cells, "source__cell string, lang__cell string, topic__cell string, tokens double")
    raked = mixing.rake(df, {"source": 0.0, "lang": {"x": 0.25}, "topic": 1.0}, 1e-9, 100).toPandas()
    total = df.agg(F.sum("tokens")).first()[0]
    assert raked.groupby("source__cell")["weight"].sum().to_numpy() == pytest.approx([total / 3] * 3, rel=1e-5)
    assert raked.groupby("lang__cell")["weight"].sum().to_dict() == pytest.approx({"x": total / 4, "y": total * 3 / 4}, rel=1e-5)
    before = raked.groupby("topic__cell")["tokens"].sum()
    assert raked.groupby("topic__cell")["weight"].sum().to_dict() == pytest.approx(before.to_dict(), rel=1e-5)
    # Raking keeps odds ratios.
    w = {tuple(r[c] for c in ("source__cell", "lang__cell", "topic__cell")): r["weight"] / r["tokens"] for r in raked.to_dict("records")}
    assert w["a", "x", "p"] * w["b", "y", "p"] == pytest.approx(w["a", "y", "p"] * w["b", "x", "p"], rel=1e-5)


def test_mixing_odd_rows_and_draws(spark, odd, nothing):
    got = mixing.mixed(odd)
    assert got.columns == [*odd.columns, "topic", "n_tokens", "weight", "probability", "copies"]
    rows = got.collect()
    assert len(rows) == len(ODD)
    assert {r["doc_id"]: r["n_tokens"] for r in rows if r["doc_id"]} == {i: len(spaced(t)) for i, t, _, _ in ODD if i}
    assert all(math.floor(r["weight"]) <= r["copies"] <= math.floor(r["weight"]) + 1 for r in rows)
    assert mixing.mixed(nothing).count() == 0
    many = spark.range(20_000).selectExpr("id AS doc_id", "'two words' AS text", "if(id % 4 = 0, 'a', 'b') AS source", "'en' AS lang")
    drawn = mixing.mixed(many, {"source": {"a": 0.1, "b": 0.9}})
    share = drawn.where("source = 'a'").agg(F.sum("copies")).first()[0] / 20_000
    assert share == pytest.approx(0.1, abs=0.01)


def test_rare_ids_depend_on_what_comes_before(spark):
    texts = [f"the w{i % 40} of a z{i % 40} and" for i in range(400)] + ["the of a and " * 30] * 20
    model = lm_scoring.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    for shares in model.share:  # of every class, after every class
        sums = np.bincount(model.classes, weights=np.exp(shares.astype(np.float64)), minlength=attention.CLASSES)
        assert np.allclose(sums[np.bincount(model.classes, minlength=attention.CLASSES) > 0], 1, atol=1e-4)
    own = attention.CLASSES * 3 // 4
    shared = model.classes >= own
    spread = model.share.max(axis=0) - model.share.min(axis=0)
    assert (spread[shared] > 0).sum() >= 60 and spread[shared].max() > 1


def _model(seed=5):
    rng = np.random.default_rng(seed)
    counts = rng.zipf(1.5, lm_scoring.IDS).clip(max=10_000) - 1
    model = lm_scoring.Model(counts)
    model.learn_contexts(rng.poisson(0.1, (attention.CLASSES, lm_scoring.IDS)))
    return model, rng


def test_ids_of_a_class_sum_to_one_in_every_state_and_start_from_their_counts():
    model, rng = _model()
    every, before = np.arange(lm_scoring.IDS), 3
    pairs = np.random.default_rng(0).poisson(0.1, (attention.CLASSES, lm_scoring.IDS))
    model.learn_contexts(pairs)
    total = np.bincount(model.classes, weights=pairs[before], minlength=attention.CLASSES) + lm_scoring.PRIOR
    wanted = np.log((pairs[before] + lm_scoring.PRIOR * model.plain) / total[model.classes])
    assert np.allclose(model.share[before], wanted, rtol=1e-4, atol=1e-3)
    vectors = rng.normal(0, 0.5, model.choices.shape).astype(np.float32)
    for _ in range(2):
        state = np.tile(rng.normal(size=attention.WIDTH).astype(np.float32), (lm_scoring.IDS, 1))
        told = model.tree.told(every, np.full(lm_scoring.IDS, before), state, vectors)
        assert np.allclose(np.bincount(model.classes, weights=np.exp(told), minlength=attention.CLASSES), 1, atol=1e-3)
        assert np.abs(told - wanted).max() > 1


def test_slopes_of_choices_match_differences():
    model, rng = _model()
    seen, aim = rng.integers(0, lm_scoring.IDS, (2, 4, attention.WINDOW))
    counted = rng.random(aim.shape) < 0.7
    before, state = model.classes[seen], rng.normal(size=(aim.size, attention.WIDTH)).astype(np.float32)
    vectors = rng.normal(0, 0.3, model.choices.shape).astype(np.float32)
    learner = subwords.Learner(model.tree, model.inputs, vectors, 0.01).at(seen, aim, before, counted)
    slope = learner.slope(state, 1.0)

    def loss(state, vectors):
        return -model.tree.told(aim.reshape(-1), before.reshape(-1), state, vectors)[counted.reshape(-1)].sum()

    step = (slope / np.linalg.norm(slope) * 0.01).astype(np.float32)
    assert (loss(state + step, vectors) - loss(state - step, vectors)) / 2 == pytest.approx(float((slope * step).sum()), rel=0.02)
    assert loss(state, learner.choices.values) < loss(state, vectors)
    assert (learner.choices.met > 0).sum() == len({n for i in aim[counted] for n in model.tree.choices(np.array([i]))[1].tolist()})


def test_an_id_read_places_ago_decides_between_ids_of_one_class():
    model, rng = _model()
    shared = np.flatnonzero(model.classes == attention.CLASSES - 1)
    (a, b, x, y), rest = shared[:4], np.flatnonzero(model.classes < 24)
    ids = rest[rng.integers(0, len(rest), (64, attention.WINDOW + 1))]
    first = np.arange(64) % 2 == 0
    ids[:, 2], ids[:, 9] = np.where(first, a, b), np.where(first, x, y)
    classes = model.classes[ids]
    assert (classes[:, 2] == classes[0, 2]).all() and (classes[:, 9] == classes[0, 9]).all()
    trainer, learner = attention.Trainer(model.weights, 0.01), subwords.Learner(model.tree, model.inputs, model.choices, lm_scoring.ROW_RATE)
    counted = np.ones((64, attention.WINDOW), bool)
    for _ in range(300):
        trainer.step(classes[:, :-1].copy(), classes[:, 1:].copy(), counted, learner.at(ids[:, :-1], ids[:, 1:], classes[:, :-1], counted))
    scorer = subwords.IdScorer(trainer.weights, model.classes, model.tree, learner.inputs.values, learner.choices.values)
    aim = ids[:1].copy()
    aim[0, 9] = y
    right, wrong = scorer.windows(ids[:1, :-1], ids[:1, 1:])[0, 8], scorer.windows(ids[:1, :-1], aim[:, 1:])[0, 8]
    assert right > wrong + 1
    # Nothing is told by what comes later, and every place is scored once.
    stream, bounds = ids.reshape(-1), np.array([0, 5, 5, 400, ids.size])
    whole, changed = scorer.stream(stream, a, bounds), stream.copy()
    changed[410] = b
    again = scorer.stream(changed, a, bounds)
    assert (whole < 0).all() and np.allclose(whole[:410], again[:410], atol=1e-4) and not np.allclose(whole[411:420], again[411:420], atol=1e-4)


def test_replicas_are_averaged_by_how_often_a_row_was_met():
    rows = []
    for run, (at, times) in enumerate((([1, 4], [1, 2]), ([4, 7], [6, 1]))):
        values = np.full((2, attention.WIDTH), run + 1, np.float16)
        rows.append((32, lm_scoring._INPUTS, run, lm_scoring._replica_part(np.array(at), np.array(times), values)))
    (batch,) = lm_scoring._means(iter([lm_scoring.rows_batch(rows)]))
    at, times, means = lm_scoring._opened(batch.column("body")[0].as_py())
    assert at.tolist() == [1, 4, 7] and times.tolist() == [1, 8, 1]
    assert np.allclose(means[:, 0], [1, 1.75, 2])
