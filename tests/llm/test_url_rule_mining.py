"""Mined url rules against a brute-force search, and urls with many common tokens."""

import itertools
import math
import random
import re
import time

import pytest

from caremetrics.llm import url_rules
from caremetrics.llm.url_rules import ALLOW, BLOCK


def _tokens(url):
    """Host suffixes, path segments, slash mark and query names of a plain url."""
    rest = url.split("://", 1)[1]
    rest, _, query = rest.partition("?")
    host, _, path = rest.partition("/")
    labels = host.split(".")
    out = {"host " + ".".join(labels[-k:]) for k in range(1, len(labels) + 1)}
    out |= {"path " + re.sub("[0-9]+", "0", s) for s in path.split("/") if s}
    out |= {"query " + n.split("=")[0] for n in query.split("&") if n}
    return out | ({"path ends /"} if rest.endswith("/") else set())


def _best(rows, urls, support, confidence):
    """The best of all combinations of tokens for each url, by trying every one."""
    baskets = [(_tokens(u), v) for u, v in rows]
    least = math.ceil(support * len(baskets))
    out = {}
    for i, url in urls:
        found, own = [], sorted(_tokens(url))
        for size in range(1, len(own) + 1):
            for combo in itertools.combinations(own, size):
                fits = [v for tokens, v in baskets if tokens >= set(combo)]
                for verdict in (ALLOW, BLOCK):
                    n = fits.count(verdict)
                    if n >= least and n / len(fits) >= confidence:
                        found.append((round(n / len(fits), 12), n, size, " & ".join(combo), verdict))
        out[i] = max(found)[3:] if found else (None, None)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_mined_rules_match_a_brute_force_search(spark, seed):
    rng = random.Random(seed)

    def url(i):
        site = rng.choice(["a.one.net", "b.one.net", "two.net"])
        parts = [rng.choice(["news", "shop", "x"]), rng.choice(["p1", "q", "r2"])][: rng.randint(0, 2)]
        end = rng.choice(["", "/"])
        query = rng.choice(["", "?ad=1", "?ad=2&ref=3"])
        return f"http://{site}/" + "/".join(parts) + end * bool(parts) + query

    rows = [(i, u, BLOCK if ("shop" in u) ^ (rng.random() < 0.2) else ALLOW) for i, u in ((i, url(i)) for i in range(80))]
    fresh = [(1000 + i, url(i)) for i in range(40)] + [(2000, "http://two.net/shop/never?ref=1"), (2001, "http://else.gov/")]
    pages = spark.createDataFrame([r[:2] for r in rows] + fresh, "page_id long, url string")
    labels = spark.createDataFrame([(i, v) for i, _, v in rows], "page_id long, verdict string")
    got = url_rules.judge(pages, labels, support=0.06, confidence=0.6)
    expected = _best([r[1:] for r in rows], [tuple(r) for r in pages.collect()], 0.06, 0.6)
    mined = {r["page_id"]: (r["mined_rule"], r["verdict"] if r["mined_rule"] else None) for r in got.collect()}
    assert mined == expected


def test_urls_with_many_common_tokens_end(spark):
    common = "/".join("part" + chr(97 + k) for k in range(20))
    hosts = "a.b.c.d.net"
    rows = [(i, f"http://{hosts}/{common}/{'bad' if i % 2 else 'good'}/{i}", BLOCK if i % 2 else ALLOW) for i in range(60)]
    pages = spark.createDataFrame([r[:2] for r in rows] + [(99, f"http://{hosts}/parta/bad"), (98, "http://x.net/good")], "page_id long, url string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "page_id long, verdict string")
    start = time.time()
    got = {r["page_id"]: r for r in url_rules.judge(pages, labels).collect()}
    assert time.time() - start < 120
    assert all(got[i]["verdict"] == v for i, _, v in rows) and got[99]["verdict"] == BLOCK and got[98]["verdict"] == ALLOW
    assert got[1]["mined_rule"].count(" & ") > 20 and got[99]["mined_rule"] == " & ".join(sorted(
        ["host " + h for h in ("net", "d.net", "c.d.net", "b.c.d.net", "a.b.c.d.net")] + ["path bad", "path parta"]))


def test_rules_that_are_always_beaten_are_dropped(spark):
    rows = [(["a"], BLOCK, 0.9, 0.5), (["b", "a"], BLOCK, 0.8, 0.3), (["c", "a"], BLOCK, 0.95, 0.2), (["d", "a"], BLOCK, 0.9, 0.5)]
    rules = spark.createDataFrame(rows, "items array<string>, verdict string, confidence double, support double")
    kept = {tuple(r["items"]) for r in url_rules._unbeaten(rules).collect()}
    assert kept == {("a",), ("c", "a"), ("d", "a")}


def test_odd_urls_and_repeated_labels(spark):
    long = "http://long.gov/" + "/".join(f"s{k}x{'y' * (k % 9)}" for k in range(3000)) + "?" + "&".join(f"n{k}" for k in range(500))
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, long), (4, long), (5, "http://"), (6, "http://bad.net/a"), (7, "http://bad.net/b"), (None, "http://bad.net/c")]
    pages = spark.createDataFrame([(*r, "clash", "t", 1) for r in rows], "page_id long, url string, host string, tokens string, rule int")
    labels = spark.createDataFrame([(6, BLOCK), (6, BLOCK), (7, BLOCK), (1, ALLOW), (3, None), (None, BLOCK)], "page_id long, verdict string")
    got = url_rules.judge(pages, labels, support=0.3)
    rows_out = got.collect()
    assert len(rows_out) == len(rows)
    by_id = {r["page_id"]: r for r in rows_out}
    assert by_id[6]["verdict"] == by_id[None]["verdict"] == BLOCK and by_id[4]["verdict"] == ALLOW
    assert by_id[1]["host"] == "" and by_id[1]["mined_rule"] is None
    assert url_rules.judge(pages.limit(0), labels).count() == 0
    assert url_rules.judge(pages, labels.limit(0)).where("mined_rule IS NOT NULL").count() == 0
