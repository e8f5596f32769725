"""URL filters: given rules first, mined association rules for the rest.

A url is cut into tokens: the suffixes of its host, its path segments (numbers
become one token), and the names of its query. Frequent token combinations of
labelled urls are mined with Spark's FP-growth; combinations that predict a
verdict with enough confidence and support are kept as rules. To apply them,
rules are an inverted index from token to rule; a rule fits if all its tokens
are met. The most confident rule decides, then the better supported, then the
longer, then the last in order of its tokens; without one the verdict is ``allow``.

Tokens that come in exactly the same labelled urls (host suffixes, fixed parts of paths) say
the same and are one item while rules are mined: apart, k of them would give 2^k combinations.
A rule of items stands for all its choices of at least one token of each item,
which have one confidence and support; on a url it is named after all tokens of
these items that the url has, the longest choice that fits. Rules that are always beaten by a
shorter one are dropped. What is left is indexed under its rarest item, and the other items are looked
up in the url's own.

Urls with the same set of tokens are matched once, which also keeps a host that
holds a third of all rows from meeting the rules more than once per path shape.

A null url, or one without ``://``, has an empty host and path and no tokens.
Repeated rows are judged alike, and two labels of one page count twice; an empty table gives an empty result; without
labels nothing is mined. Other columns are not read.
"""

from __future__ import annotations

from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremetrics.functions.joins import small_side
from caremetrics.session import checkpointed

ALLOW, BLOCK = "allow", "block"
# Host, start of the path, verdict.
GIVEN_RULES = [
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
]
# Share of the labelled urls that a mined combination must occur in.
SUPPORT = 0.005
# Share of the urls with the combination that must have the rule's verdict.
CONFIDENCE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def split_url(url: Column) -> dict[str, Column]:
    """host, path and query; empty where there is none."""
    text = F.coalesce(url, F.lit(""))
    return {
        "host": F.translate(F.regexp_extract(text, _PARTS, 1), _UPPER, _LOWER),
        "path": F.regexp_extract(text, _PARTS, 2),
        "query": F.regexp_extract(text, _PARTS, 3),
    }


def tokens(host: Column, path: Column, query: Column) -> Column:
    """Host suffixes, path segments and query names, each once."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.concat(F.lit("host "), F.array_join(F.slice(labels, F.size(labels) - k + 1, k), ".")),
    )
    segments = F.transform(
        F.filter(F.split(path, "/"), lambda s: s != ""),
        lambda s: F.concat(F.lit("path "), F.regexp_replace(s, "[0-9]+", "0")),
    )
    names = F.transform(
        F.filter(F.split(query, "&"), lambda s: s != ""),
        lambda s: F.concat(F.lit("query "), F.substring_index(s, "=", 1)),
    )
    slash = F.when(path.endswith("/"), F.array(F.lit("path ends /"))).otherwise(F.array().cast("array<string>"))
    found = F.array_distinct(F.concat(suffixes, segments, slash, names))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(found)


def given_verdict(host: Column, path: Column, rules=GIVEN_RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest given rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for site, start, decision in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(start)
        rule = F.when(fits, F.lit(site + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def token_items(baskets: DataFrame, least: int) -> DataFrame:
    """token, item, n: tokens in at least ``least`` baskets, and the item they are mined as (the least of their kind).

    Baskets (``basket``, ``tokens``) are told apart by two 64-bit sums of hashes of their numbers.
    """
    seen = baskets.select(F.xxhash64("basket").alias("h"), F.explode("tokens").alias("token"))
    sums = seen.groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.bit_xor(F.xxhash64("h", F.lit(1))).alias("y")
    )
    frequent = sums.where(F.col("n") >= least)
    firsts = frequent.groupBy("n", "x", "y").agg(F.min("token").alias("item"))
    return frequent.join(firsts, ["n", "x", "y"]).select("token", "item", "n")


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Rules and items from rows of (tokens, verdict).

    Rules: items (rarest first), verdict, confidence, support. Items: token, item, n. Tokens
    below the support are in no frequent combination and are left out; all others are mined.
    """
    known = labelled.where("verdict IS NOT NULL").select("tokens", F.concat(F.lit("verdict "), "verdict").alias("label"))
    known = checkpointed(known.withColumn("basket", F.monotonically_increasing_id()))
    least = max(1, ceil(support * known.count()))
    items = checkpointed(token_items(known, least))
    # At most tokens of a url / support: one row per frequent token.
    found = known.select("basket", F.explode("tokens").alias("token")).join(small_side(items), "token")
    held = found.groupBy("basket").agg(F.collect_set("item").alias("items"))
    baskets = known.select("basket", "label").join(held, "basket", "left")
    none = F.array().cast("array<string>")
    baskets = checkpointed(baskets.select(F.concat(F.coalesce("items", none), F.array("label")).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    verdict = F.col("consequent")[0]
    rules = model.associationRules.where(verdict.startswith("verdict ")).select(
        F.array_sort("antecedent").alias("items"), F.substring_index(verdict, " ", -1).alias("verdict"), "confidence", "support"
    )
    return _unbeaten(checkpointed(_rarest_first(rules, items))), items


def _rarest_first(rules: DataFrame, items: DataFrame) -> DataFrame:
    counted = items.where("token = item").select("item", "n")
    apart = rules.select("*", F.explode("items").alias("item")).join(small_side(counted), "item")
    ordered = F.array_sort(F.collect_list(F.struct("n", "item"))).alias("ordered")
    joined = apart.groupBy("items", "verdict", "confidence", "support").agg(ordered)
    return joined.select(F.col("ordered.item").alias("items"), "verdict", "confidence", "support")


def _unbeaten(rules: DataFrame) -> DataFrame:
    """Rules without those that fit only where a better one with fewer items fits."""
    key = ["items", "verdict"]
    other = rules.select(
        F.col("items")[0].alias("item"), F.col("items").alias("fewer"), F.col("confidence").alias("c"), F.col("support").alias("s")
    )
    apart = rules.where(F.size("items") > 1).select("*", F.explode("items").alias("item"))
    better = (F.col("c") > F.col("confidence")) | ((F.col("c") == F.col("confidence")) & (F.col("s") > F.col("support")))
    inside = (F.size("fewer") < F.size("items")) & (F.size(F.array_except("fewer", "items")) == 0)
    beaten = apart.join(small_side(other), "item").where(better & inside).select(*key).distinct()
    return checkpointed(rules.join(beaten, key, "left_anti"))


def match(token_sets: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """The deciding rule of each token set (column ``tokens``): mined_rule, mined_verdict, confidence."""
    index = rules.select(F.col("items")[0].alias("item"), "items", "verdict", "confidence", "support")
    met = token_sets.select("tokens", F.explode("tokens").alias("token")).join(small_side(items), "token")
    own = met.groupBy("tokens").agg(
        F.collect_set("item").alias("own"), F.collect_list(F.struct("item", "token")).alias("pairs")
    )
    probes = own.select("*", F.explode("own").alias("item"))
    sided = small_side(index)
    fits = probes.join(sided, "item").where(F.size(F.array_except("items", "own")) == 0)
    named = F.array_sort(F.transform(
        F.filter("pairs", lambda p: F.array_contains("items", p["item"])), lambda p: p["token"]
    ))
    best = F.max(F.struct("confidence", "support", F.size(named).alias("size"), F.array_join(named, " & ").alias("name"), "verdict"))
    return fits.groupBy("tokens").agg(best.alias("best")).select(
        "tokens",
        F.col("best.name").alias("mined_rule"),
        F.col("best.verdict").alias("mined_verdict"),
        F.col("best.confidence").alias("confidence"),
    )


def judge(
    pages: DataFrame, verdicts: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=GIVEN_RULES,
    support: float = SUPPORT, confidence: float = CONFIDENCE,
) -> DataFrame:
    """Every row with host, path, rule, verdict, mined_rule and confidence.

    ``verdicts`` (id, verdict) labels some pages; it is what rules are mined from.
    """
    parsed = pages.select(F.col(id_col), *[c.alias(n) for n, c in split_url(F.col(url_col)).items()])
    parsed = parsed.withColumn("tokens", tokens(F.col("host"), F.col("path"), F.col("query")))
    known = verdicts.select(F.col(id_col).alias("_id"), "verdict").where("verdict IS NOT NULL")
    labelled = parsed.join(known, F.col(id_col) == F.col("_id")).select("tokens", "verdict")
    mined, items = mine(labelled, support, confidence)
    decided = match(parsed.where(F.size("tokens") > 0).select("tokens").distinct(), mined, items)
    rule, verdict = given_verdict(F.col("host"), F.col("path"), rules)
    return parsed.join(decided, "tokens", "left").select(
        id_col,
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.col("mined_verdict"), F.lit(ALLOW)).alias("verdict"),
        F.when(verdict.isNull(), F.col("mined_rule")).alias("mined_rule"),
        F.when(verdict.isNull(), F.col("confidence")).alias("confidence"),
    )
