"""License scan: an exact set-similarity join of text blocks with license templates.

A block (a line of the text, or a span of neighbouring lines for a notice that is
wrapped) matches a template if it holds at least the share ``threshold`` of the
template's distinct tokens. The lines between the first and the last of a span hold
no more words than the longest template over the threshold; lines without words do
not count. A span matches only if it holds more of the template than its first line
and than the span from its next line on, so a notice is met where it begins. The template's tokens are
ordered from rare to frequent by the number of blocks that hold them in the whole
table. A matching block must hold one of the template's first ``size - required
+ 1`` tokens (prefix filter), at least the required number of template tokens
(length filter), and enough of them from its first shared token on (positional
filter). The rest is verified by counting.

Besides, fixed phrases are located exactly: every place where their words stand
one after another in the whole text.

Null and empty texts have no words, no places and no labels. Documents of the
same id share the labels that the join finds for any of them. Templates are a
fixed, short list, so they are literals of the plan. An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases located exactly, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Usual notices by which the join recognises a license.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
# Share of a template's tokens that a block must hold.
THRESHOLD = 0.8

_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _required(tokens: list[str], threshold: float) -> int:
    return max(1, -(-round(threshold * 1000) * len(tokens) // 1000))


def _spelled(text: Column) -> Column:
    """Every word of the text with a blank of its own on either side, A-Z lower-cased."""
    words = F.translate(F.regexp_replace(text, _BREAKS, "  "), _UPPER, _LOWER)
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def _words_in(spelled: Column) -> Column:
    return F.when(F.trim(spelled) == "", 0).otherwise(F.size(F.split(F.trim(spelled), "  ")))


def places(docs: DataFrame, text_col: str, phrases: dict[str, str]) -> DataFrame:
    """Add n_words, n_base, first_word, last_word and base_found (labels) to each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lowered = F.lower(text)
    patterns = {f" {'  '.join(p.split())} ": label for p, label in phrases.items()}
    # Most texts lack some word of every phrase; only the others are respelled.
    possible = F.lit(False)
    for phrase in phrases:
        every = F.lit(True)
        for word in sorted(phrase.split(), key=len, reverse=True):
            every = every & F.contains(lowered, F.lit(word))
        possible = possible | every
    found = docs.withColumn("n_words", F.regexp_count(text, F.lit(_WORD)).cast("long")).withColumn(
        "_spelled", F.when(possible, _spelled(text)).otherwise(F.lit(""))
    )
    counts, firsts, lasts, labels = [], [], [], []
    spelled = F.col("_spelled")
    for pattern, label in patterns.items():
        here = F.lit(pattern)
        some = F.contains(spelled, here)
        n = (F.length(spelled) - F.length(F.replace(spelled, here, F.lit("")))) / len(pattern)
        at = F.instr(spelled, pattern)
        back = F.instr(F.reverse(spelled), pattern[::-1])
        after = F.length(spelled) - back - len(pattern) + 1
        counts.append(F.when(some, n.cast("long")).otherwise(0))
        firsts.append(F.when(some, _words_in(F.substring(spelled, F.lit(1), at - 1))))
        lasts.append(F.when(some, _words_in(F.substring(spelled, F.lit(1), after))))
        labels.append(F.when(some, F.lit(label)))

    def extreme(pick, columns):
        return pick(*columns) if len(columns) > 1 else columns[0]

    return found.select(
        *docs.columns,
        "n_words",
        sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        extreme(F.least, firsts).cast("long").alias("first_word"),
        extreme(F.greatest, lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base_found"),
    )


def blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, block number, distinct lower-case tokens of each line that has any."""
    lines = docs.select(id_col, F.posexplode(F.split(F.col(text_col), "\n")).alias("block", "line"))
    tokens = F.array_distinct(F.split(F.lower("line"), _BREAKS))
    return lines.select(id_col, "block", tokens.alias("tokens"))


def spans(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[str], longest: int) -> DataFrame:
    """id, number of the first line, and the vocabulary tokens of the longest span from there on.

    Also those of its first line (``alone``) and of the span from the next line on (``later``).
    """
    words = F.transform(F.split(F.lower(text_col), "\n"), lambda line: F.filter(F.split(line, _BREAKS), lambda w: w != ""))
    numbered = F.transform(
        words, lambda w, at: F.struct(at.alias("block"), F.array_intersect(w, _literal(vocabulary)).alias("held"), F.size(w).alias("n"))
    )
    lines = docs.select(id_col, F.filter(numbered, lambda line: line["n"] > 0).alias("lines"))

    def taken(line: Column, at: Column) -> Column:
        # Every line that follows has a word, so no span is longer than that.
        following = F.slice("lines", at + 2, F.lit(longest + 1))
        start = F.struct(line["held"].alias("held"), F.lit(0).alias("inner"))
        grown = lambda span, x: F.struct(F.array_union(span["held"], x["held"]).alias("held"), (span["inner"] + x["n"]).alias("inner"))
        whole = F.aggregate(following, start, lambda span, x: F.when(span["inner"] <= longest, grown(span, x)).otherwise(span))
        return F.struct(line["block"].alias("block"), line["held"].alias("alone"), whole["held"].alias("tokens"))

    found = lines.where(F.size("lines") > 1).select(id_col, F.transform("lines", taken).alias("spans"))
    later = lambda s, at: F.struct(s["block"].alias("block"), s["tokens"].alias("tokens"), s["alone"].alias("alone"), F.get("spans", at + 1)["tokens"].alias("later"))
    return found.select(id_col, F.inline(F.transform("spans", later)))


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def token_order(lines: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Rank of each template token: rare first, by the number of blocks that hold it."""
    held = lines.select(F.explode(F.array_intersect("tokens", _literal(vocabulary))).alias("token"))
    counts = {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count("*").alias("n")).collect()}
    ordered = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))  # as many rows as template tokens
    return {word: rank for rank, word in enumerate(ordered)}


def contained(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, block, label, share for every (block, template) at or above the threshold."""
    split = [(label, sorted(set(text.lower().split()))) for label, text in templates]
    vocabulary = sorted({w for _, words in split for w in words})
    lines = blocks(docs, id_col, text_col)
    rank = token_order(lines, vocabulary)
    nothing = F.array().cast("array<string>")
    longest = max(-(-len(text.split()) * 1000 // round(threshold * 1000)) for _, text in templates)
    # Only texts that hold enough of some template, as parts of words at least, can have a span.
    lowered, enough = F.lower(text_col), F.lit(False)
    for _, words in split:
        enough = enough | (sum(F.contains(lowered, F.lit(w)).cast("int") for w in words) >= _required(words, threshold))
    wrapped = spans(docs.where(enough), id_col, text_col, vocabulary, longest)
    lines = lines.select(id_col, "block", "tokens", nothing.alias("alone"), nothing.alias("later")).unionByName(wrapped)

    shape = "template int, label string, size int, required int, ranks array<int>"
    rows = []
    for number, (label, words) in enumerate(split):
        ranks = sorted(rank[w] for w in words)
        rows.append((number, label, len(ranks), _required(words, threshold), ranks))
    known = docs.sparkSession.createDataFrame(rows, shape)
    prefixes = known.withColumn(
        "first", F.explode(F.slice("ranks", 1, F.col("size") - F.col("required") + 1))
    )
    leading = sorted({r for _, _, size, need, ranks in rows for r in ranks[: size - need + 1]})
    shortest = min(need for _, _, _, need, _ in rows)

    words_of = [w for w, _ in sorted(rank.items(), key=lambda item: item[1])]
    # Only tokens that some template's prefix holds can start a match.
    near = lines.where(F.arrays_overlap("tokens", _literal([words_of[r] for r in leading])))
    held = F.array_intersect(_literal(words_of), F.col("tokens"))
    ranks_of = lambda held: F.transform(held, lambda w: F.array_position(_literal(words_of), w).cast("int") - 1)
    ranked = near.withColumns({"held": ranks_of(held), "alone": ranks_of(F.col("alone")), "later": ranks_of(F.coalesce("later", nothing))})
    ranked = ranked.where(F.size("held") >= shortest).select(id_col, "block", "held", "alone", "later")
    probes = ranked.withColumn("first", F.explode("held"))
    candidates = probes.join(F.broadcast(prefixes), "first")  # one row per template token at most
    # A pair counts at its first shared token only, so both sides need enough from there on.
    onwards = lambda side: F.size(F.filter(side, lambda r: r >= F.col("first")))
    possible = candidates.where(
        (F.size("held") >= F.col("required"))
        & (onwards("held") >= F.col("required"))
        & (onwards("ranks") >= F.col("required"))
    )
    common = F.array_intersect("held", "ranks")
    verified = possible.where((F.element_at(common, 1) == F.col("first")) & (F.size(common) >= F.col("required")))
    other = lambda c: F.size(F.array_intersect(c, "ranks"))
    verified = verified.where((F.size(common) > other("alone")) & (F.size(common) > other("later")))
    return verified.select(id_col, "block", "label", (F.size(common) / F.col("size")).alias("share"))


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    based = places(docs.select(id_col, text_col), text_col, phrases).drop(text_col)
    matched = contained(docs, templates, threshold, id_col, text_col)
    # At most one label per template and document survives the partial aggregate.
    matched = matched.groupBy(id_col).agg(
        F.collect_set("label").alias("matched"), F.max("share").alias("share")
    )
    joined = based.join(matched.withColumnRenamed(id_col, "_id"), F.col(id_col) == F.col("_id"), "left")
    some = F.coalesce("matched", F.array().cast("array<string>"))

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return joined.select(
        id_col,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        listed(F.col("base_found")).alias("base_labels"),
        listed(F.array_union("base_found", some)).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
