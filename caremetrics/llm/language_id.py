"""Language identification by rank-order profiles of character n-grams.

A profile lists the ``depth`` most frequent n-grams (one to three letters, word
ends count as a blank) in order. A text's profile is compared with that of each
language by the out-of-place measure: the sum, over the text's n-grams, of the
distance between its two ranks, or ``depth`` where the language's profile lacks
it. The language with the smallest distance is predicted, the first in order if
several share it. The score is one minus that distance over the largest possible.

A text that is null or has no letter is ``und`` with score 0, and so is every
text if no language could be learned. Training rows without a language or an id
teach nothing. Repeated rows count as often as they occur; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremetrics.llm.words import column_bytes, pieces

# N-grams per profile.
DEPTH = 300
# Profiles are sent to every task, so their number must be bounded; a column with
# more distinct labels is no language column and is refused.
MAX_LANGUAGES = 5000
UNDETERMINED = "und"
# Score below which a text counts as none of the learned languages.
MIN_SCORE = 0.2

_NONE = (1 << 21) - 1  # marks the places that a shorter n-gram leaves free
_letters: list[np.ndarray] = []
# Bytes of text whose n-grams a task sorts at once; each byte takes some 100 of memory there.
_PIECE = 1 << 18
# N-gram counts kept by a task before they are merged.
_HELD = 200_000


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


class Grams:
    """The distinct n-grams of each document of a piece, with their counts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace").lower() for a, b in zip(offsets[:-1], offsets[1:])]
        codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), dtype=np.uint32)
        codes = np.concatenate([[0], codes, [0, 0]]).astype(np.int64)
        codes[~_is_letter()[codes]] = 0
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        # A small alphabet in code point order keeps the keys short.
        present = np.zeros(0x110000, dtype=bool)
        present[codes] = True
        present[0] = True
        self._alphabet = np.flatnonzero(present)
        place = np.zeros(0x110000, dtype=np.int32)
        place[self._alphabet] = np.arange(len(self._alphabet))
        small = place[codes].astype(np.uint64)
        self._bits = int(len(self._alphabet)).bit_length()
        b, free = np.uint64(self._bits), np.uint64((1 << self._bits) - 1)
        one, two, three = small[:-2], small[1:-1], small[2:]
        # Row i of the document stream is ``two``; n-grams start at the letter or the blank before it.
        middle = two > 0
        owner = np.concatenate([owner, [max(len(texts) - 1, 0)]])[: len(two)]
        keys = [
            ((two << b | free) << b | free, middle),
            ((one << b | two) << b | free, (one > 0) | (two > 0)),
            ((one << b | two) << b | three, middle),
        ]
        total = 3 * self._bits
        top = owner.astype(np.uint64) << np.uint64(total)
        merged = np.concatenate([(top | key)[ok] for key, ok in keys])
        merged.sort()
        first = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]])) if len(merged) else np.empty(0, int)
        self.count = np.diff(np.concatenate([first, [len(merged)]]))
        distinct = merged[first]
        self.document = (distinct >> np.uint64(total)).astype(np.int64)
        self._small = distinct & np.uint64((1 << total) - 1)
        self.documents = len(texts)

    def code(self, chosen: np.ndarray | slice) -> np.ndarray:
        """N-grams as numbers that mean the same everywhere and keep their order."""
        small, free = self._small[chosen], (1 << self._bits) - 1
        out = np.zeros(len(small), dtype=np.int64)
        for step in (2, 1, 0):
            part = (small >> np.uint64(step * self._bits)).astype(np.int64) & free
            letters = self._alphabet[np.minimum(part, len(self._alphabet) - 1)]
            out = out << 21 | np.where(part == free, _NONE, letters)
        return out

    def top(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(index, rank) of each document's most frequent n-grams; ties in n-gram order."""
        order = np.lexsort((-self.count, self.document)) if not self._packs() else self._packed_order()
        document = self.document[order]
        begin = np.searchsorted(document, np.arange(self.documents))
        rank = np.arange(len(order)) - begin[document]
        kept = rank < depth
        return order[kept], rank[kept]

    def _packs(self) -> bool:
        return len(self.count) > 0 and (self.documents * (int(self.count.max()) + 1) * len(self.count)) < 1 << 62

    def _packed_order(self) -> np.ndarray:
        n, most = len(self.count), int(self.count.max()) + 1
        key = (self.document * most + (most - 1 - self.count)) * n + np.arange(n)
        key.sort()
        return key % n


def _count_grams(lang_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            lang, code, n = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((code, lang))
            lang, code, n = lang[order], code[order], n[order]
            new = np.flatnonzero(np.concatenate([[True], (lang[1:] != lang[:-1]) | (code[1:] != code[:-1])]))
            return lang[new], code[new], np.add.reduceat(n, new)

        for batch in batches:
            for part, data, offsets in pieces(batch, text_col, _PIECE):
                lang = np.array([names.setdefault(x, len(names)) for x in part.column(lang_col).to_pylist()])
                grams = Grams(data, offsets)
                if len(grams.count):
                    held.append((lang[grams.document], grams.code(slice(None)), grams.count))
                if sum(len(h[0]) for h in held) > _HELD:
                    held = [merged()]
                    if len(held[0][0]) > _HELD // 2:
                        yield _gram_batch(held.pop(), list(names))
        if held:
            yield _gram_batch(merged(), list(names))

    return run


def _gram_batch(counted: tuple, names: list[str]) -> pa.RecordBatch:
    lang, code, n = counted
    labels = pa.array(names, pa.string()).take(pa.array(lang, pa.int64()))
    return pa.RecordBatch.from_arrays([labels, pa.array(code), pa.array(n)], ["lang", "gram", "n"])


def profiles(train: DataFrame, lang_col: str = "lang", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """lang, gram, place: the profile of each language, places from 0."""
    labelled = train.where(F.col(lang_col).isNotNull()).select(lang_col, text_col)
    counted = labelled.mapInArrow(_count_grams(lang_col, text_col), "lang string, gram long, n long")
    total = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A filter on row_number is a limit per language before the shuffle, too.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = total.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < depth)
    return ranked.select("lang", "gram", "place")


def _collected(found: DataFrame, depth: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    rows = found.limit(MAX_LANGUAGES * depth + 1).toPandas()
    if len(rows) > MAX_LANGUAGES * depth:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out = {}
    for lang, part in sorted(rows.groupby("lang"), key=lambda item: item[0]):
        part = part.sort_values("gram")
        out[lang] = part["gram"].to_numpy(np.int64), part["place"].to_numpy(np.int64)
    return out


def _distances(grams: Grams, known: dict, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: distance to each language, and the number of n-grams compared."""
    chosen, rank = grams.top(depth)
    code, owner = grams.code(chosen), grams.document[chosen]
    sizes = np.bincount(owner, minlength=grams.documents)
    out = np.empty((len(known), grams.documents))
    for row, (codes, places) in enumerate(known.values()):
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        apart = np.where(codes[at] == code, np.abs(places[at] - rank), depth)
        out[row] = np.bincount(owner, weights=apart, minlength=grams.documents)
    return out, sizes


def predict(
    docs: DataFrame, learned: DataFrame, columns: list[str], text_col: str = "text", depth: int = DEPTH
) -> DataFrame:
    """``columns``, lang_pred, score for every row, from the text alone.

    Columns of the input named like the two results are left out.
    """
    known = _collected(learned, depth)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    columns = [c for c in columns if c not in ("lang_pred", "score")]
    needed = docs.select(*dict.fromkeys([*columns, text_col]))
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*(needed.schema[c] for c in columns), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known, UNDETERMINED], dtype=object)
        for batch in batches:
            for part, data, offsets in pieces(batch, text_col, _PIECE):
                grams = Grams(data, offsets)
                n = part.num_rows
                best, score = np.full(n, len(known)), np.zeros(n)
                if known and len(grams.count):
                    apart, sizes = _distances(grams, known, depth)
                    some = sizes > 0
                    nearest = apart.argmin(axis=0)
                    best[some] = nearest[some]
                    smallest = apart[nearest, np.arange(n)]
                    score[some] = 1 - smallest[some] / (depth * sizes[some])
                kept = [part.column(c) for c in columns]
                found = [pa.array(names[best], pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays([*kept, *found], schema.fieldNames())

    return needed.mapInArrow(run, schema)


def fold(id_col: str, folds: int):
    """The fold of a row: checksum of its id as text; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5
) -> DataFrame:
    """Learn from all folds but the first, predict every row: id, held_out, lang_pred, score."""
    learned = profiles(docs.where(fold(id_col, folds) != 0), lang_col, text_col)
    found = predict(docs, learned, [id_col], text_col)
    held_out = F.coalesce(fold(id_col, folds) == 0, F.lit(False))
    return found.select(id_col, held_out.alias("held_out"), "lang_pred", "score")


def keep_identified(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_score: float = MIN_SCORE
) -> DataFrame:
    """The rows whose text is in some learned language, unchanged; rejected are texts
    without letters and texts whose n-grams are hardly those of any language."""
    learned = profiles(docs, lang_col, text_col)
    own = {c: f"own_{c}" for c in docs.columns}
    found = predict(docs.toDF(*own.values()), learned, list(own.values()), own[text_col])
    kept = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
    return kept.select(*[F.col(o).alias(c) for c, o in own.items()])
