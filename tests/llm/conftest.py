import re
import zlib

import pytest

ID_TEXT = "doc_id long, text string, lang string, source string, n_chars long"
SHAPE = f"{ID_TEXT}, own_text string, score double, members__ string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def fold(doc_id, folds):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


LONG = " ".join(f"word{i * i % 977}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
# Nulls, empty and very long texts, ties, repeated rows, and text that is no text.
ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n\r\x0b\x0c ", "en", None),
    (4, "The quick brown fox", "en", "a"),
    (5, "The  quick\nbrown fox", "en", "a"),
    (6, "The quick brown fox", "en", "b"),
    (6, "The quick brown fox", "en", "b"),
    (7, LONG, "en", "a"),
    (8, LONG + " tail", "en", "a"),
    (9, f"before {PASSAGE} after and more words here", "en", "a"),
    (10, f"other lead {PASSAGE} end", "fr", "c"),
    (11, "one", "en", "a"),
    (12, "one two", None, "a"),
    (13, "é É ß 漢字 漢字 ñandú \U0001f600 K", "fr", "c"),
    (14, "a a a a a a a a a a a a a a a a a a a a a a a a a a", "en", "a"),
    (15, "12 34 -- !!", "en", "a"),
    (None, "The quick brown fox", "en", "a"),
    (None, None, None, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, l, s, len(t or ""), "clash", 0.5, "x") for i, t, l, s in ODD]
    return spark.createDataFrame(rows, SHAPE).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)
