"""Counts of character pairs over all texts, the training data of the character models.

Tokens that look garbled are left out of the counts, so that the pairs describe clean text: a token with an unusual
character counts only if most of its letters are plain ones. All rows are counted. The alphabet is fixed: the characters
of the single-byte encodings that Cyrillic text is read in, and one sign for all others of each general category. So there
are some 400 signs and at most their square of pairs, however large the corpus is; that many numbers are collected.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands for the start and the end of a text, and for a left-out token.
EDGE, GAP = "\x02", "\x03"
# The encodings whose characters have signs of their own.
CODE_PAGES = ("cp1251", "cp1252", "latin-1", "koi8_r", "cp866", "mac_cyrillic", "iso8859_5")
#: The first of the signs that stand for all other characters of a general category.
OTHERS = 0xE000

# What plain text of the project is made of, and the characters that only change its looks.
PLAIN_CLASS = "А-Яа-яЁё0-9 !-/:-@\\[-`{-~№²³Ø×«»–"
ORDINARY = re.compile(f"[A-Za-z{PLAIN_CLASS}]*")
PLAIN_LETTER = re.compile("[A-Za-zА-Яа-яЁё]")
LOOKS_ONLY = r"\u00a0\u00ad\u034f\u180e\u2000-\u200f\u2010-\u2012\u2028-\u202f\u205f-\u2064\u2212\u3000\ufeff\u0300-\u036f\u0391-\u03c9\uff01-\uff5e\U0001d400-\U0001d7ff"
USUAL_TOKEN = re.compile(f"[A-Za-z{PLAIN_CLASS}{LOOKS_ONLY}]*")
LATIN_LETTERS = re.compile("[À-ÖÙ-öø-ÿ]")
USUAL_WITH_LATIN = re.compile(f"[A-Za-z{PLAIN_CLASS}{LOOKS_ONLY}À-ÖÙ-öø-ÿ]*")
LETTERS = re.compile(r"[^\W\d_]")
QUESTION = re.compile(r"[^\W\d_]{2,}\?")


@cache
def signs() -> np.ndarray:
    """By code point the sign that stands for it: itself for characters of the alphabet, else its category's."""
    own = {chr(k) for k in range(0x100)} | {"\ufffd"}
    for page in CODE_PAGES:
        own |= set(bytes(range(256)).decode(page, "ignore"))
    kinds: dict[str, int] = {}
    out = np.arange(sys.maxunicode + 1, dtype=np.int32)
    for k in range(0x100, sys.maxunicode + 1):
        c = chr(k)
        if c not in own:
            out[k] = kinds.setdefault(unicodedata.category(c), OTHERS + len(kinds))
    return out


def clean_token(token: str) -> bool:
    """Whether a token may teach the clean model."""
    if "?" in token and not QUESTION.fullmatch(token):
        return False
    if USUAL_TOKEN.fullmatch(token):
        return bool(LETTERS.search(token)) or bool(re.search(r"[0-9!-/]", token)) or token == ""
    if USUAL_WITH_LATIN.fullmatch(token):
        return 2 * len(PLAIN_LETTER.findall(token)) >= len(LETTERS.findall(token)) > 0
    return False


def clean_part(text: str) -> str:
    """The text with every token that must not teach the model replaced by a gap."""
    if "?" not in text and ORDINARY.fullmatch(text):
        return text
    return " ".join(t if clean_token(t) else GAP for t in text.split(" "))


def count_pairs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signs before and after, and how often the pair occurs; every text starts and ends with EDGE."""
    joined = EDGE + EDGE.join(map(clean_part, texts)) + EDGE
    codes = signs()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].astype(np.int64)
    there = np.flatnonzero(np.bincount(codes, minlength=0x10000))
    index = np.zeros(0x10000, dtype=np.int64)
    index[there] = np.arange(len(there))
    small = index[codes]
    counts = np.bincount(small[:-1] * len(there) + small[1:], minlength=len(there) ** 2)
    pairs = np.flatnonzero(counts)
    return there[pairs // len(there)], there[pairs % len(there)], counts[pairs]


def pair_counts(texts: DataFrame, *, text: str = "text") -> list[tuple[int, int, int]]:
    """(before, after, n) over all rows, as signs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        size = 0

        def flush() -> pa.RecordBatch:
            a, b, n = count_pairs(held)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(n, pa.int64())], names=["a", "b", "n"])

        for batch in batches:
            for value in batch.column(0).to_pylist():
                held.append(value)
                size += len(value)
            if size > 4_000_000:
                yield flush()
                held.clear()
                size = 0
        if held:
            yield flush()

    rows = texts.select(F.col(text).alias("text")).filter("text is not null and text <> ''").mapInArrow(count, "a int, b int, n bigint")
    return sorted((r["a"], r["b"], r["n"]) for r in rows.groupBy("a", "b").agg(F.sum("n").alias("n")).collect())
