"""Evaluation passages inside documents by Wu-Manber multi-pattern search over words.

A pattern is a run of `run` consecutive words of an evaluation item, so an item is contained in a document exactly if one
of its patterns occurs there. The search slides a window of `run` words over the document. A block of two words at the
window's end is looked up in a shift table, which tells how far the window can move without missing a pattern; only where
the shift is 0 the window's prefix and suffix together are looked up in a second table. What passes both is compared with
the patterns of its hash word by word.

Both tables are arrays over hashes whose size is bounded whatever the number of items is: hashes that meet take the
smaller shift, which is always safe, and cost comparisons, never a hit. They are built in the executors, part by part, and
only they are sent to the workers. The patterns stay a distributed table; the windows that pass are joined to it. So the
documents are read once and no item is brought to the driver.

Defined cases: null and empty texts contain nothing; an item of fewer than `run` words has no pattern; equal patterns of
several items give a row each; one row per document and item however often it occurs; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import HOT_ROWS, SMALL_ROWS, salted_join
from ..session import cut_lineage
from .words import joined_words

RUN = 12
BLOCK = 2
#: Entries of the tables for a pattern, the most they may have, and those of a part that one task builds.
ENTRIES_RATE, LEAST_ENTRIES, MOST_ENTRIES, PART = 16, 1 << 16, 1 << 26, 1 << 16
_ODD = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


@lru_cache(maxsize=1 << 18)
def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


def block_hash(first: str, second: str) -> int:
    return ((word_hash(first) * _ODD & _ALL) ^ word_hash(second)) * _ODD >> 20 & 0xFFFFFFFFFF


def end_hash(window: list[str]) -> int:
    """Prefix and suffix of a window together."""
    return (block_hash(window[0], window[1]) * _ODD + block_hash(window[-2], window[-1]) * 3 & _ALL) >> 16


class Tables:
    """Shift by block and a bit by prefix and suffix, both by hash modulo the number of entries."""

    def __init__(self, shift: np.ndarray, ends: np.ndarray, run: int = RUN) -> None:
        self.run, self.furthest = run, run - BLOCK + 1
        self.mask = len(shift) - 1
        self.shift, self.ends = shift.tobytes(), ends.tobytes()

    def windows(self, found: list[str]) -> list[str]:
        """The windows that may be patterns, once each."""
        shift, ends, mask, run, n, end = self.shift, self.ends, self.mask, self.run, len(found), self.run
        out: dict[str, None] = {}
        while end <= n:
            move = shift[block_hash(found[end - 2], found[end - 1]) & mask]
            if move:
                end += move
                continue
            window = found[end - run : end]
            if ends[end_hash(window) & mask]:
                out[" ".join(window)] = None
            end += 1
        return list(out)


def table_rows(found: list[str], run: int = RUN) -> tuple[dict[int, int], set[int]]:
    """Shifts by block hash, and hashes of prefix and suffix, of an item's patterns."""
    shifts: dict[int, int] = {}
    ends: set[int] = set()
    for start in range(len(found) - run + 1):
        pattern = found[start : start + run]
        ends.add(end_hash(pattern))
        for end in range(BLOCK, run + 1):
            block = block_hash(pattern[end - 2], pattern[end - 1])
            shifts[block] = min(shifts.get(block, run), run - end)
    return shifts, ends


def filled(furthest: int, entries: int, shifts: dict[int, int], ends: set[int]) -> tuple[np.ndarray, np.ndarray]:
    """The tables of a set of hashes."""
    shift, bits = np.full(entries, furthest, np.uint8), np.zeros(entries, np.uint8)
    if shifts:
        np.minimum.at(shift, np.fromiter(shifts, np.int64) & (entries - 1), np.fromiter(shifts.values(), np.uint8))
    bits[np.fromiter(ends, np.int64) & (entries - 1)] = 1
    return shift, bits


def search_tables(items: DataFrame, entries: int, run: int = RUN) -> Tables:
    """The tables of all patterns of items (item, text): built in parts of PART entries, collected at their fixed size."""
    furthest = run - BLOCK + 1

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shifts: dict[int, int] = {}
            ends: set[int] = set()
            for text in batch.column(0).to_pylist():
                own, tails = table_rows(joined_words(text), run)
                ends |= tails
                for block, move in own.items():
                    shifts[block] = min(shifts.get(block, run), move)
            at = np.concatenate([np.fromiter(shifts, np.int64, len(shifts)), np.fromiter(ends, np.int64, len(ends))]) & (entries - 1)
            move = np.concatenate([np.fromiter(shifts.values(), np.int32, len(shifts)), np.full(len(ends), -1, np.int32)])
            yield pa.RecordBatch.from_arrays([pa.array(at // PART, pa.int32()), pa.array(at % PART, pa.int32()), pa.array(move, pa.int32())], names=["part", "at", "move"])

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        shift, bits = np.full(PART, furthest, np.uint8), np.zeros(PART, np.uint8)
        moves = frame[frame["move"] >= 0]
        np.minimum.at(shift, moves["at"].to_numpy(), moves["move"].to_numpy().astype(np.uint8))
        bits[frame.loc[frame["move"] < 0, "at"].to_numpy()] = 1
        return pd.DataFrame({"part": [int(frame["part"].iloc[0])], "shift": [shift.tobytes()], "ends": [bits.tobytes()]})

    # equal entries meet before they are shuffled; a part then has at most two rows an entry and shift
    rows = items.select("text").mapInArrow(hashes, "part int, at int, move int").groupBy("part", "at", F.col("move") < 0).agg(F.min("move").alias("move")).select("part", "at", "move")
    shift, ends = np.full(entries, furthest, np.uint8), np.zeros(entries, np.uint8)
    for row in rows.groupBy("part").applyInPandas(build, "part int, shift binary, ends binary").collect():
        at = row["part"] * PART
        shift[at : at + PART] = np.frombuffer(bytes(row["shift"]), np.uint8)
        ends[at : at + PART] = np.frombuffer(bytes(row["ends"]), np.uint8)
    return Tables(shift, ends, run)


def pattern_rows(items: DataFrame, kind: str, run: int = RUN) -> DataFrame:
    """(pattern, items): every pattern with the items that have it."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, patterns = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                found = joined_words(text)
                each = {" ".join(found[s : s + run]) for s in range(len(found) - run + 1)}
                own += [k] * len(each)
                patterns += each
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own, pa.int64())), pa.array(patterns, pa.string())], names=["item", "pattern"])

    rows = items.select("item", "text").mapInArrow(split, f"item {kind}, pattern string")
    return rows.groupBy("pattern").agg(F.collect_set("item").alias("items"))


def leaked_items(documents: DataFrame, items: DataFrame, *, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", run: int = RUN, entries: int | None = None, small_rows: int = SMALL_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_key, item_key): the document contains at least `run` consecutive words of the item."""
    doc_kind, item_kind = documents.schema[doc_key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    pages = documents.select(F.col(doc_key).alias("doc"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    asked = items.select(F.col(item_key).alias("item"), F.col(text).alias("text")).filter("item is not null and text is not null")
    patterns = cut_lineage(pattern_rows(asked, item_kind, run))
    n = patterns.count()
    if entries is None:
        entries = LEAST_ENTRIES
        while entries < min(ENTRIES_RATE * n, MOST_ENTRIES):
            entries *= 2
    tables = documents.sparkSession.sparkContext.broadcast(search_tables(asked, entries, run))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = tables.value
        for batch in batches:
            docs, windows = [], []
            for k, value in enumerate(batch.column(1).to_pylist()):
                if found := search.windows(joined_words(value)):
                    docs += [k] * len(found)
                    windows += found
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs, pa.int64())), pa.array(windows, pa.string())], names=["doc", "pattern"])

    candidates = pages.mapInArrow(scan, f"doc {doc_kind}, pattern string")
    if n <= small_rows:
        hits = candidates.join(F.broadcast(patterns), "pattern")
    else:
        # a passage that very many documents have is split by document
        candidates = cut_lineage(candidates)
        counted = patterns.join(candidates.groupBy("pattern").agg(F.count("*").alias("n_docs")), "pattern")
        hits = salted_join(candidates, counted, "pattern", weight="n_docs", spread=F.col("doc"), hot_rows=hot_rows)
    return hits.select("doc", F.explode("items").alias("item")).distinct().select(F.col("doc").alias(doc_key), F.col("item").alias(item_key))
