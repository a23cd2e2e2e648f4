"""Share of repeated content inside each document.

A word is repeated if it belongs to a run of `run` consecutive words that already began earlier in the document (the runs
may overlap). Words of digits only are left out before runs are formed. A comparison of histograms with a language
reference (`divergence.py`) cannot tell which words are repeats, so the share is counted exactly from the runs themselves.

Defined cases: null and empty texts have 0 words and share 0.0; texts shorter than a run have share 0.0; repeated
documents get a row each; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import words

RUN = 6
MIN_WORDS = 30
MIN_SHARE = 0.5


def repeated_words(found: list[str], run: int = RUN) -> int:
    """How many of the words lie in a run that began before."""
    seen: set[tuple[str, ...]] = set()
    covered_to = total = 0
    for i, gram in enumerate(zip(*(found[k:] for k in range(run)), strict=False)):
        if gram in seen:
            total += i + run - max(i, covered_to)
            covered_to = i + run
        else:
            seen.add(gram)
    return total


def repetition_share(df: DataFrame, *, key: str = "doc_id", text: str = "text", run: int = RUN) -> DataFrame:
    """(key, n_words, n_repeated, share) of every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_repeated = [], []
            for value in batch.column(1).to_pylist():
                found = [w for w in words(value or "") if not w.isdigit()]
                n_words.append(len(found))
                n_repeated.append(repeated_words(found, run))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_repeated, pa.int64())], names=["key", "n_words", "n_repeated"])

    kind = df.schema[key].dataType.simpleString()
    counted = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(measure, f"key {kind}, n_words bigint, n_repeated bigint")
    share = F.when(F.col("n_words") > 0, F.col("n_repeated") / F.col("n_words")).otherwise(F.lit(0.0))
    return counted.select(F.col("key").alias(key), "n_words", "n_repeated", share.alias("share"))


def self_repeating(df: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, min_share: float = MIN_SHARE) -> DataFrame:
    return repetition_share(df, key=key, text=text).filter((F.col("n_words") >= min_words) & (F.col("n_repeated") >= F.lit(min_share) * F.col("n_words")))
