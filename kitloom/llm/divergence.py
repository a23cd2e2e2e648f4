"""How far a document's characters and words are from those of its language, by Jensen-Shannon distance.

Reference histograms are counted over all documents of a language: of character classes, and of the most common words with
one bin for all others. A document's distances to both are between 0 (equal) and 1 (nothing in common). A document of few
words is far from any reference, so documents below a least number of words are not judged, and the others are compared
with those of about their length: unusual is a word distance above the median of its language and length by a number of
median deviations.

Pages that repeat themselves use few words and stand out by this distance, but a histogram can't tell which words are
repeats; the required share is counted in `repetition.py`, and the README has the measured recall of this operator beside it.

Defined cases: null and empty texts have 0 words, no distances and are not judged; a document without a language, or of one
beyond the LANGUAGES largest, is compared with all documents; repeated documents get a row each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from math import log2, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .repetition import MIN_WORDS
from .words import words

COMMON_WORDS, LANGUAGES, DEVIATIONS = 2000, 64, 3.0
ALL, OTHER = "", "\x00"


def char_class(c: str) -> str:
    if "Ѐ" <= c <= "ԯ":
        return "Cyrillic capital" if c.isupper() else "Cyrillic"
    if c.isalpha():
        return "capital" if c.isupper() else "letter"
    return "digit" if c.isdigit() else "line" if c == "\n" else "space" if c.isspace() else "cell" if c == "|" else "sign"


def histograms(text: str) -> tuple[Counter[str], Counter[str]]:
    """Counts of character classes and of words."""
    classes: Counter[str] = Counter()
    for c, n in Counter(text).items():
        classes[char_class(c)] += n
    return classes, Counter(w for w in words(text) if not w.isdigit())


def distance(own: Mapping[str, int], reference: Mapping[str, float]) -> float | None:
    """Jensen-Shannon distance of counts from shares; what the reference doesn't know falls into its bin for others."""
    total = sum(own.values())
    if not total or not reference:
        return None
    bins: dict[str, float] = defaultdict(float)
    for item, n in own.items():
        bins[item if item in reference else OTHER] += n / total
    divergence, met = 0.0, 0.0
    for item, p in bins.items():
        q = reference.get(item, 0.0)
        met += q
        divergence += p * log2(2 * p / (p + q)) + (q * log2(2 * q / (p + q)) if q else 0.0)
    return sqrt(max(0.0, divergence + max(0.0, 1.0 - met)) / 2)


def references(documents: DataFrame, *, common_words: int = COMMON_WORDS, languages: int = LANGUAGES) -> dict[str, dict[str, dict[str, float]]]:
    """By language and for all: shares of classes and of common words; documents: lang, text.

    What is collected is bounded: (languages + 1) * (common_words + the classes).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[str, str, str]] = Counter()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(held.values(), pa.int64())], names=["lang", "kind", "item", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for kind, found in zip(("class", "word"), histograms(text), strict=True):
                    for item, n in found.items():
                        held[lang, kind, item] += n
            if len(held) > 200_000:
                yield flush()
                held.clear()
        if held:
            yield flush()

    rows = documents.select(F.coalesce("lang", F.lit(ALL)).alias("lang"), "text").filter("text is not null").mapInArrow(count, "lang string, kind string, item string, n bigint")
    counted = cut_lineage(rows.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))
    known = [r["lang"] for r in counted.filter(F.col("lang") != ALL).groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()]
    every = counted.groupBy("kind", "item").agg(F.sum("n").alias("n")).select(F.lit(ALL).alias("lang"), "kind", "item", "n")
    counted = counted.filter(F.col("lang").isin(known)).unionByName(every)
    totals = {(r["lang"], r["kind"]): r["n"] for r in counted.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    place = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item"))
    out: dict[str, dict[str, dict[str, float]]] = {lang: {"class": {}, "word": {}} for lang in [ALL, *known]}
    for r in counted.withColumn("place", place).filter(F.col("place") <= common_words).collect():
        out[r["lang"]][r["kind"]][r["item"]] = r["n"] / totals[r["lang"], r["kind"]]
    for kinds in out.values():
        kinds["word"][OTHER] = max(0.0, 1.0 - sum(kinds["word"].values()))
    return out


def divergence(df: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", min_words: int = MIN_WORDS, deviations: float = DEVIATIONS) -> DataFrame:
    """(key, n_words, class_distance, word_distance, unusual) of every row."""
    pages = df.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(references(pages.select("lang", "text")))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            langs, n_words, by_class, by_word = [], [], [], []
            for own, value in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                classes, found = histograms(value or "")
                langs.append(own if own in known else ALL)
                n_words.append(sum(found.values()))
                by_class.append(distance(classes, known[langs[-1]]["class"]))
                by_word.append(distance(found, known[langs[-1]]["word"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(n_words, pa.int64()), pa.array(by_class, pa.float64()), pa.array(by_word, pa.float64())], names=["key", "lang", "n_words", "class_distance", "word_distance"])

    kind = df.schema[key].dataType.simpleString()
    judged = cut_lineage(pages.mapInArrow(measure, f"key {kind}, lang string, n_words bigint, class_distance double, word_distance double"))
    size = F.when(F.col("n_words") >= min_words, F.floor(F.log2("n_words")).cast("int"))
    judged = judged.withColumn("size", size)
    asked = judged.filter("size is not null")
    middle = asked.groupBy("lang", "size").agg(F.percentile_approx("word_distance", 0.5, 10_000).alias("middle"))
    spread = asked.join(F.broadcast(middle), ["lang", "size"]).groupBy("lang", "size", "middle").agg(F.percentile_approx(F.abs(F.col("word_distance") - F.col("middle")), 0.5, 10_000).alias("spread"))
    # a row for each language and power of two of words: a few thousand at most
    out = judged.join(F.broadcast(spread), ["lang", "size"], "left")
    unusual = F.coalesce(F.col("word_distance") > F.col("middle") + F.lit(deviations) * F.greatest("spread", F.lit(1e-6)), F.lit(False))
    return out.select(F.col("key").alias(key), "n_words", "class_distance", "word_distance", unusual.alias("unusual"))
