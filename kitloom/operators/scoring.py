"""Scores of texts, predictions and runs. An empty denominator gives null, so that averages skip it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .matching import top_overlaps


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def jaccard(a: Column, b: Column) -> Column:
    """100 * |a and b| / |a or b| of two arrays, null if both are empty."""
    return 100.0 * ratio(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


def recall(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct expected tokens and how many of them are in actual, per key."""
    hit = expected.distinct().join(actual.select(*keys, "token", F.lit(1).alias("hit")).distinct(), [*keys, "token"], "left")
    return hit.groupBy(*keys).agg(F.count("*").alias("expected"), F.count("hit").alias("hits")).withColumn("recall", F.col("hits") / F.col("expected"))


def prf(expected: DataFrame, actual: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """tp, fp, fn, precision, recall and F1 of two sets of keys, per group; two empty sets score 1."""
    both = expected.select(*by, *keys, F.lit(1).alias("e")).distinct().join(actual.select(*by, *keys, F.lit(1).alias("a")).distinct(), [*by, *keys], "full_outer")
    counts = both.groupBy(*by).agg(F.count_if(F.col("e").isNotNull() & F.col("a").isNotNull()).alias("tp"), F.count_if(F.col("e").isNull()).alias("fp"), F.count_if(F.col("a").isNull()).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision = F.when(tp + fp > 0, tp / (tp + fp)).when(fn == 0, 1.0).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).when(fp == 0, 1.0).otherwise(0.0)
    scored = counts.withColumn("precision", precision).withColumn("recall", rec)
    return scored.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0))


def duplicate_line_ratio(lines: DataFrame, keys: list[str], min_len: int = 12) -> DataFrame:
    """Share of content lines that occurred before; 0 where there is none."""
    key = F.trim(F.regexp_replace(F.trim("line"), r"[ \t\n\r\f]+", " "))
    eligible = (F.length(key) >= min_len) & ~key.rlike(r"^(---|\||```|#)")
    counts = lines.groupBy(*keys).agg(F.count_if(eligible).alias("total"), F.count_distinct(F.when(eligible, key)).alias("distinct_lines"))
    return counts.withColumn("ratio", F.coalesce(ratio(F.col("total") - F.col("distinct_lines"), F.col("total")), F.lit(0.0)))


def best_matches(candidates: DataFrame, queries: DataFrame, *, query: str, candidate: str, k: int = 5) -> DataFrame:
    """Per query the k candidates with the highest token recall; inputs (id, token) distinct, ties to the smaller id."""
    size = queries.groupBy(query).agg(F.count("*").alias("size"))
    hits = top_overlaps(queries, candidates, left_id=query, right_id=candidate, term="token", k=k).withColumnRenamed("overlap", "hits")
    rank = F.row_number().over(Window.partitionBy(query).orderBy(F.desc("hits"), candidate))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).join(size, query).select(query, candidate, "rank", "hits", ratio(F.col("hits"), F.col("size")).alias("recall"))


def unsupported(facts: DataFrame, layer: DataFrame, keys: list[str]) -> DataFrame:
    """Facts of each key, how many the layer lacks, and their share."""
    marked = facts.join(layer.select(*keys, "fact", F.lit(1).alias("in_layer")).distinct(), [*keys, "fact"], "left")
    return marked.groupBy(*keys).agg(F.count("*").alias("facts"), F.count_if(F.col("in_layer").isNull()).alias("missing")).withColumn("unsupported", F.col("missing") / F.col("facts"))


def checklist(texts: DataFrame, *, contains: list[str], absent: list[str], any_of: list[str], text: str = "text") -> Column:
    """A boolean: all of contains, none of absent, at least one of any_of (if given)."""
    c = F.col(text)
    out = F.lit(True)
    for s in contains:
        out = out & F.contains(c, F.lit(s))
    for s in absent:
        out = out & ~F.contains(c, F.lit(s))
    if any_of:
        some = F.lit(False)
        for s in any_of:
            some = some | F.contains(F.lower(c), F.lit(s.lower()))
        out = out & some
    return out
