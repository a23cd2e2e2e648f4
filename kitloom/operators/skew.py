"""Joins that a hot key can't hold up, and broadcasts whose size is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

HOT_ROWS = 1_000_000
SALTS = 64
SMALL_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """df written once and counted; marked for broadcast only if it has at most so many rows, else left to the planner."""
    held = cut_lineage(df)
    return F.broadcast(held) if held.count() <= most else held


def salted_join(big: DataFrame, small: DataFrame, key: str, *, weight: str, spread: Column, hot_rows: int = HOT_ROWS, salts: int = SALTS) -> DataFrame:
    """Inner join of big with small, whose keys are unique and whose weight says how many rows of big have each.

    A key of more than hot_rows rows is split into salts by spread, which must tell rows of big apart and be the same on
    every run; there are at most (rows of big / hot_rows) such keys, so their list is small.
    """
    hot = cut_lineage(small.filter(F.col(weight) > hot_rows).select(key, F.lit(True).alias("__hot")))
    n_hot = hot.count()
    if not n_hot:
        return big.join(small, key)
    marked = big.join(F.broadcast(hot) if n_hot <= SMALL_ROWS else hot, key, "left")
    salted = marked.withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(0)).drop("__hot")
    copies = small.withColumn("__salt", F.explode(F.when(F.col(weight) > hot_rows, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return salted.join(copies, [key, "__salt"]).drop("__salt")
