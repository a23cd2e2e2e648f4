"""Mixing sources to target shares of the total size.

The mixture is to be as large as all documents of the listed sources; a source's budget is its share of that. Sources that
their caps on repeats keep below their share go in with all they may, and what they lack is shared by the others in
proportion to their targets, so the mixture has the size asked for as long as the caps allow it; the actual shares tell.

A source goes in whole as often as its budget allows. What is left of the budget is fitted by a subset sum: documents are
counted by exact token length, all of the rest but a last WINDOW_TOKENS is spread over the lengths in proportion, and a
bounded-knapsack dynamic program over that window finds the counts that come closest without exceeding the budget. Of each
length the counted number of documents is taken in a seeded order. Each source is fitted in an executor.

Defined cases: documents without a listed source and those of 0 tokens are not chosen; a listed source without documents
contributes 0; null shares and repeats count as 0; of several rows of a source the one of the greatest share counts; an
empty list or table gives an empty mixture; a share of 0 takes none.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import broadcast_if_small
from ..session import cut_lineage
from .tokens import token_counts

SEED = 20
WINDOW_TOKENS = 1 << 15
BANDS = 4096


@dataclass(frozen=True)
class Fit:
    whole: int
    extra: Mapping[int, int]
    tokens: int


def knapsack(counts: Mapping[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take for the largest sum of at most budget."""
    reach, layers = 1, []
    mask = (1 << (budget + 1)) - 1
    for length, most in sorted(counts.items(), reverse=True):
        most = min(most, budget // length) if length else 0
        if not most:
            continue
        before, take = reach, 1
        while most > 0:
            n = min(take, most)
            reach |= (reach << (n * length)) & mask
            most -= n
            take *= 2
        layers.append((length, min(counts[length], budget // length), before))
        if reach >> budget & 1:
            break
    left, taken = reach.bit_length() - 1, {}
    for length, most, before in reversed(layers):
        n = next(k for k in range(most + 1) if left >= k * length and before >> (left - k * length) & 1)
        if n:
            taken[length] = n
            left -= n * length
    return taken


def fit_budget(counts: Mapping[int, int], budget: int, max_repeats: int, window: int = WINDOW_TOKENS) -> Fit:
    """Whole copies of the source and, by length, the documents that get one more."""
    counts = {n: c for n, c in counts.items() if n > 0 and c > 0}
    size = sum(n * c for n, c in counts.items())
    if not size or budget <= 0 or max_repeats <= 0:
        return Fit(0, {}, 0)
    whole = min(max_repeats, budget // size)
    rest = budget - whole * size
    if whole == max_repeats or rest == 0:
        return Fit(whole, {}, whole * size)
    part = max(0, rest - window)
    bulk = {n: k for n, c in counts.items() if (k := c * part // size)}
    spread = sum(n * c for n, c in bulk.items())
    # rounding down leaves up to one document a length; whole documents go on, longest first, down to the window
    for n in sorted(counts, reverse=True):
        spare = min(counts[n] - bulk.get(n, 0), (rest - spread - window) // n)
        if spare <= 0:
            continue
        bulk[n] = bulk.get(n, 0) + spare
        spread += spare * n
    fine = knapsack({n: c - bulk.get(n, 0) for n, c in counts.items()}, rest - spread)
    extra = {n: bulk.get(n, 0) + fine.get(n, 0) for n in counts if bulk.get(n, 0) + fine.get(n, 0)}
    return Fit(whole, extra, whole * size + sum(n * c for n, c in extra.items()))


def budgets(targets: DataFrame, sizes: DataFrame, total: int) -> DataFrame:
    """(source, target_share, max_repeats, budget_tokens) of a mixture of total tokens; sizes: source, size.

    In the order of cap over share, a source is capped if its cap is no more than its part of what the sources before it
    leave. That is one row a source in one ordered window.
    """
    share, repeats = F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)), F.coalesce(F.col("max_repeats").cast("int"), F.lit(0))
    listed = targets.filter("source is not null").groupBy("source").agg(F.max(F.struct(share.alias("s"), repeats.alias("m"))).alias("t")).select("source", F.col("t.s").alias("share"), F.col("t.m").alias("max_repeats"))
    own = listed.join(sizes, "source", "left").withColumn("cap", F.when(F.col("share") > 0, F.coalesce("size", F.lit(0)) * F.col("max_repeats")).otherwise(0).cast("double"))
    order = Window.orderBy(F.when(F.col("share") > 0, F.col("cap") / F.col("share")).otherwise(0.0), "source")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.greatest(F.lit(float(total)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.lit(0.0))
    part = own.withColumn("part", F.when(F.col("share") > 0, F.col("share") / F.sum("share").over(after) * left).otherwise(0.0))
    part = part.withColumn("capped", F.col("cap") <= F.col("part"))
    # the first that is not capped has the price of all that are not
    price = F.when(~F.col("capped") & (F.col("share") > 0), F.col("part") / F.col("share"))
    whole = F.max(price).over(Window.partitionBy())
    budget = F.when(F.col("capped"), F.col("cap")).otherwise(F.least(F.col("cap"), F.floor(F.col("share") * whole + 1e-6)))
    return part.select("source", F.col("share").alias("target_share"), "max_repeats", budget.cast("bigint").alias("budget_tokens"))


def mix(documents: DataFrame, targets: DataFrame, *, key: str = "doc_id", seed: int = SEED, tokenizer: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The chosen documents (key, source, n_tokens, copies) and the shares (source, target_share, actual_share, ...)."""
    names = targets.select("source").filter("source is not null").distinct()
    sized = cut_lineage(token_counts(documents.join(names, "source", "left_semi"), key=key, keep=("source",), tokenizer=tokenizer))
    lengths = cut_lineage(sized.filter("n_tokens > 0").groupBy("source", "n_tokens").agg(F.count("*").alias("n")))
    sizes = lengths.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n")).alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    asked = cut_lineage(budgets(targets, sizes, total))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        head = frame.iloc[0]
        counts = dict(zip(frame["n_tokens"].tolist(), frame["n"].tolist(), strict=True))
        found = fit_budget(counts, int(head["budget_tokens"]), int(head["max_repeats"]))
        rows = [(head["source"], n, found.whole, found.extra.get(n, 0)) for n in counts if found.whole or n in found.extra]
        return pd.DataFrame(rows, columns=["source", "n_tokens", "whole", "extra"])

    # of a source one row for each length of its documents
    fits = cut_lineage(lengths.join(asked, "source").groupBy("source").applyInPandas(fit, "source string, n_tokens bigint, whole int, extra bigint"))
    planned = sized.join(broadcast_if_small(fits), ["source", "n_tokens"])
    # the seeded order is cut into bands, so that one length of one source is no single task
    banded = planned.withColumn("hash", F.xxhash64(F.lit(seed), key)).withColumn("band", F.pmod("hash", F.lit(BANDS)))
    counted = banded.groupBy("source", "n_tokens", "band").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("source", "n_tokens").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
    inside = Window.partitionBy("source", "n_tokens", "band").orderBy("hash", key)
    placed = banded.join(counted, ["source", "n_tokens", "band"]).withColumn("place", F.col("before") + F.row_number().over(inside))
    copies = F.col("whole") + F.when(F.col("place") <= F.col("extra"), 1).otherwise(0)
    chosen = placed.select(key, "source", "n_tokens", copies.cast("int").alias("copies")).filter("copies > 0")
    taken = lengths.join(fits, ["source", "n_tokens"]).groupBy("source").agg(F.sum(F.col("n_tokens") * (F.col("n") * F.col("whole") + F.col("extra"))).alias("tokens"))
    mixed = F.sum("tokens").over(Window.partitionBy())
    shares = asked.join(taken, "source", "left").fillna(0, ["tokens"]).withColumn("actual_share", F.when(mixed > 0, F.col("tokens") / mixed).otherwise(0.0))
    return chosen, shares.select("source", "target_share", "max_repeats", "budget_tokens", "tokens", "actual_share").orderBy("source")
