"""Matching that fails closed: a match counts only if it is the only one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def unique_match(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """left with the value of the only right row group that owns its keys, and a reason: matched, ambiguous, missing.

    The right side is reduced to one row per key before the join, so a hot key of it costs no more than another.
    """
    owners = right.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias(value), (F.min(value) != F.max(value)).alias("__many"))
    joined = left.join(owners, keys, "left")
    reason = F.when(F.col("__many").isNull(), "missing").when(F.col("__many"), "ambiguous").otherwise("matched")
    return joined.withColumn("reason", reason).withColumn(value, F.when(~F.col("__many"), F.col(value))).drop("__many")


#: A term that more than a share of the right ids has is common; the shares that are tried one after the other.
COMMON_SHARES, COMMON_LEAST = (0.02, 0.1), 20


def top_overlaps(left: DataFrame, right: DataFrame, *, left_id: str, right_id: str, term: str = "term", k: int = 1, shares: tuple[float, ...] = COMMON_SHARES, least: int = COMMON_LEAST) -> DataFrame:
    """(left_id, right_id, overlap): all pairs that can be among the k that share most terms, with their exact overlap.

    Inputs (id, term) are distinct. Pairs are formed through rare terms only. A right id that shares no rare term with a left
    id shares at most its common terms; so where the k-th best by rare terms has more, the pairs at hand are all that count,
    and only those that could still reach it are compared in their common terms. Left ids for which that doesn't hold are
    tried again with more terms counted as rare, the last of them with all.
    """
    other = cut_lineage(right.select(right_id, term))
    uses = other.groupBy(term).agg(F.count("*").alias("__df"))
    asked = cut_lineage(left.select(left_id, term).join(uses, term))
    n = other.select(F.count_distinct(right_id)).first()[0]
    out = None
    for share in (*shares, None):
        if share is None:
            part = asked.join(other, term).groupBy(left_id, right_id).agg(F.count("*").alias("overlap"))
            return part if out is None else out.unionByName(part)
        common = F.col("__df") > max(float(least), share * n)
        rare = cut_lineage(asked.filter(~common).join(other, term).groupBy(left_id, right_id).agg(F.count("*").alias("__rare")))
        rank = F.row_number().over(Window.partitionBy(left_id).orderBy(F.desc("__rare")))
        kth = rare.withColumn("__r", rank).filter(F.col("__r") == k).select(left_id, F.col("__rare").alias("__kth"))
        most = asked.groupBy(left_id).agg(F.count_if(common).alias("__most"))
        decided = cut_lineage(most.join(kth, left_id).filter("__kth > __most"))
        hopeful = rare.join(decided, left_id).filter(F.col("__rare") + F.col("__most") >= F.col("__kth")).select(left_id, right_id, "__rare")
        # a pair's common terms: the left id's are few, the right id is asked for each of them
        more = hopeful.join(asked.filter(common).select(left_id, term), left_id).join(other, [right_id, term]).groupBy(left_id, right_id).agg(F.count("*").alias("__more"))
        part = hopeful.join(more, [left_id, right_id], "left").select(left_id, right_id, (F.col("__rare") + F.coalesce("__more", F.lit(0))).alias("overlap"))
        out = part if out is None else out.unionByName(part)
        asked = cut_lineage(asked.join(decided.select(left_id), left_id, "left_anti"))
        if asked.isEmpty():
            return out
    return out


def max_overlap(left: DataFrame, right: DataFrame, *, left_id: str, right_id: str, term: str = "term") -> DataFrame:
    """Per left id the right id that shares most terms if it is the only such; inputs (id, term) distinct."""
    shared = top_overlaps(left, right, left_id=left_id, right_id=right_id, term=term)
    best = shared.groupBy(left_id).agg(F.max("overlap").alias("overlap"))
    ties = shared.join(best, [left_id, "overlap"]).groupBy(left_id, "overlap").agg(F.min(right_id).alias(right_id), F.count("*").alias("ties"))
    return ties.select(left_id, F.when(F.col("ties") == 1, F.col(right_id)).alias(right_id), "overlap", "ties")


def prefix_matches(heads: DataFrame, wholes: DataFrame, *, head: str, whole: str, shortest: int = 4, longer: tuple[int, ...] = (12, 32, 96)) -> DataFrame:
    """Heads that are a strict prefix of some whole text, with the smallest such text.

    In order of their bytes, the texts that a head begins follow it at once, so the next whole text decides; no pairs are
    formed. The order is looked at in blocks of texts with the same first signs: inside the blocks of most signs first, then
    from block to block among those that share fewer signs, so that a common beginning is no task of its own.
    """
    a = heads.select(F.col(head).alias("t"), F.lit(True).alias("h"), F.lit(False).alias("w"))
    b = wholes.select(F.col(whole).alias("t"), F.lit(False).alias("h"), F.lit(True).alias("w"))
    texts = a.unionByName(b).filter(F.length("t") >= shortest).groupBy("t").agg(F.bool_or("h").alias("h"), F.bool_or("w").alias("w"))
    sizes = sorted((shortest, *(n for n in longer if n > shortest)))
    blocks = texts.select("*", *[F.left("t", F.lit(n)).alias(f"b{n}") for n in sizes])
    following = lambda size, by: Window.partitionBy(f"b{size}").orderBy(by).rowsBetween(1, Window.unboundedFollowing)
    found = blocks.withColumn("whole", F.first(F.when(F.col("w"), F.col("t")), ignorenulls=True).over(following(sizes[-1], "t")))
    # the first whole text of each finer block, and of the next finer block that has one
    for coarse, fine in reversed(list(zip(sizes, sizes[1:], strict=False))):
        first = blocks.groupBy(f"b{fine}").agg(F.min(F.when(F.col("w"), F.col("t"))).alias("first"), F.first(f"b{coarse}").alias(f"b{coarse}"))
        after = first.withColumn("later", F.first("first", ignorenulls=True).over(following(coarse, f"b{fine}"))).select(f"b{fine}", "later")
        asked = found.filter(F.col("h") & F.col("whole").isNull())
        found = found.filter("whole is not null").unionByName(asked.join(after, f"b{fine}", "left").withColumn("whole", F.col("later")).drop("later"))
    return found.filter(F.col("h") & F.startswith("whole", F.col("t"))).select(F.col("t").alias("head"), "whole")


def points_in_boxes(points: DataFrame, boxes: DataFrame, keys: list[str], *, cell: float, half_open: bool = False) -> DataFrame:
    """Pairs of points (x, y) and boxes (x0, y0, x1, y1) that contain them, by equi-join on grid cells of the keys.

    A box lies on the grid whose cells are as wide as it is, of those that grow by fours from `cell`, so that it covers four
    cells at most whatever its size; points meet the grids that boxes lie on.
    """
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(cell))
    sized = boxes.filter("x0 <= x1 and y0 <= y1").withColumn("__level", F.ceil(F.log2(size / cell) / 2 - 1e-9).cast("int"))
    # at most one level for each power of four between a cell and the largest number
    levels = sorted(r[0] for r in sized.select("__level").distinct().collect() if r[0] is not None)
    width = F.lit(cell) * F.pow(F.lit(4.0), F.col("__level"))
    at = lambda c: F.floor(F.col(c) / width).cast("long")
    tiled = sized.withColumn("__cx", F.explode(F.sequence(at("x0"), at("x1")))).withColumn("__cy", F.explode(F.sequence(at("y0"), at("y1"))))
    placed = points.filter("x is not null and y is not null").withColumn("__level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("__cx", at("x")).withColumn("__cy", at("y"))
    inside = "x >= x0 and y >= y0 and " + ("x < x1 and y < y1" if half_open else "x <= x1 and y <= y1")
    return placed.join(tiled, [*keys, "__level", "__cx", "__cy"]).filter(inside).drop("__level", "__cx", "__cy")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], *, left_id: str, right_id: str, radius: float) -> DataFrame:
    """Per left row (x, y) the nearest right row within radius, ties to the smaller id; cells are as wide as the radius."""
    a = left.select(*keys, left_id, F.col("x").alias("ax"), F.col("y").alias("ay")).withColumn("__cx", F.floor(F.col("ax") / radius).cast("long")).withColumn("__cy", F.floor(F.col("ay") / radius).cast("long"))
    around = F.array(*[F.lit(k).cast("long") for k in (-1, 0, 1)])
    b = right.select(*keys, right_id, F.col("x").alias("bx"), F.col("y").alias("by"))
    b = b.withColumn("__cx", F.explode(F.transform(around, lambda k: F.floor(F.col("bx") / radius).cast("long") + k))).withColumn("__cy", F.explode(F.transform(around, lambda k: F.floor(F.col("by") / radius).cast("long") + k)))
    d2 = (F.col("ax") - F.col("bx")) * (F.col("ax") - F.col("bx")) + (F.col("ay") - F.col("by")) * (F.col("ay") - F.col("by"))
    pairs = a.join(b, [*keys, "__cx", "__cy"]).withColumn("d2", d2).filter(F.col("d2") <= radius * radius)
    return pairs.groupBy(*keys, left_id).agg(F.min(F.struct("d2", right_id)).alias("m")).select(*keys, left_id, F.col(f"m.{right_id}").alias(right_id), F.col("m.d2").alias("d2"))


def mutual_pairs(pairs: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Pairs whose both ends occur in no other pair."""
    single = lambda c: pairs.groupBy(c).agg(F.count("*").alias("n")).filter("n = 1").select(c)
    return pairs.join(single(left_id), left_id, "left_semi").join(single(right_id), right_id, "left_semi")


def joined_schedule(marks: DataFrame, rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Marks with the label of their schedule row and a note: table, conflict, no row, no table (of that first key)."""
    index = rows.groupBy(*keys).agg(F.min(label).alias(label), F.count_distinct(label).alias("__labels"))
    tables = rows.select(keys[0]).distinct().withColumn("__table", F.lit(True))
    out = marks.join(index, keys, "left").join(tables, keys[0], "left")
    note = F.when(F.col("__labels") == 1, "table").when(F.col("__labels") > 1, "conflict").when(F.col("__table"), "no row").otherwise("no table")
    return out.withColumn("note", note).withColumn(label, F.when(F.col("__labels") == 1, F.col(label))).drop("__labels", "__table")


def any_key_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, conditions: list[tuple[str, str]]) -> DataFrame:
    """A join on any of several key pairs as a union of equi-joins: missing, resolved or ambiguous.

    Each key's right rows are reduced to their smallest and largest id before the join.
    """
    hits = None
    for a, b in conditions:
        owners = right.filter(F.col(b).isNotNull()).groupBy(F.col(b).alias("__k")).agg(F.min(right_id).alias("__low"), F.max(right_id).alias("__high"))
        part = left.filter(F.col(a).isNotNull()).select(left_id, F.col(a).alias("__k")).join(owners, "__k").select(left_id, "__low", "__high")
        hits = part if hits is None else hits.unionByName(part)
    found = hits.groupBy(left_id).agg(F.min("__low").alias("__low"), F.max("__high").alias("__high"))
    status = F.when(F.col("__low").isNull(), "missing").when(F.col("__low") == F.col("__high"), "resolved").otherwise("ambiguous")
    joined = left.join(found, left_id, "left").withColumn("status", status)
    return joined.withColumn(right_id, F.when(F.col("status") == "resolved", F.col("__low"))).drop("__low", "__high")


def zipped(left: DataFrame, right: DataFrame, keys: list[str], left_order: str, right_order: str) -> DataFrame:
    """Positional join: the n-th left row of a key with its n-th right row."""
    a = left.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(left_order)))
    b = right.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(right_order)))
    return a.join(b, [*keys, "__n"]).withColumnRenamed("__n", "place")


def greedy_claims(left: DataFrame, right: DataFrame, keys: list[str], *, left_id: str, right_id: str, value: str, radius: float, tie: float = 0.2) -> DataFrame:
    """Each left row in order takes the nearest right row that none before took; near ties of other value are ambiguous, and
    a left row with none left is missing. Ids of left are unique.

    The candidates are found by cells; only the claims of one key's rows are folded in order, as sorted partitions stream by.
    """
    import pandas as pd

    a = left.select(*keys, left_id, F.col("x").alias("ax"), F.col("y").alias("ay")).withColumn("__cx", F.floor(F.col("ax") / radius).cast("long")).withColumn("__cy", F.floor(F.col("ay") / radius).cast("long"))
    around = F.array(*[F.lit(k).cast("long") for k in (-1, 0, 1)])
    b = right.select(*keys, right_id, value, F.col("x").alias("bx"), F.col("y").alias("by"))
    b = b.withColumn("__cx", F.explode(F.transform(around, lambda k: F.floor(F.col("bx") / radius).cast("long") + k))).withColumn("__cy", F.explode(F.transform(around, lambda k: F.floor(F.col("by") / radius).cast("long") + k)))
    distance = F.sqrt((F.col("ax") - F.col("bx")) * (F.col("ax") - F.col("bx")) + (F.col("ay") - F.col("by")) * (F.col("ay") - F.col("by")))
    pairs = a.join(b, [*keys, "__cx", "__cy"]).withColumn("distance", distance).filter(F.col("distance") <= radius).select(*keys, left_id, right_id, F.col(value).cast("string").alias("value"), "distance")

    def fold(frames):  # noqa: ANN001, ANN202
        key, mark, taken, options = None, None, set(), []

        def decide():  # noqa: ANN202
            free = [o for o in options if o[1] not in taken]
            if not free:
                return (*key, mark, None, None, "missing")
            best = free[0]
            if any(o[0] - best[0] <= tie and o[2] != best[2] for o in free[1:]):
                return (*key, mark, None, None, "ambiguous")
            taken.add(best[1])
            return (*key, mark, best[1], best[2], "read")

        columns = [*keys, left_id, right_id, "value", "status"]
        for frame in frames:
            out = []
            for row in frame[[*keys, left_id, right_id, "value", "distance"]].itertuples(index=False):
                own, m = tuple(row[: len(keys)]), row[len(keys)]
                if (own, m) != (key, mark):
                    if mark is not None:
                        out.append(decide())
                    if own != key:
                        taken = set()
                    key, mark, options = own, m, []
                options.append((row[-1], row[-3], row[-2]))
            yield pd.DataFrame(out, columns=columns)
        if mark is not None:
            yield pd.DataFrame([decide()], columns=columns)

    kinds = ", ".join(f"{k} {left.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, {left_id} {left.schema[left_id].dataType.simpleString()}, {right_id} {right.schema[right_id].dataType.simpleString()}, value string, status string"
    claims = pairs.repartition(*keys).sortWithinPartitions(*keys, left_id, "distance", right_id).mapInPandas(fold, schema)
    # rows with nothing near
    every = left.select(*keys, left_id).join(claims.drop(*keys), left_id, "left").withColumn("status", F.coalesce("status", F.lit("missing")))
    return every.select(*keys, left_id, right_id, "value", "status")
