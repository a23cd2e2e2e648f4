"""Reconciliation of the same sheet read from several files.

variants: one row per sheet as one file shows it; bodies: the sheet's text of a variant. Everything is grouped by hash
keys; nulls of a key are groups of their own, never dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut_lineage
from .skew import broadcast_if_small

NO_CODE = "(без шифра)"
VECTOR_KINDS = ("DWG", "DXF")


def is_vector(kind: Column) -> Column:
    return F.coalesce(F.upper(F.trim(kind)).isin(*VECTOR_KINDS), F.lit(False))


def _stamp(field: str) -> Column:
    return F.trim(F.coalesce(F.col(f"stamp.{field}"), F.lit("")))


def placed(variants: DataFrame) -> DataFrame:
    """Variants with section, document, number ('' = unnumbered) and their place among the variants of a sheet."""
    code = _stamp("code")
    section = F.coalesce(F.nullif(T.section_of(code), F.lit("")), F.lit(NO_CODE))
    base = variants.select("variant_id", "source_name", "source_kind", "idx", "stamp", is_vector(F.col("source_kind")).alias("vector"), section.alias("section"), F.coalesce(F.nullif(code, F.lit("")), section).alias("document"), _stamp("sheet").alias("number"), (F.coalesce(T.is_text_part(code), F.lit(False))).alias("text_part"), ((code != "") | (_stamp("sheet") != "") | (_stamp("title") != "")).alias("found"))
    # unnumbered variants have no place; each is a partition of its own, however many there are
    lone = F.when(F.col("number") == "", F.col("variant_id"))
    order = Window.partitionBy("section", "document", "number", lone).orderBy(F.desc("vector"), F.desc("found"), F.asc_nulls_last("idx"), "variant_id")
    return base.withColumn("place", F.when(F.col("number") != "", F.row_number().over(order)))


def sheet_tree(variants: DataFrame) -> DataFrame:
    """One row per sheet: main variant, title of the first variant that has one, kinds that show it, number of variants."""
    p = placed(variants).filter("number <> ''")
    titled = F.when(_stamp("title") != "", F.struct("place", _stamp("title").alias("title")))
    return p.groupBy("section", "document", "number").agg(
        F.min_by("variant_id", "place").alias("main_id"), F.min(titled)["title"].alias("title"), F.array_join(F.sort_array(F.collect_set(F.upper(F.trim("source_kind")))), ",").alias("kinds"), F.count("*").alias("variants"), F.bool_or("text_part").alias("text_part")
    )


def unnumbered(variants: DataFrame) -> DataFrame:
    return placed(variants).filter("number = ''").groupBy("section", "document").agg(F.count("*").alias("variants"))


def section_heads(variants: DataFrame) -> DataFrame:
    """Object, organisation and stage of a section: the last drawing's value, else the first other one's."""
    p = placed(variants)
    out = []
    for f in ("object_name", "org", "stage"):
        value = F.nullif(_stamp(f), F.lit(""))
        drawing = F.max(F.when(F.col("vector") & value.isNotNull(), F.struct("variant_id", value.alias("v"))))["v"]
        other = F.min(F.when(~F.col("vector") & value.isNotNull(), F.struct("variant_id", value.alias("v"))))["v"]
        out.append(F.coalesce(drawing, other).alias(f))
    return p.groupBy("section").agg(*out)


def field_conflicts(variants: DataFrame) -> DataFrame:
    """Titles and stages in which other variants of a sheet contradict the main one."""
    p = placed(variants).filter("number <> ''")
    keys = ["section", "document", "number"]
    main = p.filter("place = 1").select(*keys, _stamp("title").alias("m_title"), _stamp("stage").alias("m_stage"))
    both = p.filter("place > 1").join(main, keys)
    checks = [F.when((F.col(f"m_{f}") != "") & (_stamp(f) != "") & (T.fold_title(F.col(f"m_{f}")) != T.fold_title(_stamp(f))), F.struct(F.lit(f).alias("field"), F.col(f"m_{f}").alias("left"), _stamp(f).alias("right"))) for f in ("title", "stage")]
    return both.select(*keys, "variant_id", F.explode(F.array_compact(F.array(*checks))).alias("c")).select(*keys, "variant_id", "c.*")


def duplicates(variants: DataFrame) -> DataFrame:
    return sheet_tree(variants).filter("variants >= 2").select("section", "document", "number", "variants", "kinds")


def skeleton_rows(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., skeleton, pos, line) of lines that can be compared: long and wordy enough, no service lines."""
    skip = F.col("line").rlike(r"^\s*(#{1,6}\s|\|[\s:|-]+\|\s*$|_[^_]*_\s*$|-{3,}\s*$|>\s)")
    bare = lines.filter(F.col("line").rlike("[0-9]") & ~skip).select(*keys, T.skeleton(F.col("line")).alias("skeleton"), "pos", "line")
    letters = F.length(F.regexp_replace("skeleton", f"[^{T.LETTERS}]", ""))
    return bare.filter((F.length("skeleton") >= 12) & F.col("skeleton").contains("#") & (letters >= 4))


def unique_skeletons(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Skeletons that occur exactly once under the keys, with the numbers of their line."""
    once = rows.groupBy(*keys, "skeleton").agg(F.count("*").alias("n"), F.min("pos").alias("pos"), F.first("line").alias("line")).filter("n = 1").drop("n")
    return once.withColumn("nums", F.array_join(T.numbers(F.col("line")), ";")).withColumn("line", F.trim("line"))


def number_conflicts(left: DataFrame, right: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """Lines equal in words but not in numbers, where the words occur once on each side; limit: first lines per key."""
    a = unique_skeletons(skeleton_rows(left, keys), keys)
    b = unique_skeletons(skeleton_rows(right, keys), keys).select(*keys, "skeleton", F.col("nums").alias("r_nums"), F.col("line").alias("r_line"))
    out = a.join(b, [*keys, "skeleton"]).filter("nums <> r_nums")
    if limit is not None:
        out = out.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))).filter(F.col("__n") <= limit).drop("__n")
    return out.select(*keys, F.replace("skeleton", F.lit("#"), F.lit("…")).alias("phrase"), F.col("line").alias("left"), F.col("r_line").alias("right"))


def token_sets(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Sizes of two token sets per key and of their intersection and differences; inputs (keys..., token) distinct."""
    both = left.select(*keys, "token", F.lit(1).alias("l")).join(right.select(*keys, "token", F.lit(1).alias("r")), [*keys, "token"], "full_outer")
    return both.groupBy(*keys).agg(F.count("l").alias("left"), F.count("r").alias("right"), F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("common"), F.count_if(F.col("r").isNull()).alias("left_only"), F.count_if(F.col("l").isNull()).alias("right_only"))


def union_lines(readings: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct lines of several readings (keys..., reading, pos, line) by their first occurrence."""
    key = T.fold(F.col("line"))
    first = F.row_number().over(Window.partitionBy(*keys, "__k").orderBy("reading", "pos"))
    return readings.withColumn("__k", key).filter("__k <> ''").withColumn("__n", first).filter("__n = 1").drop("__k", "__n")


def added_lines(base: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of extra that base lacks, headings left out."""
    k = T.fold(F.col("line"))
    return extra.filter(~F.trim("line").startswith("#")).withColumn("__k", k).filter("__k <> ''").join(base.select(*keys, k.alias("__k")).distinct(), [*keys, "__k"], "left_anti").drop("__k")


def fresh_lines(base: DataFrame, extra: DataFrame, keys: list[str], reread: float = 0.6) -> DataFrame:
    """Lines of extra with a token that base does not know, unless they are mostly one line of base misread.

    Set form: each line is judged against base alone, not against lines added before it.
    """
    base_tokens = base.select(*keys, F.col("pos").alias("b_pos"), F.explode(T.tokens(F.col("line"))).alias("token"))
    lined = extra.select(*keys, "pos", "line", T.tokens(F.col("line")).alias("ts")).filter(F.size("ts") > 0)
    each = lined.select(*keys, "pos", F.explode("ts").alias("token"))
    known = each.join(base_tokens.select(*keys, "token").distinct(), [*keys, "token"], "left_anti").filter(F.length("token") >= 3)
    overlap = each.join(base_tokens, [*keys, "token"]).groupBy(*keys, "pos", "b_pos").agg(F.count("*").alias("n")).groupBy(*keys, "pos").agg(F.max("n").alias("n"))
    fresh = lined.join(known.select(*keys, "pos").distinct(), [*keys, "pos"], "left_semi").join(overlap, [*keys, "pos"], "left")
    return fresh.filter(F.coalesce("n", F.lit(0)) < reread * F.size("ts")).select(*keys, "pos", "line")


def fused_lines(base: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of extra that add to base, in order: each accepted line makes its tokens known for the next ones.

    Order-dependent, so a page's lines stream by in order, those of base first, and are decided when the page ends.
    """
    import pyarrow as pa

    from . import folds

    n = len(keys)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page: tuple | None = None
        own: list[set[str]] = []
        added: dict[str, set[str]] = {}
        order: list[str] = []
        out: list[tuple] = []

        def decide() -> None:
            kept = folds.added_in_order(set().union(*own), order, added.__getitem__, own)
            out.extend((*page, k, line) for k, line in enumerate(kept))

        def written(schema: pa.Schema) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * (n + 2)
            kinds = [*(schema.field(k).type for k in range(n)), pa.int64(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[*keys, "ord", "line"])
            out.clear()
            return batch

        schema = None
        for batch in batches:
            schema = batch.schema
            for *where, side, line, tokens in zip(*(batch.column(k).to_pylist() for k in range(n + 3)), strict=True):
                if page != (at := tuple(where)):
                    if order:
                        decide()
                    page, own, added, order = at, [], {}, []
                if side:
                    added[line] = set(tokens)
                    order.append(line)
                else:
                    own.append(set(tokens))
            yield written(schema)
        if order:
            decide()
            yield written(schema)

    side = lambda df, k: df.select(*keys, F.lit(k).alias("side"), "pos", "line", F.coalesce(T.tokens(F.col("line")), F.array().cast("array<string>")).alias("tokens"))
    both = side(base, 0).unionByName(side(extra, 1)).repartition(*keys).sortWithinPartitions(*keys, "side", "pos")
    kinds = ", ".join(f"{k} {extra.schema[k].dataType.simpleString()}" for k in keys)
    return both.select(*keys, "side", "line", "tokens").mapInArrow(fold, f"{kinds}, ord long, line string")


def missing_texts(texts: DataFrame, known: DataFrame, keys: list[str], text: str = "text", shingle: int = 4, block: int = 6_000_000) -> DataFrame:
    """Distinct folded texts that stand in no known text of their key, not even inside one.

    Texts that equal a known one go first. What is left is held by key while the key's known texts stream by, so no text is
    cut into rows of pieces. A key whose texts have more than `block` signs is cut into blocks of both sides, of which each
    meets each of the other side; what is missing there is missing from every block of known texts.
    """
    import pyarrow as pa

    from . import folds

    n = len(keys)
    # a null in the key equals nothing, so known texts have no nulls there
    keyed = reduce(and_, (F.col(k).isNotNull() for k in keys))
    folded = lambda df, side: df.filter(F.col(text).isNotNull()).select(*keys, T.fold(F.col(text)).alias("t"), F.lit(side).alias("side")).filter("t <> ''")
    theirs = folded(known, 1).filter(keyed)
    left = cut_lineage(folded(texts, 0).unionByName(theirs).groupBy(*keys, "t").agg(F.max("side").alias("side")).filter("side = 0"))
    signs = lambda df, c, side: df.select(*keys, (F.length(c) * (1 - side)).alias("asked"), (F.length(c) * side).alias("known"))
    blocks = lambda c: F.ceil(F.sum(c) / block).cast("int").alias(c)
    hot = broadcast_if_small(signs(left.filter(keyed), "t", 0).unionByName(signs(known.filter(keyed), text, 1)).groupBy(*keys).agg(blocks("asked"), blocks("known")).filter("asked > 1 or known > 1"))
    count = lambda side: F.greatest(F.coalesce(F.col(side), F.lit(1)), F.lit(1))

    def cells(df: DataFrame, own: str, other: str) -> DataFrame:
        placed = df.join(hot, keys, "left").select(*keys, "t", "side", F.pmod(F.xxhash64("t"), count(own)).cast("int").alias(f"{own}_block"), F.sequence(F.lit(0), count(other) - 1).alias("others"))
        return placed.withColumn(f"{other}_block", F.explode("others")).select(*keys, "asked_block", "known_block", "side", "t")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: tuple | None = None
        asked: list[str] = []
        rest: folds.OpenTexts | None = None
        out: list[tuple] = []

        def written(schema: pa.Schema) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * (n + 1)
            kinds = [*(schema.field(k).type for k in range(n)), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[*keys, "t"])
            out.clear()
            return batch

        schema = None
        for batch in batches:
            schema = batch.schema
            for *where, side, t in zip(*(batch.column(k).to_pylist() for k in range(n + 4)), strict=True):
                if cell != (at := tuple(where)):
                    if cell is not None:
                        out.extend((*cell[:n], x) for x in (asked if rest is None else rest))
                    cell, asked, rest = at, [], None
                if not side:
                    asked.append(t)
                elif asked:
                    if rest is None:
                        rest = folds.OpenTexts(asked, shingle)
                    rest.meet(t)
            yield written(schema)
        if cell is not None:
            out.extend((*cell[:n], x) for x in (asked if rest is None else rest))
            yield written(schema)

    both = cells(left.filter(keyed), "asked", "known").unionByName(cells(theirs, "known", "asked")).repartition(*keys, "asked_block", "known_block").sortWithinPartitions(*keys, "asked_block", "known_block", "side")
    kinds = ", ".join(f"{k} {left.schema[k].dataType.simpleString()}" for k in keys)
    missing = both.mapInArrow(fold, f"{kinds}, t string").groupBy(*keys, "t").agg(F.count("*").alias("n"))
    everywhere = missing.join(hot, keys, "left").filter(F.col("n") == count("known"))
    return everywhere.select(*keys, "t").unionByName(left.filter(~keyed).select(*keys, "t")).withColumnRenamed("t", text)


def best_of(base: DataFrame, override: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Values of base with those of override in their place, and those only override has."""
    o = override.select(*keys, F.col(value).alias("__o"))
    return base.select(*keys, value).join(o, keys, "full_outer").select(*keys, F.coalesce("__o", value).alias(value))


def stacked(sources: list[tuple[str, DataFrame]], keys: list[str], value: str) -> DataFrame:
    """Values of several sources under each other, each with its name; missing ones are left out."""
    out = None
    for k, (name, df) in enumerate(sources):
        part = df.filter(F.col(value).isNotNull()).select(*keys, F.struct(F.lit(k).alias("k"), F.concat(F.lit(f"### {name}\n"), F.col(value)).alias("v")).alias("s"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["v"]), "\n\n").alias(value))
