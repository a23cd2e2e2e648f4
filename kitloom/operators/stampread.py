"""Reading the title block of a sheet from its captions (document_id, page, item_id, x, y, size, text).

Anchors are captions with a known word; a value is the nearest other caption below its anchor in a narrow column. All steps
are equi-joins on the sheet of a few anchors with its captions, reduced at once to one row per anchor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Folded captions that name a field of the block, and its sizes in units of its scale.
ANCHORS = ("изм", "колуч", "ндок", "nдок", "№док", "подп", "подпись", "дата", "стадия", "лист", "листов", "разраб", "проверил", "гип", "нконтр", "нконтроль")
CELL_HEIGHT, CELL_HALF, BLOCK_SPAN, BLOCK_WIDTH, BLOCK_HEIGHT = 12.0, 9.0, 35.0, 185.0, 55.0
SHEET = ["document_id", "page"]


def _below(anchors: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """Per anchor (a_id, ax, ay, scale) the text of the nearest caption below it."""
    dy = F.col("ay") - F.col("y")
    near = anchors.join(items.filter("anchor is null"), SHEET).filter((dy > 0) & (dy <= F.col("scale") * CELL_HEIGHT) & (F.abs(F.col("x") - F.col("ax")) <= F.col("scale") * CELL_HALF))
    return near.groupBy(*SHEET, "a_id").agg(F.min(F.struct(dy.alias("dy"), "item_id", "text"))["text"].alias(name))


def _anchor(items: DataFrame, word: str) -> DataFrame:
    return items.filter(F.col("anchor") == word).select(*SHEET, F.col("item_id").alias("a_id"), F.col("x").alias("ax"), F.col("y").alias("ay"), "size")


def read_stamps(captions: DataFrame) -> DataFrame:
    """(document_id, page, stage, sheet, sheets_total, code) of sheets with a stage anchor."""
    key = T.fold_caption(F.col("text"))
    items = captions.filter("text is not null and trim(text) <> '' and x is not null and y is not null").select(*SHEET, "item_id", "x", "y", F.coalesce("size", F.lit(1.0)).alias("size"), "text").withColumn("anchor", F.when(key.isin(*ANCHORS), key))
    stages, totals, sheets = (_anchor(items, w) for w in ("стадия", "листов", "лист"))
    right = totals.select(*SHEET, F.col("a_id").alias("t_id"), F.col("ax").alias("tx"), F.col("ay").alias("ty"))
    same_row = (F.col("tx") > F.col("ax")) & (F.abs(F.col("ty") - F.col("ay")) <= F.greatest("size", F.lit(1.0)) * 2)
    paired = stages.join(right, SHEET).filter(same_row).groupBy(*SHEET, "a_id").agg(F.min(F.struct("tx", "t_id", "ty")).alias("t"))
    span = F.col("t.tx") - F.col("ax")
    scaled = stages.join(paired, [*SHEET, "a_id"], "left").withColumn("scale", F.when(span > 1, span / BLOCK_SPAN).otherwise(1.0))
    filled = scaled.join(_below(scaled, items, "stage"), [*SHEET, "a_id"], "left")
    best = filled.groupBy(*SHEET).agg(F.max(F.struct(F.col("stage").isNotNull().alias("f"), (F.col("ax") - F.col("ay")).alias("corner"), (-F.col("a_id")).alias("o"), "a_id", "ax", "ay", "scale", "t", "stage")).alias("b")).select(*SHEET, "b.*")
    total = best.filter("t is not null").select(*SHEET, F.col("t.t_id").alias("a_id"), F.col("t.tx").alias("ax"), F.col("t.ty").alias("ay"), "scale")
    between = sheets.drop("size").join(best.select(*SHEET, F.col("ax").alias("sx"), F.col("ay").alias("sy"), "t", "scale"), SHEET).filter("t is not null and ax > sx and ax < t.tx")
    inner = between.groupBy(*SHEET).agg(F.min(F.struct(F.abs(F.col("ay") - F.col("sy")).alias("d"), "a_id", "ax", "ay", "scale")).alias("s")).select(*SHEET, "s.a_id", "s.ax", "s.ay", "s.scale")
    number = lambda df, name: _below(df, items, name).select(*SHEET, T.clean_number(F.col(name)).alias(name))
    dx, dy = F.col("x") - F.col("ax"), F.col("y") - F.col("ay")
    zone = (dx >= F.col("scale") * -BLOCK_WIDTH * 1.1) & (dx <= F.col("scale") * BLOCK_WIDTH * 0.6) & (F.abs(dy) <= F.col("scale") * BLOCK_HEIGHT)
    coded = items.filter(T.looks_like_code(F.col("text"))).join(best.select(*SHEET, "ax", "ay", "scale"), SHEET).filter(zone)
    code = coded.groupBy(*SHEET).agg(F.max(F.struct(F.round("size", 1).alias("s"), F.length("text").alias("l"), (-F.col("item_id")).alias("o"), F.trim("text").alias("code")))["code"].alias("code"))
    out = best.select(*SHEET, F.trim("stage").alias("stage"))
    for part in (number(inner, "sheet"), number(total, "sheets_total"), code):
        out = out.join(part, SHEET, "left")
    return out


def block_columns(rows: Column) -> Column:
    """Which columns of a grid (array of rows of cells) hold data: two values in a wide grid, else one."""
    width = F.array_max(F.transform(rows, F.size))
    need = F.when(width > 6, 2).otherwise(1)
    return F.filter(F.sequence(F.lit(0), width - 1), lambda i: F.size(F.filter(rows, lambda r: F.coalesce(F.trim(F.get(r, i)) != "", F.lit(False)))) >= need)


def trimmed_grid(rows: Column) -> Column:
    """A grid without sparse columns and blank rows."""
    keep = block_columns(rows)
    cut = F.transform(rows, lambda r: F.transform(keep, lambda i: F.coalesce(F.get(r, i), F.lit(""))))
    return F.filter(cut, lambda r: F.exists(r, lambda c: F.trim(c) != ""))


def stamp_start(rows: Column, words: tuple[str, ...], needed: int = 3) -> Column:
    """The first row of a grid's lower half from which on `needed` words of a title block occur, null if none."""
    joined = F.transform(rows, lambda r: F.lower(F.array_join(r, " ")))
    half = F.floor(F.size(rows) / 2).cast("int")

    def stands(word: str, lines: Column) -> Column:
        return F.exists(lines, lambda line: F.contains(line, F.lit(word))).cast("int")

    def words_from(i: Column) -> Column:
        rest = F.slice(joined, i + 1, F.greatest(F.size(rows) - i, F.lit(0)))
        return sum((stands(w, rest) for w in words), F.lit(0))

    starts = F.filter(F.sequence(half, F.greatest(F.size(rows) - 1, half)), lambda i: (i < F.size(rows)) & (words_from(i) >= needed))
    return F.array_min(starts)


def destacked(row: Column) -> Column:
    """A row whose filled cells stack the same number of tiers becomes that many rows."""
    tiers = F.transform(row, lambda c: F.split(c, "\n"))
    filled = F.filter(tiers, lambda t: F.exists(t, lambda x: F.trim(x) != ""))
    n = F.size(F.get(filled, 0))
    even = (F.size(filled) >= 2) & (n > 1) & F.forall(filled, lambda t: F.size(t) == n)
    split = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda k: F.transform(tiers, lambda t: F.coalesce(F.get(t, k), F.lit(""))))
    return F.when(even, split).otherwise(F.array(row))
