"""Drawings as tables of entities, layers, layouts and viewports: what is shown, where it stands, which sheet it belongs to.

Entities are rows (path, handle, owner, layer, ...) as a reader of drawings emits them; all steps are joins on handles,
layers or grid cells.

Defined cases: null layers are shown; entities without a box belong to no sheet; frames of no extent are none; other input
columns are kept or ignored as each function says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .geometry import outermost, to_paper
from .matching import points_in_boxes

# The bit of an external block, how far beyond a sheet its objects reach, the share that makes a frame of an
# insert, the title block's size (mm) and the fewest texts that tell a sheet's usual height.
EXTERNAL_BIT, SHEET_PAD, FRAME_SHARE, STAMP_WIDTH, STAMP_HEIGHT, LEAST_TEXTS = 4, 0.3, 0.85, 185.0, 55.0, 8


def shown(entities: DataFrame, layers: DataFrame) -> DataFrame:
    """Entities that are visible and on no layer that is off or frozen; layers: path, name, off, frozen."""
    hidden = layers.filter("off or frozen").select("path", F.col("name").alias("layer")).distinct()
    return entities.filter(~F.coalesce(F.col("invisible"), F.lit(False))).join(hidden, ["path", "layer"], "left_anti")


def external_blocks(blocks: DataFrame) -> DataFrame:
    """(path, name) of block definitions that stand for another file; blocks: path, name, flags."""
    return blocks.filter(F.col("flags").bitwiseAND(F.lit(EXTERNAL_BIT)) != 0).select("path", "name").distinct()


def layout_viewports(viewports: DataFrame, layouts: DataFrame) -> DataFrame:
    """Viewports with the name of their layout, by the handle of the block that owns them; defective ones are left out.

    viewports: path, owner, center, width, height, view_center, view_height and, if any, view_target, twist; points are
    structs x, y. layouts: path, layout, block.
    """
    sound = viewports.filter("center.x is not null and center.y is not null and view_center.x is not null and view_center.y is not null and width > 0 and height > 0 and view_height > 0")
    named = layouts.filter("layout is not null and block is not null").groupBy("path", F.col("block").alias("owner")).agg(F.max("layout").alias("layout"))
    origin = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return sound.join(named, ["path", "owner"]).withColumn("view_target", F.coalesce("view_target", origin)).withColumn("twist", F.coalesce("twist", F.lit(0.0)))


def on_paper(points: DataFrame, viewports: DataFrame, *, cell: float = 1000.0) -> DataFrame:
    """Points (path, id, x, y) of the model where the viewports of layouts show them: path, id, layout, x, y on paper.

    A point is looked for in the box around a viewport's window in the model and then measured on paper.
    """
    scale = F.col("height") / F.col("view_height")
    cx, cy = F.col("view_center.x") + F.col("view_target.x"), F.col("view_center.y") + F.col("view_target.y")
    reach = F.sqrt(F.col("width") * F.col("width") + F.col("height") * F.col("height")) / scale / 2
    half = F.when(F.col("twist") == 0, F.col("width") / scale / 2).otherwise(reach), F.when(F.col("twist") == 0, F.col("height") / scale / 2).otherwise(reach)
    windows = viewports.select("path", "layout", "center", "width", "height", scale.alias("scale"), "twist", cx.alias("cx"), cy.alias("cy"), (cx - half[0]).alias("x0"), (cy - half[1]).alias("y0"), (cx + half[0]).alias("x1"), (cy + half[1]).alias("y1"))
    met = points_in_boxes(points.select("path", "id", "x", "y"), windows, ["path"], cell=cell)
    px, py = to_paper(F.col("x"), F.col("y"), F.col("cx"), F.col("cy"), F.col("scale"), F.col("twist"), F.col("center.x"), F.col("center.y"))
    placed = met.select("path", "id", "layout", px.alias("px"), py.alias("py"), "center", "width", "height")
    inside = (F.abs(F.col("px") - F.col("center.x")) <= F.col("width") / 2) & (F.abs(F.col("py") - F.col("center.y")) <= F.col("height") / 2)
    return placed.filter(inside).select("path", "id", "layout", F.col("px").alias("x"), F.col("py").alias("y")).distinct()


def sheet_frames(frames: DataFrame, *, cell: float = 1000.0) -> DataFrame:
    """(path, number, x0, y0, x1, y1): the outermost frames of a model, numbered by rows of a hundred units from the top, then from the left."""
    boxes = frames.filter("x1 > x0 and y1 > y0").select("path", "x0", "y0", "x1", "y1").distinct().withColumn("frame", F.xxhash64("x0", "y0", "x1", "y1"))
    order = Window.partitionBy("path").orderBy(F.desc(F.round(F.col("y1"), -2)), "x0", "frame")
    return outermost(boxes, ["path"], "frame", cell).select("path", F.row_number().over(order).alias("number"), "x0", "y0", "x1", "y1")


def frame_texts(texts: DataFrame, sheets: DataFrame, *, cell: float = 1000.0) -> DataFrame:
    """Texts (path, id, x, y, height) of the sheets they stand in: path, number, id, usual (the sheet's usual height).

    The usual height is the most frequent one of the sheet, or of the file where a sheet has too few texts.
    """
    inside = points_in_boxes(texts.select("path", "id", "x", "y", "height"), sheets, ["path"], cell=cell).select("path", "number", "id", "height")
    tall = F.round("height", 1)
    mode = lambda df, keys: df.filter("height > 0").groupBy(*keys, tall.alias("h")).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max(F.struct("n", (-F.col("h")).alias("h"))).alias("m"), F.sum("n").alias("texts")).select(*keys, (-F.col("m.h")).alias("h"), "texts")
    own = mode(inside, ["path", "number"]).filter(F.col("texts") >= LEAST_TEXTS).select("path", "number", F.col("h").alias("own"))
    file = mode(texts, ["path"]).select("path", F.col("h").alias("file"))
    return inside.join(own, ["path", "number"], "left").join(file, "path", "left").select("path", "number", "id", F.coalesce("own", "file").alias("usual"))


def on_sheet(box: Column, sheet: Column) -> Column:
    """A box overlaps a sheet and reaches beyond it by no more than a part of its size."""
    b, s = box, sheet
    overlaps = (b["x1"] >= s["x0"]) & (b["x0"] <= s["x1"]) & (b["y1"] >= s["y0"]) & (b["y0"] <= s["y1"])
    w, h = (s["x1"] - s["x0"]) * SHEET_PAD, (s["y1"] - s["y0"]) * SHEET_PAD
    return overlaps & (b["x0"] > s["x0"] - w) & (b["x1"] < s["x1"] + w) & (b["y0"] > s["y0"] - h) & (b["y1"] < s["y1"] + h)


def common_area(a: Column, b: Column) -> Column:
    width = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    height = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))


def covers_sheet(box: Column, sheet: Column) -> Column:
    """A box takes so much of its sheet that it is a frame."""
    area = (sheet["x1"] - sheet["x0"]) * (sheet["y1"] - sheet["y0"])
    return F.coalesce((area > 0) & (common_area(box, sheet) >= FRAME_SHARE * area), F.lit(False))


def placed_stamp(x: Column, y: Column, scale: Column, sheet: Column) -> Column:
    """The title block's box at an insert point: of the four around it the one most of which is on the sheet."""
    w, h = scale * STAMP_WIDTH, scale * STAMP_HEIGHT
    boxes = [(x, y, x + w, y + h), (x - w, y, x, y + h), (x, y - h, x + w, y), (x - w, y - h, x, y)]
    named = [F.struct(*[v.cast("double").alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), b, strict=True)]) for b in boxes]
    ranked = F.array(*[F.struct(F.round(common_area(b, sheet), 6).alias("area"), F.lit(-k).alias("k"), b.alias("box")) for k, b in enumerate(named)])
    return F.array_max(ranked)["box"]


def block_signatures(entities: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """(keys, signature): a hash of what a block is made of, whatever the order and the handles of its entities."""
    one = F.to_json(F.struct(*[F.col(c) for c in sorted(attributes)]))
    whole = F.array_join(F.array_sort(F.collect_list(one)), "\n")
    return entities.groupBy(*keys).agg(F.concat(F.lit("blockdef:"), F.sha2(whole, 256)).alias("signature"))
