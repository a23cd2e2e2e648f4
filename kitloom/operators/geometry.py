"""Plane geometry of drawing sheets as column expressions and grouped operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WHOLE = "по всему листу"


def gap_clusters(df: DataFrame, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """df with cluster: values of a key whose gap to the value before exceeds tolerance start the next one."""
    w = Window.partitionBy(*keys).orderBy(value)
    gap = F.col(value) - F.lag(value).over(w)
    return df.withColumn("__g", F.coalesce((gap > tolerance).cast("int"), F.lit(0))).withColumn("cluster", F.sum("__g").over(w)).drop("__g")


def zone(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, *, y_up: bool) -> Column:
    """The place of a box on its sheet in a compass of nine fields; a box of 70 % both ways is the whole sheet."""
    cx, cy = (x0 + x1) / 2 / width, (y0 + y1) / 2 / height
    high, low = ("север", "юг") if y_up else ("юг", "север")
    vertical = F.when(cy < 1 / 3, low).when(cy > 2 / 3, high).otherwise("")
    horizontal = F.when(cx < 1 / 3, "запад").when(cx > 2 / 3, "восток").otherwise("")
    name = F.when((vertical != "") & (horizontal != ""), F.concat(vertical, F.lit("о-"), horizontal)).otherwise(F.coalesce(F.nullif(F.concat(vertical, horizontal), F.lit("")), F.lit("центр")))
    return F.when(((x1 - x0) / width >= 0.7) & ((y1 - y0) / height >= 0.7), WHOLE).otherwise(name)


def overlap_share(a: str, b: str) -> Column:
    """Share of box struct a that lies in box struct b."""
    width = F.least(F.col(f"{a}.x1"), F.col(f"{b}.x1")) - F.greatest(F.col(f"{a}.x0"), F.col(f"{b}.x0"))
    height = F.least(F.col(f"{a}.y1"), F.col(f"{b}.y1")) - F.greatest(F.col(f"{a}.y0"), F.col(f"{b}.y0"))
    area = (F.col(f"{a}.x1") - F.col(f"{a}.x0")) * (F.col(f"{a}.y1") - F.col(f"{a}.y0"))
    return F.when(area > 0, F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0)) / area).otherwise(0.0)


def to_paper(x: Column, y: Column, center_x: Column, center_y: Column, scale: Column, twist_degrees: Column, paper_x: Column, paper_y: Column) -> tuple[Column, Column]:
    """World point of a viewport on paper: shifted, turned, scaled."""
    a = F.radians(twist_degrees)
    dx, dy = x - center_x, y - center_y
    return paper_x + (dx * F.cos(a) - dy * F.sin(a)) * scale, paper_y + (dx * F.sin(a) + dy * F.cos(a)) * scale


def polyline_length(points: Column) -> Column:
    """Length of an array of structs x, y."""
    steps = F.zip_with(F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), lambda p, q: F.sqrt((q["x"] - p["x"]) * (q["x"] - p["x"]) + (q["y"] - p["y"]) * (q["y"] - p["y"])))
    return F.aggregate(steps, F.lit(0.0), lambda s, v: s + v)


def rows_by_gap(df: DataFrame, keys: list[str], *, left: str = "x", right: str = "right", gap: Column) -> DataFrame:
    """df with group: within a key, in order of left, a part begins where the distance to all before exceeds gap."""
    w = Window.partitionBy(*keys).orderBy(left)
    reach = F.max(right).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("__b", F.coalesce((F.col(left) - reach > gap).cast("int"), F.lit(0))).withColumn("group", F.sum("__b").over(w)).drop("__b")


def reading_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """df with place: top down, then left to right."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("y"), "x", "text")))


CHUNK_ROWS = 5000


def _fold_lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A text opens a line unless its y is within 0.6 of its height of the line's first text; rows come in order."""
    key, first, line = None, 0.0, -1
    for frame in frames:
        out = []
        columns = (frame[c] for c in ("document_id", "sheet", "chunk", "y", "height"))
        for document, sheet, chunk, y, height in zip(*columns, strict=True):
            if (document, sheet, chunk) != key:
                key, first, line = (document, sheet, chunk), y, 0
            elif abs(first - y) > max(height, 1.0) * 0.6:
                first, line = y, line + 1
            out.append(line)
        yield frame[["document_id", "sheet", "chunk", "item_id"]].assign(line=pd.array(out, dtype="int64"))


def text_lines(items: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(document_id, sheet, item_id, line) by the greedy grouping of a sheet's texts into lines.

    Each decision depends on the line's first text, so rows are folded in order. A large sheet is cut into chunks where
    the gap of y exceeds every tolerance of the sheet, which no line crosses; chunks are folded apart and counted up.
    """
    usable = items.filter("document_id is not null and sheet is not null and x is not null and y is not null").select("document_id", "sheet", "item_id", "x", "y", F.coalesce("height", F.lit(1.0)).alias("height"))
    w = Window.partitionBy("document_id", "sheet").orderBy(F.desc("y"), "x", "item_id")
    tolerance = F.max(F.greatest("height", F.lit(1.0)) * 0.6).over(Window.partitionBy("document_id", "sheet"))
    cut = F.coalesce(F.lag("y").over(w) - F.col("y") > tolerance, F.lit(True))
    start = F.when(cut, F.row_number().over(w))
    chunked = usable.withColumn("start", start).withColumn("chunk", F.floor(F.max("start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) / chunk_rows).cast("long")).drop("start")
    ordered = chunked.repartition("document_id", "sheet", "chunk").sortWithinPartitions("document_id", "sheet", "chunk", F.desc("y"), "x", "item_id")
    inner = ordered.mapInPandas(_fold_lines, "document_id string, sheet int, chunk long, item_id bigint, line bigint")
    sizes = inner.groupBy("document_id", "sheet", "chunk").agg((F.max("line") + 1).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("document_id", "sheet").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return inner.join(sizes.withColumn("before", before), ["document_id", "sheet", "chunk"]).select("document_id", "sheet", "item_id", (F.col("before") + F.col("line")).alias("line"))


def outermost(boxes: DataFrame, keys: list[str], box_id: str, cell: float) -> DataFrame:
    """Boxes that lie in no larger box of their key; a box meets those that contain its lower left corner."""
    from .matching import points_in_boxes

    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    corners = boxes.select(*keys, F.col(box_id).alias("__id"), F.col("x0").alias("x"), F.col("y0").alias("y"), F.col("x1").alias("__x1"), F.col("y1").alias("__y1"), area.alias("__area"))
    pairs = points_in_boxes(corners, boxes.select(*keys, box_id, "x0", "y0", "x1", "y1"), keys, cell=cell)
    larger = (area > F.col("__area")) | ((area == F.col("__area")) & (F.col(box_id) < F.col("__id")))
    inner = pairs.filter(larger & (F.col("__x1") <= F.col("x1")) & (F.col("__y1") <= F.col("y1"))).select(*keys, F.col("__id").alias(box_id)).distinct()
    return boxes.join(inner, [*keys, box_id], "left_anti")


def components(nodes: DataFrame, edges: DataFrame, node: str, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable over edges, by label propagation with pointer jumping.

    Every round is a few shuffles of labels and edges; its state is written to the checkpoint folder. Labels only fall, and
    jumping halves the way to the smallest one, so the rounds grow with the logarithm of the longest path; it stops when no
    label changes.
    """
    from ..session import cut_lineage

    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct()
    labels = nodes.select(F.col(node).alias("u"), F.col(node).alias("c")).distinct()
    while True:
        around = both.join(labels.select(F.col("u").alias("v"), "c"), "v").select("u", "c")
        low = labels.unionByName(around).groupBy("u").agg(F.min("c").alias("n"))
        jumped = low.join(low.select(F.col("u").alias("n"), F.col("n").alias("nn")), "n", "left").select("u", F.coalesce("nn", "n").alias("n"))
        step = cut_lineage(jumped.join(labels, "u"))
        if not step.filter("n <> c").limit(1).count():
            return step.select(F.col("u").alias(node), F.col("n").alias("component"))
        labels = step.select("u", F.col("n").alias("c"))


def span_text(numbers: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Numbers of a key as spans: {1, 2, 3, 5} is 1–3, 5."""
    w = Window.partitionBy(*keys).orderBy(value)
    island = numbers.select(*keys, F.col(value).cast("long").alias("n")).distinct()
    island = island.withColumn("i", F.col("n") - F.row_number().over(Window.partitionBy(*keys).orderBy("n")))
    ranges = island.groupBy(*keys, "i").agg(F.min("n").alias("a"), F.max("n").alias("b"))
    piece = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat(F.col("a").cast("string"), F.lit("–"), F.col("b").cast("string")))
    return ranges.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", piece.alias("p")))), lambda x: x["p"]), ", ").alias("spans"))


def frame_signatures(boxes: DataFrame, document: str, page: str, share: float = 0.3, least: int = 3) -> DataFrame:
    """Rounded boxes that recur on enough of a document's pages: its frames."""
    rounded = boxes.select(document, page, *[F.round(c).cast("int").alias(c) for c in ("x0", "y0", "x1", "y1")])
    pages = boxes.groupBy(document).agg(F.count_distinct(page).alias("pages"))
    seen = rounded.groupBy(document, "x0", "y0", "x1", "y1").agg(F.count_distinct(page).alias("on_pages"))
    return seen.join(pages, document).filter((F.col("on_pages") >= least) & (F.col("on_pages") >= F.col("pages") * share))


def cell_texts(points: DataFrame, cells: DataFrame, keys: list[str], cell_id: str, text: str, size: float) -> DataFrame:
    """The text of each cell: its captions from top to bottom, left to right."""
    from .matching import points_in_boxes

    inside = points_in_boxes(points, cells, keys, cell=size)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("y")).alias("y"), "x", F.col(text).alias("t"))))
    return inside.groupBy(*keys, cell_id).agg(F.array_join(F.transform(ordered, lambda s: s["t"]), " ").alias("text"))


def drawing_field(sheet: str, stamp: str) -> Column:
    """The largest of the four remainders of a sheet box after its stamp is cut away."""
    s, t = F.col(sheet), F.col(stamp)
    box = lambda x0, y0, x1, y1: F.struct(((x1 - x0) * (y1 - y0)).alias("area"), x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))
    parts = F.array(box(s.x0, s.y0, t.x0, s.y1), box(t.x1, s.y0, s.x1, s.y1), box(s.x0, t.y1, s.x1, s.y1), box(s.x0, s.y0, s.x1, t.y0))
    return F.array_max(parts)


def fitted(inner: str, outer: str) -> Column:
    """A box moved into another one as far as it must be, then cut to it."""
    i, o = F.col(inner), F.col(outer)
    dx = F.when(i.x0 < o.x0, o.x0 - i.x0).when(i.x1 > o.x1, F.greatest(o.x1 - i.x1, o.x0 - i.x0)).otherwise(0.0)
    dy = F.when(i.y0 < o.y0, o.y0 - i.y0).when(i.y1 > o.y1, F.greatest(o.y1 - i.y1, o.y0 - i.y0)).otherwise(0.0)
    return F.struct((i.x0 + dx).alias("x0"), (i.y0 + dy).alias("y0"), F.least(i.x1 + dx, o.x1).alias("x1"), F.least(i.y1 + dy, o.y1).alias("y1"))


def clipped_segment(x0: Column, y0: Column, x1: Column, y1: Column, box: str) -> Column:
    """A segment cut to a box as struct x0, y0, x1, y1; null if it lies outside."""
    b = F.col(box)
    dx, dy = x1 - x0, y1 - y0
    low, high, outside = F.lit(0.0), F.lit(1.0), F.lit(False)
    for p, q in ((-dx, x0 - b.x0), (dx, b.x1 - x0), (-dy, y0 - b.y0), (dy, b.y1 - y0)):
        t = q / F.nullif(p, F.lit(0.0))
        low = F.greatest(low, F.when(p < 0, t).otherwise(0.0))
        high = F.least(high, F.when(p > 0, t).otherwise(1.0))
        outside = outside | ((p == 0) & (q < 0))
    cut = F.struct((x0 + dx * low).alias("x0"), (y0 + dy * low).alias("y0"), (x0 + dx * high).alias("x1"), (y0 + dy * high).alias("y1"))
    return F.when(~outside & (low <= high), cut)


def shape_signature(points: Column, kind: Column) -> Column:
    """Hash of a shape that neither moving nor scaling changes: points relative to their box, rounded."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    x0, y0 = F.array_min(xs), F.array_min(ys)
    size = F.greatest(F.array_max(xs) - x0, F.array_max(ys) - y0, F.lit(1e-9))
    part = lambda p: F.concat_ws(",", F.round((p["x"] - x0) / size, 2).cast("string"), F.round((p["y"] - y0) / size, 2).cast("string"))
    return F.sha2(F.concat_ws(";", kind, F.array_join(F.transform(points, part), ";")), 256)


def outside_tables(blocks: DataFrame, tables: DataFrame, keys: list[str], block_id: str, share: float = 0.6, cell: float = 100.0) -> DataFrame:
    """Blocks (keys..., block_id, box) of which no table of the page covers more than a share of at least a half.

    A table that covers more than half of a block contains its middle, so blocks meet only tables that do.
    """
    from .matching import points_in_boxes

    middles = blocks.select(*keys, block_id, F.col("box").alias("__a"), ((F.col("box.x0") + F.col("box.x1")) / 2).alias("x"), ((F.col("box.y0") + F.col("box.y1")) / 2).alias("y"))
    met = points_in_boxes(middles, tables.select(*keys, F.col("box").alias("__b"), "box.*"), keys, cell=cell)
    covered = met.filter(overlap_share("__a", "__b") > share).select(*keys, block_id).distinct()
    return blocks.join(covered, [*keys, block_id], "left_anti")


def median_clusters(df: DataFrame, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """(keys..., value, cluster): in order of value, a value joins the cluster whose running median is near enough.

    A fold over sorted partitions; only the current cluster of a key is held. Its values come in order, so its median is in
    their middle.
    """

    def middle(held: list[float]) -> float:
        return (held[(len(held) - 1) // 2] + held[len(held) // 2]) / 2

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, cluster, held = None, 0, []
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                own, v = tuple(row[:-1]), row[-1]
                if own != key:
                    key, cluster, held = own, 0, [v]
                elif abs(v - middle(held)) <= tolerance:
                    held.append(v)
                else:
                    cluster, held = cluster + 1, [v]
                out.append(cluster)
            yield frame.assign(cluster=pd.array(out, dtype="int64"))

    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    ordered = df.select(*keys, F.col(value).cast("double").alias(value)).filter(F.col(value).isNotNull()).repartition(*keys).sortWithinPartitions(*keys, value)
    return ordered.mapInPandas(fold, f"{kinds}, {value} double, cluster long")
