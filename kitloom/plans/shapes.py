"""Registered queries of sheet geometry, marks, grids, captions and merged readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tables
from ..functions import text as T
from ..operators import catalog, entities, folds, gates, layouts, marks, matching, scoring, stampread, symbols
from ..operators import geometry as G
from ..operators import lines as L
from ..operators import recon as R
from ..session import table
from ..streaming import jobs as J
from .texts import _CELLS, _SQ

# Extent of a sheet and of its title block, in millimetres.
SHEET = (0.0, 0.0, 420.0, 297.0)


def _box(x0: float, y0: float, x1: float, y1: float):  # noqa: ANN202
    return F.struct(*[F.lit(v).alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), (x0, y0, x1, y1), strict=True)])


def _notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes with a box, a row for each id."""
    return table(spark, d, "note_texts").filter("bbox is not null").dropDuplicates(["id"])


def _captions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "text_items").filter("text is not null and x is not null and y is not null and document_id is not null and sheet is not null")


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """The edges of the notes' boxes as straight lines."""
    b = F.col("bbox")
    sides = [(b.x0, b.y0, b.x1, b.y0), (b.x0, b.y1, b.x1, b.y1), (b.x0, b.y0, b.x0, b.y1), (b.x1, b.y0, b.x1, b.y1)]
    side = F.explode(F.array(*[F.struct(*[v.alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), s, strict=True)]) for s in sides])).alias("s")
    return layouts.straight_lines(_notes(spark, d).select("document_id", F.col("page").cast("int").alias("sheet"), side).select("document_id", "sheet", "s.*"))


def box_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)


def snapped_edges(spark: SparkSession, d: str) -> DataFrame:
    texts = _notes(spark, d).filter("x is not null and y is not null").select("document_id", F.col("page").cast("int").alias("sheet"), "x", "y")
    return layouts.snapped_lines(_edges(spark, d), texts).select("document_id", "sheet", "across", "at", "low", "high")


def box_outlines(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("bbox")
    points = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((b.x0, b.y0), (b.x1, b.y0), (b.x1, b.y1), (b.x0, b.y1), (b.x0, b.y0))])
    return _notes(spark, d).select("id", F.round(G.polyline_length(points), 3).alias("length"), G.shape_signature(points, F.lit("box")).alias("signature"))


def paper_points(spark: SparkSession, d: str) -> DataFrame:
    """Captions as a viewport turned by 30 degrees shows them at half their size."""
    x, y = G.to_paper(F.col("x"), F.col("y"), F.lit(420.0), F.lit(297.0), F.lit(0.5), F.lit(30.0), F.lit(200.0), F.lit(100.0))
    return _captions(spark, d).select("item_id", F.round(x, 3).alias("px"), F.round(y, 3).alias("py"))


def clipped_diagonals(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("bbox")
    cut = G.clipped_segment(b.x0, b.y0, b.x1, b.y1, "sheet")
    out = _notes(spark, d).filter("bbox.x1 > bbox.x0 and bbox.y1 > bbox.y0").withColumn("sheet", _box(*SHEET)).select("id", cut.alias("c")).filter("c is not null")
    return out.select("id", *[F.round(F.col(f"c.{n}"), 3).alias(n) for n in ("x0", "y0", "x1", "y1")])


def drawing_fields(spark: SparkSession, d: str) -> DataFrame:
    """What a title block of 185 by 55 in the lower right corner leaves of a page's extent."""
    page = _notes(spark, d).groupBy("document_id", "page").agg(F.struct(F.min("bbox.x0").alias("x0"), F.min("bbox.y0").alias("y0"), F.max("bbox.x1").alias("x1"), F.max("bbox.y1").alias("y1")).alias("s")).filter("s.x1 - s.x0 > 185 and s.y1 - s.y0 > 55")
    stamp = F.struct((F.col("s.x1") - 185).alias("x0"), F.col("s.y0").alias("y0"), F.col("s.x1").alias("x1"), (F.col("s.y0") + 55).alias("y1"))
    return page.withColumn("t", stamp).withColumn("f", G.drawing_field("s", "t")).select("document_id", "page", F.round("f.area", 2).alias("area"), "f.x0", "f.y0", "f.x1", "f.y1")


def fitted_boxes(spark: SparkSession, d: str) -> DataFrame:
    return _notes(spark, d).withColumn("sheet", _box(*SHEET)).select("id", G.fitted("bbox", "sheet").alias("b")).select("id", *[F.round(F.col(f"b.{n}"), 6).alias(n) for n in ("x0", "y0", "x1", "y1")])


def notes_outside_legends(spark: SparkSession, d: str) -> DataFrame:
    keys = ["document_id", "page"]
    legends = table(spark, d, "legend_entries").filter("bbox is not null").select(*keys, F.col("bbox").alias("box"))
    return G.outside_tables(_notes(spark, d).select(*keys, "id", F.col("bbox").alias("box")), legends, keys, "id", share=0.5).select("id")


def axis_values(spark: SparkSession, d: str) -> DataFrame:
    v = marks.axis_value(F.col("text"))
    return table(spark, d, "text_items").select("item_id", v.alias("v")).filter("v is not null").select("item_id", "v.kind", "v.value")


def number_values(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "text_items").filter(marks.is_level(t) | marks.is_size(t)).select("item_id", marks.number_value(t).alias("value"), marks.is_level(t).alias("level"))


def axis_marks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of axes with the letter and digit of the captions near them."""
    own = symbols.latest_rows(table(spark, d, "symbol_instances")).filter("lower(block_name) like 'ось%' and document_id is not null and page is not null")
    own = own.select("document_id", F.col("page").cast("int").alias("sheet"), "id", "x", "y", F.lit("osi").alias("layer"), F.lit(None).cast("string").alias("reason"), "block_name", F.lit(None).cast("map<string,string>").alias("attributes"))
    return marks.read_axes(own, _captions(spark, d).select("document_id", "sheet", F.col("item_id").alias("text_id"), "x", "y", "text"), ["document_id", "sheet"], radius=60.0)


def size_marks(spark: SparkSession, d: str) -> DataFrame:
    """Symbols on layers of sizes with the number of the caption near them."""
    own = symbols.latest_rows(table(spark, d, "symbol_instances")).filter("layer = 'РАЗМЕРЫ' and document_id is not null and page is not null")
    own = own.select("document_id", F.col("page").cast("int").alias("sheet"), "id", "x", "y", F.lit("razmer").alias("layer"), F.lit(None).cast("string").alias("reason"), "block_name", F.lit(None).cast("map<string,string>").alias("attributes"))
    return marks.read_dimensions(own, _captions(spark, d).select("document_id", "sheet", F.col("item_id").alias("text_id"), "x", "y", "text"), ["document_id", "sheet"], radius=60.0)


def axis_pairs(spark: SparkSession, d: str) -> DataFrame:
    return symbols.axis_pairs(_captions(spark, d), ["document_id"], 400.0).select("letter_id", "digit_id")


def block_definitions(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "symbol_instances").filter("block_name is not null")
    return entities.block_signatures(own, ["block_name"], ["layer", "role", "units"])


def frame_covers(spark: SparkSession, d: str) -> DataFrame:
    """How a note's box lies on a sheet, and where a title block inserted at its corner stands."""
    b, s = F.col("bbox"), _box(*SHEET)
    stamp = entities.placed_stamp(b.x0, b.y0, F.lit(1.0), s)
    return _notes(spark, d).select("id", entities.on_sheet(b, s).alias("on_sheet"), entities.covers_sheet(b, s).alias("covers"), F.round(stamp["x0"], 6).alias("sx0"), F.round(stamp["y0"], 6).alias("sy0"))


def caption_spans(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "text_items").filter("text is not null and height is not null").select("item_id", F.round(gates.text_span(F.col("text"), F.col("height"), F.lit(0.8)), 3).alias("span"))


def type_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "legend_entries").filter("label is not null").select("id", gates.type_label(F.col("label")).alias("label")).distinct()


def sheet_kinds(spark: SparkSession, d: str) -> DataFrame:
    """What a sheet is by its extent and captions, and by its symbols."""
    t = F.col("text")
    own = _captions(spark, d).groupBy("document_id", "sheet").agg((F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h"), F.count("*").alias("labels"), F.count_distinct("text").alias("unique_labels"), F.count_if(t.rlike("^DN")).alias("pipes"), F.count_if(t.rlike("^[А-Я]$")).alias("axes"), F.count_if(t.rlike("^[0-9]+$")).alias("numbers"), F.sum(F.length(t)).alias("chars"))
    inserts = table(spark, d, "symbol_instances").groupBy("document_id", F.col("page").cast("int").alias("sheet")).agg(F.count("*").alias("inserts"))
    whole = own.join(inserts, ["document_id", "sheet"], "left").fillna(0, ["inserts"])
    kind = gates.page_kind(F.col("w") * 2, F.col("h") * 2, F.col("labels"), F.col("unique_labels"), F.col("pipes"), F.col("axes"), F.lit(None).cast("string"), F.lit(0), F.col("numbers"), F.col("chars"))
    return whole.select("document_id", "sheet", kind.alias("kind"), gates.sheet_kind(F.col("w") / 20, F.col("labels"), F.col("labels"), F.col("inserts")).alias("vector_kind"), gates.needs_model(F.lit(False), F.col("labels") < 3, kind).alias("needs_model"), gates.is_drawing_page(F.col("w") * 2, F.col("h") * 2).alias("drawing"))


def page_states(spark: SparkSession, d: str) -> DataFrame:
    """Pages by what kind of content they have, and what a passport says of their kind."""
    docs = table(spark, d, "documents")
    text = F.trim(F.coalesce("text", F.lit("")))
    state = gates.sheet_content(text != "", F.col("text").isNull(), F.col("n_chars") == 0)
    only_text = gates.is_text_only(F.length(text), F.lit(0), F.lit(0.0), F.lit(0.0))
    return docs.groupBy(state.alias("state"), only_text.alias("only_text"), gates.passport_kind(F.col("text")).alias("passport")).agg(F.count("*").alias("pages"))


def level_sentences(spark: SparkSession, d: str) -> DataFrame:
    """The check of a document's dimensions in words: those that are levels count as found."""
    t, dimension = F.col("text"), F.col("source") == "dimension"
    other = F.array_sort(F.collect_set(F.when(dimension & ~marks.is_level(t), t)))
    own = table(spark, d, "text_items").filter("text is not null and document_id is not null").groupBy("document_id").agg(F.count_if(dimension).alias("total"), F.count_if(dimension & marks.is_level(t)).alias("found"), other.alias("suspects"))
    return own.select("document_id", gates.numbers_sentence(F.col("total"), F.col("found"), F.col("suspects")).alias("sentence"))


def stripped_pages(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.md5(T.strip_page_heading(t)).alias("body"), F.md5(T.strip_tile_markers(t)).alias("tiles"), F.md5(T.normalized(t)).alias("normal"))


def best_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles of sheets: those of the kit before those of the archive; and both under each other."""
    one = lambda name: table(spark, d, name).filter("sheet_key is not null").groupBy("sheet_key").agg(F.max("title").alias("title"))
    kit, archive = one("stamps_kit"), one("stamps_archive")
    both = R.stacked([("kit", kit), ("archive", archive)], ["sheet_key"], "title").withColumnRenamed("title", "both")
    return R.best_of(archive, kit, ["sheet_key"], "title").join(both, "sheet_key", "left")


def zipped_stamps(spark: SparkSession, d: str) -> DataFrame:
    """The n-th sheet of a document in one copy beside the n-th in the other."""
    one = lambda t, name: table(spark, d, t).filter("sheet_key is not null and document_id is not null").select("document_id", F.col("sheet_key").alias(name)).distinct()
    return matching.zipped(one("stamps_kit", "kit_key"), one("stamps_archive", "archive_key"), ["document_id"], "kit_key", "archive_key").select("document_id", "kit_key", "archive_key")


def sole_bindings(spark: SparkSession, d: str) -> DataFrame:
    """Instances and legend entries that are bound to each other alone."""
    pairs = table(spark, d, "symbol_bindings").filter("instance_id is not null and legend_entry_id is not null").select("instance_id", "legend_entry_id").distinct()
    return matching.mutual_pairs(pairs, "instance_id", "legend_entry_id").select("instance_id", "legend_entry_id")


def title_likeness(spark: SparkSession, d: str) -> DataFrame:
    """Likeness of a sheet's greatest titles in both copies by their words."""
    words = lambda c: F.split(F.lower(F.col(c)), " ")
    one = lambda t, name: table(spark, d, t).filter("sheet_key is not null and title is not null").groupBy("sheet_key").agg(F.max("title").alias(name))
    both = one("stamps_kit", "a").join(one("stamps_archive", "b"), "sheet_key")
    return both.select("sheet_key", F.round(scoring.jaccard(words("a"), words("b")), 6).alias("likeness"))


def trimmed_tables(spark: SparkSession, d: str) -> DataFrame:
    """Rows and columns that are left of a page's tables without blank rows and sparse columns."""
    cells = L.table_cells(L.lines(table(spark, d, "documents"), ["doc_id"]), ["doc_id"])
    rows = cells.groupBy("doc_id", "table_no", "row").agg(F.array_sort(F.collect_list(F.struct("col", "cell"))).alias("r")).withColumn("r", F.transform("r", lambda c: c["cell"]))
    grid = rows.groupBy("doc_id", "table_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "r"))), lambda x: x["r"]).alias("g"))
    cut = grid.select("doc_id", "table_no", stampread.trimmed_grid(F.col("g")).alias("t"), stampread.block_columns(F.col("g")).alias("c"))
    return cut.select("doc_id", "table_no", F.size("t").cast("bigint").alias("rows"), F.size("c").cast("bigint").alias("columns"))


def stamp_rows(spark: SparkSession, d: str) -> DataFrame:
    """The row of a sheet's stamp texts, taken as a grid of one column, from which on it is a title block."""
    own = table(spark, d, "stamp_items").filter("text is not null and document_id is not null").groupBy("document_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "text"))), lambda x: F.array(x["text"])).alias("g"))
    return own.select("document_id", "page", stampread.stamp_start(F.col("g"), ("лист",), needed=1).alias("start")).filter("start is not null")


def grown_findings(spark: SparkSession, d: str) -> DataFrame:
    """Tools and documents with more findings in the later half than in the earlier."""
    f = table(spark, d, "findings").filter("document_id is not null and tool is not null and n_found is not null and found_at is not null")
    part = lambda late: f.filter((F.month("found_at") >= 7) == F.lit(late)).groupBy("document_id", "tool").agg(F.sum("n_found").alias("n"))
    return catalog.changed_findings(part(False), part(True), ["document_id", "tool"], "n").select("document_id", "tool", F.col("n").cast("bigint").alias("n"), F.coalesce("before", F.lit(0)).cast("bigint").alias("before"))


def page_passes(spark: SparkSession, d: str) -> DataFrame:
    return L.passes(table(spark, d, "documents").filter("text is not null"), ["doc_id"], "text").select("doc_id", "pass", F.md5("body").alias("digest"))


def split_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines and distinct tokens of pages by the table functions of SQL."""
    tables.register(spark)
    docs = table(spark, d, "documents").select("doc_id", "text")
    split = spark.sql("select doc_id, l.pos, l.line from {docs}, lateral text_lines(text) l", docs=docs)
    tokens = spark.sql("select doc_id, t.token from {docs}, lateral text_tokens(text) t", docs=docs)
    return split.groupBy("doc_id").agg(F.count("*").alias("lines")).join(tokens.groupBy("doc_id").agg(F.count("*").alias("tokens")), "doc_id", "left").fillna(0, ["tokens"])


def restarted_states(spark: SparkSession, d: str) -> DataFrame:
    """Users by the state they are in after a restart that makes what was viewed wait again."""
    last = J.latest_state(table(spark, d, "events"), "user_id")
    state = J.reconciled(F.when(F.col("event_type") == "view", "processing").otherwise(F.col("event_type")))
    return last.groupBy(state.alias("state")).agg(F.count("*").alias("users"))


def summed_usage(spark: SparkSession, d: str) -> DataFrame:
    used = table(spark, d, "findings").filter("tool is not null and n_found is not null").select("tool", F.create_map(F.lit("found"), F.col("n_found").cast("bigint"), F.lit("calls"), F.lit(1).cast("bigint")).alias("usage"))
    return J.merged_usage(used, ["tool"], "usage")


def joined_cells(spark: SparkSession, d: str) -> DataFrame:
    """Sheets' stamp texts as one cell of tiers, and captions with their signs put in order."""
    own = table(spark, d, "stamp_items").filter("text is not null and document_id is not null").groupBy("document_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "text"))), lambda x: x["text"]), "\n").alias("text"))
    joined = folds.text_function(lambda t: folds.joined_tiers(folds.sanitized(folds.unescaped(t)).split("\n")))
    return own.select("document_id", "page", F.md5(joined(F.col("text"))).alias("digest"))


QUERIES = {
    f.__name__: f
    for f in (
        box_edges, snapped_edges, box_outlines, paper_points, clipped_diagonals, drawing_fields, fitted_boxes, notes_outside_legends, axis_values, number_values, axis_marks, size_marks, axis_pairs, block_definitions, frame_covers, caption_spans, type_labels,
        sheet_kinds, page_states, level_sentences, stripped_pages, best_titles, zipped_stamps, sole_bindings, title_likeness, trimmed_tables, stamp_rows, grown_findings, page_passes, split_lines, restarted_states, summed_usage, joined_cells,
    )
}

_NOTES = "n AS (SELECT DISTINCT ON (id) * FROM note_texts WHERE bbox IS NOT NULL)"
_EDGES = f"""{_NOTES}, e AS (
  SELECT document_id, page::INTEGER AS sheet, true AS across, bbox.x0 AS low, bbox.x1 AS high, bbox.y0 AS "at" FROM n WHERE bbox.x1 > bbox.x0 UNION ALL SELECT document_id, page::INTEGER, true, bbox.x0, bbox.x1, bbox.y1 FROM n WHERE bbox.x1 > bbox.x0
  UNION ALL SELECT document_id, page::INTEGER, false, bbox.y0, bbox.y1, bbox.x0 FROM n WHERE bbox.y1 > bbox.y0 UNION ALL SELECT document_id, page::INTEGER, false, bbox.y0, bbox.y1, bbox.x1 FROM n WHERE bbox.y1 > bbox.y0)"""
_CAPTIONS = "c AS (SELECT * FROM text_items WHERE text IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND document_id IS NOT NULL AND sheet IS NOT NULL)"
_NUMBER = r"trim(replace(regexp_replace(trim(text, ' '), '(?i)\s*мм$', ''), ',', '.'), ' ')"
_LEVEL = f"regexp_full_match({_NUMBER}, '[+-]?[0-9]+\\.[0-9]{{1,4}}')"
_SIZE = f"(regexp_full_match({_NUMBER}, '[+-]?[0-9]{{2,6}}(\\.[0-9]{{1,3}})?') AND NOT regexp_matches(text, '[()]'))"

ORACLE = {
    "box_edges": f'WITH {_EDGES} SELECT document_id, sheet, across, low, high, "at" FROM e',
    "snapped_edges": f"""WITH {_EDGES}, s AS (SELECT document_id, sheet, greatest(greatest(a, b, c) * 0.004, 1e-6) AS tol FROM (SELECT document_id, sheet, max(high - low) AS a FROM e GROUP BY ALL) JOIN (SELECT document_id, page::INTEGER AS sheet, max(x) - min(x) AS b, max(y) - min(y) AS c FROM n WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ALL) USING (document_id, sheet)),
g AS (SELECT *, CASE WHEN "at" - lag("at") OVER (PARTITION BY document_id, sheet, across ORDER BY "at") > tol THEN 1 ELSE 0 END AS new FROM e JOIN s USING (document_id, sheet)), l AS (SELECT *, sum(new) OVER (PARTITION BY document_id, sheet, across ORDER BY "at" RANGE UNBOUNDED PRECEDING) AS line FROM g)
SELECT document_id, sheet, across, min("at") AS "at", min(low) AS low, max(high) AS high FROM l GROUP BY document_id, sheet, across, line""",
    "box_outlines": f"WITH {_NOTES}, b AS (SELECT id, bbox.x1 - bbox.x0 AS w, bbox.y1 - bbox.y0 AS h, greatest(bbox.x1 - bbox.x0, bbox.y1 - bbox.y0, 1e-9) AS s FROM n), t AS (SELECT *, round(w / s, 2)::VARCHAR AS x, round(h / s, 2)::VARCHAR AS y FROM b) SELECT id, round(2 * w + 2 * h, 3) AS length, sha256('box;0.0,0.0;' || x || ',0.0;' || x || ',' || y || ';0.0,' || y || ';0.0,0.0') AS signature FROM t",
    "paper_points": f"WITH {_CAPTIONS} SELECT item_id, round(200 + ((x - 420) * cos(radians(30)) - (y - 297) * sin(radians(30))) * 0.5, 3) AS px, round(100 + ((x - 420) * sin(radians(30)) + (y - 297) * cos(radians(30))) * 0.5, 3) AS py FROM c",
    "clipped_diagonals": f"""WITH {_NOTES}, b AS (SELECT id, bbox.x0 AS a, bbox.y0 AS b, bbox.x1 - bbox.x0 AS dx, bbox.y1 - bbox.y0 AS dy FROM n WHERE bbox.x1 > bbox.x0 AND bbox.y1 > bbox.y0),
t AS (SELECT *, greatest(0.0, -a / dx, -b / dy) AS low, least(1.0, (420 - a) / dx, (297 - b) / dy) AS high FROM b) SELECT id, round(a + dx * low, 3) AS x0, round(b + dy * low, 3) AS y0, round(a + dx * high, 3) AS x1, round(b + dy * high, 3) AS y1 FROM t WHERE low <= high""",
    "drawing_fields": f"""WITH {_NOTES}, s AS (SELECT document_id, page, min(bbox.x0) x0, min(bbox.y0) y0, max(bbox.x1) x1, max(bbox.y1) y1 FROM n GROUP BY ALL), k AS (SELECT * FROM s WHERE x1 - x0 > 185 AND y1 - y0 > 55),
p AS (SELECT document_id, page, (x1 - 185 - x0) * (y1 - y0) AS area, x0, y0, x1 - 185 AS x1, y1 FROM k UNION ALL SELECT document_id, page, (x1 - x0) * (y1 - (y0 + 55)), x0, y0 + 55, x1, y1 FROM k)
SELECT document_id, page, round(area, 2) AS area, x0, y0, x1, y1 FROM p QUALIFY row_number() OVER (PARTITION BY document_id, page ORDER BY area DESC, x0 DESC, y0 DESC) = 1""",
    "fitted_boxes": f"""WITH {_NOTES}, b AS (SELECT id, bbox.x0 x0, bbox.y0 y0, bbox.x1 x1, bbox.y1 y1, CASE WHEN bbox.x0 < 0 THEN -bbox.x0 WHEN bbox.x1 > 420 THEN greatest(420 - bbox.x1, -bbox.x0) ELSE 0 END AS dx, CASE WHEN bbox.y0 < 0 THEN -bbox.y0 WHEN bbox.y1 > 297 THEN greatest(297 - bbox.y1, -bbox.y0) ELSE 0 END AS dy FROM n)
SELECT id, round(x0 + dx, 6) AS x0, round(y0 + dy, 6) AS y0, round(least(x1 + dx, 420), 6) AS x1, round(least(y1 + dy, 297), 6) AS y1 FROM b""",
    "notes_outside_legends": f"WITH {_NOTES} SELECT id FROM n WHERE NOT EXISTS (SELECT 1 FROM legend_entries l WHERE l.document_id = n.document_id AND l.page = n.page AND l.bbox IS NOT NULL AND greatest(least(n.bbox.x1, l.bbox.x1) - greatest(n.bbox.x0, l.bbox.x0), 0) * greatest(least(n.bbox.y1, l.bbox.y1) - greatest(n.bbox.y0, l.bbox.y0), 0) > 0.5 * (n.bbox.x1 - n.bbox.x0) * (n.bbox.y1 - n.bbox.y0))",
    "axis_values": "SELECT item_id, CASE WHEN regexp_full_match(trim(text, ' '), '[0-9]{1,3}') THEN 'digit' ELSE 'letter' END AS kind, CASE WHEN regexp_full_match(trim(text, ' '), '[0-9]{1,3}') THEN trim(text, ' ') ELSE replace(upper(trim(text, ' ')), 'Ё', 'Е') END AS value FROM text_items WHERE regexp_full_match(trim(text, ' '), '[0-9]{1,3}') OR regexp_full_match(replace(upper(trim(text, ' ')), 'Ё', 'Е'), '[A-ZА-Я]{1,2}')",
    "number_values": f"SELECT item_id, {_NUMBER} AS value, {_LEVEL} AS level FROM text_items WHERE {_LEVEL} OR {_SIZE}",
    "axis_pairs": f"""WITH {_CAPTIONS}, m AS (SELECT document_id, sheet, item_id, x, y, CASE WHEN regexp_full_match(trim(text, ' '), '[0-9]{{1,3}}') THEN 'digit' ELSE 'letter' END AS kind FROM c WHERE regexp_full_match(trim(text, ' '), '[0-9]{{1,3}}') OR regexp_full_match(trim(text, ' '), '[A-ZА-Я]{{1,2}}')),
p AS (SELECT a.item_id AS letter_id, b.item_id AS digit_id FROM m a JOIN m b ON a.document_id = b.document_id AND a.kind = 'letter' AND b.kind = 'digit' AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 160000)
SELECT letter_id, digit_id FROM p QUALIFY count(*) OVER (PARTITION BY letter_id) = 1 AND count(*) OVER (PARTITION BY digit_id) = 1""",
    "block_definitions": """WITH j AS (SELECT block_name, '{' || concat_ws(',', CASE WHEN layer IS NOT NULL THEN '"layer":"' || layer || '"' END, CASE WHEN role IS NOT NULL THEN '"role":"' || role || '"' END, CASE WHEN units IS NOT NULL THEN '"units":"' || units || '"' END) || '}' AS o FROM symbol_instances WHERE block_name IS NOT NULL)
SELECT block_name, 'blockdef:' || sha256(string_agg(o, chr(10) ORDER BY o)) AS signature FROM j GROUP BY block_name""",
    "frame_covers": f"""WITH {_NOTES}, b AS (SELECT id, bbox.x0 x0, bbox.y0 y0, bbox.x1 x1, bbox.y1 y1 FROM n), p AS (SELECT id, k, x0 - 185 * dx AS sx0, y0 - 55 * dy AS sy0 FROM b, (VALUES (0, 0, 0), (1, 1, 0), (2, 0, 1), (3, 1, 1)) v(k, dx, dy)),
a AS (SELECT *, greatest(least(sx0 + 185, 420) - greatest(sx0, 0), 0) * greatest(least(sy0 + 55, 297) - greatest(sy0, 0), 0) AS area FROM p), s AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(area, 6) DESC, k) = 1)
SELECT id, x1 >= 0 AND x0 <= 420 AND y1 >= 0 AND y0 <= 297 AND x0 > -126 AND x1 < 546 AND y0 > -89.1 AND y1 < 386.1 AS on_sheet, greatest(least(x1, 420) - greatest(x0, 0), 0) * greatest(least(y1, 297) - greatest(y0, 0), 0) >= 0.85 * 420 * 297 AS covers, round(sx0, 6) AS sx0, round(sy0, 6) AS sy0 FROM b JOIN s USING (id)""",
    "caption_spans": "SELECT item_id, round(list_max(list_transform(string_split(text, chr(10)), lambda t: length(t))) * height * 0.8 * 0.6, 3) AS span FROM text_items WHERE text IS NOT NULL AND height IS NOT NULL",
    "type_labels": r"SELECT DISTINCT id, regexp_replace(trim(label, ' '), '^[0-9]+[ \t]+', '') AS label FROM legend_entries WHERE label IS NOT NULL",
    "sheet_kinds": f"""WITH {_CAPTIONS}, o AS (SELECT document_id, sheet, (max(x) - min(x)) * 2 w, (max(y) - min(y)) * 2 h, count(*) labels, count(DISTINCT text) u, count_if(regexp_matches(text, '^DN')) pipes, count_if(regexp_full_match(text, '[0-9]+')) numbers, sum(length(text)) chars FROM c GROUP BY ALL),
i AS (SELECT document_id, page::INTEGER AS sheet, count(*) inserts FROM symbol_instances GROUP BY ALL), a AS (SELECT o.*, coalesce(inserts, 0) AS inserts, greatest(w, h) >= 1100 OR (greatest(w, h) >= 900 AND least(w, h) >= 700) AS big, greatest(w, h) / greatest(least(w, h), 1) >= 1.6 AND greatest(w, h) >= 1000 AS wide FROM o LEFT JOIN i USING (document_id, sheet)),
k AS (SELECT *, CASE WHEN big AND (labels >= 40 OR u >= 15 OR pipes >= 8 OR wide) THEN 'plan' WHEN big THEN 'scheme' WHEN numbers >= 40 THEN 'table' WHEN chars > 800 AND u < 8 THEN 'text' WHEN u >= 10 AND pipes >= 5 THEN 'mixed' ELSE 'text' END AS kind FROM a)
SELECT document_id, sheet, kind, CASE WHEN w / 40 <= 0 AND inserts = 0 THEN 'text' WHEN w / 40 >= 40 OR inserts >= 3 THEN 'plan' WHEN labels >= 5 * greatest(labels, 1) THEN 'plan' ELSE 'text' END AS vector_kind, labels < 3 OR kind IN ('plan', 'scheme', 'mixed') AS needs_model, big AS drawing FROM k""",
    "page_states": r"SELECT CASE WHEN trim(coalesce(text, ''), ' ') <> '' THEN 'text' WHEN text IS NULL THEN 'lost' WHEN n_chars = 0 THEN 'blank' ELSE 'drawing' END AS state, length(trim(coalesce(text, ''), ' ')) >= 600 AS only_text, nullif(lower(coalesce(nullif(regexp_extract(text, '(?im)^\s*[-*]?\s*kind:\s*`?([a-z]+)', 1), ''), regexp_extract(text, 'Тип листа \(эвристика\):\s*([a-z]+)', 1))), '') AS passport, count(*) AS pages FROM documents GROUP BY ALL",
    "level_sentences": f"""WITH d AS (SELECT document_id, count_if(coalesce(source = 'dimension', false)) AS total, count_if(coalesce(source = 'dimension', false) AND {_LEVEL}) AS found, coalesce(list_sort(list(DISTINCT text) FILTER (WHERE source = 'dimension' AND NOT {_LEVEL})), []) AS s FROM text_items WHERE text IS NOT NULL AND document_id IS NOT NULL GROUP BY document_id)
SELECT document_id, CASE WHEN total = 0 THEN 'в описании нет чисел' WHEN len(s) = 0 THEN 'все ' || total || ' чисел описания найдены в документе' ELSE found || ' из ' || total || ' чисел описания найдены в документе; не найдены: ' || array_to_string(s[1:12], '; ') END AS sentence FROM d""",
    "stripped_pages": r"""SELECT doc_id, md5(trim(regexp_replace(text, '^## Страница[^\n]*\n?', ''), ' ')) AS body,
md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '<\|[^|>]*\|>', '', 'g'), '(?i)</t[dh]>', ' | ', 'g'), '(?i)</tr>', ' |' || chr(10), 'g'), '(?i)</?(table|tbody|thead|tr|td|th)[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g')) AS tiles,
md5(""" + _SQ.format(c=r"translate(lower(regexp_replace(regexp_replace(text, '(?s)<think>.*?</think>', '', 'g'), '(?s)<think>.*$', '')), 'ёЁ', 'еЕ')") + ") AS normal FROM documents WHERE text IS NOT NULL",
    "best_titles": "WITH a AS (SELECT sheet_key, max(title) AS title FROM stamps_archive WHERE sheet_key IS NOT NULL GROUP BY 1), k AS (SELECT sheet_key, max(title) AS title FROM stamps_kit WHERE sheet_key IS NOT NULL GROUP BY 1) SELECT sheet_key, coalesce(k.title, a.title) AS title, nullif(concat_ws(chr(10) || chr(10), '### kit' || chr(10) || k.title, '### archive' || chr(10) || a.title), '') AS both FROM a FULL JOIN k USING (sheet_key)",
    "zipped_stamps": "WITH a AS (SELECT document_id, sheet_key, row_number() OVER (PARTITION BY document_id ORDER BY sheet_key) AS n FROM (SELECT DISTINCT document_id, sheet_key FROM stamps_kit WHERE sheet_key IS NOT NULL AND document_id IS NOT NULL)), b AS (SELECT document_id, sheet_key, row_number() OVER (PARTITION BY document_id ORDER BY sheet_key) AS n FROM (SELECT DISTINCT document_id, sheet_key FROM stamps_archive WHERE sheet_key IS NOT NULL AND document_id IS NOT NULL)) SELECT document_id, a.sheet_key AS kit_key, b.sheet_key AS archive_key FROM a JOIN b USING (document_id, n)",
    "sole_bindings": "WITH p AS (SELECT DISTINCT instance_id, legend_entry_id FROM symbol_bindings WHERE instance_id IS NOT NULL AND legend_entry_id IS NOT NULL) SELECT instance_id, legend_entry_id FROM p QUALIFY count(*) OVER (PARTITION BY instance_id) = 1 AND count(*) OVER (PARTITION BY legend_entry_id) = 1",
    "title_likeness": "WITH k AS (SELECT sheet_key, max(title) AS a FROM stamps_kit WHERE sheet_key IS NOT NULL AND title IS NOT NULL GROUP BY 1), r AS (SELECT sheet_key, max(title) AS b FROM stamps_archive WHERE sheet_key IS NOT NULL AND title IS NOT NULL GROUP BY 1), w AS (SELECT sheet_key, list_distinct(string_split(lower(a), ' ')) AS a, list_distinct(string_split(lower(b), ' ')) AS b FROM k JOIN r USING (sheet_key)) SELECT sheet_key, round(100.0 * len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6)::DOUBLE AS likeness FROM w",
    "trimmed_tables": _CELLS + r""", w AS (SELECT doc_id, table_no, max(col) + 1 AS width FROM cell GROUP BY ALL), k AS (SELECT c.doc_id, c.table_no, col FROM cell c JOIN w USING (doc_id, table_no) GROUP BY ALL HAVING count_if(trim(cell, ' ') <> '') >= CASE WHEN max(width) > 6 THEN 2 ELSE 1 END), r AS (SELECT DISTINCT doc_id, table_no, "row" FROM cell SEMI JOIN k USING (doc_id, table_no, col) WHERE trim(cell, ' ') <> '')
SELECT doc_id, table_no, (SELECT count(*) FROM r WHERE r.doc_id = w.doc_id AND r.table_no = w.table_no) AS rows, (SELECT count(*) FROM k WHERE k.doc_id = w.doc_id AND k.table_no = w.table_no) AS columns FROM w""",
    "stamp_rows": """WITH t AS (SELECT document_id, page, lower(text) AS l, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY document_id, page) AS n FROM stamp_items WHERE text IS NOT NULL AND document_id IS NOT NULL WINDOW w AS (PARTITION BY document_id, page ORDER BY item_id, text)),
p AS (SELECT document_id, page, n, max(i) FILTER (WHERE contains(l, 'лист')) AS a FROM t GROUP BY ALL)
SELECT document_id, page, (n // 2)::INTEGER AS start FROM p WHERE a >= n // 2""",
    "grown_findings": "WITH f AS (SELECT document_id, tool, month(found_at) >= 7 AS late, sum(n_found)::BIGINT AS n FROM findings WHERE document_id IS NOT NULL AND tool IS NOT NULL AND n_found IS NOT NULL AND found_at IS NOT NULL GROUP BY ALL) SELECT a.document_id, a.tool, a.n, coalesce(b.n, 0) AS before FROM f a LEFT JOIN f b ON b.document_id = a.document_id AND b.tool = a.tool AND NOT b.late WHERE a.late AND a.n > coalesce(b.n, 0)",
    "page_passes": r"""WITH s AS (SELECT doc_id, unnest(p) AS part, unnest(range(len(p))) AS n FROM (SELECT doc_id, string_split(chr(10) || text, chr(10) || '### PASS-') AS p FROM documents WHERE text IS NOT NULL)), q AS (SELECT doc_id, n, regexp_extract('PASS-' || part, '^(PASS-[^ \n]+)', 1) AS pass, trim(regexp_replace('PASS-' || part, '^[^\n]*\n?', ''), ' ') AS body FROM s WHERE n > 0)
SELECT doc_id, pass, md5(arg_min(body, n)) AS digest FROM q GROUP BY doc_id, pass""",
    "split_lines": f"SELECT doc_id, len(string_split(replace(text, chr(13), ''), chr(10)))::BIGINT AS lines, len(list_distinct(list_transform(regexp_extract_all(text, '{T.TOKEN}'), lambda t: lower(t))))::BIGINT AS tokens FROM documents WHERE text IS NOT NULL",
    "restarted_states": "WITH l AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS s FROM events GROUP BY user_id) SELECT CASE WHEN s = 'view' THEN 'queued' ELSE s END AS state, count(*) AS users FROM l GROUP BY 1",
    "summed_usage": "SELECT tool, unnest(['found', 'calls']) AS name, unnest([sum(n_found)::BIGINT, count(*)::BIGINT]) AS value FROM findings WHERE tool IS NOT NULL AND n_found IS NOT NULL GROUP BY tool",
}
