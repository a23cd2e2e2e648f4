"""Registered queries of composites: fused readings, blocks, claims, frames and leftovers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import catalog as C
from ..operators import geometry as G
from ..operators import layouts as Y
from ..operators import lines as L
from ..operators import matching as M
from ..operators import recon as R
from ..session import table
from .kits import _sides
from .texts import _LN, _SQ


def _side_lines(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Content lines of all readings of a page and side, one reading after the other."""
    order = F.row_number().over(Window.partitionBy("kit", "page").orderBy("doc_id", "pos", "line"))
    return tuple(L.content_lines(L.lines(x, ["kit", "page", "doc_id"])).withColumn("pos", order).drop("doc_id") for x in _sides(spark, d))


def fused_pages(spark: SparkSession, d: str) -> DataFrame:
    a, b = _side_lines(spark, d)
    return R.fused_lines(a, b, ["kit", "page"]).groupBy("kit", "page").agg(F.count("*").alias("added"))


def heading_blocks(spark: SparkSession, d: str) -> DataFrame:
    return L.heading_blocks(L.lines(table(spark, d, "documents"), ["doc_id"]), ["doc_id"])


def anchor_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.lines_within(L.lines(table(spark, d, "documents"), ["doc_id"]), ["doc_id"], 600).groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


def shown_labels(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "text_items").filter("text is not null").select("document_id", "sheet", F.col("item_id").alias("pos"), F.col("text").alias("line"))
    return L.shown_labels(items, ["document_id", "sheet"]).groupBy("document_id", "sheet").agg(F.count("*").alias("labels"), F.count_if(F.col("line").endswith("схлопнуто)")).alias("folded"))


def missing_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles of the kit's stamps that stand in no title of the archive's stamps of the document."""
    titles = lambda t: table(spark, d, t).select("document_id", F.col("title").alias("text"))
    return R.missing_texts(titles("stamps_kit"), titles("stamps_archive"), ["document_id"])


def claimed_captions(spark: SparkSession, d: str) -> DataFrame:
    """Dimensions in order of id claim the nearest free caption of their sheet within 40 mm."""
    items = table(spark, d, "text_items").filter("x is not null and y is not null and document_id is not null and sheet is not null and text is not null")
    marks = items.filter("source = 'dimension'").withColumnRenamed("item_id", "mark")
    return M.greedy_claims(marks, items.filter("source = 'text'"), ["document_id", "sheet"], left_id="mark", right_id="item_id", value="text", radius=40.0).select("mark", "item_id", "status")


def frame_signatures(spark: SparkSession, d: str) -> DataFrame:
    boxes = table(spark, d, "legend_entries").filter("bbox is not null").select("document_id", "page", F.struct(*[(F.round(F.col(f"bbox.{c}") / 100) * 100).alias(c) for c in ("x0", "y0", "x1", "y1")]).alias("b")).select("document_id", "page", "b.*")
    return G.frame_signatures(boxes, "document_id", "page", share=0.01, least=2)


def box_texts(spark: SparkSession, d: str) -> DataFrame:
    notes = table(spark, d, "note_texts").filter("bbox is not null and text is not null").dropDuplicates(["id"])
    cells = notes.select("document_id", "page", F.col("id").alias("cell_id"), "bbox.*")
    return G.cell_texts(notes.select("document_id", "page", "x", "y", "text"), cells, ["document_id", "page"], "cell_id", "text", 50.0).select("cell_id", F.length("text").alias("chars"))


def row_clusters(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "text_items").filter("document_id is not null and sheet is not null")
    return G.median_clusters(items, ["document_id", "sheet"], "y", 6.0).groupBy("document_id", "sheet").agg((F.max("cluster") + 1).alias("clusters"))


def unused_signatures(spark: SparkSession, d: str) -> DataFrame:
    return C.orphan_definitions(table(spark, d, "legend_entries").filter("label is not null"), table(spark, d, "symbol_instances").select("signature"), "signature").select("signature", "n")


def lost_fields(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose archive stamps lost a field that the kit's stamps have."""
    flag = F.coalesce(F.trim("sheets_total") != "", F.lit(False)).alias("has")
    side = lambda t: table(spark, d, t).select("document_id", flag)
    return C.field_loss(side("stamps_kit"), side("stamps_archive"), ["document_id"], "has")


def sheet_views(spark: SparkSession, d: str) -> DataFrame:
    return Y.views(table(spark, d, "text_items").filter("document_id is not null and sheet is not null")).select("document_id", "sheet", "view", "title")


def layer_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes of a page by its notes layer: what stands below the layer's uppermost text."""
    notes = table(spark, d, "note_texts").filter("layer = 'ПРИМЕЧАНИЯ' and document_id is not null").dropDuplicates(["id"])
    head = notes.groupBy("document_id", "page").agg(F.max("y").alias("top"))
    return notes.join(head, ["document_id", "page"]).filter("y < top").select("document_id", "page", "id")


def soil_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "legend_entries").filter("label is not null").groupBy(C.is_soil_fill(F.col("label")).alias("soil"), C.is_wrapped_label(F.array("label")).alias("wrapped")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (fused_pages, heading_blocks, anchor_lines, shown_labels, missing_titles, claimed_captions, frame_signatures, box_texts, row_clusters, unused_signatures, lost_fields, sheet_views, layer_notes, soil_labels)}

_FOLDED = f"lower({_SQ.format(c='{c}')})"
ORACLE = {
    "heading_blocks": _LN + r""", h AS (SELECT doc_id, pos, trim(regexp_replace(line, '^#+ +', ''), ' ') AS title FROM ln WHERE regexp_matches(line, '^#{2,6} +(PASS-|SRC-|Страница )')), n AS (SELECT doc_id, count(*) AS lines FROM ln GROUP BY doc_id)
SELECT doc_id, (row_number() OVER w)::INTEGER AS block, title, pos::INTEGER AS start, coalesce(lead(pos) OVER w, lines)::INTEGER AS "end" FROM h JOIN n USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
UNION ALL SELECT doc_id, 1, 'Лист', 0, lines::INTEGER FROM n WHERE doc_id NOT IN (SELECT doc_id FROM h)""",
    "anchor_lines": _LN + f", k AS (SELECT *, {_FOLDED.format(c='line')} AS k FROM ln), f AS (SELECT * FROM k WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY doc_id, k ORDER BY pos) = 1), s AS (SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS t FROM f) SELECT doc_id, count(*) AS lines, sum(length(line))::BIGINT AS chars FROM s WHERE t <= 600 GROUP BY doc_id",
    "shown_labels": "WITH c AS (SELECT document_id, sheet, text, count(*) AS n FROM text_items WHERE text IS NOT NULL GROUP BY ALL) SELECT document_id, sheet, sum(CASE WHEN n >= 4 THEN 1 ELSE n END)::BIGINT AS labels, count_if(n >= 4)::BIGINT AS folded FROM c GROUP BY document_id, sheet",
    "missing_titles": f"WITH a AS (SELECT DISTINCT document_id, {_FOLDED.format(c='title')} AS t FROM stamps_kit WHERE title IS NOT NULL), b AS (SELECT DISTINCT document_id, {_FOLDED.format(c='title')} AS t FROM stamps_archive WHERE title IS NOT NULL) SELECT document_id, t AS text FROM a WHERE t <> '' AND NOT EXISTS (SELECT 1 FROM b WHERE b.document_id = a.document_id AND b.t <> '' AND contains(b.t, a.t))",
    "frame_signatures": "WITH b AS (SELECT document_id, page, (round(bbox.x0 / 100) * 100)::INTEGER AS x0, (round(bbox.y0 / 100) * 100)::INTEGER AS y0, (round(bbox.x1 / 100) * 100)::INTEGER AS x1, (round(bbox.y1 / 100) * 100)::INTEGER AS y1 FROM legend_entries WHERE bbox IS NOT NULL), p AS (SELECT document_id, count(DISTINCT page) AS pages FROM b GROUP BY document_id), s AS (SELECT document_id, x0, y0, x1, y1, count(DISTINCT page) AS on_pages FROM b GROUP BY ALL) SELECT s.*, pages FROM s JOIN p USING (document_id) WHERE on_pages >= 2 AND on_pages >= pages * 0.01",
    "box_texts": "WITH n AS (SELECT DISTINCT id, document_id, page, x, y, bbox, text FROM note_texts WHERE bbox IS NOT NULL AND text IS NOT NULL) SELECT c.id AS cell_id, (sum(length(p.text)) + count(*) - 1)::INTEGER AS chars FROM n c JOIN n p ON p.document_id = c.document_id AND p.page = c.page AND p.x >= c.bbox.x0 AND p.x <= c.bbox.x1 AND p.y >= c.bbox.y0 AND p.y <= c.bbox.y1 GROUP BY c.id",
    "unused_signatures": "WITH u AS (SELECT signature, count(*) AS n, list_sort(list(DISTINCT label)) AS c FROM legend_entries WHERE label IS NOT NULL AND signature IS NOT NULL AND signature NOT IN (SELECT signature FROM symbol_instances WHERE signature IS NOT NULL) GROUP BY signature) SELECT min(signature) AS signature, max(n) AS n FROM u GROUP BY c",
    "lost_fields": "WITH a AS (SELECT document_id, count(*) AS source_rows, count_if(coalesce(trim(sheets_total,' ') <> '', false))::BIGINT AS source_with FROM stamps_kit GROUP BY 1), b AS (SELECT document_id, count(*) AS parsed_rows, count_if(coalesce(trim(sheets_total,' ') <> '', false))::BIGINT AS parsed_with FROM stamps_archive GROUP BY 1), j AS (SELECT a.*, coalesce(parsed_rows, 0) AS parsed_rows, coalesce(parsed_with, 0) AS parsed_with FROM a LEFT JOIN b USING (document_id)) SELECT *, CASE WHEN parsed_with = 0 THEN 'lost' ELSE 'weak' END AS verdict FROM j WHERE source_with >= 10 AND source_with / source_rows >= 0.02 AND (parsed_with = 0 OR parsed_with / parsed_rows < source_with / source_rows / 4)",
    "sheet_views": r"""WITH h AS (SELECT document_id, sheet, trim(text, ' ') AS text, x, y, x + length(text) * greatest(coalesce(height, 2.5), 0.1) * 0.55 AS r, y + greatest(coalesce(height, 2.5), 0.1) AS t FROM text_items
  WHERE x IS NOT NULL AND y IS NOT NULL AND text IS NOT NULL AND document_id IS NOT NULL AND sheet IS NOT NULL AND coalesce(source IN ('text', 'mtext'), true) AND regexp_matches(trim(text, ' '), '(?i)^(схем[а-яё]*\s+расположен|(геологическ[а-яё]*\s+)?разрез([^а-яё]|$)|по\s+лини|[IVX]+ *[-–] *[IVX]+)')),
a AS (SELECT *, CASE WHEN x - max(r) OVER (PARTITION BY document_id, sheet ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 18 THEN 1 ELSE 0 END AS b FROM h), s AS (SELECT *, sum(b) OVER (PARTITION BY document_id, sheet ORDER BY x) AS strip FROM a),
c AS (SELECT *, CASE WHEN y - max(t) OVER (PARTITION BY document_id, sheet, strip ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 18 THEN 1 ELSE 0 END AS d FROM s), g AS (SELECT *, sum(d) OVER (PARTITION BY document_id, sheet, strip ORDER BY y) AS grp FROM c),
n AS (SELECT document_id, sheet, strip, grp, text, min((-y, x)) AS o FROM g GROUP BY ALL), m AS (SELECT document_id, sheet, strip, grp, string_agg(text, ' ' ORDER BY o, text) AS title FROM n GROUP BY ALL),
k AS (SELECT document_id, sheet, strip, grp, (min(x) + max(r)) / 2 AS middle, min(y) + max(t) AS height FROM g GROUP BY ALL), v AS (SELECT *, CASE WHEN middle - lag(middle) OVER (PARTITION BY document_id, sheet ORDER BY middle) > 80 THEN 1 ELSE 0 END AS new FROM k JOIN m USING (document_id, sheet, strip, grp)),
w AS (SELECT *, sum(new) OVER (PARTITION BY document_id, sheet ORDER BY middle) AS cluster FROM v) SELECT document_id, sheet, (row_number() OVER (PARTITION BY document_id, sheet ORDER BY cluster, height, title) - 1)::INTEGER AS view, title FROM w""".replace("\\\\", "\\"),
    "layer_notes": "WITH n AS (SELECT DISTINCT id, document_id, page, y FROM note_texts WHERE layer = 'ПРИМЕЧАНИЯ' AND document_id IS NOT NULL), h AS (SELECT *, max(y) OVER (PARTITION BY document_id, page) AS top FROM n) SELECT document_id, page, id FROM h WHERE y < top",
    "soil_labels": "SELECT regexp_matches(translate(lower(label), 'ёЁ', 'еЕ'), 'песок|песч|суглин|супес|глин|насып|почв|торф|щебен|гравий') AND NOT regexp_matches(translate(lower(label), 'ёЁ', 'еЕ'), 'вод|дата|уровень|границ|скважин') AS soil, length(label) >= 40 OR regexp_matches(lower(trim(label,' ')), '(,|-| и| в| на| с| для| из| по)$') AS wrapped, count(*) AS n FROM legend_entries WHERE label IS NOT NULL GROUP BY ALL",
}
