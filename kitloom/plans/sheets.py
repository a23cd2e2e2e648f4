"""Registered queries of matching, geometry, catalogues, findings and queue state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import catalog as C
from ..operators import geometry as G
from ..operators import matching as M
from ..session import table
from ..streaming import jobs as J

#: The paper of the test sheets, for zones.
SHEET_W, SHEET_H = 841.0, 594.0


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, name)


def signature_matches(spark: SparkSession, d: str) -> DataFrame:
    """Instances bound to the only legend label that owns their signature."""
    legends = _t(spark, d, "legend_entries").filter("label is not null and signature is not null").select("signature", T.label_key(F.col("label")).alias("label"))
    marks = _t(spark, d, "symbol_instances").filter("signature is not null").select("id", "signature").distinct()
    return M.unique_match(marks, legends, ["signature"], "label")


def overlap_matches(spark: SparkSession, d: str) -> DataFrame:
    """Legend labels and the reference sign that shares most terms with each, if only one does."""
    left = _t(spark, d, "legend_entries").filter("label is not null").select("label", F.explode(T.context_terms(F.col("label"))).alias("term")).distinct()
    right = _t(spark, d, "legend_reference").select("ref_id", F.explode(T.context_terms(F.col("label"))).alias("term")).distinct()
    return M.max_overlap(left, right, left_id="label", right_id="ref_id")


def cut_texts(spark: SparkSession, d: str) -> DataFrame:
    items = _t(spark, d, "text_items").filter("text is not null")
    return M.prefix_matches(items, items, head="text", whole="text", shortest=16)


def texts_in_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Notes whose point lies in the box of another note of the page."""
    notes = _t(spark, d, "note_texts").filter("bbox is not null").dropDuplicates(["id"])
    boxes = notes.select("document_id", "page", F.col("id").alias("box_id"), "bbox.*")
    found = M.points_in_boxes(notes.select("document_id", "page", "id", "x", "y"), boxes, ["document_id", "page"], cell=50.0, half_open=True)
    return found.select("id", "box_id")


def nearest_texts(spark: SparkSession, d: str) -> DataFrame:
    """The nearest caption of each dimension on its sheet within 40 mm."""
    items = _t(spark, d, "text_items").filter("x is not null and y is not null").select("document_id", "sheet", "source", "item_id", "x", "y")
    sizes = items.filter("source = 'dimension'").withColumnRenamed("item_id", "mark")
    return M.nearest(sizes, items.filter("source = 'text'"), ["document_id", "sheet"], left_id="mark", right_id="item_id", radius=40.0).select("mark", "item_id")


def schedule_notes(spark: SparkSession, d: str) -> DataFrame:
    """Stamps of the kit with the archive's stage by document and sheet."""
    rows = _t(spark, d, "stamps_archive").filter("sheet is not null and stage is not null").select("document_id", "sheet", "stage")
    marks = _t(spark, d, "stamps_kit").select("sheet_key", "document_id", "sheet").distinct()
    return M.joined_schedule(marks, rows, ["document_id", "sheet"], "stage").select("sheet_key", "sheet", "stage", "note")


def source_links(spark: SparkSession, d: str) -> DataFrame:
    """Variants linked to the other file of their name or path, by either key."""
    v = _t(spark, d, "variants").select("variant_id", F.nullif("job_id", F.lit("")).alias("job"), F.nullif("run_dir", F.lit("")).alias("run"))
    return M.any_key_match(v, v.select(F.col("variant_id").alias("other"), F.col("job").alias("o_job"), F.col("run").alias("o_run")), "variant_id", "other", [("job", "o_job"), ("run", "o_run")]).select("variant_id", "other", "status")


def column_clusters(spark: SparkSession, d: str) -> DataFrame:
    items = _t(spark, d, "text_items").filter("x is not null")
    c = G.gap_clusters(items.select("document_id", "sheet", "x").distinct(), ["document_id", "sheet"], "x", 12.0)
    return c.groupBy("document_id", "sheet", "cluster").agg(F.count("*").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"))


def note_zones(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "note_texts").filter("bbox is not null")
    z = G.zone(F.col("bbox.x0"), F.col("bbox.y0"), F.col("bbox.x1"), F.col("bbox.y1"), F.lit(SHEET_W), F.lit(SHEET_H), y_up=True)
    return n.groupBy(z.alias("zone")).agg(F.count("*").alias("n"))


def text_places(spark: SparkSession, d: str) -> DataFrame:
    """The place of every caption of a sheet."""
    items = _t(spark, d, "text_items").filter("x is not null and y is not null and text is not null")
    return G.reading_order(items.select("document_id", "sheet", "x", "y", "text").distinct(), ["document_id", "sheet"]).select("document_id", "sheet", "place", "text")


def text_line_groups(spark: SparkSession, d: str) -> DataFrame:
    return G.text_lines(_t(spark, d, "text_items"))


def outer_boxes(spark: SparkSession, d: str) -> DataFrame:
    boxes = _t(spark, d, "note_texts").filter("bbox is not null").select("document_id", "page", "id", "bbox.*").dropDuplicates(["id"])
    return G.outermost(boxes, ["document_id", "page"], "id", 60.0).select("id")


def linked_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Connected groups of symbols over relationships."""
    edges = _t(spark, d, "relationships").filter("source_id is not null and target_id is not null").select(F.lower(F.trim("source_id")).alias("a"), F.lower(F.trim("target_id")).alias("b")).distinct()
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    return G.components(nodes, edges, "node", "a", "b")


def page_spans(spark: SparkSession, d: str) -> DataFrame:
    return G.span_text(_t(spark, d, "legend_entries").filter("page is not null"), ["document_id"], "page")


def file_catalog(spark: SparkSession, d: str) -> DataFrame:
    return C.file_catalog(_t(spark, d, "legend_entries"), ["document_id"])


def project_catalog(spark: SparkSession, d: str) -> DataFrame:
    return C.project_catalog(_t(spark, d, "legend_entries"))


def unique_signatures(spark: SparkSession, d: str) -> DataFrame:
    return C.unique_signatures(_t(spark, d, "legend_entries"), ["document_id"])


def symbol_types(spark: SparkSession, d: str) -> DataFrame:
    return C.symbol_types(_t(spark, d, "symbol_instances"))


def insert_roles(spark: SparkSession, d: str) -> DataFrame:
    i = _t(spark, d, "symbol_instances")
    return i.groupBy("role", C.insert_role(F.col("layer"), F.col("block_name"), F.col("role"), F.col("status")).alias("judged")).agg(F.count("*").alias("n"))


def symbol_integrity(spark: SparkSession, d: str) -> DataFrame:
    return C.integrity(_t(spark, d, "symbol_instances"), _t(spark, d, "legend_entries"), _t(spark, d, "symbol_bindings"), _t(spark, d, "relationships"))


def number_findings(spark: SparkSession, d: str) -> DataFrame:
    return C.number_findings(_t(spark, d, "text_items"))


def layer_stats(spark: SparkSession, d: str) -> DataFrame:
    return C.layer_stats(_t(spark, d, "text_items"))


def finding_totals(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "findings").groupBy("tool", "severity").agg(F.count("*").alias("n"), F.sum("n_found").alias("found"), F.sum(F.size(F.coalesce("examples", F.array()))).alias("examples"))


def changed_instances(spark: SparkSession, d: str) -> DataFrame:
    """Symmetric difference of two readings: instances' and bindings' legend references."""
    a = _t(spark, d, "symbol_instances").filter("legend_entry_id is not null").select(F.col("id").alias("symbol"), "legend_entry_id")
    b = _t(spark, d, "symbol_bindings").filter("legend_entry_id is not null and instance_id is not null").select(F.col("instance_id").alias("symbol"), "legend_entry_id")
    return C.symmetric_difference(a, b)


def lanes(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "variants").groupBy(J.lane(F.col("source_path")).alias("lane")).agg(F.count("*").alias("n"))


def latest_state(spark: SparkSession, d: str) -> DataFrame:
    return J.latest_state(_t(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), "user_id").select("user_id", "event_id", "event_type")


def next_in_lane(spark: SparkSession, d: str) -> DataFrame:
    return J.next_in_lane(_t(spark, d, "events").select("event_type", "event_id", "user_id"), "event_type", "event_id")


def pages_to_resume(spark: SparkSession, d: str) -> DataFrame:
    """Sheets of the archive that the kit has no stamp of."""
    return J.missing_pages(_t(spark, d, "stamps_archive").select("document_id", "page").distinct(), _t(spark, d, "stamps_kit"), ["document_id", "page"])


def event_page(spark: SparkSession, d: str) -> DataFrame:
    return J.page_delta(_t(spark, d, "events").select("event_id", "user_id"), 500, 50, "event_id")


def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    return J.sessions(_t(spark, d, "events"), "user_id").select("user_id", "started", "events")


def hourly_events(spark: SparkSession, d: str) -> DataFrame:
    return J.tumbling(_t(spark, d, "events"), "event_type")


def job_outcomes(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("total"), F.count_if(F.col("event_type") == "purchase").alias("done"), F.count_if(F.col("event_type") == "error").alias("failed"))
    return e.select("user_id", J.job_outcome(F.col("done") + F.col("failed"), F.col("done"), F.col("failed"), F.lit(False)).alias("outcome"))


QUERIES = {f.__name__: f for f in (signature_matches, overlap_matches, cut_texts, texts_in_boxes, nearest_texts, schedule_notes, source_links, column_clusters, note_zones, text_places, text_line_groups, outer_boxes, linked_symbols, page_spans, file_catalog, project_catalog, unique_signatures, symbol_types, insert_roles, symbol_integrity, number_findings, layer_stats, finding_totals, changed_instances, lanes, latest_state, next_in_lane, pages_to_resume, event_page, event_sessions, hourly_events, job_outcomes)}

_LBL = "trim(regexp_replace(regexp_replace(translate(lower(label), 'ёЁ', 'еЕ'), '[^A-Za-zА-Яа-яЁё0-9]+', ' ', 'g'), '([0-9]) (мм|см|м|кв|л)( |$)', '\\1\\2\\3', 'g'), ' ')"
_NAMED = f"WITH n AS (SELECT *, {_LBL} AS k FROM legend_entries WHERE label IS NOT NULL AND {_LBL} <> '')"
_END = "(иями|ями|ами|ого|его|ому|ему|ыми|ими|ией|иях|ах|ях|ый|ий|ой|ая|яя|ое|ее|ые|ие|ую|юю|ов|ев|ей|ом|ем|ам|ям|а|я|о|е|ы|и|у|ю|ь)$"


def _terms(key: str, name: str) -> str:
    return f"SELECT DISTINCT {key}, CASE WHEN length(c) >= 4 THEN c ELSE w END AS term FROM (SELECT {key}, w, regexp_replace(w, '{_END}', '') AS c FROM (SELECT {key}, unnest(regexp_extract_all(translate(lower(label), 'ёЁ', 'еЕ'), '[а-яa-z]{{4,}}')) AS w FROM {name} WHERE label IS NOT NULL))"


ORACLE = {
    "signature_matches": f"WITH o AS (SELECT signature, min({_LBL}) AS label, count(DISTINCT {_LBL}) AS n FROM legend_entries WHERE label IS NOT NULL AND signature IS NOT NULL GROUP BY signature), m AS (SELECT DISTINCT id, signature FROM symbol_instances WHERE signature IS NOT NULL) SELECT m.id, m.signature, CASE WHEN n = 1 THEN label END AS label, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE 'matched' END AS reason FROM m LEFT JOIN o USING (signature)",
    "overlap_matches": f"WITH a AS ({_terms('label', 'legend_entries')}), b AS ({_terms('ref_id', 'legend_reference')}), s AS (SELECT label, ref_id, count(*) AS overlap FROM a JOIN b USING (term) GROUP BY ALL), m AS (SELECT *, max(overlap) OVER (PARTITION BY label) AS best FROM s) SELECT label, CASE WHEN count(*) = 1 THEN min(ref_id) END AS ref_id, overlap, count(*) AS ties FROM m WHERE overlap = best GROUP BY label, overlap",
    "cut_texts": "WITH t AS (SELECT DISTINCT text FROM text_items WHERE text IS NOT NULL) SELECT a.text AS head, min(b.text) AS whole FROM t a JOIN t b ON left(a.text, 16) = left(b.text, 16) AND length(b.text) > length(a.text) AND starts_with(b.text, a.text) WHERE length(a.text) >= 16 GROUP BY a.text",
    "texts_in_boxes": "WITH b AS (SELECT DISTINCT id, document_id, page, x, y, bbox FROM note_texts WHERE bbox IS NOT NULL) SELECT a.id, b.id AS box_id FROM b a JOIN b ON a.document_id = b.document_id AND a.page = b.page AND a.x >= b.bbox.x0 AND a.y >= b.bbox.y0 AND a.x < b.bbox.x1 AND a.y < b.bbox.y1",
    "nearest_texts": "WITH p AS (SELECT m.item_id AS mark, t.item_id, (m.x - t.x) * (m.x - t.x) + (m.y - t.y) * (m.y - t.y) AS d2 FROM text_items m JOIN text_items t ON m.document_id = t.document_id AND m.sheet = t.sheet AND m.source = 'dimension' AND t.source = 'text') SELECT mark, arg_min(item_id, struct_pack(d := d2, i := item_id)) AS item_id FROM p WHERE d2 <= 1600 GROUP BY mark",
    "schedule_notes": "WITH r AS (SELECT document_id, sheet, min(stage) AS stage, count(DISTINCT stage) AS n FROM stamps_archive WHERE sheet IS NOT NULL AND stage IS NOT NULL GROUP BY ALL), m AS (SELECT DISTINCT sheet_key, document_id, sheet FROM stamps_kit), d AS (SELECT DISTINCT document_id FROM r) SELECT m.sheet_key, m.sheet, CASE WHEN n = 1 THEN stage END AS stage, CASE WHEN n = 1 THEN 'table' WHEN n > 1 THEN 'conflict' WHEN d.document_id IS NOT NULL THEN 'no row' ELSE 'no table' END AS note FROM m LEFT JOIN r ON m.document_id = r.document_id AND m.sheet = r.sheet LEFT JOIN d ON m.document_id = d.document_id",
    "source_links": "WITH v AS (SELECT variant_id, nullif(job_id, '') AS job, nullif(run_dir, '') AS run FROM variants), h AS (SELECT a.variant_id, b.variant_id AS other FROM v a JOIN v b ON a.job = b.job UNION SELECT a.variant_id, b.variant_id FROM v a JOIN v b ON a.run = b.run), c AS (SELECT variant_id, count(DISTINCT other) AS n, min(other) AS other FROM h GROUP BY variant_id) SELECT v.variant_id, CASE WHEN n = 1 THEN other END AS other, CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'resolved' ELSE 'ambiguous' END AS status FROM v LEFT JOIN c USING (variant_id)",
    "column_clusters": "WITH t AS (SELECT DISTINCT document_id, sheet, x FROM text_items WHERE x IS NOT NULL), g AS (SELECT *, CASE WHEN x - lag(x) OVER w > 12 THEN 1 ELSE 0 END AS g FROM t WINDOW w AS (PARTITION BY document_id, sheet ORDER BY x)), c AS (SELECT *, sum(g) OVER (PARTITION BY document_id, sheet ORDER BY x)::BIGINT AS cluster FROM g) SELECT document_id, sheet, cluster, count(*) AS n, min(x) AS x0, max(x) AS x1 FROM c GROUP BY ALL",
    "note_zones": f"WITH z AS (SELECT (bbox.x0 + bbox.x1) / 2 / {SHEET_W} AS cx, (bbox.y0 + bbox.y1) / 2 / {SHEET_H} AS cy, (bbox.x1 - bbox.x0) / {SHEET_W} AS w, (bbox.y1 - bbox.y0) / {SHEET_H} AS h FROM note_texts WHERE bbox IS NOT NULL), n AS (SELECT CASE WHEN w >= 0.7 AND h >= 0.7 THEN 'по всему листу' ELSE NULL END AS whole, CASE WHEN cy < 1/3 THEN 'юг' WHEN cy > 2/3 THEN 'север' ELSE '' END AS v, CASE WHEN cx < 1/3 THEN 'запад' WHEN cx > 2/3 THEN 'восток' ELSE '' END AS h FROM z) SELECT coalesce(whole, CASE WHEN v <> '' AND h <> '' THEN v || 'о-' || h ELSE coalesce(nullif(v || h, ''), 'центр') END) AS zone, count(*) AS n FROM n GROUP BY 1",
    "text_places": "WITH t AS (SELECT DISTINCT document_id, sheet, x, y, text FROM text_items WHERE x IS NOT NULL AND y IS NOT NULL AND text IS NOT NULL) SELECT document_id, sheet, (row_number() OVER (PARTITION BY document_id, sheet ORDER BY y DESC, x, text))::INTEGER AS place, text FROM t",
    "outer_boxes": "WITH b AS (SELECT DISTINCT document_id, page, id, bbox.x0 AS x0, bbox.y0 AS y0, bbox.x1 AS x1, bbox.y1 AS y1, (bbox.x1 - bbox.x0) * (bbox.y1 - bbox.y0) AS area FROM note_texts WHERE bbox IS NOT NULL) SELECT id FROM b a WHERE NOT EXISTS (SELECT 1 FROM b o WHERE o.document_id = a.document_id AND o.page = a.page AND a.x0 >= o.x0 AND a.y0 >= o.y0 AND a.x1 <= o.x1 AND a.y1 <= o.y1 AND (o.area > a.area OR (o.area = a.area AND o.id < a.id)))",
    "page_spans": "WITH p AS (SELECT DISTINCT document_id, page::BIGINT AS n FROM legend_entries WHERE page IS NOT NULL), i AS (SELECT *, n - row_number() OVER (PARTITION BY document_id ORDER BY n) AS i FROM p), r AS (SELECT document_id, min(n) AS a, max(n) AS b FROM i GROUP BY document_id, i) SELECT document_id, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '–' || b END, ', ' ORDER BY a) AS spans FROM r GROUP BY document_id",
    "file_catalog": _NAMED + ", s AS (SELECT document_id, signature FROM n WHERE signature IS NOT NULL GROUP BY ALL HAVING count(DISTINCT k) > 1), b AS (SELECT DISTINCT n.document_id, n.k FROM n JOIN s ON n.document_id = s.document_id AND n.signature = s.signature) SELECT n.document_id, n.k AS key_label, min(label) AS label, count(DISTINCT label) AS variants, count(DISTINCT page) AS pages, count(DISTINCT signature) AS signatures, CASE WHEN bool_or(b.k IS NOT NULL) THEN 'conflicting' ELSE 'consistent' END AS status FROM n LEFT JOIN b ON n.document_id = b.document_id AND n.k = b.k GROUP BY n.document_id, n.k",
    "project_catalog": _NAMED + ", s AS (SELECT signature FROM n WHERE signature IS NOT NULL GROUP BY ALL HAVING count(DISTINCT k) > 1), b AS (SELECT DISTINCT n.k FROM n JOIN s USING (signature)) SELECT n.k AS key_label, count(DISTINCT document_id) AS files, count(DISTINCT signature) AS signatures, CASE WHEN bool_or(b.k IS NOT NULL) THEN 'conflicting' WHEN count_if(status = 'unmatched') = count(*) THEN 'external_only' WHEN count(DISTINCT signature) = 0 THEN 'text_only' ELSE 'consistent' END AS status FROM n LEFT JOIN b ON n.k = b.k GROUP BY n.k",
    "unique_signatures": f"SELECT document_id, signature, min({_LBL}) AS key_label FROM legend_entries WHERE label IS NOT NULL AND signature IS NOT NULL GROUP BY document_id, signature HAVING count(DISTINCT {_LBL}) = 1",
    "symbol_types": "WITH c AS (SELECT signature, block_name, count(*) AS n FROM symbol_instances WHERE signature IS NOT NULL AND block_name IS NOT NULL GROUP BY ALL), t AS (SELECT signature, block_name AS name FROM c QUALIFY row_number() OVER (PARTITION BY signature ORDER BY n DESC, block_name) = 1), s AS (SELECT signature, count(*) AS inserts, count(DISTINCT document_id) AS files, count_if(status = 'confirmed') AS confirmed FROM symbol_instances WHERE signature IS NOT NULL GROUP BY signature) SELECT s.*, t.name FROM s LEFT JOIN t USING (signature)",
    "insert_roles": "WITH i AS (SELECT role, status, lower(trim(coalesce(layer,''),' ')) AS l, lower(trim(coalesce(block_name,''),' ')) AS b FROM symbol_instances) SELECT role, CASE WHEN NOT coalesce(role = 'field_candidate' AND status IN ('unresolved','unclassified'), false) THEN role WHEN l = 'format' THEN 'sheet_furniture' WHEN l IN ('skv','probe','грунт') THEN 'geology_mark' WHEN starts_with(b, 'трап') AND l = 'технология' THEN 'drawing_object' WHEN l IN ('металл фахверк','стойки','fachverk','metall','metal','fundament','фундамент','beton') AND starts_with(b, '*') THEN 'drawing_object' WHEN l IN ('osi','оси') THEN 'specification_mark' WHEN l = '0' AND starts_with(b, 'номерация') THEN 'specification_mark' WHEN l IN ('razmer','otmetki','nadpisi','подписи','linkeddata','размеры','отметки') THEN 'drawing_annotation' WHEN l = '0' AND (starts_with(b, 'высоты') OR starts_with(b, 'новый абк')) THEN 'drawing_annotation' ELSE role END AS judged, count(*) AS n FROM i GROUP BY ALL",
    "symbol_integrity": """WITH own AS (SELECT id, max(legend_entry_id) AS own FROM symbol_instances GROUP BY id), bd AS (SELECT DISTINCT id, instance_id, legend_entry_id FROM symbol_bindings)
SELECT 'duplicate_instances' AS "check", (SELECT count(*) FROM (SELECT id FROM symbol_instances GROUP BY id HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'duplicate_legends', (SELECT count(*) FROM (SELECT id FROM legend_entries GROUP BY id HAVING count(*) > 1))
UNION ALL SELECT 'duplicate_bindings', (SELECT count(*) FROM (SELECT id FROM symbol_bindings GROUP BY id HAVING count(*) > 1))
UNION ALL SELECT 'duplicate_relationships', (SELECT count(*) FROM (SELECT id FROM relationships GROUP BY id HAVING count(*) > 1))
UNION ALL SELECT 'binding_without_instance', (SELECT count(*) FROM symbol_bindings b WHERE instance_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM symbol_instances i WHERE i.id = b.instance_id))
UNION ALL SELECT 'binding_without_legend', (SELECT count(*) FROM symbol_bindings b WHERE legend_entry_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM legend_entries i WHERE i.id = b.legend_entry_id))
UNION ALL SELECT 'instance_without_legend', (SELECT count(*) FROM symbol_instances b WHERE legend_entry_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM legend_entries i WHERE i.id = b.legend_entry_id))
UNION ALL SELECT 'relationship_without_source', (SELECT count(*) FROM relationships b WHERE source_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM symbol_instances i WHERE i.id = b.source_id))
UNION ALL SELECT 'binding_disagrees', (SELECT count(*) FROM bd b JOIN own o ON o.id = b.instance_id WHERE o.own IS NOT NULL AND b.legend_entry_id IS NOT NULL AND o.own <> b.legend_entry_id)
UNION ALL SELECT 'confirmed_without_legend', (SELECT count(*) FROM symbol_instances WHERE status = 'confirmed' AND legend_entry_id IS NULL)
UNION ALL SELECT 'confidence_out_of_range', (SELECT count(*) FROM symbol_bindings WHERE confidence < 0 OR confidence > 1)
UNION ALL SELECT 'box_inverted', (SELECT count(*) FROM legend_entries WHERE bbox IS NOT NULL AND (bbox.x0 > bbox.x1 OR bbox.y0 > bbox.y1))""",
    "number_findings": "WITH b AS (SELECT document_id, sheet, min(y) AS y0, max(y) AS y1 FROM text_items GROUP BY ALL), w AS (SELECT t.*, b.y0, b.y1 FROM text_items t JOIN b ON t.document_id = b.document_id AND t.sheet = b.sheet WHERE text IS NOT NULL), k AS (SELECT item_id, CASE WHEN height <= 0 THEN 'zero height' WHEN height > (y1 - y0) / 3 THEN 'too tall' END AS kind FROM w UNION ALL SELECT item_id, 'narrower than a sign' FROM w WHERE width > 0 AND width < height UNION ALL SELECT item_id, 'squeezed' FROM w WHERE NOT coalesce(factor, 1.0) BETWEEN 0.3 AND 3.0) SELECT kind, count(*) AS n, min(item_id) AS first_item FROM k WHERE kind IS NOT NULL GROUP BY kind",
    "layer_stats": "SELECT document_id, sheet, count(*) AS texts, sum(length(text))::BIGINT AS chars, min(x) AS x0, max(x) AS x1, grouping(document_id, sheet)::BIGINT AS level FROM text_items GROUP BY ROLLUP (document_id, sheet)",
    "finding_totals": "SELECT tool, severity, count(*) AS n, sum(n_found)::BIGINT AS found, sum(len(coalesce(examples, [])))::BIGINT AS examples FROM findings GROUP BY ALL",
    "changed_instances": "WITH a AS (SELECT id AS symbol, legend_entry_id FROM symbol_instances WHERE legend_entry_id IS NOT NULL), b AS (SELECT instance_id AS symbol, legend_entry_id FROM symbol_bindings WHERE legend_entry_id IS NOT NULL AND instance_id IS NOT NULL) SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)",
    "lanes": "SELECT CASE WHEN lower(regexp_extract(source_path, '\\.([A-Za-z0-9]+)$', 1)) IN ('dwg','dxf') THEN 'vector' ELSE 'model' END AS lane, count(*) AS n FROM variants GROUP BY 1",
    "latest_state": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "next_in_lane": "SELECT event_type, event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) = 1",
    "pages_to_resume": "SELECT DISTINCT document_id, page FROM stamps_archive a WHERE NOT EXISTS (SELECT 1 FROM stamps_kit k WHERE k.document_id = a.document_id AND k.page = a.page)",
    "event_page": "SELECT event_id, user_id, (SELECT count(*) FROM events WHERE event_id > 500) > 50 AS more FROM events WHERE event_id > 500 ORDER BY event_id LIMIT 50",
    "event_sessions": "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, min(ts) AS started, count(*) AS events FROM s GROUP BY user_id, sid",
    "hourly_events": "SELECT date_trunc('hour', ts) AS started, event_type, count(*) AS events FROM events GROUP BY ALL",
    "job_outcomes": "WITH e AS (SELECT user_id, count_if(event_type = 'purchase') AS done, count_if(event_type = 'error') AS failed FROM events GROUP BY user_id) SELECT user_id, CASE WHEN failed = 0 THEN 'completed' WHEN done > 0 THEN 'partial' ELSE 'failed' END AS outcome FROM e",
    "linked_symbols": "WITH RECURSIVE e AS (SELECT DISTINCT lower(trim(source_id, ' ')) AS a, lower(trim(target_id, ' ')) AS b FROM relationships WHERE source_id IS NOT NULL AND target_id IS NOT NULL), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, reach) AS (SELECT a, a FROM s UNION SELECT r.node, s.b FROM r JOIN s ON s.a = r.reach) SELECT node, min(reach) AS component FROM r GROUP BY node",
}
