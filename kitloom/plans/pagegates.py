"""Registered queries of gates, captions and title blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import gates as G
from ..operators import stampread
from ..session import table
from .texts import _SQ


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null")


def page_gates(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return _docs(spark, d).select(
        "doc_id", G.layer_is_usable(t, F.col("page_kind")).alias("usable"), G.is_all_errors(t).alias("all_errors"), G.is_garbage_tile(t).alias("garbage"), G.has_context(t).alias("context"), G.content_rows(t).alias("content_rows"), G.digit_rows(t).alias("digit_rows"), G.table_score(t).alias("table_score"), G.stamped_location(t).alias("stamped"), G.fragment_count(t).alias("fragments")
    )


def repeated_pages(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).filter(G.looks_repeated(F.col("text"))).select("doc_id")


def description_gates(spark: SparkSession, d: str) -> DataFrame:
    r = _docs(spark, d).select("doc_id", F.explode(G.description_reasons(F.col("text"), F.coalesce("page_kind", F.lit("text")))).alias("reason"))
    return r.groupBy("reason").agg(F.count("*").alias("pages"))


def page_trust(spark: SparkSession, d: str) -> DataFrame:
    s = F.coalesce("source", F.lit(""))
    level = G.trust_level(s == "docx_note", s == "dwg_notes", s.isin("pdf_layer", "spec_sheets"), F.trim("text") != "")
    w = _docs(spark, d).select(level.alias("level"), F.size(G.trust_warnings(s == "ocr_read", s == "vlm_read", F.trim("text") == "", F.lit(False), F.lit(0), level)).alias("warnings"))
    return w.groupBy("level", "warnings").agg(F.count("*").alias("pages"))


def caption_gates(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    c = table(spark, d, "text_items").filter("text is not null").select(G.looks_like_heading(t).alias("heading"), G.is_view_title(t).alias("view"), (F.size(G.junk_kinds(t)) > 0).alias("junk"), (G.clean_caption(t) != t).alias("cleaned"), G.paper_format(t).alias("paper"), G.looks_like_stamp(t).alias("stamp"))
    return c.groupBy(*c.columns).agg(F.count("*").alias("n"))


def caption_parts(spark: SparkSession, d: str) -> DataFrame:
    p = G.caption_part(F.col("stamp.title"))
    return table(spark, d, "variants").filter("stamp.title is not null").groupBy(p["name"].alias("name"), p["part"].alias("part")).agg(F.count("*").alias("n"))


def block_numbers(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("block_name")
    return table(spark, d, "symbol_instances").groupBy(G.circle_number(b).alias("circle"), F.nullif(G.room_number(b), F.lit("")).alias("room"), F.regexp_extract(b, "^([^_]*)", 1).alias("family")).agg(F.count("*").alias("n"))


def title_blocks(spark: SparkSession, d: str) -> DataFrame:
    return stampread.read_stamps(table(spark, d, "stamp_items"))


def key_hits(spark: SparkSession, d: str) -> DataFrame:
    """Key phrases of file readings that stand in the other readings of the same kit."""
    docs = _docs(spark, d).filter("kit is not null and source is not null")
    from_file = F.col("source").isin("dwg_notes", "pdf_layer", "docx_note", "spec_sheets")
    keys = docs.filter(from_file).select("kit", F.explode(G.key_phrases(F.col("text"))).alias("key")).distinct()
    tokens = docs.filter(~from_file).select("kit", F.explode(T.tokens(F.col("text"))).alias("token")).distinct()
    own = keys.select("kit", "key", F.explode(F.filter(T.tokens(F.col("key")), lambda t: F.length(t) >= 3)).alias("token"))
    hits = own.join(tokens.withColumn("hit", F.lit(1)), ["kit", "token"], "left").groupBy("kit", "key").agg(F.count("*").alias("n"), F.count("hit").alias("h"))
    return hits.groupBy("kit").agg(F.count("*").alias("keys"), F.count_if(F.col("h") * 10 >= F.col("n") * 7).alias("found"))


def frame_formats(spark: SparkSession, d: str) -> DataFrame:
    boxes = table(spark, d, "text_items").groupBy("document_id", "sheet").agg((F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h"))
    fits = G.sheet_format(F.greatest("w", "h"), F.least("w", "h"))
    return boxes.select("document_id", "sheet", F.size(fits).alias("fits"))


QUERIES = {f.__name__: f for f in (page_gates, repeated_pages, description_gates, page_trust, caption_gates, caption_parts, block_numbers, title_blocks, key_hits, frame_formats)}

_LNS = "list_filter(list_transform(string_split(replace(text, chr(13), ''), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"
_JUNKS = " OR ".join(f"regexp_matches(text, '{p}')" for p in (r"\\[UM]\+", r"\{\\[A-Za-z]|\\[fFHWTQ][^;]{0,24};", "#{3,}", "[\ufffd\\x01-\\x08]"))
_CLEAN0 = r"regexp_replace(text, '[\x00-\x08\x0B-\x1F]', '', 'g')"
_CLEAN1 = f"regexp_replace({_CLEAN0}, '{G.MTEXT_CODE}', '', 'g')"
_CLEAN2 = f"CASE WHEN {_CLEAN1} <> {_CLEAN0} THEN regexp_replace({_CLEAN1}, '\\{{([^{{}}]*)\\}}', '\\1', 'g') ELSE {_CLEAN0} END"
_CLEAN3 = _CLEAN2
for _code, _sign in G.CAD_CODES:
    _CLEAN3 = f"regexp_replace({_CLEAN3}, '{_code}', '{_sign}', 'g')"
_ANCH = "('" + "','".join(stampread.ANCHORS) + "')"

ORACLE = {
    "page_gates": f"""WITH d AS (SELECT doc_id, text, page_kind, trim(text, ' ') AS t, {_LNS} AS ls, len(regexp_extract_all(text, '[А-Яа-яЁё]')) AS u, len(regexp_extract_all(text, '[À-ʯЀЂ-ЏѐђѓєѕіїјљњќћўџҐґ]')) AS o FROM documents WHERE text IS NOT NULL),
e AS (SELECT *, list_filter(list_transform(string_split(array_to_string(list_filter(string_split(replace(chr(10) || text, chr(10) || '### ', chr(1) || '### '), chr(1)), lambda s: NOT regexp_matches(s, '^### (PASS-0|PASS-[^ \\n]* пропущен)')), chr(10)), chr(10)), lambda x: trim(regexp_replace(x, '\\(ошибк[аи][^)]*\\)', '', 'g'), ' ')), lambda x: NOT regexp_matches(x, '^(#{{1,6}} |-{{2,}} |_[^_]*_ *$)')) AS rl FROM d),
s AS (SELECT *, len(list_filter(list_filter(ls, lambda x: starts_with(x, '|') AND regexp_matches(x, '[0-9]')), lambda x: len(list_filter(string_split(regexp_replace(x, '^\\|+|\\|+$', '', 'g'), '|'), lambda y: trim(y, ' ') <> '')) >= 2)) AS cr,
 list_filter(list_transform(list_filter(ls, lambda x: contains(x, ' — ')), lambda x: lower(trim(regexp_replace(x, '^.* — ', ''), ' '))), lambda x: length(x) >= 6) AS tails FROM e)
SELECT doc_id, NOT coalesce(CASE WHEN u + o >= 30 THEN o / (u + o) >= 0.25 END, false) AND CASE WHEN coalesce(page_kind IN ('plan','scheme','mixed','table'), false) THEN length(t) >= 1500 AND len(list_filter(regexp_split_to_array(t, '[ \\t\\n\\r\\f]+'), lambda x: x <> '')) >= 200 ELSE length(t) >= 400 END AS usable,
 length(regexp_replace(array_to_string(rl, ''), '[^{G.ALPHA}0-9]', '', 'g')) < 40 AS all_errors,
 length(t) >= 20 AND (len(list_filter(ls, lambda x: regexp_matches(x, '^\\|[ 0-9|]*\\|[ ]*[0-9]{{1,4}}[ ]*\\|[ 0-9|]*$'))) >= 25 OR len(list_filter(ls, lambda x: regexp_matches(x, '(?i)^([-*•]\\s*)?ось\\s+[0-9]+'))) >= 20 OR len(list_filter(ls, lambda x: regexp_matches(x, '^([-*•]\\s*)?[0-9]{{1,4}}$'))) >= 30) AS garbage,
 len(list_filter(ls, lambda x: length(x) >= 8 AND NOT starts_with(x, '|'))) > 0 AS context, cr::INTEGER AS content_rows, len(list_filter(ls, lambda x: regexp_matches(x, '^\\|.*[0-9]')))::INTEGER AS digit_rows,
 (cr * 1000 + least(length(text), 999) - CASE WHEN contains(text, '[петля пустых ячеек]') THEN 500 ELSE 0 END)::INTEGER AS table_score,
 coalesce(list_max(list_transform(list_distinct(tails), lambda a: len(list_filter(tails, lambda b: b = a)))) >= 6, false) AS stamped,
 greatest(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^[ \\t]*--- +[^ ]+ +---[ \\t]*$'))), 1)::INTEGER AS fragments FROM s""",
    "page_trust": """WITH p AS (SELECT coalesce(source, '') AS s, trim(text, ' ') AS t FROM documents WHERE text IS NOT NULL), l AS (SELECT *, CASE WHEN s = 'docx_note' THEN 'docx' WHEN s = 'dwg_notes' THEN 'drawing' WHEN s IN ('pdf_layer','spec_sheets') THEN 'layer' WHEN t <> '' THEN 'model' ELSE 'none' END AS level FROM p)
SELECT level, ((s = 'ocr_read' OR s = 'vlm_read' OR t = '')::INTEGER + (level = 'model')::INTEGER + (level = 'none')::INTEGER)::INTEGER AS warnings, count(*) AS pages FROM l GROUP BY ALL""",
    "caption_gates": f"""WITH c AS (SELECT length(text) <= 90 AND NOT contains(trim(text,' '), chr(10)) AND (regexp_matches(trim(text,' '), '^[0-9].*[{G.ALPHA}]') OR regexp_matches(lower(trim(text,' ')), '{G.HEADING_START}')) AS heading,
 regexp_matches(trim(text,' '), '(?i)^(схем[а-яё]*\\s+расположен|(геологическ[а-яё]*\\s+)?разрез([^а-яё]|$)|по\\s+лини|[IVX]+ *[-–] *[IVX]+)') AS view, ({_JUNKS}) AS junk,
 (CASE WHEN regexp_matches(trim({_CLEAN3}, ' '), '^#{{2,}}$') THEN {_CLEAN3} ELSE regexp_replace({_CLEAN3}, '#{{2,}}', '—', 'g') END) <> text AS cleaned,
 CASE WHEN regexp_matches(text, '(?i)[aа][0-5]([^0-9]|$)') THEN regexp_extract(text, '(?i)[aа]([0-5])([^0-9]|$)', 1) END AS paper,
 ({' + '.join(f"contains(lower(text), '{w}')::INT" for w in G.STAMP_WORDS)}) >= 2 AS stamp FROM text_items WHERE text IS NOT NULL) SELECT *, count(*) AS n FROM c GROUP BY ALL""",
    "block_numbers": "WITH b AS (SELECT block_name AS b, try_cast(nullif(regexp_extract(lower(trim(block_name,' ')), '^круг ?([0-9]+)$', 1), '') AS INTEGER) AS c FROM symbol_instances) SELECT CASE WHEN c BETWEEN 1 AND 20 THEN c END AS circle, nullif(regexp_extract(trim(b,' '), '(?i)^номерация[ \\t]+(.+)$', 1), '') AS room, CASE WHEN b IS NOT NULL THEN regexp_extract(b, '^([^_]*)', 1) END AS family, count(*) AS n FROM b GROUP BY ALL",
    "title_blocks": f"""WITH i AS (SELECT document_id, page, item_id, x, y, coalesce(size, 1.0) AS size, text, regexp_replace(translate(lower(text), 'ёЁ', 'еЕ'), '[ \\t\\n\\r\\f.]+', '', 'g') AS k FROM stamp_items WHERE text IS NOT NULL AND trim(text,' ') <> '' AND x IS NOT NULL AND y IS NOT NULL),
a AS (SELECT *, CASE WHEN k IN {_ANCH} THEN k END AS anchor FROM i), st AS (SELECT * FROM a WHERE anchor = 'стадия'), tt AS (SELECT * FROM a WHERE anchor = 'листов'),
pr AS (SELECT s.*, (SELECT min(struct_pack(tx := t.x, t_id := t.item_id, ty := t.y)) FROM tt t WHERE t.document_id = s.document_id AND t.page = s.page AND t.x > s.x AND abs(t.y - s.y) <= greatest(s.size, 1.0) * 2) AS t FROM st s),
sc AS (SELECT *, CASE WHEN t.tx - x > 1 THEN (t.tx - x) / 35.0 ELSE 1.0 END AS scale FROM pr),
fl AS (SELECT s.*, (SELECT arg_min(b.text, struct_pack(d := s.y - b.y, i := b.item_id)) FROM a b WHERE b.anchor IS NULL AND b.document_id = s.document_id AND b.page = s.page AND s.y - b.y > 0 AND s.y - b.y <= s.scale * 12.0 AND abs(b.x - s.x) <= s.scale * 9.0) AS stage FROM sc s),
be AS (SELECT * FROM fl QUALIFY row_number() OVER (PARTITION BY document_id, page ORDER BY (stage IS NOT NULL) DESC, x - y DESC, item_id) = 1),
si AS (SELECT l.*, b.scale FROM be b JOIN a l ON l.anchor = 'лист' AND l.document_id = b.document_id AND l.page = b.page AND b.t IS NOT NULL AND l.x > b.x AND l.x < b.t.tx QUALIFY row_number() OVER (PARTITION BY l.document_id, l.page ORDER BY abs(l.y - b.y), l.item_id) = 1),
sv AS (SELECT document_id, page, (SELECT arg_min(b.text, struct_pack(d := s.y - b.y, i := b.item_id)) FROM a b WHERE b.anchor IS NULL AND b.document_id = s.document_id AND b.page = s.page AND s.y - b.y > 0 AND s.y - b.y <= s.scale * 12.0 AND abs(b.x - s.x) <= s.scale * 9.0) AS v FROM si s),
tv AS (SELECT document_id, page, (SELECT arg_min(b.text, struct_pack(d := s.t.ty - b.y, i := b.item_id)) FROM a b WHERE b.anchor IS NULL AND b.document_id = s.document_id AND b.page = s.page AND s.t.ty - b.y > 0 AND s.t.ty - b.y <= s.scale * 12.0 AND abs(b.x - s.t.tx) <= s.scale * 9.0) AS v FROM be s),
co AS (SELECT b.document_id, b.page, trim(c.text,' ') AS code FROM be b JOIN a c ON c.document_id = b.document_id AND c.page = b.page AND c.x - b.x >= b.scale * -185.0 * 1.1 AND c.x - b.x <= b.scale * 185.0 * 0.6 AND abs(c.y - b.y) <= b.scale * 55.0
 WHERE length(trim(c.text,' ')) BETWEEN 5 AND 40 AND regexp_matches(trim(c.text,' '), '{T.DOCUMENT_CODE}') AND regexp_matches(trim(c.text,' '), '[-/]') AND length(regexp_replace(trim(c.text,' '), '[^0-9]', '', 'g')) * 4 >= length(trim(c.text,' ')) QUALIFY row_number() OVER (PARTITION BY b.document_id, b.page ORDER BY round(c.size, 1) DESC, length(c.text) DESC, c.item_id) = 1)
SELECT b.document_id, b.page, trim(b.stage,' ') AS stage, coalesce(nullif(regexp_extract(sv.v, '([0-9]+)', 1), ''), trim(sv.v,' ')) AS sheet, coalesce(nullif(regexp_extract(tv.v, '([0-9]+)', 1), ''), trim(tv.v,' ')) AS sheets_total, co.code FROM be b LEFT JOIN sv ON sv.document_id = b.document_id AND sv.page = b.page LEFT JOIN tv ON tv.document_id = b.document_id AND tv.page = b.page LEFT JOIN co ON co.document_id = b.document_id AND co.page = b.page""",
    "caption_parts": f"""WITH t AS (SELECT {_SQ.format(c="stamp.title")} AS t FROM variants WHERE stamp.title IS NOT NULL), w AS (SELECT t, translate(lower(regexp_extract(t, '\\( *([^)]{{3,20}}?) *\\) *$', 1)), 'ёЁ', 'еЕ') AS w FROM t), p AS (SELECT t, CASE WHEN w = '' THEN NULL WHEN starts_with(w, 'нач') THEN 0 WHEN starts_with(w, 'прод') THEN 1 WHEN starts_with(w, 'окон') OR starts_with(w, 'конец') THEN 2 END AS p FROM w)
SELECT CASE WHEN p IS NOT NULL THEN trim(regexp_replace(t, '\\([^)]*\\) *$', ''), ' ') ELSE t END AS name, coalesce(p, 0)::INTEGER AS part, count(*) AS n FROM p GROUP BY ALL""",
    "frame_formats": "WITH b AS (SELECT document_id, sheet, max(x) - min(x) AS w, max(y) - min(y) AS h FROM text_items GROUP BY ALL), p AS (SELECT * FROM (VALUES (210.0::DOUBLE, 297.0::DOUBLE), (297.0, 420.0), (420.0, 594.0), (594.0, 841.0), (841.0, 1189.0)) t(pw, ph)), f AS (SELECT document_id, sheet, greatest(w, h) AS l, least(w, h) AS s, pw, ph, round(greatest(w, h) / ph) AS k FROM b, p) SELECT document_id, sheet, count_if(k > 0 AND abs(l / ph - k) <= 0.02 * k AND abs(s / pw - k) <= 0.05 * k)::INTEGER AS fits FROM f GROUP BY ALL",
    "description_gates": f"""WITH d AS (SELECT doc_id, text, coalesce(page_kind, 'text') AS k, {_LNS} AS ls FROM documents WHERE text IS NOT NULL),
t AS (SELECT *, list_filter(list_transform(list_filter(ls, lambda x: contains(x, ' — ')), lambda x: lower(trim(regexp_replace(x, '^.* — ', ''), ' '))), lambda x: length(x) >= 6) AS tails FROM d),
r AS (SELECT 'stamped_location' AS reason FROM t WHERE coalesce(list_max(list_transform(list_distinct(tails), lambda a: len(list_filter(tails, lambda b: b = a)))) >= 6, false)
UNION ALL SELECT 'too_short' FROM t WHERE length(trim(text, ' ')) < CASE k WHEN 'plan' THEN 2500 WHEN 'scheme' THEN 2000 WHEN 'table' THEN 2000 WHEN 'mixed' THEN 2200 ELSE 1500 END
UNION ALL SELECT 'repetition_loop' FROM t WHERE contains(text, '[truncated-repeat]')
UNION ALL SELECT 'tables_too_thin' FROM t WHERE k = 'table' AND len(list_filter(ls, lambda x: regexp_matches(x, '^\\|.+\\|$'))) < 8
UNION ALL SELECT 'missing_sections' FROM t WHERE k IN ('plan', 'scheme', 'mixed') AND (NOT contains(lower(text), 'что это'))::INT + (NOT contains(lower(text), 'состав и размещение'))::INT + (NOT contains(lower(text), 'связи'))::INT >= 2) SELECT reason, count(*) AS pages FROM r GROUP BY reason""",
}
