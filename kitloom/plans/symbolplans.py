"""Registered queries of symbol binding and its summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import symbols as S
from ..session import table
from .sheets import _LBL

#: Families of blocks and the phrases that name them in a legend.
NEEDLES = {"труба": "труба", "опора": "опора", "знак": "пункт", "ось": "граница"}


def _instances(spark: SparkSession, d: str) -> DataFrame:
    return S.latest_rows(table(spark, d, "symbol_instances"))


def _legends(spark: SparkSession, d: str) -> DataFrame:
    return S.latest_rows(table(spark, d, "legend_entries").select("id", "document_id", "page", "label", "signature", "bbox", "status", "loaded_at"))


def block_matches(spark: SparkSession, d: str) -> DataFrame:
    return S.block_matches(_instances(spark, d), _legends(spark, d))


def project_matches(spark: SparkSession, d: str) -> DataFrame:
    return S.project_matches(_instances(spark, d), _legends(spark, d))


def needle_matches(spark: SparkSession, d: str) -> DataFrame:
    return S.needle_matches(_instances(spark, d), _legends(spark, d), NEEDLES)


def unknown_clusters(spark: SparkSession, d: str) -> DataFrame:
    return S.unknown_clusters(_instances(spark, d))


def review_counts(spark: SparkSession, d: str) -> DataFrame:
    return S.review_counts(_instances(spark, d).withColumn("source_kind", F.coalesce("source_kind", F.lit(""))), "source_kind")


def evidence_summary(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "symbol_bindings").select("id", "evidence", "loaded_at")
    return S.evidence_summary(S.latest_rows(b))


def merged_stamps(spark: SparkSession, d: str) -> DataFrame:
    """Stages and titles of sheets from both copies of the stamps, the kit winning."""
    one = lambda t, at: table(spark, d, t).filter("sheet_key is not null").groupBy("sheet_key").agg(F.max(F.struct(at, "stage", "title")).alias("r")).select("sheet_key", "r.stage", "r.title")
    a, b = one("stamps_kit", "read_at"), one("stamps_archive", "synced_at").select("sheet_key", F.col("stage").alias("b_stage"), F.col("title").alias("b_title"))
    both = a.join(b, "sheet_key")
    m = both.select("sheet_key", S.merged_field(F.col("stage"), F.col("b_stage")).alias("s"), S.merged_field(F.col("title"), F.col("b_title")).alias("t"))
    return m.select("sheet_key", F.col("s.value").alias("stage"), F.col("s.conflict").alias("stage_conflict"), F.col("t.value").alias("title"), F.col("t.conflict").alias("title_conflict"))


def queue_health(spark: SparkSession, d: str) -> DataFrame:
    """Events by state and day with cumulative counts."""
    from pyspark.sql import Window

    by = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("event_type").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return by.withColumn("so_far", F.sum("n").over(w))


QUERIES = {f.__name__: f for f in (block_matches, project_matches, needle_matches, unknown_clusters, review_counts, evidence_summary, merged_stamps, queue_health)}

_INST = "i AS (SELECT * FROM symbol_instances WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, document_id DESC NULLS LAST, page DESC NULLS LAST, source_kind DESC NULLS LAST, status DESC NULLS LAST, x DESC NULLS LAST, y DESC NULLS LAST, space DESC NULLS LAST, units DESC NULLS LAST, source_handle DESC NULLS LAST, layer DESC NULLS LAST, signature DESC NULLS LAST, block_name DESC NULLS LAST, role DESC NULLS LAST, legend_entry_id DESC NULLS LAST) = 1)"
_LEG = "l AS (SELECT id, document_id, page, label, signature, bbox, status FROM legend_entries WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, document_id DESC NULLS LAST, page DESC NULLS LAST, label DESC NULLS LAST, signature DESC NULLS LAST, bbox DESC NULLS LAST, status DESC NULLS LAST) = 1)"
_OPEN = "coalesce(role = 'field_candidate' AND status IN ('unresolved', 'unclassified'), false)"

ORACLE = {
    "block_matches": f"WITH {_INST}, {_LEG}, e AS (SELECT i.id, min(l.id) AS b, count(DISTINCT l.id) AS n FROM i JOIN l ON i.document_id = l.document_id AND i.page = l.page AND i.x >= l.bbox.x0 AND i.y >= l.bbox.y0 AND i.x < l.bbox.x1 AND i.y < l.bbox.y1 AND l.bbox.x0 <= l.bbox.x1 AND l.bbox.y0 <= l.bbox.y1 GROUP BY i.id), o AS (SELECT document_id, signature, min(id) AS s, count(DISTINCT id) AS n FROM l WHERE signature IS NOT NULL GROUP BY ALL) SELECT i.id, CASE WHEN e.n = 1 THEN e.b WHEN e.n IS NULL AND o.n = 1 THEN o.s END AS legend_id, CASE WHEN e.n = 1 THEN 'exemplar' WHEN e.n > 1 THEN 'several boxes' WHEN o.n = 1 THEN 'signature' WHEN o.n > 1 THEN 'ambiguous' ELSE 'missing' END AS reason FROM i LEFT JOIN e ON e.id = i.id LEFT JOIN o ON o.document_id = i.document_id AND o.signature = i.signature",
    "project_matches": f"WITH {_INST}, {_LEG}, n AS (SELECT DISTINCT document_id, signature, {_LBL} AS k FROM l WHERE signature IS NOT NULL AND label IS NOT NULL), c AS (SELECT signature, min(k) AS label, count(DISTINCT document_id) AS files FROM n GROUP BY signature HAVING count(DISTINCT k) = 1) SELECT i.id, c.label, c.files FROM i JOIN c ON c.signature = i.signature WHERE {_OPEN} AND NOT EXISTS (SELECT 1 FROM n WHERE n.document_id = i.document_id AND n.signature = i.signature)",
    "needle_matches": f"WITH {_INST}, {_LEG}, d AS (SELECT * FROM (VALUES {', '.join(f'({chr(39)}{a}{chr(39)}, {chr(39)}{b}{chr(39)})' for a, b in NEEDLES.items())}) t(family, needle)), h AS (SELECT document_id, family, min(id) AS legend_id FROM l JOIN d ON contains(translate(lower(l.label), 'ёЁ', 'еЕ'), d.needle) GROUP BY ALL HAVING count(DISTINCT id) = 1) SELECT i.id, h.legend_id FROM i JOIN h ON h.document_id = i.document_id AND h.family = lower(regexp_extract(i.block_name, '^([^_]+)', 1))",
    "unknown_clusters": f"WITH {_INST} SELECT document_id, coalesce(signature, '') AS signature, count(*) AS members, min(id) AS representative, count(DISTINCT page) AS pages FROM i WHERE {_OPEN} GROUP BY ALL",
    "review_counts": f"WITH {_INST}, m AS (SELECT *, coalesce(source_kind, '') AS k, {_OPEN} AS o FROM i) SELECT k AS source_kind, count(*) AS inserts, count_if(o)::BIGINT AS \"open\", count(legend_entry_id) AS bound, count_if(status = 'ignored')::BIGINT AS ignored, count(DISTINCT signature) FILTER (WHERE o) AS open_signatures FROM m GROUP BY ROLLUP (k)",
    "evidence_summary": "WITH b AS (SELECT DISTINCT id, evidence FROM symbol_bindings WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1), e AS (SELECT id, len(list_distinct(list_transform(evidence, lambda x: x.kind))) AS k, unnest(evidence) AS e FROM b) SELECT e.kind AS kind, count(*) AS n, max(e.score) AS best, count(DISTINCT id) FILTER (WHERE k = 1) AS sole FROM e GROUP BY e.kind",
    "merged_stamps": "WITH k AS (SELECT sheet_key, nullif(trim(stage,' '), '') AS s, nullif(trim(title,' '), '') AS t FROM stamps_kit WHERE sheet_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sheet_key ORDER BY read_at DESC) = 1), a AS (SELECT sheet_key, nullif(trim(stage,' '), '') AS s, nullif(trim(title,' '), '') AS t FROM stamps_archive WHERE sheet_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sheet_key ORDER BY synced_at DESC) = 1), f AS (SELECT sheet_key, k.s AS ks, a.s AS as_, k.t AS kt, a.t AS at_ FROM k JOIN a USING (sheet_key)) SELECT sheet_key, coalesce(ks, as_) AS stage, coalesce(lower(trim(regexp_replace(ks, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')) <> lower(trim(regexp_replace(as_, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')), false) AS stage_conflict, coalesce(kt, at_) AS title, coalesce(lower(trim(regexp_replace(kt, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')) <> lower(trim(regexp_replace(at_, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')), false) AS title_conflict FROM f",
    "queue_health": "WITH b AS (SELECT event_type, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL) SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY day)::BIGINT AS so_far FROM b",
}
