"""Registered queries of the llm operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import canonlist, divergence, encodings, leakage, mixture, repetition, survivors, truncation, uniform


def _records(spark: SparkSession, d: str, name: str, key: str) -> DataFrame:
    return table(spark, d, name).select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("record_id"), "text")


def _captions(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d, "text_items", "item_id").unionByName(_records(spark, d, "stamp_items", "item_id"))


def _pairs(spark: SparkSession, d: str) -> list[tuple[int, int, int]]:
    """Counts over captions and notes, for all models of characters."""
    return encodings.train(_captions(spark, d).select("text"), table(spark, d, "note_texts").select("text"))


def _inconsistent(spark: SparkSession, d: str) -> DataFrame:
    records = _records(spark, d, "text_items", "item_id").unionByName(_records(spark, d, "note_texts", "id"))
    return uniform.inconsistent_records(records, _pairs(spark, d), garbled_tables=("text_items",))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _inconsistent(spark, d).select("table_name", "record_id").distinct()


def p1_uniform(spark: SparkSession, d: str) -> DataFrame:
    return _inconsistent(spark, d).select("table_name", "record_id", "uniform").distinct()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return encodings.garbled_records(_captions(spark, d), _pairs(spark, d)).select("table_name", "record_id")


def p2_restored(spark: SparkSession, d: str) -> DataFrame:
    return encodings.garbled_records(_captions(spark, d), _pairs(spark, d)).select("table_name", "record_id", "restored", "restorable")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.best_representatives(table(spark, d, "variants")).select("survivor_id")


def p4_golden(spark: SparkSession, d: str) -> DataFrame:
    return survivors.best_representatives(table(spark, d, "variants"))


def _labels(spark: SparkSession, d: str) -> DataFrame:
    return canonlist.matched_labels(table(spark, d, "legend_entries"), table(spark, d, "legend_reference"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d).filter("ref_id is not null")


def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d).filter("ref_id is null").select("legend_id")


def _cuts(spark: SparkSession, d: str) -> DataFrame:
    captions = table(spark, d, "text_items").select(F.lit("text_items").alias("table_name"), F.col("item_id").cast("string").alias("record_id"), F.coalesce("source", F.lit("")).alias("part"), F.concat(F.lit("text:"), F.coalesce("source", F.lit(""))).alias("model"), "text")
    kind = F.trim(F.regexp_replace("kind", r"(?U)\s+", " "))
    findings = table(spark, d, "findings").select(F.lit("findings").alias("table_name"), F.col("finding_id").cast("string").alias("record_id"), F.coalesce("tool", F.lit("")).alias("part"), F.lit("kind").alias("model"), kind.alias("text"))
    return truncation.cut_values(captions.unionByName(findings), _pairs(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _cuts(spark, d).filter("cut").select("table_name", "record_id")


def p6_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_rates(_cuts(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return p8_found(spark, d).groupBy("item_id").agg(F.count("*").alias("pages"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(table(spark, d, "documents"), table(spark, d, "source_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(table(spark, d, "documents"), table(spark, d, "source_targets"))[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.self_repeating(table(spark, d, "documents")).select("doc_id")


def p10_share(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetition_share(table(spark, d, "documents"))


def p10_divergence(spark: SparkSession, d: str) -> DataFrame:
    return divergence.divergence(table(spark, d, "documents"))


QUERIES = {"p1_found": p1_found, "p1_uniform": p1_uniform, "p2_found": p2_found, "p2_restored": p2_restored, "p4_found": p4_found, "p4_golden": p4_golden, "p5_found": p5_found, "p5_unmatched": p5_unmatched, "p6_found": p6_found, "p6_rates": p6_rates, "p8_found": p8_found, "p8_report": p8_report, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_share": p10_share, "p10_divergence": p10_divergence}

_GRAMS8 = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(replace(lower(regexp_replace(text, '([\p{L}\p{N}])[-\x{00AD}\x{2010}\x{2011}][ \t\r]*\n[ \t\r]*([\p{L}\p{N}])', '\1\2', 'g')), 'ё', 'е'), '[\p{L}\p{N}]+') AS ws FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(replace(lower(regexp_replace(text, '([\p{L}\p{N}])[-\x{00AD}\x{2010}\x{2011}][ \t\r]*\n[ \t\r]*([\p{L}\p{N}])', '\1\2', 'g')), 'ё', 'е'), '[\p{L}\p{N}]+') FROM eval_items WHERE text IS NOT NULL),
g AS (SELECT DISTINCT side, id, array_to_string(list_slice(ws, k, k + 11), ' ') AS gram FROM (SELECT side, id, ws, unnest(range(1, len(ws) - 10)) AS k FROM w WHERE len(ws) >= 12)),
hit AS (SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM g d JOIN g i ON d.side = 'd' AND i.side = 'i' AND d.gram = i.gram)
"""
_GRAMS10 = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+'), lambda x: NOT regexp_full_match(x, '[\p{Nd}²³¹⁰-⁹₀-₉]+')) AS ws FROM documents),
g AS (SELECT doc_id, k, array_to_string(list_slice(ws, k, k + 5), ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 4)) AS k FROM w WHERE len(ws) >= 6)),
r AS (SELECT doc_id, k FROM (SELECT doc_id, k, min(k) OVER (PARTITION BY doc_id, gram) AS f FROM g) WHERE k > f),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(k, k + 6)) AS p FROM r) GROUP BY doc_id),
s AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(c.n, 0) AS n_repeated FROM w LEFT JOIN c USING (doc_id))
"""

ORACLE = {
    "p4_found": r"""
WITH v AS (
  SELECT variant_id, idx, read_at, lower(regexp_replace(stamp.code, '\s+', '', 'g')) code, regexp_extract(stamp.sheet, '([0-9]+)', 1) raw,
    CASE upper(trim(source_kind)) WHEN 'DWG' THEN 0 WHEN 'PDF' THEN 1 WHEN 'DOCX' THEN 2 ELSE 3 END kind,
    len(list_filter([stamp.code, stamp.sheet, stamp.sheets_total, stamp.stage, stamp.title, stamp.object_name, stamp.org],
        lambda x: x IS NOT NULL AND trim(x) NOT IN ('', '-', '–', '—'))) filled
  FROM variants),
g AS (SELECT *, regexp_replace(raw, '^0+([0-9])', '\1') no FROM v WHERE code <> '' AND raw <> '')
SELECT variant_id AS survivor_id FROM g
QUALIFY count(*) OVER (PARTITION BY code, no) >= 2
  AND row_number() OVER (PARTITION BY code, no ORDER BY kind, filled DESC, read_at DESC NULLS LAST, idx NULLS LAST, variant_id) = 1
""",
    "p8_found": _GRAMS8 + "SELECT doc_id, item_id FROM hit",
    "p8_report": _GRAMS8 + "SELECT item_id, count(*) AS pages FROM hit GROUP BY item_id",
    "p10_found": _GRAMS10 + "SELECT doc_id FROM s WHERE n_words >= 30 AND n_repeated >= 0.5 * n_words",
    "p10_share": _GRAMS10 + "SELECT doc_id, n_words, n_repeated, CASE WHEN n_words > 0 THEN n_repeated / n_words ELSE 0.0 END AS share FROM s",
}
