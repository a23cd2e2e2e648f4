"""Registered queries of the general data-quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import orphans, setrecon
from ..session import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return setrecon.stamp_differences(table(spark, d, "stamps_kit"), table(spark, d, "stamps_archive"))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphans.symbol_orphans(*(table(spark, d, t) for t in ("symbol_bindings", "relationships", "symbol_instances", "legend_entries")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("table_name", "ref_id", "field_name")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(_orphans(spark, d))


def p7_current(spark: SparkSession, d: str) -> DataFrame:
    counts = orphans.symbol_counts(*(table(spark, d, t) for t in ("symbol_bindings", "relationships", "symbol_instances", "legend_entries")))
    return orphans.current_orphans(counts)


_ORPHAN_CTES = r"""
WITH targets AS (
  SELECT lower(trim(id)) k, loaded_at l, deleted_at x FROM symbol_instances
  UNION ALL SELECT lower(trim(id)), loaded_at, deleted_at FROM legend_entries),
refs AS (
  SELECT 'symbol_bindings' table_name, id ref_id, 'instance_id' field_name, instance_id v, loaded_at t FROM symbol_bindings
  UNION ALL SELECT 'symbol_bindings', id, 'legend_entry_id', legend_entry_id, loaded_at FROM symbol_bindings
  UNION ALL SELECT 'relationships', id, 'target_id', target_id, loaded_at FROM relationships),
orphan AS (
  SELECT DISTINCT table_name, ref_id, field_name, strftime(t, '%Y-%m') period FROM refs r
  WHERE v IS NOT NULL AND NOT EXISTS (SELECT 1 FROM targets g WHERE g.k = lower(trim(r.v)) AND g.l <= r.t + INTERVAL 1 DAY AND (g.x IS NULL OR g.x > r.t)))
"""

QUERIES = {"p3_found": p3_found, "p7_found": p7_found, "p7_report": p7_report, "p7_current": p7_current}
ORACLE = {
    "p3_found": r"""
WITH kit AS (
  SELECT sheet_key, lower(regexp_replace(coalesce(code,''), '\s+', '', 'g')) code,
         trim(regexp_replace(translate(lower(coalesce(title,'')), 'ё«»"''„“”‘’`', 'е'), '\s+', ' ', 'g')) title,
         trim(coalesce(sheets_total,'')) s
  FROM stamps_kit WHERE sheet_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sheet_key ORDER BY read_at DESC) = 1),
arc AS (
  SELECT sheet_key, lower(regexp_replace(coalesce(code,''), '\s+', '', 'g')) code,
         trim(regexp_replace(translate(lower(coalesce(title,'')), 'ё«»"''„“”‘’`', 'е'), '\s+', ' ', 'g')) title,
         trim(coalesce(sheets_total,'')) s
  FROM stamps_archive WHERE sheet_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sheet_key ORDER BY synced_at DESC) = 1),
both_ AS (
  SELECT sheet_key, k.sheet_key IS NOT NULL hk, a.sheet_key IS NOT NULL ha, k.code kc, a.code ac, k.title kt, a.title at_,
         CASE WHEN regexp_full_match(k.s, '[0-9]+') THEN regexp_replace(k.s, '^0+([0-9])', '\1') ELSE k.s END ks,
         CASE WHEN regexp_full_match(a.s, '[0-9]+') THEN regexp_replace(a.s, '^0+([0-9])', '\1') ELSE a.s END as_
  FROM kit k FULL JOIN arc a USING (sheet_key))
SELECT sheet_key, 'only_kit' AS difference FROM both_ WHERE NOT ha
UNION ALL SELECT sheet_key, 'only_archive' FROM both_ WHERE NOT hk
UNION ALL SELECT sheet_key, 'code' FROM both_ WHERE hk AND ha AND kc <> ac
UNION ALL SELECT sheet_key, 'title' FROM both_ WHERE hk AND ha AND kt <> at_
UNION ALL SELECT sheet_key, 'sheets_total' FROM both_ WHERE hk AND ha AND ks <> as_
""",
    "p7_found": _ORPHAN_CTES + "SELECT table_name, ref_id, field_name FROM orphan",
    "p7_report": _ORPHAN_CTES + "SELECT table_name, field_name, period, count(*) AS orphans FROM orphan GROUP BY ALL",
    "p7_current": r"""
WITH targets AS (
  SELECT lower(trim(id)) k FROM (SELECT id, loaded_at, deleted_at FROM symbol_instances UNION ALL SELECT id, loaded_at, deleted_at FROM legend_entries)
  WHERE id IS NOT NULL AND loaded_at IS NOT NULL AND deleted_at IS NULL),
refs AS (
  SELECT lower(trim(v)) AS k FROM (SELECT instance_id AS v FROM symbol_bindings UNION ALL SELECT legend_entry_id FROM symbol_bindings UNION ALL SELECT target_id FROM relationships) WHERE v IS NOT NULL)
SELECT k AS key, CAST(count(*) AS BIGINT) AS refs FROM refs WHERE NOT EXISTS (SELECT 1 FROM targets t WHERE t.k = refs.k) GROUP BY k
""",
}
