"""Registered queries of reconciliation and scoring over sheet variants and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import lines as L
from ..operators import recon as R
from ..operators import scoring as S
from ..session import table
from .texts import _CELLS, _LN, _SQ, _YO, _short  # noqa: F401

#: Readings made from the file itself; the other sources are readings of an image.
FILE_SOURCES = ("dwg_notes", "pdf_layer", "docx_note", "spec_sheets")
_FILES = "('dwg_notes', 'pdf_layer', 'docx_note', 'spec_sheets')"


def _variants(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "variants")


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").filter("kit is not null and source is not null and text is not null")
    from_file = F.col("source").isin(*FILE_SOURCES)
    return docs.filter(from_file), docs.filter(~from_file)


def sheet_tree(spark: SparkSession, d: str) -> DataFrame:
    return R.sheet_tree(_variants(spark, d))


def unnumbered_variants(spark: SparkSession, d: str) -> DataFrame:
    return R.unnumbered(_variants(spark, d))


def section_heads(spark: SparkSession, d: str) -> DataFrame:
    return R.section_heads(_variants(spark, d))


def field_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return R.field_conflicts(_variants(spark, d)).select("section", "document", "number", "variant_id", "field", "left", "right")


def duplicate_sheets(spark: SparkSession, d: str) -> DataFrame:
    return R.duplicates(_variants(spark, d))


def number_conflicts(spark: SparkSession, d: str) -> DataFrame:
    a, b = _sides(spark, d)
    ordered = lambda df: L.lines(df, ["kit", "doc_id"]).withColumn("pos", F.struct("doc_id", "pos"))
    return R.number_conflicts(ordered(a), ordered(b), ["kit"])


def kit_token_sets(spark: SparkSession, d: str) -> DataFrame:
    a, b = _sides(spark, d)
    tokens = lambda df: df.select("kit", F.explode(T.tokens(F.col("text"))).alias("token")).distinct()
    return R.token_sets(tokens(a), tokens(b), ["kit"])


def kit_jaccard(spark: SparkSession, d: str) -> DataFrame:
    s = kit_token_sets(spark, d)
    union = F.col("left_only") + F.col("right_only") + F.col("common")
    return s.select("kit", (100.0 * F.col("common") / union).alias("jaccard"))


def united_lines(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("kit is not null")
    read = L.lines(docs, ["kit", "page", "doc_id"]).withColumnRenamed("doc_id", "reading")
    return R.union_lines(read, ["kit", "page"]).groupBy("kit", "page").agg(F.count("*").alias("lines"))


def added_lines(spark: SparkSession, d: str) -> DataFrame:
    a, b = (L.lines(x, ["kit", "doc_id"]) for x in _sides(spark, d))
    return R.added_lines(a, b, ["kit"]).groupBy("kit").agg(F.count("*").alias("lines"))


def fresh_readings(spark: SparkSession, d: str) -> DataFrame:
    """Fresh lines of every reading of a page."""
    a, b = (L.lines(x, ["kit", "page", "doc_id"]).withColumn("pos", F.struct("doc_id", "pos")).drop("doc_id") for x in _sides(spark, d))
    return R.fresh_lines(a, b, ["kit", "page"]).select("kit", "page", "pos.doc_id", "pos.pos", "line")


def token_recall(spark: SparkSession, d: str) -> DataFrame:
    a, b = _sides(spark, d)
    words = lambda df: df.select("kit", F.explode(T.words(F.col("text"))).alias("token"))
    return S.recall(words(a), words(b), ["kit"])


def duplicate_line_ratio(spark: SparkSession, d: str) -> DataFrame:
    return S.duplicate_line_ratio(L.lines(table(spark, d, "documents"), ["doc_id"]), ["doc_id"])


def best_reference_pages(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "eval_items").select("item_id", F.explode(T.longer_tokens(F.col("text"))).alias("token"))
    pages = table(spark, d, "documents").select("doc_id", F.explode(T.longer_tokens(F.col("text"))).alias("token"))
    return S.best_matches(pages, items, query="item_id", candidate="doc_id")


def unsupported_facts(spark: SparkSession, d: str) -> DataFrame:
    a, b = _sides(spark, d)
    facts = lambda df: df.select("kit", F.explode(T.facts(F.col("text"))).alias("fact")).distinct()
    return S.unsupported(facts(b), facts(a), ["kit"])


def page_kind_scores(spark: SparkSession, d: str) -> DataFrame:
    """How well the share of table lines tells the kind of a page, per language."""
    docs = table(spark, d, "documents").filter("lang is not null")
    says = docs.filter("page_kind = 'table'").select(F.lower("lang").alias("lang"), "doc_id")
    piped = F.regexp_count(F.concat(F.lit("\n"), F.col("text")), F.lit("\n[ ]*\\|"))
    guess = docs.filter(piped * 2 >= F.regexp_count(F.col("text"), F.lit("\n")) + 1).select(F.lower("lang").alias("lang"), "doc_id")
    return S.prf(says, guess, ["doc_id"], ["lang"])


def checked_pages(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null")
    ok = S.checklist(docs, contains=["Страница"], absent=["[mock]"], any_of=["шаг", "отм", "площад"])
    return docs.groupBy("source").agg(F.count("*").alias("pages"), F.count_if(ok).alias("passed"))


def density(spark: SparkSession, d: str) -> DataFrame:
    """Characters per fact by source, recomputed from sums, with a total row."""
    docs = table(spark, d, "documents").filter("text is not null and source is not null").select("source", F.length("text").alias("chars"), F.size(T.facts(F.col("text"))).alias("facts"))
    sums = docs.rollup("source").agg(F.sum("chars").alias("chars"), F.sum("facts").alias("facts"), F.count("*").alias("pages"))
    return sums.withColumn("chars_per_fact", F.col("chars") / F.nullif("facts", F.lit(0)))


QUERIES = {f.__name__: f for f in (sheet_tree, unnumbered_variants, section_heads, field_conflicts, duplicate_sheets, number_conflicts, kit_token_sets, kit_jaccard, united_lines, added_lines, fresh_readings, token_recall, duplicate_line_ratio, best_reference_pages, unsupported_facts, page_kind_scores, checked_pages, density)}

_CODE = "trim(coalesce(stamp.code, ''), ' ')"
_PLACED = f"""WITH v AS (SELECT variant_id, source_kind, idx, trim(coalesce(stamp.title,''),' ') AS title, trim(coalesce(stamp.stage,''),' ') AS stage, trim(coalesce(stamp.org,''),' ') AS org, trim(coalesce(stamp.object_name,''),' ') AS object_name, trim(coalesce(stamp.sheet,''),' ') AS number, {_CODE} AS code,
  coalesce(upper(trim(source_kind,' ')) IN ('DWG','DXF'), false) AS vector, regexp_matches({_CODE}, '(?i)(\\.пз|\\.тч|\\.пояснительная записка)$') AS text_part FROM variants),
s AS (SELECT *, coalesce(nullif(CASE WHEN text_part THEN regexp_replace(regexp_replace(code, '(?i)(\\.пз|\\.тч|\\.пояснительная записка)$', ''), '[ .]+$', '') ELSE code END, ''), '(без шифра)') AS section FROM v),
p AS (SELECT *, coalesce(nullif(code, ''), section) AS document, CASE WHEN number <> '' THEN row_number() OVER (PARTITION BY section, coalesce(nullif(code, ''), section), number ORDER BY vector DESC, (code <> '' OR number <> '' OR title <> '') DESC, idx NULLS LAST, variant_id) END AS place FROM s)"""
_TREE = """SELECT section, document, number, arg_min(variant_id, place) AS main_id, arg_min(title, place) FILTER (WHERE title <> '') AS title, coalesce(array_to_string(list_sort(list(DISTINCT upper(trim(source_kind,' '))) FILTER (WHERE source_kind IS NOT NULL)), ','), '') AS kinds, count(*) AS variants, bool_or(text_part) AS text_part FROM p WHERE number <> '' GROUP BY ALL"""
_FOLD_TITLE = lambda c: "regexp_replace(" + _SQ.format(c="regexp_replace(" + _YO.format(c=f"lower(trim({c},' '))") + ", '[«»\"''`]+', '', 'g')") + ", '^[ .]+|[ .]+$', '', 'g')"
_SIDED = f"WITH d AS (SELECT *, source IN {_FILES} AS left_side FROM documents WHERE kit IS NOT NULL AND source IS NOT NULL AND text IS NOT NULL)"
_TOK = f", t AS (SELECT DISTINCT kit, left_side, lower(unnest(regexp_extract_all(text, '{T.TOKEN}'))) AS token FROM d), b AS (SELECT kit, token, bool_or(left_side) AS l, bool_or(NOT left_side) AS r FROM t GROUP BY ALL)"
_NUMSQL = f"list_transform(list_transform(list_transform(regexp_extract_all(line, '{T.NUMBER}'), lambda x: translate(x, '−,', '-.')), lambda y: {_short('y')}), lambda z: CASE WHEN z IN ('','-') THEN '0' ELSE z END)"
_SKEL = _SQ.format(c="regexp_replace(" + _YO.format(c=f"lower(regexp_replace(line, '{T.NUMBER}', '#', 'g'))") + ", '[|·•]+', ' ', 'g')")
_KLN = ", ln AS (SELECT kit, page, doc_id, left_side, unnest(l) AS line, unnest(range(len(l))) AS pos FROM (SELECT *, string_split(replace(text, chr(13), ''), chr(10)) AS l FROM d))"

ORACLE = {
    "sheet_tree": _PLACED + _TREE,
    "unnumbered_variants": _PLACED + "SELECT section, document, count(*) AS variants FROM p WHERE number = '' GROUP BY ALL",
    "section_heads": _PLACED + "SELECT section, " + ", ".join(f"coalesce(arg_max({f}, variant_id) FILTER (WHERE vector AND {f} <> ''), arg_min({f}, variant_id) FILTER (WHERE NOT vector AND {f} <> '')) AS {f}" for f in ("object_name", "org", "stage")) + " FROM p GROUP BY section",
    "field_conflicts": _PLACED + f""", m AS (SELECT section, document, number, title AS mt, stage AS ms FROM p WHERE place = 1), o AS (SELECT p.*, mt, ms FROM p JOIN m USING (section, document, number) WHERE place > 1)
SELECT section, document, number, variant_id, 'title' AS field, mt AS "left", title AS "right" FROM o WHERE mt <> '' AND title <> '' AND {_FOLD_TITLE("mt")} <> {_FOLD_TITLE("title")}
UNION ALL SELECT section, document, number, variant_id, 'stage', ms, stage FROM o WHERE ms <> '' AND stage <> '' AND {_FOLD_TITLE("ms")} <> {_FOLD_TITLE("stage")}""",
    "duplicate_sheets": _PLACED + ", t AS (" + _TREE + ") SELECT section, document, number, variants, kinds FROM t WHERE variants >= 2",
    "number_conflicts": _SIDED + _KLN + f""", s AS (SELECT kit, left_side, {_SKEL} AS sk, array_to_string({_NUMSQL}, ';') AS nums, trim(line,' ') AS line FROM ln WHERE NOT regexp_matches(line, '^\\s*(#{{1,6}}\\s|\\|[\\s:|-]+\\|\\s*$|_[^_]*_\\s*$|-{{3,}}\\s*$|>\\s)')),
u AS (SELECT kit, left_side, sk, min(nums) AS nums, min(line) AS line FROM s WHERE length(sk) >= 12 AND length(regexp_replace(sk, '[^A-Za-zА-Яа-яЁё]', '', 'g')) >= 4 AND contains(sk, '#') GROUP BY ALL HAVING count(*) = 1)
SELECT a.kit, replace(a.sk, '#', '…') AS phrase, a.line AS "left", b.line AS "right" FROM u a JOIN u b ON a.kit = b.kit AND a.sk = b.sk AND a.left_side AND NOT b.left_side WHERE a.nums <> b.nums""",
    "kit_token_sets": _SIDED + _TOK + " SELECT kit, count_if(l) AS \"left\", count_if(r) AS \"right\", count_if(l AND r) AS common, count_if(NOT r) AS left_only, count_if(NOT l) AS right_only FROM b GROUP BY kit",
    "kit_jaccard": _SIDED + _TOK + " SELECT kit, 100.0::DOUBLE * count_if(l AND r) / count(*) AS jaccard FROM b GROUP BY kit",
    "united_lines": _SIDED.replace(" AND source IS NOT NULL", "") + _KLN + f" SELECT kit, page, count(DISTINCT lower({_SQ.format(c='line')})) AS lines FROM ln WHERE lower({_SQ.format(c='line')}) <> '' GROUP BY kit, page",
    "added_lines": _SIDED + _KLN + f", k AS (SELECT *, lower({_SQ.format(c='line')}) AS k FROM ln) SELECT kit, count(*) AS lines FROM k a WHERE NOT left_side AND k <> '' AND NOT starts_with(trim(line,' '), '#') AND NOT EXISTS (SELECT 1 FROM k b WHERE b.left_side AND b.kit = a.kit AND b.k = a.k) GROUP BY kit",
    "token_recall": _SIDED + f", w AS (SELECT DISTINCT kit, left_side, {_YO.format(c='lower(x)')} AS token FROM (SELECT kit, left_side, unnest(regexp_extract_all(text, '{T.WORD}')) AS x FROM d)) SELECT a.kit, count(*) AS expected, count(b.token) AS hits, count(b.token) / count(*) AS recall FROM w a LEFT JOIN w b ON a.kit = b.kit AND a.token = b.token AND NOT b.left_side WHERE a.left_side GROUP BY a.kit",
    "duplicate_line_ratio": _LN + f""", k AS (SELECT doc_id, {_SQ.format(c="trim(line,' ')")} AS k FROM ln), e AS (SELECT doc_id, CASE WHEN length(k) >= 12 AND NOT regexp_matches(k, '^(---|\\||```|#)') THEN k END AS k FROM k), c AS (SELECT doc_id, count(k) AS total, count(DISTINCT k) AS distinct_lines FROM e GROUP BY doc_id) SELECT doc_id, total, distinct_lines, CASE WHEN total > 0 THEN (total - distinct_lines) / total ELSE 0.0 END AS ratio FROM c""",
    "best_reference_pages": f"""WITH i AS (SELECT DISTINCT item_id, lower(unnest(regexp_extract_all(text, '{T.TOKEN}'))) AS token FROM eval_items), p AS (SELECT DISTINCT doc_id, lower(unnest(regexp_extract_all(text, '{T.TOKEN}'))) AS token FROM documents), il AS (SELECT * FROM i WHERE length(token) >= 2), h AS (SELECT item_id, doc_id, count(*) AS hits FROM il JOIN p USING (token) GROUP BY ALL), n AS (SELECT item_id, count(*) AS size FROM il GROUP BY ALL)
SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY hits DESC, doc_id) AS rank, hits, hits / size AS recall FROM h JOIN n USING (item_id) QUALIFY rank <= 5""",
    "unsupported_facts": _SIDED + f", f AS (SELECT DISTINCT kit, left_side, lower(translate(regexp_replace(unnest(regexp_extract_all(text, '{T.FACT}')), '[ \\t\\n\\r\\f]+', '', 'g'), 'Ø,', '∅.')) AS fact FROM d) SELECT a.kit, count(*) AS facts, count_if(b.fact IS NULL) AS missing, count_if(b.fact IS NULL) / count(*) AS unsupported FROM f a LEFT JOIN f b ON a.kit = b.kit AND a.fact = b.fact AND b.left_side WHERE NOT a.left_side GROUP BY a.kit",
    "page_kind_scores": """WITH d AS (SELECT doc_id, lower(lang) AS lang, coalesce(page_kind = 'table', false) AS e, coalesce(len(regexp_extract_all(chr(10) || text, '\\n[ ]*\\|')) * 2 >= len(regexp_extract_all(text, '\\n')) + 1, false) AS a FROM documents WHERE lang IS NOT NULL), c AS (SELECT lang, count_if(e AND a) AS tp, count_if(a AND NOT e) AS fp, count_if(e AND NOT a) AS fn FROM d WHERE e OR a GROUP BY lang),
s AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) WHEN fn = 0 THEN 1.0 ELSE 0.0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) WHEN fp = 0 THEN 1.0 ELSE 0.0 END AS recall FROM c) SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM s""",
    "checked_pages": "SELECT source, count(*) AS pages, count_if(contains(text, 'Страница') AND NOT contains(text, '[mock]') AND (contains(lower(text), 'шаг') OR contains(lower(text), 'отм') OR contains(lower(text), 'площад'))) AS passed FROM documents WHERE text IS NOT NULL GROUP BY source",
    "density": f"WITH d AS (SELECT source, length(text) AS chars, len(list_distinct(list_transform(regexp_extract_all(text, '{T.FACT}'), lambda x: lower(translate(regexp_replace(x, '[ \\t\\n\\r\\f]+', '', 'g'), 'Ø,', '∅.'))))) AS facts FROM documents WHERE text IS NOT NULL AND source IS NOT NULL) SELECT source, sum(chars)::BIGINT AS chars, sum(facts)::BIGINT AS facts, count(*) AS pages, sum(chars) / nullif(sum(facts), 0) AS chars_per_fact FROM d GROUP BY ROLLUP (source)",
    "fresh_readings": _SIDED + _KLN + f""", t AS (SELECT kit, page, doc_id, pos, left_side, line, list_distinct(list_transform(regexp_extract_all(line, '{T.TOKEN}'), lambda x: lower(x))) AS ts FROM ln), ev AS (SELECT kit, page, doc_id, pos, left_side, unnest(ts) AS token FROM t),
fr AS (SELECT DISTINCT a.kit, a.page, a.doc_id, a.pos FROM ev a WHERE NOT a.left_side AND length(a.token) >= 3 AND NOT EXISTS (SELECT 1 FROM ev b WHERE b.left_side AND b.kit = a.kit AND b.page IS NOT DISTINCT FROM a.page AND b.token = a.token)),
ov AS (SELECT kit, page, doc_id, pos, max(n) AS n FROM (SELECT a.kit, a.page, a.doc_id, a.pos, b.doc_id AS bd, b.pos AS bp, count(*) AS n FROM ev a JOIN ev b ON b.left_side AND NOT a.left_side AND a.kit = b.kit AND a.page = b.page AND a.token = b.token GROUP BY ALL) GROUP BY kit, page, doc_id, pos)
SELECT t.kit, t.page, t.doc_id, t.pos::INTEGER AS pos, t.line FROM t JOIN fr ON fr.kit = t.kit AND fr.page = t.page AND fr.doc_id = t.doc_id AND fr.pos = t.pos LEFT JOIN ov ON ov.kit = t.kit AND ov.page = t.page AND ov.doc_id = t.doc_id AND ov.pos = t.pos WHERE NOT t.left_side AND coalesce(ov.n, 0) < 0.6 * len(t.ts)""",
}
