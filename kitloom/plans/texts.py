"""Registered queries of text functions and line operators over the project's texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import lines as L
from ..session import table


def _items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "text_items").filter("text is not null")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return L.lines(table(spark, d, "documents"), ["doc_id"])


def folded_titles(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("stamp.title")
    return table(spark, d, "variants").select("variant_id", T.fold_title(t).alias("title"), T.fold(t).alias("folded"), T.fold_caption(t).alias("caption"), T.slug(t).alias("slug"))


def stamp_codes(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("stamp.code")
    return table(spark, d, "variants").select("variant_id", T.canonical_code(c).alias("code"), T.section_of(c).alias("section"), T.is_text_part(c).alias("text_part"), T.looks_like_code(c).alias("is_code"), T.clean_number(F.col("stamp.sheet")).alias("sheet"))


def line_skeletons(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).groupBy(T.skeleton(F.col("text")).alias("skeleton")).agg(F.count("*").alias("n"), F.countDistinct(F.array_join(T.numbers(F.col("text")), ";")).alias("n_numbers"))


def item_tokens(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "note_texts").filter("text is not null").dropDuplicates(["id"])
    return t.select("id", F.explode(T.tokens(F.col("text"))).alias("token"))


def item_facts(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).select("item_id", F.explode(T.facts(F.col("text"))).alias("fact"))


def scored_tokens(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.size(T.words(t)).alias("n_words"), F.size(T.codes(t)).alias("n_codes"), F.coalesce(T.code_in_body(t), F.lit("")).alias("code")).filter("n_words >= 0")


def glued_numbers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.explode(T.scored_numbers(F.col("text"))).alias("number"))


def value_classes(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    kinds = _items(spark, d).select(T.value_class(t).alias("class"), T.is_level(t).alias("level"), T.is_linear_size(t).alias("linear"), T.is_service_text(t).alias("service"))
    return kinds.groupBy("class", "level", "linear", "service").agg(F.count("*").alias("n"))


def garbled_pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.garbled_share(F.col("text")).alias("share")).filter("share is not null")


def legend_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "legend_entries").filter("label is not null").groupBy(T.label_key(F.col("label")).alias("label")).agg(F.count("*").alias("n"), F.countDistinct("signature").alias("signatures"))


def label_terms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "legend_reference").select("ref_id", F.explode(T.context_terms(F.col("label"))).alias("term"))


def sheet_counts_worded(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "variants").groupBy(F.coalesce("stamp.code", F.lit("")).alias("code")).agg(F.count("*").alias("n"))
    return n.select("code", "n", T.plural(F.col("n"), "лист", "листа", "листов").alias("word"), T.circled(F.col("n").cast("int")).alias("mark"))


def page_bodies(spark: SparkSession, d: str) -> DataFrame:
    p = L.pages(table(spark, d, "documents").filter("text is not null"), ["doc_id"])
    return p.select("doc_id", "page", F.length("body").cast("long").alias("chars"), F.md5("body").alias("digest"))


def line_runs(spark: SparkSession, d: str) -> DataFrame:
    r = L.runs(_lines(spark, d), ["doc_id"], F.trim("line")).filter("run_len >= 2 and run_pos = 1")
    return r.select("doc_id", "pos", F.col("run_key").alias("line"), "run_len")


def limited_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.limit_equal_lines(_lines(spark, d), ["doc_id"]).groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


def first_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.first_occurrences(_lines(spark, d), ["doc_id"]).groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


def lines_before_repeat(spark: SparkSession, d: str) -> DataFrame:
    return L.cut_at_repeat(_lines(spark, d), ["doc_id"], 3).groupBy("doc_id").agg(F.count("*").alias("lines"))


def list_stem_runs(spark: SparkSession, d: str) -> DataFrame:
    return L.collapse_list_stems(_lines(spark, d), ["doc_id"], 3).filter(F.col("line").startswith("[truncated")).select("doc_id", "pos")


def table_progressions(spark: SparkSession, d: str) -> DataFrame:
    return L.collapse_table_progressions(_lines(spark, d), ["doc_id"], 4).filter(F.col("line").startswith("[truncated")).select("doc_id", "pos", "line")


def document_cells(spark: SparkSession, d: str) -> DataFrame:
    c = L.table_cells(_lines(spark, d), ["doc_id"])
    return c.groupBy("doc_id", "table_no", "col").agg(F.count("*").alias("rows"), F.count_if(F.col("cell") != "").alias("filled"))


def ragged_tables(spark: SparkSession, d: str) -> DataFrame:
    return L.ragged_tables(_lines(spark, d), ["doc_id"])


def empty_rows_stripped(spark: SparkSession, d: str) -> DataFrame:
    return L.strip_empty_rows(_lines(spark, d), ["doc_id"]).groupBy("doc_id").agg(F.count("*").alias("lines"))


def content_line_counts(spark: SparkSession, d: str) -> DataFrame:
    return L.content_lines(_lines(spark, d)).groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


def cleaned_pages(spark: SparkSession, d: str) -> DataFrame:
    return L.text_of(L.clean_chain(_lines(spark, d), ["doc_id"]), ["doc_id"]).select("doc_id", F.length("text").cast("long").alias("chars"))


def label_run_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.collapse_label_runs(_lines(spark, d), ["doc_id"]).groupBy("doc_id").agg(F.count("*").alias("lines"))


_LN = "WITH ln AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM (SELECT doc_id, string_split(replace(text, chr(13), ''), chr(10)) l FROM documents WHERE text IS NOT NULL))"
_RUNS = ", keyed AS (SELECT *, {key} AS k FROM ln), marked AS (SELECT *, CASE WHEN k IS NOT DISTINCT FROM lag(k) OVER w AND pos > 0 THEN 0 ELSE 1 END AS new FROM keyed WINDOW w AS (PARTITION BY doc_id ORDER BY pos)), ided AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS rid FROM marked), run AS (SELECT *, row_number() OVER (PARTITION BY doc_id, rid ORDER BY pos) AS rpos, count(*) OVER (PARTITION BY doc_id, rid) AS rlen FROM ided)"
_SQ = r"trim(regexp_replace({c}, '[ \t\n\r\f]+', ' ', 'g'), ' ')"
_NUM = "[-−]?[0-9]+(?:[.,][0-9]+)?"
_CMPNUM = "CASE WHEN {s} IN ('','-') THEN '0' ELSE {s} END"


def _short(x: str) -> str:
    return f"CASE WHEN contains({x}, '.') THEN regexp_replace(regexp_replace({x}, '0+$', ''), '\\.$', '') ELSE {x} END"


_SEP = r"^[ \t:|-]*-[ \t:|-]*$"
_CELLS = _LN + _RUNS.format(key="starts_with(ltrim(line), '|')") + f", tab AS (SELECT doc_id, dense_rank() OVER (PARTITION BY doc_id ORDER BY rid) AS table_no, rpos AS \"row\", trim(line) AS line FROM run WHERE k AND rlen >= 3), cell AS (SELECT doc_id, table_no, \"row\", unnest(c) AS cell, unnest(range(len(c))) AS col FROM (SELECT *, string_split(regexp_replace(regexp_replace(line, '^\\|', ''), '\\|$', ''), '|') AS c FROM tab WHERE NOT regexp_matches(line, '{_SEP}')))"
_STEM = r"CASE WHEN regexp_matches(trim(line), '^([0-9]{1,4}[.)]\s+|[-*•]\s+)') AND length(st) >= 4 THEN st END"

QUERIES = {f.__name__: f for f in (folded_titles, stamp_codes, line_skeletons, item_tokens, item_facts, scored_tokens, glued_numbers, value_classes, garbled_pages, legend_keys, label_terms, sheet_counts_worded, page_bodies, line_runs, limited_lines, first_lines, lines_before_repeat, list_stem_runs, table_progressions, document_cells, ragged_tables, empty_rows_stripped, content_line_counts, cleaned_pages, label_run_lines)}

_YO = "translate({c}, 'ёЁ', 'еЕ')"
ORACLE = {
    "folded_titles": f"""SELECT variant_id,
  regexp_replace({_SQ.format(c="regexp_replace(" + _YO.format(c="lower(trim(stamp.title))") + ", '[«»\"''`]+', '', 'g')")}, '^[ .]+|[ .]+$', '', 'g') AS title,
  lower({_SQ.format(c="stamp.title")}) AS folded,
  regexp_replace({_YO.format(c="lower(stamp.title)")}, '[ \\t\\n\\r\\f.]+', '', 'g') AS caption,
  coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(trim(coalesce(stamp.title,'')), '[/\\\\ \\t\\n\\r\\f]+', '_', 'g'), '[?#%]+', '', 'g'), '^[_.]+|[_.]+$', '', 'g'), ''), 'без-имени') AS slug
  FROM variants""",
    "stamp_codes": f"""SELECT variant_id, upper({_YO.format(c="regexp_replace(stamp.code, '[ \\t\\n\\r\\f]+', '', 'g')")}) AS code,
  CASE WHEN regexp_matches(trim(stamp.code), '(?i)(\\.пз|\\.тч|\\.пояснительная записка)$') THEN regexp_replace(regexp_replace(trim(stamp.code), '(?i)(\\.пз|\\.тч|\\.пояснительная записка)$', ''), '[ .]+$', '') ELSE trim(stamp.code) END AS section,
  regexp_matches(trim(stamp.code), '(?i)(\\.пз|\\.тч|\\.пояснительная записка)$') AS text_part,
  length(trim(stamp.code)) BETWEEN 5 AND 40 AND regexp_matches(trim(stamp.code), '^[A-Za-zА-Яа-яЁё0-9][A-Za-zА-Яа-яЁё0-9./-]{{4,40}}$') AND regexp_matches(trim(stamp.code), '[-/]') AND length(regexp_replace(trim(stamp.code), '[^0-9]', '', 'g')) * 4 >= length(trim(stamp.code)) AS is_code,
  coalesce(nullif(regexp_extract(stamp.sheet, '([0-9]+)', 1), ''), trim(stamp.sheet)) AS sheet FROM variants""",
    "line_skeletons": f"""WITH s AS (SELECT {_SQ.format(c="regexp_replace(" + _YO.format(c=f"lower(regexp_replace(text, '{_NUM}', '#', 'g'))") + ", '[|·•]+', ' ', 'g')")} AS skeleton,
  list_transform(list_transform(regexp_extract_all(text, '{_NUM}'), lambda x: translate(x, '−,', '-.')), lambda y: {_short("y")}) AS nums FROM text_items WHERE text IS NOT NULL)
  SELECT skeleton, count(*) AS n, count(DISTINCT array_to_string(list_transform(nums, lambda s: CASE WHEN s IN ('','-') THEN '0' ELSE s END), ';')) AS n_numbers FROM s GROUP BY skeleton""",
    "item_tokens": f"""WITH n AS (SELECT DISTINCT id, text FROM note_texts WHERE text IS NOT NULL) SELECT DISTINCT id, lower(unnest(regexp_extract_all(text, '{T.TOKEN}'))) AS token FROM n""",
    "item_facts": f"""SELECT DISTINCT item_id, lower(translate(regexp_replace(unnest(regexp_extract_all(text, '{T.FACT}')), '[ \\t\\n\\r\\f]+', '', 'g'), 'Ø,', '∅.')) AS fact FROM text_items WHERE text IS NOT NULL""",
    "value_classes": f"""WITH k AS (SELECT CASE WHEN regexp_matches(trim(text), '^[0-9]{{1,3}}$') THEN 'digit' WHEN regexp_matches(trim(text), '^[A-Za-zА-Яа-яЁё]{{1,2}}$') THEN 'letter' ELSE 'other' END AS class,
  regexp_matches(trim(text), '^[-+−]?[0-9]{{1,3}}[.,][0-9]{{3}}$') AS level, regexp_matches(trim(text), '^[0-9]{{2,6}}$') AS linear,
  regexp_matches(regexp_replace({_YO.format(c="lower(text)")}, '[ \\t\\n\\r\\f.]+', '', 'g'), '{T.SERVICE_START}') AS service FROM text_items WHERE text IS NOT NULL)
  SELECT class, level, linear, service, count(*) AS n FROM k GROUP BY ALL""",
    "garbled_pages": """WITH c AS (SELECT doc_id, len(regexp_extract_all(text, '[А-Яа-яЁё]')) u, len(regexp_extract_all(text, '[À-ʯЀЂ-ЏѐђѓєѕіїјљњћќўџҐґ]')) o FROM documents WHERE text IS NOT NULL) SELECT doc_id, o / (u + o) AS share FROM c WHERE u + o >= 30""",
    "legend_keys": f"""SELECT trim(regexp_replace(regexp_replace({_YO.format(c="lower(label)")}, '[^A-Za-zА-Яа-яЁё0-9]+', ' ', 'g'), '([0-9]) (мм|см|м|кв|л)( |$)', '\\1\\2\\3', 'g')) AS label, count(*) AS n, count(DISTINCT signature) AS signatures FROM legend_entries WHERE label IS NOT NULL GROUP BY 1""",
    "label_terms": f"""WITH w AS (SELECT ref_id, unnest(regexp_extract_all({_YO.format(c="lower(label)")}, '[а-яa-z]{{4,}}')) AS w FROM legend_reference), s AS (SELECT ref_id, w, regexp_replace(w, '(иями|ями|ами|ого|его|ому|ему|ыми|ими|ией|иях|ах|ях|ый|ий|ой|ая|яя|ое|ее|ые|ие|ую|юю|ов|ев|ей|ом|ем|ам|ям|а|я|о|е|ы|и|у|ю|ь)$', '') AS c FROM w) SELECT DISTINCT ref_id, CASE WHEN length(c) >= 4 THEN c ELSE w END AS term FROM s""",
    "sheet_counts_worded": f"""WITH n AS (SELECT coalesce(stamp.code, '') AS code, count(*) AS n FROM variants GROUP BY 1) SELECT code, n, CASE WHEN n % 100 BETWEEN 11 AND 14 THEN 'листов' WHEN n % 10 = 1 THEN 'лист' WHEN n % 10 BETWEEN 2 AND 4 THEN 'листа' ELSE 'листов' END AS word, CASE WHEN n BETWEEN 1 AND 20 THEN '{T.CIRCLED}'[n:n] ELSE '(' || n || ')' END AS mark FROM n""",
    "line_runs": _LN + _RUNS.format(key="trim(line)") + " SELECT doc_id, pos, k AS line, rlen AS run_len FROM run WHERE rlen >= 2 AND rpos = 1",
    "limited_lines": _LN + _RUNS.format(key="trim(line)") + " SELECT doc_id, count(*) AS lines, sum(length(line)) AS chars FROM run WHERE k = '' OR rpos <= 2 GROUP BY doc_id",
    "first_lines": _LN + f""", k AS (SELECT *, CASE WHEN length(lower({_SQ.format(c="line")})) >= 8 AND NOT regexp_matches(trim(line), '^(#|\\||---|>|```)') THEN lower({_SQ.format(c="line")}) END AS k FROM ln), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, k ORDER BY pos) AS n FROM k) SELECT doc_id, count(*) AS lines, sum(length(line)) AS chars FROM n WHERE k IS NULL OR n = 1 GROUP BY doc_id""",
    "lines_before_repeat": _LN + f""", k AS (SELECT *, lower({_SQ.format(c="line")}) AS k FROM ln), n AS (SELECT *, CASE WHEN k <> '' THEN row_number() OVER (PARTITION BY doc_id, k ORDER BY pos) END AS n FROM k), c AS (SELECT *, min(CASE WHEN n >= 3 THEN pos END) OVER (PARTITION BY doc_id) AS c FROM n) SELECT doc_id, count(*) AS lines FROM c WHERE c IS NULL OR pos < c GROUP BY doc_id""",
    "list_stem_runs": _LN.replace("WITH ln AS", "WITH raw AS") + f""", ln AS (SELECT *, lower({_SQ.format(c="regexp_replace(regexp_replace(trim(line), '^([0-9]{1,4}[.)]\\s+|[-*•]\\s+)', ''), '[0-9]+([.,][0-9]+)?', '#', 'g')")}) AS st FROM raw)""" + _RUNS.format(key=_STEM) + " SELECT doc_id, pos FROM run WHERE k IS NOT NULL AND rlen >= 3 AND rpos = 3",
    "document_cells": _CELLS + " SELECT doc_id, table_no, col, count(*) AS rows, count_if(trim(cell) <> '') AS filled FROM cell GROUP BY ALL",
    "ragged_tables": _CELLS + ", w AS (SELECT doc_id, table_no, \"row\", count(*) AS cells FROM cell GROUP BY ALL) SELECT doc_id, table_no, max(cells) AS widest, arg_min(cells, \"row\") AS header FROM w GROUP BY ALL HAVING max(cells) > arg_min(cells, \"row\") + 1",
    "content_line_counts": _LN + r""", c AS (SELECT doc_id, trim(regexp_replace(trim(line), '^[-*•]\s+', '')) AS line FROM ln WHERE NOT (trim(line) = '' OR regexp_matches(trim(line), '^(\||>|#|---)') OR (starts_with(trim(line), '_') AND ends_with(trim(line), '_')) OR regexp_matches(trim(line), '(?i)^\[(warning|mock|ocr|truncated|inline)|^_?\[mock\]|^\[.{0,40}схлопнут'))) SELECT doc_id, count(*) AS lines, sum(length(line)) AS chars FROM c WHERE length(line) >= 3 GROUP BY doc_id""",
    "label_run_lines": _LN + _RUNS.format(key="trim(line)") + ", x AS (SELECT *, CASE WHEN length(k) <= 20 AND k <> '' AND NOT contains(k, ' ') AND rlen >= 4 THEN 2 WHEN k <> '' AND length(k) <= 40 AND rlen >= 8 THEN 1 END AS keep FROM run) SELECT doc_id, count(*) AS lines FROM x WHERE (keep IS NULL OR rpos <= keep + 1) AND (k <> '' OR rpos = 1) GROUP BY doc_id",
    "empty_rows_stripped": _LN + r""", n AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS nx FROM ln) SELECT doc_id, count(*) AS lines FROM n WHERE NOT (regexp_matches(trim(line, ' '), '^\|[| \t]*$') AND NOT coalesce(regexp_matches(trim(nx, ' '), '^\|[ \t:|-]*-[ \t:|-]*$'), false)) GROUP BY doc_id""",
    "page_bodies": r"""WITH p AS (SELECT doc_id, string_split(regexp_replace(chr(10) || text, '\n## Страница ([0-9]+[ \t]*)(\n|$)', chr(1) || '\1' || chr(2), 'g'), chr(1)) AS ps FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, unnest(ps) AS part, unnest(range(len(ps))) AS n, len(ps) = 1 AS only_ FROM p),
b AS (SELECT doc_id, CASE WHEN only_ THEN 1 ELSE try_cast(regexp_extract(part, '^([0-9]+)', 1) AS INTEGER) END AS page, trim(CASE WHEN only_ THEN part ELSE regexp_replace(part, '^[0-9]+[ \t]*\x02', '') END, ' ') AS body FROM e WHERE only_ OR n > 0)
SELECT doc_id, page, length(body) AS chars, md5(body) AS digest FROM b""",
    "table_progressions": _LN.replace("WITH ln AS", "WITH raw AS") + f""", num AS (SELECT *, regexp_extract(line, '(-?[0-9]+(?:[.,][0-9]+)?)', 1) AS f FROM raw), ln AS (SELECT *, CASE WHEN starts_with(ltrim(line, ' '), '|') AND NOT regexp_matches(trim(line, ' '), '{_SEP}') AND f <> '' THEN lower({_SQ.format(c="regexp_replace(line, '-?[0-9]+(?:[.,][0-9]+)?', '#', 'g')")}) END AS shape FROM num)""" + _RUNS.format(key="shape") + """, st AS (SELECT *, round(try_cast(replace(f, ',', '.') AS DOUBLE) - lag(try_cast(replace(f, ',', '.') AS DOUBLE)) OVER (PARTITION BY doc_id, rid ORDER BY pos), 4) AS step FROM run), ev AS (SELECT *, min(step) OVER (PARTITION BY doc_id, rid) = max(step) OVER (PARTITION BY doc_id, rid) AS even FROM st) SELECT doc_id, pos, '[truncated-table-progression: ещё ' || (rlen - 3) || ' однотипных строк с постоянным шагом]' AS line FROM ev WHERE k IS NOT NULL AND rlen >= 4 AND coalesce(even, false) AND rpos = 4""",
}
