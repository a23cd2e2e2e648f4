"""Registered queries of folds, writers and the character-map repair over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import charmap, folds
from ..operators import lines as L
from ..operators import recon as R
from ..session import table
from ..sources import writers
from .kits import _PLACED, _TREE
from .texts import _CELLS, _SQ


def folded_documents(spark: SparkSession, d: str) -> DataFrame:
    return folds.cleaned(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.length("text").cast("long").alias("chars"), F.md5("text").alias("digest"))


def assembled_readings(spark: SparkSession, d: str) -> DataFrame:
    """Kits from all readings of a page: after each reading the lines of the next that no earlier one has."""
    docs = table(spark, d, "documents").filter("kit is not null")
    text = F.when(F.col("text").rlike(r"\S"), F.regexp_replace("text", "\r", ""))
    read = docs.select("kit", "page", "doc_id", F.posexplode_outer(F.split(text, "\n")).alias("pos", "line"))
    first = F.min("doc_id").over(Window.partitionBy("kit", "page", T.fold(F.col("line"))))
    pages = L.text_of(read.withColumn("first", first).filter("doc_id = first").withColumn("pos", F.struct("doc_id", "pos")), ["kit", "page"]).withColumnRenamed("text", "body")
    return writers.assembled(pages, ["kit"]).select("kit", F.length("text").cast("long").alias("chars"), F.md5("text").alias("digest"))


def kit_contents(spark: SparkSession, d: str) -> DataFrame:
    return writers.contents(R.sheet_tree(table(spark, d, "variants"))).select("section", "document", "sheets", F.md5("text").alias("digest"))


def kit_json(spark: SparkSession, d: str) -> DataFrame:
    return writers.nested(R.sheet_tree(table(spark, d, "variants")))


def rebuilt_tables(spark: SparkSession, d: str) -> DataFrame:
    cells = L.table_cells(L.lines(table(spark, d, "documents"), ["doc_id"]), ["doc_id"])
    return writers.markdown_tables(cells, ["doc_id", "table_no"]).select("doc_id", "table_no", F.length("text").cast("long").alias("chars"))


def charmap_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Characters of captions outside the plain ranges that a map from shifted words would recover, by source."""
    items = table(spark, d, "text_items").filter("text is not null")
    words = charmap.word_counts(items)
    broken = words.filter(~F.col("word").rlike("^[A-Za-zА-Яа-яЁё]+$"))
    known = words.filter(F.col("word").rlike("^[а-яё]{4,}$"))
    return charmap.coverage(items, charmap.build_mapping(broken, known), ["source"])


def charmap_shifts(spark: SparkSession, d: str) -> DataFrame:
    words = charmap.word_counts(table(spark, d, "text_items"))
    return charmap.shifts(words.filter(~F.col("word").rlike("[A-Za-zА-Яа-яЁё]")), words.filter(F.col("word").rlike("^[а-яё]{4,}$")))


QUERIES = {f.__name__: f for f in (folded_documents, assembled_readings, kit_contents, kit_json, rebuilt_tables, charmap_coverage, charmap_shifts)}

ORACLE = {
    "assembled_readings": rf"""WITH ln AS (SELECT kit, page, doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM (SELECT kit, page, doc_id, string_split(replace(text, chr(13), ''), chr(10)) AS l FROM documents WHERE kit IS NOT NULL AND regexp_matches(text, '\S'))),
f AS (SELECT *, min(doc_id) OVER (PARTITION BY kit, page, lower({_SQ.format(c='line')})) AS first FROM ln), b AS (SELECT kit, page, string_agg(line, chr(10) ORDER BY doc_id, pos) AS body FROM f WHERE doc_id = first GROUP BY ALL), p AS (SELECT DISTINCT kit, page FROM documents WHERE kit IS NOT NULL),
a AS (SELECT kit, string_agg('## Страница ' || page || chr(10) || chr(10) || coalesce(body, ''), chr(10) || chr(10) ORDER BY page) AS text FROM p LEFT JOIN b USING (kit, page) GROUP BY kit) SELECT kit, length(text)::BIGINT AS chars, md5(text) AS digest FROM a""",
    "kit_contents": _PLACED + ", t AS (" + _TREE + "), o AS (SELECT *, nullif(regexp_extract(trim(number,' '), '^([0-9]+)', 1), '') AS n, number || ' | ' || coalesce(title, '-') || ' | ' || kinds || ' | ' || variants AS l FROM t) SELECT section, document, count(*) AS sheets, md5(string_agg(l, chr(10) ORDER BY (n IS NULL)::INT, coalesce(n::DOUBLE, 0), number, l)) AS digest FROM o GROUP BY ALL",
    "rebuilt_tables": _CELLS + ", r AS (SELECT doc_id, table_no, \"row\", count(*) AS n, sum(length(replace(coalesce(nullif(trim(cell,' '), ''), '-'), '|', '\\|'))) AS c FROM cell GROUP BY ALL) SELECT doc_id, table_no, (sum(c + 3 * n + 1) + (count(*) - 1) + 1 + 1 + 4 * arg_min(n, \"row\"))::BIGINT AS chars FROM r GROUP BY ALL",
}
