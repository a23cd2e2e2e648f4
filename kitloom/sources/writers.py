"""Sinks: ordered documents, reports, sidecars and tables of geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def assembled(pages: DataFrame, keys: list[str]) -> DataFrame:
    """One text per key: pages in number order under their headings."""
    piece = F.concat(F.lit("## Страница "), F.col("page").cast("string"), F.lit("\n\n"), F.coalesce("body", F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct("page", piece.alias("p"))))
    return pages.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["p"]), "\n\n").alias("text"))


def replaced_page(pages: DataFrame, keys: list[str], new: DataFrame) -> DataFrame:
    """Pages with those of new in place of their own."""
    return pages.join(new.select(*keys, "page").distinct(), [*keys, "page"], "left_anti").unionByName(new.select(*pages.columns))


def markdown_tables(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Pipe tables from (keys..., row, col, cell); blank cells are a dash, the first row is the header."""
    safe = F.coalesce(F.nullif(T.markdown_cell(F.trim("cell")), F.lit("")), F.lit("-"))
    row = cells.groupBy(*keys, "row").agg(F.array_sort(F.collect_list(F.struct("col", safe.alias("c")))).alias("cs"))
    line = F.concat(F.lit("| "), F.array_join(F.transform("cs", lambda x: x["c"]), " | "), F.lit(" |"))
    ruled = row.select(*keys, "row", line.alias("line"), F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.size("cs"))).alias("rule"))
    ordered = F.array_sort(F.collect_list(F.struct("row", "line", "rule")))
    lines = F.concat(F.slice(F.transform(ordered, lambda x: x["line"]), 1, 1), F.slice(F.transform(ordered, lambda x: x["rule"]), 1, 1), F.slice(F.transform(ordered, lambda x: x["line"]), F.lit(2), F.greatest(F.size(ordered) - 1, F.lit(0))))
    return ruled.groupBy(*keys).agg(F.array_join(lines, "\n").alias("text"))


def contents(tree: DataFrame) -> DataFrame:
    """The contents of each document: one line per sheet in sheet order."""
    line = F.concat_ws(" | ", "number", F.coalesce("title", F.lit("-")), "kinds", F.col("variants").cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct(T.sheet_order(F.col("number")).alias("o"), line.alias("l"))))
    return tree.groupBy("section", "document").agg(F.array_join(F.transform(ordered, lambda x: x["l"]), "\n").alias("text"), F.count("*").alias("sheets"))


def nested(tree: DataFrame) -> DataFrame:
    """Sections with their documents and sheets as JSON; drawings before text parts, no code last."""
    sheets = tree.groupBy("section", "document", "text_part").agg(F.transform(F.array_sort(F.collect_list(F.struct(T.sheet_order(F.col("number")).alias("o"), "number", "title", "variants"))), lambda x: F.struct(x["number"].alias("number"), x["title"].alias("title"), x["variants"].alias("variants"))).alias("sheets"))
    documents = sheets.groupBy("section").agg(F.array_sort(F.collect_list(F.struct("text_part", "document", "sheets"))).alias("documents"))
    return documents.select("section", F.to_json(F.struct("section", "documents")).alias("json")).orderBy(F.col("section").startswith("("), "section")


def write_sidecars(df: DataFrame, path: str, keys: tuple[str, ...] = ("document_id", "page")) -> None:
    """JSON files by key; the commit protocol makes each write whole or absent."""
    df.repartition(*keys).write.mode("overwrite").partitionBy(*keys).json(path)


def write_geometry(primitives: DataFrame, path: str) -> None:
    """CSV of primitives with their points as x,y pairs."""
    points = F.array_join(F.transform("points", lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ";")
    primitives.withColumn("points", points).write.mode("overwrite").option("header", "true").csv(path)
