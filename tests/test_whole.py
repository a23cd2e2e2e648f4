"""Queries give the whole of what their operator is for."""

import hashlib

import pytest

from kitloom.plans import registry
from kitloom.plans.kits import FILE_SOURCES
from kitloom.session import table

from .oracle import DATA, connect, rows_of_spark, rows_of_sql

SF = DATA / "sf0.001"
FILE, OTHER = FILE_SOURCES[0], "another"


@pytest.mark.skipif(not SF.exists(), reason="no test data")
def test_every_caption_has_a_place(spark):
    captions = table(spark, str(SF), "text_items").filter("x is not null and y is not null and text is not null").select("document_id", "sheet", "x", "y", "text").distinct()
    placed = registry.QUERIES["text_places"](spark, str(SF))
    assert placed.count() == captions.count()
    assert placed.filter("place > 3").count() > 0


@pytest.fixture
def kit(spark, tmp_path):
    """A page with two readings on each side and one more that is empty."""
    rows = [
        (1, "k", 1, "", "pdf"), (2, "k", 1, "общая строка alpha\nповтор\n\nповтор", FILE), (3, "k", 1, "Общая  строка alpha\nтолько gamma здесь", FILE),
        (4, "k", 1, "вставка delta первая", OTHER), (5, "k", 1, "вывод omega второй\nтолько gamma здесь", OTHER), (6, "k", 2, None, FILE),
    ]
    spark.createDataFrame(rows, "doc_id long, kit string, page int, text string, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    return tmp_path


def _both(spark, kit, name):
    rows = rows_of_spark(registry.QUERIES[name](spark, str(kit)))
    if name in registry.ORACLE:
        assert rows == rows_of_sql(connect(kit), registry.ORACLE[name])
    return rows[1]


def test_all_readings_of_a_page_are_fused(spark, kit):
    assert _both(spark, kit, "fused_pages") == [("2", "k", "1")]


def test_lines_of_all_readings_are_judged(spark, kit):
    assert [(doc, line) for doc, _, line, _, _ in _both(spark, kit, "fresh_readings")] == [("4", "вставка delta первая"), ("5", "вывод omega второй")]


def test_kits_are_assembled_from_all_readings(spark, kit):
    body = "общая строка alpha\nповтор\n\nповтор\nтолько gamma здесь\nвставка delta первая\nвывод omega второй"
    text = f"## Страница 1\n\n{body}\n\n## Страница 2\n\n"
    assert _both(spark, kit, "assembled_readings") == [(str(len(text)), hashlib.md5(text.encode()).hexdigest(), "k")]
