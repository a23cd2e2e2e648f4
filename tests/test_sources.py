from kitloom.functions import tables
from kitloom.sources import kitsource

from .test_operators import _docx


def test_table_functions(spark):
    tables.register(spark)
    text = "## Страница 2\nУзел 5, узел\n## Страница 7\nб"
    df = spark.createDataFrame([(1, text), (2, "без страниц"), (3, None)], "id int, text string")
    df.createOrReplaceTempView("texts_of_pages")
    got = spark.sql("select id, p.page, p.body from texts_of_pages, lateral split_pages(text) p").collect()
    assert sorted(map(tuple, got)) == [(1, 2, "Узел 5, узел"), (1, 7, "б"), (2, 1, "без страниц")]
    assert spark.sql("select count(*) from texts_of_pages, lateral text_lines(text)").first()[0] == 5
    tokens = spark.sql("select token from texts_of_pages, lateral text_tokens(text) where id = 1").collect()
    assert [r[0] for r in tokens] == ["страница", "2", "узел", "5", "7"]


def test_kit_source(spark, tmp_path):
    kitsource.register(spark)
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.md").write_text("## Страница 1\nа\n## Страница 3\nб")
    (tmp_path / "sub/b.docx").write_bytes(_docx("<w:p><w:r><w:t>текст</w:t></w:r></w:p>"))
    (tmp_path / "c.docx").write_bytes(b"x")
    (tmp_path / "d.txt").write_text("no")
    rows = spark.read.format("kit").load(str(tmp_path)).collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["page"], r["kind"], r["body"]) for r in rows) == [("a.md", 1, "text", "а"), ("a.md", 3, "text", "б"), ("b.docx", 1, "text", "текст"), ("c.docx", 0, "error", "BadZipFile")]
    (tmp_path / "empty").mkdir()
    assert spark.read.format("kit").load(str(tmp_path / "empty")).collect() == []
