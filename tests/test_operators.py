import datetime as dt
import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from kitloom.functions import text as T
from kitloom.operators import charmap, folds
from kitloom.operators import geometry as G
from kitloom.operators import lines as L
from kitloom.operators import matching as M
from kitloom.operators import recon as R
from kitloom.operators import scoring as S
from kitloom.sources import readers, writers
from kitloom.streaming import jobs as J


def _one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "f, value, expected",
    [
        (T.fold_title, "  «Ёлка»  у дома. ", "елка у дома"), (T.fold_caption, "Кол. уч.", "колуч"), (T.clean_number, "лист 12 из 3", "12"), (T.clean_number, " б/н ", "б/н"), (T.compared_number, "−2,050", "-2.05"), (T.compared_number, "-", "0"),
        (T.scored_number, "0,500", ".5"), (T.scored_number, "000", "0"), (T.glue_numbers, "1 500,5 и 4 169", "1500,5 и 4169"), (T.skeleton, "Отметка низа −2,050 | м", "отметка низа # м"), (T.looks_like_code, "41-ПРЛ-2/24-КР1", True), (T.looks_like_code, "ПОЯСНИТЕЛЬНАЯ-ЗАПИСКА", False),
        (T.section_of, "41-ПРЛ-2/24-КР1.ПЗ", "41-ПРЛ-2/24-КР1"), (T.is_text_part, "А-1.тч", True), (T.slug, " а/б?в.. ", "а_бв"), (T.slug, None, "без-имени"), (T.code_in_body, "по ГОСТ см. 41-ПРЛ-2/24 лист", "41-ПРЛ-2/24"), (T.part_order, "Продолжение", 1), (T.is_level, "+12.350", True),
        (T.is_linear_size, "(120)", False), (T.value_class, "Б", "letter"), (T.strip_thinking, "а<think>x</think>б<think>в", "аб"), (T.strip_tile_markers, "<table><tr><td>а</td><td>б</td></tr></table>", "а | б |  |"), (T.label_key, "Ёмкость, 5 мм!", "емкость 5мм"), (T.stem, "канализации", "канализаци"), (T.fact_key, "Ø 80", "∅80"),
        (T.strip_page_heading, "## Страница 3\nтекст", "текст"), (T.markdown_cell, "а|б\nв", "а\\|б<br>в"),
    ],
)
def test_scalar_functions(spark, f, value, expected):
    assert _one(spark, value, f) == expected


def test_page_ranges_and_plurals(spark):
    assert T.page_range("5,1-3, 2,99", 6) == [5, 1, 2, 3]
    got = spark.createDataFrame([(n,) for n in (1, 2, 5, 11, 21, 112)], "n int").select(T.plural(F.col("n"), "лист", "листа", "листов")).collect()
    assert [r[0] for r in got] == ["лист", "листа", "листов", "листов", "лист", "листов"]


def _cleaned(spark, text, step, **kw):
    df = L.lines(spark.createDataFrame([(1, text)], "id int, text string"), ["id"])
    rows = L.text_of(step(df, ["id"], **kw), ["id"]).collect()
    return rows[0]["text"] if rows else None


def test_line_cleaners(spark):
    assert _cleaned(spark, "а\nа\nа\n\nа\nб", L.limit_equal_lines) == "а\nа\n\nа\nб"
    numbers = "\n".join(f"- {i}" for i in range(25))
    assert _cleaned(spark, numbers, L.collapse_number_bullets) == "- 0\n- 1\n- 2\n[truncated-numeric-list]"
    assert _cleaned(spark, "\n".join(f"{i}. Ось {i}" for i in range(9)), L.collapse_list_stems) == "0. Ось 0\n1. Ось 1\n[truncated-numbered-hallucination]"
    table = "\n".join(f"| {i * 2} | ряд |" for i in range(12))
    assert _cleaned(spark, table, L.collapse_table_progressions).endswith("ещё 9 однотипных строк с постоянным шагом]")
    assert _cleaned(spark, table.replace("| 4 |", "| 5 |"), L.collapse_table_progressions) == table.replace("| 4 |", "| 5 |")
    column = "\n\n".join(["DN200", "NC", "102.55", "-1.380", "NC", "7"])
    assert _cleaned(spark, f"фраза тут\n{column}\nконец строки", L.join_value_columns) == "фраза тут\nЗначения на фрагменте: DN200, NC, 102.55, -1.380, 7 [дубли схлопнуты: 1]\nконец строки"
    assert _cleaned(spark, "| | |\n|---|---|\n| | |\n| а | |", L.strip_empty_rows) == "| | |\n|---|---|\n| а | |"
    assert _cleaned(spark, "| а | б |\n" + "|---" * 9 + "|", L.cap_separators) == "| а | б |\n|---|---|"
    assert _cleaned(spark, "\n".join(["ещё", "и"] * 7), L.cut_at_repeat) == "\n".join(["ещё", "и"] * 5)
    assert _cleaned(spark, "длинная строка\n# заг\nдлинная  СТРОКА\n# заг", L.first_occurrences) == "длинная строка\n# заг\n# заг"
    assert _cleaned(spark, "\n".join(["W1"] * 5), L.collapse_label_runs) == "W1\nW1\n(×5 на плане — схлопнуто)"
    assert _cleaned(spark, None, L.limit_equal_lines) is None


def test_pages_and_passes(spark):
    df = spark.createDataFrame([(1, "## Страница 2\nа\n### PASS-0 x\nп\n### PASS-A\nо\n## Страница 10\nб"), (2, "без страниц"), (3, None)], "id int, text string")
    pages = L.pages(df, ["id"])
    assert sorted(map(tuple, pages.select("id", "page").collect())) == [(1, 2), (1, 10), (2, 1)]
    assert sorted(map(tuple, L.passes(pages, ["id", "page"]).select("pass", "body").collect())) == [("PASS-0", "п"), ("PASS-A", "о")]


def test_folds():
    assert folds.without_loops("17.00;" * 20 + "конец строки текста тут").startswith("17.00;17.00;\n[truncated-repeat]")
    assert folds.without_loops("начало текста " + "абвгдежзиклм" * 9).endswith("[truncated-repeat]")
    assert folds.without_loops("| | | | " * 30).count("|") == 90
    assert folds.without_progressions("шаг " + ", ".join(map(str, range(0, 40, 2))) + " всё") == "шаг 0, 2 … 38 всё"
    assert folds.without_progressions("1, 5, 2") == "1, 5, 2"
    assert folds.without_cycles("\n".join(["а", "б"] * 5 + ["в"])) == "а\nб\n[truncated-cycle: блок из 2 строк повторён 5 раз]\nв"
    assert folds.without_phrase_repeats(", ".join(["с утилизацией", "с переработкой"] * 5)) == "с утилизацией, с переработкой"
    row = "| 1 | " + ", ".join(["с утилизацией", "с переработкой"] * 5) + " | да |"
    assert folds.without_phrase_repeats(row) == "| 1 | с утилизацией, с переработкой | да |"
    assert folds.without_phrase_repeats(", ".join(f"фраза номер {k}" for k in range(9))).count(",") == 8
    assert folds.without_cycles("\n".join(["а", "б", "в"] * 4 + ["б", "в"] * 3)) == "а\nб\nв\n[truncated-cycle: блок из 3 строк повторён 4 раз]\nб\nв\nб\nв\nб\nв"
    assert folds.without_cycles("\n".join(["", ""] * 9 + ["к"])).count("\n") == 18
    assert folds.without_error_stubs("а [error (x [y]) z] б") == ("а  б", 1)
    assert folds.wrapped("один два три", 60, 10) == "один два\nтри"
    assert folds.unescaped("\\U+0416к") == "Жк"
    assert folds.sanitized("а\x07б𝟏\nв") == "а б1\nв"
    assert folds.joined_tiers(["фунда-", "мент", "ов", "Плита"]) == "фундаментов<br>Плита"
    assert folds.tile_grid(4000, 1000, 1000, 3) == (3, 1)
    tokens = lambda s: set(s.split())
    assert folds.added_in_order({"старое"}, ["старое", "новое слово", "новое слово", "ещё факт"], tokens, []) == ["новое слово", "ещё факт"]
    assert [f("") for f in folds.CHAIN] == [""] * len(folds.CHAIN)


def test_number_conflicts_need_unique_lines(spark):
    a = spark.createDataFrame([(1, 0, "Отметка низа −2,050"), (1, 1, "Шаг стоек 5 метров"), (1, 2, "Шаг стоек 6 метров"), (1, 3, "# Отметка верха 1")], "id int, pos int, line string")
    b = spark.createDataFrame([(1, 0, "отметка низа -2.150"), (1, 1, "Шаг стоек 7 метров")], "id int, pos int, line string")
    assert [tuple(r) for r in R.number_conflicts(a, b, ["id"], limit=12).collect()] == [(1, "отметка низа …", "Отметка низа −2,050", "отметка низа -2.150")]


def test_fresh_lines(spark):
    schema = "id int, pos int, line string"
    base = spark.createDataFrame([(1, 0, "складской комплекс магистраль")], schema)
    extra = spark.createDataFrame([(1, 0, "складской комплекс магистралъ"), (1, 1, "новая насосная"), (1, 2, "складской комплекс")], schema)
    assert [r["pos"] for r in R.fresh_lines(base, extra, ["id"]).collect()] == [1]


def test_prf_edges(spark):
    e = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "g string, k int")
    got = {r["g"]: (r["precision"], r["recall"]) for r in S.prf(e, e.filter("g = 'a' and k = 1"), ["k"], ["g"]).collect()}
    assert got == {"a": (1.0, 0.5), "b": (0.0, 0.0)}


def test_unique_match_fails_closed(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, None)], "id int, k string")
    right = spark.createDataFrame([("x", "one"), ("x", "one"), ("y", "one"), ("y", "two"), (None, "n")], "k string, v string")
    assert sorted((r["id"], r["v"], r["reason"]) for r in M.unique_match(left, right, ["k"], "v").collect()) == [(1, "one", "matched"), (2, None, "ambiguous"), (3, None, "missing"), (4, None, "missing")]


def test_nearest_and_mutual(spark):
    a = spark.createDataFrame([(1, 1, 0.0, 0.0), (1, 2, 100.0, 0.0)], "s int, a int, x double, y double")
    b = spark.createDataFrame([(1, 7, 3.0, 4.0), (1, 8, -5.0, 0.0), (2, 9, 0.0, 0.0)], "s int, b int, x double, y double")
    assert [(r["a"], r["b"], r["d2"]) for r in M.nearest(a, b, ["s"], left_id="a", right_id="b", radius=8.0).collect()] == [(1, 7, 25.0)]
    pairs = spark.createDataFrame([(1, "p"), (2, "q"), (2, "r")], "a int, b string")
    assert [tuple(r) for r in M.mutual_pairs(pairs, "a", "b").select("a", "b").collect()] == [(1, "p")]
    z = M.zipped(spark.createDataFrame([("t", 2), ("t", 1)], "k string, l int"), spark.createDataFrame([("t", 5)], "k string, r int"), ["k"], "l", "r")
    assert [(r["l"], r["r"]) for r in z.collect()] == [(1, 5)]


def test_components(spark):
    nodes = spark.range(12).select(F.col("id").alias("n"))
    edges = spark.createDataFrame([(i, i + 1) for i in range(8)] + [(10, 11)], "a long, b long")
    got = {r["n"]: r["component"] for r in G.components(nodes, edges, "n", "a", "b").collect()}
    assert got == {**dict.fromkeys(range(9), 0), 9: 9, 10: 10, 11: 10}


def test_text_lines_in_chunks(spark):
    rows = [("d", 1, i, float(i % 7), float(-(i // 3)) * 2, 2.5) for i in range(60)]
    df = spark.createDataFrame(rows, "document_id string, sheet int, item_id long, x double, y double, height double")
    whole = sorted(map(tuple, G.text_lines(df).collect()))
    assert whole == sorted(map(tuple, G.text_lines(df, chunk_rows=7).collect()))
    assert whole[0][3] == 0 and max(r[3] for r in whole) == 19
    assert G.text_lines(df.limit(0)).collect() == []


def test_geometry(spark):
    box = spark.createDataFrame([(0.0, 0.0, 10.0, 10.0)], "x0 double, y0 double, x1 double, y1 double")
    c = [F.col(n) for n in ("x0", "y0", "x1", "y1")]
    assert box.select(G.zone(*c, F.lit(100.0), F.lit(100.0), y_up=True)).first()[0] == "юго-запад"
    assert box.select(G.zone(*c, F.lit(10.0), F.lit(10.0), y_up=False)).first()[0] == G.WHOLE
    line = spark.sql("select array(struct(0D as x, 0D as y), struct(3D as x, 4D as y), struct(3D as x, 5D as y)) as p")
    assert line.select(G.polyline_length(F.col("p"))).first()[0] == 6.0
    x, y = G.to_paper(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(90.0), F.lit(5.0), F.lit(5.0))
    assert [round(v, 9) for v in spark.range(1).select(x, y).first()] == [5.0, 7.0]
    n = spark.createDataFrame([("a", i) for i in (1, 2, 3, 5, 9, 8)], "k string, n int")
    assert G.span_text(n, ["k"], "n").first()["spans"] == "1–3, 5, 8–9"


def test_character_map(spark):
    plain = "насосная станция колодец площадь покрытие отметка котлована раздел балка плита".split()
    vocabulary = [*plain, *(f"слово{c}{d}" for c in "абвгд" for d in "ежзик"), *(f"знак{c}{d}ов" for c in "абвгд" for d in "ежзик")]
    shifted = lambda w: "".join(chr(ord(c) - 500) for c in w)
    known = spark.createDataFrame([(w, 5) for w in vocabulary], "word string, n long")
    mixed = [w.replace("о", "ɔ") for w in plain if "о" in w]
    assert charmap.build_mapping(spark.createDataFrame([(w, 1) for w in mixed], "word string, n long"), known) == {"ɔ": "о"}
    found = charmap.shifts(spark.createDataFrame([(shifted(w), 1) for w in plain], "word string, n long"), known).collect()
    assert [r["delta"] for r in found] == [500]
    assert charmap.build_mapping(known, known.limit(3)) == {}


def _docx(body):
    out = io.BytesIO()
    ns = readers.W[1:-1]
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{ns}"><w:body>{body}</w:body></w:document>')
        z.writestr("word/media/a.png", b"")
    return out.getvalue()


def test_docx_source(spark, tmp_path):
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    table = f'<w:tbl><w:tr><w:tc><w:tcPr><w:gridSpan w:val="2"/></w:tcPr>{p("а")}</w:tc></w:tr><w:tr><w:tc>{p("б")}</w:tc><w:tc>{p("в")}</w:tc></w:tr></w:tbl>'
    data = _docx(p("первый") + table + '<w:p><w:r><w:br w:type="page"/><w:t>второй</w:t></w:r></w:p>')
    (tmp_path / "a.docx").write_bytes(data)
    (tmp_path / "b.docx").write_bytes(b"no zip")
    rows = sorted((r["path"][-6:], r["sheet"], r["kind"], r["text"], r["cells"]) for r in readers.read_docx(spark, str(tmp_path)).collect())
    assert rows == [("a.docx", 1, "table", "", [["а", ""], ["б", "в"]]), ("a.docx", 1, "text", "первый", []), ("a.docx", 2, "text", "второй", []), ("b.docx", 1, "error", "BadZipFile", [])]
    assert readers.docx_media(data) == 1
    assert sorted(r["path"][-6:] for r in readers.discover(spark, str(tmp_path), (".DOCX",)).collect()) == ["a.docx", "b.docx"]


def test_text_and_json_sources(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m/out.md").write_text("## Страница 1\nа\n## Страница 2\nб")
    assert sorted((r["page"], r["body"]) for r in readers.page_texts(spark, str(tmp_path / "m")).collect()) == [(1, "а"), (2, "б")]
    (tmp_path / "x.dxf").write_text("0\nSECTION\nxx\nENTITIES\n")
    assert [(r["line_no"], r["line"]) for r in readers.bad_group_codes(spark, str(tmp_path / "x.dxf")).collect()] == [(2, "xx")]
    assert json.loads(readers.repaired_json('{"a": nan, "b": 5., "c": "nan 5."}')) == {"a": None, "b": 5, "c": "nan 5."}
    dump = '{"OBJECTS": [{"object": "LAYOUT", "handle": 1, "layout_name": "Л"}, {"entity": "TEXT", "handle": 2, "ownerhandle": 1, "text": "т", "ins_pt": [1., 2.5]}]}'
    (tmp_path / "d.json").write_text(dump)
    assert [(r["text"], r["layout_name"]) for r in readers.layout_texts(readers.drawing_objects(spark, str(tmp_path / "d.json"))).collect()] == [("т", "Л")]
    lines = spark.createDataFrame([('{"id": "1", "status": "queued", "other": 5}',), ("broken",)], "value string")
    assert [r["status"] for r in readers.jobs(lines).collect()] == ["queued"]
    images = spark.createDataFrame([("p", 1, bytearray(b"ok")), ("p", 2, bytearray(b"bad"))], "path string, page int, content binary")

    def client(path, content):
        if content == b"bad":
            raise ValueError("no")
        return content.decode()

    assert sorted((r["page"], r["body"], r["error"]) for r in readers.read_pages_with(client, images).collect()) == [(1, "ok", None), (2, None, "no")]


def test_writers(spark, tmp_path):
    pages = spark.createDataFrame([("k", 2, "б"), ("k", 1, "а")], "k string, page int, body string")
    assert writers.assembled(pages, ["k"]).first()["text"] == "## Страница 1\n\nа\n\n## Страница 2\n\nб"
    new = spark.createDataFrame([("k", 2, "в")], "k string, page int, body string")
    assert sorted(r["body"] for r in writers.replaced_page(pages, ["k"], new).collect()) == ["а", "в"]
    cells = spark.createDataFrame([(1, 0, 0, "h"), (1, 0, 1, "i|"), (1, 1, 0, ""), (1, 1, 1, "z")], "t int, row int, col int, cell string")
    assert writers.markdown_tables(cells, ["t"]).first()["text"] == "| h | i\\| |\n|---|---|\n| - | z |"
    writers.write_sidecars(spark.createDataFrame([("d", 1, "x")], "document_id string, page int, v string"), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).first()["v"] == "x"
    primitives = spark.sql("select 'line' as type, array(struct(0D as x, 1D as y)) as points")
    writers.write_geometry(primitives, str(tmp_path / "g"))
    assert spark.read.option("header", True).csv(str(tmp_path / "g")).first()["points"] == "0.0 1.0"


def test_job_state(spark):
    e = spark.createDataFrame([("j", dt.datetime(2024, 1, 1), 1, "queued"), ("j", dt.datetime(2024, 1, 1), 2, "done"), ("i", dt.datetime(2024, 1, 1), 3, "queued")], "job string, ts timestamp, event_id long, state string")
    assert sorted((r["job"], r["state"]) for r in J.latest_state(e, "job").collect()) == [("i", "queued"), ("j", "done")]
    assert [r[0] for r in e.select(J.job_outcome(F.lit(3), F.lit(2), F.lit(1), F.lit(False))).limit(1).collect()] == ["partial"]
    usage = spark.sql("select 'j' as job, map('a', 1L, 'b', 2L) as u union all select 'j', map('a', 5L)")
    assert sorted((r["name"], r["value"]) for r in J.merged_usage(usage, ["job"], "u").collect()) == [("a", 6), ("b", 2)]


def test_budget_stream(spark, tmp_path):
    rows = [("j", p, p != 2) for p in range(1, 6)] + [("k", 1, True)]
    spark.createDataFrame(rows, "job string, page int, needs_model boolean").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = J.budgeted(spark.readStream.schema("job string, page int, needs_model boolean").parquet(str(tmp_path / "in")), 2)
    q = stream.writeStream.format("memory").queryName("verdicts").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted(map(tuple, spark.table("verdicts").collect()))
    assert [v for j, _, v in got if j == "j"].count("model") == 2 and ("j", 2, "layer") in got and ("k", 1, "model") in got
    assert [v for j, _, v in got if j == "j"].count("over budget") == 2


def test_event_stream(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 1, 0, 5), "a"), (1, dt.datetime(2024, 1, 1, 0, 5), "a"), (2, dt.datetime(2024, 1, 1, 0, 50), "a"), (3, dt.datetime(2024, 1, 1, 9, 0), "b")]
    spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string").coalesce(1).write.parquet(str(tmp_path / "in"))
    s = J.tumbling(J.stream(spark, str(tmp_path / "in"), "event_id long, ts timestamp, event_type string"), "event_type")
    q = s.writeStream.format("memory").outputMode("complete").queryName("hours").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r["event_type"], r["events"]) for r in spark.table("hours").collect()) == [("a", 2), ("b", 1)]


def _shuffled_records(spark):
    sc, gateway = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway
    sc.listenerBus().waitUntilEmpty()
    stages = sc.statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


def test_missing_texts_cuts_no_text_into_rows(spark):
    t, rng = "d string, text string", random.Random(5)
    word = lambda: "".join(rng.choice("абвгдежзик") for _ in range(6))
    wholes = [" ".join(word() for _ in range(60)) for _ in range(40)]
    asked = [("a", w[7:30].strip()) for w in wholes[:20]] + [("a", "план щита"), ("b", wholes[0])]
    before, threshold = _shuffled_records(spark), "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")  # else small sides are sent to the driver, uncounted
    try:
        got = R.missing_texts(spark.createDataFrame(asked, t), spark.createDataFrame([("a", w) for w in wholes], t), ["d"]).collect()
    finally:
        spark.conf.unset(threshold)
    assert sorted(map(tuple, got)) == sorted([("a", "план щита"), ("b", wholes[0])])
    assert 0 < _shuffled_records(spark) - before <= 10 * (len(asked) + len(wholes))


@pytest.mark.parametrize("block", [5, 60, 1_000_000])
def test_missing_texts_of_hot_keys_agree_with_all_pairs(spark, block):
    t, rng = "d string, e int, text string", random.Random(block)
    some = lambda n, most: [(rng.choice(["hot"] * 8 + ["x", "y", None]), rng.choice([1] * 9 + [None]), "".join(rng.choice("абВ ") for _ in range(rng.randrange(most)))) for _ in range(n)]
    asked, known = some(200, 9) + [("lone", 1, "ааа"), ("hot", 1, None)], some(60, 24) + [("hot", 1, None)]
    fold = lambda rows: {(d, e, f) for d, e, x in rows if x is not None and (f := " ".join(x.split()).lower())}
    wholes = fold(known)
    right = {(d, e, x) for d, e, x in fold(asked) if d is None or e is None or not any((d, e) == (kd, ke) and x in w for kd, ke, w in wholes)}
    got = [tuple(r) for r in R.missing_texts(spark.createDataFrame(asked, t), spark.createDataFrame(known, t), ["d", "e"], block=block).collect()]
    assert len(got) == len(set(got)) and set(got) == right


def test_open_texts_are_found_by_any_run():
    rng = random.Random(3)
    for size in (1, 4):
        texts = sorted({"".join(rng.choice("аб") for _ in range(rng.randrange(1, 12))) for _ in range(200)})
        wholes = ["".join(rng.choice("аб") for _ in range(rng.randrange(0, 15))) for _ in range(40)]
        rest = folds.OpenTexts(texts, size)
        for w in wholes:
            rest.meet(w)
        assert sorted(rest) == [t for t in texts if not any(t in w for w in wholes)]


def test_fused_and_missing(spark):
    schema = "id int, pos int, line string"
    base = spark.createDataFrame([(1, 0, "складской комплекс магистраль"), (2, 0, "лист")], schema)
    extra = spark.createDataFrame([(1, 0, "новая насосная"), (1, 1, "насосная"), (1, 2, "кладской комплекс"), (3, 0, "x")], schema)
    assert [(r["id"], r["ord"], r["line"]) for r in R.fused_lines(base, extra, ["id"]).collect() if r["id"] == 1] == [(1, 0, "новая насосная")]
    t = "d string, text string"
    known = spark.createDataFrame([("a", "План  кровли дома"), ("a", "аб"), (None, "x"), ("a", None)], t)
    asked = spark.createDataFrame([("a", "кровли"), ("a", "ЛИ"), ("a", "фасад"), ("b", "кровли"), ("a", ""), ("a", "план кровли дома 2")], t)
    assert sorted(map(tuple, R.missing_texts(asked, known, ["d"]).collect())) == [("a", "план кровли дома 2"), ("a", "фасад"), ("b", "кровли")]
    v = "k int, v string"
    assert sorted(map(tuple, R.best_of(spark.createDataFrame([(1, "a"), (2, "b")], v), spark.createDataFrame([(2, "c"), (3, "d")], v), ["k"], "v").collect())) == [(1, "a"), (2, "c"), (3, "d")]
    s = R.stacked([("A", spark.createDataFrame([(1, "a")], v)), ("B", spark.createDataFrame([(1, "b"), (2, None)], v))], ["k"], "v").collect()
    assert [tuple(r) for r in s] == [(1, "### A\na\n\n### B\nb")]


def test_greedy_claims_follow_the_order(spark):
    a = spark.createDataFrame([(1, 1, 0.0, 0.0), (1, 2, 0.1, 0.0), (1, 3, 0.2, 0.0), (2, 4, 0.0, 0.0)], "s int, m int, x double, y double")
    b = spark.createDataFrame([(1, 10, 0.0, 1.0, "a"), (1, 11, 0.0, 3.0, "b"), (2, 12, 0.0, 1.0, "c"), (2, 13, 0.0, -1.1, "d")], "s int, t int, x double, y double, v string")
    got = {r["m"]: (r["t"], r["status"]) for r in M.greedy_claims(a, b, ["s"], left_id="m", right_id="t", value="v", radius=8.0).collect()}
    assert got == {1: (10, "read"), 2: (11, "read"), 3: (None, "missing"), 4: (None, "ambiguous")}


def test_more_geometry(spark):
    one = spark.sql("select struct(0D as x0, 0D as y0, 10D as x1, 10D as y1) as s, struct(8D as x0, 0D as y0, 10D as x1, 2D as y1) as t, struct(-5D as x0, 4D as y0, 3D as x1, 30D as y1) as i")
    assert tuple(one.select(G.drawing_field("s", "t")).first()[0])[1:] == (0.0, 0.0, 8.0, 10.0) or one.select(G.drawing_field("s", "t")).first()[0]["area"] == 80.0
    assert tuple(one.select(G.fitted("i", "s")).first()[0]) == (0.0, 0.0, 8.0, 10.0)
    assert tuple(one.select(G.clipped_segment(F.lit(-5.0), F.lit(5.0), F.lit(20.0), F.lit(5.0), "s")).first()[0]) == (0.0, 5.0, 10.0, 5.0)
    assert one.select(G.clipped_segment(F.lit(-5.0), F.lit(50.0), F.lit(20.0), F.lit(50.0), "s")).first()[0] is None
    shapes = spark.sql("select array(struct(0D as x, 0D as y), struct(2D as x, 1D as y)) as p union all select array(struct(10D as x, 5D as y), struct(14D as x, 7D as y))")
    assert shapes.select(G.shape_signature(F.col("p"), F.lit("line"))).distinct().count() == 1
    values = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 9.0, 10.0, 30.0)], "k string, y double")
    assert [r["cluster"] for r in G.median_clusters(values, ["k"], "y", 3.0).orderBy("y").collect()] == [0, 0, 1, 1, 2]
    blocks = spark.sql("select 1 as p, 'in' as b, struct(0D as x0, 0D as y0, 1D as x1, 1D as y1) as box union all select 1, 'out', struct(5D as x0, 5D as y0, 6D as x1, 6D as y1)")
    tables = spark.sql("select 1 as p, struct(0D as x0, 0D as y0, 2D as x1, 2D as y1) as box")
    assert [r["b"] for r in G.outside_tables(blocks, tables, ["p"], "b").collect()] == ["out"]
    c = spark.createDataFrame([(1, 0.5, 0.5, "б"), (1, 0.2, 0.9, "а"), (1, 9.0, 9.0, "х")], "p int, x double, y double, t string")
    cells = spark.createDataFrame([(1, "c", 0.0, 0.0, 1.0, 1.0)], "p int, c string, x0 double, y0 double, x1 double, y1 double")
    assert [(r["c"], r["text"]) for r in G.cell_texts(c, cells, ["p"], "c", "t", 5.0).collect()] == [("c", "а б")]


def test_gates(spark):
    from kitloom.operators import gates as P
    from kitloom.operators import stampread as B

    assert _one(spark, "### PASS-0 x\nпаспорт\n### PASS-A\n(ошибка тайла: 500)\n_[mock]_", P.is_all_errors) is True
    assert _one(spark, "\n".join(f"- Футляр {i} — юго-запад" for i in range(6)), P.stamped_location) is True
    assert _one(spark, "\n".join(f"| {i} | | {i} |" for i in range(25)), P.is_garbage_tile) is True
    assert _one(spark, "%%c325 {\\C1;120} l=#### \x03", P.clean_caption) == "∅325 120 l=— "
    assert _one(spark, "Содержание (окончание)", P.caption_part) == ("Содержание", 2)
    assert _one(spark, "круг12", P.circle_number) == 12 and _one(spark, "круг21", P.circle_number) is None
    assert _one(spark, "номерация 5", P.room_number) == "5" and _one(spark, "12 суглинок", P.type_label) == "суглинок"
    assert _one(spark, "- kind: `plan`", P.passport_kind) == "plan" and _one(spark, "М 1:500", P.written_scale) == "500"
    assert _one(spark, "а\n--- r1c1 ---\nб\n--- r1c2 ---\n", P.fragment_count) == 2
    fits = [tuple(r) for r in spark.range(1).select(F.explode(P.sheet_format(F.lit(29700.0), F.lit(21000.0)))).select("col.*").collect()]
    assert {("A4", 100.0), ("A2", 50.0), ("A0", 25.0)} <= set(fits)
    assert spark.range(1).select(P.sheet_kind(F.lit(0.0), F.lit(3), F.lit(1), F.lit(0)), P.sheet_kind(F.lit(41.0), F.lit(1), F.lit(9), F.lit(0)), P.sheet_kind(F.lit(1.0), F.lit(10), F.lit(2), F.lit(0))).first()[:] == ("text", "plan", "plan")
    grid = spark.sql("select array(array('а', '', 'в'), array('', '', ''), array('Изм.', 'Лист', 'Подп.'), array('стадия', 'листов', 'разраб')) as g")
    assert grid.select(B.trimmed_grid(F.col("g"))).first()[0] == [["а", "", "в"], ["Изм.", "Лист", "Подп."], ["стадия", "листов", "разраб"]]
    assert grid.select(B.stamp_start(F.col("g"), P.STAMP_WORDS)).first()[0] == 2
    assert spark.sql("select array('а\\nб', '1\\n2', '') as r").select(B.destacked(F.col("r"))).first()[0] == [["а", "1", ""], ["б", "2", ""]]


def test_title_block(spark):
    from kitloom.operators import stampread as B

    rows = [("d", 1, 1, 100.0, 40.0, 2.5, "Стадия"), ("d", 1, 2, 115.0, 40.0, 2.5, "Лист"), ("d", 1, 3, 135.0, 40.0, 2.5, "Листов"), ("d", 1, 4, 100.0, 33.0, 3.5, "П"), ("d", 1, 5, 115.0, 33.0, 3.5, "лист 7"), ("d", 1, 6, 135.0, 33.0, 3.5, "12"), ("d", 1, 7, 120.0, 60.0, 7.0, "41-ПРЛ-2/24-КР1"), ("d", 1, 8, 300.0, 40.0, 2.5, "Стадия"), ("d", 2, 9, 1.0, 1.0, 2.5, "Лист"), ("d", 2, 10, None, 1.0, 2.5, "Стадия"), ("d", 3, 11, 1.0, 1.0, 2.5, None)]
    df = spark.createDataFrame(rows, "document_id string, page int, item_id long, x double, y double, size double, text string")
    assert [tuple(r) for r in B.read_stamps(df).select("page", "stage", "sheet", "sheets_total", "code").collect()] == [(1, "П", "7", "12", "41-ПРЛ-2/24-КР1")]


def test_axis_pairs_and_merged_fields(spark):
    from kitloom.operators import symbols as Y

    rows = [(1, 1, 0.0, 0.0, "А"), (1, 2, 3.0, 0.0, "5"), (1, 3, 100.0, 0.0, "Б"), (1, 4, 101.0, 0.0, "6"), (1, 5, 102.0, 0.0, "7"), (2, 6, 0.0, 0.0, "8"), (1, 7, None, 0.0, "В")]
    df = spark.createDataFrame(rows, "s int, item_id long, x double, y double, text string")
    assert [(r["letter_id"], r["digit_id"]) for r in Y.axis_pairs(df, ["s"], 8.0).collect()] == [(1, 2)]
    got = spark.createDataFrame([(" П ", "п"), ("П", "Р"), ("", "Р"), (None, None)], "a string, g string").select(Y.merged_field(F.col("a"), F.col("g")).alias("m")).select("m.*").collect()
    assert [tuple(r) for r in got] == [("П", False), ("П", True), ("Р", False), (None, False)]


def test_block_matches_fail_closed(spark):
    from kitloom.operators import symbols as Y

    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    legends = spark.createDataFrame([("L1", "d", 1, "Труба", "s1", (0.0, 0.0, 5.0, 5.0)), ("L2", "d", 1, "Люк", "s2", (4.0, 4.0, 9.0, 9.0)), ("L3", "d", 1, "Лоток", "s2", None)], f"id string, document_id string, page int, label string, signature string, bbox {box}")
    inst = spark.createDataFrame([("a", "d", 1, 1.0, 1.0, "x"), ("b", "d", 1, 4.5, 4.5, "s1"), ("c", "d", 2, 1.0, 1.0, "s1"), ("e", "d", 2, 1.0, 1.0, "s2"), ("f", "d", 2, None, None, None), ("g", "d", 1, 5.0, 5.0, "s1")], "id string, document_id string, page int, x double, y double, signature string")
    got = {r["id"]: (r["legend_id"], r["reason"]) for r in Y.block_matches(inst, legends).collect()}
    assert got == {"a": ("L1", "exemplar"), "b": (None, "several boxes"), "c": ("L1", "signature"), "e": (None, "ambiguous"), "f": (None, "missing"), "g": ("L2", "exemplar")}


def test_periodic_stretches_agree_with_brute_force():
    import random

    import numpy as np

    rng = random.Random(5)
    for _ in range(200):
        values = [rng.choice("ab") for _ in range(rng.randrange(3, 30))]
        for period in (1, 2, 3):
            if period >= len(values):
                continue
            want = []
            for i in range(len(values)):
                same = lambda k, i=i: k + period < len(values) and values[k] == values[k + period]  # noqa: B023, E731
                if same(i) and (i == 0 or values[i - 1] != values[i - 1 + period]):
                    end = i
                    while same(end):
                        end += 1
                    if end - i >= period:
                        want.append((i, end + period))
            assert folds.periodic(np.array(values), period) == want


def test_overlaps_through_rare_terms_agree_with_all_pairs(spark):
    import random

    rng = random.Random(8)
    terms = [f"t{k}" for k in range(60)]
    draw = lambda n: set(rng.choices(terms, weights=[60 - k for k in range(60)], k=n))
    right = {f"r{i}": draw(12) for i in range(200)}
    left = {f"l{i}": (set(rng.choice(list(right.values()))) if i % 3 else draw(4)) for i in range(40)}
    table = lambda d, name: spark.createDataFrame([(i, t) for i, ts in d.items() for t in ts], f"{name} string, token string")
    got = {}
    for r in S.best_matches(table(right, "r"), table(left, "l"), query="l", candidate="r", k=3).collect():
        got.setdefault(r["l"], []).append((r["rank"], r["hits"], r["r"]))
    for i, ts in left.items():
        hits = sorted((-len(ts & own), r) for r, own in right.items() if ts & own)[:3]
        assert sorted(got[i]) == [(n + 1, -h, r) for n, (h, r) in enumerate(hits)]
    for shares in ((0.02,), (0.3, 0.6), ()):
        best = {r["l"]: (r["overlap"], r["r"]) for r in M.top_overlaps(table(left, "l"), table(right, "r"), left_id="l", right_id="r", term="token", shares=shares, least=1).orderBy("overlap", "r").collect()}
        assert {i: b[0] for i, b in best.items()} == {i: max(len(ts & own) for own in right.values()) for i, ts in left.items()}


def test_boxes_of_any_size(spark):
    import random

    rng = random.Random(9)
    boxes = [(i, x := rng.uniform(-50, 50), y := rng.uniform(-50, 50), x + rng.choice([0.0, 3.0, 40.0, 1e9]), y + rng.choice([0.0, 5.0, 1e7])) for i in range(60)]
    points = [(i, rng.uniform(-60, 200), rng.uniform(-60, 200)) for i in range(80)] + [(99, None, 1.0)]
    got = M.points_in_boxes(spark.createDataFrame([(1, *p) for p in points], "k int, p int, x double, y double"), spark.createDataFrame([(1, *b) for b in boxes], "k int, b int, x0 double, y0 double, x1 double, y1 double"), ["k"], cell=10.0)
    want = {(p, b) for p, x, y in points if x is not None for b, x0, y0, x1, y1 in boxes if x0 <= x <= x1 and y0 <= y <= y1}
    assert {(r["p"], r["b"]) for r in got.collect()} == want and got.count() == len(want)


def test_scattered_labels_are_summed_up(spark):
    lines = [x for k in range(20) for x in ("К1", f"узел {k}")] + ["В1"] * 15 + ["Б2"] * 14
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(lines)] + [("e", 0, "К1")], "d string, pos long, line string")
    got = [r["line"] for r in L.sum_up_labels(df, ["d"]).filter("d = 'd'").orderBy("pos").collect()]
    assert got == ["К1", "узел 0", "К1"] + [f"узел {k}" for k in range(1, 20)] + ["В1"] * 2 + ["Б2"] * 14 + ["", "Метки сетей на плане (сводка): К1 (×20), В1 (×15)."]
    assert L.sum_up_labels(df, ["d"]).filter("d = 'e'").count() == 1


def test_prefixes_agree_with_brute_force(spark):
    import random

    rng = random.Random(10)
    texts = sorted({"".join(rng.choice("аб ") for _ in range(rng.randrange(2, 14))) for _ in range(300)} | {"абабаб" + "а" * k for k in range(40)})
    wholes = [t for t in texts if rng.random() < 0.6]
    table = lambda rows, c: spark.createDataFrame([(r,) for r in [*rows, None]], f"{c} string")
    want = {(h, min(w for w in wholes if w.startswith(h) and w != h and len(w) >= 4)) for h in texts if len(h) >= 4 and any(w.startswith(h) and w != h for w in wholes)}
    for longer in ((), (6,), (5, 8, 20)):
        got = M.prefix_matches(table(texts, "h"), table(wholes, "w"), head="h", whole="w", longer=longer).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_added_lines_agree_with_brute_force():
    import random

    rng = random.Random(11)
    words = ["".join(rng.choice("абв") for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    for _ in range(150):
        line = lambda: " ".join(rng.choices(words, k=rng.randrange(1, 6)))
        base, extra = [set(line().split()) for _ in range(8)], [line() for _ in range(12)]
        known, want, seen = set().union(*base), [], set()
        for x in extra:
            own = set(x.split())
            fresh = {t for t in own if len(t) >= 3 and not any(t in k for k in known)}
            if x in seen or not fresh or any(len(own & b) >= 0.6 * len(own) for b in base):
                continue
            seen.add(x)
            want.append(x)
            known |= own
        assert folds.added_in_order(set().union(*base), extra, lambda x: set(x.split()), base) == want


def test_sides_hashed_alike_stay_together(spark):
    """Sides that were shuffled alike and merged differently still give whole pages."""
    from pyspark.sql import Window

    from kitloom.session import UNION_CONF

    order = F.row_number().over(Window.partitionBy("k").orderBy("line"))
    side = lambda n, copies: spark.range(n).select((F.col("id") % 400).alias("k"), F.concat(F.lit("узел номер "), F.col("id").cast("string"), F.lit(" " + "слово " * copies)).alias("line")).withColumn("pos", order)
    merging = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "60KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB", "spark.sql.shuffle.partitions": "40"}
    held = {name: spark.conf.get(name) for name in merging}
    try:
        for name, value in merging.items():
            spark.conf.set(name, value)
        assert spark.conf.get(UNION_CONF) == "false"
        assert R.fused_lines(side(40_000, 60), side(4000, 60), ["k"]).count() == 0
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
