import json

from pyspark.sql import functions as F

from kitloom.operators import charmap as C
from kitloom.operators import entities as E
from kitloom.operators import manifests as N
from kitloom.operators import marks as M
from kitloom.sources import readers

MARK = "d string, id string, x double, y double, layer string, reason string, block_name string, attributes map<string,string>, value string"
TEXT = "d string, text_id string, x double, y double, text string"


def _marks(spark, rows):
    return spark.createDataFrame([("d", i, x, y, layer, reason, block, attrs, "z") for i, x, y, layer, reason, block, attrs in rows], MARK)


def test_axes(spark):
    marks = _marks(spark, [
        ("1", 0.0, 0.0, "OSI", None, None, {"Ось": "а", "Ось'": "12"}), ("2", 50.0, 0.0, None, None, None, {"ОСЬ(2)": "Б"}), ("3", 100.0, 0.0, "osi", "", "", {"Ось": "А", "ось’": "Б"}),
        ("4", 150.0, 0.0, None, "axis-layer", None, None), ("5", 200.0, 0.0, "osi", None, "Номерация 5", {"Ось": "1"}), ("6", 250.0, 0.0, "0", None, None, {"прим": "1"}), ("7", 0.0, 90.0, "osi", None, None, {"Ось": ""}), ("8", None, None, "osi", None, None, None),
    ])
    texts = spark.createDataFrame([("d", "a", 52.0, 0.0, "7"), ("d", "b", 151.0, 0.0, "Ё"), ("d", "c", 151.1, 0.0, "Ж"), ("d", "e", 0.0, 92.0, "Узел"), ("d", "f", 0.0, 99.5, "3"), ("d", "g", None, 1.0, "3"), ("d", "h", 1.0, 1.0, None)], TEXT)
    got = {r["id"]: (r["letter"], r["digit"], r["source"], r["note"]) for r in M.read_axes(marks, texts, ["d"]).collect()}
    assert got == {"1": ("А", "12", "attributes", ""), "2": ("Б", "7", "merged", ""), "3": ("", "", "", M.UNSORTED), "4": ("", "", "", M.SEVERAL_TEXTS), "7": ("", "", "", M.NO_AXIS), "8": ("", "", "", M.NO_AXIS)}
    assert M.read_axes(marks.limit(0), texts, ["d"]).collect() == []


def test_dimensions(spark):
    marks = _marks(spark, [
        ("1", 0.0, 0.0, "otmetki", None, None, {"ОТМЕТКА": "+12,350"}), ("2", 50.0, 0.0, "Otmetki", None, None, {"Отметка": " "}), ("3", 100.0, 0.0, "razmer", None, None, {"В": "5", "Размер(1)": "2 400 мм", "Длина": "2400 мм"}),
        ("4", 150.0, 0.0, "0", None, "Высоты здания", None), ("5", 200.0, 0.0, "razmer", "building-label-block", None, {"Размер": "100"}), ("6", 250.0, 0.0, "0", None, None, {"Размер": "100"}), ("7", 300.0, 0.0, "razmer", None, None, None),
    ])
    texts = spark.createDataFrame([("d", "a", 50.0, 3.0, "-3.900"), ("d", "b", 151.0, 0.0, "+7.500"), ("d", "c", 300.0, 1.0, "120"), ("d", "e", 300.0, -1.1, "130"), ("d", "f", 150.0, 0.5, "(5)")], TEXT)
    got = {r["id"]: (r["kind"], r["value"], r["source"], r["note"]) for r in M.read_dimensions(marks, texts, ["d"]).collect()}
    assert got == {"1": ("elevation", "+12.350", "attributes", ""), "2": ("elevation", "-3.900", "text", ""), "3": ("linear", "2400", "attributes", ""), "4": ("height", "+7.500", "text", ""), "7": ("linear", "", "", M.SEVERAL_NUMBERS)}


def test_shown_and_external(spark):
    entities = spark.createDataFrame([("p", "1", "A", False), ("p", "2", "B", False), ("p", "3", None, None), ("p", "4", "A", True), ("q", "5", "B", False)], "path string, handle string, layer string, invisible boolean")
    layers = spark.createDataFrame([("p", "B", True, False), ("p", "B", False, True), ("p", "A", False, False)], "path string, name string, off boolean, frozen boolean")
    assert sorted(r["handle"] for r in E.shown(entities, layers).collect()) == ["1", "3", "5"]
    blocks = spark.createDataFrame([("p", "x", 4), ("p", "x", 6), ("p", "y", 2), ("p", "z", None)], "path string, name string, flags int")
    assert [tuple(r) for r in E.external_blocks(blocks).collect()] == [("p", "x")]


def test_viewports(spark):
    point = "struct<x:double,y:double>"
    ports = spark.createDataFrame([("p", "b1", (100.0, 50.0), 200.0, 100.0, (1000.0, 500.0), 1000.0, None, None), ("p", "b1", (100.0, 50.0), 0.0, 100.0, (1.0, 1.0), 10.0, None, None), ("p", "b9", (1.0, 1.0), 1.0, 1.0, (1.0, 1.0), 1.0, None, None), ("p", "b2", None, 1.0, 1.0, (1.0, 1.0), 1.0, None, None), ("p", "b3", (0.0, 0.0), 10.0, 10.0, (0.0, 0.0), 10.0, (5.0, 5.0), 90.0)], f"path string, owner string, center {point}, width double, height double, view_center {point}, view_height double, view_target {point}, twist double")
    layouts = spark.createDataFrame([("p", "Лист 1", "b1"), ("p", "Лист 3", "b3"), ("p", None, "b2")], "path string, layout string, block string")
    found = E.layout_viewports(ports, layouts)
    assert sorted(r["layout"] for r in found.collect()) == ["Лист 1", "Лист 3"]
    points = spark.createDataFrame([("p", 1, 1500.0, 600.0), ("p", 2, 2500.0, 500.0), ("p", 3, 6.0, 5.0), ("p", 4, None, 1.0)], "path string, id int, x double, y double")
    got = {(r["id"], r["layout"]): (round(r["x"], 6), round(r["y"], 6)) for r in E.on_paper(points, found).collect()}
    assert got == {(1, "Лист 1"): (150.0, 60.0), (3, "Лист 1"): (0.6, 0.5), (3, "Лист 3"): (0.0, 1.0)}


def test_frames_of_a_model(spark):
    frames = spark.createDataFrame([("p", 0.0, 0.0, 420.0, 297.0), ("p", 20.0, 5.0, 415.0, 292.0), ("p", 500.0, 0.0, 920.0, 297.0), ("p", 0.0, 400.0, 420.0, 697.0), ("p", 5.0, 5.0, 5.0, 9.0)], "path string, x0 double, y0 double, x1 double, y1 double")
    sheets = E.sheet_frames(frames)
    assert {r["number"]: (r["x0"], r["y0"]) for r in sheets.collect()} == {1: (0.0, 400.0), 2: (0.0, 0.0), 3: (500.0, 0.0)}
    texts = spark.createDataFrame([("p", i, 10.0 + i, 10.0, 2.5 if i else 9.0) for i in range(9)] + [("p", 50, 600.0, 10.0, 7.0), ("p", 51, 1200.0, 10.0, 2.5)], "path string, id int, x double, y double, height double")
    got = {r["id"]: (r["number"], r["usual"]) for r in E.frame_texts(texts, sheets).collect()}
    assert got[1] == (2, 2.5) and got[50] == (3, 2.5) and 51 not in got


def test_boxes_and_stamps(spark):
    one = spark.sql("select named_struct('x0', 0D, 'y0', 0D, 'x1', 420D, 'y1', 297D) as s, named_struct('x0', 5D, 'y0', 5D, 'x1', 415D, 'y1', 292D) as f, named_struct('x0', 300D, 'y0', 1D, 'x1', 1000D, 'y1', 9D) as far")
    flags = one.select(E.on_sheet(F.col("f"), F.col("s")), E.on_sheet(F.col("far"), F.col("s")), E.covers_sheet(F.col("f"), F.col("s")), E.covers_sheet(F.col("far"), F.col("s")), E.placed_stamp(F.lit(415.0), F.lit(5.0), F.lit(1.0), F.col("s"))).first()
    assert list(flags)[:4] == [True, False, True, False] and tuple(flags[4]) == (230.0, 5.0, 415.0, 60.0)


def test_block_signatures(spark):
    rows = [("a", "LINE", 1.0), ("a", "ARC", 2.0), ("b", "ARC", 2.0), ("b", "LINE", 1.0), ("c", "LINE", 1.0), ("e", None, None)]
    got = {r["block"]: r["signature"] for r in E.block_signatures(spark.createDataFrame(rows, "block string, kind string, r double"), ["block"], ["kind", "r"]).collect()}
    assert got["a"] == got["b"] != got["c"] and len(set(got.values())) == 3


def test_manifests(spark):
    good = {"schemaVersion": 1, "qualityGates": {"minInstanceRecall": 0.9, "maxFalseConfirmedBindings": 0}, "fixtures": [{"id": "a", "documentPath": "p", "page": 1, "split": "holdout", "expected": {"instanceKeys": ["k"], "bindings": [{"instanceKey": "k", "legendLabel": "l"}], "relationships": [{"sourceKey": "a", "targetKey": "b", "type": "t", "directed": True}]}}]}
    bad = {"schemaVersion": 2, "qualityGates": {"minInstanceRecall": True, "other": 1, "maxFalseConfirmedBindings": -1}, "fixtures": [{"id": "a", "documentPath": "", "page": 0, "split": "x", "expected": {"instanceKeys": [1], "bindings": {}, "relationships": [{"sourceKey": "a"}]}}, {"id": "a", "documentPath": "p", "page": True, "split": "holdout", "expected": None}, 5]}
    rows = [("good", json.dumps(good)), ("bad", json.dumps(bad)), ("text", "{"), ("null", None), ("empty", json.dumps({"schemaVersion": 1, "fixtures": []}))]
    got = N.manifest_problems(spark.createDataFrame(rows, "path string, text string")).collect()
    fields = lambda p: sorted(r["field"] for r in got if r["path"] == p)
    assert fields("good") == [] and fields("text") == fields("null") == [""] and fields("empty") == ["fixtures"]
    assert fields("bad") == sorted(["schemaVersion", "qualityGates.minInstanceRecall", "qualityGates.other", "qualityGates.maxFalseConfirmedBindings", "fixtures[0].documentPath", "fixtures[0].page", "fixtures[0].split", "fixtures[0].expected.instanceKeys", "fixtures[0].expected.bindings", "fixtures[0].expected.relationships[0].targetKey", "fixtures[0].expected.relationships[0].type", "fixtures[0].expected.relationships[0].directed", "fixtures[0].id", "fixtures[1].id", "fixtures[1].page", "fixtures[1].expected", "fixtures[2]"])


def test_cut_texts_are_joined(spark, tmp_path):
    word = "Московская область".encode()
    groups = [(b"  0", b"ATTRIB"), (b"  3", word[:7]), (b"  3", word[7:20]), (b"  1", word[20:]), (b"  0", b"LAYER"), (b"  3", b"x"), (b"  1", b"y"), (b"  0", b"TEXT"), (b"  3", b"alone"), (b"  8", b"0"), (b"  0", b"EOF")]
    data = b"".join(c + b"\r\n" + v + b"\r\n" for c, v in groups)
    whole, n = readers.joined_text_groups(data)
    assert n == 1 and b"  1\r\n" + word + b"\r\n" in whole and whole.count(b"  3\r\n") == 2
    assert readers.joined_text_groups(whole) == (whole, 0) and readers.joined_text_groups(b"") == (b"", 0)
    (tmp_path / "a.dxf").write_bytes(data)
    assert [r["joined"] for r in readers.joined_drawings(spark, str(tmp_path)).collect()] == [1]


def test_shifts_of_fonts(spark):
    moved = lambda w, k: "".join(chr(ord(c) - k) for c in w)
    broken = [("f", moved(w, 5)) for w in ("насос", "схема", "кровля")] + [("g", moved("насос", 9))] + [("h", moved("железобетонный", 7))] + [("f", "??")]
    known = spark.createDataFrame([(w,) for w in ("насос", "схема", "кровля", "железобетонный", "узел")], "word string")
    got = {r["font"]: (r["shift"], r["witnesses"]) for r in C.font_shifts(C.font_tokens(spark.createDataFrame(broken, "font string, text string")), known).collect()}
    assert got == {"f": (5, 3), "h": (7, 1)}
    glyphs = spark.createDataFrame([("f", 1, "o1"), ("f", 2, "o2"), ("f", 2, "o3"), ("f", 3, None), ("f", 4, "o4")], "font string, code int, outline string")
    outlines = spark.createDataFrame([("o1", "а"), ("o1", "а"), ("o2", "б"), ("o3", "в"), ("o4", "г"), ("o4", "д")], "outline string, char string")
    assert [tuple(r) for r in C.glyph_codes(glyphs, outlines).collect()] == [("f", 1, "а")]


def test_blocks_outside_tables(spark):
    from kitloom.operators import geometry as G

    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    blocks = spark.createDataFrame([(1, "a", (0.0, 0.0, 10.0, 10.0)), (1, "b", (6.0, 0.0, 16.0, 10.0)), (2, "c", (0.0, 0.0, 10.0, 10.0))], f"p int, id string, box {box}")
    tables = spark.createDataFrame([(1, (0.0, 0.0, 12.0, 1e6))], f"p int, box {box}")
    assert sorted(r["id"] for r in G.outside_tables(blocks, tables, ["p"], "id").collect()) == ["b", "c"]
