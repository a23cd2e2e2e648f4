import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from kitloom.llm import canonlist as K
from kitloom.llm import survivors as S

STAMP = "struct<code:string,sheet:string,sheets_total:string,stage:string,title:string,object_name:string,org:string,source:string,note:string>"
VARIANT = f"variant_id long, source_kind string, idx int, stamp {STAMP}, read_at timestamp, code_key string, members int"
T0 = dt.datetime(2024, 1, 1)


def _variant(i, kind, code, sheet, idx=1, at=T0, **fields):
    return (i, kind, idx, (code, sheet, *[fields.get(f) for f in ("sheets_total", "stage", "title", "object_name", "org", "source", "note")]), at, "x", 1)


def _survivors(spark, rows):
    return sorted(r["survivor_id"] for r in S.best_representatives(spark.createDataFrame(rows, VARIANT)).collect())


def test_order_of_survivors(spark):
    rows = [
        _variant(1, "PDF", "A-1", "03", title="x", stage="П"), _variant(2, " dwg ", "a - 1", "лист 3"), _variant(3, None, "A-1", "3"),
        _variant(4, "PDF", "B", "1", title="-"), _variant(5, "PDF", "B", "1", title="t"), _variant(6, "DOCX", "C", "1", at=T0), _variant(7, "DOCX", "C", "1", at=T0 + dt.timedelta(1)), _variant(14, "DOCX", "C", "1", at=None),
        _variant(8, "x", "D", "1", idx=None), _variant(9, "y", "D", "1", idx=5), _variant(10, "z", "D", "1", idx=5), _variant(11, "DWG", "E", "1"), _variant(12, "DWG", None, "1"), _variant(13, "DWG", "F", "без"), _variant(15, "DWG", "F", "без"), _variant(16, "DWG", " ", "1"), _variant(17, "DWG", " ", "1"),
    ]
    assert _survivors(spark, rows) == [2, 5, 7, 9]
    assert _survivors(spark, []) == []
    assert _survivors(spark, [*rows, *rows, _variant(None, "DWG", "A-1", "3")]) == sorted([2, 5, 7, 9, 11])
    assert _survivors(spark, [*rows, *[(100, None, None, None, None, None, None)] * 2]) == [2, 5, 7, 9]


def test_missing_fields_come_in_whole_bundles(spark):
    rows = [_variant(1, "DWG", "A", "1", title="т"), _variant(2, "PDF", "A", "1", stage="П", object_name="О", org="К", sheets_total="5"), _variant(3, "DOCX", "A", "1", stage="Р", object_name="Д", org="Л", sheets_total="7")]
    (r,) = S.best_representatives(spark.createDataFrame(rows, VARIANT)).collect()
    assert (r["survivor_id"], r["stage"], r["object_name"], r["org"], r["title"]) == (1, "П", "О", "К", "т")
    assert r["sheets_total"] == "5"


def test_a_value_that_agrees_fills_though_a_more_trusted_one_contradicts(spark):
    rows = [
        _variant(1, "DWG", "A", "1", object_name="О", title="т", sheets_total="5"), _variant(2, "PDF", "A", "1", stage="П", object_name="Д", org="Л"), _variant(3, "DOCX", "A", "1", stage="П", object_name="О", org="К", note="н"),
        _variant(4, "DWG", "B", "1", object_name="О", org="К", title="т"), _variant(5, "DOCX", "B", "1", stage="Р"),
    ]
    a, b = sorted(S.best_representatives(spark.createDataFrame(rows, VARIANT)).collect(), key=lambda r: r["survivor_id"])
    assert (a["survivor_id"], a["stage"], a["object_name"], a["org"], a["note"], a["filled_from"]) == (1, "П", "О", "К", "н", "project,reading")
    assert (b["survivor_id"], b["stage"], b["object_name"], b["org"], b["filled_from"]) == (4, "Р", "О", "К", "project")


def _brute(records, bundles, facts):
    """Greatest (record trust, sum of trusts) over all choices, and all completed fields that reach it."""
    best, ends = None, []
    for own, said in records:
        for picks in itertools.product(*[[None, *b] for b in bundles]):
            known, total = dict(said), 0
            for pick in filter(None, picks):
                if not S.keeps(known, pick[1], facts):
                    break
                known |= pick[1]
                total += pick[0]
            else:
                if best is None or (own, total) > best:
                    best, ends = (own, total), []
                if (own, total) == best:
                    ends.append(known)
    return best, ends


def test_branch_and_bound_is_the_best_choice():
    rng = random.Random(2)
    for _ in range(80):
        value = lambda: {f: rng.choice("ab") for f in rng.sample(S.FIELDS, 2)}
        records = [((rng.randrange(3), rng.randrange(3)), value()) for _ in range(rng.randrange(1, 4))]
        bundles = [[(rng.randrange(1, 9), value()) for _ in range(rng.randrange(4))] for _ in range(3)]
        facts = {(d, v): rng.choice("ab") for d in S.DEPENDENCIES for v in "ab" if rng.random() < 0.5}
        record, picked = S.choose(records, bundles, facts)
        known, total = dict(records[record][1]), 0
        for b, i in zip(bundles, picked, strict=True):
            if i is not None:
                assert S.keeps(known, b[i][1], facts)
                known |= b[i][1]
                total += b[i][0]
        assert (records[record][0], total) == _brute(records, bundles, facts)[0]


def test_groups_get_the_best_of_all_choices(spark):
    """Reducing the candidates before the search loses nothing."""
    rng = random.Random(4)
    pick = lambda options: rng.choice([None, None, *options])
    rows = [_variant(i, rng.choice(["DWG", "PDF", "DOCX", "x"]), f"g{i % 60}", "1", idx=i, at=T0 + dt.timedelta(rng.randrange(3)), stage=pick("ПР"), sheets_total=pick("56"), object_name=pick("ОД"), org=pick("КЛ"), title=pick("тм"), note=pick("н")) for i in range(400)]
    got = {r["code_key"]: r for r in S.best_representatives(spark.createDataFrame(rows, VARIANT)).collect()}
    names = ("sheets_total", "stage", "title", "object_name", "org", "source", "note")
    different = 0
    for g in range(60):
        members = []
        for i, kind, idx, stamp, at, *_ in (r for r in rows if r[3][0] == f"g{g}"):
            said = {n: v for n, v in zip(names, stamp[2:], strict=True) if v is not None}
            n_filled = 2 + sum(n in said for n in S.FILLED_FIELDS)
            members.append(((-S.KIND_RANK.get(kind, 3), n_filled, at, -idx, -i), said))
        bundles = []
        for fields in S.BUNDLES.values():
            values = {}
            for (k, *_), said in members:
                part = tuple((f, said[f]) for f in fields if f in said)
                if part:
                    values[part] = max(values.get(part, 0), 3 + k + 10 * len(part))
            bundles.append([(t, dict(v)) for v, t in values.items()])
        facts = {}
        for _, said in sorted(members, key=lambda m: m[0], reverse=True):
            for d, x in S.DEPENDENCIES.items():
                if d in said and x in said:
                    facts.setdefault((d, said[d]), said[x])
        # values that add nothing to the leading record are no fills
        lead = max(members, key=lambda m: m[0])
        bundles = [[(t, v) for t, v in b if v.keys() - lead[1].keys()] for b in bundles]
        best, ends = _brute([lead], bundles, facts)
        r = got[f"g{g}"]
        assert r["survivor_id"] == -best[0][-1]
        assert {f: r[f] for f in S.FIELDS if r[f] is not None} in ends
        free, loose = _brute([lead], bundles, {})
        different += {f: r[f] for f in S.FIELDS if r[f] is not None} not in loose
    assert different  # the dependencies decide some of the groups


def test_dependencies_bind(spark):
    rows = [
        _variant(1, "DWG", "A", "1", title="т", sheets_total="5"), _variant(2, "PDF", "A", "1", stage="П", sheets_total="9"), _variant(3, "DOCX", "A", "1", stage="П", object_name="О", org="К"), _variant(4, "x", "A", "1", stage="Р", object_name="О"),
    ]
    (r,) = S.best_representatives(spark.createDataFrame(rows, VARIANT)).collect()
    # stage П has 9 sheets in this group, so it can't join a record of 5
    assert (r["survivor_id"], r["stage"], r["object_name"], r["org"], r["sheets_total"]) == (1, "Р", "О", None, "5")


def test_a_group_of_a_third_of_all_rows(spark):
    rows = spark.range(30_000).select(F.col("id").alias("variant_id"), F.lit("PDF").alias("source_kind"), F.lit(1).alias("idx"), F.struct(F.when(F.expr("id % 3 = 0"), "HOT").otherwise(F.concat(F.lit("c"), F.expr("id div 2"))).alias("code"), F.lit("1").alias("sheet"), *[F.lit(None).cast("string").alias(f) for f in ("sheets_total", "stage")], F.col("id").cast("string").alias("title"), *[F.lit(None).cast("string").alias(f) for f in ("object_name", "org", "source", "note")]).alias("stamp"), F.lit(T0).alias("read_at"))
    got = S.best_representatives(rows).filter("code_key = 'hot'").collect()
    assert [(r["survivor_id"], r["members"]) for r in got] == [(0, 10_000)]


LIST = [(1, "Сеть бытовой канализации проектируемая"), (2, "Сеть бытовой канализации существующая"), (3, "Сеть дождевой канализации проектируемая"), (4, "Железобетонный лоток демонтируемый"), (5, "Кабельная линия низкого напряжения проектируемая"), (6, "Дерево лиственное существующее")]


@pytest.mark.parametrize(
    "value, ref",
    [
        ("сеть бытовой канализации проектируемая", 1), ("12. Проектируемая сеть бытовой, канализации (см. лист 5)", 1), ("сеть бытовой канал. сущ.", 2), ("сеть быотвой каналзации существующая DN100", 2), ("set dozhdevoy kanalizacii proektiruemaya", 3),
        ("ж/б лоток демонт.", 4), ("кабельная линия НН проект.", 5), ("деерво лиственное существующее, L=5,1 м", 6), ("сеть бытовой канализации", None), ("проектируемая", None), ("дерево хвойное существующее", None), ("лоток слаботочный демонтируемый", None), ("то же: лоток слаботочный демонтируемый", None),
        ("сеть бытовой канализации демонтируемая", None), ("", None), ("---", None), ("сеть канализации проектируемая", None),
    ],
)
def test_labels(value, ref):
    assert K.SignMatcher(K.parsed(LIST)).find(value) == ref


ENTRY = "id string, label string, label_variants array<string>, loaded_at timestamp, ref_id int, at long"


def test_entries(spark):
    rows = [
        ("a", LIST[0][1], None, T0, 9, 9), ("a", "без названия", None, T0 + dt.timedelta(1), 9, 9), ("b", None, [LIST[2][1], "сеть дожд. канализации проект.", LIST[5][1]], T0, 9, 9), ("c", None, None, T0, 9, 9),
        ("d", None, [None, ""], T0, 9, 9), ("e", "", [LIST[0][1]], None, 9, 9), ("f", LIST[1][1] + " x" * 20_000, None, T0, 9, 9), (None, LIST[0][1], None, T0, 9, 9), ("g", None, [LIST[0][1], LIST[1][1]], T0, 9, 9), ("g", None, [LIST[0][1], LIST[1][1]], T0, 9, 9),
    ]
    reference = spark.createDataFrame(LIST, "ref_id int, label string")
    got = {r["legend_id"]: r["ref_id"] for r in K.matched_labels(spark.createDataFrame(rows, ENTRY), reference).collect()}
    assert got == {"a": 1, "b": 3, "c": None, "d": None, "e": None, "f": 2, "g": 1}
    assert K.matched_labels(spark.createDataFrame([], ENTRY), reference).collect() == []
    assert {r["ref_id"] for r in K.matched_labels(spark.createDataFrame(rows, ENTRY), reference.limit(0)).collect()} == {None}


def test_initials_do_not_displace_abbreviations():
    listed = [(1, "Скважина разведочная существующая"), (2, "Газопровод среднего давления существующий"), (3, "Газопровод низкого давления существующий")]
    find = K.SignMatcher(K.parsed(listed)).find
    assert [find(v) for v in ("газопровод ср. давл. сущ.", "газопровод сд сущ.", "ср сущ.", "газопровод нд существующий")] == [2, 2, 1, 3]


def test_the_index_finds_what_a_scan_finds():
    """Costs by the index are those of comparing a token with every token of the list."""
    rng = random.Random(7)
    matcher = K.SignMatcher(K.parsed(LIST))
    letters = "абвгдеиклмнопрсту"
    for _ in range(3000):
        word = rng.choice(matcher.ordered)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(word) + 1)
            word = rng.choice([word[:k] + rng.choice(letters) + word[k:], word[:k] + word[k + 1 :], word[:k] + rng.choice(letters) + word[k + 1 :], word[:k], word[:k] + word[k + 1 : k + 2] + word[k : k + 1] + word[k + 2 :]])
        for dotted in (False, True):
            scan = {}
            for s, meant in matcher.spelled.items():
                if (c := matcher._near(word, dotted, s)) is not None:
                    for t in meant:
                        scan[t] = min(c, scan.get(t, c))
            assert matcher._close(word, dotted) == scan, word


def test_blocks_of_a_list_give_what_the_whole_list_gives(spark):
    values = ["сеть бытовой канал. сущ.", "сеть быотвой каналзации существующая DN100", "ж/б лоток демонт.", "кабельная линия НН проект.", "деерво лиственное существующее", "сеть канализации проектируемая", "то же: лоток слаботочный демонтируемый", "12. Проектируемая сеть бытовой, канализации", "проектируемая", ""]
    rows = [(f"v{i}", v, None, T0, 9, 9) for i, v in enumerate(values)] + [("w", None, [LIST[2][1], "сеть дожд. канализации проект.", LIST[5][1], None], T0, 9, 9), ("n", None, None, T0, 9, 9), ("e", None, [], None, 9, 9)]
    reference = spark.createDataFrame([*LIST, (7, LIST[0][1]), (8, "Сеть дождевой канализации существующая"), (9, "Сеть дренажной канализации проектируемая")], "ref_id int, label string")
    found = lambda **how: sorted(map(tuple, K.matched_labels(spark.createDataFrame(rows, ENTRY), reference, **how).collect()))
    assert found() == found(block_entries=2) == found(block_entries=1)
    assert dict(found())["v0"] == 2 and dict(found())["w"] == 3


def test_a_list_of_many_entries_is_searched_quickly():
    import time

    rng = random.Random(11)
    syllables = [a + b for a in "бвгдзклмнпрст" for b in "аеиоу"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5))) for _ in range(6000)]
    listed = [(i, f"{rng.choice(words)} {rng.choice(words)} {rng.choice(words)} проектируемый") for i in range(20_000)]
    matcher = K.SignMatcher(K.parsed(listed))
    began = time.perf_counter()
    right = 0
    for i, label in listed[::100]:
        word = label.split()
        word[1] = word[1][:2] + word[1][3:]
        right += matcher.find(" ".join(word)) == i
    assert right > 150
    assert (time.perf_counter() - began) / 200 < 0.05
