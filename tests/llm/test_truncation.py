import random

import numpy as np
from pyspark.sql import functions as F

from kitloom.llm import encodings as E
from kitloom.llm import truncation as T

from .test_encodings import WORDS

VALUES = "table_name string, record_id string, part string, model string, text string, len string, cut string"


def test_hashes_tell_contexts_apart():
    groups = np.array([1, 1, 2], dtype=np.uint64)
    texts = ["схема опалубки", "а схема опалубки", "схема опалубки"]
    ends = T.context_hashes(texts, groups, ends_only=True)
    assert ends[0][0] == ends[0][1] != ends[0][2]
    assert ends[-1][0] != ends[-1][1]
    everywhere = T.context_hashes(texts, groups, ends_only=False)
    assert len(everywhere[0]) == sum(map(len, texts))
    assert everywhere[2][len(texts[0]) - 1] == ends[2][0]


def test_normal_forms():
    assert T.normal("Отм. +12.350, Ёмкость 140") == "отм. +0.000, емкость 0"
    assert T.language("Höhe über") == "latin"
    assert T.language("7×5 �?") == "cyrillic"


def _values(n, seed=3):
    rng = random.Random(seed)
    ends = ["в подвале корпуса.", "у проектируемого проезда.", "по письму заказчика.", "на кровле блока.", "после уточнения нагрузок."]
    rows, cut = [], set()
    for i in range(n):
        text = f"{rng.choice(WORDS)} {rng.choice(WORDS)} {rng.choice(WORDS)} {rng.randrange(300)} {rng.choice(ends)}"
        if rng.random() < 0.05:
            text = text[: rng.randrange(12, len(text) - 3)]
            cut.add(str(i))
        rows.append(("t", str(i), "p", "m", text, "x", "y"))
    return rows, cut


def test_cuts_are_found(spark):
    rows, cut = _values(4000)
    extra = [("t", "n", "p", "m", None, "x", "y"), ("t", "e", "p", "m", "", "x", "y"), ("t", "long", "p", "m", "узел ввода " * 3000 + "по письму заказчика.", "x", "y")]
    df = spark.createDataFrame(rows + extra, VALUES)
    judged = T.cut_values(df, E.train(df.select("text"))).cache()
    got = {r["record_id"] for r in judged.filter("cut").collect()}
    assert len(got & cut) >= 0.97 * len(cut)
    assert len(got - cut) <= 0.01 * len(cut)
    assert judged.count() == len(rows) + 1
    (rate,) = T.cut_rates(judged).collect()
    assert rate["n_cut"] == len(got) and rate["n_values"] == len(rows) + 1


def test_hot_contexts_change_nothing(spark):
    rows, _ = _values(600, 5)
    df = spark.createDataFrame(rows + [("t", f"h{i}", "p", "m", "0", "x", "y") for i in range(300)], VALUES)
    pairs = E.train(df.select("text"))
    pick = lambda d: sorted(map(tuple, d.select("record_id", "cut", "chance").collect()))
    assert pick(T.cut_values(df, pairs)) == pick(T.cut_values(df, pairs, hot_rows=20))


def test_chances_agree_with_a_count_by_hand(spark):
    rows, _ = _values(300, 8)
    df = spark.createDataFrame(rows, VALUES)
    texts = T.prepared(df, E.train(df.select("text")))
    got = {r["ctx"]: r["chance"] for r in T.context_chances(texts).collect()}
    held = texts.collect()
    pad = "\x02" * T.LEVELS[-1]
    for r in held[:40]:
        chance = 0.05
        for k in T.LEVELS:
            ctx = (pad + r["normal"])[-k:]
            ends = sum((pad + q["normal"]).endswith(ctx) for q in held) - 1
            occurs = sum((pad + q["normal"])[p - k : p] == ctx for q in held for p in range(len(pad) + 1, len(pad) + len(q["normal"]) + 1)) - 1
            chance = (ends + T.PRIOR * chance) / (occurs + T.PRIOR)
        assert abs(got[r["ctx"]] - chance) < 1e-9


def test_codes_that_all_differ_are_whole(spark):
    """No cuts where none are: a column of random codes, alone and beside texts with cuts."""
    rng = random.Random(12)
    code = lambda n: "".join(rng.choice("ABCDEFGHKLMNPRSTUVXYZ0123456789-") for _ in range(n))
    codes = [("t", f"c{i}", "p", "codes", code(rng.choice((8, 8, 11))), "x", "y") for i in range(5000)]
    rows, cut = _values(3000, 4)
    mixed = [("t", f"m{i}", "p", "m", code(9), "x", "y") for i in range(300)]
    df = spark.createDataFrame(codes + rows + mixed, VALUES)
    got = {r["record_id"] for r in T.cut_values(df, E.train(df.select("text"))).filter("cut").collect()}
    assert sum(i.startswith("c") for i in got) <= 5
    assert sum(i.startswith("m") for i in got) <= 3
    assert len(got & cut) >= 0.97 * len(cut)


def test_bloom_filters_know_their_hashes(spark):
    for n in (10, 200_000):
        hashes = spark.range(n).select(F.xxhash64("id").alias("h"))
        bits = T._bloom(hashes, n)
        own = np.array([r["h"] for r in hashes.collect()], dtype=np.int64).view(np.uint64)
        chunks = len(bits) * 8 // T.CHUNK_BITS
        there = lambda x: np.logical_and(*[(bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 for p in T._places(x, chunks)])  # noqa: B023, E731
        assert there(own).all() and there(own ^ np.uint64(0x5DEECE66D5DEECE6)).mean() < 0.05


def test_empty_table(spark):
    df = spark.createDataFrame([], VALUES)
    assert T.cut_values(df, []).collect() == []
