import random
from math import log2, sqrt

from kitloom.llm import divergence as D

DOC = "doc_id long, lang string, text string, n_words long, size int"


def _brute(own, reference):
    total = sum(own.values())
    p = {}
    for item, n in own.items():
        k = item if item in reference else D.OTHER
        p[k] = p.get(k, 0) + n / total
    out = 0.0
    for k in set(p) | set(reference):
        a, b = p.get(k, 0.0), reference.get(k, 0.0)
        m = (a + b) / 2
        out += (a * log2(a / m) if a else 0) / 2 + (b * log2(b / m) if b else 0) / 2
    return sqrt(max(0.0, out))


def test_distance_is_jensen_shannon():
    rng = random.Random(1)
    for _ in range(200):
        items = rng.sample("abcdefghij", 6)
        weights = [rng.random() for _ in range(7)]
        reference = {k: w / sum(weights) for k, w in zip([*items, D.OTHER], weights, strict=True)}
        own = {k: rng.randrange(1, 9) for k in rng.sample("abcdefghijkl", rng.randrange(1, 8))}
        assert abs(D.distance(own, reference) - _brute(own, reference)) < 1e-9
    assert D.distance({}, {"a": 1.0}) is None
    assert D.distance({"a": 3}, {"a": 1.0, D.OTHER: 0.0}) == 0.0
    assert D.distance({"b": 3}, {"a": 1.0, D.OTHER: 0.0}) == 1.0


def test_documents(spark):
    rng = random.Random(2)
    usual = [f"слово{k}" for k in range(40)]
    page = lambda: " ".join(rng.choice(usual) for _ in range(60))
    rows = [(i, "ru", page()) for i in range(60)] + [(100, "ru", "уклон кровли " * 30), (101, None, page()), (102, "ru", None), (103, "ru", ""), (104, "xx", "мало слов"), (105, "ru", "1 2 3 " * 50), (0, "ru", rows0 := page()), (106, "ru", page() * 500)]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], DOC)
    got = {r["doc_id"]: r for r in D.divergence(df).collect()}
    assert rows0 and len(got) == 67 and got[100]["unusual"] and not got[1]["unusual"]
    assert got[102]["word_distance"] is None and got[105]["n_words"] == 0 and not got[104]["unusual"]
    assert got[104]["word_distance"] is not None and got[100]["word_distance"] > got[1]["word_distance"]
    assert D.divergence(df.limit(0)).collect() == []


def test_references_are_shares(spark):
    df = spark.createDataFrame([("ru", "а а б"), ("ru", "в 7"), (None, "а"), ("en", None)], "lang string, text string")
    known = D.references(df, common_words=2)
    assert known["ru"]["word"] == {"а": 0.5, "б": 0.25, D.OTHER: 0.25}
    assert known[D.ALL]["word"]["а"] == 0.6
    assert set(D.references(df, languages=0)) == {D.ALL}
