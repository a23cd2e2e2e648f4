import random

import pytest

from kitloom.llm import charmodel as C
from kitloom.llm import encodings as E

WORDS = "узел ввода площадь покрытия насосной станции принят уклон схема опалубки крепление элементам опорной плиты дренажный колодец отметка низа балки по письму заказчика лист раздела разрез развёртка коридор".split()


def corpus(n=4000, seed=1):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(2, 9))).capitalize() + rng.choice(["", ".", f" {rng.randrange(100)}", f", {rng.randrange(99)},5 м²", f" № {rng.randrange(50)}", " DN80"]) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    a, b, n = C.count_pairs(corpus())
    return E.EncodingModel(list(zip(a.tolist(), b.tolist(), n.tolist(), strict=True)))


def test_whole_texts_come_back(model):
    texts = [t for t in corpus(60, 2) if sum(c.isalpha() for c in t) > 12]
    for g in E.GARBLINGS:
        if isinstance(g, E.Loss) or g.wrong in ("mac_cyrillic", "iso8859_5"):
            continue
        bad = [g.apply(t) for t in texts]
        found = model.spans(bad)
        changed = [i for i, t in enumerate(texts) if bad[i] != t]
        assert len(set(found) & set(changed)) >= 0.97 * len(changed), g
        exact = [i for i in changed if i in found and g.undo(bad[i]) == texts[i]]
        assert sum(E.restore(bad[i], found[i]) == (texts[i], True) for i in exact) >= 0.9 * len(exact), g


def test_part_of_a_text(model):
    g = E.Garbling("utf-8", "cp1251")
    text = "Узел ввода насосной станции, " + g.apply("площадь покрытия принят") + " раздела"
    (spans,) = model.spans([text]).values()
    assert E.restore(text, spans)[0] == "Узел ввода насосной станции, площадь покрытия принят раздела"


def test_clean_texts_and_losses(model):
    assert model.spans(corpus(500, 3)) == {}
    found = model.spans(["???? ????? ???????", "������� ������", "Узел ввода", ""])
    assert set(found) == {0, 1}
    assert not E.restore("???? ?????", found[0])[1]


def test_stretches_never_lose_a_garbled_path(model):
    """Labels by stretches are those of the search over whole texts."""
    import numpy as np

    rng = random.Random(5)
    garble = lambda t: rng.choice(E.GARBLINGS).apply(t)
    texts = corpus(150, 4) + [garble(t) for t in corpus(150, 6)] + [f"{a} {garble(b)} {c}" for a, b, c in zip(corpus(150, 7), corpus(150, 8), corpus(150, 9), strict=True)]
    found, several = model.spans(texts), 0
    for i, t in enumerate(texts):
        pairs, starts = model._pairs([t])
        row = model._viterbi(pairs[None, :], np.array([len(t)]), np.array([True]), np.array([True]))[0]
        labels = np.zeros(len(t), dtype=int)
        for a, b, state in found.get(i, ()):
            labels[a:b] = state
        assert (labels == row).all(), t
        several += 0 < (row > 0).sum() < len(t)
    assert several > 50


def test_unusual_characters_keep_the_tables_bounded():
    texts = corpus(200, 3) + ["".join(chr(k) for k in range(s, s + 500) if not 0xD800 <= k < 0xE000) for s in range(0x100, 0x3000, 500)] + ["😀 узел \U00020000"]
    a, b, n = C.count_pairs(texts)
    assert len(set(a.tolist()) | set(b.tolist())) < 500
    model = E.EncodingModel(list(zip(a.tolist(), b.tolist(), n.tolist(), strict=True)))
    assert model.emit.nbytes < 64 << 20
    assert model.spans(["узел ввода 😀", "あ узел"]) == {}


def test_very_long_texts(model):
    g = E.Garbling("cp1251", "cp1252")
    clean = "узел ввода насосной станции " * 9000
    middle = g.apply("площадь покрытия принят " * 6000)
    (spans,) = model.spans([clean + middle + clean, "", clean]).values()
    ((start, end, _),) = spans  # a space at its end may be on either side
    assert start == len(clean) and end in (len(clean) + len(middle) - 1, len(clean) + len(middle))
    assert E.restore(clean + middle + clean, spans)[0] == clean + "площадь покрытия принят " * 6000 + clean


def test_larger_batches_keep_rows():
    import pyarrow as pa

    from kitloom.llm.batches import larger

    small = [pa.RecordBatch.from_arrays([pa.array(range(k, k + 3))], names=["a"]) for k in range(0, 30, 3)]
    joined = list(larger(iter(small), rows=7))
    assert [v for b in joined for v in b.column(0).to_pylist()] == list(range(30)) and len(joined) == 4
    assert list(larger(iter([]))) == []


RECORDS = "table_name string, record_id string, text string, restored string, model string"


def test_records(spark):
    texts = corpus(800, 7)
    bad = E.Garbling("cp1251", "cp1252").apply(texts[0] + " узел ввода")
    rows = [("t", str(i), t, "x", "y") for i, t in enumerate(texts)] + [("t", "n", None, "x", "y"), ("t", "e", "", "x", "y"), ("t", "g", bad, "x", "y"), ("t", "g", bad, "x", "y"), ("t", "long", "узел ввода " * 20_000, "x", "y")]
    df = spark.createDataFrame(rows, RECORDS)
    pairs = E.train(df.select("text"))
    got = [(r["record_id"], r["restored"], r["restorable"]) for r in E.garbled_records(df, pairs).collect()]
    assert got == [("g", texts[0] + " узел ввода", True)] * 2


def test_empty_table(spark):
    df = spark.createDataFrame([], RECORDS)
    assert E.garbled_records(df, E.train(df.select("text"))).collect() == []
