import random
import unicodedata

import pytest

from kitloom.llm import charmodel as C
from kitloom.llm import encodings as E
from kitloom.llm import uniform as U

from .test_encodings import corpus


@pytest.fixture(scope="module")
def pairs():
    a, b, n = C.count_pairs([*corpus(), "Höhe über Grund 5", "façade sud", "Труба DN80 PN16 LED IP44", "unit volt line Lager Linie Unterlage"])
    return list(zip(a.tolist(), b.tolist(), n.tolist(), strict=True))


@pytest.fixture(scope="module")
def form(pairs):
    return U.WordForm(pairs)


@pytest.mark.parametrize(
    "text, plain",
    [
        ("Узeл ввoдa", "Узел ввода"), ("HBK１", "НВК1"), ("ΡС-39 СΡ-4", "РС-39 СР-4"), ("PC", "РС"), ("LЕD", "LED"), ("DN80 РN16", "DN80 PN16"),
        ("по​з­. 4⁠﻿", "поз. 4"), ("отм. ＋１2.0\U0001d7d80", "отм. +12.000"), ("Ф‑22", "Ф-22"), ("Узел 　ввода", "Узел  ввода"),
        ("й ё", "й ё"), ("передаëт", "передаёт"), ("№ 5, 3 м², 2 м³, Ø12, 2×3, 5 %, «а» – б", "№ 5, 3 м², 2 м³, Ø12, 2×3, 5 %, «а» – б"),
        ("Höhe über Grund", "Höhe über Grund"), ("façade sud", "façade sud"), ("Ｇrößｅ 4", "Größe 4"), ("", ""), ("12345", "12345"), ("DЖ", "DЖ"), ("υnit νolt", "unit volt"), ("Ӏine Ӏager", "line lager"), ("ӏinie", "linie"),
    ],
)
def test_forms(form, text, plain):
    assert form.text(text) == plain
    assert form.text(plain) == plain


def test_random_disguises_come_back(form):
    rng = random.Random(1)
    back = {c: a for a, c in U.PAIRS.items()}
    for text in corpus(300, 9):
        out = "".join(rng.choice(["", "​"]) + (back[c] if c in back and rng.random() < 0.4 else c) for c in text)
        out = unicodedata.normalize("NFD", out) if rng.random() < 0.3 else out
        assert form.text(out) == text


def test_records(spark, pairs):
    bad = E.Garbling("utf-8", "cp1251").apply("Узел ввода насосной станции")
    rows = [("a", "1", "Узел ввода"), ("a", "2", "Узeл"), ("a", "2", "Узeл"), ("a", "3", None), ("a", "4", ""), ("a", "5", bad), ("b", "5", "схe​ма " * 30_000), ("a", "6", "Höhe")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "table_name string, record_id string, text string, uniform string")
    got = sorted((r["table_name"], r["record_id"]) for r in U.inconsistent_records(df, pairs, garbled_tables=("a",)).collect())
    assert got == [("a", "2"), ("a", "2"), ("b", "5")]
    assert U.inconsistent_records(df.limit(0), pairs).collect() == []
    texts = U.uniform_texts(df, pairs, out="form").filter("table_name = 'a'").select("form").collect()
    assert [r[0] for r in texts][:5] == ["Узел ввода", "Узел", "Узел", None, ""]


def test_scores_choose_between_looks_of_one_alphabet(form):
    """Without counts the lattice has no best letter, so another one is taken."""
    blind = U.WordForm([])
    disguised = ["υnit", "νolt", "Ӏine", "υnterӏage"]
    assert [form.best(w) for w in disguised] == ["unit", "volt", "line", "unterlage"]
    assert [blind.best(w) for w in disguised] != ["unit", "volt", "line", "unterlage"]


def test_viterbi_is_the_best_of_all_paths(form):
    import itertools

    rng = random.Random(3)
    letters = "".join(U.OTHER_LOOKS) + "".join(U.PAIRS) + "ЖшDфg5"
    for _ in range(300):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 6)))

        def worth(path, word=word):
            changes, score, last, before = 0, 0.0, "", U.EDGE
            for c, (alphabet, letter) in zip(word, path, strict=True):
                turn = alphabet != "" and last != "" and alphabet != last
                changes -= turn
                score += (0.0 if letter == c else U.CHANGE_LETTER) + (form.unseen if turn else form.score.get((before, letter), form.unseen))
                last, before = alphabet or last, letter
            return changes, changes == 0 and last == "c", round(score + form.score.get((before, " "), form.unseen), 9)

        best = max(itertools.product(*map(U.looks, word)), key=worth)
        taken = form.best(word)
        assert worth(best) in {worth(p) for p in itertools.product(*map(U.looks, word)) if "".join(x for _, x in p) == taken}
