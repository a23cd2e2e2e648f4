import itertools
import random

import pytest
from pyspark.sql import functions as F

from kitloom.llm import leakage as W
from kitloom.llm import mixture as M
from kitloom.llm import repetition as R
from kitloom.llm import tokens as T
from kitloom.llm.words import joined_words, words

DOC = "doc_id long, text string, doc long, item long, n_words long, share double"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 0.5) for i, t in rows], DOC)


def test_words():
    assert joined_words("Ёлка у комп-\n лекта, 12-й д​ом") == ["елка", "у", "комплекта", "12", "й", "д", "ом"]
    assert joined_words("конец-\n\nНачало") == ["конец", "начало"]
    assert words("Ёлка_5 м²") == ["ёлка", "5", "м²"]


def test_wu_manber_agrees_with_brute_force():
    rng = random.Random(4)
    for run in (3, 5, 12):
        items = [(i, [rng.choice("abcd") for _ in range(rng.randrange(run - 1, run + 6))]) for i in range(30)]
        shifts, ends = {}, set()
        for _, w in items:
            own, tails = W.table_rows(w, run)
            shifts = {b: min(m, shifts.get(b, run)) for b, m in (shifts | own).items()} | {b: min(m, shifts[b]) for b, m in own.items() if b in shifts}
            ends |= tails
        patterns = {i: {" ".join(w[k : k + run]) for k in range(len(w) - run + 1)} for i, w in items}
        searches = [W.Tables(*W.filled(run - 1, entries, shifts, ends), run) for entries in (1 << 16, 4, 1)]  # hashes that meet cost nothing but work
        for _ in range(150):
            text = [rng.choice("abcde") for _ in range(rng.randrange(60))]
            if rng.random() < 0.5:
                text[5:5] = items[rng.randrange(30)][1]
            grams = {tuple(text[k : k + run]) for k in range(len(text) - run + 1)}
            expected = {i for i, w in items if any(tuple(w[k : k + run]) in grams for k in range(len(w) - run + 1))}
            for tables in searches:
                found = set(tables.windows(text))
                assert {i for i, p in patterns.items() if p & found} == expected


def test_leaks(spark):
    item = " ".join(f"слово{i}" for i in range(20))
    rows = [(1, "начало " + item), (2, item[: item.index("слово11") + 7]), (3, item[: item.index("слово10") + 7]), (4, None), (5, ""), (6, item.upper().replace("СЛОВО5", "СЛО-\nВО5")), (1, "начало " + item), (7, "шум " * 40_000 + item)]
    items = spark.createDataFrame([(9, item, "d"), (8, "коротко", "d"), (7, None, "d"), (6, item, "d")], "item_id long, text string, doc string")
    for how in ({}, {"small_rows": 0}, {"small_rows": 0, "hot_rows": 2}, {"entries": 1 << 16}):
        got = sorted(map(tuple, W.leaked_items(_docs(spark, rows), items, **how).collect()))
        assert got == [(d, i) for d in (1, 2, 6, 7) for i in (6, 9)]
    assert W.leaked_items(_docs(spark, []), items).collect() == []
    assert W.leaked_items(_docs(spark, rows), items.limit(0)).collect() == []


def test_many_items(spark):
    """Tens of thousands of items need no more of the driver than a few."""
    items = spark.range(50_000).select(F.col("id").alias("item_id"), F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), F.expr(f"(id * 31 + {k} * 7) % 9973")) for k in range(13)], F.concat(F.lit("n"), "id")).alias("text"))
    docs = items.filter("item_id % 1000 = 0").select((F.col("item_id") + 1).alias("doc_id"), F.concat(F.lit("начало "), "text", F.lit(" конец")).alias("text"))
    got = {tuple(r) for r in W.leaked_items(docs, items).collect()}
    assert {(i + 1, i) for i in range(0, 50_000, 1000)} <= got
    texts = {r["item_id"]: r["text"].split() for r in items.collect()}
    grams = {}
    for i, w in texts.items():
        for k in range(len(w) - 11):
            grams.setdefault(tuple(w[k : k + 12]), set()).add(i)
    assert got == {(i + 1, j) for i in range(0, 50_000, 1000) for k in range(3) for j in grams.get(tuple(texts[i][k : k + 12]), ())}


def _brute_repeated(found, run=6):
    marked = set()
    for i in range(len(found) - run + 1):
        if any(found[j : j + run] == found[i : i + run] for j in range(i)):
            marked |= set(range(i, i + run))
    return len(marked)


def test_repeats_agree_with_brute_force():
    rng = random.Random(6)
    for _ in range(400):
        found = [rng.choice("ab") for _ in range(rng.randrange(40))]
        assert R.repeated_words(found) == _brute_repeated(found)
        assert R.repeated_words(found, 2) == _brute_repeated(found, 2)


def test_repetition(spark):
    phrase = "раз два три четыре пять шесть "
    rows = [(1, phrase * 6), (2, phrase * 4), (3, " ".join(f"слово{i}" for i in range(60))), (4, None), (5, ""), (6, "1 2 3 " * 50), (1, phrase * 6), (7, phrase * 20_000)]
    got = {r["doc_id"]: (r["n_words"], r["n_repeated"], r["share"]) for r in R.repetition_share(_docs(spark, rows)).collect()}
    assert got[1] == (36, 30, 30 / 36) and got[4] == got[5] == got[6] == (0, 0, 0.0) and got[3] == (60, 0, 0.0)
    assert sorted(r["doc_id"] for r in R.self_repeating(_docs(spark, rows)).collect()) == [1, 1, 7]
    assert R.self_repeating(_docs(spark, [])).collect() == []


def test_token_counts_are_the_tokenizers_own(spark):
    import base64

    import tiktoken

    path = f"{T.TOKENIZER_DIR}/{T.TOKENIZER}"
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    whole = tiktoken.Encoding("whole", pat_str=T.PIECES, mergeable_ranks=ranks, special_tokens={})
    texts = ["Узел ввода, площадь 12,5 м²\n\n| a | b |", "it's  don't   x", "", "а" * 5000, "\t\n 　é ¥ 𝟏"]
    count = T.counter(open(path, "rb").read())
    assert [count(t) for t in texts] == [len(whole.encode_ordinary(t)) for t in texts]
    got = T.token_counts(_docs(spark, [(1, None), (2, texts[0])]), key="doc_id").collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in got] == [(1, 0), (2, count(texts[0]))]


def test_knapsack_is_exact():
    rng = random.Random(8)
    for _ in range(200):
        counts = {n: rng.randrange(1, 4) for n in rng.sample(range(1, 12), 3)}
        budget = rng.randrange(0, 60)
        sums = {sum(n * k for n, k in zip(counts, ks, strict=True)) for ks in itertools.product(*[range(c + 1) for c in counts.values()])}
        taken = M.knapsack(counts, budget)
        assert all(0 < k <= counts[n] for n, k in taken.items())
        assert sum(n * k for n, k in taken.items()) == max(s for s in sums if s <= budget)


@pytest.mark.parametrize("budget, repeats", [(0, 3), (10**6, 2), (123_457, 3), (987_654, 5), (5, 1)])
def test_fits(budget, repeats):
    rng = random.Random(9)
    counts = {n: rng.randrange(1, 9) for n in rng.sample(range(20, 900), 120)}
    size = sum(n * c for n, c in counts.items())
    fit = M.fit_budget(counts, budget, repeats)
    assert fit.tokens <= min(budget, repeats * size)
    assert all(k <= counts[n] for n, k in fit.extra.items())
    assert fit.tokens == fit.whole * size + sum(n * k for n, k in fit.extra.items())
    if 1000 < budget < repeats * size:
        assert fit.tokens == budget


def test_capped_sources_leave_their_part_to_the_others(spark):
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.1, 4), ("d", 0.1, 2), ("e", None, 2), ("b", 0.2, 9), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    sizes = spark.createDataFrame([("a", 100), ("b", 500), ("c", 400), ("x", 0)], "source string, size long")
    got = {r["source"]: r["budget_tokens"] for r in M.budgets(targets, sizes, 1000).collect()}
    assert got == {"a": 100, "b": 675, "c": 225, "d": 0, "e": 0}
    short = {r["source"]: r["budget_tokens"] for r in M.budgets(targets.filter("source = 'a' or source = 'd'"), sizes, 1000).collect()}
    assert short == {"a": 100, "d": 0}


def test_mixture(spark):
    rows = [(i, "слово " * (5 + i % 40), ("a", "b", "c", None)[i % 4]) for i in range(800)] + [(900, None, "a"), (901, "", "b")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.4, 1), ("d", 0.05, 2), ("c", 0.05, 1), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    chosen, shares = M.mix(docs, targets)
    taken = {}
    for r in chosen.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["n_tokens"] * r["copies"]
        assert 1 <= r["copies"] <= {"a": 3, "b": 1, "c": 1}[r["source"]]
    by = {r["source"]: r for r in shares.collect()}
    assert set(by) == {"a", "b", "c", "d"} and by["d"]["tokens"] == 0
    assert {s: by[s]["tokens"] for s in taken} == taken
    # texts of one word repeated have few lengths, so a budget may lie between two sums
    assert all(0 <= by[s]["budget_tokens"] - by[s]["tokens"] <= 2 for s in "ac")
    assert by["b"]["tokens"] <= by["b"]["budget_tokens"]
    again, _ = M.mix(docs, targets)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, chosen.collect()))
    none, empty = M.mix(docs.limit(0), targets)
    assert none.collect() == [] and all(r["tokens"] == 0 for r in empty.collect())
