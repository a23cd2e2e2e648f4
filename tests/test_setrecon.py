import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kitloom.operators import setrecon as S

KIT = "sheet_key string, code string, title string, sheets_total string, read_at timestamp, h long, bucket long, key string"
ARC = "sheet_key string, code string, title string, sheets_total string, synced_at timestamp, chk long"


def _sketched(hashes, bound, split=1):
    """Rows of one bucket as partial sketches."""
    points = S._points(bound)
    rows = []
    for k in range(split):
        own = np.array(hashes[k::split], dtype=np.uint64)
        if len(own):
            values = S.sketch(own[None, :], np.array([len(own)]), points).astype(np.uint32)
            rows.append((0, len(own), int(np.bitwise_xor.reduce(own.astype(np.int64) * 7)), values[0].tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "n", "chk", "values"])


def _roots(poly, hashes):
    def value(h):
        acc = 1
        for c in reversed(poly):
            acc = (acc * h + c) % S.PRIME
        return acc

    return {h for h in hashes if len(poly) and value(h) == 0}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.integers(20, 60), st.integers(0, 20), st.integers(0, 20))
def test_decoding_finds_exactly_the_difference(seed, common, left, right):
    rng = random.Random(seed)
    pool = rng.sample(range(1, S.HASH_TOP), common + left + right)
    a, b = pool[: common + left], pool[:common] + pool[common + left :]
    got = S.compared(_sketched(a, 32, 3), _sketched(b, 32, 2), 32)
    if not left and not right:
        assert got.empty
        return
    (row,) = got.itertuples(index=False)
    assert not row.whole and row.n_diff == left - right
    if left + right <= 32:
        assert _roots(row.left_poly, a) == set(a[common:]) and _roots(row.right_poly, b) == set(b[common:])
    elif row.left_poly is not None:  # a bound too small is told by the points left over
        raise AssertionError("decoded beyond the bound")


def test_one_side_empty_or_few_rows_are_compared_whole():
    assert S.compared(_sketched([1, 2, 3], 8), _sketched([], 8), 8)["whole"].tolist() == [True]
    assert S.compared(_sketched([1, 2], 8), _sketched([2, 3], 8), 8)["whole"].tolist() == [True]


def test_solver_leaves_free_unknowns_at_zero():
    m = np.array([[[1, 1, 3], [2, 2, 6]]], dtype=np.uint64)
    assert S._solve(m).tolist() == [[3, 0]]


def _run(spark, kit, arc):
    out = S.stamp_differences(spark.createDataFrame(kit, KIT), spark.createDataFrame(arc, ARC))
    assert out.columns == ["sheet_key", "difference"]
    return sorted(map(tuple, out.collect()))


def test_differences_field_by_field(spark):
    t = dt.datetime.fromisoformat
    kit = [
        ("a", "12-AB", "План «А»", "07", t("2024-01-02"), 1, 1, "x"), ("a", "old", "old", "9", t("2024-01-01"), 1, 1, "x"),
        ("b", "1-X", None, "5", t("2024-01-01"), 1, 1, "x"), ("b", "1-X", None, "5", t("2024-01-01"), 1, 1, "x"),
        ("c", "same", "Ёлка  у дома", " 12 ", t("2024-01-01"), None, None, None), (None, "n", "n", "1", t("2024-01-01"), 1, 1, "x"),
        ("d", "1", "x" * 100_000, "1a", None, 1, 1, "x"),
    ]
    arc = [
        ("a", "12 - ab", "план а", "7", t("2024-03-01"), 1), ("c", "SAME", "елка у дома", "12", t("2024-03-01"), 2),
        ("d", "1", "x" * 100_000 + "y", "2a", t("2024-03-01"), 3), ("e", "", "", "", t("2024-03-01"), 4), (None, "m", "m", "2", t("2024-03-01"), 5),
    ]
    assert _run(spark, kit, arc) == [("b", "only_kit"), ("d", "sheets_total"), ("d", "title"), ("e", "only_archive")]


@pytest.mark.parametrize("kit, arc", [([], []), ([("a", None, None, None, None, 1, 1, "x")], []), ([], [("a", None, None, None, None, 1)])])
def test_empty_tables(spark, kit, arc):
    expected = [("a", "only_kit")] if kit else [("a", "only_archive")] if arc else []
    assert _run(spark, kit, arc) == expected


def test_many_rows_agree_with_a_full_join(spark):
    n = 4000
    base = spark.range(n).select(F.concat(F.lit("k"), "id").alias("sheet_key"), F.col("id").cast("string").alias("code"), F.lit("t").alias("title"), F.lit("1").alias("sheets_total"), F.lit("2024-01-01").cast("timestamp").alias("read_at"))
    other = base.filter("code % 17 <> 0").withColumn("title", F.when(F.expr("code % 5 = 0"), "u").otherwise("t")).withColumnRenamed("read_at", "synced_at")
    got = S.stamp_differences(base, other).groupBy("difference").count().collect()
    gone = sum(i % 17 == 0 for i in range(n))
    assert {r["difference"]: r["count"] for r in got} == {"only_kit": gone, "title": sum(i % 5 == 0 and i % 17 != 0 for i in range(n))}


def test_failed_buckets_are_sketched_again(spark):
    """Buckets of many differences need several rounds; one bucket holds all rows."""
    rows = lambda ids: spark.createDataFrame([(str(i), i * 7919 + 1, 0) for i in ids], "key string, chk long, bucket long").coalesce(1)
    left, right = rows(range(0, 120)), rows(range(50, 170))
    got = {(r["side"], r["key"], r["chk"]) for r in S.differing_hashes(left, right, bound=8).collect()}
    assert got == {("left", str(i), i * 7919 + 1) for i in range(50)} | {("right", str(i), i * 7919 + 1) for i in range(120, 170)}


def test_a_key_of_a_third_of_all_rows(spark):
    base = spark.range(3000).select(F.when(F.expr("id % 3 = 0"), "hot").otherwise(F.col("id").cast("string")).alias("sheet_key"), F.lit("c").alias("code"), F.lit("t").alias("title"), F.col("id").cast("string").alias("sheets_total"), F.expr("timestamp_seconds(id)").alias("read_at"))
    other = base.filter("sheets_total <> '2997'")
    got = S.stamp_differences(base, other.withColumnRenamed("read_at", "synced_at")).collect()
    assert [tuple(r) for r in got] == [("hot", "sheets_total")]
