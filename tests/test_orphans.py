import datetime as dt
import random

from pyspark.sql import functions as F

from kitloom.operators import orphans as O

T0 = dt.datetime(2024, 1, 10)
REC = "id string, loaded_at timestamp, deleted_at timestamp, key string, at long, slot long"
BND = "id string, instance_id string, legend_entry_id string, loaded_at timestamp, payload string, key string"
REL = "id string, target_id string, loaded_at timestamp, at long"


def _found(spark, bindings, relationships, instances, legends):
    out = O.symbol_orphans(spark.createDataFrame(bindings, BND), spark.createDataFrame(relationships, REL), spark.createDataFrame(instances, REC), spark.createDataFrame(legends, REC))
    return sorted((r["table_name"], r["ref_id"], r["field_name"]) for r in out.collect())


def _at(days):
    return T0 + dt.timedelta(days=days)


def test_missing_deleted_late_and_alive(spark):
    instances = [("S1", _at(0), None, "x", 1, 1), ("S2", _at(0), _at(5), "x", 1, 1), ("S3", _at(9), None, "x", 1, 1), (None, _at(0), None, "x", 1, 1), ("S4", None, None, "x", 1, 1), ("S5", _at(4), _at(1), "x", 1, 1)]
    rows = [
        ("b1", " s1 ", None, _at(6), "p", "k"), ("b2", "S2", None, _at(4), "p", "k"), ("b3", "S2", None, _at(5), "p", "k"), ("b4", "S3", None, _at(8), "p", "k"),
        ("b5", "S3", None, _at(7.9), "p", "k"), ("b6", "S9", "S1", _at(6), "p", "k"), ("b6", "S9", "S1", _at(6), "p", "k"), ("b7", "S4", None, _at(6), "p", "k"), ("b8", "S5", None, _at(3.5), "p", "k"), ("b9", "S1", None, None, "p", "k"), ("b10", "", None, _at(6), "p", "k"),
    ]
    got = _found(spark, rows, [("r1", "S1", _at(-2), 1), ("r2", None, _at(0), 1)], instances, [])
    assert got == sorted([("symbol_bindings", b, "instance_id") for b in ("b3", "b5", "b6", "b7", "b8", "b9", "b10")] + [("relationships", "r1", "target_id")])


def test_empty_tables(spark):
    assert _found(spark, [], [], [], []) == []
    assert _found(spark, [("b", "S", None, T0, "p", "k")], [], [], []) == [("symbol_bindings", "b", "instance_id")]


def test_random_changes_agree_with_brute_force(spark):
    rng = random.Random(3)
    hour = lambda n: T0 + dt.timedelta(hours=n)
    records = [(f"K{rng.randrange(12)}", hour(rng.randrange(400)), hour(rng.randrange(500)) if rng.random() < 0.5 else None, "x", 1, 1) for _ in range(60)]
    refs = [(f"r{i}", f"K{0 if rng.random() < 0.4 else rng.randrange(14)}", hour(rng.randrange(450)), 1) for i in range(400)]
    day = dt.timedelta(days=1)
    alive = lambda k, t: any(i.lower() == k.lower() and a <= t + day and (x is None or x > t) for i, a, x, *_ in records)
    expected = sorted(("relationships", r, "target_id") for r, k, t, _ in refs if not alive(k, t))
    assert _found(spark, [], refs, records[:30], records[30:]) == expected
    # hot keys in two steps give the same
    own = O.reference_rows(spark.createDataFrame(refs, REL), "relationships", "id", ["target_id"])
    deltas = O.existence_deltas(spark.createDataFrame(records, REC))
    pick = lambda **how: sorted((r["payload"]["ref_id"], r["references"]) for r in O.orphan_references(own, deltas, **how).collect())
    assert [r for r, _ in pick()] == [r for _, r, _ in expected] and pick() == pick(hot_rows=30) == pick(hot_rows=0)


def test_report_counts_by_month(spark):
    deltas = O.existence_deltas(spark.createDataFrame([], REC))
    refs = O.reference_rows(spark.createDataFrame([("r1", "a", _at(0), 1), ("r2", "a", _at(30), 1), ("r3", "b", _at(1), 1)], REL), "relationships", "id", ["target_id"])
    rows = O.orphan_report(O.orphan_references(refs, deltas).select("payload.*")).orderBy("period").collect()
    assert [(r["period"], r["orphans"]) for r in rows] == [("2024-01", 2), ("2024-02", 1)]
    assert O.orphan_references(refs, deltas).agg(F.max("references")).first()[0] == 2


def test_a_key_that_a_third_of_all_rows_refer_to_at_one_time(spark):
    refs = spark.range(9000).select(F.when(F.expr("id % 3 = 0"), "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key"), F.lit(5).cast("long").alias("at"), F.struct(F.col("id").alias("ref_id")).alias("payload"))
    deltas = spark.range(9000).filter("id % 3 = 1").select(F.concat(F.lit("k"), "id").alias("key"), F.lit(1).cast("long").alias("at"), F.lit(1).alias("exists"))
    times = O.orphan_times(refs, deltas)
    assert times.filter("key = 'hot'").collect()[0]["refs"] == 3000
    for small, hot in ((10**6, 10**6), (0, 100), (0, 10**6)):
        got = O.orphan_references(refs, deltas, small_rows=small, hot_rows=hot).select("payload.ref_id").collect()
        assert sorted(r[0] for r in got) == [i for i in range(9000) if i % 3 != 1]


def test_counts_are_kept_over_a_stream(spark, tmp_path):
    from kitloom.streaming import orphancounts as C

    source, path = tmp_path / "changes", str(tmp_path / "counts")
    ddl = "key string, refs long, exists long"
    batches = [[("a", 1, None), ("b", 2, None), (None, 1, 1), ("c", None, 1)], [("b", None, 1), ("d", 1, 0)], [("a", -1, None), ("b", None, -1)], []]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(source))
        query = C.keep_counts(spark.readStream.schema(ddl).parquet(str(source)), path, str(tmp_path / "checkpoint"), availableNow=True)
        query.awaitTermination()
        want = {0: {"a": 1, "b": 2}, 1: {"a": 1, "d": 1}}.get(k, {"b": 2, "d": 1})
        assert {r["key"]: r["refs"] for r in O.current_orphans(C.counts_at(spark, path)).collect()} == want
    assert len(C.versions(spark, path)) <= C.KEPT
    # the last batch run again finds the same base
    C.applied(path)(spark.createDataFrame(batches[-1], ddl), C.versions(spark, path)[-1])
    assert {r["key"]: r["refs"] for r in O.current_orphans(C.counts_at(spark, path)).collect()} == {"b": 2, "d": 1}
