from pyspark.sql import functions as F

from kitloom.operators import skew


def test_salted_join_is_the_join(spark):
    big = spark.range(4000).select(F.col("id").alias("row"), F.when(F.expr("id % 3 = 0"), 7).otherwise(F.expr("id % 50")).alias("k"))
    small = big.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 10)
    plain = sorted(map(tuple, big.join(small, "k").select("row", "k", "v").collect()))
    for hot in (10**9, 500, 10):
        got = skew.salted_join(big, small, "k", weight="n", spread=F.col("row"), hot_rows=hot, salts=8)
        assert sorted(map(tuple, got.select("row", "k", "v").collect())) == plain
    assert skew.salted_join(big.limit(0), small, "k", weight="n", spread=F.col("row"), hot_rows=1).collect() == []


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(20)
    plan = lambda most: spark.range(5).join(skew.broadcast_if_small(df, most), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(20).lower()
    assert "strategy=broadcast" not in plan(19).lower()
