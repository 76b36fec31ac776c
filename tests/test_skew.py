import datetime

from pyspark.sql import functions as F

from kinfold.operators import skew

T = datetime.datetime


def table(spark):
    day = lambda i: T(2025, 1, 1 + i % 3, i % 24)
    rows = [("hot", f"n{i % 7}", "a", day(i)) for i in range(300)] + [("x", None, None, None), (None, "n", "a", day(1)), ("y", "m", "a", day(2)), ("y", "m", "a", day(2))]
    return spark.createDataFrame(rows, "country string, business_name string, business_address string, updated_at timestamp").withColumn("n", F.lit(1)).withColumn("_total", F.lit(1))


def test_found(spark):
    assert [r[0] for r in skew.found_keys(table(spark), "country").collect()] == ["hot"]
    assert skew.found_keys(table(spark).limit(0), "country").count() == 0


def test_stats_count_null_key(spark):
    got = {r["country"]: (r["n_rows"], r["n_names"], r["n_distinct_names"]) for r in skew.key_stats(table(spark), "country").collect()}
    assert got == {"hot": (300, 300, 7), "x": (1, 0, 0), None: (1, 1, 1), "y": (2, 2, 1)}


def test_ties_of_top_go_by_value(spark):
    top = skew.top_per_key(table(spark), "country", "business_name", 2).where("country = 'hot'").orderBy("rank").collect()
    assert [(r["business_name"], r["rank"]) for r in top] == [("n0", 1), ("n1", 2)]


def test_rank_equals_plain_rank(spark):
    df = table(spark)
    got = {(r["country"], r["updated_at"]): r["rank"] for r in skew.rank_per_key(df, "country", "updated_at").collect()}
    rows = [(r["country"], r["updated_at"]) for r in df.collect() if r["updated_at"]]
    assert got == {k: 1 + sum(c == k[0] and t < k[1] for c, t in rows) for k in rows}


def test_split_join_with_a_unique_side(spark):
    left = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = left.select("k").distinct().withColumn("m", F.col("k") * 2)
    out = skew.join_split(left, right, "k", unique=True, hot=50, least=100)
    assert out.count() == 6_000 and out.where("m <> k * 2").count() == 0


def test_split_join_is_the_plain_join(spark):
    left = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("a"))
    right = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("b"))
    out = skew.join_split(left, right, "k", hot=50, least=100)
    assert "_row" in out._jdf.queryExecution().toString()
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    assert skew.join_split(left.limit(0), right, "k").count() == 0


def test_meeting_within_a_hot_key(spark):
    df = spark.createDataFrame([("hot", f"v{i:03d}") for i in range(130)] + [("x", "p"), ("x", "q"), ("y", "r")], "k string, v string")
    n = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = skew.meet_within(df.join(n, "k"), "k", "n", ["v"], limit=20).where("a_v < b_v").collect()
    assert len(out) == len({tuple(r) for r in out}) == 130 * 129 // 2 + 1
