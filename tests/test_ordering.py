import re

from pyspark.sql import functions as F

from lexigraph.operators import keyed, ordering


def test_numbers_follow_the_order(spark, rows):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), F.lit("x").alias("other")).repartition(5)
    got = ordering.number_rows(df, [F.desc("v")], "n")
    assert got.columns == ["v", "other", "n"]
    assert rows(got, "v", "n") == sorted(((v, 5000 - v) for v in range(5000)), key=repr)


def test_numbers_per_key_with_hot_and_null_keys(spark, rows):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    df = spark.range(3000).select(key.alias("k"), F.col("id").alias("v")).repartition(7)
    expected, seen = [], {}
    for k, v in sorted(((r.k, r.v) for r in df.collect()), key=lambda r: (str(r[0]), r[1])):
        seen[k] = seen.get(k, 0) + 1
        expected.append((k, v, seen[k]))
    for broadcast_rows in (keyed.BROADCAST_ROWS, 0):  # by broadcast, and by lookup
        keyed_before = ordering.broadcast_if_bounded
        ordering.broadcast_if_bounded = lambda frame: keyed_before(frame, broadcast_rows)
        try:
            got = ordering.number_rows(df, ["v"], "n", ["k"], total="all")
        finally:
            ordering.broadcast_if_bounded = keyed_before
        assert rows(got, "k", "v", "n") == sorted(expected, key=repr)
        assert rows(got.where("n = 1"), "k", "all") == sorted(seen.items(), key=repr)


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert ordering.number_rows(df, ["v"], "n", ["k"]).collect() == []


def test_no_group_of_a_running_total_is_large(spark):
    """A key with a third of 200,000 rows, at 1,000 rows a group."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 400).alias("k"), (F.col("id") * 1000).alias("o")
    )
    cut, levels = keyed.bucket_rows(df.repartition(8), "k", "o", 1000)
    largest = cut.groupBy("k", *levels).count().agg(F.max("count")).first()[0]
    assert largest <= 1000
    total = keyed.running_total(df, ["k"], "o", F.lit(1).cast("bigint"), "n", 1000)
    hot = total.where("k = 0").agg(F.max("n"), F.countDistinct("n"), F.count(F.lit(1))).first()
    assert hot[0] == hot[1] == hot[2]


def test_a_lookup_reads_its_rows_once(spark, tmp_path):
    spark.range(100).select((F.col("id") % 9).alias("k"), "id").write.parquet(str(tmp_path / "t"))
    spark.range(9).select(F.col("id").alias("k"), F.lit(11).alias("n"), F.lit("x").alias("x")).write.parquet(str(tmp_path / "k"))
    df, table = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "k"))
    found = keyed.lookup(df, table, ["k"], "inner", "n", hot_rows=5)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation ?\[k#\d+L?,id#", plan)) == 1
    assert found.count() == 100
