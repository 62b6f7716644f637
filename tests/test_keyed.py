import re

import pytest
from pyspark.sql import functions as F

from lexigraph.operators import keyed


def skewed(spark):
    return spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        F.col("id").alias("v"),
    )


def test_lookup_keeps_every_row(spark, rows):
    df = skewed(spark)
    table = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    joined = {
        how: rows(df.join(table, "k", {"anti": "left_anti"}.get(how, how))) for how in ("left", "inner", "anti")
    }
    for hot_rows in (1, 100, 10**9):
        for how, expected in joined.items():
            assert rows(keyed.lookup(df, table, ["k"], how, hot_rows=hot_rows)) == expected


def test_hot_list_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(keyed, "HOT_KEYS", 3)
    hot = [r.k for r in keyed.hot_keys(skewed(spark), ["k"], 1).collect()]
    assert len(hot) == 3 and hot[0] == 0


def test_key_totals_name_the_rows(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    assert rows(keyed.key_totals(df, ["k"], s=F.sum("v"))) == [("a", 2, 3), ("b", 1, 5)]


def test_spread_join_equals_join(spark, rows):
    left = skewed(spark)
    right = spark.range(400).select((F.col("id") % 7).alias("k"), F.col("id").alias("w"))
    expected = rows(left.join(right, "k"))
    for lh, rh in ((None, None), (20, None), (None, 20), (100, 50), (50, 20)):
        got = keyed.spread_join(
            left, right, ["k"],
            lh and keyed.hot_keys(left, ["k"], lh), rh and keyed.hot_keys(right, ["k"], rh), ["v"], ["w"],
        )
        assert rows(got, "k", "v", "w") == expected


def test_running_total_does_not_depend_on_buckets(spark, rows):
    # dense, sparse and NULL keys
    df = spark.createDataFrame(
        [(k, o * (10**9 if k == "a" else 1), o % 4) for k in ("a", "b", None) for o in range(-50, 60, 3 if k == "a" else 7)],
        "k string, o bigint, x bigint",
    )
    totals = {}
    for k, o, x in sorted((tuple(r) for r in df.collect()), key=lambda r: (str(r[0]), r[1])):
        totals[k, o] = totals.get((k, "sum"), 0) + x
        totals[k, "sum"] = totals[k, o]
    expected = sorted(((k, o, t) for (k, o), t in totals.items() if o != "sum"), key=repr)
    for hot_rows in (1, 20, 10**9):
        got = keyed.running_total(df.repartition(3), ["k"], "o", F.col("x"), "t", hot_rows)
        assert rows(got, "k", "o", "t") == expected


def test_sparse_orders_are_cut_into_few_buckets(spark, monkeypatch):
    seen = []
    real = keyed.F.percentile_approx
    monkeypatch.setattr(keyed.F, "percentile_approx", lambda *a: seen.append(a) or real(*a))
    df = spark.range(5000).select(F.lit("hot").alias("k"), (F.col("id") * 2_000_000).alias("o"))
    got = keyed.running_total(df, ["k"], "o", F.lit(1), "n", 100)
    assert got.where(F.col("n") != F.col("o") / 2_000_000 + 1).isEmpty() and seen


def test_broadcast_only_what_is_proven_small(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("s"))
    assert keyed.broadcast_if_bounded(df, 10)[1]
    assert not keyed.broadcast_if_bounded(df, 9)[1]
    assert not keyed.broadcast_if_bounded(df, 10, max_chars=9)[1]
    assert not keyed.broadcast_if_bounded(df, 0)[1]


def plan_without_broadcasts(spark, made):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        return made()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)


def test_lookup_deals_flagged_rows_by_their_place(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 AS k")
    table = spark.range(3).selectExpr("id AS k", "'a' || id AS v", "334L AS _rows")
    plan = plan_without_broadcasts(spark, lambda: keyed.lookup(df, table, ["k"], "inner", "_rows", 10))
    assert re.search(r"hashpartitioning\(k#\d+L, _spread#", plan)


@pytest.mark.parametrize("table_rows, join", [(None, "SortMergeJoin"), (3, "ShuffledHashJoin"), (10**9, "SortMergeJoin")])
def test_lookup_hashes_a_table_only_if_its_parts_are_small(spark, table_rows, join):
    df = spark.range(1000).selectExpr("id", "id % 3 AS k")
    table = spark.range(3).selectExpr("id AS k", "'a' || id AS v", "334L AS _rows")
    made = lambda: keyed.lookup(df, table, ["k"], "left", "_rows", 10, table_rows)
    assert join in plan_without_broadcasts(spark, made)
    assert made().where("v = 'a' || k").count() == 1000
