import os

from lexigraph.session import clear_scratch, scratch_dir, widen


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark.newSession(), "x")
    assert a != b and a.startswith(f"{base}/x-") and b.startswith(f"{base}/x-")


def test_small_scans_are_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    cores = spark.sparkContext.defaultParallelism
    assert scan.rdd.getNumPartitions() < cores
    assert widen(scan, "id").rdd.getNumPartitions() == cores
    wide = spark.range(100).repartition(cores)
    assert widen(wide, "id") is wide


def test_scratch_is_cleared(spark):
    clear_scratch(spark)
    written, unused = scratch_dir(spark, "a"), scratch_dir(spark, "b")
    spark.range(3).write.parquet(written)
    assert os.path.isdir(written) and clear_scratch(spark) == 1 and not os.path.exists(written)
    assert clear_scratch(spark) == 0 and not os.path.exists(unused)
