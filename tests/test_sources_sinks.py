import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lexigraph.functions import text
from lexigraph.operators import tracking
from lexigraph.sinks import writers
from lexigraph.sources import readers


def part_lines(folder):
    out = []
    for name in sorted(glob.glob(f"{folder}/part-*")):
        with open(name, encoding="utf-8") as f:
            out += f.read().splitlines()
    return out


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_text_functions(spark):
    assert value(spark, text.java_trim(F.lit("\t a b \x00\t"))) == "a b"
    assert value(spark, text.decade_label(text.decade(F.lit("1998")))) == "1990"
    assert value(spark, text.image_format(F.lit("http://h/a.b/x.JPE"))) == "jpg"
    assert value(spark, text.image_format(F.lit("http://h/x.png"))) == "png"
    assert [value(spark, c) for c in text.split_first(F.lit("u;t;x"))] == ["u", "t;x"]
    assert [value(spark, c) for c in text.split_first(F.lit("u"))] == [None, None]
    assert value(spark, text.base_name(F.lit("http://h/p/x.gif"))) == "x.gif"
    assert value(spark, text.numbered_thumb(F.lit("w"), F.lit(3))) == "w_3"
    assert value(spark, text.whole_number(F.lit("+12"))) == 12
    assert value(spark, text.whole_number(F.lit("1.0"))) is None
    assert value(spark, text.whole_number(F.lit("1000000000000000001"))) == 10**18 + 1
    assert value(spark, text.whole_number(F.lit(str(2**63)))) is None
    ms = text.elapsed_ms(F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit("2024-01-01 00:00:01.5").cast("timestamp"))
    assert value(spark, ms) == 1500


def test_line_formats(spark, tmp_path, rows):
    lines = ["a b 1990 1 1 1", "Éé c 1991 2 1 1"]
    path = str(tmp_path / "seq")
    offsets = enumerate(lines, start=2**40)  # above 32 bits, to become LongWritable
    spark.sparkContext.parallelize(list(offsets), 2).saveAsNewAPIHadoopFile(
        path,
        "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        "org.apache.hadoop.io.LongWritable",
        "org.apache.hadoop.io.Text",
    )
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    df.write.text(str(tmp_path / "text"))
    df.write.parquet(str(tmp_path / "parquet"))
    for fmt, where in (("sequence", path), ("text", str(tmp_path / "text")), ("parquet", str(tmp_path / "parquet"))):
        assert rows(readers.read_bigrams(spark, where, fmt), "w1", "year") == [("a", "1990"), ("Éé", "1991")]
    with pytest.raises(ValueError):
        readers.read_lines(spark, path, "xml")


def test_shards_and_sample(spark, tmp_path):
    paths = readers.shard_paths(str(tmp_path / "biarcs"), 12)
    assert paths[0].endswith("biarcs.00-of-12") and paths[-1].endswith("biarcs.11-of-12") and len(paths) == 12
    for i, p in enumerate(paths[:2]):
        spark.range(1000).select(F.concat_ws(" ", F.lit(f"line {i}"), "id").alias("value")).write.text(p)
    assert readers.read_biarcs(spark, paths[:2]).count() == 2000
    one = readers.read_biarcs(spark, paths[:2], sample_every=50)
    other = readers.systematic_sample(readers.read_lines(spark, paths[:2]).repartition(7), 50)
    assert sorted(one.collect()) == sorted(other.collect())
    assert 10 < one.count() < 80


def test_pairs(spark, tmp_path):
    (tmp_path / "in.txt").write_text(
        "X melt into Y\tY absorb X\nonly one\na\tb\tc\n\t X rise above Y\tY sink below X\t\n"
    )
    pairs = readers.read_pairs(spark, str(tmp_path / "in.txt"))
    dropped = readers.rejected_pairs(readers.read_text_lines(spark, str(tmp_path / "in.txt")))
    assert sorted(r.value for r in dropped.collect()) == ["a\tb\tc", "only one"]
    writers.write_pair_literals(pairs, str(tmp_path / "out"))
    assert part_lines(tmp_path / "out") == [
        '"X melt into Y" + Constants.S + "Y absorb X",',
        '"X rise above Y" + Constants.S + "Y sink below X",',
    ]


def test_item_lists_and_stop_words(spark, tmp_path, rows):
    (tmp_path / "jobs").mkdir()
    (tmp_path / "jobs" / "j1").write_text("u1\nu2\nu1\n")
    (tmp_path / "jobs" / "j2").write_text("u3\n")
    (tmp_path / "jobs" / "j3").write_text("")
    lists = readers.read_item_lists(spark, str(tmp_path / "jobs"))
    assert rows(lists, "job_id", "item") == [
        ("j1", "u1"), ("j1", "u1"), ("j1", "u2"), ("j2", "u3"), ("j3", None)
    ]
    assert lists.where("submit_seq IS NULL OR submit_seq <= 0").isEmpty()
    (tmp_path / "stop").write_text("eng\tthe\nheb\tשל\n")
    assert rows(readers.read_stop_words(spark, str(tmp_path / "stop"), "heb")) == [("של",)]


def test_key_value_and_modes(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", 3, None)], "x string, y string, n int, z string")
    out = str(tmp_path / "kv")
    writers.write_key_value(df, out, keys=2)
    assert part_lines(out) == ["a b\t3 "]
    with pytest.raises(AnalysisException):
        writers.write_key_value(df, out)
    writers.write_key_value(df, out, mode="overwrite")
    assert writers.materialise(df, str(tmp_path / "table")).collect() == df.collect()


def test_ordered_lines_of_a_large_key_span_files_in_order(spark, tmp_path):
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 == 0, "small").otherwise("large").alias("job_id"),
        F.col("id").alias("seq"),
        F.col("id").cast("string").alias("line"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    writers.write_summaries(df.repartition(5), str(tmp_path / "s"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    large = tmp_path / "s" / "job_id=large"
    assert len(glob.glob(f"{large}/part-*")) > 1
    for key, ids in (("large", [i for i in range(5000) if i % 10]), ("small", list(range(0, 5000, 10)))):
        assert [int(x) for x in part_lines(tmp_path / "s" / f"job_id={key}")] == ids


def test_report_files(spark, tmp_path):
    report = spark.createDataFrame(
        [("199", 3, 0.2, "a", "b", "second"), ("199", 0, None, None, None, "title"), ("199", 3, 0.9, "z", "z", "first")],
        "decade string, section int, npmi double, w1 string, w2 string, line string",
    )
    writers.write_decade_report(report, str(tmp_path / "d"))
    assert part_lines(tmp_path / "d" / "decade=199") == ["title", "first", "second"]
    html = spark.createDataFrame(
        [("j", 2, 0, "foot"), ("j", 1, 5, "b"), ("j", 0, 0, "head"), ("j", 1, 4, "a")],
        "job_id string, section int, seq bigint, html string",
    )
    writers.write_gallery(html, str(tmp_path / "g"))
    assert part_lines(tmp_path / "g" / "job_id=j") == ["head", "a", "b", "foot"]
    lines = spark.createDataFrame(
        [("w", 6, 1, "1: b"), ("w", 6, 0, "0: a"), ("w", 0, 0, "Worker")],
        "worker string, section int, idx bigint, line string",
    )
    writers.write_worker_report(lines, str(tmp_path / "w"))
    assert part_lines(tmp_path / "w" / "worker=w") == ["Worker", "0: a", "1: b"]


def test_messages_round_trip(spark, tmp_path, rows):
    sent = spark.createDataFrame(
        [("m1", 1, "c", "mgr", tracking.START_JOB, "j", "list")],
        "msg_id string, seq bigint, from_id string, to_id string, type string, job_id string, body string",
    )
    writers.send_messages(sent, str(tmp_path / "q"))
    got = readers.read_messages(spark, str(tmp_path / "q"))
    assert rows(got, *sent.columns) == rows(sent)
    stream = readers.read_message_stream(spark, str(tmp_path / "q"))
    writers.send_message_stream(stream, str(tmp_path / "q2"), str(tmp_path / "cp")).awaitTermination()
    assert rows(readers.read_messages(spark, str(tmp_path / "q2")), *sent.columns) == rows(sent)


def test_lines_keep_their_numbers_over_files(spark, tmp_path, rows):
    """A key that spans many part files, with empty lines, and files of several blocks."""
    lines = spark.range(4000).select(
        F.when(F.col("id") % 4 == 0, "small").otherwise("large").alias("key"),
        (F.col("id") * 7919 % 4000).alias("at"),
    ).withColumn("line", F.when(F.col("at") % 10 == 0, "").otherwise(F.concat(F.lit("line "), F.col("at").cast("string"))))
    expected = []
    for key in ("large", "small"):
        found = sorted((r["at"], r.line) for r in lines.where(F.col("key") == key).collect())
        expected += [(key, i + 1, line) for i, (_, line) in enumerate(found)]
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    try:
        spark.conf.set(coalesce, "false")
        writers.write_ordered_lines(lines, str(tmp_path / "out"), "key", "line", ["at"])
        assert len(list((tmp_path / "out").glob("key=large/part*"))) > 1
        for c in before:
            spark.conf.set(c, "2000")
        got = rows(readers.read_ordered_lines(spark, str(tmp_path / "out"), "key"))
    finally:
        spark.conf.unset(coalesce)
        for c, v in before.items():
            spark.conf.set(c, v)
    assert got == sorted(expected, key=repr)


def test_no_lines_are_read_back_as_none(spark, tmp_path):
    """A report without a line has no folder of a key."""
    lines = spark.createDataFrame([], "job_id string, seq bigint, line string")
    writers.write_summaries(lines, str(tmp_path / "none"))
    found = readers.read_ordered_lines(spark, str(tmp_path / "none"), "job_id")
    assert found.columns == ["job_id", "line_no", "line"] and found.collect() == []


def test_sequence_files_pass_no_row_through_python(spark, tmp_path, rows):
    lines = spark.createDataFrame([("a b\tc",), ("",), ("é",), ("ends with\r",)], "value string")
    writers.write_sequence_lines(lines, str(tmp_path / "s"))
    assert next((tmp_path / "s").glob("part-*")).read_bytes().startswith(b"SEQ\x06\x21org.apache.hadoop.io.LongWritable")
    found = readers.read_sequence_lines(spark, str(tmp_path / "s"))
    assert rows(found) == rows(lines.replace("ends with\r", "ends with"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan


def test_written_times_keep_their_microseconds(spark, tmp_path):
    sent = spark.createDataFrame([("m", 1, "2024-01-02 03:04:05.678901", None, None, None, None, None)],
                                 readers.MESSAGE_SCHEMA.replace("timestamp", "string"))
    sent = sent.withColumn("ts", F.col("ts").cast("timestamp"))
    writers.send_messages(sent, str(tmp_path / "m"))
    back = spark.read.schema(readers.MESSAGE_SCHEMA).json(str(tmp_path / "m"))
    assert back.select(F.unix_micros("ts")).first()[0] == sent.select(F.unix_micros("ts")).first()[0]
