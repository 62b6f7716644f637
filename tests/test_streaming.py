import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lexigraph.operators import tracking as ops
from lexigraph.sinks import writers
from lexigraph.sources import readers
from lexigraph.streaming import tracking as stream

T0 = dt.datetime(2024, 1, 1)
ORDERS = [("j1", "a"), ("j1", "b"), ("j1", "a"), ("j2", "a"), ("j2", "c")]
REPLIES = [
    ("j1", ops.FINISHED_WORK, "a;t0"), ("j2", ops.ERROR_WORK, "c"), ("j1", ops.FINISHED_WORK, "b;t1"),
    ("j1", ops.FINISHED_WORK, "a;t2"), ("j2", ops.FINISHED_WORK, "a;t3"), ("j2", ops.FINISHED_WORK, "z;t4"),
    ("j1", ops.FINISHED_WORK, "a;late"),
]


def message(seq, job, kind, body, msg_id=None):
    return (msg_id or f"m{seq}", seq, T0 + dt.timedelta(seconds=seq), "x", "y", kind, job, body)


def send(spark, data, folder, files):
    step = -(-len(data) // files)
    for k in range(0, len(data), step):
        part = spark.createDataFrame(data[k:k + step], readers.MESSAGE_SCHEMA).coalesce(1)
        writers.send_messages(part, folder)


@pytest.mark.parametrize("files", [1, 2, 13])
def test_stream_equals_batch(spark, tmp_path, rows, files):
    data = [message(i, j, ops.INIT_WORK, b) for i, (j, b) in enumerate(ORDERS)]
    data += [message(100 + i, j, k, b) for i, (j, k, b) in enumerate(REPLIES)]
    data.append(message(200, "j3", ops.START_JOB, "empty list"))
    send(spark, data, str(tmp_path / "in"), files)
    stream.use_rocksdb(spark)
    messages = readers.read_message_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    stream.write_available(
        stream.match_stream(messages, parts=4), str(tmp_path / "out"), str(tmp_path / "cp")
    ).awaitTermination()
    outcomes = spark.read.parquet(str(tmp_path / "out"))
    assert rows(outcomes.where("outcome = 'alert'"), "job_id", "item", "thumb") == [
        ("j1", "a", "late"), ("j2", "z", "t4")
    ]
    assert rows(stream.progress_from_outcomes(outcomes)) == [
        ("j1", 3, 3, 0, 0, True, 103), ("j2", 2, 1, 1, 0, True, 104), ("j3", 0, 0, 0, 0, True, None)
    ]


@pytest.mark.parametrize("files_per_trigger", [1, 8, 64])
def test_dedupe_keeps_every_first_delivery(spark, tmp_path, rows, files_per_trigger):
    """Two deliveries of each message, hours apart by their stamps, in files in no order."""
    data = [message(i * 3600, "j", ops.INIT_WORK, "u", f"m{i}") for i in range(40)] * 2
    random.Random(3).shuffle(data)
    send(spark, data, str(tmp_path / "in"), 16)
    messages = readers.read_message_stream(spark, str(tmp_path / "in"), files_per_trigger)
    stream.write_available(
        stream.dedupe_stream(messages), str(tmp_path / "out"), str(tmp_path / "cp")
    ).awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "out")), "msg_id")
    assert got == sorted((f"m{i}",) for i in range(40))


@pytest.mark.parametrize("files", [1, 3, 14])
def test_jobs_end_once(spark, tmp_path, rows, files):
    data = [message(-1, j, ops.START_JOB, n) for j, n in (("j1", "3"), ("j2", "2"), ("j3", "0"), ("j4", "5"))]
    data += [message(i, j, ops.INIT_WORK, b) for i, (j, b) in enumerate(ORDERS)]
    data += [message(100 + i, j, k, b) for i, (j, k, b) in enumerate(REPLIES)]
    data.append(message(300, "j1", ops.FINISHED_WORK, "b;again"))
    send(spark, data, str(tmp_path / "in"), files)
    stream.use_rocksdb(spark)
    outcomes = stream.match_stream(readers.read_message_stream(spark, str(tmp_path / "in"), 1))
    stream.write_completions(outcomes, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert rows(stream.read_completions(spark, str(tmp_path / "out"), "s")) == [
        ("j1", ops.JOB_ENDED, 103, "s/job_id=j1"), ("j2", ops.JOB_ENDED, 104, "s/job_id=j2"),
        ("j3", ops.JOB_ENDED, None, "s/job_id=j3"),
    ]


def test_items_are_processed_and_routed(spark, tmp_path, rows):
    data = [message(i, "j", ops.INIT_WORK, b) for i, b in enumerate(["1", "x", "2"])]
    send(spark, data, str(tmp_path / "in"), 2)
    messages = readers.read_message_stream(spark, str(tmp_path / "in"))
    done = ops.process_items(messages.withColumn("item", F.col("body")), lambda s: str(int(s) + 1))
    stream.write_routed(done, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows(out, "item", "status", "result") == [
        ("1", "ok", "2"), ("2", "ok", "3"), ("x", "error", None)
    ]


def test_running_worker_statistics(spark, tmp_path, rows):
    schema = "worker string, seq bigint, url string, start_ts timestamp, ms double, status string, error string"
    for k in range(3):
        data = [(f"w{i % 2}", 10 * k + i, "u", T0, float(i), "ok" if i else "error", None) for i in range(5)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    work = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream.write_updates(
        stream.running_worker_stats(work), str(tmp_path / "out"), str(tmp_path / "cp")
    ).awaitTermination()
    batch = ops.worker_stats(spark.read.parquet(str(tmp_path / "in")))
    assert rows(stream.read_merged(spark, str(tmp_path / "out"), "worker"), *batch.columns) == rows(batch)


def test_updates_are_merged_every_few_batches(spark, tmp_path, rows):
    """Merged tables take the place of batches; a batch that is run again, and a merge that was cut
    off, change nothing."""
    schema = "worker string, seq bigint, url string, start_ts timestamp, ms double, status string, error string"

    def arrive(k):
        data = [(f"w{i % 3}", 10 * k + i, "u", T0, 0.1 * i, "ok" if i else "error", None) for i in range(k + 1)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        work = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        stream.write_updates(
            stream.running_worker_stats(work), str(tmp_path / "out"), str(tmp_path / "cp"), key="worker", every=2
        ).awaitTermination()

    for k in range(5):
        arrive(k)
    run()
    arrive(5)
    run()
    batch = ops.worker_stats(spark.read.parquet(str(tmp_path / "in")), exact=True)
    merged = stream.read_merged(spark, str(tmp_path / "out"), "worker")
    assert rows(merged, *batch.columns) == rows(batch)
    assert stream._marks(spark, str(tmp_path / "out")) == [3, 5]
    assert sorted(p.name for p in (tmp_path / "out" / "batches").glob("batch=*")) == ["batch=-1", "batch=4", "batch=5"]
    # cut off before the mark and the commit: the batch and its merge are made again
    for log in ("5", ".5.crc"):
        (tmp_path / "cp" / "commits" / log).unlink(missing_ok=True)
    (tmp_path / "out" / "marks" / "upto=5").rename(tmp_path / "gone")
    assert rows(stream.read_merged(spark, str(tmp_path / "out"), "worker"), *batch.columns) == rows(batch)
    run()
    assert stream._marks(spark, str(tmp_path / "out")) == [3, 5]
    assert rows(stream.read_merged(spark, str(tmp_path / "out"), "worker"), *batch.columns) == rows(batch)
