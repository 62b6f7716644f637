"""Streaming forms of the work-tracking operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators import tracking as ops
from ..session import delete_path
from .manager import ENDED_SCHEMA, end_jobs
from .state import Table, part_and_bucket

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Micro-batches between two merges of what they have written.
COMPACT_EVERY = 20

# What stands before the first batch.
NOTHING = -1

NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
OUTCOME_SCHEMA = "job_id string, seq bigint, outcome string, item string, thumb string"


class _Outstanding(StatefulProcessor):
    """Open copies per job and item of one part; an item's state goes when it has none."""

    SCHEMA = pa.schema([("bucket", pa.int32()), ("job_id", pa.string()), ("item", pa.string()), ("n", pa.int64())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = Table(handle, "open", self.SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # One micro-batch of one part; the trigger bounds its bytes.
        batch = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable", ignore_index=True)
        started = (batch["type"] == ops.START_JOB).to_numpy()
        outcomes = np.where(started, "started", "alert").astype(object)
        moves = batch[~started & batch["item"].notna().to_numpy()]
        if len(moves):
            outcomes[moves.index] = self._move(moves)
        yield pd.DataFrame(
            {
                "job_id": batch["job_id"].to_numpy(),
                "seq": batch["seq"].to_numpy(),
                "outcome": outcomes,
                "item": batch["item"].to_numpy(),
                "thumb": batch["thumb"].to_numpy(),
            }
        )

    def _move(self, moves: pd.DataFrame) -> np.ndarray:
        """Outcomes of orders and replies in their order, and their copies put into the state."""
        buckets = np.unique(moves["bucket"])
        held = self.open.read(buckets)
        copies = pd.concat([held[["bucket", "job_id", "item"]], moves[["bucket", "job_id", "item"]]], ignore_index=True)
        codes = copies.groupby(["job_id", "item"], sort=False, dropna=False).ngroup().to_numpy()
        before = np.zeros(codes.max() + 1, "int64")
        before[codes[:len(held)]] = held["n"]
        copy = codes[len(held):]
        ordered = (moves["type"] == ops.INIT_WORK).to_numpy()
        steps = pd.Series(np.where(ordered, 1, -1))
        # What is open never falls below zero: a reply that would take it there is an alert, and
        # lifts all that follows by one.
        level = steps.groupby(copy).cumsum() + before[copy]
        lift = np.minimum(level.groupby(copy).cummin(), 0)
        alert = lift < lift.groupby(copy).shift(fill_value=0)
        after = before.copy()
        after[copy] = (level - lift).to_numpy()  # the last one of a copy stays
        first = np.unique(codes, return_index=True)[1]
        self.open.write(copies.iloc[first].assign(n=after)[after > 0], buckets)
        done = np.where(moves["type"] == ops.FINISHED_WORK, "done", "failed")
        return np.where(ordered, "expected", np.where(alert, "alert", done))

    def close(self) -> None:
        pass


def match_stream(messages: DataFrame, parts: int | None = None) -> DataFrame:
    """Outcome of every message of a job: started, expected, done, failed or alert.

    State is kept per hash part of (job, item), so a large job is spread over tasks and a small
    one costs no group of its own; ``parts`` follows the number of shuffle partitions unless it is
    given. A start's item is its body. The session must use the RocksDB state store (``use_rocksdb``).
    """
    if parts is None:
        parts = 4 * int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    replies = (ops.FINISHED_WORK, ops.ERROR_WORK)
    item, thumb = ops.text.split_first(F.col("body"))
    done = F.col("type") == ops.FINISHED_WORK
    rows = messages.where(
        F.col("job_id").isNotNull() & F.col("type").isin(ops.START_JOB, ops.INIT_WORK, *replies)
    ).select(
        "job_id", "seq", "type",
        F.when(done, item).otherwise(F.col("body")).alias("item"),
        F.when(done, thumb).alias("thumb"),
    )
    placed = rows.select("*", *part_and_bucket("job_id", "item", parts=parts))
    return placed.groupBy("part").transformWithStateInPandas(
        statefulProcessor=_Outstanding(),
        outputStructType=OUTCOME_SCHEMA,
        outputMode="Append",
        timeMode="None",
    )


def progress_from_outcomes(outcomes: DataFrame) -> DataFrame:
    """The batch ``job_progress`` table from the outcomes of a stream, or as a stream."""
    def one(value: str):
        return F.when(F.col("outcome") == value, 1).otherwise(0).cast("bigint")

    answered = F.col("outcome").isin("done", "failed")
    return ops.progress_of(
        outcomes.select(
            "job_id", one("expected").alias("total"), one("done").alias("done"),
            one("failed").alias("failed"), F.when(answered, F.col("seq")).alias("seq"),
        )
    )


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def write_available(df: DataFrame, path: str, checkpoint: str, timers: bool = False) -> StreamingQuery:
    """Append a stream to parquet files until all available input is consumed.

    ``timers`` says that the stream has state with timers or a lifetime by the clock. Spark would
    run batches without data for them for ever; here they wait for the next batch with data.
    """
    spark = df.sparkSession
    before = spark.conf.get(NO_DATA_BATCHES)
    try:
        if timers:  # read when the query starts
            spark.conf.set(NO_DATA_BATCHES, "false")
        return (
            df.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(NO_DATA_BATCHES, before)


def dedupe_stream(messages: DataFrame, keep: str = "180 seconds") -> DataFrame:
    """Drop repeated deliveries that arrive within ``keep`` of the first.

    Time is that of arrival, which never runs back, so a message that was not seen before is
    passed on whatever its own ``ts`` is. ``keep`` bounds the state, and how late a repeat may
    be to be known as one.
    """
    arrived = messages.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", keep)
    return arrived.dropDuplicatesWithinWatermark(["msg_id"]).drop("_arrived")


def running_worker_stats(work: DataFrame) -> DataFrame:
    """Statistics per worker so far, for ``write_updates``."""
    return ops.worker_stats(work, exact=True)


def write_routed(processed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Send successful and failed rows to their own folders, ``status=ok`` and ``status=error``."""
    return (
        processed.writeStream.format("parquet")
        .partitionBy("status")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_updates(
    df: DataFrame, path: str, checkpoint: str, key: str | None = None, every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Write the rows of a streaming aggregate that a micro-batch has changed.

    Every batch has its own folder, and a batch that is run again overwrites it. With ``key``, the
    last rows of all batches are merged after each ``every`` batches into one table. A merged
    table counts once its mark is written, so a merge that was cut off is as if never begun and
    made again with its batch. Batches and tables that an earlier mark has superseded are deleted.
    """
    spark = df.sparkSession
    for name in (f"batches/batch={NOTHING}", f"merged/upto={NOTHING}", f"marks/upto={NOTHING}"):
        spark.createDataFrame([], df.schema).write.mode("ignore").parquet(f"{path}/{name}")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batches/batch={batch_id}")
        if key is not None and (batch_id + 1) % every == 0:
            _compact(batch.sparkSession, path, key, batch_id)

    return (
        df.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def _marks(spark: SparkSession, path: str) -> list[int]:
    """The batches up to which there are merged tables, as many as have not been deleted."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/marks")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    done = [f for f in (x.getPath().getName() for x in found) if f.startswith("upto=")]
    return sorted(int(f.removeprefix("upto=")) for f in done)


def _compact(spark: SparkSession, path: str, key: str, batch_id: int) -> None:
    earlier = [m for m in _marks(spark, path) if m < batch_id]
    base = max(earlier)
    rows = _merged_rows(spark, path, key, base, batch_id)
    rows.write.mode("overwrite").parquet(f"{path}/merged/upto={batch_id}")
    spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{path}/marks/upto={batch_id}")
    # one table is left for those who have begun to read it
    for mark in earlier[:-1]:
        for name in ("marks", "merged"):
            delete_path(spark, f"{path}/{name}/upto={mark}")
    for batch in range(max([NOTHING, *earlier[:-1]]) + 1, base + 1):
        if batch != NOTHING:
            delete_path(spark, f"{path}/batches/batch={batch}")


def _merged_rows(spark: SparkSession, path: str, key: str, upto: int, last: int | None = None) -> DataFrame:
    merged = spark.read.parquet(f"{path}/merged/upto={upto}")
    later = spark.read.parquet(f"{path}/batches").where(F.col("batch") > upto)
    if last is not None:
        later = later.where(F.col("batch") <= last)
    rows = later.unionByName(merged.withColumn("batch", F.lit(upto)))
    rest = [c for c in merged.columns if c != key]
    found = rows.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("_row"))
    return found.select(key, "_row.*")


def read_merged(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The last row written for each ``key``: the merged table and the batches after it."""
    return _merged_rows(spark, path, key, max(_marks(spark, path)))


# ---- completion ------------------------------------------------------------------------

def write_completions(outcomes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """One JOB_ENDED row per job, in the micro-batch that completes it (``manager.end_jobs``).

    ``outcomes`` come from ``match_stream``; a start's item is the number of the job's items.
    """
    return write_available(end_jobs(outcomes), path, checkpoint, timers=True)


def read_completions(spark: SparkSession, path: str, summaries: str) -> DataFrame:
    """The rows of ``operators.tracking.completed_jobs`` from ``write_completions``."""
    ended = spark.read.schema(ENDED_SCHEMA).parquet(path)
    return ops.completed_jobs(
        ended.select("job_id", F.lit(True).alias("complete"), F.col("seq").alias("completed_at")), summaries
    )
