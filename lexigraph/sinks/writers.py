"""Writers. ``mode`` is ``errorifexists`` (fail on an existing target) or ``overwrite``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text
from ..session import jvm_class, scratch_dir

FAIL = "errorifexists"


def write_key_value(df: DataFrame, path: str, keys: int = 1, mode: str = FAIL) -> None:
    """Text lines: the first ``keys`` columns joined by blanks, a tab, the others by blanks."""
    def joined(names: list[str]) -> Column:
        return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])

    key, value = joined(df.columns[:keys]), joined(df.columns[keys:])
    df.select(F.concat_ws("\t", key, value).alias("value")).write.mode(mode).text(path)


def write_sequence_lines(lines: DataFrame, path: str) -> None:
    """Lines of ``value`` as sequence files of (offset, line).

    The only file format without a DataFrame writer: the JVM copies a text of the lines, without a
    row in Python.
    """
    spark = lines.sparkSession
    copy = scratch_dir(spark, "text-lines")
    lines.select("value").write.text(copy)
    jsc = spark.sparkContext._jsc
    offset, line, source, target = (jvm_class(spark, f"org.apache.hadoop.{name}") for name in (
        "io.LongWritable", "io.Text", "mapreduce.lib.input.TextInputFormat", "mapreduce.lib.output.SequenceFileOutputFormat",
    ))
    pairs = jsc.newAPIHadoopFile(copy, source, offset, line, jsc.hadoopConfiguration())
    pairs.saveAsNewAPIHadoopFile(path, offset, line, target)


def write_pairs(pairs: DataFrame, path: str, mode: str = FAIL) -> None:
    """Lines of two tab-separated parts, as ``read_pairs`` takes them."""
    pairs.select(F.concat_ws("\t", "p1", "p2").alias("value")).write.mode(mode).text(path)


def write_routed(processed: DataFrame, path: str, mode: str = FAIL) -> None:
    """Successful, failed and retried rows in folders of their own, ``status=…``."""
    processed.write.mode(mode).partitionBy("status").parquet(path)


def materialise(df: DataFrame, path: str, mode: str = FAIL) -> DataFrame:
    """Write an intermediate result as parquet and read it back from there."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_ordered_lines(
    lines: DataFrame, path: str, key: str, line: str, order: list, mode: str = FAIL
) -> None:
    """One folder per ``key``, lines in ``order`` over its part files.

    Rows are partitioned by range of (key, order), so a key with very many lines gets
    several part files, whose names sort in line order.
    """
    (
        lines.repartitionByRange(key, *order)
        .sortWithinPartitions(key, *order)
        .select(key, F.col(line).alias("value"))
        .write.mode(mode)
        .partitionBy(key)
        .text(path)
    )


def write_decade_report(lines: DataFrame, path: str, mode: str = FAIL) -> None:
    order = ["section", F.desc("npmi"), "w1", "w2"]
    write_ordered_lines(lines, path, "decade", "line", order, mode)


def write_summaries(summary: DataFrame, path: str, mode: str = FAIL) -> None:
    write_ordered_lines(summary, path, "job_id", "line", ["seq"], mode)


def write_gallery(html: DataFrame, path: str, mode: str = FAIL) -> None:
    write_ordered_lines(html, path, "job_id", "html", ["section", "seq"], mode)


def write_worker_report(report: DataFrame, path: str, mode: str = FAIL) -> None:
    write_ordered_lines(report, path, "worker", "line", ["section", "idx"], mode)


def format_pair_literals(pairs: DataFrame) -> DataFrame:
    return pairs.select(text.pair_literal(F.col("p1"), F.col("p2")).alias("value"))


def write_pair_literals(pairs: DataFrame, path: str, mode: str = FAIL) -> None:
    format_pair_literals(pairs).write.mode(mode).text(path)


def write_thumbnails(thumbs: DataFrame, path: str, mode: str = FAIL) -> None:
    """Pixels of the successful thumbnails, with the format each is to be encoded in."""
    (
        thumbs.where(F.col("status") == "ok")
        .select("origin", "format", "height", "width", "nChannels", "mode", "data")
        .write.mode(mode)
        .parquet(path)
    )


# Times are sent in microseconds; by default JSON would cut them to milliseconds.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def send_messages(messages: DataFrame, path: str, mode: str = "append") -> None:
    messages.write.mode(mode).options(**TIMES).json(path)


def send_message_stream(messages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Stream messages to JSON files until all available input is consumed."""
    return (
        messages.writeStream.format("json").options(**TIMES)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
