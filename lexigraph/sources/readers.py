"""Readers. Every line reader accepts text or sequence files through ``read_lines``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text
from ..operators.ordering import number_rows
from ..session import jvm_class, scratch_dir

MESSAGE_SCHEMA = (
    "msg_id string, seq bigint, ts timestamp, from_id string, to_id string, "
    "type string, job_id string, body string"
)


def read_text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def read_sequence_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Values of sequence files of any key, each a line of text.

    The only file format without a DataFrame reader. The JVM writes the values as text in the
    scratch folder, which is then scanned like any text; no row passes through Python. A value
    that holds line ends is as many lines.
    """
    paths = [path] if isinstance(path, str) else path
    context = spark.sparkContext
    text_class = jvm_class(spark, "org.apache.hadoop.io.Text")
    pairs = context._jsc.newAPIHadoopFile(
        ",".join(paths),
        jvm_class(spark, "org.apache.hadoop.mapreduce.lib.input.SequenceFileAsTextInputFormat"),
        text_class, text_class, context._jsc.hadoopConfiguration(),
    )
    copy = scratch_dir(spark, "sequence-text")
    pairs.values().saveAsTextFile(copy)
    return spark.read.option("lineSep", "\n").text(copy)


def read_ordered_lines(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, line_no, line) of what ``sinks.writers.write_ordered_lines`` has written.

    Part files are in order of their number, blocks of a file in order of their offset, and lines of
    a block as they are read, so lines get the numbers, from 1, that they had when written. Where no
    line was written there is no folder of a key, and no row.
    """
    if not _has_folder(spark, path, f"{key}="):
        return spark.createDataFrame([], f"`{key}` string, line_no bigint, line string")
    lines = spark.read.schema(f"value string, `{key}` string").option("lineSep", "\n").text(path)
    file = F.col("_metadata.file_path")
    placed = lines.select(
        key, F.col("value").alias("line"), F.regexp_extract(file, r"part-(\d+)[^/]*$", 1).cast("int").alias("_file_no"),
        file.alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )
    numbered = number_rows(placed, ["_file_no", "_file", "_start", "_row"], "line_no", [key])
    return numbered.select(key, "line_no", "line")


def _has_folder(spark: SparkSession, path: str, prefix: str) -> bool:
    """Whether a folder in ``path`` begins with ``prefix``; the listing ends at the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatusIterator(folder)
    while found.hasNext():
        entry = found.next()
        if entry.isDirectory() and entry.getPath().getName().startswith(prefix):
            return True
    return False


def read_lines(spark: SparkSession, path: str | list[str], fmt: str = "text") -> DataFrame:
    if fmt == "text":
        return read_text_lines(spark, path)
    if fmt == "sequence":
        return read_sequence_lines(spark, path)
    if fmt == "parquet":
        return spark.read.schema("value string").parquet(*([path] if isinstance(path, str) else path))
    raise ValueError(f"unknown line format {fmt!r}")


def shard_paths(prefix: str, shards: int) -> list[str]:
    """``prefix.00-of-12`` … ``prefix.11-of-12`` for twelve shards."""
    # Fixed value: the form of a shard's name.
    return [f"{prefix}.{i:02d}-of-{shards}" for i in range(shards)]


def systematic_sample(df: DataFrame, every: int, on: Iterable[str] = ("value",)) -> DataFrame:
    """About one row in ``every``, chosen by content so that partitioning does not matter."""
    if every <= 1:
        return df
    digest = F.md5(F.concat_ws("\t", *on))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.where(F.pmod(number, F.lit(every)) == 0)


# ---- bigrams ---------------------------------------------------------------------------

def check_bigrams(lines: DataFrame) -> DataFrame:
    """Lines ``w1 w2 year count pages volumes`` as ``(value, bigram)``.

    ``bigram`` is NULL for a line that has another number of fields, a year of fewer than four
    characters, or no positive count below 9e18.
    """
    def f(i: int) -> Column:
        return F.get("_f", F.lit(i))

    count = f(3).try_cast("double")
    ok = (
        (F.size("_f") == 6)
        & (F.length(f(2)) >= 4)
        & (count > 0)
        & (count <= 9e18)  # false for NaN, which sorts above every number
    )
    bigram = F.struct(
        f(0).alias("w1"),
        f(1).alias("w2"),
        f(2).alias("year"),
        count.alias("match_count"),
        f(4).try_cast("bigint").alias("pages"),
        f(5).try_cast("bigint").alias("volumes"),
    )
    split = lines.select("value", text.fields(F.col("value")).alias("_f"))
    return split.select("value", F.when(ok, bigram).alias("bigram"))


def parse_bigrams(lines: DataFrame) -> DataFrame:
    """The well-formed bigram lines as columns; other lines are dropped."""
    # Inlined from an array of one and not filtered: a filter would be pushed below the
    # split, and split every line again.
    some = F.when(F.col("bigram").isNotNull(), F.array("bigram"))
    return check_bigrams(lines).select(F.inline(some))


def rejected_bigrams(lines: DataFrame) -> DataFrame:
    """The lines that ``parse_bigrams`` drops."""
    some = F.when(F.col("bigram").isNull(), F.array("value"))
    return check_bigrams(lines).select(F.explode(some).alias("value"))


def read_bigrams(spark: SparkSession, path: str | list[str], fmt: str = "text") -> DataFrame:
    return parse_bigrams(read_lines(spark, path, fmt))


# ---- dependency n-grams ------------------------------------------------------------------

def check_biarcs(lines: DataFrame) -> DataFrame:
    """Lines ``head <tab> n-gram <tab> count …`` as ``(value, ok)``; ``ok`` is false for a line
    with fewer than three filled fields or a count that is no whole number."""
    f = F.filter(F.split("value", "\t"), lambda x: x != "")
    count = text.whole_number(F.get(f, F.lit(2)))
    return lines.select("value", F.coalesce(count.isNotNull(), F.lit(False)).alias("ok"))


def rejected_biarcs(lines: DataFrame) -> DataFrame:
    """The lines of which ``extract_paths`` cannot make a path whatever their n-gram is."""
    return check_biarcs(lines).where(~F.col("ok")).select("value")


def read_biarcs(
    spark: SparkSession, path: str | list[str], fmt: str = "text", sample_every: int = 1
) -> DataFrame:
    """Lines of syntactic n-grams, for ``extract_paths``."""
    return systematic_sample(read_lines(spark, path, fmt), sample_every)


# ---- pairs, item lists, stop words -------------------------------------------------------

def parse_pairs(lines: DataFrame) -> DataFrame:
    """Lines with exactly two tab-separated parts; empty parts at the end do not count."""
    trimmed = F.rtrim(text.java_trim(F.col("value")), F.lit("\t"))
    parts = F.split(trimmed, "\t")
    return (
        lines.select(parts.alias("_p"))
        .where(F.size("_p") == 2)
        .select(F.get("_p", F.lit(0)).alias("p1"), F.get("_p", F.lit(1)).alias("p2"))
    )


def rejected_pairs(lines: DataFrame) -> DataFrame:
    """The lines that ``parse_pairs`` drops."""
    trimmed = F.rtrim(text.java_trim(F.col("value")), F.lit("\t"))
    return lines.where(F.coalesce(F.size(F.split(trimmed, "\t")) != 2, F.lit(True))).select("value")


def read_pairs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_pairs(read_text_lines(spark, path))


def read_item_lists(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One job per file, one item per line: ``(job_id, submit_seq, item)``.

    job_id is the file's name, submit_seq the time of its last change in microseconds. An
    empty file is a job with one row without item.
    """
    items = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("job_id"),
        F.unix_micros("_metadata.file_modification_time").alias("submit_seq"),
        F.col("value").alias("item"),
    )
    empty = spark.createDataFrame(
        [(name, changed, None) for name, changed in _empty_files(spark, path)], items.schema
    )
    return items.unionByName(empty)


def _empty_files(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int]]:
    """Names and times of empty files, which scans skip; from the listing that a scan needs, too."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = []
    for pattern in [path] if isinstance(path, str) else path:
        files = hadoop.Path(pattern).getFileSystem(spark._jsc.hadoopConfiguration())
        for top in files.globStatus(hadoop.Path(pattern)) or []:
            for f in files.listStatus(top.getPath()):
                name = f.getPath().getName()
                if f.isFile() and f.getLen() == 0 and name[0] not in "_.":
                    found.append((name, 1000 * f.getModificationTime()))
    return found


def read_stop_words(spark: SparkSession, path: str, lang: str) -> DataFrame:
    """Stop words of a language from tab-separated ``lang, word`` lines."""
    words = parse_pairs(read_text_lines(spark, path))
    return words.where(F.col("p1") == lang).select(F.col("p2").alias("word"))


# ---- messages and images -----------------------------------------------------------------

def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).json(path)


def rejected_messages(messages: DataFrame) -> DataFrame:
    """Messages without an id, a type or a recipient, as lines that are no message have none."""
    return messages.where(F.col("msg_id").isNull() | F.col("type").isNull() | F.col("to_id").isNull())


def read_message_stream(
    spark: SparkSession,
    path: str,
    files_per_trigger: int | None = None,
    fmt: str = "json",
    bytes_per_trigger: int = 256 << 20,
) -> DataFrame:
    """Messages arriving as files. A micro-batch takes files up to ``bytes_per_trigger``, or
    ``files_per_trigger`` of them if that is given."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_trigger is None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    else:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images; a file that cannot be decoded keeps its origin, with height -1."""
    return spark.read.format("image").option("dropInvalid", False).load(path).select("image.*")
