"""Inputs of the operators, made by Spark from the given tables.

The tables hold prose, orders, events and pages, not bigram tables, parsed n-grams or queue
messages. The functions here give them those shapes. They use every row and whole texts.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text
from ..operators import tracking
from ..operators.bigrams import text_bigrams
from ..session import input_bytes, widen

WINDOW = 8

# Bytes of documents whose bigrams one task counts before they are shuffled. Hardly any bigram comes
# twice in a task, so the table it counts in grows with its share; a larger one would spill.
COUNTED_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widen(table(spark, sf_dir, "documents"), "doc_id")


def _year() -> Column:
    return (1900 + F.col("doc_id") % 120).cast("string")


def bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring words of ``documents``; the year follows from the document number."""
    parts = -(-input_bytes(spark, f"{sf_dir}/documents.parquet") // COUNTED_BYTES)
    docs = table(spark, sf_dir, "documents").select(_year().alias("year"), "doc_id", "text")
    docs = docs.repartition(max(parts, spark.sparkContext.defaultParallelism), "doc_id", "text").drop("doc_id")
    return text_bigrams(docs, "text").withColumn("match_count", F.lit(1.0))


def bigram_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bigrams as text lines, broken in one of several ways by length of a word."""
    kind = F.length("w1") % 7
    count = F.length("w2").cast("string")
    line = (
        F.when(kind == 0, F.concat_ws(" ", "w1", "w2", "year", count, F.lit("1")))
        .when(kind == 1, F.concat_ws(" ", "w1", "w2", F.lit("98"), count, F.lit("1"), F.lit("1")))
        .when(kind == 2, F.concat_ws(" ", "w1", "w2", "year", F.lit("abc"), F.lit("1"), F.lit("1")))
        .when(kind == 3, F.concat_ws("\t ", F.lit(""), "w1", "w2", "year", count, F.lit("1"), F.lit("1"), F.lit("")))
        .when(kind == 4, F.concat_ws(" ", "w1", "w2", "year", F.lit("0"), F.lit("1"), F.lit("1")))
        .when(kind == 5, F.concat_ws(" ", "w1", "w2", "year", count, F.lit("1"), F.lit("1"), F.lit("1")))
        .otherwise(F.concat_ws(" ", "w1", "w2", "year", count, F.lit("1"), F.lit("1")))
    )
    return bigrams(spark, sf_dir).select(line.alias("value"))


def biarc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` in runs of WINDOW, with part of speech and head by position and
    length of the word. Some heads form cycles or point behind the last word."""
    runs = (
        documents(spark, sf_dir)
        .select(text.tokens(F.col("text")).alias("t"), (F.col("doc_id") % 9 + 1).alias("c"))
        .where(F.size("t") > 0)
        # cut before it is exploded: a row must not carry the whole text
        .select("c", F.explode(F.transform(
            F.sequence(F.lit(1), F.size("t"), F.lit(WINDOW)), lambda start: F.slice("t", start, WINDOW)
        )).alias("t"))
    )

    def token(k: int) -> Column:
        """The k-th token, NULL if there is none."""
        w = F.get("t", F.lit(k - 1))
        size = F.length(w)
        pos = F.when(size % 3 == 0, "NN").when(size % 3 == 1, "NNS").otherwise("JJ")
        head = F.when(size % 5 == 1, "2").when(size % 5 == 2, str(k + 1)).otherwise(str(k - 1))
        if k == 1:
            head = F.lit("2")
        elif k == 2:
            pos, head = F.lit("VB"), F.lit("0")
        return F.concat(w, F.lit("/"), pos, F.lit("/dep/"), head)

    # a column for each place: compiled, where a function on arrays is interpreted
    ngram = F.concat_ws(" ", *[token(k) for k in range(1, WINDOW + 1)])
    return runs.select(
        F.concat_ws("\t", F.get("t", F.lit(0)), ngram, F.col("c").cast("string"), F.lit("1990,1")).alias("value")
    )


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as triples: the path names flag and part type, the slots nation and brand."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat_ws(" ", F.lit("X"), "l_returnflag", "p_type", F.lit("Y")).alias("path"),
            F.col("n_name").alias("slot_x"),
            F.col("p_brand").alias("slot_y"),
            F.col("l_quantity").cast("bigint").alias("c"),
        )
    )


def path_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each part type the paths of two return flags, in four combinations."""
    flags = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ("AN", "AR", "NR", "RA")]
    )
    types = table(spark, sf_dir, "part").select("p_type").distinct()

    def path(flag: str):
        return F.concat_ws(" ", F.lit("X"), flag, "p_type", F.lit("Y"))

    return types.select("p_type", F.inline(flags)).select(path("a").alias("p1"), path("b").alias("p2"))


def mirrored_pairs(features: DataFrame) -> DataFrame:
    """Each path with the path that has X and Y exchanged."""
    swap = F.transform(
        F.split("path", " "),
        lambda w: F.when(w == "X", "Y").when(w == "Y", "X").otherwise(w),
    )
    paths = features.select("path").distinct()
    return paths.select(F.col("path").alias("p1"), F.array_join(swap, " ").alias("p2"))


# ---- work tracking ---------------------------------------------------------------------

def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten jobs, submitted in order of their number; every event is a copy of an item."""
    number = F.col("user_id") % 10
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("j"), number.cast("string")).alias("job_id"),
        number.alias("submit_seq"),
        F.col("props").alias("item"),
    )


def _result_item() -> Column:
    """Sign-ups answer an item that no job has."""
    user = F.concat_ws("#", "props", F.col("user_id").cast("string"))
    return F.when(F.col("event_type") == "signup", user).otherwise(F.col("props"))


def _thumb() -> Column:
    return F.concat(F.lit("t"), F.col("event_id").cast("string"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.when(error, tracking.ERROR).otherwise(tracking.OK).alias("type"),
        _result_item().alias("item"),
        F.when(~error, _thumb()).alias("thumb"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as queue messages, sent to one of seven managers."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("msg_id"),
        F.col("event_id").alias("seq"),
        "ts",
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("from_id"),
        F.concat(F.lit("manager"), (F.col("user_id") % 7).cast("string")).alias("to_id"),
        F.when(kind == "signup", tracking.START_JOB)
        .when(kind == "click", tracking.FINISHED_WORK)
        .when(kind == "error", tracking.ERROR_WORK)
        .when((kind == "purchase") & (F.col("value") > 50), tracking.TERMINATE)
        .when(kind == "view", tracking.INIT_WORK)
        .alias("type"),
        F.concat(F.lit("j"), (F.col("user_id") % 10).cast("string")).alias("job_id"),
        F.when(kind == "click", text.summary_line(F.col("props"), _thumb()))
        .otherwise(F.col("props"))
        .alias("body"),
    )


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages, and the failed and finished ones a second time."""
    sent = messages(spark, sf_dir)
    again = sent.where(F.col("type").isin(tracking.ERROR_WORK, tracking.FINISHED_WORK))
    return sent.unionByName(again.withColumn("seq", F.col("seq") + 10**12))


def job_messages(spark: SparkSession, sf_dir: str, jobs: int | None = 10) -> tuple[DataFrame, DataFrame]:
    """Work orders for the items of ``jobs`` jobs (None: up to 20 per user), and the replies."""
    many = F.concat_ws("-", "user_id", F.col("event_id") % 20)
    number = many if jobs is None else F.col("user_id") % jobs
    base = table(spark, sf_dir, "events").select(
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("msg_id"),
        F.col("event_id").alias("seq"),
        "ts",
        F.concat(F.lit("j"), number.cast("string")).alias("job_id"),
        "event_id", "event_type", "props", "user_id",
    )
    columns = ["msg_id", "seq", "ts", "from_id", "to_id", "type", "job_id", "body"]
    orders = base.withColumns(
        {
            "from_id": F.lit("remote_manager"), "to_id": F.lit("*"),
            "type": F.lit(tracking.INIT_WORK), "body": F.col("props"),
        }
    )
    error = F.col("event_type") == "error"
    replies = base.withColumns(
        {
            "msg_id": F.concat("msg_id", F.lit("r")),
            "seq": F.col("seq") + 10**12,
            "from_id": F.concat(F.lit("w"), F.col("user_id").cast("string")),
            "to_id": F.lit("remote_manager"),
            "type": F.when(error, tracking.ERROR_WORK).otherwise(tracking.FINISHED_WORK),
            "body": F.when(error, _result_item()).otherwise(
                text.summary_line(_result_item(), _thumb())
            ),
        }
    )
    return orders.select(*columns), replies.select(*columns)


def job_starts(orders: DataFrame) -> DataFrame:
    """A start message per job, whose body is the number of the job's orders, and one of a job
    without orders for every 50th order."""
    sized = orders.groupBy("job_id").agg(F.min("ts").alias("ts"), F.count(F.lit(1)).cast("string").alias("body"))
    empty = orders.where(F.col("seq") % 50 == 0).select(
        F.concat(F.lit("empty"), F.col("seq").cast("string")).alias("job_id"), "ts", F.lit("0").alias("body")
    )
    return sized.unionByName(empty).select(
        F.concat("job_id", F.lit("-start")).alias("msg_id"), F.lit(-1).cast("bigint").alias("seq"), "ts",
        F.lit("client").alias("from_id"), F.lit(tracking.MANAGER).alias("to_id"),
        F.lit(tracking.START_JOB).alias("type"), "job_id", "body",
    )


def unaddressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``jobs`` and ``results`` as messages: an order's seq is its job's submit_seq, and replies name
    no job."""
    columns = ["msg_id", "seq", "ts", "from_id", "to_id", "type", "job_id", "body"]
    events = table(spark, sf_dir, "events")
    number = F.col("user_id") % 10
    orders = events.withColumns({
        "msg_id": F.concat(F.lit("o"), F.col("event_id").cast("string")), "seq": number,
        "from_id": F.lit(tracking.MANAGER), "to_id": F.lit("*"), "type": F.lit(tracking.INIT_WORK),
        "job_id": F.concat(F.lit("j"), number.cast("string")), "body": F.col("props"),
    })
    error = F.col("event_type") == "error"
    replies = events.withColumns({
        "msg_id": F.concat(F.lit("r"), F.col("event_id").cast("string")), "seq": F.col("event_id"),
        "from_id": F.lit("w"), "to_id": F.lit(tracking.MANAGER),
        "type": F.when(error, tracking.ERROR_WORK).otherwise(tracking.FINISHED_WORK),
        "job_id": F.lit(None).cast("string"),
        "body": F.when(error, _result_item()).otherwise(text.summary_line(_result_item(), _thumb())),
    })
    return orders.select(*columns).unionByName(replies.select(*columns))


STOP_FROM = "2024-01-16"


def stop_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts (sign-ups) of one job each, stops (costly purchases from STOP_FROM on), and the end of
    each job an hour after its start; every tenth job of one manager never ends."""
    all_ = messages(spark, sf_dir)
    starts = all_.where(F.col("type") == tracking.START_JOB).withColumn("job_id", F.col("msg_id"))
    stops = all_.where((F.col("type") == tracking.TERMINATE) & (F.col("ts") >= F.lit(STOP_FROM).cast("timestamp")))
    stuck = (F.col("to_id") == "manager3") & (F.col("seq") % 10 == 0)
    ends = starts.where(~stuck).withColumns({
        "msg_id": F.concat("msg_id", F.lit("-ended")), "ts": F.col("ts") + F.expr("INTERVAL 1 HOUR"),
        "type": F.lit(tracking.JOB_ENDED),
    })
    return starts.unionByName(stops).unionByName(ends)


def handled_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When the finished and failed messages were handled: up to six hours after they were sent."""
    done = messages(spark, sf_dir).where(F.col("type").isin(tracking.FINISHED_WORK, tracking.ERROR_WORK))
    return done.withColumn("ts", F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("seq") % 7 * 3_600_000_000))


def page_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order per page, of its host's job."""
    host = F.substring_index(F.substring_index("url", "/", 3), "/", -1)
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("msg_id"),
        F.crc32(host.cast("binary")).alias("seq"), F.timestamp_seconds(F.lit(0)).alias("ts"),
        F.lit(tracking.MANAGER).alias("from_id"), F.lit("*").alias("to_id"),
        F.lit(tracking.INIT_WORK).alias("type"), host.alias("job_id"), F.col("url").alias("body"),
    )


def work_of(events: DataFrame) -> DataFrame:
    """Events as work done; users are the workers."""
    error = F.col("event_type") == "error"
    return events.select(
        F.concat(F.lit("w"), F.col("user_id").cast("string")).alias("worker"),
        F.col("event_id").alias("seq"),
        F.col("props").alias("url"),
        F.col("ts").alias("start_ts"),
        F.col("value").alias("ms"),
        F.when(error, tracking.ERROR).otherwise(tracking.OK).alias("status"),
        F.when(error, F.lit("bad input")).alias("error"),
    )


def page_jobs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One job per host with its page addresses, and results: an address with a query
    failed, one with a fragment has no result yet."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host = F.substring_index(F.substring_index("url", "/", 3), "/", -1)
    jobs_ = pages.select(
        host.alias("job_id"), F.crc32(host.cast("binary")).alias("submit_seq"), F.col("url").alias("item")
    )
    failed = F.col("url").contains("?")
    results_ = pages.where(~F.col("url").contains("#")).select(
        F.col("page_id").alias("seq"),
        F.when(failed, tracking.ERROR).otherwise(tracking.OK).alias("type"),
        F.col("url").alias("item"),
        F.when(~failed, F.concat(F.lit("t"), F.col("page_id").cast("string"))).alias("thumb"),
    )
    return jobs_, results_


def page_lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Start messages and the item lists they name: a list per host with its addresses. Hosts
    with an even number of letters start two jobs, and one job names a list that is not there."""
    pages = table(spark, sf_dir, "pages").select(
        F.substring_index(F.substring_index("url", "/", 3), "/", -1).alias("list"), F.col("url").alias("item")
    )
    hosts = pages.select("list").distinct()
    copies = F.when(F.length("list") % 2 == 0, 2).otherwise(1)
    starts = hosts.select("list", F.explode(F.sequence(F.lit(1), copies)).alias("k"))
    nowhere = spark.range(1).select(F.lit("nowhere").alias("list"), F.lit(1).alias("k"))
    job = F.concat_ws("-", F.lit("job"), "list", F.col("k").cast("string"))
    messages_ = starts.unionByName(nowhere).select(
        F.concat(F.lit("m-"), job).alias("msg_id"), F.crc32(job.cast("binary")).alias("seq"),
        F.timestamp_seconds(F.lit(0)).alias("ts"), F.lit("client").alias("from_id"),
        F.lit(tracking.MANAGER).alias("to_id"), F.lit(tracking.START_JOB).alias("type"),
        job.alias("job_id"), F.col("list").alias("body"),
    )
    return messages_, pages


TILE = 64


def page_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of each page as grey images of TILE x TILE pixels, the last one filled up with
    zeros. Tiles of addresses with a query are no images. ``seq`` numbers all tiles."""
    size = TILE * TILE
    raw = F.encode("html", "UTF-8")
    pages = widen(table(spark, sf_dir, "pages"), "page_id")
    last = F.greatest(F.ceil(F.octet_length("html") / size).cast("int"), F.lit(1)) - 1
    tiles = F.transform(
        F.sequence(F.lit(0), last),
        lambda k: F.struct(k.alias("k"), F.rpad(F.substr(raw, k * size + 1, F.lit(size)), size, F.lit(b"\0")).alias("data")),
    )
    rows = pages.select("page_id", "url", F.explode(tiles).alias("t"))
    image = ~F.col("url").contains("?")
    side = F.when(image, TILE).otherwise(-1)
    return rows.select(
        F.concat_ws("#", "url", F.col("t.k").cast("string")).alias("origin"),
        (F.col("page_id") * 1_000_000 + F.col("t.k")).alias("seq"),
        F.substring_index(F.substring_index("url", "/", 3), "/", -1).alias("job_id"),
        side.alias("height"), side.alias("width"), F.lit(1).alias("nChannels"), F.lit(0).alias("mode"),
        F.col("t.data").alias("data"),
    )


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of each page as a grey image, 64 pixels wide and as high as needed."""
    raw = F.encode("html", "UTF-8")
    height = F.ceil(F.octet_length("html") / 64).cast("int")
    return widen(table(spark, sf_dir, "pages"), "page_id").select(
        F.col("url").alias("origin"),
        height.alias("height"),
        F.lit(64).alias("width"),
        F.lit(1).alias("nChannels"),
        F.lit(0).alias("mode"),
        F.rpad(raw, height * 64, F.lit(b"\0")).alias("data"),
    )


BITMAP_WIDTH = 30


def write_page_bitmaps(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The bytes of each page as an uncompressed bitmap file of three colours, BITMAP_WIDTH pixels wide,
    named by page_id. Pages whose address has a query are written as they are, which is no image."""
    def bitmap(raw: bytes) -> bytes:
        row = 3 * BITMAP_WIDTH
        height = max(1, -(-len(raw) // row))
        lines = [raw[row * y:row * (y + 1)].ljust(row, b"\0") + b"\0" * (-row % 4) for y in range(height)]
        data = b"".join(reversed(lines))  # the last line comes first
        head = struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54 + len(data), 0, 0, 54, 40, BITMAP_WIDTH, height, 1, 24, 0, len(data), 0, 0, 0, 0)
        return head + data

    def write(rows: Iterator) -> None:
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder)
        for row in rows:
            raw = (row.html or "").encode()
            with store.open_output_stream(f"{folder}/p{row.page_id}.bmp") as out:
                out.write(raw if "?" in row.url else bitmap(raw))

    widen(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id").foreachPartition(write)
