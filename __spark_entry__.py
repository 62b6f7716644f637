"""Registered queries over the given tables, and the SQL each must agree with."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexigraph.functions import text
from lexigraph.functions.stop_words import ENGLISH, HEBREW
from lexigraph.operators import bigrams as bg
from lexigraph.operators import imaging, paths, similarity, tracking
from lexigraph.plans import collocations as colloc
from lexigraph.plans import derived as d
from lexigraph.plans import similarity as sim
from lexigraph.plans.tracking import track_images
from lexigraph.session import scratch_dir
from lexigraph.sinks import writers
from lexigraph.sources import readers
from lexigraph.streaming import manager
from lexigraph.streaming import tracking as stream



def _if_there(name: str) -> ModuleType | None:
    """A module, unless it or the subpackage ``llm`` has been left out of an installation."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as e:
        if e.name in (name, "lexigraph.llm"):
            return None
        raise


LLM = _if_there("lexigraph.llm.queries")
PIPELINE = _if_there("corpus_pipeline")

SMOKE_DIR = "/root/testdata/sf0.001"

MIN_NPMI = 0.75
REL_MIN_NPMI = 0.0005
DP_MIN_COUNT = 2
MIN_FEATURES = 3

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- collocations ----------------------------------------------------------------------

def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return bg.word_count(d.documents(spark, sf), "text")


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return bg.bigrams_by_decade(d.bigrams(spark, sf))


def bigrams_by_decade(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf)


def stopword_filtered_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    return bg.bigrams_by_decade(d.bigrams(spark, sf), ENGLISH)


def left_marginal(spark: SparkSession, sf: str) -> DataFrame:
    return bg.left_marginals(_counts(spark, sf))


def right_marginal(spark: SparkSession, sf: str) -> DataFrame:
    return bg.right_marginals(_counts(spark, sf))


def decade_totals(spark: SparkSession, sf: str) -> DataFrame:
    return bg.decade_totals(_counts(spark, sf))


def npmi_by_decade(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "counts")
    scored = bg.npmi_by_decade(bg.count_table(d.bigrams(spark, sf), path), spent=path)
    return _rounded(scored, 6, "pmi", "npmi")


def collocations(spark: SparkSession, sf: str) -> DataFrame:
    found = colloc.collocations(d.bigrams(spark, sf), MIN_NPMI, REL_MIN_NPMI)
    return _rounded(_rounded(found, 6, "pmi", "npmi"), 4, "decade_npmi")


def decade_report_lines(spark: SparkSession, sf: str) -> DataFrame:
    found = colloc.collocations(
        d.bigrams(spark, sf), MIN_NPMI, REL_MIN_NPMI, stop_words="eng", ordered=False,
        table=scratch_dir(spark, "pmi"),
    )
    lines = colloc.order_report(colloc.decade_report(found, digits=4))
    return lines.select("decade", "section", "line")


def bigram_validation(spark: SparkSession, sf: str) -> DataFrame:
    checked = readers.check_bigrams(d.bigram_lines(spark, sf))
    year = F.coalesce("bigram.year", F.lit("rejected"))
    return checked.groupBy(year.alias("year")).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("bigram.match_count"), F.lit(0)).cast("bigint").alias("total"),
    )


# ---- path similarity -------------------------------------------------------------------

def extract_paths(spark: SparkSession, sf: str) -> DataFrame:
    return paths.extract_paths(d.biarc_lines(spark, sf))


def triples_to_slots(spark: SparkSession, sf: str) -> DataFrame:
    return paths.to_slots(d.triples(spark, sf))


def slot_marginals(spark: SparkSession, sf: str) -> DataFrame:
    counts = similarity.slot_word_counts(d.triples(spark, sf))
    none = F.lit(None).cast("string")
    parts = [
        counts.select(F.lit("psw").alias("kind"), "path", "slot", "word", "c"),
        similarity.path_totals(counts).select(
            F.lit("ps").alias("kind"), "path", "slot", none.alias("word"), F.col("ps").alias("c")
        ),
        similarity.word_totals(counts).select(
            F.lit("sw").alias("kind"), none.alias("path"), "slot", "word", F.col("sw").alias("c")
        ),
        similarity.slot_totals(counts).select(
            F.lit("s").alias("kind"), none.alias("path"), "slot", none.alias("word"), F.col("s").alias("c")
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.features(d.triples(spark, sf), DP_MIN_COUNT)


def path_features(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_features(spark, sf), 6, "mi", "tfidf", "dice")


def pair_features(spark: SparkSession, sf: str) -> DataFrame:
    pairs = similarity.pair_features(_features(spark, sf), d.path_pairs(spark, sf))
    return _rounded(pairs, 6, "mi", "tfidf", "dice")


def _similarity_columns(df: DataFrame) -> DataFrame:
    # NaN (slot values of unequal sign) is compared as NULL
    sim = F.when(~F.isnan("sim"), F.round("sim", 4)).alias("sim")
    return df.select(
        "p1", "p2", sim, F.round("cosine", 6).alias("cosine"), F.round("cover", 6).alias("cover")
    )


def path_similarity(spark: SparkSession, sf: str) -> DataFrame:
    feats = sim.feature_table(d.triples(spark, sf), DP_MIN_COUNT)
    return _similarity_columns(
        similarity.path_similarity(feats, d.path_pairs(spark, sf), MIN_FEATURES)
    )


def mirrored_path_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job from n-gram lines. There are as many pairs as paths, so they are not
    broadcast."""
    feats = sim.feature_table(paths.extract_paths(d.biarc_lines(spark, sf)), DP_MIN_COUNT, sliced=True)
    found = similarity.path_similarity(feats, d.mirrored_pairs(feats.whole()), 0, broadcast_rows=0)
    return _similarity_columns(found)


def systematic_sample(spark: SparkSession, sf: str) -> DataFrame:
    docs = d.table(spark, sf, "documents").select("doc_id", "text")
    return readers.systematic_sample(docs, 50, ["text"]).select("doc_id")


# ---- work tracking ---------------------------------------------------------------------

def match_results(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.match_results(d.jobs(spark, sf), d.results(spark, sf))


def unmatched_results(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.unmatched_results(match_results(spark, sf)).select("seq", "type", "item", "thumb")


def job_progress(spark: SparkSession, sf: str) -> DataFrame:
    jobs = d.jobs(spark, sf)
    return tracking.job_progress(jobs, tracking.match_results(jobs, d.results(spark, sf)))


def running_items(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.running_items(job_progress(spark, sf))


def pending_messages(spark: SparkSession, sf: str) -> DataFrame:
    sent = d.messages(spark, sf)
    handled = sent.where(F.col("type").isin(tracking.FINISHED_WORK, tracking.ERROR_WORK))
    return tracking.pending_messages(sent, handled).groupBy("to_id").agg(F.count(F.lit(1)).alias("n"))


def dispatch_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.with_route(d.messages(spark, sf)).select("msg_id", "to_id", "route")


def addressed_messages(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.addressed_to(d.messages(spark, sf), "manager3").select("msg_id", "body")


def accept_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.accept_jobs(d.messages(spark, sf)).select("msg_id", "to_id", "accepted")


def parse_results(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.parse_results(d.messages(spark, sf)).select("seq", "type", "item", "thumb")


def dedupe_messages(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.dedupe_messages(d.redelivered(spark, sf)).select("msg_id", "seq", "type", "body")


def worker_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _stats_columns(tracking.worker_stats(d.work_of(d.table(spark, sf, "events"))))


def _stats_columns(stats: DataFrame) -> DataFrame:
    micros = {c: F.unix_micros(c) for c in ("start_ts", "end_ts")}
    return _rounded(stats, 4, "avg_ms", "avg_ok_ms").withColumns(micros)


def worker_items(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.worker_items(d.work_of(d.table(spark, sf, "events")))


def worker_report_lines(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.worker_report(d.work_of(d.table(spark, sf, "events")), digits=3)


def _page_matches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Jobs and matched results; the latter are read several times and so a table."""
    jobs, results = d.page_jobs(spark, sf)
    return jobs, writers.materialise(tracking.match_results(jobs, results), scratch_dir(spark, "matched"))


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return writers.materialise(tracking.summary_lines(*_page_matches(spark, sf)), scratch_dir(spark, "summary"))


def summary_lines(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.summary_lines(*_page_matches(spark, sf)).select("job_id", "seq", "line")


def gallery_html(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.gallery_html(_summary(spark, sf), "http://thumbs/")


def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    pages = d.table(spark, sf, "pages").select("page_id", "url")
    before, after = text.split_first(F.col("url"), "/")
    return pages.select(
        "page_id",
        text.base_name(F.col("url")).alias("base"),
        text.extension(F.col("url")).alias("ext"),
        text.image_format(F.col("url")).alias("format"),
        before.alias("scheme"),
        after.alias("rest"),
    )


def pair_literals(spark: SparkSession, sf: str) -> DataFrame:
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    line = (
        F.when(F.col("p_size") % 5 == 0, name)
        .when(F.col("p_size") % 5 == 1, F.concat_ws("\t", name, kind, brand))
        .otherwise(F.concat_ws("\t", F.concat(F.lit(" "), name), kind, F.lit(" ")))
    )
    lines = d.table(spark, sf, "part").select(line.alias("value"))
    return writers.format_pair_literals(readers.parse_pairs(lines))


def thumbnails(spark: SparkSession, sf: str) -> DataFrame:
    images = d.page_images(imaging.image_session(spark), sf)
    return imaging.thumbnails(images).select(
        "origin", "format", "status", "height", "width", F.octet_length("data").alias("size")
    )


def process_items(spark: SparkSession, sf: str) -> DataFrame:
    """Second part of an address's path; an address without one is an error."""
    items = d.table(spark, sf, "pages").select("page_id", F.col("url").alias("item"))
    return tracking.process_column(items, *_second_part())


def _second_part() -> tuple[Column, Column]:
    parts = F.split(F.btrim(F.coalesce(F.parse_url("item", F.lit("PATH")), F.lit("")), F.lit("/")), "/")
    return F.get(parts, 1), F.when(F.size(parts) < 2, "no second part")


def tracked_thumbnails(spark: SparkSession, sf: str) -> DataFrame:
    """Images to replies, matching and summaries; every result with its pixels and whether it
    is in its job's summary."""
    images = d.page_tiles(imaging.image_session(spark), sf)
    jobs = images.select("job_id", F.crc32(F.col("job_id").cast("binary")).alias("submit_seq"), F.col("origin").alias("item"))
    done = track_images(jobs, images, "w1", "http://thumbs/", box=16)
    pixels = done.thumbnails.select("seq", F.md5("data").alias("pixels"), "height", "width")
    lines = done.summary.select("seq", F.col("line"))
    return (
        done.matched.join(pixels, "seq").join(lines, "seq", "left")
        .select("seq", "job_id", "type", "item", "thumb", "pixels", "height", "width", "line")
    )


def work_orders(spark: SparkSession, sf: str) -> DataFrame:
    starts, lists = d.page_lists(spark, sf)
    jobs, orders = tracking.expand_jobs(starts, lists)
    empty = jobs.where(F.col("item").isNull()).select(
        F.lit(None).cast("string").alias("msg_id"), "job_id", F.lit("empty").alias("type"), F.col("item").alias("body")
    )
    return orders.select("msg_id", "job_id", "type", "body").unionByName(empty)


def completed_jobs(spark: SparkSession, sf: str) -> DataFrame:
    progress = tracking.job_progress(*_page_matches(spark, sf))
    return tracking.completed_jobs(progress, "summaries")


def refusals(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.refusals(d.messages(spark, sf)).select("msg_id", "from_id", "to_id", "type", "body")


# ---- written and read back -------------------------------------------------------------

def _part_lines(spark: SparkSession, sf: str) -> DataFrame:
    return d.table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("value"), "p_partkey")


def _tally(lines: DataFrame) -> DataFrame:
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def text_lines_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "lines")
    _part_lines(spark, sf).select("value").write.text(path)
    return _tally(readers.read_text_lines(spark, path))


def sequence_lines_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "sequence")
    writers.write_sequence_lines(_part_lines(spark, sf), path)
    return _tally(readers.read_lines(spark, path, "sequence"))


def shard_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    paths = readers.shard_paths(scratch_dir(spark, "shards"), 3)
    for i, path in enumerate(paths):
        _part_lines(spark, sf).where(F.col("p_partkey") % 3 == i).select("value").write.text(path)
    return _tally(readers.read_biarcs(spark, paths))


def key_value_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "key-value")
    writers.write_key_value(d.table(spark, sf, "part").select("p_type", "p_brand", "p_size", "p_partkey"), path, keys=2)
    return _tally(readers.read_text_lines(spark, path))


def pair_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "pairs")
    writers.write_pairs(d.path_pairs(spark, sf), path)
    return readers.read_pairs(spark, path)


def item_list_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "items")
    d.table(spark, sf, "pages").select(F.col("url").alias("value")).write.text(path)
    items = readers.read_item_lists(spark, path).where(F.col("submit_seq") > 0)
    return items.where(F.col("item").isNotNull()).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def thumbnail_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "thumbnails")
    writers.write_thumbnails(imaging.thumbnails(d.page_tiles(imaging.image_session(spark), sf), box=16), path)
    return spark.read.parquet(path).select("origin", "height", "width", F.md5("data").alias("pixels"))


def report_lines_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """A report of collocations, summaries and galleries, written to files, and their lines with the
    numbers that the files give them."""
    path = {name: scratch_dir(spark, name) for name in ("report", "summaries", "gallery")}
    found = colloc.collocations(
        d.bigrams(spark, sf), MIN_NPMI, REL_MIN_NPMI, stop_words="eng", ordered=False, table=scratch_dir(spark, "pmi")
    )
    lines = colloc.decade_report(found, digits=4)
    # the last digits differ by the order of a sum, and must not decide the order of lines
    writers.write_decade_report(_rounded(lines, 6, "npmi"), path["report"])
    summary = _summary(spark, sf)
    writers.write_summaries(summary, path["summaries"])
    writers.write_gallery(tracking.gallery_html(summary, "http://thumbs/"), path["gallery"])
    parts = [
        readers.read_ordered_lines(spark, path[name], key).select(F.lit(name).alias("report"), F.col(key).alias("key"), "line_no", "line")
        for name, key in (("report", "decade"), ("summaries", "job_id"), ("gallery", "job_id"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def decoded_thumbnails(spark: SparkSession, sf: str) -> DataFrame:
    """Image files, broken ones among them, decoded and reduced by ratios that are not whole."""
    path = scratch_dir(spark, "bitmaps")
    d.write_page_bitmaps(spark, sf, path)
    images = readers.read_images(imaging.image_session(spark), path)
    return imaging.thumbnails(images, box=16).select(
        text.base_name(F.col("origin")).alias("file"), "status", "error", "height", "width", "nChannels",
        F.md5("data").alias("pixels"),
    )


def routed_errors(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "routed")
    writers.write_routed(process_items(spark, sf), path)
    good, bad = tracking.route_errors(spark.read.parquet(path))
    return good.select("page_id", "result").unionByName(bad.select("page_id", F.col("error").alias("result")))


def hebrew_stop_words(spark: SparkSession, sf: str) -> DataFrame:
    """The list is written as a table, read back and joined; every third first word is on it."""
    path = scratch_dir(spark, "stop-words")
    listed = spark.createDataFrame([("heb", w) for w in HEBREW] + [("eng", w) for w in ENGLISH], "p1 string, p2 string")
    writers.write_pairs(listed, path)
    words = F.array(*map(F.lit, HEBREW))
    number = F.col("p_partkey")
    hebrew = F.get(words, (number % len(HEBREW)).cast("int"))
    bigrams = d.table(spark, sf, "part").select(
        F.when(number % 3 == 0, hebrew).otherwise(F.col("p_type")).alias("w1"),
        F.col("p_name").alias("w2"), F.lit("1990").alias("year"), F.lit(1.0).alias("match_count"),
    )
    return bg.bigrams_by_decade(bigrams, readers.read_stop_words(spark, path, "heb"))


def rejected_lines(spark: SparkSession, sf: str) -> DataFrame:
    """What the readers of bigrams, n-grams, pairs and messages refuse, by kind."""
    part = d.table(spark, sf, "part")
    pairs = part.select(F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.concat_ws("\t", "p_name", "p_type")).alias("value"))
    count = F.when(F.col("p_size") % 3 == 0, "x").when(F.col("p_size") % 3 == 1, "1000000000000000001").otherwise("9223372036854775808")
    biarcs = part.select(F.concat_ws("\t", "p_name", F.lit("a/NN/s/2 go/VB/r/0 b/NN/o/2"), count).alias("value"))
    parts = [
        ("bigram", readers.rejected_bigrams(d.bigram_lines(spark, sf))),
        ("n-gram", readers.rejected_biarcs(biarcs)),
        ("pair", readers.rejected_pairs(pairs)),
        ("message", readers.rejected_messages(d.messages(spark, sf))),
    ]
    rows = [df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, df in parts]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


# ---- streams ---------------------------------------------------------------------------

def _send(messages: DataFrame, inbox: str, files: int = 4) -> None:
    """Several files in no order of time, as if from several senders."""
    writers.send_messages(messages.repartition(files, F.xxhash64("msg_id", "seq")), inbox)


def _outcomes(spark: SparkSession, parts: list[DataFrame], files_per_trigger: int) -> DataFrame:
    """Outcomes of messages that arrive part after part, repeats dropped first."""
    inbox = scratch_dir(spark, "inbox")
    for part in parts:
        _send(part, inbox)
    stream.use_rocksdb(spark)
    return stream.match_stream(stream.dedupe_stream(
        readers.read_message_stream(spark, inbox, files_per_trigger=files_per_trigger)
    ))


def _again(replies: DataFrame) -> DataFrame:
    return replies.withColumn("seq", F.col("seq") + 10**12)


def track_jobs_stream(spark: SparkSession, sf: str) -> DataFrame:
    orders, replies = d.job_messages(spark, sf)
    found = _outcomes(spark, [orders, replies, _again(replies)], 4)
    path = scratch_dir(spark, "outcomes")
    stream.write_available(found, path, scratch_dir(spark, "checkpoint")).awaitTermination()
    return stream.progress_from_outcomes(spark.read.schema(stream.OUTCOME_SCHEMA).parquet(path))


def completed_jobs_stream(spark: SparkSession, sf: str) -> DataFrame:
    orders, replies = d.job_messages(spark, sf, jobs=None)
    found = _outcomes(spark, [d.job_starts(orders), orders, replies, _again(replies)], 4)
    path = scratch_dir(spark, "completed")
    stream.write_completions(found, path, scratch_dir(spark, "checkpoint")).awaitTermination()
    return stream.read_completions(spark, path, "summaries")


def match_results_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and replies in 16 files, in no order at all."""
    inbox, out = scratch_dir(spark, "inbox"), scratch_dir(spark, "credits")
    _send(d.unaddressed(spark, sf), inbox, 16)
    stream.use_rocksdb(spark)
    found = manager.match_results_stream(readers.read_message_stream(spark, inbox, files_per_trigger=4))
    stream.write_available(found, out, scratch_dir(spark, "checkpoint"), timers=True).awaitTermination()
    return manager.read_matched(spark, out)


def terminate_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted and refused starts, and when each manager is drained, from files in no order."""
    inbox, out = scratch_dir(spark, "inbox"), scratch_dir(spark, "stopping")
    _send(d.stop_messages(spark, sf), inbox, 8)
    stream.use_rocksdb(spark)
    found = manager.terminate_stream(readers.read_message_stream(spark, inbox, files_per_trigger=2))
    stream.write_available(found, out, scratch_dir(spark, "checkpoint"), timers=True).awaitTermination()
    starts = manager.read_starts(spark, out).select(
        F.when(F.col("accepted"), "accepted").otherwise("refused").alias("event"), "msg_id", "to_id",
        F.lit(None).cast("bigint").alias("at"),
    )
    drained = manager.read_drained(spark, out).select(
        F.lit("drained").alias("event"), F.lit(None).cast("string").alias("msg_id"), "to_id", "at"
    )
    return starts.unionByName(drained)


def _tick(messages: DataFrame) -> DataFrame:
    """A message far ahead in time, which says that all before have been sent."""
    last = messages.agg(F.max("ts").alias("ts"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in messages.schema.fields if f.name not in ("msg_id", "ts")]
    ahead = last.select(F.lit("tick").alias("msg_id"), (F.col("ts") + F.expr("INTERVAL 100 DAYS")).alias("ts"), *blank)
    return ahead.select(*messages.columns)


def pending_messages_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Messages that were not handled within five hours, per manager; files in no order."""
    queues = []
    for part in (d.messages(spark, sf), d.handled_messages(spark, sf)):
        inbox = scratch_dir(spark, "inbox")
        _send(part, inbox, 4)
        _send(_tick(part), inbox, 1)
        queues.append(readers.read_message_stream(spark, inbox, files_per_trigger=2))
    out = scratch_dir(spark, "pending")
    found = manager.pending_messages_stream(*queues, within="5 HOURS", late="40 days")
    stream.write_available(found, out, scratch_dir(spark, "checkpoint")).awaitTermination()
    rows = spark.read.schema(readers.MESSAGE_SCHEMA).parquet(out)
    return rows.groupBy("to_id").agg(F.count(F.lit(1)).alias("n"))


def worker_chain_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Orders to replies to matching as two chained streams, both stopped and resumed on the way."""
    inbox, outbox, out = (scratch_dir(spark, n) for n in ("inbox", "outbox", "credits"))
    work, match = scratch_dir(spark, "checkpoint"), scratch_dir(spark, "checkpoint")
    stream.use_rocksdb(spark)
    orders = d.page_orders(spark, sf)
    number = F.substring("msg_id", 2, 20).cast("bigint")
    for half in (number % 2 == 0, number % 2 == 1):
        _send(orders.where(half), inbox, 2)
        manager.run_worker(spark, inbox, outbox, work, *_second_part(), number).awaitTermination()
        both = readers.read_message_stream(spark, inbox).unionByName(readers.read_message_stream(spark, outbox))
        found = manager.match_results_stream(both)
        stream.write_available(found, out, match, timers=True).awaitTermination()
    return manager.read_matched(spark, out)


def running_worker_stats_stream(spark: SparkSession, sf: str) -> DataFrame:
    inbox, out = scratch_dir(spark, "work"), scratch_dir(spark, "workers")
    events = d.table(spark, sf, "events")
    events.repartition(8, "event_id").write.parquet(inbox)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(inbox)
    stream.write_updates(
        stream.running_worker_stats(d.work_of(arriving)), out, scratch_dir(spark, "checkpoint"), key="worker", every=2
    ).awaitTermination()
    return _stats_columns(stream.read_merged(spark, out, "worker"))


def dedupe_stream(spark: SparkSession, sf: str) -> DataFrame:
    inbox = scratch_dir(spark, "inbox")
    _send(d.redelivered(spark, sf), inbox, 8)
    out = scratch_dir(spark, "deduped")
    stream.write_available(
        stream.dedupe_stream(readers.read_message_stream(spark, inbox, files_per_trigger=1)),
        out,
        scratch_dir(spark, "checkpoint"),
    ).awaitTermination()
    return spark.read.schema(readers.MESSAGE_SCHEMA).parquet(out).select("msg_id", "type", "body")


def entry(spark: SparkSession) -> DataFrame:
    """Collocations per decade on the smallest tables."""
    return collocations(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    found = [
        word_count, bigrams_by_decade, stopword_filtered_bigrams, left_marginal, right_marginal,
        decade_totals, npmi_by_decade, collocations, decade_report_lines, bigram_validation,
        extract_paths, triples_to_slots, slot_marginals, path_features, pair_features,
        path_similarity, mirrored_path_similarity, systematic_sample,
        match_results, unmatched_results, job_progress, running_items, pending_messages,
        dispatch_by_type, addressed_messages, accept_jobs, parse_results, dedupe_messages,
        worker_stats, worker_items, worker_report_lines, summary_lines, gallery_html, url_parts,
        pair_literals, thumbnails, process_items, tracked_thumbnails, work_orders, completed_jobs, refusals,
        text_lines_round_trip, sequence_lines_round_trip, shard_round_trip, key_value_round_trip,
        pair_round_trip, item_list_round_trip, thumbnail_round_trip, routed_errors, hebrew_stop_words,
        rejected_lines, report_lines_in_order, decoded_thumbnails,
        track_jobs_stream, completed_jobs_stream, running_worker_stats_stream, dedupe_stream,
        match_results_stream, terminate_stream, pending_messages_stream, worker_chain_stream,
    ]
    named = {f.__name__: f for f in found}
    if LLM:
        named |= LLM.queries()
    if PIPELINE:
        named["pipeline"] = PIPELINE.run
    return named


# ---- SQL -------------------------------------------------------------------------------

_TOKENS = r"""
words AS (
  SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i
  FROM (SELECT doc_id, string_split_regex(text, '[ \t\n\r\f]+') AS t FROM documents)
),
toks AS (
  SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i FROM words WHERE w <> ''
)"""

_BIGRAMS = _TOKENS + """,
bigrams AS (
  SELECT * FROM (
    SELECT w AS w1, lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS w2,
           CAST(1900 + doc_id % 120 AS VARCHAR) AS year
    FROM toks)
  WHERE w2 IS NOT NULL
)"""

_COUNTS = _BIGRAMS + """,
counts AS (
  SELECT w1, w2, substr(year, 1, 3) AS decade, CAST(count(*) AS BIGINT) AS c
  FROM bigrams {where} GROUP BY ALL
)"""

_NPMI = _COUNTS + """,
l AS (SELECT w1, decade, CAST(sum(c) AS BIGINT) AS left_c FROM counts GROUP BY ALL),
r AS (SELECT w2, decade, CAST(sum(c) AS BIGINT) AS right_c FROM counts GROUP BY ALL),
t AS (SELECT decade, CAST(2 * sum(c) AS BIGINT) AS n FROM counts GROUP BY ALL),
npmi AS (
  SELECT w1, w2, decade, c, n, left_c, right_c,
         ln((c / n) / ((left_c / n) * (right_c / n))) AS pmi,
         ln((c / n) / ((left_c / n) * (right_c / n))) / -ln(c / n) AS npmi
  FROM counts JOIN l USING (w1, decade) JOIN r USING (w2, decade) JOIN t USING (decade)
),
found AS (
  SELECT decade, w1, w2, npmi, pmi, decade_npmi
  FROM npmi JOIN (SELECT decade, sum(npmi) AS decade_npmi FROM npmi GROUP BY ALL) USING (decade)
  WHERE npmi > {min_npmi} OR npmi / decade_npmi > {rel}
)"""


def _npmi_sql(where: str = "") -> str:
    return _NPMI.format(where=where, min_npmi=MIN_NPMI, rel=REL_MIN_NPMI)


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_NO_STOP = f"WHERE w1 NOT IN ({_quoted(ENGLISH)}) AND w2 NOT IN ({_quoted(ENGLISH)})"

_LINES = """
lines AS (
  SELECT CASE length(w1) % 7
    WHEN 0 THEN w1 || ' ' || w2 || ' ' || year || ' ' || length(w2) || ' 1'
    WHEN 1 THEN w1 || ' ' || w2 || ' 98 ' || length(w2) || ' 1 1'
    WHEN 2 THEN w1 || ' ' || w2 || ' ' || year || ' abc 1 1'
    WHEN 3 THEN chr(9) || ' ' || w1 || chr(9) || ' ' || w2 || chr(9) || ' ' || year || chr(9) || ' '
                || length(w2) || chr(9) || ' 1' || chr(9) || ' 1' || chr(9) || ' '
    WHEN 4 THEN w1 || ' ' || w2 || ' ' || year || ' 0 1 1'
    WHEN 5 THEN w1 || ' ' || w2 || ' ' || year || ' ' || length(w2) || ' 1 1 1'
    ELSE w1 || ' ' || w2 || ' ' || year || ' ' || length(w2) || ' 1 1' END AS value
  FROM bigrams
),
f AS (SELECT list_filter(string_split_regex(value, '[ \\t\\n\\r\\f\\x0B]+'), lambda x: x <> '') AS f FROM lines),
v AS (
  SELECT f, coalesce(len(f) = 6 AND length(f[3]) >= 4 AND TRY_CAST(f[4] AS DOUBLE) > 0, false) AS ok FROM f
)"""

_TRIPLES = """
triples AS (
  SELECT 'X ' || l_returnflag || ' ' || p_type || ' Y' AS path, n_name AS slot_x,
         p_brand AS slot_y, CAST(l_quantity AS BIGINT) AS c
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
)"""

_PAIRS = """
pairs AS (
  SELECT 'X ' || a || ' ' || p_type || ' Y' AS p1, 'X ' || b || ' ' || p_type || ' Y' AS p2
  FROM (SELECT DISTINCT p_type FROM part),
       (VALUES ('A', 'N'), ('A', 'R'), ('N', 'R'), ('R', 'A')) v(a, b)
)"""

_SLOTS = """
slots AS (
  SELECT path, 'X' AS slot, slot_x AS word, c FROM triples
  UNION ALL SELECT path, 'Y', slot_y, c FROM triples
),
psw AS (SELECT path, slot, word, CAST(sum(c) AS BIGINT) AS c FROM slots GROUP BY ALL),
ps AS (SELECT path, slot, CAST(sum(c) AS BIGINT) AS ps FROM slots GROUP BY ALL),
sw AS (SELECT slot, word, CAST(sum(c) AS BIGINT) AS sw FROM slots GROUP BY ALL),
s AS (SELECT slot, CAST(sum(c) AS BIGINT) AS s FROM slots GROUP BY ALL)"""

_FEATURES = _SLOTS + f""",
feats AS MATERIALIZED (
  SELECT path, slot, word, c,
         ln(CAST(c AS DOUBLE) * s / (CAST(ps AS DOUBLE) * sw)) AS mi,
         c / (1 + ln(sw)) AS tfidf,
         2 * c / (sw + ps) AS dice
  FROM (
    SELECT *, sum(c) OVER (PARTITION BY path, slot) AS ps, sum(c) OVER (PARTITION BY slot, word) AS sw,
           sum(c) OVER (PARTITION BY slot) AS s
    FROM psw)
  WHERE ps > {DP_MIN_COUNT}
)"""

_SIDES = _FEATURES + """,
sides AS (
  SELECT p1, p2, 1 AS side, f.* FROM pairs JOIN feats f ON p1 = path WHERE p1 <> p2
  UNION ALL SELECT p1, p2, 2, f.* FROM pairs JOIN feats f ON p2 = path WHERE p1 <> p2
)"""

_SIMILARITY = _FEATURES + """,
both_sides AS MATERIALIZED (
  SELECT p1, p2, slot, word, mi AS mi_a, tfidf AS t_a, dice AS dice_a, NULL AS mi_b, NULL AS t_b
  FROM pairs JOIN feats ON p1 = path WHERE p1 <> p2
  UNION ALL SELECT p1, p2, slot, word, NULL, NULL, NULL, mi, tfidf FROM pairs JOIN feats ON p2 = path WHERE p1 <> p2
),
shared_words AS MATERIALIZED (
  SELECT p1, p2, slot, max(mi_a) AS mi_a, max(t_a) AS t_a, max(dice_a) AS dice_a, max(mi_b) AS mi_b, max(t_b) AS t_b
  FROM both_sides GROUP BY p1, p2, slot, word
),
per_slot AS MATERIALIZED (
  SELECT p1, p2, slot, count(mi_a) AS n1, count(mi_b) AS n2,
         coalesce(sum(mi_a), 0) + coalesce(sum(mi_b), 0) AS mi,
         sqrt(sum(t_a * t_a)) * sqrt(sum(t_b * t_b)) AS t, sum(dice_a) AS dice,
         coalesce(sum(mi_a + mi_b), 0) AS m_mi, coalesce(sum(t_a * t_b), 0) AS m_t,
         coalesce(sum(dice_a) FILTER (mi_b IS NOT NULL), 0) AS m_dice
  FROM shared_words GROUP BY p1, p2, slot
),
measured AS MATERIALIZED (
  SELECT p1, p2, slot, n1, n2, CASE WHEN mi = 0 THEN 0 ELSE m_mi / mi END AS sim,
         CASE WHEN t = 0 THEN 0 ELSE m_t / t END AS cosine, CASE WHEN dice = 0 THEN 0 ELSE m_dice / dice END AS cover
  FROM per_slot WHERE n1 > {min_features} AND n2 > {min_features}
),
scored AS (
  SELECT x.p1, x.p2,
         CASE WHEN x.sim * y.sim >= 0 THEN round(sqrt(x.sim * y.sim), 4) END AS sim,
         round(sqrt(x.cosine * y.cosine), 6) AS cosine, round(sqrt(x.cover * y.cover), 6) AS cover
  FROM (SELECT * FROM measured WHERE slot = 'X') x JOIN (SELECT * FROM measured WHERE slot = 'Y') y USING (p1, p2)
)"""

# The walk of extract_paths as a recursive query: one row per noun and step.
_PATHS = _TOKENS + """,
runs AS (
  SELECT doc_id, w, (i - 1) // 8 AS run, (i - 1) % 8 + 1 AS k, doc_id % 9 + 1 AS c FROM toks
),
tk AS (
  SELECT doc_id, run, w, k, c, count(*) OVER (PARTITION BY doc_id, run) AS n,
         CASE WHEN k = 2 THEN 'VB' WHEN length(w) % 3 = 0 THEN 'NN' WHEN length(w) % 3 = 1 THEN 'NN'
              ELSE 'JJ' END AS pos,
         CASE WHEN k = 2 THEN 0 WHEN k = 1 OR length(w) % 5 = 1 THEN 2
              WHEN length(w) % 5 = 2 THEN k + 1 ELSE k - 1 END AS head
  FROM runs
),
usable AS (
  SELECT doc_id, run FROM tk GROUP BY ALL HAVING max(k) >= 2 AND bool_and(NOT contains(w, '/'))
),
t AS (SELECT tk.* FROM tk JOIN usable USING (doc_id, run)),
walk AS (
  WITH RECURSIVE step AS (
    SELECT doc_id, run, k AS i, n, head AS at_, CAST([] AS BIGINT[]) AS seen, false AS bad, 0 AS steps
    FROM t WHERE pos = 'NN'
    UNION ALL
    SELECT s.doc_id, s.run, s.i, s.n, t.head, list_append(s.seen, s.at_), s.at_ < 1 OR s.at_ > s.n, s.steps + 1
    FROM step s LEFT JOIN t ON t.doc_id = s.doc_id AND t.run = s.run AND t.k = s.at_
    WHERE s.at_ <> 2 AND NOT s.bad AND s.steps < 16
  )
  SELECT doc_id, run, i, n, seen, at_ IS NOT DISTINCT FROM 2 AND NOT bad AND len(seen) <= 15 AS ok, bad
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, run, i ORDER BY steps DESC) AS last FROM step)
  WHERE last = 1
),
prs AS (
  SELECT a.doc_id, a.run, a.i, b.i AS j, a.seen AS seen_a, b.seen AS seen_b,
         a.ok AND b.ok AND NOT list_contains(a.seen, b.i) AS keep,
         a.bad OR (a.ok AND NOT list_contains(a.seen, b.i) AND b.bad) AS broken
  FROM walk a JOIN walk b ON a.doc_id = b.doc_id AND a.run = b.run AND a.i < b.i
),
broken AS (SELECT DISTINCT doc_id, run FROM prs WHERE broken),
kept AS (
  SELECT prs.* FROM prs LEFT JOIN broken b ON prs.doc_id = b.doc_id AND prs.run = b.run
  WHERE keep AND b.doc_id IS NULL
),
spelled AS (
  SELECT p.doc_id, p.run, p.i, p.j, any_value(t.c) AS c,
         any_value(t.w) FILTER (t.k = p.i) AS word_i, any_value(t.w) FILTER (t.k = p.j) AS word_j,
         string_agg(CASE t.k WHEN p.i THEN 'X' WHEN p.j THEN 'Y' ELSE t.w END, ' ' ORDER BY t.k) AS path_1,
         string_agg(CASE t.k WHEN p.i THEN 'Y' WHEN p.j THEN 'X' ELSE t.w END, ' ' ORDER BY t.k) AS path_2
  FROM kept p JOIN t ON t.doc_id = p.doc_id AND t.run = p.run
  WHERE t.k IN (p.i, p.j, 2) OR list_contains(p.seen_a, t.k) OR list_contains(p.seen_b, t.k)
  GROUP BY p.doc_id, p.run, p.i, p.j
),
triples AS MATERIALIZED (
  SELECT path_1 AS path, word_i AS slot_x, word_j AS slot_y, c FROM spelled
  UNION ALL SELECT path_2, word_j, word_i, c FROM spelled
)"""

_MIRRORED = """
pairs AS (
  SELECT DISTINCT path AS p1,
         array_to_string(list_transform(string_split(path, ' '),
           lambda w: CASE w WHEN 'X' THEN 'Y' WHEN 'Y' THEN 'X' ELSE w END), ' ') AS p2
  FROM triples
)"""

_MATCHED = """
jobs AS (SELECT 'j' || (user_id % 10) AS job_id, user_id % 10 AS submit_seq, props AS item FROM events),
results AS (
  SELECT event_id AS seq, CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS type,
         CASE WHEN event_type = 'signup' THEN props || '#' || user_id ELSE props END AS item,
         CASE WHEN event_type <> 'error' THEN 't' || event_id END AS thumb
  FROM events
),
copies AS (SELECT job_id, item, row_number() OVER (PARTITION BY item ORDER BY submit_seq) AS k FROM jobs),
numbered AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY seq) AS k FROM results),
matched AS (SELECT seq, type, item, thumb, job_id FROM numbered LEFT JOIN copies USING (item, k)),
progress AS (
  SELECT job_id, total, coalesce(done, 0) AS done, coalesce(failed, 0) AS failed,
         total - coalesce(done, 0) - coalesce(failed, 0) AS unfinished,
         total = coalesce(done, 0) + coalesce(failed, 0) AS complete,
         CASE WHEN total = coalesce(done, 0) + coalesce(failed, 0) THEN last_seq END AS completed_at
  FROM (SELECT job_id, count(item) AS total FROM jobs GROUP BY ALL)
  LEFT JOIN (SELECT job_id, count(*) FILTER (type = 'ok') AS done, count(*) FILTER (type = 'error') AS failed,
                    max(seq) AS last_seq FROM matched GROUP BY ALL) USING (job_id)
)"""

_MESSAGES = """
messages AS (
  SELECT 'm' || event_id AS msg_id, event_id AS seq, ts, 'u' || user_id AS from_id,
         'manager' || (user_id % 7) AS to_id,
         CASE WHEN event_type = 'signup' THEN 'start_job' WHEN event_type = 'click' THEN 'thumbnail_ended'
              WHEN event_type = 'error' THEN 'error_work'
              WHEN event_type = 'purchase' AND value > 50 THEN 'terminate'
              WHEN event_type = 'view' THEN 'init_url_thumb' END AS type,
         CASE WHEN event_type = 'click' THEN props || ';t' || event_id ELSE props END AS body
  FROM events
)"""

_WORK = """
work AS (
  SELECT 'w' || user_id AS worker, event_id AS seq, props AS url, ts AS start_ts, value AS ms,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
         CASE WHEN event_type = 'error' THEN 'bad input' END AS error
  FROM events
),
stats AS (
  SELECT worker, count(*) AS processed, count(*) FILTER (status = 'ok') AS ok,
         count(*) FILTER (status <> 'ok') AS failed,
         coalesce(sum(ms) FILTER (status = 'ok'), 0) / count(*) AS avg_ms,
         avg(ms) FILTER (status = 'ok') AS avg_ok_ms, min(start_ts) AS start_ts,
         max(start_ts + to_microseconds(CAST(trunc(ms * 1000) AS BIGINT))) AS end_ts
  FROM work GROUP BY ALL
),
items AS (
  SELECT worker, status, seq, url, error,
         row_number() OVER (PARTITION BY worker, status ORDER BY seq) - 1 AS idx
  FROM work
)"""

_STATS = (
    f"WITH {_WORK} SELECT worker, processed, ok, failed, round(avg_ms, 4) AS avg_ms, "
    "round(avg_ok_ms, 4) AS avg_ok_ms, epoch_us(start_ts) AS start_ts, epoch_us(end_ts) AS end_ts FROM stats"
)

_PART_LINES = "SELECT p_name || ' ' || p_type || ' ' || p_brand AS value, count(*) AS n FROM part GROUP BY ALL"

# Tiles of 64 x 64 bytes, and means of 4 x 4 of them rounded half to even.
_TILES = """
bytes AS MATERIALIZED (SELECT page_id, url, hex(encode(html)) AS h FROM pages),
tiles AS MATERIALIZED (
  SELECT page_id, url, k, rpad(substr(h, 8192 * k + 1, 8192), 8192, '0') AS h
  FROM (SELECT *, unnest(generate_series(0, greatest((len(h) // 2 + 4095) // 4096, 1) - 1)) AS k FROM bytes)
),
means AS (
  SELECT page_id, url, k, i // 256 AS y, (i % 64) // 4 AS x,
         round_even(sum(CAST('0x' || substr(h, 2 * i + 1, 2) AS INTEGER)) / 16, 0) AS v
  FROM (SELECT *, unnest(generate_series(0, 4095)) AS i FROM tiles) GROUP BY ALL
),
thumbs AS MATERIALIZED (
  SELECT url || '#' || k AS origin, page_id * 1000000 + k AS seq, string_split(url, '/')[3] AS job_id,
         NOT contains(url, '?') AS image,
         md5(unhex(string_agg(printf('%02x', CAST(v AS INTEGER)), '' ORDER BY y, x))) AS pixels
  FROM means GROUP BY page_id, url, k
)"""

_PAGE_JOBS = """
jobs AS (SELECT string_split(url, '/')[3] AS job_id, url AS item FROM pages),
results AS (
  SELECT page_id AS seq, CASE WHEN contains(url, '?') THEN 'error' ELSE 'ok' END AS type, url AS item,
         CASE WHEN NOT contains(url, '?') THEN 't' || page_id END AS thumb, string_split(url, '/')[3] AS job_id
  FROM pages WHERE NOT contains(url, '#')
),
complete AS (
  SELECT job_id FROM (SELECT job_id, count(*) AS n FROM jobs GROUP BY ALL)
  JOIN (SELECT job_id, count(*) AS n FROM results GROUP BY ALL) USING (job_id, n)
),
summary AS (
  SELECT job_id, seq, item, thumb, item || ';' || thumb AS line
  FROM results JOIN complete USING (job_id) WHERE type = 'ok'
  UNION ALL
  SELECT job_id, NULL, NULL, NULL, '' FROM results JOIN complete USING (job_id)
  GROUP BY job_id HAVING count(*) FILTER (type = 'ok') = 0
)"""


def oracle_sql() -> dict[str, str]:
    counts = _COUNTS.format(where="")
    scored = _SIMILARITY.format(min_features=MIN_FEATURES)
    mirrored = _SIMILARITY.format(min_features=0)
    rounded = "round(mi, 6) AS mi, round(tfidf, 6) AS tfidf, round(dice, 6) AS dice"
    found = {
        "word_count": f"WITH {_TOKENS} SELECT w AS word, count(*) AS n FROM toks GROUP BY ALL",
        "bigrams_by_decade": f"WITH {counts} SELECT * FROM counts",
        "stopword_filtered_bigrams": f"WITH {_COUNTS.format(where=_NO_STOP)} SELECT * FROM counts",
        "left_marginal": f"WITH {counts} SELECT w1, decade, CAST(sum(c) AS BIGINT) AS left_c FROM counts GROUP BY ALL",
        "right_marginal": f"WITH {counts} SELECT w2, decade, CAST(sum(c) AS BIGINT) AS right_c FROM counts GROUP BY ALL",
        "decade_totals": f"WITH {counts} SELECT decade, CAST(2 * sum(c) AS BIGINT) AS n FROM counts GROUP BY ALL",
        "npmi_by_decade": f"""WITH {_npmi_sql()}
            SELECT w1, w2, decade, c, n, left_c, right_c, round(pmi, 6) AS pmi, round(npmi, 6) AS npmi FROM npmi""",
        "collocations": f"""WITH {_npmi_sql()}
            SELECT decade, w1, w2, round(npmi, 6) AS npmi, round(pmi, 6) AS pmi,
                   round(decade_npmi, 4) AS decade_npmi FROM found""",
        "decade_report_lines": f"""WITH {_npmi_sql(_NO_STOP)},
            heads AS (SELECT decade, max(decade_npmi) AS total FROM found GROUP BY ALL)
            SELECT decade, 0 AS section, '' AS line FROM heads
            UNION ALL SELECT decade, 1, 'Decade ' || decade || '0' || chr(9) || 'Total in decade was ' || printf('%.4f', total) FROM heads
            UNION ALL SELECT decade, 2, chr(9) || chr(9) || 'W1' || chr(9) || chr(9) || 'W2' || chr(9) || chr(9) || 'npmi'
                             || chr(9) || chr(9) || 'pmi' || chr(9) FROM heads
            UNION ALL SELECT decade, 3, chr(9) || chr(9) || w1 || chr(9) || chr(9) || w2 || chr(9) || chr(9)
                             || printf('%.4f', npmi) || chr(9) || chr(9) || printf('%.4f', pmi) || chr(9) FROM found""",
        "bigram_validation": f"""WITH {_BIGRAMS}, {_LINES}
            SELECT f[3] AS year, count(*) AS n, CAST(sum(CAST(f[4] AS DOUBLE)) AS BIGINT) AS total FROM v WHERE ok GROUP BY ALL
            UNION ALL SELECT 'rejected', count(*), CAST(0 AS BIGINT) FROM v WHERE NOT ok""",
        "extract_paths": f"WITH {_PATHS} SELECT path, slot_x, slot_y, c FROM triples",
        "triples_to_slots": f"WITH {_TRIPLES}, {_SLOTS} SELECT path, slot, word, c FROM slots",
        "slot_marginals": f"""WITH {_TRIPLES}, {_SLOTS}
            SELECT 'psw' AS kind, path, slot, word, c FROM psw
            UNION ALL SELECT 'ps', path, slot, NULL, ps FROM ps
            UNION ALL SELECT 'sw', NULL, slot, word, sw FROM sw
            UNION ALL SELECT 's', NULL, slot, NULL, s FROM s""",
        "path_features": f"WITH {_TRIPLES}, {_FEATURES} SELECT path, slot, word, c, {rounded} FROM feats",
        "pair_features": f"""WITH {_TRIPLES}, {_PAIRS}, {_SIDES}
            SELECT p1, p2, side, path, slot, word, c, {rounded} FROM sides""",
        "path_similarity": f"WITH {_TRIPLES}, {_PAIRS}, {scored} SELECT * FROM scored",
        "mirrored_path_similarity": f"WITH {_PATHS}, {_MIRRORED}, {mirrored} SELECT * FROM scored",
        "systematic_sample": """SELECT doc_id FROM documents
            WHERE CAST('0x' || substr(md5(text), 1, 8) AS BIGINT) % 50 = 0""",
        "match_results": f"WITH {_MATCHED} SELECT * FROM matched",
        "unmatched_results": f"WITH {_MATCHED} SELECT seq, type, item, thumb FROM matched WHERE job_id IS NULL",
        "job_progress": f"WITH {_MATCHED} SELECT * FROM progress",
        "running_items": f"""WITH {_MATCHED} SELECT CAST(sum(unfinished) AS BIGINT) AS running,
            count(*) FILTER (NOT complete) AS open_jobs FROM progress""",
        "pending_messages": f"""WITH {_MESSAGES} SELECT to_id, count(*) AS n FROM messages
            WHERE type IS NULL OR type NOT IN ('thumbnail_ended', 'error_work') GROUP BY ALL""",
        "dispatch_by_type": f"""WITH {_MESSAGES} SELECT msg_id, to_id,
            CASE WHEN type IS NULL THEN 'reject' WHEN type = 'start_job' THEN 'start'
                 WHEN type = 'thumbnail_ended' THEN 'finished' WHEN type = 'error_work' THEN 'error'
                 WHEN type = 'terminate' THEN 'terminate' ELSE 'ignore' END AS route FROM messages""",
        "addressed_messages": f"WITH {_MESSAGES} SELECT msg_id, body FROM messages WHERE to_id = 'manager3'",
        "accept_jobs": f"""WITH {_MESSAGES},
            stops AS (SELECT to_id, min(ts) AS stop FROM messages WHERE type = 'terminate' GROUP BY ALL)
            SELECT msg_id, to_id, stop IS NULL OR ts < stop AS accepted
            FROM messages LEFT JOIN stops USING (to_id) WHERE type = 'start_job'""",
        "parse_results": """SELECT event_id AS seq, CASE WHEN event_type = 'click' THEN 'ok' ELSE 'error' END AS type,
            props AS item, CASE WHEN event_type = 'click' THEN 't' || event_id END AS thumb
            FROM events WHERE event_type IN ('click', 'error')""",
        "dedupe_messages": f"WITH {_MESSAGES} SELECT msg_id, seq, type, body FROM messages",
        "worker_stats": _STATS,
        "worker_items": f"WITH {_WORK} SELECT worker, status, seq, url, error, idx FROM items",
        "worker_report_lines": f"""WITH {_WORK},
            lines AS (
              SELECT worker, 0 AS section, 0 AS idx, 'Worker {{' || worker || '}}' AS line FROM stats
              UNION ALL SELECT worker, 1, 0, 'Start date  = ' || strftime(start_ts, '%a %b %d %H:%M:%S UTC %Y') FROM stats
              UNION ALL SELECT worker, 2, 0, 'End date = ' || strftime(end_ts, '%a %b %d %H:%M:%S UTC %Y') FROM stats
              UNION ALL SELECT worker, 3, 0, 'Average proccess time in MS= ' || printf('%.3f', avg_ms) FROM stats
              UNION ALL SELECT worker, 4, 0, 'Number of processed url = ' || processed FROM stats
              UNION ALL SELECT worker, 5, 0, 'Successfull urls - ' FROM stats
              UNION ALL SELECT worker, 6, idx, idx || ': ' || url FROM items WHERE status = 'ok'
              UNION ALL SELECT worker, 7, 0, '' FROM stats
              UNION ALL SELECT worker, 8, 0, 'Failed urls - ' FROM stats
              UNION ALL SELECT worker, 9, idx, idx || ': ' || url || ', Error reason = ' || error FROM items WHERE status = 'error')
            SELECT worker, section, CAST(idx AS BIGINT) AS idx, line FROM lines""",
        "summary_lines": f"WITH {_PAGE_JOBS} SELECT job_id, seq, line FROM summary",
        "gallery_html": f"""WITH {_PAGE_JOBS}
            SELECT job_id, 1 AS section, seq, '<a href="' || item || '"><img src="http://thumbs/' || thumb
                   || '" width="50" height="50"></a>' AS html FROM summary WHERE item IS NOT NULL
            UNION ALL SELECT DISTINCT job_id, 0, CAST(0 AS BIGINT), '<HTML>' || chr(10) || '<HEAD>' || chr(10) || '</HEAD>' || chr(10) || '<BODY>' FROM summary
            UNION ALL SELECT DISTINCT job_id, 2, CAST(0 AS BIGINT), '</BODY>' || chr(10) || '</HTML>' FROM summary""",
        "url_parts": """SELECT page_id, string_split(url, '/')[-1] AS base, string_split(url, '.')[-1] AS ext,
            CASE WHEN lower(string_split(url, '.')[-1]) = 'jpe' THEN 'jpg' ELSE string_split(url, '.')[-1] END AS format,
            string_split(url, '/')[1] AS scheme, substr(url, strpos(url, '/') + 1) AS rest FROM pages""",
        "pair_literals": """SELECT '"' || p_name || '" + Constants.S + "' || p_type || '",' AS value
            FROM part WHERE p_size % 5 NOT IN (0, 1)""",
        "thumbnails": """SELECT url AS origin,
            CASE WHEN lower(string_split(url, '.')[-1]) = 'jpe' THEN 'jpg' ELSE string_split(url, '.')[-1] END AS format,
            'ok' AS status, CAST(greatest(1, floor(h * 50 / greatest(h, 64) + 0.5)) AS INTEGER) AS height,
            CAST(greatest(1, floor(64 * 50 / greatest(h, 64) + 0.5)) AS INTEGER) AS width,
            CAST(greatest(1, floor(h * 50 / greatest(h, 64) + 0.5)) * greatest(1, floor(64 * 50 / greatest(h, 64) + 0.5)) AS INTEGER) AS size
            FROM (SELECT url, CAST(ceil(strlen(html) / 64) AS INTEGER) AS h FROM pages)""",
        "tracked_thumbnails": f"""WITH {_TILES}
            SELECT seq, job_id, CASE WHEN image THEN 'ok' ELSE 'error' END AS type, origin AS item,
                   CASE WHEN image THEN 'w1_' || seq END AS thumb, CASE WHEN image THEN pixels END AS pixels,
                   CASE WHEN image THEN 16 END AS height, CASE WHEN image THEN 16 END AS width,
                   CASE WHEN image THEN origin || ';w1_' || seq END AS line FROM thumbs""",
        "thumbnail_round_trip": f"""WITH {_TILES}
            SELECT origin, 16 AS height, 16 AS width, pixels FROM thumbs WHERE image""",
        "work_orders": """WITH lists AS (SELECT string_split(url, '/')[3] AS list, url AS item FROM pages),
            copies AS (SELECT *, row_number() OVER (PARTITION BY list, item) AS n FROM lists),
            starts AS (SELECT DISTINCT list, 'job-' || list || '-' || k AS job_id
                       FROM lists, (VALUES (1), (2)) v(k) WHERE k = 1 OR length(list) % 2 = 0)
            SELECT 'm-' || job_id || '-' || md5(item) || '-' || n AS msg_id, job_id, 'init_url_thumb' AS type, item AS body
            FROM starts JOIN copies USING (list)
            UNION ALL SELECT NULL, 'job-nowhere-1', 'empty', NULL""",
        "completed_jobs": f"""WITH {_PAGE_JOBS}
            SELECT job_id, 'job_ended' AS type, max(seq) AS seq, 'summaries/job_id=' || job_id AS body
            FROM results JOIN complete USING (job_id) GROUP BY job_id""",
        "refusals": f"""WITH {_MESSAGES},
            stops AS (SELECT to_id, min(ts) AS stop FROM messages WHERE type = 'terminate' GROUP BY ALL)
            SELECT msg_id || '-refused' AS msg_id, to_id AS from_id, from_id AS to_id, 'job_refused' AS type, body
            FROM messages JOIN stops USING (to_id) WHERE type = 'start_job' AND ts >= stop""",
        "text_lines_round_trip": _PART_LINES,
        "sequence_lines_round_trip": _PART_LINES,
        "shard_round_trip": _PART_LINES,
        "key_value_round_trip": """SELECT p_type || ' ' || p_brand || chr(9) || p_size || ' ' || p_partkey AS value,
            count(*) AS n FROM part GROUP BY ALL""",
        "pair_round_trip": f"WITH {_PAIRS} SELECT p1, p2 FROM pairs",
        "item_list_round_trip": "SELECT url AS item, count(*) AS n FROM pages GROUP BY ALL",
        "routed_errors": r"""SELECT page_id, CASE WHEN len(p) >= 2 THEN p[2] ELSE 'no second part' END AS result
            FROM (SELECT page_id,
                  string_split(trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/') AS p FROM pages)""",
        "hebrew_stop_words": "SELECT p_type AS w1, p_name AS w2, '199' AS decade, CAST(count(*) AS BIGINT) AS c "
                             "FROM part WHERE p_partkey % 3 <> 0 GROUP BY ALL",
        "rejected_lines": f"""WITH {_BIGRAMS}, {_LINES}, {_MESSAGES}
            SELECT 'bigram' AS kind, count(*) AS n FROM v WHERE NOT ok
            UNION ALL SELECT 'n-gram', count(*) FROM part WHERE p_size % 3 <> 1
            UNION ALL SELECT 'pair', count(*) FROM part WHERE p_size % 2 = 0
            UNION ALL SELECT 'message', count(*) FROM messages WHERE type IS NULL""",
        "completed_jobs_stream": """
            SELECT 'j' || user_id || '-' || event_id % 20 AS job_id, 'job_ended' AS type,
                   max(event_id) + 1000000000000 AS seq,
                   'summaries/job_id=j' || user_id || '-' || event_id % 20 AS body
            FROM events GROUP BY user_id, event_id % 20 HAVING count(*) FILTER (event_type = 'signup') = 0
            UNION ALL
            SELECT 'empty' || event_id, 'job_ended', NULL, 'summaries/job_id=empty' || event_id
            FROM events WHERE event_id % 50 = 0""",
        "report_lines_in_order": f"""WITH {_npmi_sql(_NO_STOP)}, {_PAGE_JOBS},
            heads AS (SELECT decade, max(decade_npmi) AS total FROM found GROUP BY ALL),
            rows AS (
              SELECT 'report' AS report, decade AS key, 0 AS a, 0 AS b, '' AS c, '' AS d, 0 AS e, '' AS line FROM heads
              UNION ALL SELECT 'report', decade, 1, 0, '', '', 0, 'Decade ' || decade || '0' || chr(9) || 'Total in decade was ' || printf('%.4f', total) FROM heads
              UNION ALL SELECT 'report', decade, 2, 0, '', '', 0, chr(9) || chr(9) || 'W1' || chr(9) || chr(9) || 'W2' || chr(9) || chr(9) || 'npmi'
                               || chr(9) || chr(9) || 'pmi' || chr(9) FROM heads
              UNION ALL SELECT 'report', decade, 3, -round(npmi, 6), w1, w2, 0, chr(9) || chr(9) || w1 || chr(9) || chr(9) || w2 || chr(9) || chr(9)
                               || printf('%.4f', npmi) || chr(9) || chr(9) || printf('%.4f', pmi) || chr(9) FROM found
              UNION ALL SELECT 'summaries', job_id, 0, coalesce(seq, -1), '', '', 0, line FROM summary
              UNION ALL SELECT 'gallery', job_id, 1, seq, '', '', 0, '<a href="' || item || '"><img src="http://thumbs/' || thumb
                               || '" width="50" height="50"></a>' FROM summary WHERE item IS NOT NULL
              UNION ALL SELECT 'gallery', job_id, s, 0, '', '', i, l
                        FROM (SELECT DISTINCT job_id FROM summary), (VALUES (0, 0, '<HTML>'), (0, 1, '<HEAD>'), (0, 2, '</HEAD>'),
                             (0, 3, '<BODY>'), (2, 0, '</BODY>'), (2, 1, '</HTML>')) v(s, i, l))
            SELECT report, key, row_number() OVER (PARTITION BY report, key ORDER BY a, b, c, d, e) AS line_no, line FROM rows""",
        "decoded_thumbnails": f"""WITH b AS MATERIALIZED (
              SELECT page_id, hex(encode(html)) AS x, greatest(1, CAST(ceil(strlen(html) / {3 * d.BITMAP_WIDTH}.0) AS BIGINT)) AS h,
                     {d.BITMAP_WIDTH} AS w FROM pages WHERE NOT contains(url, '?')),
            s AS MATERIALIZED (
              SELECT *, greatest(1, CAST(floor(h * 16 / greatest(h, w) + 0.5) AS BIGINT)) AS th,
                     greatest(1, CAST(floor(w * 16 / greatest(h, w) + 0.5) AS BIGINT)) AS tw FROM b),
            px AS (
              SELECT page_id, h, w, th, tw, i // (3 * w) AS y, i % (3 * w) // 3 AS x, i % 3 AS c,
                     CASE WHEN 2 * i < length(s.x) THEN CAST('0x' || substr(s.x, CAST(2 * i + 1 AS BIGINT), 2) AS INTEGER) ELSE 0 END AS v
              FROM s, generate_series(0, 3 * w * h - 1) g(i)),
            spread AS (
              SELECT page_id, h, w, ty, tx, c,
                     v * (least((y + 1) * th, (ty + 1) * h) - greatest(y * th, ty * h))
                       * (least((x + 1) * tw, (tx + 1) * w) - greatest(x * tw, tx * w)) AS part
              FROM (SELECT *, unnest(generate_series(y * th // h, ((y + 1) * th - 1) // h)) AS ty FROM px) a,
                   LATERAL (SELECT unnest(generate_series(x * tw // w, ((x + 1) * tw - 1) // w)) AS tx)),
            small AS (
              SELECT page_id, ty, tx, c, CAST(sum(part) AS BIGINT) // (h * w) AS q, CAST(sum(part) AS BIGINT) % (h * w) AS r, h * w AS n
              FROM spread GROUP BY page_id, h, w, ty, tx, c),
            done AS (
              SELECT page_id, md5(unhex(string_agg(printf('%02x', q + CASE WHEN 2 * r > n OR (2 * r = n AND q % 2 = 1) THEN 1 ELSE 0 END), ''
                                                   ORDER BY ty, tx, c))) AS pixels
              FROM small GROUP BY page_id)
            SELECT 'p' || page_id || '.bmp' AS file, 'ok' AS status, NULL AS error, th AS height, tw AS width, 3 AS "nChannels", pixels
            FROM s JOIN done USING (page_id)
            UNION ALL SELECT 'p' || page_id || '.bmp', 'error', 'not an image', NULL, NULL, NULL, NULL FROM pages WHERE contains(url, '?')""",
        "terminate_stream": f"""WITH {_MESSAGES},
            stops AS (SELECT to_id, min(ts) AS stop FROM messages
                      WHERE type = 'terminate' AND ts >= TIMESTAMP '{d.STOP_FROM}' GROUP BY ALL),
            starts AS (SELECT *, seq % 10 = 0 AND to_id = 'manager3' AS stuck
                       FROM messages LEFT JOIN stops USING (to_id) WHERE type = 'start_job')
            SELECT CASE WHEN stop IS NULL OR ts < stop THEN 'accepted' ELSE 'refused' END AS event, msg_id, to_id,
                   CAST(NULL AS BIGINT) AS at FROM starts
            UNION ALL
            SELECT 'drained', NULL, to_id,
                   epoch_us(greatest(stop, (SELECT max(ts) + INTERVAL 1 HOUR FROM starts s WHERE s.to_id = stops.to_id AND s.ts < s.stop)))
            FROM stops
            WHERE NOT EXISTS (SELECT 1 FROM starts s WHERE s.to_id = stops.to_id AND s.ts < s.stop AND s.stuck)""",
        "pending_messages_stream": f"""WITH {_MESSAGES}
            SELECT to_id, count(*) AS n FROM messages
            WHERE type IS NULL OR type NOT IN ('thumbnail_ended', 'error_work') OR seq % 7 = 6 GROUP BY to_id""",
        "worker_chain_stream": r"""SELECT page_id AS seq, CASE WHEN len(p) >= 2 THEN 'ok' ELSE 'error' END AS type,
            url AS item, CASE WHEN len(p) >= 2 THEN p[2] END AS thumb, string_split(url, '/')[3] AS job_id
            FROM (SELECT page_id, url,
                  string_split(trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/') AS p FROM pages)""",
        "process_items": r"""SELECT page_id, url AS item,
            CASE WHEN len(p) >= 2 THEN 'ok' ELSE 'error' END AS status, CASE WHEN len(p) >= 2 THEN p[2] END AS result,
            CASE WHEN len(p) < 2 THEN 'no second part' END AS error
            FROM (SELECT page_id, url,
                  string_split(trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/') AS p FROM pages)""",
        "track_jobs_stream": """SELECT 'j' || (user_id % 10) AS job_id, count(*) AS total,
            count(*) FILTER (event_type NOT IN ('error', 'signup')) AS done, count(*) FILTER (event_type = 'error') AS failed,
            count(*) FILTER (event_type = 'signup') AS unfinished, count(*) FILTER (event_type = 'signup') = 0 AS complete,
            CASE WHEN count(*) FILTER (event_type = 'signup') = 0 THEN max(event_id) + 1000000000000 END AS completed_at
            FROM events GROUP BY ALL""",
        "running_worker_stats_stream": _STATS,
        "dedupe_stream": f"WITH {_MESSAGES} SELECT msg_id, type, body FROM messages",
    }
    found["match_results_stream"] = found["match_results"]
    if LLM:
        found |= LLM.oracle_sql()
    if PIPELINE and PIPELINE.ORACLE_SQL:
        found["pipeline"] = PIPELINE.ORACLE_SQL
    return found
