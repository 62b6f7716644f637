"""Work tracking: messages, jobs, results and workers as frames.

``jobs``     job_id, submit_seq (unique per job), item; one row per copy of an item, one row
             with a NULL item for an empty job
``results``  seq (unique), type (``ok`` or ``error``), item, thumb
``matched``  results with the job each was credited to, NULL if none
``work``     worker, seq (unique), url, start_ts, ms, status (``ok`` or ``error``), error
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text
from .keyed import HOT_ROWS, hot_keys, lookup, running_total, spread_join

# Message types.
START_JOB = "start_job"
JOB_ENDED = "job_ended"
TERMINATE = "terminate"
FINISHED_WORK = "thumbnail_ended"
INIT_WORK = "init_url_thumb"
ERROR_WORK = "error_work"

# Type of our own: a job that was sent after its manager's stop.
REFUSED = "job_refused"

# Fixed value: the manager's address.
MANAGER = "remote_manager"

OK = "ok"
ERROR = "error"
RETRY = "retry"

COPY_CHUNK = 4096

# Milliseconds are summed up to a billionth.
EXACT_MS = "decimal(28,9)"


# ---- messages --------------------------------------------------------------------------

def dedupe_messages(messages: DataFrame) -> DataFrame:
    """The first delivery of every message; ``seq`` orders deliveries."""
    rest = [c for c in messages.columns if c not in ("msg_id", "seq")]
    first = F.min(F.struct("seq", *rest)).alias("_m")
    return messages.groupBy("msg_id").agg(first).select(
        *[("msg_id" if c == "msg_id" else F.col(f"_m.{c}").alias(c)) for c in messages.columns]
    )


def addressed_to(messages: DataFrame, uid: str) -> DataFrame:
    return messages.where(F.col("to_id") == uid)


def with_route(messages: DataFrame) -> DataFrame:
    """Where the manager sends a message: ``route`` is ``reject`` for a missing type and
    ``ignore`` for a type it does not handle."""
    kind = F.col("type")
    return messages.withColumn(
        "route",
        F.when(kind.isNull(), "reject")
        .when(kind == START_JOB, "start")
        .when(kind == FINISHED_WORK, "finished")
        .when(kind == ERROR_WORK, "error")
        .when(kind == TERMINATE, "terminate")
        .otherwise("ignore"),
    )


def dispatch_by_type(messages: DataFrame) -> dict[str, DataFrame]:
    routed = with_route(messages)
    routes = ("start", "finished", "error", "terminate", "reject")
    return {r: routed.where(F.col("route") == r).drop("route") for r in routes}


def accept_jobs(messages: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Start messages, with ``accepted`` false once their recipient was told to terminate."""
    starts = messages.where(F.col("type") == START_JOB)
    stops = (
        messages.where(F.col("type") == TERMINATE).groupBy("to_id").agg(F.min("ts").alias("_stop"))
    )
    cut = lookup(starts, stops, ["to_id"], hot_rows=hot_rows)
    return cut.withColumn("accepted", F.col("_stop").isNull() | (F.col("ts") < F.col("_stop"))).drop(
        "_stop"
    )


def refusals(messages: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """A reply to the sender of each start message that came after its recipient's stop."""
    refused = accept_jobs(messages, hot_rows).where(~F.col("accepted"))
    return refused.select(
        F.concat("msg_id", F.lit("-refused")).alias("msg_id"), "seq", "ts",
        F.col("to_id").alias("from_id"), F.col("from_id").alias("to_id"),
        F.lit(REFUSED).alias("type"), "job_id", "body",
    )


def parse_results(messages: DataFrame) -> DataFrame:
    """Worker replies as results; ``item`` is NULL if a finished reply has no separator."""
    item, thumb = text.split_first(F.col("body"))
    done = F.col("type") == FINISHED_WORK
    return messages.where(done | (F.col("type") == ERROR_WORK)).select(
        "seq",
        "job_id",
        F.when(done, OK).otherwise(ERROR).alias("type"),
        F.when(done, item).otherwise(F.col("body")).alias("item"),
        F.when(done, thumb).alias("thumb"),
    )


def pending_messages(sent: DataFrame, handled: DataFrame) -> DataFrame:
    """Messages sent and not yet handled."""
    return sent.join(handled.select("msg_id"), "msg_id", "left_anti")


# ---- jobs and results ------------------------------------------------------------------

def match_results(jobs: DataFrame, results: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Credit each result to the first submitted job that has a copy of its item left.

    A result without an item, as from a malformed reply, belongs to no job.

    The k-th result of an item takes the item's k-th copy, so both sides are numbered per
    item and joined on (item, number), a key that is unique on both sides.
    """
    claims = (
        jobs.where(F.col("item").isNotNull())
        .groupBy("item", "submit_seq", "job_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    claims = running_total(claims, ["item"], "submit_seq", F.col("_n"), "_last", hot_rows)
    claims = claims.withColumn("_first", F.col("_last") - F.col("_n") + 1)
    copies = _chunks(claims, ["item"]).select(
        "item", "job_id", F.explode(F.sequence("_from", "_to")).alias("_k")
    )
    columns = [c for c in results.columns if c != "job_id"]
    numbered = running_total(
        results.select(*columns).where(F.col("item").isNotNull()),
        ["item"], "seq", F.lit(1).cast("bigint"), "_k", hot_rows,
    )
    # By merge: the claims look small to the planner, which would broadcast all their copies.
    found = numbered.join(copies.hint("merge"), ["item", "_k"], "left").select(*columns, "job_id")
    nameless = results.select(*columns).where(F.col("item").isNull())
    return found.unionByName(nameless.withColumn("job_id", F.lit(None).cast(found.schema["job_id"].dataType)))


def unmatched_results(matched: DataFrame) -> DataFrame:
    return matched.where(F.col("job_id").isNull())


def expand_jobs(
    starts: DataFrame, item_lists: DataFrame, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Jobs and work orders of start messages, whose ``body`` names an item list.

    ``item_lists`` has (list, item), a row without item for an empty list. An empty or missing
    list makes an empty job. Each copy of an item gets an order of its own; its msg_id
    follows from the start message, the item and the copy's number, so a repeated run sends
    the same orders.
    """
    asked = starts.where(F.col("type") == START_JOB).select(
        "msg_id", F.col("job_id"), F.col("seq").alias("submit_seq"), "ts", F.col("to_id").alias("manager"),
        F.col("body").alias("list"),
    )
    sized = item_lists.where(F.col("item").isNotNull()).groupBy("list", "item").agg(F.count(F.lit(1)).alias("_n"))
    found = spread_join(
        sized, asked, ["list"], hot_keys(sized, ["list"], hot_rows), None, ["item"], ["msg_id"]
    )
    empty = asked.join(sized.select("list").distinct(), "list", "left_anti").withColumns(
        {"item": F.lit(None).cast("string"), "_n": F.lit(1).cast("bigint")}
    )
    rows = found.unionByName(empty)
    copies = _chunks(rows.withColumns({"_first": F.lit(1).cast("bigint"), "_last": F.col("_n")}), ["msg_id", "item"])
    each = copies.withColumn("_k", F.explode(F.sequence("_from", "_to")))
    orders = each.where(F.col("item").isNotNull()).select(
        F.concat_ws("-", "msg_id", F.md5("item"), F.col("_k").cast("string")).alias("msg_id"),
        F.col("submit_seq").alias("seq"), "ts", F.col("manager").alias("from_id"), F.lit("*").alias("to_id"),
        F.lit(INIT_WORK).alias("type"), "job_id", F.col("item").alias("body"),
    )
    return each.select("job_id", "submit_seq", "item"), orders


def _chunks(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows with numbers ``_first`` to ``_last`` as chunks ``_from`` to ``_to`` of at most
    COPY_CHUNK numbers; the chunks of a long row are spread out again."""
    long = F.col("_last") - F.col("_first") >= COPY_CHUNK
    few = rows.where(~long).withColumns({"_from": F.col("_first"), "_to": F.col("_last")})
    many = (
        rows.where(long)
        .withColumn("_from", F.explode(F.sequence("_first", "_last", F.lit(COPY_CHUNK).cast("bigint"))))
        .repartition(*key, "_from")
        .withColumn("_to", F.least(F.col("_from") + COPY_CHUNK - 1, F.col("_last")))
    )
    return few.unionByName(many)


def summary_place(base: str, job_id: Column) -> Column:
    """Where ``write_summaries`` puts a job's summary."""
    return F.concat(F.lit(f"{base}/job_id="), job_id)


def completed_jobs(progress: DataFrame, summaries: str) -> DataFrame:
    """One JOB_ENDED row per complete job: when its last result came (NULL for an empty
    job), and where its summary is."""
    return progress.where("complete").select(
        "job_id", F.lit(JOB_ENDED).alias("type"), F.col("completed_at").alias("seq"),
        summary_place(summaries, F.col("job_id")).alias("body"),
    )


def job_progress(jobs: DataFrame, matched: DataFrame) -> DataFrame:
    """Per job: items, done, failed, unfinished, and the result that completed it.

    A job without unfinished items is complete, so an empty job is complete at once.
    """
    zero = F.lit(0).cast("bigint")

    def one(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0).cast("bigint")

    submitted = jobs.select(
        "job_id", one(F.col("item").isNotNull()).alias("total"), zero.alias("done"),
        zero.alias("failed"), F.lit(None).cast("bigint").alias("seq"),
    )
    returned = matched.where(F.col("job_id").isNotNull()).select(
        "job_id", zero.alias("total"), one(F.col("type") == OK).alias("done"),
        one(F.col("type") == ERROR).alias("failed"), F.col("seq").cast("bigint").alias("seq"),
    )
    return progress_of(submitted.unionByName(returned))


def progress_of(parts: DataFrame) -> DataFrame:
    """Add up ``(job_id, total, done, failed, seq)`` rows per job."""
    sums = parts.groupBy("job_id").agg(
        F.sum("total").alias("total"), F.sum("done").alias("done"),
        F.sum("failed").alias("failed"), F.max("seq").alias("_last"),
    )
    left = F.col("total") - F.col("done") - F.col("failed")
    return sums.select(
        "job_id", "total", "done", "failed", left.alias("unfinished"),
        (left == 0).alias("complete"), F.when(left == 0, F.col("_last")).alias("completed_at"),
    )


def running_items(progress: DataFrame) -> DataFrame:
    """Items not finished over all jobs, in one row."""
    return progress.agg(
        F.coalesce(F.sum("unfinished"), F.lit(0)).alias("running"),
        F.count_if(~F.col("complete")).alias("open_jobs"),
    )


def summary_lines(
    jobs: DataFrame, matched: DataFrame, complete_only: bool = True, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``item;thumb`` per finished item, as ``(job_id, seq, item, thumb, line)``.

    Lines of a job are in order of ``seq``. Jobs still running have no summary yet; a finished
    job without a finished item has one empty line, with nothing but the job's id.
    """
    done = matched.where(F.col("job_id").isNotNull() & (F.col("type") == OK)).select(
        "job_id", "seq", "item", "thumb",
        text.summary_line(F.col("item"), F.col("thumb")).alias("line"),
    )
    if not complete_only:
        return done
    complete = job_progress(jobs, matched).where("complete").select(
        "job_id", F.col("done").alias("_rows"), F.lit(True).alias("_complete")
    )
    lines = lookup(
        done, complete, ["job_id"], "inner", rows="_rows", hot_rows=hot_rows
    ).drop("_complete")
    return lines.unionByName(
        complete.where(F.col("_rows") == 0).select("job_id", F.lit("").alias("line")), allowMissingColumns=True
    )


def gallery_html(summary: DataFrame, thumb_base: str) -> DataFrame:
    """HTML page lines ``(job_id, section, seq, html)``: head, one line per thumbnail, foot.

    Every job of the summary has a page, also one without a finished item.
    """
    body = summary.where(F.col("item").isNotNull()).select(
        "job_id", F.lit(1).alias("section"), "seq",
        text.gallery_line(F.col("item"), F.concat(F.lit(thumb_base), F.col("thumb"))).alias("html"),
    )
    ids = summary.select("job_id").distinct()
    frame = F.array(
        F.struct(F.lit(0).alias("section"), F.lit("<HTML>\n<HEAD>\n</HEAD>\n<BODY>").alias("html")),
        F.struct(F.lit(2).alias("section"), F.lit("</BODY>\n</HTML>").alias("html")),
    )
    ends = ids.select("job_id", F.inline(frame)).select(
        "job_id", "section", F.lit(0).cast("bigint").alias("seq"), "html"
    )
    return body.unionByName(ends)


# ---- workers ---------------------------------------------------------------------------

def worker_stats(work: DataFrame, exact: bool = False) -> DataFrame:
    """Counts and times per worker. ``avg_ms`` is the time of successful items over the
    number of all items, ``avg_ok_ms`` over the successful ones. ``exact`` sums times as decimals, so
    that the last digits depend neither on partitions nor on micro-batches."""
    ok = F.col("status") == OK
    ms = F.col("ms").cast(EXACT_MS) if exact else F.col("ms")
    start = F.col("start_ts").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(start) + (F.col("ms") * 1000).cast("bigint"))
    sums = work.groupBy("worker").agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(ok).alias("ok"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(ok, ms)), F.lit(0)).cast("double").alias("_ms"),
        F.min(start).alias("start_ts"),
        F.max(end).alias("end_ts"),
    )
    return sums.select(
        "worker", "processed", "ok", "failed",
        (F.col("_ms") / F.col("processed")).alias("avg_ms"),
        F.try_divide("_ms", "ok").alias("avg_ok_ms"),
        "start_ts", "end_ts",
    )


def worker_items(work: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each worker's ok and failed items, numbered from 0 in order of ``seq``."""
    numbered = running_total(
        work.select("worker", "status", "seq", "url", "error"),
        ["worker", "status"], "seq", F.lit(1).cast("bigint"), "idx", hot_rows,
    )
    return numbered.withColumn("idx", F.col("idx") - 1)


def worker_report(work: DataFrame, digits: int | None = None) -> DataFrame:
    """Report lines ``(worker, section, idx, line)``, to be read in that order."""
    def date(c: str) -> Column:
        return F.date_format(c, "EEE MMM dd HH:mm:ss zzz yyyy")

    avg = F.col("avg_ms").cast("string") if digits is None else F.format_string(
        f"%.{digits}f", "avg_ms"
    )
    # The wording of the report. Sections 6 and 9 hold the items.
    wording = {
        0: F.concat(F.lit("Worker {"), F.col("worker"), F.lit("}")),
        1: F.concat(F.lit("Start date  = "), date("start_ts")),
        2: F.concat(F.lit("End date = "), date("end_ts")),
        3: F.concat(F.lit("Average proccess time in MS= "), avg),
        4: F.concat(F.lit("Number of processed url = "), F.col("processed").cast("string")),
        5: F.lit("Successfull urls - "),
        7: F.lit(""),
        8: F.lit("Failed urls - "),
    }
    sections = F.array(
        *[F.struct(F.lit(k).alias("section"), v.alias("line")) for k, v in wording.items()]
    )
    frame = worker_stats(work).select("worker", F.inline(sections)).select(
        "worker", "section", F.lit(0).cast("bigint").alias("idx"), "line"
    )
    ok = F.col("status") == OK
    label = F.concat(F.col("idx").cast("string"), F.lit(": "), F.col("url"))
    reason = F.concat(F.lit(", Error reason = "), F.coalesce("error", F.lit("null")))
    items = worker_items(work).select(
        "worker", F.when(ok, 6).otherwise(9).alias("section"), "idx",
        F.when(ok, label).otherwise(F.concat(label, reason)).alias("line"),
    )
    return frame.unionByName(items)


def process_items(items: DataFrame, fn: Callable[[str], str], column: str = "item") -> DataFrame:
    """Apply ``fn`` to every item of a batch or stream.

    Adds ``status``, ``result`` and ``error``. A call that raises gives an error row, and
    never fails the task.
    """
    def run(value: str) -> tuple[str, str | None, str | None]:
        try:
            return OK, fn(value), None
        except Exception as e:
            return ERROR, None, str(e)

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = pd.DataFrame(
                [run(v) for v in frame[column]], columns=["status", "result", "error"], index=frame.index
            )
            yield pd.concat([frame, out], axis=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return items.mapInPandas(batches, f"{schema}, status string, result string, error string")


def process_column(items: DataFrame, result: Column, error: Column) -> DataFrame:
    """``process_items`` for work that Spark's functions express: ``error`` is NULL for an item
    that succeeds."""
    failed = error.isNotNull()
    return items.withColumns({
        "status": F.when(failed, ERROR).otherwise(OK),
        "result": F.when(~failed, result),
        "error": error,
    })


def route_errors(processed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Successful and failed rows."""
    return (
        processed.where(F.col("status") == OK),
        processed.where(F.col("status") == ERROR),
    )


def to_replies(processed: DataFrame, worker: str, manager: str = MANAGER) -> DataFrame:
    """Replies to the manager: ``item;result`` for a success, the item for a failure.

    An item whose result could not be stored (status RETRY) gets none: its order stays
    pending and is delivered again.
    """
    processed = processed.where(F.col("status") != RETRY)
    ok = F.col("status") == OK
    body = F.when(ok, text.summary_line(F.col("item"), F.col("result"))).otherwise(F.col("item"))
    return processed.select(
        "msg_id", "seq", "ts",
        F.lit(worker).alias("from_id"),
        F.lit(manager).alias("to_id"),
        F.when(ok, FINISHED_WORK).otherwise(ERROR_WORK).alias("type"),
        "job_id",
        body.alias("body"),
    )
