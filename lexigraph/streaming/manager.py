"""The manager as streams: crediting replies by item, ending jobs, stopping, and pending messages.

Messages may come in any order. What a message says is decided again while earlier ones can still
arrive: each decision has a row with a revision number, and ``read_latest`` keeps the last. So after
every micro-batch the latest rows are those that the batch operators give for all messages so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import text
from ..operators import tracking as ops
from ..sources import readers
from ..sinks import writers
from .state import NONE, Clock, Table, nullable, or_none, part_and_bucket, same

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS

CREDIT_SCHEMA = "item string, seq bigint, type string, thumb string, job_id string, rev int"
ENDED_SCHEMA = "job_id string, seq bigint"
STOP_SCHEMA = (
    "kind string, msg_id string, from_id string, to_id string, job_id string, body string, "
    "accepted boolean, at bigint, rev int"
)


def read_latest(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """The last revision of every row, without its number."""
    rows = spark.read.schema(schema).parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "rev")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "rev").alias("_row"))
    return last.select(*[(c if c in keys else F.col(f"_row.{c}").alias(c)) for c in rows.columns if c != "rev"])


# ---- results to jobs -------------------------------------------------------------------

class _Credits(StatefulProcessor):
    """One item: an ordered multiset of claims (submit_seq, job, copies) and the replies that may
    still be credited otherwise.

    Replies in order of seq take the copies in order of submit_seq, so a reply or job that comes
    late moves those behind it. After ``keep_ms`` a reply is settled: it leaves with the copy it
    has taken. What is left are the open copies, and nothing once there are none.
    """

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.claims = handle.getListState("claims", "submit_seq bigint, job_id string, n bigint")
        self.replies = handle.getListState(
            "replies", "seq bigint, type string, thumb string, job_id string, submit_seq bigint, rev int, arrived bigint"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        item = key[0]
        claims, replies = self._read() if item is not None else ({}, {})
        for batch in rows:  # the trigger bounds the bytes of a micro-batch
            for kind, seq, job, thumb in zip(batch["type"], batch["seq"], batch["job_id"], batch["thumb"]):
                if kind == ops.INIT_WORK:
                    claims[seq, job] = claims.get((seq, job), 0) + 1
                elif seq not in replies:
                    replies[seq] = [kind, thumb, None, None, 0, now]
        changed = []
        for seq, reply, job, submitted in self._credited(claims, replies):
            if reply[4] == 0 or (job, submitted) != (reply[2], reply[3]):
                reply[2:5] = [job, submitted, reply[4] + 1]
                changed.append((item, seq, reply[0], reply[1], job, reply[4]))
        if item is not None:
            self._write(claims, replies, now)
            if replies:
                self.handle.registerTimer(now + self.keep_ms + 1)
        columns = ["item", "seq", "type", "thumb", "job_id", "rev"]
        yield pd.DataFrame(changed, columns=columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._write(*self._read(), timerValues.getCurrentProcessingTimeInMs())
        return iter(())

    @staticmethod
    def _credited(claims: dict, replies: dict) -> Iterator[tuple]:
        queue = iter(sorted(claims.items()))
        claim, left = (None, None), 0
        for seq in sorted(replies):
            while left == 0:
                (submitted, job), left = next(queue, ((None, None), -1))
                claim = (job, submitted)
            left -= 1  # below zero for ever once no copy is left
            yield seq, replies[seq], *claim

    def _read(self) -> tuple[dict, dict]:
        claims = {(s, j): n for s, j, n in self.claims.get()}
        return claims, {r[0]: list(r[1:]) for r in self.replies.get()}

    def _write(self, claims: dict, replies: dict, now: int) -> None:
        open_, kept = dict(claims), []
        for seq, (kind, thumb, job, submitted, rev, arrived) in replies.items():
            if arrived + self.keep_ms >= now:
                kept.append((seq, kind, thumb, job, submitted, rev, arrived))
            elif job is not None:
                open_[submitted, job] -= 1
        left = [(s, j, n) for (s, j), n in open_.items() if n > 0]
        for state, values in ((self.claims, left), (self.replies, kept)):
            if values:
                state.put(values)
            else:
                state.clear()

    def close(self) -> None:
        pass


class _PartCredits(StatefulProcessor):
    """``_Credits`` for the items of one part: an ordered multiset of claims (submit_seq, job, copies) each, and the
    replies that may still be credited otherwise.

    Replies in order of seq take the copies in order of submit_seq, so a reply or job that comes
    late moves those behind it. After ``keep_ms`` a reply is settled: it leaves with the copy it
    has taken. What is left are the open copies, and nothing once there are none.
    """

    CLAIMS = pa.schema([
        ("bucket", pa.int32()), ("item", pa.string()), ("submit_seq", pa.int64()), ("job_id", pa.string()), ("n", pa.int64()),
    ])
    REPLIES = pa.schema([
        ("bucket", pa.int32()), ("item", pa.string()), ("seq", pa.int64()), ("type", pa.string()), ("thumb", pa.string()),
        ("submit_seq", pa.int64()), ("job_id", pa.string()), ("rev", pa.int32()), ("arrived", pa.int64()),
    ])

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.claims = Table(handle, "claims", self.CLAIMS)
        self.replies = Table(handle, "replies", self.REPLIES)
        self.clock = Clock(handle, self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        batch = pd.concat(list(rows), ignore_index=True)  # the trigger bounds the bytes of a micro-batch
        order = (batch["type"] == ops.INIT_WORK).to_numpy()
        orders = batch[order].rename(columns={"seq": "submit_seq"}).assign(n=1)
        arrived = batch[~order].assign(submit_seq=NONE, rev=0, arrived=now, job_id=None)
        nameless = arrived["item"].isna()
        # what names no item is credited to none, and leaves no state
        none = arrived[nameless].drop_duplicates("seq").assign(rev=1)
        arrived = arrived[~nameless]
        changed = [none]
        buckets = np.unique(np.concatenate([orders["bucket"], arrived["bucket"]]))
        if len(buckets):
            stored = self.replies.read(buckets)
            replies = pd.concat([stored, arrived[self.REPLIES.names]], ignore_index=True) if len(stored) else arrived
            # the one that came first
            replies = replies.drop_duplicates(["item", "seq"]).sort_values(["item", "seq"], ignore_index=True)
            claims = self._claims(orders, buckets)
            job, submitted = self._credited(claims, replies)
            moved = (replies["rev"] == 0).to_numpy() | ~same(job, replies["job_id"]) | (submitted != replies["submit_seq"].to_numpy())
            replies = replies.assign(job_id=job, submit_seq=submitted, rev=replies["rev"] + moved)
            changed.append(replies[moved])
            self._write(claims, replies, buckets, now)
            if len(replies):
                self.clock.wind(now)
        out = pd.concat(changed, ignore_index=True)
        yield pd.DataFrame({
            "item": out["item"], "seq": nullable(out["seq"]), "type": out["type"], "thumb": out["thumb"],
            "job_id": out["job_id"], "rev": out["rev"].astype("int32"),
        })

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        claims, replies = self.claims.read(), self.replies.read()
        left = self._write(claims, replies, np.union1d(claims["bucket"], replies["bucket"]), now)
        self.clock.rang(now, again=left > 0)
        return iter(())

    def _claims(self, orders: pd.DataFrame, buckets: np.ndarray) -> pd.DataFrame:
        """Copies per item, submit_seq and job, in this order, with those in the state."""
        stored = self.claims.read(buckets)
        claims = pd.concat([stored, orders[self.CLAIMS.names]], ignore_index=True) if len(stored) else orders
        keys = ["item", "submit_seq", "job_id"]
        return claims.groupby(keys, dropna=False).agg(bucket=("bucket", "first"), n=("n", "sum")).reset_index()

    @staticmethod
    def _credited(claims: pd.DataFrame, replies: pd.DataFrame) -> tuple[pd.Series, np.ndarray]:
        """Job and submit_seq of the copy that each reply takes."""
        items = pd.factorize(pd.concat([claims["item"], replies["item"]], ignore_index=True), sort=True)[0].astype("int64")
        claimed, replied = items[:len(claims)], items[len(claims):]
        place = replies.groupby(replied).cumcount().to_numpy() if len(replies) else np.zeros(0, "int64")
        # the number of an item's last copy up to each claim, items one after the other
        last = claims["n"].groupby(claimed).cumsum().to_numpy().astype("int64")
        width = max(last.max(initial=0), place.max(initial=0)) + 1
        at = np.searchsorted(claimed * width + last, replied * width + place, "right")
        found = at < len(claims)
        at = np.where(found, at, 0)
        if len(claims):
            found &= claimed[at] == replied
        job = pd.Series(None, index=replies.index, dtype=object)
        submitted = np.full(len(replies), NONE)
        if found.any():
            job = pd.Series(np.where(found, claims["job_id"].to_numpy(dtype=object)[at], None), index=replies.index, dtype=object)
            submitted = np.where(found, claims["submit_seq"].to_numpy()[at], NONE)
        return job, submitted

    def _write(self, claims: pd.DataFrame, replies: pd.DataFrame, buckets: np.ndarray, now: int) -> int:
        """Settle what has been kept long enough; the number of replies that are left."""
        kept = (replies["arrived"] + self.keep_ms >= now).to_numpy()
        taken = replies[~kept & replies["job_id"].notna().to_numpy()]
        if len(taken):
            keys = ["item", "submit_seq", "job_id"]
            n = taken.groupby(keys).size().rename("_taken").reset_index()
            claims = claims.merge(n, "left", keys)
            claims["n"] = claims["n"] - claims["_taken"].fillna(0).astype("int64")
        self.claims.write(claims[claims["n"] > 0], buckets)
        self.replies.write(replies[kept], buckets)
        return int(kept.sum())

    def close(self) -> None:
        pass


def match_results_stream(
    messages: DataFrame, keep_ms: int = HOUR_MS, parts: int | None = None, by_item: bool = False
) -> DataFrame:
    """``match_results`` of a stream of orders and replies, which need no job id.

    An order's ``seq`` is its job's submit_seq, as ``expand_jobs`` makes it; a reply's is its own.
    Repeats are to be dropped before. Rows are for ``read_latest`` by seq. Decisions stay open for
    ``keep_ms`` after a reply came. State is held by hash parts of the items, as a group of its own
    costs more than most items' few rows; an item is one queue, so what a task holds of it are its
    open jobs, and the replies of that time. ``by_item`` makes each item a group all the same, for few
    items. The session must use the RocksDB state store (``use_rocksdb``).
    """
    if parts is None:
        parts = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    item, thumb = text.split_first(F.col("body"))
    done = F.col("type") == ops.FINISHED_WORK
    order = F.col("type") == ops.INIT_WORK
    rows = messages.where(F.col("type").isin(ops.INIT_WORK, ops.FINISHED_WORK, ops.ERROR_WORK)).select(
        F.when(done, item).otherwise(F.col("body")).alias("item"), "seq",
        F.when(order, ops.INIT_WORK).when(done, ops.OK).otherwise(ops.ERROR).alias("type"),
        F.when(order, F.col("job_id")).alias("job_id"), F.when(done, thumb).alias("thumb"),
    )
    nameless = F.col("item").isNull()
    # replies that name no item are spread by their own number
    key = F.when(nameless, F.col("seq").cast("string")).otherwise(F.col("item"))
    # an order without an item claims nothing
    claiming = rows.where(~(nameless & (F.col("type") == ops.INIT_WORK))).withColumn("key", key)
    if not by_item:
        claiming = claiming.withColumn("seq", or_none(F.col("seq")))
    placed = claiming.select("*", *part_and_bucket("key", parts=parts)).drop("key")
    if by_item:
        part = F.when(nameless, F.col("part")).otherwise(0).alias("part")
        grouped, processor = placed.withColumn("part", part).groupBy("item", "part"), _Credits(keep_ms)
    else:
        grouped, processor = placed.groupBy("part"), _PartCredits(keep_ms)
    return grouped.transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=CREDIT_SCHEMA, outputMode="Append",
        timeMode="ProcessingTime",
    )


def read_matched(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``match_results`` from the written ones of ``match_results_stream``."""
    return read_latest(spark, path, CREDIT_SCHEMA, ["seq"]).select("seq", "type", "item", "thumb", "job_id")


# ---- completion ------------------------------------------------------------------------

class _Ending(StatefulProcessor):
    """Jobs of one part: how many items each has and how many are answered, until it ends. Then only
    a flag stays, for ``keep_ms``, so that repeats and late answers find no job to open again."""

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "job_id string", "total bigint, answered bigint, last bigint")
        self.ended = handle.getMapState("ended", "job_id string", "at bigint", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        batch = pd.concat(list(rows))  # one micro-batch of one part; the trigger bounds its bytes
        sums = batch.groupby("job_id").agg(total=("total", "max"), answered=("answered", "sum"), last=("last", "max"))
        done = []
        for job, total, answered, last in sums.itertuples():
            stored = self.counts.getValue((job,))
            if stored is None and self.ended.getValue((job,)) is not None:
                continue
            before = stored or (None, 0, None)
            total = before[0] if pd.isna(total) else int(total)
            answered = before[1] + int(answered)
            last = max((x for x in (before[2], None if pd.isna(last) else int(last)) if x is not None), default=None)
            if total is not None and answered >= total:
                if stored is not None:
                    self.counts.removeKey((job,))
                self.ended.updateValue((job,), (now,))
                done.append((job, last))
            else:
                self.counts.updateValue((job,), (total, answered, last))
        yield pd.DataFrame(done, columns=["job_id", "seq"]).astype({"seq": "Int64"})

    def close(self) -> None:
        pass


class _PartEnding(StatefulProcessor):
    """``_Ending`` with the jobs of a bucket as one value."""

    SCHEMA = pa.schema([
        ("bucket", pa.int32()), ("job_id", pa.string()), ("total", pa.int64()), ("answered", pa.int64()),
        ("last", pa.int64()), ("ended", pa.int64()),
    ])

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.jobs = Table(handle, "jobs", self.SCHEMA)
        self.clock = Clock(handle, self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        batch = pd.concat(list(rows), ignore_index=True)  # one micro-batch of one part; the trigger bounds its bytes
        buckets = np.unique(batch["bucket"])
        stored = self._fresh(self.jobs.read(buckets), now)
        over = stored["ended"] != NONE
        late = batch["job_id"].isin(stored.loc[over, "job_id"])
        both = pd.concat([stored[~over].assign(given=False), batch[~late].assign(ended=NONE, given=True)], ignore_index=True)
        # the total of this batch goes before the stored one
        both["given"] &= both["total"] != NONE
        total = both[both["given"]].groupby("job_id")["total"].max()
        jobs = both.groupby("job_id", sort=False).agg(
            bucket=("bucket", "first"), total=("total", "max"), answered=("answered", "sum"), last=("last", "max"), ended=("ended", "first"),
        )
        jobs.loc[total.index, "total"] = total
        done = (jobs["total"] != NONE) & (jobs["answered"] >= jobs["total"]) & jobs.index.isin(batch["job_id"])
        jobs.loc[done, "ended"] = now
        self.jobs.write(pd.concat([stored[over], jobs.reset_index()], ignore_index=True), buckets)
        if done.any():
            self.clock.wind(now)
        yield pd.DataFrame({"job_id": jobs.index[done].to_numpy(dtype=object), "seq": nullable(jobs.loc[done, "last"]).array})

    def _fresh(self, jobs: pd.DataFrame, now: int) -> pd.DataFrame:
        return jobs[(jobs["ended"] == NONE) | (jobs["ended"] + self.keep_ms >= now)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        jobs = self.jobs.read()
        fresh = self._fresh(jobs, now)
        self.jobs.write(fresh, np.unique(jobs["bucket"]))
        self.clock.rang(now, again=bool((fresh["ended"] != NONE).any()))
        return iter(())

    def close(self) -> None:
        pass


def end_jobs(outcomes: DataFrame, keep_ms: int = DAY_MS, parts: int | None = None, by_job: bool = False) -> DataFrame:
    """(job_id, seq) of every job, once, in the micro-batch that completes it.

    ``outcomes`` are those of ``match_stream``: a start's item is the number of the job's items,
    answers count, and orders and alerts don't, so they make no state. State is kept for open
    jobs, and a flag for jobs that ended within ``keep_ms``; it is held by hash parts of the jobs,
    as a group of its own costs more than a job's few numbers. ``by_job`` makes each job a value of its
    own in its part's state, for micro-batches of few jobs.
    """
    answered = F.col("outcome").isin("done", "failed")
    started = F.col("outcome") == "started"
    if parts is None:
        parts = int(outcomes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = F.when(started, text.whole_number(F.col("item"))).cast("bigint")
    rows = outcomes.where(answered | started).select(
        *part_and_bucket("job_id", parts=parts), "job_id", total.alias("total"),
        F.when(answered, 1).otherwise(0).cast("bigint").alias("answered"), F.when(answered, F.col("seq")).alias("last"),
    )
    if not by_job:
        rows = rows.withColumns({c: or_none(F.col(c)) for c in ("total", "last")})
    return rows.groupBy("part").transformWithStateInPandas(
        statefulProcessor=_Ending(keep_ms) if by_job else _PartEnding(keep_ms), outputStructType=ENDED_SCHEMA, outputMode="Append",
        timeMode="ProcessingTime",
    )


# ---- stop, drain, stopped --------------------------------------------------------------

class _Stopping(StatefulProcessor):
    """One manager: when it was told to stop, its jobs, and how many accepted ones are open."""

    JOBS = pa.schema([
        ("bucket", pa.int32()), ("job", pa.string()), ("msg_id", pa.string()), ("from_id", pa.string()), ("body", pa.string()),
        ("start", pa.int64()), ("end", pa.int64()), ("accepted", pa.int8()), ("rev", pa.int32()), ("arrived", pa.int64()),
    ])

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.jobs = Table(handle, "jobs", self.JOBS)
        # n_open, last_end: of accepted jobs
        self.tally = handle.getValueState("tally", "stop bigint, n_open bigint, last_end bigint, at bigint, rev int")
        self.clock = Clock(handle, self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        stop, n_open, last_end, at, rev = self.tally.get() or (None, 0, None, None, 0)
        batch = pd.concat(list(rows), ignore_index=True)  # the trigger bounds the bytes of a micro-batch
        batch = batch[batch["ts"] != NONE]
        told = batch["type"] == ops.TERMINATE
        earliest = min((t for t in (stop, *batch.loc[told, "ts"].nsmallest(1)) if t is not None), default=None)
        earliest = None if earliest is None else int(earliest)
        touched = batch[~told]
        # an earlier stop refuses jobs that were accepted before
        again = earliest != stop
        stored = self.jobs.read(None if again else np.unique(touched["bucket"]))
        buckets = np.union1d(stored["bucket"], touched["bucket"])
        jobs = self._merged(stored, touched, now)
        before = jobs["accepted"].to_numpy()
        begun = (jobs["start"] != NONE).to_numpy()
        accepted = np.where(begun, 1 if earliest is None else (jobs["start"] < earliest).to_numpy().astype("int8"), -1)
        changed = accepted != before
        jobs = jobs.assign(accepted=accepted.astype("int8"), rev=jobs["rev"] + changed)
        if again:
            n_open, last_end = 0, None
        else:
            # counted again as they are now
            n_open -= int(((stored["accepted"] == 1) & (stored["end"] == NONE)).sum())
        running = (accepted == 1) & (jobs["end"] == NONE).to_numpy()
        n_open += int(running.sum())
        ends = jobs["end"].to_numpy()[(accepted == 1) & ~running]
        last_end = max((t for t in (last_end, int(ends.max()) if len(ends) else None) if t is not None), default=None)
        self.jobs.write(jobs, buckets)
        moved = jobs[changed]
        out = pd.DataFrame({
            "kind": "start", "msg_id": moved["msg_id"], "from_id": moved["from_id"], "to_id": key[0], "job_id": moved["job"],
            "body": moved["body"], "accepted": (moved["accepted"] == 1).astype("boolean"), "at": moved["start"].astype("Int64"),
            "rev": moved["rev"].astype("int32"),
        })
        drained = max(earliest, last_end or earliest) if earliest is not None and n_open == 0 else None
        if drained != at:
            rev += 1
            row = pd.DataFrame({
                "kind": ["drained"], "msg_id": [None], "from_id": [None], "to_id": [key[0]], "job_id": [None], "body": [None],
                "accepted": pd.array([None], "boolean"), "at": pd.array([drained], "Int64"), "rev": np.array([rev], "int32"),
            })
            out = pd.concat([out, row], ignore_index=True) if len(out) else row
        self.tally.update((earliest, n_open, last_end, drained, rev))
        self.clock.wind(now)
        yield out

    def _merged(self, stored: pd.DataFrame, touched: pd.DataFrame, now: int) -> pd.DataFrame:
        """The stored jobs with the first start and the earliest end of each job of a batch."""
        starting = touched["type"] == ops.START_JOB
        start = touched[starting].drop_duplicates("job").rename(columns={"ts": "start"})
        end = touched[~starting].groupby("job", sort=False).agg(bucket=("bucket", "first"), end=("ts", "min")).reset_index()
        blank = {"msg_id": None, "from_id": None, "body": None, "start": NONE, "end": NONE, "accepted": -1, "rev": 0, "arrived": now}
        rows = [stored, *(x.assign(**{k: v for k, v in blank.items() if k not in x})[self.JOBS.names] for x in (start, end))]
        rows = pd.concat([r for r in rows if len(r)] or rows[:1], ignore_index=True)
        ends = rows["end"].mask(rows["end"] == NONE, -(NONE + 1)).groupby(rows["job"], dropna=False).min()
        # the stored row comes first, then the first start
        begun = rows[rows["start"] != NONE].drop_duplicates("job")
        rest = rows[~rows["job"].isin(begun["job"])].drop_duplicates("job")
        seen = rows.drop_duplicates("job").set_index("job")
        jobs = pd.concat([begun, rest]) if len(rest) else begun
        known = seen.loc[jobs["job"]]
        found = ends.loc[jobs["job"]].to_numpy()
        return jobs.assign(
            end=np.where(found == -(NONE + 1), NONE, found),
            **{c: known[c].to_numpy() for c in ("accepted", "rev", "arrived")},
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Jobs that have ended, or were refused, are settled."""
        now = timerValues.getCurrentProcessingTimeInMs()
        jobs = self.jobs.read()
        over = (jobs["end"] != NONE) | (jobs["accepted"] != 1)
        kept = jobs[~((jobs["arrived"] < now - self.keep_ms) & (jobs["start"] != NONE) & over)]
        self.jobs.write(kept, np.unique(jobs["bucket"]))
        self.clock.rang(now, again=len(kept) > 0)
        return iter(())

    def close(self) -> None:
        pass


# Buckets of a manager's jobs.
JOB_BUCKETS = 256


def terminate_stream(messages: DataFrame, keep_ms: int = DAY_MS) -> DataFrame:
    """Whether a manager accepts each start, and when it is drained.

    A start is accepted if it was sent before the first stop. A manager is drained when it was told
    to stop and every accepted job has ended (a JOB_ENDED message with its job_id). Messages may
    come in any order; rows are for ``read_starts`` and ``read_drained``.
    """
    rows = messages.where(
        F.col("to_id").isNotNull() & F.col("type").isin(ops.START_JOB, ops.TERMINATE, ops.JOB_ENDED)
    ).select(
        "to_id", "type", or_none(F.unix_micros("ts")).alias("ts"), "msg_id", "from_id", "body",
        F.coalesce("job_id", "msg_id").alias("job"),
    )
    _, bucket = part_and_bucket("job", parts=1, buckets=JOB_BUCKETS)
    return rows.withColumn("bucket", bucket).groupBy("to_id").transformWithStateInPandas(
        statefulProcessor=_Stopping(keep_ms), outputStructType=STOP_SCHEMA, outputMode="Append",
        timeMode="ProcessingTime",
    )


def read_starts(spark: SparkSession, path: str) -> DataFrame:
    """msg_id, from_id, to_id, job_id, body, accepted of every start."""
    rows = read_latest(spark, path, STOP_SCHEMA, ["kind", "to_id", "msg_id"]).where("kind = 'start'")
    return rows.select("msg_id", "from_id", "to_id", "job_id", "body", "accepted")


def read_drained(spark: SparkSession, path: str) -> DataFrame:
    """(to_id, at) of the managers that are drained, in microseconds."""
    rows = read_latest(spark, path, STOP_SCHEMA, ["kind", "to_id", "msg_id"])
    return rows.where("kind = 'drained' AND at IS NOT NULL").select("to_id", "at")


# ---- pending messages ------------------------------------------------------------------

def pending_messages_stream(sent: DataFrame, handled: DataFrame, within: str, late: str) -> DataFrame:
    """Messages that were not handled ``within`` a time of being sent.

    ``sent`` and ``handled`` are streams with ``msg_id`` and ``ts``. A message is handed out when the
    time of both streams has passed its own by ``within`` and ``late``, by which rows may be out
    of order; until then it is state, and after that it is not.
    """
    a = sent.withWatermark("ts", late).alias("a")
    b = handled.select(F.col("msg_id").alias("_done"), F.col("ts").alias("_at")).withWatermark("_at", late)
    near = F.expr(f"_done = a.msg_id AND _at >= a.ts AND _at <= a.ts + INTERVAL {within}")
    return a.join(b, near, "leftOuter").where(F.col("_done").isNull()).drop("_done", "_at")


# ---- orders to results, with restart ---------------------------------------------------

def work_stream(orders: DataFrame, result: Column, error: Column, worker: str) -> DataFrame:
    """A worker between two queues: each order's reply, by ``process_column``.

    ``result`` and ``error`` refer to ``item``. A reply's id follows from its order's, so that work
    done twice sends the same message. The order's number is kept, and replies name no job.
    """
    items = orders.where(F.col("type") == ops.INIT_WORK).withColumn("item", F.col("body"))
    replies = ops.to_replies(ops.process_column(items, result, error), worker)
    return replies.withColumns({
        "msg_id": F.concat("msg_id", F.lit("-reply")), "job_id": F.lit(None).cast("string"),
    })


def run_worker(
    spark: SparkSession, inbox: str, outbox: str, checkpoint: str, result: Column, error: Column, seq: Column,
    worker: str = "worker", files_per_trigger: int = 1,
) -> StreamingQuery:
    """Answer what is in ``inbox`` into ``outbox``, from where the checkpoint left off.

    ``seq`` numbers a reply, from its order's columns. The outbox's own log names the files of
    completed micro-batches only, so a batch that was cut off leaves nothing that is read.
    """
    orders = readers.read_message_stream(spark, inbox, files_per_trigger=files_per_trigger)
    replies = work_stream(orders.withColumn("seq", seq), result, error, worker)
    return writers.send_message_stream(replies, outbox, checkpoint)
