"""The manager's streams against the batch operators, for files in any order, repeats and restarts."""

import datetime as dt
import os
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexigraph.operators import tracking as ops
from lexigraph.sinks import writers
from lexigraph.sources import readers
from lexigraph.streaming import manager, state
from lexigraph.streaming import tracking as stream

T0 = dt.datetime(2024, 1, 1)


def message(msg_id, seq, kind, body, job=None, to="m", at=None):
    return (msg_id, seq, T0 + dt.timedelta(seconds=seq if at is None else at), "client", to, kind, job, body)


def send(spark, data, folder, files=1):
    step = -(-len(data) // files)
    for k in range(0, len(data), step):
        writers.send_messages(spark.createDataFrame(data[k:k + step], readers.MESSAGE_SCHEMA).coalesce(1), folder)


def run(spark, df, tmp_path, name="out"):
    stream.use_rocksdb(spark)
    stream.write_available(df, str(tmp_path / name), str(tmp_path / f"{name}-cp"), timers=True).awaitTermination()
    return str(tmp_path / name)


def orders_and_replies(rng, n_orders=60, n_replies=70):
    orders = [message(f"o{i}", rng.randrange(5), ops.INIT_WORK, rng.choice("abc"), None) for i in range(n_orders)]
    orders = [(*o[:6], f"j{o[1]}", o[7]) for o in orders]
    replies = []
    for i in range(n_replies):
        item = rng.choice("abcd")
        bad = rng.random() < 0.3
        replies.append(message(f"r{i}", i, ops.ERROR_WORK if bad else ops.FINISHED_WORK, item if bad else f"{item};t{i}"))
    return orders, [*replies, message("r-none", 1000, ops.FINISHED_WORK, "no separator")]


def batch_match(spark, orders, replies):
    jobs = spark.createDataFrame([(o[6], o[1], o[7]) for o in orders], "job_id string, submit_seq bigint, item string")
    return ops.match_results(jobs, ops.parse_results(spark.createDataFrame(replies, readers.MESSAGE_SCHEMA)))


@pytest.mark.parametrize("files_per_trigger", [1, 4, 16])
def test_credits_equal_the_batch(spark, tmp_path, rows, files_per_trigger):
    rng = random.Random(files_per_trigger)
    orders, replies = orders_and_replies(rng)
    data = orders + replies
    rng.shuffle(data)
    send(spark, data, str(tmp_path / "in"), 8 if files_per_trigger == 1 else 16)
    found = manager.match_results_stream(readers.read_message_stream(spark, str(tmp_path / "in"), files_per_trigger))
    columns = ["seq", "type", "item", "thumb", "job_id"]
    got = rows(manager.read_matched(spark, run(spark, found, tmp_path)), *columns)
    assert got == rows(batch_match(spark, orders, replies), *columns)


def test_worker_and_manager_resume(spark, tmp_path, rows):
    """Stopped after every micro-batch, and once between writing a batch and noting it, the chain gives
    the rows of one run."""
    rng = random.Random(5)
    orders, _ = orders_and_replies(rng, 24, 0)
    orders = [(*o[:7], f"{o[7]}{i % 4}") for i, o in enumerate(orders)]
    error = F.when(F.col("item").endswith("3"), "odd")
    number = F.substring("msg_id", 2, 9).cast("bigint")

    def work(name):
        inbox, outbox = str(tmp_path / f"{name}-in"), str(tmp_path / f"{name}-replies")
        manager.run_worker(
            spark, inbox, outbox, str(tmp_path / f"{name}-worker"), F.upper("item"), error, number
        ).awaitTermination()
        both = readers.read_message_stream(spark, inbox).unionByName(readers.read_message_stream(spark, outbox))
        return run(spark, manager.match_results_stream(both), tmp_path, f"{name}-out")

    send(spark, orders, str(tmp_path / "once-in"), 3)
    expected = rows(manager.read_matched(spark, work("once")))
    for k in range(3):
        send(spark, orders[8 * k:8 * k + 8], str(tmp_path / "often-in"))
        out = work("often")
        if k == 1:  # the batch's files are there, but neither log says so: it is run again
            for log in ("often-worker/commits", "often-replies/_spark_metadata"):
                folder = tmp_path / log
                last = max((f for f in os.listdir(folder) if f.isdigit()), key=int)
                for f in (last, f".{last}.crc"):
                    (folder / f).unlink(missing_ok=True)
            out = work("often")
    assert rows(manager.read_matched(spark, out)) == expected
    assert len(expected) == 24 and all(r[-1] for r in expected)


def test_a_stop_refuses_later_starts_and_drains_once(spark, tmp_path, rows):
    data = []
    for m, stop in (("m1", 50), ("m2", 50), ("m3", None), ("m4", 5)):
        for i in range(10):
            data.append(message(f"{m}-{i}", i, ops.START_JOB, "list", f"{m}-{i}", m, at=10 * i + 1))
            if not (m == "m2" and i == 2):  # this job never ends
                data.append(message(f"{m}-{i}-end", i, ops.JOB_ENDED, None, f"{m}-{i}", m, at=10 * i + 30))
        if stop is not None:
            data += [message(f"{m}-stop{k}", 0, ops.TERMINATE, None, None, m, at=stop + k) for k in (0, 7, 20)]
    random.Random(2).shuffle(data)
    send(spark, data, str(tmp_path / "in"), 6)
    found = manager.terminate_stream(readers.read_message_stream(spark, str(tmp_path / "in"), 1))
    out = run(spark, found, tmp_path)
    starts = manager.read_starts(spark, out)
    batch = ops.accept_jobs(spark.createDataFrame(data, readers.MESSAGE_SCHEMA))
    assert rows(starts, "msg_id", "to_id", "accepted") == rows(batch, "msg_id", "to_id", "accepted")
    micros = {r.to_id: r["at"] for r in manager.read_drained(spark, out).collect()}
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 10**6)
    assert micros == {"m1": base + 70 * 10**6, "m4": base + 30 * 10**6}


def test_ended_jobs_leave_no_state_and_stay_ended(spark):
    """A late answer or repeated start opens no job again; only open jobs are held."""
    class Map:
        def __init__(self):
            self.rows = {}

        def getValue(self, key):
            return self.rows.get(key)

        def updateValue(self, key, value):
            self.rows[key] = value

        def removeKey(self, key):
            del self.rows[key]

    class Timer:
        def getCurrentProcessingTimeInMs(self):
            return 1

    p = manager._Ending(10)
    p.counts, p.ended = Map(), Map()

    def step(*data):
        frame = pd.DataFrame(data, columns=["job_id", "total", "answered", "last"])
        return [tuple(r) for f in p.handleInputRows((0,), iter([frame]), Timer()) for r in f.itertuples(index=False)]

    assert step(("a", 2, 0, None), ("b", 1, 0, None), ("c", 0, 0, None)) == [("c", pd.NA)]
    assert step(("a", None, 1, 7), ("b", None, 1, 3)) == [("b", 3)]
    assert set(p.counts.rows) == {("a",)}
    assert step(("b", 1, 1, 9), ("c", 0, 0, None)) == []
    assert step(("a", None, 1, 5)) == [("a", 7)]
    assert not p.counts.rows


def test_settled_replies_keep_their_copies():
    """What was decided more than ``keep_ms`` ago stays, and later messages take what is left."""
    p = manager._Credits(10)

    class List:
        def __init__(self):
            self.rows = []

        def get(self):
            return iter(self.rows)

        def put(self, rows):
            self.rows = rows

        def clear(self):
            self.rows = []

    class Timer:
        now = 0

        def getCurrentProcessingTimeInMs(self):
            return self.now

        def registerTimer(self, at):
            pass

    p.claims, p.replies, p.handle, clock = List(), List(), Timer(), Timer()

    def step(now, *data):
        clock.now = now
        frame = pd.DataFrame(data, columns=["type", "seq", "job_id", "thumb"])
        return [tuple(r)[1:] for f in p.handleInputRows(("x", 0), iter([frame]), clock) for r in f.itertuples(index=False)]

    assert step(0, (ops.INIT_WORK, 2, "j2", None), (ops.OK, 5, None, "t5")) == [(5, "ok", "t5", "j2", 1)]
    assert step(5, (ops.INIT_WORK, 1, "j1", None)) == [(5, "ok", "t5", "j1", 2)]  # still open: moved
    assert list(p.handleExpiredTimer(("x", 0), type("T", (), {"getCurrentProcessingTimeInMs": lambda s: 20})(), None)) == []
    assert p.replies.rows == [] and p.claims.rows == [(2, "j2", 1)]
    assert step(21, (ops.OK, 4, None, None)) == [(4, "ok", None, "j2", 1)]  # takes what is left
    assert step(22, (ops.OK, 3, None, None)) == [(3, "ok", None, "j2", 1), (4, "ok", None, None, 2)]


class Values:
    """A map or value state."""

    def __init__(self):
        self.rows = {}

    def getValue(self, key):
        return self.rows.get(key)

    def containsKey(self, key):
        return key in self.rows

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        del self.rows[key]

    def iterator(self):
        return iter(list(self.rows.items()))

    def exists(self):
        return bool(self.rows)

    def get(self):
        return self.rows.get("value")

    def update(self, value):
        self.rows["value"] = value

    def clear(self):
        self.rows = {}


class Handle:
    """States by name, the calls for them, and the timers and time."""

    def __init__(self):
        self.states, self.timers, self.now = {}, [], 0

    def getMapState(self, name, *_):
        return self.states.setdefault(name, Values())

    getValueState = getMapState

    def registerTimer(self, at):
        self.timers.append(at)

    def getCurrentProcessingTimeInMs(self):
        return self.now


def stepper(processor, columns):
    handle = Handle()
    processor.init(handle)

    def step(now, *data):
        handle.now = now
        frame = pd.DataFrame(data, columns=columns)
        frame["bucket"] = 1
        return [tuple(r) for f in processor.handleInputRows((0,), iter([frame]), handle) for r in f.itertuples(index=False)]

    return handle, step


def test_jobs_of_a_bucket_end_once_and_their_flags_go():
    p = manager._PartEnding(10)
    handle, step = stepper(p, ["job_id", "total", "answered", "last"])
    no = state.NONE
    assert step(1, ("a", 2, 0, no), ("b", 1, 0, no), ("c", 0, 0, no)) == [("c", pd.NA)]
    assert step(1, ("a", no, 1, 7), ("b", no, 1, 3)) == [("b", 3)]
    assert step(2, ("b", 1, 1, 9), ("c", 0, 0, no)) == []
    assert step(2, ("a", no, 1, 5)) == [("a", 7)]
    assert handle.timers == [12]
    handle.now = 50
    list(p.handleExpiredTimer((0,), handle, None))
    assert not handle.states["jobs"].rows and handle.timers == [12]


def test_settled_replies_of_a_bucket_keep_their_copies():
    p = manager._PartCredits(10)
    handle, step = stepper(p, ["item", "type", "seq", "job_id", "thumb"])
    assert step(0, ("x", ops.INIT_WORK, 2, "j2", None), ("x", ops.OK, 5, None, "t5"), ("y", ops.OK, 6, None, "t6")) == [
        ("x", 5, "ok", "t5", "j2", 1), ("y", 6, "ok", "t6", None, 1)]
    assert step(5, ("x", ops.INIT_WORK, 1, "j1", None)) == [("x", 5, "ok", "t5", "j1", 2)]  # still open: moved
    assert step(6, ("x", ops.OK, 5, None, "again")) == []
    handle.now = 20
    list(p.handleExpiredTimer((0,), handle, None))
    assert not handle.states["replies"].rows and len(p.claims.read()) == 1
    assert step(21, ("x", ops.OK, 4, None, None)) == [("x", 4, "ok", None, "j2", 1)]  # takes what is left
    assert step(22, ("x", ops.OK, 3, None, None)) == [("x", 3, "ok", None, "j2", 1), ("x", 4, "ok", None, None, 2)]


def test_a_batch_of_many_items_calls_the_state_a_few_times():
    """Items, jobs and copies used to cost calls of their own each."""
    n = 5000
    for p, columns, data in (
        (manager._PartCredits(10), ["item", "type", "seq", "job_id", "thumb"], [(f"i{k}", ops.OK, k, None, "t") for k in range(n)]),
        (manager._PartEnding(10), ["job_id", "total", "answered", "last"], [(f"j{k}", 1, k % 2, k) for k in range(n)]),
        (stream._Outstanding(), ["job_id", "type", "item", "seq", "thumb"], [(f"j{k}", ops.INIT_WORK, "i", k, None) for k in range(n)]),
    ):
        handle, step = stepper(p, columns)
        assert len(step(0, *data)) == (n // 2 if "total" in columns else n)
        assert sum(len(s.rows) for s in handle.states.values()) <= 3


def test_outcomes_follow_the_order_of_messages():
    """Against one message after the other, over several batches."""
    rng = random.Random(4)
    handle, step = stepper(stream._Outstanding(), ["type", "job_id", "item", "seq", "thumb"])
    open_ = Counter()
    for batch in range(5):
        data = [(rng.choice((ops.INIT_WORK, ops.FINISHED_WORK, ops.ERROR_WORK)), rng.choice("ab"), rng.choice(("x", "y", None)), k, None) for k in range(60)]
        expected = []
        for kind, job, item, k, _ in data:
            if item is None:
                expected.append("alert")
            elif kind == ops.INIT_WORK:
                open_[job, item] += 1
                expected.append("expected")
            elif open_[job, item]:
                open_[job, item] -= 1
                expected.append("done" if kind == ops.FINISHED_WORK else "failed")
            else:
                expected.append("alert")
        rng.shuffle(data)
        assert [(r[1], r[2]) for r in step(batch, *data)] == list(enumerate(expected))
