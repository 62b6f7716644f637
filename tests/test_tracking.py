import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexigraph.operators import tracking as ops

JOBS = [("j1", 1, "a"), ("j1", 1, "b"), ("j1", 1, "a"), ("j2", 2, "a"), ("j2", 2, "c"), ("j3", 3, None)]
RESULTS = [
    (1, "ok", "a", "t0"), (2, "error", "c", None), (3, "ok", "b", "t1"), (4, "ok", "a", "t2"),
    (5, "ok", "a", "t3"), (6, "ok", "z", "t4"),
]


def frames(spark, jobs=JOBS, results=RESULTS):
    return (
        spark.createDataFrame(jobs, "job_id string, submit_seq bigint, item string"),
        spark.createDataFrame(results, "seq bigint, type string, item string, thumb string"),
    )


def test_results_go_to_the_first_job_with_a_copy_left(spark, rows):
    matched = ops.match_results(*frames(spark))
    assert rows(matched, "seq", "job_id") == [
        (1, "j1"), (2, "j2"), (3, "j1"), (4, "j1"), (5, "j2"), (6, None)
    ]
    assert rows(ops.unmatched_results(matched), "seq") == [(6,)]


def test_progress_and_summary(spark, rows):
    jobs, results = frames(spark)
    matched = ops.match_results(jobs, results)
    progress = ops.job_progress(jobs, matched)
    assert rows(progress) == [
        ("j1", 3, 3, 0, 0, True, 4), ("j2", 2, 1, 1, 0, True, 5), ("j3", 0, 0, 0, 0, True, None)
    ]
    lines = [("j1", 1, "a;t0"), ("j1", 3, "b;t1"), ("j1", 4, "a;t2"), ("j2", 5, "a;t3"), ("j3", None, "")]
    for hot_rows in (1, 10**9):
        assert rows(ops.summary_lines(jobs, matched, hot_rows=hot_rows), "job_id", "seq", "line") == lines
    assert rows(ops.running_items(progress)) == [(0, 0)]


def test_running_job_has_no_summary(spark, rows):
    jobs, results = frames(spark, results=RESULTS[:3])
    matched = ops.match_results(jobs, results)
    progress = ops.job_progress(jobs, matched)
    assert rows(ops.running_items(progress)) == [(2, 2)]
    assert rows(ops.summary_lines(jobs, matched), "job_id", "line") == [("j3", "")]
    assert len(rows(ops.summary_lines(jobs, matched, complete_only=False))) == 2


@pytest.mark.parametrize("bits, chunk", [(20, 4096), (3, 2)])
def test_matching_against_a_plain_loop(spark, rows, monkeypatch, bits, chunk):
    """One item has a third of all copies, and one job a third of that item's."""
    monkeypatch.setattr(ops, "COPY_CHUNK", chunk)
    rng = random.Random(5)

    def item():
        return "hot" if rng.random() < 0.4 else f"i{rng.randint(0, 9)}"

    jobs = [("j0", 100, "hot")] * 60
    jobs += [(f"j{k}", 100 + k, item()) for k in range(1, 40) for _ in range(rng.randint(1, 8))]
    results = [(7 * k, rng.choice(["ok", "error"]), item(), f"t{k}") for k in range(300)]
    left = {}
    for job, _, it in sorted(jobs, key=lambda j: j[1]):
        left.setdefault(job, Counter())[it] += 1
    expected = []
    for seq, _, it, _ in results:
        job = next((j for j, c in left.items() if c[it] > 0), None)
        if job:
            left[job][it] -= 1
        expected.append((seq, job))
    rng.shuffle(jobs)
    a, b = frames(spark, jobs, results)
    matched = ops.match_results(a.repartition(7), b.repartition(5), hot_rows=bits)
    assert rows(matched, "seq", "job_id") == sorted(expected, key=repr)


def messages(spark):
    t = dt.datetime(2024, 1, 1)
    data = [
        ("m1", 1, "c1", "mgr", ops.START_JOB, "list1"), ("m2", 2, "c2", "other", ops.START_JOB, "list2"),
        ("m3", 3, "w1", "mgr", ops.FINISHED_WORK, "u;t;x"), ("m4", 4, "w1", "mgr", ops.ERROR_WORK, "v"),
        ("m5", 5, "c1", "mgr", ops.TERMINATE, "terminate"), ("m6", 6, "c3", "mgr", ops.START_JOB, "list3"),
        ("m7", 7, "c3", "mgr", None, "?"), ("m8", 8, "mgr", "*", ops.INIT_WORK, "u"),
        ("m9", 9, "w1", "mgr", ops.FINISHED_WORK, "no separator"),
        ("m3", 10, "w1", "mgr", ops.FINISHED_WORK, "u;t;x"),
    ]
    return spark.createDataFrame(
        [(m, s, t + dt.timedelta(seconds=s), f, to, ty, None, b) for m, s, f, to, ty, b in data],
        "msg_id string, seq bigint, ts timestamp, from_id string, to_id string, type string, "
        "job_id string, body string",
    )


def test_messages(spark, rows):
    all_ = messages(spark)
    first = ops.dedupe_messages(all_)
    assert rows(first, "seq") == [(s,) for s in range(1, 10)]
    assert first.columns == all_.columns
    routed = {k: rows(v, "msg_id") for k, v in ops.dispatch_by_type(first).items()}
    assert routed == {
        "start": [("m1",), ("m2",), ("m6",)], "finished": [("m3",), ("m9",)], "error": [("m4",)],
        "terminate": [("m5",)], "reject": [("m7",)],
    }
    assert rows(ops.addressed_to(first, "other"), "msg_id") == [("m2",)]
    assert rows(ops.parse_results(first), "seq", "type", "item", "thumb") == [
        (3, "ok", "u", "t;x"), (4, "error", "v", None), (9, "ok", None, None)
    ]
    for hot_rows in (1, 10**9):
        assert rows(ops.accept_jobs(first, hot_rows=hot_rows), "msg_id", "accepted") == [
            ("m1", True), ("m2", True), ("m6", False)
        ]
    assert ops.pending_messages(first, first.where("seq > 3")).count() == 3


def work(spark):
    t = dt.datetime(2024, 1, 1, 10)
    return spark.createDataFrame(
        [
            ("w1", 1, "u1", t, 100.0, "ok", None), ("w1", 2, "u2", t, 50.0, "error", "not found"),
            ("w1", 3, "u3", t, 300.0, "ok", None), ("w2", 4, "u4", t, 9.0, "error", "timeout"),
        ],
        "worker string, seq bigint, url string, start_ts timestamp, ms double, status string, error string",
    )


def test_worker_statistics(spark, rows):
    got = rows(ops.worker_stats(work(spark)).drop("start_ts", "end_ts"))
    assert [g[:4] for g in got] == [("w1", 3, 2, 1), ("w2", 1, 0, 1)]
    assert got[0][4:] == pytest.approx((400 / 3, 200.0)) and got[1][4:] == (0.0, None)
    assert rows(ops.worker_items(work(spark)), "worker", "status", "idx", "url") == [
        ("w1", "error", 0, "u2"), ("w1", "ok", 0, "u1"), ("w1", "ok", 1, "u3"), ("w2", "error", 0, "u4")
    ]


def test_worker_report(spark):
    report = ops.worker_report(work(spark), digits=1).where("worker = 'w1'").orderBy("section", "idx")
    assert [r.line for r in report.collect()] == [
        "Worker {w1}", "Start date  = Mon Jan 01 10:00:00 UTC 2024",
        "End date = Mon Jan 01 10:00:00 UTC 2024", "Average proccess time in MS= 133.3",
        "Number of processed url = 3", "Successfull urls - ", "0: u1", "1: u3", "", "Failed urls - ",
        "0: u2, Error reason = not found",
    ]


def test_process_items(spark, rows):
    def half(x):
        return str(int(x) // 2)

    done = ops.process_items(spark.createDataFrame([("4",), ("x",)], "item string"), half)
    good, bad = ops.route_errors(done)
    assert rows(good, "item", "result") == [("4", "2")]
    assert [r.item for r in bad.collect()] == ["x"] and "invalid literal" in bad.first().error


def test_replies(spark, rows):
    items = messages(spark).where("seq in (8, 9)").withColumn("item", F.col("body"))
    done = ops.process_items(items, lambda u: {"u": "thumb"}[u])
    assert rows(ops.to_replies(done, "w7"), "from_id", "type", "body") == [
        ("w7", ops.ERROR_WORK, "no separator"), ("w7", ops.FINISHED_WORK, "u;thumb")
    ]


def test_gallery(spark):
    jobs, results = frames(spark)
    matched = ops.match_results(jobs, results)
    page = ops.gallery_html(ops.summary_lines(jobs, matched), "http://b/")
    html = [r.html for r in page.where("job_id = 'j2'").orderBy("section", "seq").collect()]
    assert html == [
        "<HTML>\n<HEAD>\n</HEAD>\n<BODY>", '<a href="a"><img src="http://b/t3" width="50" height="50"></a>',
        "</BODY>\n</HTML>",
    ]
    assert page.where("job_id = 'j3'").count() == 2


def test_results_without_an_item_are_kept(spark, rows):
    jobs, results = frames(spark)
    more = results.unionByName(spark.createDataFrame([(9, "ok", None, None)], results.schema))
    assert rows(ops.unmatched_results(ops.match_results(jobs, more)), "seq") == [(6,), (9,)]


def test_work_of_nameless_workers_is_numbered(spark, rows):
    mixed = work(spark).selectExpr("nullif(worker, 'w1') AS worker", "seq", "url", "start_ts", "ms", "status", "error")
    assert rows(ops.worker_items(mixed), "worker", "status", "idx", "url") == [
        ("w2", "error", 0, "u4"), (None, "error", 0, "u2"), (None, "ok", 0, "u1"), (None, "ok", 1, "u3")
    ]


def test_a_finished_job_without_a_line_has_summary_and_page(spark, rows):
    jobs, results = frames(spark, [("j1", 1, "a"), ("j2", 2, "b")], [(1, "ok", "a", "t"), (2, "error", "b", None)])
    summary = ops.summary_lines(jobs, ops.match_results(jobs, results))
    assert rows(summary, "job_id", "seq", "line") == [("j1", 1, "a;t"), ("j2", None, "")]
    assert rows(ops.gallery_html(summary, "x").groupBy("job_id").count()) == [("j1", 3), ("j2", 2)]


def test_expand_jobs(spark, rows, monkeypatch):
    starts = messages(spark).where("seq IN (1, 2, 6)").withColumn("job_id", F.concat(F.lit("j"), "seq"))
    lists = spark.createDataFrame([("list1", "a"), ("list1", "b"), ("list1", "a"), ("list3", None)], "list string, item string")
    for chunk, hot_rows in ((4096, 10**9), (1, 1)):
        monkeypatch.setattr(ops, "COPY_CHUNK", chunk)
        jobs, orders = ops.expand_jobs(starts, lists, hot_rows)
        assert rows(jobs) == [("j1", 1, "a"), ("j1", 1, "a"), ("j1", 1, "b"), ("j2", 2, None), ("j6", 6, None)]
        assert rows(orders, "from_id", "type", "job_id", "body") == [
            ("mgr", ops.INIT_WORK, "j1", "a"), ("mgr", ops.INIT_WORK, "j1", "a"), ("mgr", ops.INIT_WORK, "j1", "b")
        ]
        assert orders.select("msg_id").distinct().count() == 3


def test_refusals_and_completed_jobs(spark, rows):
    assert rows(ops.refusals(messages(spark)), "msg_id", "from_id", "to_id", "type") == [
        ("m6-refused", "mgr", "c3", ops.REFUSED)
    ]
    jobs, results = frames(spark)
    progress = ops.job_progress(jobs, ops.match_results(jobs, results))
    assert rows(ops.completed_jobs(progress, "s"), "job_id", "type", "body") == [
        (j, ops.JOB_ENDED, f"s/job_id={j}") for j in ("j1", "j2", "j3")
    ]


def test_a_result_that_was_not_stored_gets_no_reply(spark):
    items = messages(spark).where("seq = 8").withColumn("item", F.col("body")).withColumn("result", F.lit("t"))
    assert ops.to_replies(items.withColumn("status", F.lit(ops.RETRY)), "w").isEmpty()
    assert ops.to_replies(items.withColumn("status", F.lit(ops.OK)), "w").count() == 1


def test_copies_of_few_claims_are_not_broadcast(spark):
    """One claim stands for as many rows as it has copies."""
    jobs = spark.range(20_000).select(F.lit("j").alias("job_id"), F.lit(1).cast("bigint").alias("submit_seq"), F.lit("a").alias("item"))
    results = spark.range(20_001).select(
        F.col("id").alias("seq"), F.lit("ok").alias("type"), F.lit("a").alias("item"), F.lit("t").alias("thumb")
    )
    found = ops.match_results(jobs, results)
    assert [r.seq for r in found.collect() if r.job_id is None] == [20_000]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
