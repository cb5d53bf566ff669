"""Streaming forms: file replay one micro-batch per file (FIXTURES 4.6, 4.7), restart, stream = batch."""

import json
import os

import pytest

from pyspark.sql import functions as F

from panewise.operators import parse_orders, valid_orders, window_metrics
from panewise.plans.table import MetricsTable
from panewise.sources.files import read_messages
from panewise.streaming.job import build_metrics_stream, start_metrics_query
from panewise.streaming.router import start_staged_query

M = 1_704_067_200_000  # a minute mark


def _files(d, rows, start=0):
    os.makedirs(d, exist_ok=True)
    for i, (e, u, s, a, off) in enumerate(rows, start):
        p = os.path.join(d, f"part-{i:04d}.json")
        with open(p, "w") as f:
            f.write(json.dumps({"event_id": e, "user_id": u, "store_id": s, "amount": a, "event_time": M + off}) + "\n")
        os.utime(p, (1_000_000 + i * 10, 1_000_000 + i * 10))


def _latest(table):
    return {(r.window_start, r.store_id): (r.order_cnt, r.gmv_total, r.user_cnt) for r in table.latest().collect()}


REPLAY = [("a", "u1", "s", 1.0, 100_000), ("f", "u9", "s", 0.0, 100_000), ("f", "u9", "s", 0.0, 100_000),
          ("b", "u2", "s", 2.0, 70_000), ("z", "u9", "s", 1.0, 400_000)]


def test_replay_counts_out_of_order_row_and_drops_duplicate(spark, scratch):
    src = os.path.join(scratch, "in")
    _files(src, REPLAY)
    table = MetricsTable(spark, os.path.join(scratch, "t"))
    st = build_metrics_stream(read_messages(spark, src, stream=True, files_per_trigger=1), output_mode="update")
    q = start_metrics_query(st, table, os.path.join(scratch, "ck"), trigger_seconds=None)
    q.processAllAvailable()
    q.stop()
    got = _latest(table)
    # b (t = +70 s) counts in the panes starting at +30 s and +60 s
    assert got[("2024-01-01 00:00:30", "s")] == (1, 2.0, 1)
    assert got[("2024-01-01 00:01:00", "s")] == (3, 3.0, 3)
    # stream result equals the batch result over the deduplicated rows (nothing here is late)
    dedup = [r for i, r in enumerate(REPLAY) if i != 2]
    batch = spark.createDataFrame(
        [(e, u, s, a, M + o) for e, u, s, a, o in dedup],
        "event_id string, user_id string, store_id string, amount double, event_time long",
    ).withColumn("event_ts", F.timestamp_millis("event_time"))
    exp = {(r.window_start, r.store_id): (r.order_cnt, r.gmv_total, r.user_cnt) for r in window_metrics(batch).collect()}
    assert got == exp


def test_restart_from_checkpoint_keeps_state(spark, scratch):
    src = os.path.join(scratch, "in")
    table = MetricsTable(spark, os.path.join(scratch, "t"))
    ck = os.path.join(scratch, "ck")
    _files(src, REPLAY[:3])
    for _ in range(2):  # second run: restart on the same checkpoint after more files arrive
        st = build_metrics_stream(read_messages(spark, src, stream=True, files_per_trigger=1), output_mode="update")
        q = start_metrics_query(st, table, ck, trigger_seconds=None)
        q.processAllAvailable()
        q.stop()
        _files(src, REPLAY[3:], start=3)
    got = _latest(table)
    assert got[("2024-01-01 00:01:00", "s")] == (3, 3.0, 3)  # the duplicate f stayed rejected after restart
    keys = table.latest().groupBy("window_start", "store_id").count()
    assert keys.filter("count > 1").count() == 0


def test_staged_job_routes_too_late_row(spark, scratch):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")  # results must not depend on it
    try:
        _staged_too_late(spark, scratch)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _staged_too_late(spark, scratch):
    src = os.path.join(scratch, "in")
    rows = [("a", "u1", "s", 1.0, 100_000), ("f", "u9", "s", 0.0, 100_000), ("b", "u2", "s", 2.0, 70_000),
            ("old", "u3", "s", 5.0, 10_000), ("z", "u9", "s", 1.0, 400_000)]
    _files(src, rows)
    table = MetricsTable(spark, os.path.join(scratch, "t"))
    router, qs = start_staged_query(read_messages(spark, src, stream=True, files_per_trigger=1),
                                    os.path.join(scratch, "job"), table, trigger_seconds=None)
    for q in qs:
        q.processAllAvailable()
        q.stop()
    late = spark.read.parquet(router.path("late")).collect()
    assert [(r.event_id, r.watermark_ms) for r in late] == [("old", M + 100_000 - 10_001)]
    got = _latest(table)
    assert got[("2024-01-01 00:00:30", "s")] == (1, 2.0, 1)  # allowed-late b re-fires a closed window
    assert got[("2024-01-01 00:01:00", "s")] == (3, 3.0, 3)  # fired when z moved the watermark
    assert ("2024-01-01 00:06:00", "s") not in got  # z's windows are not closed yet
    assert all(r.order_cnt < 5 for r in table.versions().collect())  # 'old' counted nowhere


@pytest.mark.parametrize("dedup_engine", ["table", "bucketed"])
def test_staged_stream_equals_batch_pipeline(spark, scratch, dedup_engine):
    """Staged job over the sf0.001 raw arrivals (junk, duplicates, disorder, very late rows) = batch job."""
    from paths import SF_SMALL
    from panewise.operators.dedup import dedup_first
    from panewise.operators.late import batch_watermarks, classify_late, metrics_excluding_late
    from panewise.sources.fixtures import load_events, raw_arrivals_from_events

    n_batches = 6
    raw = raw_arrivals_from_events(load_events(spark, SF_SMALL))
    lo, hi = raw.agg(F.min("arrival_ms"), F.max("arrival_ms")).first()
    width = (hi - lo) // n_batches + 1
    raw = raw.withColumn("cb", F.floor((F.col("arrival_ms") - lo) / width).cast("bigint"))
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    for b, rows in enumerate(
        [[r.value for r in raw.filter(F.col("cb") == i).orderBy("arrival_ms").collect()] for i in range(n_batches)]
    ):
        p = os.path.join(src, f"part-{b:04d}.txt")
        with open(p, "w") as f:
            f.write("\n".join(rows) + "\n")
        os.utime(p, (1_000_000 + b * 10, 1_000_000 + b * 10))

    table = MetricsTable(spark, os.path.join(scratch, "t"))
    router, qs = start_staged_query(read_messages(spark, src, stream=True, files_per_trigger=1),
                                    os.path.join(scratch, "job"), table, trigger_seconds=None,
                                    with_dead_letters=True, dedup_engine=dedup_engine)
    for q in qs:
        q.processAllAvailable()
        q.stop()

    # Batch twin: within one test run the 1 h processing-time TTL never expires -> first arrival wins.
    valid = valid_orders(parse_orders(raw))
    wm = batch_watermarks(valid, batch_col="cb")
    classified = classify_late(dedup_first(valid, "event_id", "arrival_ms"), batch_col="cb", watermarks=wm)
    final_max = valid.agg(F.max("event_time")).first()[0]
    exp_rows = metrics_excluding_late(classified, keep_window=True).filter(
        F.col("window_end_ms") + 10_000 <= final_max).collect()
    exp = {(r.window_start, r.store_id): (r.order_cnt, r.gmv_total, r.user_cnt) for r in exp_rows}
    assert len(exp) > 100
    assert _latest(table) == exp
    late_stream = {r.event_id for r in spark.read.parquet(router.path("late")).collect()}
    late_batch = {r.event_id for r in classified.filter("is_late").collect()}
    assert late_stream == late_batch and late_stream
    assert spark.read.parquet(router.path("anomalies")).count() == parse_orders(raw).filter("reason IS NOT NULL").count()


@pytest.mark.parametrize("exact", [True, False])
def test_append_mode_emits_each_closed_window_once(spark, scratch, exact):
    src = os.path.join(scratch, "in")
    # without no-data batches, closed windows are emitted by the batch after the one moving the watermark
    _files(src, REPLAY + [("y", "u9", "s", 1.0, 400_000)])
    table = MetricsTable(spark, os.path.join(scratch, "t"))
    # exact: two chained aggregations (window, store, user) -> (window, store); else a sketch
    st = build_metrics_stream(read_messages(spark, src, stream=True, files_per_trigger=1), exact=exact,
                              output_mode="append")
    q = start_metrics_query(st, table, os.path.join(scratch, "ck"), trigger_seconds=None)
    q.processAllAvailable()
    q.stop()
    versions = table.versions().collect()
    keys = [(r.window_start, r.store_id) for r in versions]
    assert len(keys) == len(set(keys))  # append: one final row per window
    got = {k: (r.order_cnt, r.gmv_total, r.user_cnt) for k, r in zip(keys, versions)}
    # z at +400 s closes every window ending by +385 s; z's own windows stay open
    assert got == {
        ("2024-01-01 00:00:30", "s"): (1, 2.0, 1),
        ("2024-01-01 00:01:00", "s"): (3, 3.0, 3),
        ("2024-01-01 00:01:30", "s"): (2, 1.0, 2),
    }


from panewise.streaming.dedup import dedup_stream  # noqa: E402


@pytest.mark.parametrize("engine", ["bucketed", "watermark"])
def test_stream_dedup_engines(spark, scratch, engine):
    src = os.path.join(scratch, "in")
    _files(src, [("a", "u1", "s", 1.0, 1000), ("a", "u1", "s", 5.0, 2000), ("b", "u2", "s", 2.0, 3000)])
    # a hot key: many copies of "h" inside one micro-batch, all with the same arrival time
    hot = os.path.join(src, "part-0009.json")
    with open(hot, "w") as f:
        for i in range(200):
            f.write(json.dumps({"event_id": "h", "user_id": "u", "store_id": "s", "amount": float(199 - i),
                                "event_time": M}) + "\n")
    os.utime(hot, (1_000_100, 1_000_100))
    parsed = valid_orders(parse_orders(read_messages(spark, src, stream=True, files_per_trigger=1)))
    out = dedup_stream(parsed, ttl_ms=3_600_000, order_cols=("ingest_ms",), engine=engine)
    q = out.writeStream.format("memory").queryName(f"dedup_{engine}").outputMode("append").option(
        "checkpointLocation", os.path.join(scratch, "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r.event_id, r.amount) for r in spark.table(f"dedup_{engine}").collect())
    assert [k for k, _ in got] == ["a", "b", "h"]
    if engine == "bucketed":
        assert got == [("a", 1.0), ("b", 2.0), ("h", 0.0)]  # ties: the smallest row
    with pytest.raises(ValueError):
        dedup_stream(parsed, engine="bucket")


def test_accepted_ids_expire_and_survive_a_retry(spark, scratch):
    from panewise.streaming.dedup import AcceptedIds

    now = [1_000_000_000]
    ids = AcceptedIds(spark, os.path.join(scratch, "acc"), "event_id", 10_000, ("ingest_ms",), clock=lambda: now[0])

    def batch(*rows):
        return spark.createDataFrame(rows, "event_id string, ingest_ms long, amount double, big long")

    def accept(n, *rows):
        return sorted((r.event_id, r.amount, r.big) for r in ids.accept(batch(*rows), n).collect())

    big = 9_007_199_254_740_993  # a nullable long beyond what a double holds
    assert accept(0, ("a", 5, 2.0, big), ("a", 5, 1.0, big), ("a", 4, 9.0, None), ("b", 1, 1.0, None)) == [("a", 9.0, None), ("b", 1.0, None)]
    now[0] += 9_999
    first = accept(1, ("a", 9, 1.0, 1), ("c", 9, 2.0, big), ("c", 9, 1.0, big))
    assert first == [("c", 1.0, big)]
    now[0] += 50_000  # a retry much later: judged by the clock of the first attempt
    assert accept(1, ("c", 9, 2.0, big), ("a", 9, 1.0, 1), ("c", 9, 1.0, big)) == first
    now[0] = 1_000_000_000 + 10_000
    assert accept(2, ("a", 1, 7.0, None), ("c", 1, 1.0, None)) == [("a", 7.0, None)]  # exactly the TTL later
    now[0] += 40 * 3_600_000
    assert accept(3, ("c", 1, 3.0, None)) == [("c", 3.0, None)]
    assert len(ids._hours()) == 1  # what no TTL can reach is gone


def test_messages_with_any_event_time_never_stop_the_staged_job(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    times = [[0], [1704067200000000000], [M + 1000, 9223372036854775807], [-62200000000000000], [1704067200000000], [M + 200_000]]
    for i, batch in enumerate(times):
        path = os.path.join(src, f"part-{i:04d}.json")
        with open(path, "w") as f:
            for k, t in enumerate(batch):
                f.write(json.dumps({"event_id": f"e{i}-{k}", "user_id": "u", "store_id": "s", "amount": 1.0, "event_time": t}) + "\n")
        os.utime(path, (1_000_000 + i * 10, 1_000_000 + i * 10))
    table = MetricsTable(spark, os.path.join(scratch, "t"))
    router, qs = start_staged_query(read_messages(spark, src, stream=True, files_per_trigger=1), os.path.join(scratch, "job"),
                                    table, trigger_seconds=None, with_dead_letters=True)
    for q in qs:
        q.processAllAvailable()
        assert q.exception() is None
        q.stop()
    assert {r.reason for r in spark.read.parquet(router.path("anomalies")).collect()} == {"event_time_out_of_range"}
    assert spark.read.parquet(router.path("anomalies")).count() == 4
    assert spark.read.parquet(router.path("silver")).count() == 3  # 1970 first, then 2024
    assert ("2024-01-01 00:00:00", "s") in _latest(table) and ("1970-01-01 00:00:00", "s") in _latest(table)


def test_hot_store_in_the_default_stream_has_no_user_set(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    for i, rows in enumerate([[(f"e{k}", f"u{k % 700}", "hot", 1000 + k % 50) for k in range(1500)], [("z", "u", "s", 400_000)], [("y", "u", "s", 401_000)]]):
        path = os.path.join(src, f"part-{i:04d}.json")
        with open(path, "w") as f:
            for e, u, s, off in rows:
                f.write(json.dumps({"event_id": e, "user_id": u, "store_id": s, "amount": 1.0, "event_time": M + off}) + "\n")
        os.utime(path, (1_000_000 + i * 10, 1_000_000 + i * 10))
    st = build_metrics_stream(read_messages(spark, src, stream=True, files_per_trigger=1))
    assert "collect_set" not in st.metrics._jdf.queryExecution().logical().toString()
    table = MetricsTable(spark, os.path.join(scratch, "t"))
    q = start_metrics_query(st, table, os.path.join(scratch, "ck"), trigger_seconds=None)
    q.processAllAvailable()
    q.stop()
    assert _latest(table)[("2024-01-01 00:00:00", "hot")] == (1500, 1500.0, 700)


def _write_file(src, i, rows):
    os.makedirs(src, exist_ok=True)
    path = os.path.join(src, f"part-{i:04d}.json")
    with open(path, "w") as f:
        for e, u, s, off in rows:
            f.write(json.dumps({"event_id": e, "user_id": u, "store_id": s, "amount": 0.1, "event_time": M + off}) + "\n")
    os.utime(path, (1_000_000 + i * 10, 1_000_000 + i * 10))


def test_hot_store_in_update_mode_is_kept_by_user(spark, scratch):
    """Open windows are emitted again and again; a state row holds one user, the table sums users exactly."""
    src = os.path.join(scratch, "in")
    _write_file(src, 0, [(f"e{k}", f"u{k % 700}", "hot", 1000 + k % 50) for k in range(1500)])
    _write_file(src, 1, [(f"f{k}", f"u{k % 900}", "hot", 2000) for k in range(1000)] + [("n", "u1", "cold", 2000)])
    _write_file(src, 2, [("g", "u5", "hot", 3000)])
    st = build_metrics_stream(read_messages(spark, src, stream=True, files_per_trigger=1), output_mode="update")
    plan = st.metrics._jdf.queryExecution().logical().toString()
    assert "collect_set" not in plan and "user_id" in st.metrics.columns
    table = MetricsTable(spark, os.path.join(scratch, "t"))
    ck = os.path.join(scratch, "ck")
    q = start_metrics_query(st, table, ck, trigger_seconds=None)
    q.processAllAvailable()
    q.stop()
    want = {("2024-01-01 00:00:00", "hot"): (2501, 250.1, 900), ("2024-01-01 00:00:00", "cold"): (1, 0.1, 1)}
    got = {k: v for k, v in _latest(table).items() if k[0] == "2024-01-01 00:00:00"}
    assert got == want
    assert table.by_user.versions().filter("batch_id = 2").count() == 2  # one user changed: a row for each of its windows
    state = spark.read.format("statestore").option("operatorId", 0).load(ck)
    assert state.filter("key.store_id = 'hot'").count() == 2 * 900  # a row per window and user
    table.compact("20240101", "20240101", rows_per_file=500)
    table.by_user.compact("20240101", "20240101")  # nothing left to fold
    assert {k: v for k, v in _latest(table).items() if k[0] == "2024-01-01 00:00:00"} == want
    assert len([f for f in table.by_user.versions().inputFiles() if "20240101" in f]) > 3


def test_closed_windows_leave_the_state_and_a_stop_before_the_commit_counts_nothing_twice(spark, scratch):
    """T7, T8 by Spark's state reader: a batch fails after its sink has written, and is run again."""
    src, ck = os.path.join(scratch, "in"), os.path.join(scratch, "ck")
    _files(src, REPLAY[:4])
    table = MetricsTable(spark, os.path.join(scratch, "t"))
    messages = read_messages(spark, src, stream=True, files_per_trigger=1)
    write, calls = table.write_batch, []

    def fails_once(df, batch_id, epoch=0):
        write(df, batch_id=batch_id, epoch=epoch)
        calls.append(batch_id)
        if batch_id == 3 and calls.count(3) == 1:
            raise RuntimeError("lost between sink and commit")

    table.write_batch = fails_once
    q = start_metrics_query(build_metrics_stream(messages, output_mode="update"), table, ck, trigger_seconds=None)
    with pytest.raises(Exception, match="lost between sink and commit"):
        q.processAllAvailable()
    metadata = spark.read.format("state-metadata").load(ck).collect()
    assert {r.operatorId for r in metadata} >= {0, 1}
    q = start_metrics_query(build_metrics_stream(messages, output_mode="update"), table, ck, trigger_seconds=None)
    q.processAllAvailable()
    windows = lambda: {r.w for r in spark.read.format("statestore").option("operatorId", 0).load(ck).selectExpr("unix_millis(key.window.end) AS w").collect()}
    assert calls == [0, 1, 2, 3, 3]
    assert _latest(table)[("2024-01-01 00:01:00", "s")] == (3, 3.0, 3)
    assert table.by_user.versions().count() == table.by_user.versions().select("window_start", "user_id", "batch_id").distinct().count()
    open_before = windows()
    assert M + 120_000 in open_before
    _files(src, [("z", "u9", "s", 1.0, 400_000), ("y", "u9", "s", 1.0, 401_000)], start=4)
    q.processAllAvailable()
    q.stop()
    # z moved the watermark to 385 s: every window that ends by then is gone, its own two and none else are there
    assert windows() == {M + 420_000, M + 450_000}
    assert _latest(table)[("2024-01-01 00:01:00", "s")] == (3, 3.0, 3)


def test_late_counters_and_partials_of_the_staged_job(spark, scratch):
    """A7 and T5/S10 in the stream: counters equal the batch statistics, partial metrics the recomputation with all rows."""
    from panewise.operators.late import batch_watermarks, classify_late, late_events, late_stats, metrics_excluding_late

    src = os.path.join(scratch, "in")
    batches, k = [], 0
    for i in range(5):
        rows = []
        for j in range(40):
            off = i * 1_800_000 + j * 1000 if j % 5 else max(0, (i - 1 - j % 3)) * 1_800_000 + j * 500
            rows.append((f"e{k}", f"u{k % 17}", "ab"[k % 2], off))
            k += 1
        batches.append(rows)
        _write_file(src, i, rows)
    table = MetricsTable(spark, os.path.join(scratch, "t"))

    def run(root):
        router, qs = start_staged_query(read_messages(spark, src, stream=True, files_per_trigger=1), root, table, trigger_seconds=None, alert_threshold=4, with_partials=True)
        for q in qs:
            q.processAllAvailable()
            q.stop()
        return router

    router = run(os.path.join(scratch, "job"))
    flat = [(e, u, s, 0.1, M + off, b) for b, rows in enumerate(batches) for e, u, s, off in rows]
    df = spark.createDataFrame(flat, "event_id string, user_id string, store_id string, amount double, event_time long, batch_id long")
    c = classify_late(df, watermarks=batch_watermarks(df))
    want = sorted(map(tuple, late_stats(late_events(c), alert_threshold=4).collect()))
    assert sorted(map(tuple, router.late_stats().collect())) == want and len(want) > 3 and any(r[-1] for r in want)
    alerts = [(r.store_id, r.bucket_start) for r in router.late_alerts().collect()]
    assert sorted(alerts) == sorted((r[0], r[1]) for r in want if r[-1])
    # a batch that runs again writes the same counters and the same alerts
    first = [r for r in flat if r[-1] == 4]
    again = spark.createDataFrame(first, df.schema).withColumn("event_ts", F.timestamp_millis("event_time")).drop("batch_id")
    router._through = {}
    router.process(again, 4)
    assert sorted(map(tuple, router.late_stats().collect())) == want
    assert sorted((r.store_id, r.bucket_start) for r in router.late_alerts().collect()) == sorted(alerts)
    timed = c.withColumn("event_ts", F.timestamp_millis("event_time"))
    assert sorted(map(tuple, router.partials.metrics().collect())) == sorted(map(tuple, window_metrics(timed).collect()))
    assert sorted(map(tuple, router.partials.metrics(sources=["on_time"]).collect())) == sorted(map(tuple, metrics_excluding_late(timed).collect()))


def test_metrics_stream_dead_letters(spark, scratch):
    from panewise.streaming.job import start_anomaly_query

    src = os.path.join(scratch, "in")
    _files(src, REPLAY[:2])
    junk = os.path.join(src, "part-0005.json")
    with open(junk, "w") as f:
        f.write('not json\n{"user_id":"u"}\n{"event_id":"ok","event_time":1}\n')
    os.utime(junk, (1_000_100, 1_000_100))
    st = build_metrics_stream(read_messages(spark, src, stream=True, files_per_trigger=1))
    q = start_anomaly_query(st, os.path.join(scratch, "dead"), os.path.join(scratch, "ck"), trigger_seconds=None)
    q.processAllAvailable()
    q.stop()
    dead = sorted((r.value, r.reason) for r in spark.read.parquet(os.path.join(scratch, "dead")).collect())
    assert dead == [('not json', "malformed_json"), ('{"user_id":"u"}', "event_id_missing")]
