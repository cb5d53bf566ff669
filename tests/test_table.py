"""Versioned writes, retry idempotence, newer epoch wins, pruning, compaction."""

import os

from pyspark.sql import functions as F

from panewise.plans.table import MetricsTable, latest_rows

COLS = "window_start string, window_end string, store_id string, order_cnt long, gmv_total double, user_cnt long"


def _m(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_retry_is_idempotent_and_newest_version_wins(spark, scratch):
    t = MetricsTable(spark, os.path.join(scratch, "metrics"))
    b0 = _m(spark, [("2024-01-01 00:00:00", "2024-01-01 00:01:00", "s", 1, 1.0, 1),
                    ("2024-01-02 00:00:00", "2024-01-02 00:01:00", "s", 5, 5.0, 1)])
    b1 = _m(spark, [("2024-01-01 00:00:00", "2024-01-01 00:01:00", "s", 2, 3.0, 2)])
    t.write_batch(b0, batch_id=0)
    t.write_batch(b1, batch_id=1)
    t.write_batch(b1, batch_id=1)  # replayed micro-batch
    assert t.versions().count() == 3
    latest = {(r.window_start, r.store_id): r.order_cnt for r in t.latest().collect()}
    assert latest == {("2024-01-01 00:00:00", "s"): 2, ("2024-01-02 00:00:00", "s"): 5}
    # a backfill writes a higher epoch with a lower batch id and still wins
    t.write_batch(_m(spark, [("2024-01-01 00:00:00", "2024-01-01 00:01:00", "s", 9, 9.0, 3)]), batch_id=0, epoch=1)
    assert t.latest().filter(F.col("window_start") == "2024-01-01 00:00:00").first().order_cnt == 9
    # date bounds become partition filters
    plan = t.latest("20240102", "20240102")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan
    assert t.latest("20240102", "20240102").count() == 1
    # compaction keeps the view and leaves one version per key
    before = sorted(_values(t))
    t.compact("20240101", "20240102")
    assert sorted(_values(t)) == before
    assert t.versions().count() == 2


def _values(t):
    return [(r.window_start, r.store_id, r.order_cnt, r.gmv_total, r.user_cnt) for r in t.latest().collect()]


def _one(spark, n):
    return _m(spark, [("2024-01-01 00:00:00", "2024-01-01 00:01:00", "s", n, 1.0 * n, 1)])


def test_latest_rows_generic(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "c")], "key string, version int, v string")
    assert sorted(map(tuple, latest_rows(df, ["key"], ["version"]).collect())) == [("j", 1, "c"), ("k", 2, "b")]


def test_a_stream_that_goes_on_after_compaction_wins(spark, scratch):
    t = MetricsTable(spark, os.path.join(scratch, "metrics"))
    for b in (0, 1):
        t.write_batch(_one(spark, 1 + b), batch_id=b)
    t.compact("20240101", "20240101")
    assert [(r.order_cnt, r.epoch, r.batch_id, r.folded) for r in t.latest().collect()] == [(2, 0, 1, 1)]
    t.write_batch(_one(spark, 2), batch_id=1)  # a retry of a folded batch changes nothing
    assert [r.order_cnt for r in t.latest().collect()] == [2]
    t.write_batch(_one(spark, 3), batch_id=2)  # the next batch of the running stream
    assert [r.order_cnt for r in t.latest().collect()] == [3]
    t.compact("20240101", "20240101")
    assert t.versions().count() == 1 and [r.order_cnt for r in t.latest().collect()] == [3]
    t.compact("20240101", "20240101")  # nothing to fold
    assert t.versions().count() == 1


def test_versions_that_appear_during_compaction_stay(spark, scratch, monkeypatch):
    t = MetricsTable(spark, os.path.join(scratch, "metrics"))
    for b in (0, 1):
        t.write_batch(_one(spark, 1 + b), batch_id=b)
    write = t._write

    def meanwhile(rows, files_per_date):
        monkeypatch.undo()
        t.write_batch(_one(spark, 9), batch_id=2)
        write(rows, files_per_date)

    monkeypatch.setattr(t, "_write", meanwhile)
    t.compact("20240101", "20240101")
    assert sorted((r.order_cnt, r.batch_id, r.folded) for r in t.versions().collect()) == [(2, 1, 1), (9, 2, 0)]
    assert [r.order_cnt for r in t.latest().collect()] == [9]


def test_files_per_date(spark, scratch):
    t = MetricsTable(spark, os.path.join(scratch, "metrics"))
    rows = [(f"2024-01-0{d} {h:02d}:{m:02d}:00", "x", "s", 1, 1.0, 1) for d in (1, 2) for h in range(24) for m in range(60)]
    t.write_batch(_m(spark, rows), batch_id=0, files_per_date=8)
    files = t.versions().inputFiles()
    assert len(files) == 16 and sum("window_date=20240101" in f for f in files) == 8


FROM, TO = 1_704_844_800_000, 1_705_017_600_000  # 2024-01-10 to 2024-01-12


def test_backfill_replaces_the_whole_windows_of_a_range_only(spark, scratch):
    from paths import SF_SMALL
    from panewise.plans.batch import backfill, replay_range, run_job
    from panewise.sources.fixtures import load_events, raw_arrivals_from_events

    t = MetricsTable(spark, os.path.join(scratch, "metrics"))
    msgs = raw_arrivals_from_events(load_events(spark, SF_SMALL))
    t.write_batch(run_job(msgs).metrics, batch_id=7)
    want = sorted(_values(t))
    low, high = replay_range(FROM, TO)
    replay = msgs.filter(F.col("arrival_ms").between(low, high))
    backfill(t, replay, 1, FROM, TO)
    assert sorted(_values(t)) == want  # an unchanged replay changes nothing, at the edges least of all
    # rows that are gone: their windows change or go, others stay
    fewer = replay.filter("arrival_ms % 3 <> 0")
    backfill(t, fewer, 2, FROM, TO)
    inside = lambda ws: "2024-01-10 00:00:00" <= ws <= "2024-01-11 23:59:00"
    alone = {(r.window_start, r.store_id): (r.order_cnt, r.user_cnt) for r in run_job(fewer).metrics.collect() if inside(r.window_start)}
    got = {(r[0], r[1]): (r[2], r[4]) for r in _values(t) if inside(r[0])}
    assert got == alone and len(got) < len([r for r in want if inside(r[0])])
    assert sorted(r for r in _values(t) if not inside(r[0])) == [r for r in want if not inside(r[0])]
