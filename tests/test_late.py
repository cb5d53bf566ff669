"""Watermark replay, lateness boundary, late routing, statistics."""

import numpy as np
from pyspark.sql import functions as F

from panewise.operators.late import (
    batch_watermarks,
    classify_late,
    exact_quantiles,
    late_events,
    late_stats,
    lateness_profile,
    metrics_excluding_late,
    on_time_events,
)
from panewise.schema import Params

SCHEMA = "event_id string, user_id string, store_id string, amount double, event_time long, batch_id long"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("event_ts", F.timestamp_millis("event_time"))


def test_lateness_boundary(spark):
    # pane [0, 60000): with max = E + 14 999 it still accepts, at E + 15 000 it is closed.
    E = 60_000
    for max_ms, late in ((E + 14_999, False), (E + 15_000, True)):
        rows = [("f", "u", "s", 0.0, max_ms, 0), ("x", "u", "s", 1.0, 29_999, 1)]
        c = {r.event_id: r for r in classify_late(_df(spark, rows), Params()).collect()}
        # 29 999 lies in [-30 000, 30 000) and [0, 60 000); the newest one decides
        assert c["x"].is_late is late
        assert c["f"].is_late is False  # first batch: no watermark yet


def test_watermark_uses_earlier_batches_only(spark):
    rows = [("a", "u", "s", 0.0, 75_000, 0), ("b", "u", "s", 0.0, 29_999, 1), ("c", "u", "s", 0.0, 30_000, 1),
            ("d", "u", "s", 0.0, 500_000, 1), ("e", "u", "s", 0.0, 1, 1)]
    wm = {r.batch_id: r for r in batch_watermarks(_df(spark, rows)).collect()}
    assert wm[0].max_prev_ms is None and wm[1].max_prev_ms == 75_000 and wm[1].watermark_ms == 64_999
    c = {r.event_id: r.is_late for r in classify_late(_df(spark, rows)).collect()}
    assert c == {"a": False, "b": True, "c": False, "d": False, "e": True}


def test_routing_is_a_partition_and_per_window(spark):
    rows = [("f", "u", "s", 0.0, 100_000, 0), ("b", "u", "s", 2.0, 40_000, 1)]
    c = classify_late(_df(spark, rows))
    assert late_events(c).count() + on_time_events(c).count() == 2
    # b (t=40 s) is in [0,60) and [30,90): the first is dead (60+15 <= 100), the second open (90+15 > 100)
    m = {r.window_start: r.order_cnt for r in metrics_excluding_late(c).collect()}
    assert m["1970-01-01 00:00:30"] == 1 and "1970-01-01 00:00:00" not in m


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    vals = {"a": rng.integers(0, 1000, 501), "b": rng.integers(0, 10, 37), "c": np.array([42]),
            "wide": rng.integers(-50_000, 200_000, 3001)}  # spans many value blocks, negatives included
    rows = [(k, int(v)) for k, arr in vals.items() for v in arr]
    df = spark.createDataFrame(rows, "k string, v long")
    got = {r.k: r for r in exact_quantiles(df, "v", ["k"], (0.0, 0.5, 0.95, 0.99, 1.0)).collect()}
    for k, arr in vals.items():
        for q, name in ((0.0, "p0"), (0.5, "p50"), (0.95, "p95"), (0.99, "p99"), (1.0, "p100")):
            assert abs(got[k][name] - float(np.quantile(arr, q))) < 1e-9


def test_lateness_profile_and_stats(spark):
    rows = [(f"e{i}", "u", "s" if i % 2 else "t", 1.0, 10_000 * i, 10_000 * i + (i % 7) * 1000) for i in range(100)]
    df = spark.createDataFrame(rows, "event_id string, user_id string, store_id string, amount double, "
                                     "event_time long, arrival_ms long")
    ex = {r.store_id: r for r in lateness_profile(df).collect()}
    ap = {r.store_id: r for r in lateness_profile(df, exact=False).collect()}
    assert set(ex) == {"s", "t"} and ex["s"].rows == 50 and ex["s"].max_delay_ms == 6000
    assert abs(ex["s"].p50 - ap["s"].p50) <= 1000
    late = spark.createDataFrame([("s", 5_000, 10_000), ("s", 1_000, 10_000), ("t", 0, 3_700_000)],
                                 "store_id string, event_time long, watermark_ms long")
    st = {r.store_id: r for r in late_stats(late, alert_threshold=2).collect()}
    assert st["s"].late_cnt == 2 and st["s"].max_lateness_ms == 9_000 and st["s"].alert
    assert st["t"].bucket_start == "1970-01-01 01:00:00" and not st["t"].alert


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from panewise.operators import window_metrics  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 400_000), st.integers(0, 10_000), st.sampled_from(["s", "t"]),
                          st.integers(0, 4)), min_size=1, max_size=60))
def test_property_disorder_within_bound_loses_nothing(spark, rows):
    """Arrivals at most 10 s behind their event time: every row counts in every window it belongs to."""
    data = [(f"e{i}", f"u{u}", s, float(i % 7), t, (t + d) // 1000) for i, (t, d, s, u) in enumerate(rows)]
    df = _df(spark, data)
    classified = classify_late(df)
    assert classified.filter("is_late").count() == 0
    got = sorted(map(tuple, metrics_excluding_late(classified).collect()))
    exp = sorted(map(tuple, window_metrics(df.orderBy("event_time")).collect()))
    assert got == exp
