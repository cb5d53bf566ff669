"""Panes, boundaries and metrics against a brute-force model."""

import math
import random

from pyspark.sql import functions as F

from panewise.operators import window_metrics
from panewise.operators.windows import assign_panes
from panewise.schema import Params

SCHEMA = "event_id string, user_id string, store_id string, amount double, event_time long"


def _events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("event_ts", F.timestamp_millis("event_time"))


def _panes(spark, t):
    df = _events(spark, [("e", "u", "s", 1.0, t)])
    p = assign_panes(df).select(F.unix_millis("window.start").alias("s"), F.unix_millis("window.end").alias("e"))
    return sorted(tuple(r) for r in p.collect())


def test_pane_boundaries(spark):
    # t = 00:00:30.000 -> [00:00:00, 00:01:00) and [00:00:30, 00:01:30)
    assert _panes(spark, 30_000) == [(0, 60_000), (30_000, 90_000)]
    # t = 00:00:29.999 -> [-00:00:30, 00:00:30) and [00:00:00, 00:01:00)
    assert _panes(spark, 29_999) == [(-30_000, 30_000), (0, 60_000)]
    # epoch: one pane starts in 1969
    assert _panes(spark, 0) == [(-30_000, 30_000), (0, 60_000)]


def _brute(rows, size, slide):
    out = {}
    for _e, u, s, a, t in rows:
        start = (t // slide) * slide
        while start > t - size:
            k = (start, s)
            c, g, us = out.get(k, (0, 0.0, set()))
            out[k] = (c + 1, g + a, us | {u})
            start -= slide
    return {k: (c, math.floor(g * 100 + 0.5) / 100, len(us)) for k, (c, g, us) in out.items()}


def test_metrics_match_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (f"e{i}", f"u{rng.randrange(5)}", rng.choice(["n", "s", "e"]), round(rng.uniform(-5, 200), 2),
         rng.randrange(0, 600_000))
        for i in range(400)
    ]
    for size, slide in ((60_000, 30_000), (60_000, 60_000), (90_000, 30_000)):
        p = Params(size_ms=size, slide_ms=slide)
        m = window_metrics(_events(spark, rows), p, keep_window=True).collect()
        got = {(r.window_start_ms, r.store_id): (r.order_cnt, r.gmv_total, r.user_cnt) for r in m}
        assert got == _brute(rows, size, slide)


def test_output_schema_and_text(spark):
    m = window_metrics(_events(spark, [("e", "u", "s", 1.234, 30_000)]))
    assert m.columns == ["window_start", "window_end", "store_id", "order_cnt", "gmv_total", "user_cnt"]
    assert [f.dataType.simpleString() for f in m.schema.fields] == ["string", "string", "string", "bigint", "double",
                                                                    "bigint"]
    assert sorted(r.window_start for r in m.collect()) == ["1970-01-01 00:00:00", "1970-01-01 00:00:30"]


def test_extra_dimensions_and_approx(spark):
    rows = [(f"e{i}", f"u{i % 7}", "s", 1.0, 1000 * i) for i in range(50)]
    df = _events(spark, rows).withColumn("city", F.when(F.col("event_time") % 2000 == 0, "a").otherwise("b"))
    m = window_metrics(df, Params(size_ms=60_000, slide_ms=60_000), keys=("store_id", "city"))
    assert {r.city for r in m.collect()} == {"a", "b"}
    approx = window_metrics(df, Params(size_ms=60_000, slide_ms=60_000), exact=False).first()
    assert abs(approx.user_cnt - 7) <= 1


def test_partial_aggregation_before_shuffle(spark):
    m = window_metrics(_events(spark, [("e", "u", "s", 1.0, 1)]))
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan
