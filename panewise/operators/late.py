"""T5/R2/T4 (batch form), A7, A8: watermarks over bounded history, late routing, lateness statistics.

The job's watermark is ``max(event_time) - bound - 1`` and a window is dead for
late rows once ``end - 1 + lateness <= watermark``, i.e. once
``end + bound + lateness <= max(event_time)``. Spark moves its watermark once
per micro-batch, so over a history with a ``batch_id`` column the maximum is
taken over strictly earlier batches. Lateness is judged per (row, window): a
row can miss its older window and still count in the newer one; a row is
routed to the late output only when its newest window is dead too.

Scale: the per-batch table has one row per batch (time span / trigger
interval, independent of data volume). It is materialised, its size checked,
and broadcast only under the limit; above it the join is a plain shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panewise.functions import ms_to_text, timestamp_to_ms
from panewise.operators.windows import aggregate_panes, assign_panes
from panewise.schema import Params
from panewise.session import write_shared

VALUE_BLOCK = 4096


BATCH_BLOCK = 1024


def batch_watermarks(
    df: DataFrame, params: Params = Params(), batch_col: str = "batch_id", time_col: str = "event_time"
) -> DataFrame:
    """R2: per batch, the max event time of all earlier batches and the watermark it implies.

    Two-level prefix maximum: within blocks of ``BATCH_BLOCK`` consecutive batch
    ids (window partitioned by block), plus the maxima of earlier blocks (the only
    unpartitioned window, over one row per block).
    """
    per_batch = df.groupBy(batch_col).agg(F.max(time_col).alias("batch_max_ms"), F.min(time_col).alias("batch_min_ms"))
    per_batch = write_shared(per_batch, "batches")  # read from both sides of the join below
    per_batch = per_batch.withColumn("_blk", F.floor(F.col(batch_col) / F.lit(BATCH_BLOCK)))
    in_block = Window.partitionBy("_blk").orderBy(batch_col).rowsBetween(Window.unboundedPreceding, -1)
    blocks = per_batch.groupBy("_blk").agg(F.max("batch_max_ms").alias("_bm"))
    earlier_blocks = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_blk", F.max("_bm").over(earlier_blocks).alias("_prev_blocks"))
    joined = per_batch.withColumn("_prev_in", F.max("batch_max_ms").over(in_block)).join(blocks, "_blk")
    max_prev = F.greatest(F.col("_prev_in"), F.col("_prev_blocks"))
    return joined.select(
        batch_col,
        "batch_max_ms",
        "batch_min_ms",
        max_prev.alias("max_prev_ms"),
        (max_prev - F.lit(params.bound_ms + 1)).alias("watermark_ms"),
    )


def last_window_end(t, params: Params):
    """End of the newest window containing event time ``t`` (epoch-aligned panes)."""
    slide = F.lit(params.slide_ms).cast("bigint")
    return F.floor(t / slide).cast("bigint") * slide + F.lit(params.size_ms)


def is_dead(window_end_ms, max_prev_ms, params: Params):
    """True when a window ending at ``window_end_ms`` no longer accepts rows."""
    return max_prev_ms.isNotNull() & (window_end_ms + F.lit(params.delay_ms) <= max_prev_ms)


def classify_late(
    df: DataFrame,
    params: Params = Params(),
    batch_col: str = "batch_id",
    time_col: str = "event_time",
    watermarks: DataFrame | None = None,
) -> DataFrame:
    """Attach ``max_prev_ms``, ``watermark_ms`` and ``is_late`` (all windows of the row dead)."""
    wm = watermarks if watermarks is not None else batch_watermarks(df, params, batch_col, time_col)
    # one row per batch; whether it is broadcast is decided by its bytes at run time
    wm = write_shared(wm.select(batch_col, "max_prev_ms", "watermark_ms"), "watermarks")
    joined = df.join(wm, batch_col, "left")
    late = is_dead(last_window_end(F.col(time_col), params), F.col("max_prev_ms"), params)
    return joined.withColumn("is_late", late)


def late_events(classified: DataFrame) -> DataFrame:
    """S9 rows: the late events with the watermark they missed."""
    return classified.filter("is_late").drop("is_late", "max_prev_ms")


def on_time_events(classified: DataFrame) -> DataFrame:
    return classified.filter(~F.col("is_late")).drop("is_late")


def metrics_excluding_late(
    classified: DataFrame, params: Params = Params(), keys=None, exact: bool = True, ts_col: str = "event_ts",
    keep_window: bool = False,
) -> DataFrame:
    """T4 final state: window metrics counting each row only in windows still open on its arrival."""
    panes = assign_panes(classified, params, ts_col)
    alive = ~is_dead(timestamp_to_ms(F.col("window.end")), F.col("max_prev_ms"), params)
    return aggregate_panes(panes.filter(alive), params, keys, exact, keep_window=keep_window)


def late_stats(late: DataFrame, keys=("store_id",), alert_threshold: int = 10, bucket_ms: int = 3_600_000) -> DataFrame:
    """Per key and watermark hour, late count, mean and max lateness (watermark - event time), alert flag."""
    lateness = F.col("watermark_ms") - F.col("event_time")
    bucket = F.floor(F.col("watermark_ms") / F.lit(bucket_ms)).cast("bigint") * F.lit(bucket_ms)
    agg = late.groupBy(*keys, ms_to_text(bucket).alias("bucket_start")).agg(
        F.count(F.lit(1)).alias("late_cnt"),
        F.avg(lateness).alias("avg_lateness_ms"),
        F.max(lateness).alias("max_lateness_ms"),
    )
    return agg.withColumn("alert", F.col("late_cnt") >= F.lit(alert_threshold))


def exact_quantiles(df: DataFrame, value_col: str, keys, quantiles=(0.5, 0.95, 0.99)) -> DataFrame:
    """Exact linear-interpolation quantiles per key from a distributed histogram.

    ``groupBy(keys, value).count()`` is combinable, so a hot key costs one row per
    distinct value. A running sum over each key's histogram gives every value's
    rank range; the two ranks around ``q * (n - 1)`` are picked with
    conditional aggregates. The histogram of one key is bounded by its number
    of distinct values, never by its row count.
    """
    keys = list(keys)
    hist = df.groupBy(*keys, value_col).agg(F.count(F.lit(1)).alias("_c"))
    hist = write_shared(hist, "histogram")  # read twice below; far smaller than the rows
    # Two-level running sum: per value block (window over one row per block and key),
    # then inside each (key, block); no window partition holds a key's whole histogram.
    hist = hist.withColumn("_blk", F.floor(F.col(value_col) / F.lit(VALUE_BLOCK)))
    blocks = hist.groupBy(*keys, "_blk").agg(F.sum("_c").alias("_bc"))
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        *keys, "_blk",
        F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_before"),
        F.sum("_bc").over(by_key).alias("_n"),
    )
    running = Window.partitionBy(*keys, "_blk").orderBy(value_col).rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("_in", F.sum("_c").over(running)).join(blocks, [*keys, "_blk"])
    hist = hist.withColumn("_hi", F.col("_before") + F.col("_in"))
    hist = hist.withColumn("_lo", F.col("_hi") - F.col("_c"))
    aggs = [F.max("_n").alias("n"), F.max(value_col).alias("max_value")]
    for i, q in enumerate(quantiles):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(q))
        for side, idx in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (F.col("_lo") <= idx) & (idx < F.col("_hi"))
            aggs.append(F.max(F.when(hit, F.col(value_col))).alias(f"_q{i}_{side}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_q{i}_frac"))
    res = hist.groupBy(*keys).agg(*aggs)
    out = [*keys, "n", "max_value"]
    for i, q in enumerate(quantiles):
        lo = F.col(f"_q{i}_lo").cast("double")
        hi = F.col(f"_q{i}_hi").cast("double")
        out.append((lo + F.col(f"_q{i}_frac") * (hi - lo)).alias(_qname(q)))
    return res.select(*out)


def _qname(q: float) -> str:
    return "p" + f"{q * 100:g}".replace(".", "_")


def lateness_profile(
    df: DataFrame,
    arrival_col: str = "arrival_ms",
    time_col: str = "event_time",
    keys=("store_id",),
    quantiles=(0.5, 0.95, 0.99),
    exact: bool = True,
) -> DataFrame:
    """Distribution of arrival delay, to choose the out-of-orderness bound.

    ``exact=False`` uses ``percentile_approx`` (fixed-size sketch, streaming-safe).
    """
    delayed = df.withColumn("delay_ms", F.col(arrival_col) - F.col(time_col))
    if exact:
        prof = exact_quantiles(delayed, "delay_ms", keys, quantiles)
        return prof.withColumnRenamed("n", "rows").withColumnRenamed("max_value", "max_delay_ms")
    pct = F.percentile_approx("delay_ms", list(quantiles), 10_000)
    agg = delayed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.max("delay_ms").alias("max_delay_ms"), pct.alias("_p")
    )
    return agg.select(*keys, "rows", "max_delay_ms",
                      *[F.col("_p")[i].cast("double").alias(_qname(q)) for i, q in enumerate(quantiles)])
