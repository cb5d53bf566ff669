"""Order metrics per key over sliding event-time windows.

``order_cnt`` counts rows, ``gmv_total`` is the amount sum rounded half-up to
two decimals, ``user_cnt`` the exact number of distinct users. Panes are
aligned to the epoch, start inclusive, end exclusive; with size/slide = 2 each
row falls in two panes (Spark's ``window`` expands it).

Scale: count and sum are partially aggregated before the shuffle, so a hot
store costs one partial row per map task and pane. The exact distinct count
is planned by Catalyst as a (pane, key, user) pre-aggregation, then a second
aggregation by (pane, key): no group is ever collected into one task. In a
stream, exact distinct needs ``collect_set`` state (size = users per pane);
``approx_count_distinct`` (A4) keeps a fixed-size sketch instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.functions import half_up_round, ms_to_text, timestamp_to_ms
from panewise.schema import Params


def _distinct_users(df: DataFrame, exact: bool, rsd: float):
    if not exact:
        return F.approx_count_distinct("user_id", rsd).cast("bigint")
    return F.count_distinct("user_id").cast("bigint")


def assign_panes(df: DataFrame, params: Params = Params(), ts_col: str = "event_ts") -> DataFrame:
    """One row per (row, pane) with the pane in ``window`` (batch: an Expand over ``size/slide`` panes)."""
    return df.select("*", F.window(F.col(ts_col), params.size, params.slide).alias("window"))


def aggregate_panes(
    panes: DataFrame, params: Params = Params(), keys=None, exact: bool = True, rsd: float = 0.05,
    keep_window: bool = False,
) -> DataFrame:
    """Metrics of rows already assigned to panes (see ``assign_panes``)."""
    return _finish(panes.groupBy("window", *(keys or params.keys)), panes, params, keys, exact, rsd, keep_window)


def window_metrics(
    df: DataFrame,
    params: Params = Params(),
    keys: list[str] | tuple[str, ...] | None = None,
    exact: bool = True,
    rsd: float = 0.05,
    ts_col: str = "event_ts",
    keep_window: bool = False,
) -> DataFrame:
    """Parsed events -> one metric row per (window, keys).

    Output columns: ``window_start, window_end`` (UTC text), the keys,
    ``order_cnt, gmv_total, user_cnt``; with ``keep_window`` also the window
    struct and ``window_start_ms, window_end_ms`` (for versioned writes).

    Of a stream, the exact form chains two stateful aggregations, (window, keys, user) then (window, keys), which
    append mode allows; for update mode see ``user_metrics``.
    """
    win = F.window(F.col(ts_col), params.size, params.slide).alias("window")
    keys = list(keys or params.keys)
    if df.isStreaming and exact:
        per_user = df.groupBy(win, *keys, "user_id").agg(
            F.count(F.lit(1)).alias("_c"), F.sum("amount").alias("_g")
        )
        agg = per_user.groupBy("window", *keys).agg(
            F.sum("_c").alias("order_cnt"),
            F.sum("_g").alias("_gmv"),
            F.count("user_id").alias("user_cnt"),
        )
        return _project(agg, keys, keep_window)
    return _finish(df.groupBy(win, *keys), df, params, keys, exact, rsd, keep_window)


def user_metrics(df: DataFrame, params: Params = Params(), keys=None, ts_col: str = "event_ts") -> DataFrame:
    """Parsed events -> one row per (window, keys, user): the grain of an update-mode stream.

    ``gmv_total`` is the plain sum, rounded only when users are summed up (``MetricsTable.latest``); ``user_cnt`` is 1, for
    the rows without user 0.
    """
    keys = list(keys or params.keys)
    agg = df.groupBy(F.window(F.col(ts_col), params.size, params.slide).alias("window"), *keys, "user_id").agg(
        F.count(F.lit(1)).alias("order_cnt"), F.sum("amount").alias("gmv_total")
    )
    start_ms, end_ms = (timestamp_to_ms(F.col(f"window.{x}")) for x in ("start", "end"))
    return agg.select(
        ms_to_text(start_ms).alias("window_start"), ms_to_text(end_ms).alias("window_end"), *keys, "user_id", "order_cnt", "gmv_total",
        F.col("user_id").isNotNull().cast("bigint").alias("user_cnt"), start_ms.alias("window_start_ms"), end_ms.alias("window_end_ms"),
    )


def _finish(grouped, df, params, keys, exact, rsd, keep_window):
    keys = list(keys or params.keys)
    agg = grouped.agg(
        F.count(F.lit(1)).alias("order_cnt"),
        F.sum("amount").alias("_gmv"),
        _distinct_users(df, exact, rsd).alias("user_cnt"),
    )
    return _project(agg, keys, keep_window)


def _project(agg, keys, keep_window):
    start_ms = timestamp_to_ms(F.col("window.start"))
    end_ms = timestamp_to_ms(F.col("window.end"))
    cols = [
        ms_to_text(start_ms).alias("window_start"),
        ms_to_text(end_ms).alias("window_end"),
        *keys,
        F.col("order_cnt"),
        half_up_round(F.col("_gmv"), 2).alias("gmv_total"),
        F.col("user_cnt"),
    ]
    if keep_window:
        cols += [F.col("window"), start_ms.alias("window_start_ms"), end_ms.alias("window_end_ms")]
    return agg.select(*cols)
