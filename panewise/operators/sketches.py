"""A4, A8 as stored sketches: distinct users and arrival delays per slice of time, merged for any longer range.

A sketch column of bounded size stands beside the exact counts of a slice. Hours and days are unions
of stored sketches; the events are not read again. Users: HyperLogLog (``lg_k`` 12: standard error 1.6 per
cent). Delays: KLL quantile sketches (``k`` 200: normalised rank error about 1.33 per cent at 99 per cent confidence).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.functions import half_up_round, ms_to_text
from panewise.operators.slices import floor_to

HOUR_MS = 3_600_000
LG_K, KLL_K = 12, 200
#: Three standard errors of the user count, and the rank error allowed to a quantile.
USER_TOLERANCE, RANK_TOLERANCE = 3 * 1.04 / 2 ** (LG_K / 2), 0.02


def user_sketches(df: DataFrame, keys=("store_id",), width_ms: int = HOUR_MS, time_col: str = "event_time") -> DataFrame:
    """(slice_ms, keys, order_cnt, gmv, users): counts, sums and a sketch of the distinct users of each slice."""
    at = floor_to(F.col(time_col), width_ms).alias("slice_ms")
    return df.groupBy(at, *keys).agg(F.count(F.lit(1)).alias("order_cnt"), F.sum("amount").alias("gmv"), F.hll_sketch_agg("user_id", LG_K).alias("users"))


def merge_user_sketches(sketches: DataFrame, width_ms: int, keys=("store_id",)) -> DataFrame:
    """Metrics per range of ``width_ms`` from stored slices; ``user_cnt`` is approximate."""
    merged = sketches.groupBy(floor_to(F.col("slice_ms"), width_ms).alias("slice_ms"), *keys).agg(
        F.sum("order_cnt").alias("order_cnt"), F.sum("gmv").alias("gmv"), F.hll_union_agg("users").alias("users"))
    return merged.select(
        ms_to_text(F.col("slice_ms")).alias("window_start"), ms_to_text(F.col("slice_ms") + F.lit(width_ms)).alias("window_end"), *keys,
        "order_cnt", half_up_round(F.col("gmv"), 2).alias("gmv_total"), F.hll_sketch_estimate("users").alias("user_cnt"),
    )


def delay_sketches(df: DataFrame, keys=("store_id",), width_ms: int = HOUR_MS, arrival_col: str = "arrival_ms", time_col: str = "event_time") -> DataFrame:
    """(slice_ms, keys, rows, max_delay_ms, delays): a quantile sketch of the arrival delays, by slice of the arrival time."""
    delay = F.col(arrival_col) - F.col(time_col)
    at = floor_to(F.col(arrival_col), width_ms).alias("slice_ms")
    return df.groupBy(at, *keys).agg(F.count(delay).alias("rows"), F.max(delay).alias("max_delay_ms"), F.kll_sketch_agg_bigint(delay, KLL_K).alias("delays"))


def merge_delay_sketches(sketches: DataFrame, keys=("store_id",), quantiles=(0.5, 0.95, 0.99)) -> DataFrame:
    """Delay quantiles per key over all slices given (filter them by ``slice_ms`` for a range)."""
    merged = sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.max("max_delay_ms").alias("max_delay_ms"), F.kll_merge_agg_bigint("delays").alias("delays"))
    at = [F.kll_sketch_get_quantile_bigint("delays", F.lit(float(q))).alias("p" + f"{q * 100:g}".replace(".", "_")) for q in quantiles]
    return merged.select(*keys, "rows", "max_delay_ms", *at)
