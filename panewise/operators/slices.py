"""T3 by shared slices: every row is aggregated once into its slice of time; windows are sums of slices.

A slice is the greatest width that divides size and slide, so each window is a whole number of slices.
A row enters one slice (not ``size/slide`` windows), and only the partial rows of the slices are repeated for the windows they
belong to. Partial rows keep counts and sums by (slice, keys, user) or, with user numbers, by (slice, keys, word of 64
users): they merge exactly, so hours, days and changed window sizes are computed from stored
slices, without the events.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panewise.functions import half_up_round, ms_to_text
from panewise.operators.distinct import BITS, WORD, counted_users, merged_bits, user_bits, user_word
from panewise.schema import Params


def slice_width(params: Params) -> int:
    return math.gcd(params.size_ms, params.slide_ms)


def floor_to(ms: Column, width: int) -> Column:
    return F.floor(ms / F.lit(width)).cast("bigint") * F.lit(width)


def slices(df: DataFrame, params: Params = Params(), keys=None, numbered: bool = False, width: int | None = None, time_col: str = "event_time") -> DataFrame:
    """Partial rows (slice_ms, keys, grain, order_cnt, gmv); the grain is ``user_id``, or with ``numbered`` the words of ``user_no``."""
    keys = list(keys or params.keys)
    at = floor_to(F.col(time_col), width or slice_width(params)).alias("slice_ms")
    return partial_rows(df, [at, *keys], numbered)


def partial_rows(df: DataFrame, group: list, numbered: bool) -> DataFrame:
    grain, bits = (user_word(), [user_bits()]) if numbered else (F.col("user_id"), [])
    return df.groupBy(*group, grain).agg(F.count(F.lit(1)).alias("order_cnt"), F.sum("amount").alias("gmv"), *bits)


def window_starts(slice_ms: Column, size_ms: int, slide_ms: int) -> Column:
    """Starts of the windows that hold a slice."""
    last = floor_to(slice_ms, slide_ms)
    return F.sequence(floor_to(slice_ms - F.lit(size_ms), slide_ms) + F.lit(slide_ms), last, F.lit(slide_ms).cast("bigint"))


def to_windows(partials: DataFrame, params: Params = Params()) -> DataFrame:
    """Partial rows of slices as partial rows of windows, under ``window_start_ms``."""
    starts = F.explode(window_starts(F.col("slice_ms"), params.size_ms, params.slide_ms))
    return partials.withColumn("window_start_ms", starts).drop("slice_ms")


def merge(partials: DataFrame, group: list[str]) -> DataFrame:
    """Partial rows of equal group and grain become one."""
    numbered = WORD in partials.columns
    sums = [F.sum("order_cnt").alias("order_cnt"), F.sum("gmv").alias("gmv")]
    return partials.groupBy(*group, WORD if numbered else "user_id").agg(*sums, *([merged_bits()] if numbered else []))


def totals(partials: DataFrame, group: list[str]) -> DataFrame:
    """``order_cnt``, ``gmv`` and exact ``user_cnt`` per group, from partial rows that may repeat a grain."""
    users = counted_users() if BITS in partials.columns else F.count("user_id").alias("user_cnt")
    return merge(partials, group).groupBy(*group).agg(F.sum("order_cnt").alias("order_cnt"), F.sum("gmv").alias("gmv"), users)


def window_metrics_of(partials: DataFrame, params: Params = Params(), keys=None, keep_ms: bool = False) -> DataFrame:
    """Partial rows of windows -> the metric rows of ``window_metrics``."""
    keys = list(keys or params.keys)
    end_ms = F.col("window_start_ms") + F.lit(params.size_ms)
    return totals(partials, ["window_start_ms", *keys]).select(
        ms_to_text(F.col("window_start_ms")).alias("window_start"), ms_to_text(end_ms).alias("window_end"), *keys,
        "order_cnt", half_up_round(F.col("gmv"), 2).alias("gmv_total"), "user_cnt", *(["window_start_ms", end_ms.alias("window_end_ms")] if keep_ms else []),
    )


def sliced_metrics(df: DataFrame, params: Params = Params(), keys=None, keep_ms: bool = False) -> DataFrame:
    """Window metrics by way of slices, in one pass."""
    return window_metrics_of(to_windows(slices(df, params, keys), params), params, keys, keep_ms)


def dimension_metrics(df: DataFrame, sets: list[list[str]], params: Params = Params()) -> DataFrame:
    """A6 for several sets of keys in one pass over the rows: window metrics for each set of ``sets``.

    Rows are aggregated once by all keys and user; the sets are formed over those partial rows. ``grouping_id``
    has a bit for each key in order of first mention (the last is bit 0), set where the key is not in the row's set; such a key is null.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    windows = merge(to_windows(slices(df, params, keys), params), ["window_start_ms", *keys])
    group = ["window_start_ms", *keys, "user_id"]
    level = sum(F.grouping(k).cast("int") * F.lit(1 << i) for i, k in enumerate(reversed(keys)))
    each = windows.groupingSets([["window_start_ms", *s, "user_id"] for s in sets], *group).agg(
        level.alias("grouping_id"), F.sum("order_cnt").alias("order_cnt"), F.sum("gmv").alias("gmv")
    )
    each = each.select(*group, "grouping_id", "order_cnt", "gmv")
    return window_metrics_of(each, params, ["grouping_id", *keys])
