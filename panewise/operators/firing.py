"""T6 in batch form: the log of all window firings.

A window fires when the largest event time seen first reaches its end plus the bound, and again
with every later batch that brings rows which still count in it. Each firing
carries the window's metrics over all rows up to that batch.

Scale: rows are first aggregated to (window, key, batch); distinct users enter as the batch
in which a user is first seen, so running sums give the exact distinct count. Running sums are windows
over the batches of one (window, key), of which there are as many as the lateness admits. The batch that fires a
window is found by an as-of join: the running maximum of the batches, taken only where it moves, against the distinct window
ends. Its work is in proportion to those two, whatever the span of time and the trigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panewise.functions import half_up_round, ms_to_text, timestamp_to_ms
from panewise.operators.asof import asof_join
from panewise.operators.late import is_dead
from panewise.operators.windows import assign_panes
from panewise.schema import Params

#: Width of a slot of the as-of join: a few hundred window ends, and the batches of that time.
SLOT_MS = 6 * 3_600_000


def first_firings(ends: DataFrame, watermarks: DataFrame, params: Params = Params(), batch_col: str = "batch_id") -> DataFrame:
    """(end_ms, fire_batch) for the distinct ends that some batch reaches: the first whose running maximum is the end plus the bound."""
    reached = F.greatest("max_prev_ms", "batch_max_ms")
    moves = watermarks.filter(F.col("max_prev_ms").isNull() | (F.col("batch_max_ms") > F.col("max_prev_ms")))
    moves = moves.select(reached.alias("_reached"), F.col(batch_col).alias("fire_batch"))
    at = ends.select("end_ms").distinct().withColumn("_at", F.col("end_ms") + F.lit(params.bound_ms))
    hit = asof_join(at, moves, "_at", "_reached", direction="forward", ties="min", slot_ms=SLOT_MS)
    return hit.filter("fire_batch IS NOT NULL").select("end_ms", "fire_batch")


def firing_log(classified: DataFrame, watermarks: DataFrame, params: Params = Params(), keys=None, batch_col: str = "batch_id") -> DataFrame:
    """One row per firing: ``batch_id``, the window's texts, the keys and the metrics so far."""
    keys = list(keys or params.keys)
    panes = assign_panes(classified, params).withColumn("end_ms", timestamp_to_ms(F.col("window.end")))
    panes = panes.filter(~is_dead(F.col("end_ms"), F.col("max_prev_ms"), params)).withColumn("start_ms", timestamp_to_ms(F.col("window.start")))
    pane = ["start_ms", "end_ms", *keys]
    sums = panes.groupBy(*pane, F.col(batch_col).alias("_b")).agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_g"))
    first_seen = panes.groupBy(*pane, "user_id").agg(F.min(batch_col).alias("_b"))
    users = first_seen.groupBy(*pane, "_b").agg(F.count("user_id").alias("_u"))
    each = sums.join(users, [*pane, "_b"], "left")
    so_far = Window.partitionBy(*pane).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.select(*pane, "_b", *[F.sum(F.coalesce(c, F.lit(0))).over(so_far).alias(c) for c in ("_n", "_g", "_u")])
    fired = each.join(first_firings(each, watermarks, params, batch_col), "end_ms")
    fired = fired.withColumn("_fire", F.greatest("_b", "fire_batch"))
    last = fired.groupBy(*pane, "_fire").agg(F.max_by(F.struct("_n", "_g", "_u"), "_b").alias("m"))
    return last.select(
        F.col("_fire").alias(batch_col), ms_to_text(F.col("start_ms")).alias("window_start"), ms_to_text(F.col("end_ms")).alias("window_end"),
        *keys, F.col("m._n").alias("order_cnt"), half_up_round(F.col("m._g"), 2).alias("gmv_total"), F.col("m._u").alias("user_cnt"),
    )
