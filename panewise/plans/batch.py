"""The job in batch form: bounded history -> parse -> dedup -> late routing -> metrics.

Same operators as the stream, applied to a bounded DataFrame that carries an
arrival clock (``arrival_ms``) and a micro-batch id (``batch_id``). Used for
replay/backfill (S10) and as the reference the streaming result is tested against.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.functions import date_key, ms_to_text
from panewise.operators.dedup import DEFAULT_MAX_LIGHT, dedup_ttl
from panewise.operators.late import batch_watermarks, classify_late, late_events, metrics_excluding_late
from panewise.operators.parse import anomalies, parse_orders, valid_orders
from panewise.operators.windows import window_metrics
from panewise.schema import Params
from panewise.session import write_shared
from panewise.sources.encode import encode_orders


@dataclass
class JobOutputs:
    parsed: DataFrame
    anomalies: DataFrame
    deduped: DataFrame
    classified: DataFrame
    watermarks: DataFrame
    late: DataFrame
    metrics: DataFrame


def flagship_metrics(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Minimum slice: orders -> JSON messages -> parse -> sliding-window metrics."""
    return window_metrics(valid_orders(parse_orders(encode_orders(orders))), params)


def run_job(
    messages: DataFrame,
    params: Params = Params(),
    arrival_col: str = "arrival_ms",
    batch_col: str = "batch_id",
    max_light: int = DEFAULT_MAX_LIGHT,
) -> JobOutputs:
    """Raw messages with an arrival clock and batch id -> every output of the job.

    The text is scanned and parsed once, into columnar files in the shared checkpoint folder
    (raw text kept for dead letters only); watermarks, key counts and all outputs read their columns there.
    """
    parsed = parse_orders(messages)
    parsed = parsed.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
    parsed = write_shared(parsed, "parsed")
    valid = valid_orders(parsed)
    # The job assigns its watermark before dedup: every valid row moves it, duplicates included.
    watermarks = batch_watermarks(valid, params, batch_col)
    deduped = dedup_ttl(valid, "event_id", arrival_col, params.ttl_ms, max_light=max_light)
    classified = write_shared(classify_late(deduped, params, batch_col, watermarks=watermarks), "classified")
    return JobOutputs(
        parsed=parsed,
        anomalies=anomalies(parsed),
        deduped=deduped,
        classified=classified,
        watermarks=watermarks,
        late=late_events(classified),
        metrics=metrics_excluding_late(classified, params),
    )


def replay_range(from_ms: int, to_ms: int, params: Params = Params()) -> tuple[int, int]:
    """Arrival times a replay of the windows in ``[from_ms, to_ms)`` has to read, if no row is delayed by more than the TTL.

    Before: the rows that can hold a key's TTL clock or move the watermark; after: late rows and copies.
    """
    reach = (params.ttl_ms or 0) + params.size_ms + params.delay_ms
    return from_ms - 2 * reach, to_ms + 2 * reach


def backfill(table, messages: DataFrame, epoch: int, from_ms: int, to_ms: int, params: Params = Params(), **kw) -> DataFrame:
    """Recompute the windows that lie fully in ``[from_ms, to_ms)`` and write them as a newer version.

    ``messages`` must reach beyond the range on both sides (``replay_range``); windows that
    are only partly covered are never written. Windows of the range that have no rows in the replay get a
    tombstone. Returns the written rows.
    """
    start, end = (ms_to_text(F.lit(ms).cast("bigint")) for ms in (from_ms, to_ms))
    inside = (F.col("window_start") >= start) & (F.col("window_end") <= end)
    key = ["window_start", *table.keys]
    fresh = write_shared(run_job(messages, params, **kw).metrics.filter(inside), "backfill")
    days = [r[0] for r in messages.sparkSession.range(1).select(F.array(*[date_key(F.lit(ms).cast("bigint")) for ms in (from_ms, to_ms)])).collect()][0]
    gone = table.latest(*days).filter(inside).join(fresh.select(*key), key, "left_anti")
    gone = gone.select(*fresh.columns).withColumns({"order_cnt": F.lit(0).cast("bigint"), "gmv_total": F.lit(0.0), "user_cnt": F.lit(0).cast("bigint")})
    rows = fresh.unionByName(gone)
    table.write_batch(rows, batch_id=0, epoch=epoch)
    return rows
