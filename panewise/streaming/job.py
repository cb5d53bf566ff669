"""The metrics stream built from the shared operators.

``source -> parse -> TTL dedup -> withWatermark(bound + lateness) -> window metrics``.
The watermark is placed after the stateful dedup (a watermark set before it
does not reach the aggregate). With a delay of ``bound + lateness`` Spark
evicts a window exactly when the job stops accepting late rows for it.

* ``update`` mode re-emits a window whenever rows arrive for it (allowed-late
  rows included); the versioned table keeps the newest version per key.
* ``append`` mode emits one final row per window once it is closed.

Exactly-once: offsets and state live in ``checkpointLocation``; every
micro-batch writes its own table partition with dynamic overwrite, so a
replayed batch rewrites instead of duplicating.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from panewise.operators.parse import anomalies, parse_orders, valid_orders
from panewise.operators.windows import user_metrics, window_metrics
from panewise.plans.table import MetricsTable, write_rows
from panewise.schema import Params
from panewise.streaming.dedup import dedup_stream


@dataclass
class MetricsStream:
    parsed: DataFrame
    anomalies: DataFrame
    deduped: DataFrame
    metrics: DataFrame
    output_mode: str = "append"


def build_metrics_stream(
    messages: DataFrame,
    params: Params = Params(),
    exact: bool = True,
    order_cols: tuple[str, ...] = ("ingest_ms",),
    output_mode: str = "append",
    engine: str = "bucketed",
) -> MetricsStream:
    """``output_mode="append"`` (default) counts distinct users exactly in two chained aggregations: no state row
    holds a window's users. ``"update"`` re-emits open windows; its exact form keeps and emits one row per window, store and
    user, which the table keeps by user and sums when it is read."""
    parsed = parse_orders(messages)
    valid = valid_orders(parsed)
    order = tuple(c for c in order_cols if c in valid.columns)
    deduped = dedup_stream(valid, "event_id", params.ttl_ms, order, engine=engine)
    timed = deduped.withWatermark("event_ts", params.delay)
    if exact and output_mode != "append":
        metrics = user_metrics(timed, params)
    else:
        metrics = window_metrics(timed, params, exact=exact, keep_window=True).drop("window")
    return MetricsStream(parsed, anomalies(parsed), deduped, metrics, output_mode)


def start_metrics_query(
    stream: MetricsStream,
    table: MetricsTable,
    checkpoint: str,
    output_mode: str | None = None,
    trigger_seconds: int | None = 30,
    epoch: int = 0,
    name: str | None = None,
) -> StreamingQuery:
    """Sink the metrics into the versioned table; one table version per micro-batch."""
    output_mode = output_mode or stream.output_mode

    def sink(df: DataFrame, batch_id: int) -> None:
        table.write_batch(df, batch_id=batch_id, epoch=epoch)

    w = stream.metrics.writeStream.outputMode(output_mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    if name:
        w = w.queryName(name)
    return w.start()


def start_anomaly_query(stream: MetricsStream, path: str, checkpoint: str, trigger_seconds: int | None = 30) -> StreamingQuery:
    """Dead-letter rows, one partition per micro-batch (rewritten on replay)."""

    def sink(df: DataFrame, batch_id: int) -> None:
        write_rows(df, path, batch_id)

    w = stream.anomalies.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
