"""Late-event side output and the job's window firing, inside ``foreachBatch``.

Structured Streaming has no side output for rows an aggregate drops as late,
so routing is done per micro-batch against a persisted watermark log:

* ``wm_log`` holds one row per batch: ``(batch_id, max_event_ms)``. The
  maximum over strictly earlier batches gives the watermark this batch is
  judged by (Spark also moves its watermark once per batch). A retry of the
  same ``batch_id`` reads the same earlier rows, so routing is deterministic.
* Rows whose newest window is dead go to the late table; the rest go to the
  silver table with the ``max_prev_ms`` they were judged by, partitioned by
  event day so later re-reads are pruned.
* Firing follows the job: a window fires when the watermark first passes its
  end, and again for each batch that brings allowed-late rows to it. Fired
  windows are recomputed from silver (bounded by ``size + bound + lateness``
  behind the watermark) and written as a new table version.

* Late rows are counted as they come (A7): one small row per (store, hour of the watermark) and batch. ``late_stats``
  sums them; a (store, hour) is in the alert table once, under the batch whose rows brought it to the threshold.
* With ``partials`` (T5, S10) every batch also adds its partial metrics to a ``PartialsTable``: the (row, window) pairs
  that were open under ``on_time``, the others under ``late``, so that corrected metrics are read without any replay.

Every write replaces only partitions keyed by this ``batch_id``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panewise.functions import ms_to_text, timestamp_to_ms, utc_date
from panewise.operators.late import is_dead, last_window_end
from panewise.operators.parse import anomalies, parse_orders, valid_orders
from panewise.operators.windows import aggregate_panes, assign_panes
from panewise.plans.partials import PartialsTable, UserDictionary, late_partials, on_time_partials
from panewise.plans.table import MetricsTable, write_rows
from panewise.schema import MAX_EVENT_MS, MIN_EVENT_MS, Params
from panewise.session import path_exists
from panewise.streaming.dedup import AcceptedIds, dedup_stream

HOUR_MS = 3_600_000
WM_SCHEMA = T.StructType(
    [
        T.StructField("max_event_ms", T.LongType(), True),
        T.StructField("max_through_ms", T.LongType(), True),
        T.StructField("batch_id", T.LongType(), True),
    ]
)


class LateRouter:
    """Per-micro-batch routing and firing for deduplicated, parsed order events."""

    def __init__(self, spark: SparkSession, root: str, table: MetricsTable, params: Params = Params(), epoch: int = 0, alert_threshold: int = 10, with_partials: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.table = table
        self.params = params
        self.epoch = epoch
        self.alert_threshold = alert_threshold
        self.partials = PartialsTable(spark, self.path("partials"), params) if with_partials else None
        self.users = UserDictionary(spark, self.path("users")) if with_partials else None
        self._through: dict[int, int | None] = {}  # running max by batch id, mirrors wm_log

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _exists(self, name: str) -> bool:
        return path_exists(self.spark, self.path(name))

    def max_before(self, batch_id: int) -> int | None:
        """Max event time over all batches before ``batch_id``.

        Each log row carries the running maximum through its batch, and micro-batch
        ids are consecutive, so only the previous batch's partition is read (no
        listing of the whole log). A missing previous entry falls back to a scan.
        """
        if int(batch_id) - 1 in self._through:  # written by this driver; same value as on disk
            return self._through[int(batch_id) - 1]
        prev = f"wm_log/batch_id={int(batch_id) - 1}"
        if batch_id > 0 and self._exists(prev):
            row = self.spark.read.schema(T.StructType(WM_SCHEMA.fields[:2])).parquet(self.path(prev)).first()
            return None if row is None else row["max_through_ms"]
        if not self._exists("wm_log"):
            return None
        wm = self.spark.read.schema(WM_SCHEMA).parquet(self.path("wm_log"))
        return wm.filter(F.col("batch_id") < batch_id).agg(F.max("max_through_ms")).first()[0]

    def process(self, df: DataFrame, batch_id: int, batch_max: int | None = None) -> None:
        """Route one batch of deduplicated rows; ``batch_max`` is the largest event time of the batch
        with its duplicates (they move the watermark too), by default that of ``df``."""
        p = self.params
        df = df.persist()
        try:
            mp = self.max_before(batch_id)
            mp_col = F.lit(mp).cast("bigint")
            judged = df.withColumn("max_prev_ms", mp_col).withColumn(
                "watermark_ms", mp_col - F.lit(p.bound_ms + 1)
            )
            late = is_dead(last_window_end(F.col("event_time"), p), F.col("max_prev_ms"), p)
            judged = judged.withColumn("is_late", late)

            write_rows(judged.filter("is_late").drop("is_late", "max_prev_ms", "event_ts"), self.path("late"), batch_id)
            if mp is not None:
                self._count_late(judged.filter("is_late"), mp, batch_id)
            if self.partials is not None:
                self._add_partials(judged, batch_id)
            on_time = judged.filter(~F.col("is_late")).drop("is_late", "watermark_ms")
            silver_rows = (
                on_time.withColumn("event_day", utc_date(F.col("event_time")))
                .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
                .drop("event_ts")
            )
            self._silver_schema = silver_rows.schema  # read back with it: no schema inference per batch
            (
                silver_rows
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("event_day", "batch_id")
                .parquet(self.path("silver"))
            )
            if batch_max is None:
                batch_max = df.agg(F.max("event_time")).first()[0]
            through = max([m for m in (mp, batch_max) if m is not None], default=None)
            (
                self.spark.createDataFrame([(batch_max, through, int(batch_id))], WM_SCHEMA)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id")
                .parquet(self.path("wm_log"))
            )
            self._through = {int(batch_id): through}
            maxes = [m for m in (mp, batch_max) if m is not None]
            if maxes:
                fired = self.fire_windows(on_time, mp, max(maxes))
                if fired is not None:
                    self.table.write_batch(fired, batch_id=batch_id, epoch=self.epoch)
        finally:
            df.unpersist()

    def _count_late(self, late: DataFrame, max_prev: int, batch_id: int) -> None:
        """This batch's late counters, and alerts for what reaches the threshold now. A batch has one watermark, so one hour."""
        hour = (max_prev - self.params.bound_ms - 1) // HOUR_MS * HOUR_MS
        keys = list(self.params.keys)
        lateness = F.col("watermark_ms") - F.col("event_time")
        counted = late.groupBy(*keys).agg(F.count(F.lit(1)).alias("late_cnt"), F.sum(lateness).alias("lateness_sum"), F.max(lateness).alias("max_lateness_ms"))
        folder = f"{self.path('late_counts')}/hour_ms={hour}"
        counted.write.mode("overwrite").parquet(f"{folder}/batch_id={int(batch_id)}")
        counts = self.spark.read.schema(self._counts_schema()).option("basePath", self.path("late_counts")).parquet(folder)
        counts = counts.filter(F.col("batch_id") <= int(batch_id)).groupBy(*keys).agg(
            F.sum("late_cnt").alias("late_cnt"), F.sum(F.when(F.col("batch_id") < int(batch_id), F.col("late_cnt")).otherwise(0)).alias("_before"))
        new = counts.filter((F.col("late_cnt") >= self.alert_threshold) & (F.col("_before") < self.alert_threshold))
        new = new.select(*keys, ms_to_text(F.lit(hour).cast("bigint")).alias("bucket_start"), "late_cnt")
        write_rows(new, self.path("late_alerts"), batch_id)

    def _counts_schema(self) -> str:
        return ", ".join(f"`{k}` string" for k in self.params.keys) + ", late_cnt long, lateness_sum long, max_lateness_ms long, hour_ms long, batch_id long"

    def late_stats(self, from_ms: int | None = None, to_ms: int | None = None) -> DataFrame:
        """A7 from the counters, for the hours in ``[from_ms, to_ms)``: the rows of ``operators.late.late_stats``."""
        keys = list(self.params.keys)
        counts = self.spark.read.schema(self._counts_schema()).parquet(self.path("late_counts"))
        for bound, keep in ((from_ms, F.col("hour_ms") >= F.lit(from_ms)), (to_ms, F.col("hour_ms") < F.lit(to_ms))):
            counts = counts if bound is None else counts.filter(keep)
        total = counts.groupBy(*keys, "hour_ms").agg(F.sum("late_cnt").alias("late_cnt"), F.sum("lateness_sum").alias("_sum"), F.max("max_lateness_ms").alias("max_lateness_ms"))
        return total.select(*keys, ms_to_text(F.col("hour_ms")).alias("bucket_start"), "late_cnt", (F.col("_sum") / F.col("late_cnt")).alias("avg_lateness_ms"), "max_lateness_ms", (F.col("late_cnt") >= self.alert_threshold).alias("alert"))

    def late_alerts(self) -> DataFrame:
        """One row per (keys, hour) that has reached the threshold, with the count at that batch."""
        return self.spark.read.parquet(self.path("late_alerts"))

    def _add_partials(self, judged: DataFrame, batch_id: int) -> None:
        self.users.extend(judged.select("user_id"), batch_id)
        numbered = self.users.numbered(judged.select("user_id", *self.params.keys, "amount", "event_time", "max_prev_ms"))
        self.partials.write(on_time_partials(numbered, self.params), "on_time", batch_id)
        self.partials.write(late_partials(numbered, self.params), "late", batch_id)

    def silver(self, from_ms: int | None = None, to_ms: int | None = None) -> DataFrame:
        """Silver rows; with bounds only the ``event_day`` directories in range are listed and read."""
        base = self.path("silver")
        reader = self.spark.read.option("basePath", base)
        if getattr(self, "_silver_schema", None) is not None:
            reader = reader.schema(self._silver_schema)
        if from_ms is None or to_ms is None:
            return reader.parquet(base)
        first, last = (_day(ms) for ms in (from_ms, max(from_ms, to_ms)))
        days = [d for d in self._silver_days() if first <= d <= last]
        if not days:
            return None
        return reader.parquet(*[f"{base}/event_day={d}" for d in days])

    def _silver_days(self) -> list[str]:
        """Days that have silver rows: one listing, whatever the range asked for."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path("silver"))
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(n.split("=")[1] for n in names if n.startswith("event_day="))

    def fire_windows(self, batch_rows: DataFrame, max_prev: int | None, max_now: int) -> DataFrame | None:
        """Windows first closed by this batch, plus closed windows that got allowed-late rows now.

        Silver is read and expanded once; the windows that the batch touches are marked by one left join.
        """
        p = self.params
        keys = list(p.keys)
        fire_upto = max_now - p.bound_ms  # windows with end <= this have fired
        newly_from = None if max_prev is None else max_prev - p.bound_ms  # ends above this fire for the first time
        lo = None if max_prev is None else max_prev - p.delay_ms - p.size_ms
        if not self._exists("silver"):
            return None
        rows = self.silver() if lo is None else self.silver(lo, fire_upto)
        if rows is None:
            return None
        if lo is not None:
            rows = rows.filter(F.col("event_time") >= F.lit(lo))
        rows = rows.filter(F.col("event_time") < F.lit(fire_upto)).withColumn(
            "event_ts", F.timestamp_millis("event_time")
        )
        panes = assign_panes(rows, p)
        end_ms = timestamp_to_ms(F.col("window.end"))
        alive = ~is_dead(end_ms, F.col("max_prev_ms"), p)
        panes = panes.filter(alive & (end_ms <= F.lit(fire_upto)))

        touched = (
            assign_panes(batch_rows.withColumn("event_ts", F.timestamp_millis("event_time")), p)
            .filter(~is_dead(timestamp_to_ms(F.col("window.end")), F.col("max_prev_ms"), p))
            .select(timestamp_to_ms(F.col("window.start")).alias("_ws"), *keys)
            .distinct()
        )
        panes = panes.withColumn("_ws", timestamp_to_ms(F.col("window.start")))
        newly = F.lit(True) if newly_from is None else end_ms > F.lit(newly_from)
        marked = panes.join(touched.withColumn("_touched", F.lit(True)), ["_ws", *keys], "left")
        fired = marked.filter(newly | F.col("_touched")).drop("_ws", "_touched")
        return aggregate_panes(fired, p, keys, keep_window=True).drop("window")


def _day(ms: int) -> str:
    """UTC day of an event time as the ``event_day`` folders name it."""
    import datetime as _dt

    ms = min(max(ms, MIN_EVENT_MS), MAX_EVENT_MS)
    return (_dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=ms)).date().isoformat()


def start_staged_query(
    messages: DataFrame,
    root: str,
    table: MetricsTable,
    params: Params = Params(),
    trigger_seconds: int | None = 30,
    epoch: int = 0,
    order_cols=("ingest_ms",),
    with_dead_letters: bool = False,
    dedup_engine: str = "table",
    clock=None,
    alert_threshold: int = 10,
    with_partials: bool = False,
):
    """Start the staged job: foreachBatch(dedup, route late, write silver, fire windows).

    ``dedup_engine="table"`` (default) keeps accepted ids in a table under ``root`` (``AcceptedIds``, JVM
    only; ``clock`` gives its processing time); ``"bucketed"`` and ``"watermark"`` dedup in the streaming plan
    (``dedup_stream``). With ``with_dead_letters`` a second query on the same source writes the
    anomalies to ``<root>/anomalies`` (its own checkpoint). ``with_partials`` keeps partial metrics, late rows
    included (``router.partials``). Returns the router and the started queries.
    """
    spark = messages.sparkSession
    router = LateRouter(spark, root, table, params, epoch, alert_threshold, with_partials)
    parsed = parse_orders(messages)
    stream, dead = valid_orders(parsed), anomalies(parsed)
    order = tuple(c for c in order_cols if c in stream.columns)
    if dedup_engine == "table":
        accepted = AcceptedIds(spark, router.path("accepted"), "event_id", params.ttl_ms, order, clock)

        def sink(df: DataFrame, batch_id: int) -> None:
            df = df.persist()
            try:
                batch_max = df.agg(F.max("event_time")).first()[0]
                rows = accepted.accept(df, batch_id)
                try:
                    router.process(rows, batch_id, batch_max)
                finally:
                    rows.unpersist()
            finally:
                df.unpersist()
    else:
        stream = dedup_stream(stream, "event_id", params.ttl_ms, order, engine=dedup_engine)

        def sink(df: DataFrame, batch_id: int) -> None:
            router.process(df, batch_id)

    def dead_sink(df: DataFrame, batch_id: int) -> None:
        write_rows(df, router.path("anomalies"), batch_id)

    queries = []
    streams = [(stream, sink, "_checkpoint")]
    if with_dead_letters:
        streams.append((dead, dead_sink, "_checkpoint_anomalies"))
    for one, fn, ck in streams:
        w = one.writeStream.foreachBatch(fn).option("checkpointLocation", os.path.join(root, ck))
        if trigger_seconds:
            w = w.trigger(processingTime=f"{trigger_seconds} seconds")
        queries.append(w.start())
    return router, queries
