"""T2 (stream form): TTL dedup of a stream by key.

An accepted row starts a clock of ``ttl_ms`` (processing time); rejected duplicates never
extend it; once it has run out the key is accepted again. All rows of one micro-batch
share the batch's processing time, so at most one row per key and batch is
accepted: the smallest by ``order_cols`` (arrival order), ties broken by all other columns, so
that a retried batch accepts the same rows.

* ``AcceptedIds`` (the staged job): JVM only, inside ``foreachBatch``. The batch's first row per key is a
  combinable ``min(struct)``; keys accepted within the TTL are an anti-join against a small
  table of (key, accept time), of which only the hours of the last TTL are read. The accept
  time of a batch is fixed when it first runs, so a retry judges by the same clock.
* ``dedup_stream(engine="bucketed")`` (the metrics stream, whose window aggregate needs a streaming
  plan): keys are hashed into ``BUCKETS`` groups of a ``transformWithState``; a ``MapState`` keeps one
  entry with a TTL per key. Needs the RocksDB state store provider.
* ``dedup_stream(engine="watermark")``: JVM only. ``dropDuplicatesWithinWatermark`` keyed by the id,
  with the watermark on the micro-batch's processing time and a delay of
  TTL/2: an id's state expires once a batch starts more than TTL after the
  accept. Bounded divergences: re-acceptance can come up to about two trigger
  intervals after the TTL, and copies inside one micro-batch are not ordered
  by ``order_cols``. It defines the stream's watermark, so it only fits plans
  without an event-time watermark after it.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ENGINES = ("bucketed", "watermark")
#: State is keyed by the bucket: another number would forget what a checkpoint has accepted, so it is no parameter.
BUCKETS = 4096
HOUR_MS = 3_600_000


def first_rows(df: DataFrame, key: str, order_cols=()) -> DataFrame:
    """The first row of each key by ``order_cols``, then by all other columns."""
    order = [c for c in order_cols if c in df.columns]
    rest = [c for c in df.columns if c != key and c not in order]
    first = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*[F.col(key) if c == key else F.col("_first")[c].alias(c) for c in df.columns])


class AcceptedIds:
    """Keys accepted by earlier micro-batches, with their accept times, in a table under ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str = "event_id", ttl_ms: int | None = 3_600_000, order_cols=(), clock=None):
        self.spark, self.path, self.key, self.ttl_ms = spark, path.rstrip("/"), key, ttl_ms
        self.order_cols = tuple(order_cols)
        self.clock = clock or (lambda: int(time.time() * 1000))

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _hours(self) -> list[int]:
        """Hours that have accepted keys; one listing."""
        fs, p = self._fs(f"{self.path}/ids")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("hour="))

    def accept_time(self, batch_id: int) -> int:
        """The processing time of a batch: now, or what its first attempt has written."""
        path = f"{self.path}/clock/batch_id={int(batch_id)}"
        fs, p = self._fs(path)
        if fs.exists(p) and (row := self.spark.read.schema("now_ms long").parquet(path).first()) is not None:
            return row["now_ms"]
        now = self.clock()
        self.spark.createDataFrame([(now,)], "now_ms long").coalesce(1).write.mode("overwrite").parquet(path)
        return now

    def accept(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows of ``batch`` that are accepted; their keys are recorded under ``batch_id``."""
        now = self.accept_time(batch_id)
        rows = first_rows(batch, self.key, self.order_cols)
        hours = self._hours()
        if self.ttl_ms is not None:
            hours = [h for h in hours if (h + 1) * HOUR_MS > now - self.ttl_ms]
        if hours:
            kind = batch.schema[self.key].dataType.simpleString()
            schema = f"`{self.key}` {kind}, accepted_ms long, hour long, batch_id long"
            base = f"{self.path}/ids"
            seen = self.spark.read.option("basePath", base).schema(schema).parquet(*[f"{base}/hour={h}" for h in hours])
            seen = seen.filter(F.col("batch_id") < int(batch_id))
            if self.ttl_ms is not None:
                seen = seen.filter(F.col("accepted_ms") > F.lit(now - self.ttl_ms))
            rows = rows.join(seen.select(self.key), self.key, "left_anti").select(*batch.columns)
        rows = rows.persist()
        ids = rows.select(self.key, F.lit(now).cast("long").alias("accepted_ms"), F.lit(now // HOUR_MS).cast("long").alias("hour"), F.lit(int(batch_id)).cast("long").alias("batch_id"))
        ids.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hour", "batch_id").parquet(f"{self.path}/ids")
        self._forget(now)
        return rows

    def _forget(self, now: int) -> None:
        """Drop hours that no TTL can reach any more, with a day to spare for a slow retry."""
        if self.ttl_ms is None:
            return
        for h in self._hours():
            if (h + 1) * HOUR_MS < now - self.ttl_ms - 24 * HOUR_MS:
                fs, p = self._fs(f"{self.path}/ids/hour={h}")
                fs.delete(p, True)


def _rank(value):
    """Nulls first; values of one column compare among themselves."""
    return (value is not None, value) if not isinstance(value, (dict, list)) else (True, repr(value))


class TTLDedupBucketProcessor(StatefulProcessor):
    """TTL dedup over a hash bucket of keys: one handler call per bucket and batch.

    State is a ``MapState`` from key to accept time; each entry carries the TTL
    and is written only on accept, so the semantics per key are unchanged.
    """

    def __init__(self, key: str, ttl_ms: int | None, order_cols: tuple[str, ...] = (), out_cols=(),
                 key_type: str = "STRING"):
        self.key = key
        self.key_type = key_type
        self.ttl_ms = ttl_ms
        self.out_cols = list(out_cols)
        self.rank_cols = [*order_cols, *[c for c in out_cols if c not in order_cols]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accepted = handle.getMapState("accepted", f"{self.key} {self.key_type}", "accepted_ms LONG", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        first = {}
        for r in rows:
            k, rank = r[self.key], tuple(_rank(r[c]) for c in self.rank_cols)
            if k not in first or rank < first[k][0]:
                first[k] = (rank, r)
        if not first:
            return
        now = int(timerValues.getCurrentProcessingTimeInMs())
        for k, (_, r) in first.items():
            if self.accepted.containsKey((k,)):
                continue
            self.accepted.updateValue((k,), (now,))
            yield Row(**{c: r[c] for c in self.out_cols})

    def close(self) -> None:
        pass


def dedup_stream(
    df: DataFrame,
    key: str = "event_id",
    ttl_ms: int | None = 3_600_000,
    order_cols: tuple[str, ...] = (),
    engine: str = "bucketed",
) -> DataFrame:
    """Streaming TTL dedup keyed by ``key``; output schema = input schema."""
    if engine not in ENGINES:
        raise ValueError(f"unknown dedup engine {engine!r}; one of {ENGINES}")
    if engine == "watermark":
        if ttl_ms is None:
            return df.dropDuplicates([key])
        half = max(1, int(ttl_ms) // 2)
        return (
            df.withColumn("_proc_ts", F.current_timestamp())
            .withWatermark("_proc_ts", f"{half} milliseconds")
            .dropDuplicatesWithinWatermark([key])
            .drop("_proc_ts")
        )
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS))
    return df.withColumn("_dedup_bucket", bucket).groupBy("_dedup_bucket").transformWithState(
        statefulProcessor=TTLDedupBucketProcessor(
            key, ttl_ms, tuple(order_cols), df.columns, df.schema[key].dataType.simpleString().upper()
        ),
        outputStructType=df.schema,
        outputMode="Append",
        timeMode="ProcessingTime",
    )
