"""

``entry(spark)`` runs the flagship query on sf0.001; ``queries()`` maps every
registered operator to a ``(spark, sf_dir) -> DataFrame`` callable;
``oracle_sql()`` gives the DuckDB SQL computing the same result from the same
parquet tables. Every query reads the whole ``events`` table (the only table
the order job needs) and derives its inputs from it with the deterministic
rules of FIXTURES.md; the modulo rules there only decide how a row is
corrupted or copied, no row is ever filtered out.
"""

from __future__ import annotations

import importlib
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panewise.operators.asof import asof_join  # noqa: E402
from panewise.operators.dedup import dedup_first, dedup_ttl  # noqa: E402
from panewise.operators.firing import firing_log  # noqa: E402
from panewise.operators.late import (  # noqa: E402
    batch_watermarks,
    classify_late,
    late_events,
    late_stats,
    lateness_profile,
    metrics_excluding_late,
)
from panewise.operators.parse import anomalies, parse_orders, valid_orders  # noqa: E402
from panewise.operators.quality import quality_report  # noqa: E402
from panewise.operators.sketches import (  # noqa: E402
    RANK_TOLERANCE,
    USER_TOLERANCE,
    delay_sketches,
    merge_delay_sketches,
    merge_user_sketches,
    user_sketches,
)
from panewise.operators.slices import (  # noqa: E402
    dimension_metrics,
    sliced_metrics,
    slices,
    to_windows,
    window_metrics_of,
)
from panewise.operators.windows import window_metrics  # noqa: E402
from panewise.plans.batch import backfill, flagship_metrics, replay_range, run_job  # noqa: E402
from panewise.plans.partials import PartialsTable, UserDictionary, late_partials, on_time_partials  # noqa: E402
from panewise.plans.sql import metrics_sql  # noqa: E402
from panewise.plans.table import MetricsTable, latest_rows  # noqa: E402
from panewise.schema import Params  # noqa: E402
from panewise.session import ensure_checkpoint_dir, write_shared  # noqa: E402
from panewise.sources.encode import encode_orders, encode_rows  # noqa: E402
from panewise.sources.fixtures import (  # noqa: E402
    arrivals_from_events,
    load_events,
    orders_from_events,
    raw_arrivals_from_events,
    raw_messages_from_events,
)

HOUR_MS, DAY_MS = 3_600_000, 86_400_000
AS_OF_MS = 1_706_659_200_000  # 2024-01-31 00:00:00 UTC, fixed instant for the future-time rule
LATE_ALERT_THRESHOLD = 2
APPROX_RSD = 0.05  # standard error of the distinct-user sketch


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: events -> JSON orders -> parse -> 60 s/30 s window metrics per store."""
    return flagship_metrics(orders_from_events(load_events(spark, "/root/testdata/sf0.001")))


# ---------------------------------------------------------------- Spark side

def _orders(spark, sf):
    return orders_from_events(load_events(spark, sf))


def _arrivals(spark, sf):
    return arrivals_from_events(load_events(spark, sf))


def _valid_fields(df):
    return df.select("id", "event_id", "user_id", "store_id", "amount", "event_time")


def q_order_metrics_sliding(spark, sf):
    return flagship_metrics(_orders(spark, sf))


def q_order_metrics_daily(spark, sf):
    p = Params(size_ms=DAY_MS, slide_ms=DAY_MS)
    return window_metrics(valid_orders(parse_orders(encode_orders(_orders(spark, sf)))), p)


def q_order_metrics_multi_dim(spark, sf):
    ev = load_events(spark, sf)
    cat = F.concat(F.lit("cat_"), (F.get_json_object("props", "$.k").cast("bigint") % 4).cast("string"))
    o = orders_from_events(ev, extra={"category": cat})
    fields = ["event_id", "user_id", "store_id", "amount", "event_time", "category"]
    parsed = valid_orders(parse_orders(encode_orders(o, fields), extra_fields=("category",)))
    return window_metrics(parsed, Params(), keys=("store_id", "category"))


def q_encode_orders(spark, sf):
    return encode_orders(_orders(spark, sf))


def q_encode_metrics(spark, sf):
    return encode_rows(flagship_metrics(_orders(spark, sf)))


def q_parse_valid(spark, sf):
    return _valid_fields(valid_orders(parse_orders(raw_messages_from_events(load_events(spark, sf)))))


def q_parse_anomalies(spark, sf):
    return anomalies(parse_orders(raw_messages_from_events(load_events(spark, sf))))


def q_dedup_unbounded(spark, sf):
    return dedup_first(_arrivals(spark, sf), "event_id", "arrival_ms")


def q_dedup_ttl(spark, sf):
    return dedup_ttl(_arrivals(spark, sf), "event_id", "arrival_ms", 3_600_000)


def q_dedup_ttl_split(spark, sf):
    # Same result through the hot-key path: every key is treated as hot.
    return dedup_ttl(_arrivals(spark, sf), "event_id", "arrival_ms", 3_600_000, max_light=0)


def _classified(spark, sf):
    # The watermark comes from every arrival (before dedup), as in the job.
    a = _arrivals(spark, sf)
    wm = batch_watermarks(a, Params(), "batch_id")
    return classify_late(dedup_ttl(a, "event_id", "arrival_ms", 3_600_000), Params(), "batch_id", watermarks=wm)


def q_classify_late(spark, sf):
    return _classified(spark, sf)


def q_late_events(spark, sf):
    return late_events(_classified(spark, sf))


def q_late_asof_metrics(spark, sf):
    # Each late event with the metrics its store showed then: of the newest window that ends at or before the watermark.
    c = write_shared(_classified(spark, sf), "classified")
    m = metrics_excluding_late(c.withColumn("event_ts", F.timestamp_millis("event_time")), Params(), keep_window=True)
    m = m.select("store_id", "window_end_ms", "window_end", "order_cnt", "gmv_total", "user_cnt")
    late = late_events(c).select("event_id", "copy_no", "store_id", "event_time", "watermark_ms")
    return asof_join(late, m, "watermark_ms", "window_end_ms", by=["store_id"])


def q_metrics_excluding_late(spark, sf):
    c = _classified(spark, sf).withColumn("event_ts", F.timestamp_millis("event_time"))
    return metrics_excluding_late(c, Params())


def q_job_metrics(spark, sf):
    return run_job(raw_arrivals_from_events(load_events(spark, sf))).metrics


def q_job_late_events(spark, sf):
    late = run_job(raw_arrivals_from_events(load_events(spark, sf))).late
    return late.select("event_id", "user_id", "store_id", "amount", "event_time", "arrival_ms", "batch_id",
                       "copy_no", "watermark_ms")


def q_firing_log(spark, sf):
    out = run_job(raw_arrivals_from_events(load_events(spark, sf)))
    return firing_log(out.classified, out.watermarks)


def q_latest_metrics(spark, sf):
    m = window_metrics(
        valid_orders(parse_orders(encode_orders(_orders(spark, sf)))), Params(), keep_window=True
    )
    base = m.drop("window", "window_end_ms")
    # version 2 of the even minutes beside version 1 of all, in one pass over the metrics
    even_minute = (F.floor(F.col("window_start_ms") / 60_000) % 60) % 2 == 0
    versions = F.when(even_minute, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    v = base.withColumn("version", F.explode(versions))
    v = v.withColumn("order_cnt", F.col("order_cnt") + F.when(F.col("version") == 2, 1).otherwise(0))
    return latest_rows(v.drop("window_start_ms"), ["window_start", "store_id"], ["version"])


BACKFILL_FROM_MS, BACKFILL_TO_MS = 1_704_844_800_000, 1_705_276_800_000  # 2024-01-10 to 2024-01-15


def _new_table(spark, name):
    return MetricsTable(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")


def q_backfill_range(spark, sf):
    # A table of the whole history, then a replay of a range from which a seventh of the rows is gone.
    messages = raw_arrivals_from_events(load_events(spark, sf))
    table = _new_table(spark, "backfill")
    table.write_batch(run_job(messages).metrics, batch_id=0)
    low, high = replay_range(BACKFILL_FROM_MS, BACKFILL_TO_MS)
    replay = messages.filter(F.col("arrival_ms").between(low, high) & (F.col("arrival_ms") / 1000 % 7 != 0))
    backfill(table, replay, 1, BACKFILL_FROM_MS, BACKFILL_TO_MS)
    return table.latest().select("window_start", "window_end", "store_id", "order_cnt", "gmv_total", "user_cnt")


def q_table_latest(spark, sf):
    # Two versions, folded; then a later batch of the same stream.
    m = window_metrics(valid_orders(parse_orders(encode_orders(_orders(spark, sf)))), Params(), keep_window=True)
    m = write_shared(m.drop("window", "window_end_ms"), "metrics")
    minute = F.floor(F.col("window_start_ms") / 60_000)
    table = _new_table(spark, "table")
    table.write_batch(m, batch_id=0)
    table.write_batch(m.filter(minute % 2 == 0).withColumn("order_cnt", F.col("order_cnt") + 1), batch_id=1)
    table.compact("00000000", "99999999")
    table.write_batch(m.filter(minute % 3 == 0).withColumn("order_cnt", F.col("order_cnt") + 10), batch_id=2, files_per_date=2)
    return table.latest().select("window_start", "window_end", "store_id", "order_cnt", "gmv_total", "user_cnt", "window_date")


def q_late_stats(spark, sf):
    return late_stats(late_events(_classified(spark, sf)), alert_threshold=LATE_ALERT_THRESHOLD)


def q_lateness_profile(spark, sf):
    return lateness_profile(_arrivals(spark, sf))


def q_quality_report(spark, sf):
    return quality_report(raw_messages_from_events(load_events(spark, sf)).select("value"), AS_OF_MS)


def q_approx_users(spark, sf):
    # Daily panes: the sketch beside the exact count. Three standard errors of the sketch, and one user, are allowed.
    p = Params(size_ms=DAY_MS, slide_ms=DAY_MS)
    valid = write_shared(valid_orders(parse_orders(encode_orders(_orders(spark, sf)))), "valid")
    exact = window_metrics(valid, p)
    sketch = window_metrics(valid, p, exact=False, rsd=APPROX_RSD).select("window_start", "store_id", F.col("user_cnt").alias("approx_cnt"))
    off = F.abs(F.col("approx_cnt") - F.col("user_cnt"))
    joined = exact.join(sketch, ["window_start", "store_id"])
    return joined.withColumn("within_tolerance", off <= 3 * APPROX_RSD * F.col("user_cnt") + 1).drop("approx_cnt").select(
        "window_start", "window_end", "store_id", "order_cnt", "gmv_total", "user_cnt", "within_tolerance")


def _valid(spark, sf):
    return valid_orders(parse_orders(encode_orders(_orders(spark, sf))))


def _shared(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_order_metrics_slices(spark, sf):
    return sliced_metrics(_valid(spark, sf))


def q_order_metrics_rollup(spark, sf):
    # Slices of 30 s with user numbers, stored once; hours and days are merged from them, users exactly.
    valid = write_shared(_valid(spark, sf), "valid")
    numbers = UserDictionary(spark, _shared(spark, "users"))
    numbers.extend(valid.select("user_id"), 0)
    stored = write_shared(slices(numbers.numbered(valid), numbered=True), "slices")
    out = []
    for width in (HOUR_MS, DAY_MS):
        p = Params(size_ms=width, slide_ms=width)
        out.append(window_metrics_of(to_windows(stored, p), p).withColumn("width_ms", F.lit(width).cast("bigint")))
    return out[0].unionByName(out[1])


def q_order_metrics_dimensions(spark, sf):
    cat = F.concat(F.lit("cat_"), (F.get_json_object("props", "$.k").cast("bigint") % 4).cast("string"))
    fields = ["event_id", "user_id", "store_id", "amount", "event_time", "category"]
    orders = orders_from_events(load_events(spark, sf), extra={"category": cat})
    parsed = valid_orders(parse_orders(encode_orders(orders, fields), extra_fields=("category",)))
    p = Params(size_ms=HOUR_MS, slide_ms=HOUR_MS // 2)
    return dimension_metrics(parsed, [["store_id"], ["category"], ["store_id", "category"]], p)


def q_late_merge(spark, sf):
    # On-time rows are stored as partial metrics; the late rows come as a second source and are merged when read.
    c = write_shared(_classified(spark, sf), "classified")
    numbers = UserDictionary(spark, _shared(spark, "users"))
    numbers.extend(c.filter("NOT is_late").select("user_id"), 0)
    table = PartialsTable(spark, _shared(spark, "partials"))
    table.write(on_time_partials(numbers.numbered(c)), "on_time", 0)
    numbers.extend(c.filter("is_late").select("user_id"), 1)
    table.write(late_partials(numbers.numbered(c)), "late", 0)
    return table.metrics()


def q_users_rollup(spark, sf):
    # Hourly user sketches, stored; days are unions of them. Beside the exact counts: within three standard errors.
    valid = write_shared(_valid(spark, sf), "valid")
    stored = write_shared(user_sketches(valid), "sketches")
    out = []
    for width in (HOUR_MS, DAY_MS):
        p = Params(size_ms=width, slide_ms=width)
        exact = window_metrics(valid, p)
        near = merge_user_sketches(stored, width).select("window_start", "store_id", F.col("order_cnt").alias("n"), F.col("user_cnt").alias("about"))
        good = (F.abs(F.col("about") - F.col("user_cnt")) <= USER_TOLERANCE * F.col("user_cnt") + 1) & (F.col("n") == F.col("order_cnt"))
        joined = exact.join(near, ["window_start", "store_id"], "left").withColumn("within_tolerance", F.coalesce(good, F.lit(False)))
        out.append(joined.drop("about", "n").withColumn("width_ms", F.lit(width).cast("bigint")))
    return out[0].unionByName(out[1])


def q_lateness_sketch(spark, sf):
    # Hourly delay sketches, stored and merged; each quantile's true rank, from the rows, is near the one asked for.
    a = _arrivals(spark, sf)
    stored = write_shared(delay_sketches(a), "delays")
    merged = merge_delay_sketches(stored)
    delay = F.col("arrival_ms") - F.col("event_time")
    joined = a.select("store_id", delay.alias("d")).join(merged, "store_id")
    checks = []
    for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        below, upto = F.avg((F.col("d") < F.col(name)).cast("int")), F.avg((F.col("d") <= F.col(name)).cast("int"))
        checks.append(((below <= q + RANK_TOLERANCE) & (upto >= q - RANK_TOLERANCE)).alias(f"{name}_near"))
    return joined.groupBy("store_id", "rows", "max_delay_ms").agg(*checks)


def q_order_metrics_sql(spark, sf):
    return metrics_sql(valid_orders(parse_orders(encode_orders(_orders(spark, sf)))))


def _optional(name: str):
    """A module of the training-data package, None if that package is not there."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as e:
        if e.name not in (name, "panewise.llm"):
            raise
        return None


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    entries, pipeline = _optional("panewise.llm.entries"), _optional("corpus_pipeline")
    out = entries.queries() if entries else {}
    return out | ({"pipeline": pipeline.run} if pipeline else {})


def _llm_oracle_sql() -> dict[str, str]:
    entries, pipeline = _optional("panewise.llm.entries"), _optional("corpus_pipeline")
    out = entries.oracle_sql() if entries else {}
    return out | ({"pipeline": pipeline.ORACLE_SQL} if pipeline and pipeline.ORACLE_SQL else {})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _job_queries() | _llm_queries()


def _job_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "order_metrics_sliding": q_order_metrics_sliding,
        "order_metrics_daily": q_order_metrics_daily,
        "order_metrics_multi_dim": q_order_metrics_multi_dim,
        "encode_orders": q_encode_orders,
        "encode_metrics": q_encode_metrics,
        "parse_valid": q_parse_valid,
        "parse_anomalies": q_parse_anomalies,
        "dedup_unbounded": q_dedup_unbounded,
        "dedup_ttl": q_dedup_ttl,
        "dedup_ttl_split": q_dedup_ttl_split,
        "classify_late": q_classify_late,
        "late_events": q_late_events,
        "late_asof_metrics": q_late_asof_metrics,
        "metrics_excluding_late": q_metrics_excluding_late,
        "job_metrics": q_job_metrics,
        "job_late_events": q_job_late_events,
        "firing_log": q_firing_log,
        "latest_metrics": q_latest_metrics,
        "backfill_range": q_backfill_range,
        "table_latest": q_table_latest,
        "late_stats": q_late_stats,
        "lateness_profile": q_lateness_profile,
        "quality_report": q_quality_report,
        "approx_users": q_approx_users,
        "order_metrics_sql": q_order_metrics_sql,
        "order_metrics_slices": q_order_metrics_slices,
        "order_metrics_rollup": q_order_metrics_rollup,
        "order_metrics_dimensions": q_order_metrics_dimensions,
        "late_merge": q_late_merge,
        "users_rollup": q_users_rollup,
        "lateness_sketch": q_lateness_sketch,
    }


# --------------------------------------------------------------- DuckDB side

_O = """
o AS (
  SELECT event_id AS id,
         'ord_' || CAST(event_id AS VARCHAR) AS event_id,
         'user_' || CAST(user_id % 20 AS VARCHAR) AS user_id,
         event_type AS store_id,
         value AS amount,
         epoch_us(ts) // 1000 AS event_time,
         props
  FROM events)"""

_A = _O + """,
a0 AS (
  SELECT o.*,
         unnest(CASE WHEN id % 10 = 0 AND id % 25 = 0 THEN [0, 1, 2]
                     WHEN id % 10 = 0 THEN [0, 1]
                     WHEN id % 25 = 0 THEN [0, 2]
                     ELSE [0] END) AS copy_no
  FROM o),
a1 AS (
  SELECT *, CASE copy_no
              WHEN 0 THEN event_time + ((id * 7919) % 40) * 1000 + CASE WHEN id % 97 = 0 THEN 900000 ELSE 0 END
              WHEN 1 THEN event_time + 1800000
              ELSE event_time + 5400000 END AS arrival_ms
  FROM a0),
a AS (
  SELECT event_id, user_id, store_id, amount, event_time, copy_no, arrival_ms, arrival_ms // 600000 AS batch_id,
         id, props
  FROM a1)"""

_RAW_VALUE = """
  CASE
    WHEN id % 20 = 0 THEN '{"user_id":"' || user_id || '","store_id":"' || store_id || '","amount":'
         || CAST(amount AS VARCHAR) || ',"event_time":' || CAST(event_time AS VARCHAR) || '}'
    WHEN id % 33 = 0 THEN 'not json ' || CAST(id AS VARCHAR)
    WHEN id % 41 = 0 THEN '{"event_id":"","user_id":"' || user_id || '","store_id":"' || store_id || '","amount":'
         || CAST(amount AS VARCHAR) || ',"event_time":' || CAST(event_time AS VARCHAR) || '}'
    WHEN id % 53 = 0 THEN '{"event_id":"' || event_id || '","user_id":"' || user_id || '","store_id":"' || store_id
         || '","amount":"' || CAST(amount AS VARCHAR) || '","event_time":' || CAST(event_time AS VARCHAR) || '}'
    WHEN id % 59 = 0 THEN '{"event_id":"' || event_id || '","user_id":null,"store_id":"' || store_id || '","amount":'
         || CAST(amount AS VARCHAR) || ',"event_time":' || CAST(event_time AS VARCHAR) || '}'
    WHEN id % 61 = 0 THEN '{"event_id":"' || event_id || '","user_id":"' || user_id || '","store_id":"' || store_id
         || '","amount":' || CAST(amount AS VARCHAR) || ',"event_time":"2024-01-01"}'
    WHEN id % 67 = 0 THEN '{"event_id":"' || event_id || '","user_id":"' || user_id || '","store_id":"' || store_id
         || '","amount":' || CAST(amount AS VARCHAR) || ',"event_time":' || CAST(event_time * 1000000 AS VARCHAR) || '}'
    WHEN id % 71 = 0 THEN '{"event_id":"' || event_id || '","user_id":"' || user_id || '","store_id":"' || store_id
         || '","amount":' || CAST(amount AS VARCHAR) || ',"event_time":' || '9223372036854775807' || '}'
    WHEN id % 73 = 0 THEN '{"event_id":"' || event_id || '","user_id":"' || user_id || '","store_id":"' || store_id
         || '","amount":' || CAST(amount AS VARCHAR) || ',"event_time":' || '-62200000000000000' || '}'
    WHEN id % 79 = 0 THEN '{"event_id":"' || event_id || '","user_id":"' || user_id || '","store_id":"' || store_id
         || '","amount":' || CAST(amount AS VARCHAR) || ',"event_time":' || CAST(event_time * 1000 AS VARCHAR) || '}'
    ELSE '{"event_id":"' || event_id || '","user_id":"' || user_id || '","store_id":"' || store_id || '","amount":'
         || CAST(amount AS VARCHAR) || ',"event_time":' || CAST(event_time AS VARCHAR) || '}'
  END"""


def _parsed(src: str) -> str:
    """CTE ``p`` parsing ``value`` of ``src`` like ``parse_orders`` (lenient, defaults, reason)."""
    return f"""
j AS (
  SELECT s.*, CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END AS is_obj
  FROM {src} s),
x AS (
  SELECT j.*,
         CASE WHEN is_obj THEN json_extract_string(value, '$.event_id') END AS j_event_id,
         CASE WHEN is_obj THEN json_extract_string(value, '$.user_id') END AS j_user_id,
         CASE WHEN is_obj THEN json_extract_string(value, '$.store_id') END AS j_store_id,
         CASE WHEN is_obj THEN json_extract_string(value, '$.amount') END AS j_amount,
         CASE WHEN is_obj THEN json_extract_string(value, '$.event_time') END AS j_event_time
  FROM j),
p AS (
  SELECT x.*,
         j_event_id AS p_event_id,
         coalesce(j_user_id, 'unknown') AS p_user_id,
         coalesce(j_store_id, 'default') AS p_store_id,
         coalesce(TRY_CAST(j_amount AS DOUBLE), 0.0) AS p_amount,
         coalesce(TRY_CAST(j_event_time AS BIGINT), TRY_CAST(TRY_CAST(j_event_time AS DOUBLE) AS BIGINT), 0)
           AS p_event_time,
         CASE WHEN NOT is_obj THEN 'malformed_json'
              WHEN j_event_id IS NULL OR j_event_id = '' THEN 'event_id_missing'
              WHEN coalesce(TRY_CAST(j_event_time AS BIGINT), TRY_CAST(TRY_CAST(j_event_time AS DOUBLE) AS BIGINT), 0)
                   NOT BETWEEN -62135510400000 AND 253402214399999 THEN 'event_time_out_of_range' END AS reason
  FROM x)"""


def _ts_text(ms: str) -> str:
    return f"strftime(epoch_ms({ms}), '%Y-%m-%d %H:%M:%S')"


def _metrics(src: str, size: int = 60000, slide: int = 30000, keys: str = "store_id", where: str = "",
             with_ws: bool = False) -> str:
    """Window metrics over ``src`` (needs event_time, amount, user_id, keys); size = 2 * slide or size = slide."""
    starts = "[pane]" if size == slide else "[pane, pane - " + str(slide) + "]"
    return f"""
panes AS (
  SELECT s.*, unnest({starts}) AS ws FROM (SELECT *, (event_time // {slide}) * {slide} AS pane FROM {src}) s)
SELECT {'ws, ' if with_ws else ''}{_ts_text('ws')} AS window_start,
       {_ts_text(f'ws + {size}')} AS window_end,
       {keys},
       count(*) AS order_cnt,
       floor(sum(amount) * 100 + 0.5) / 100 AS gmv_total,
       count(DISTINCT user_id) AS user_cnt
FROM panes
{where}
GROUP BY ws, {keys}"""


_DEDUP_TTL = """,
firsts AS (
  SELECT * FROM a
  QUALIFY row_number() OVER (PARTITION BY event_id, arrival_ms
                             ORDER BY user_id, store_id, amount, event_time, copy_no, batch_id) = 1),
r AS (
  SELECT t.event_id, t.t FROM (
    WITH RECURSIVE chain(event_id, t) AS (
      SELECT event_id, min(arrival_ms) FROM firsts GROUP BY event_id
      UNION ALL
      SELECT n.event_id, n.t FROM (
        SELECT c.event_id,
               (SELECT min(f.arrival_ms) FROM firsts f
                 WHERE f.event_id = c.event_id AND f.arrival_ms >= c.t + 3600000) AS t
        FROM chain c) n
      WHERE n.t IS NOT NULL)
    SELECT * FROM chain) t),
d AS (
  SELECT f.event_id, f.user_id, f.store_id, f.amount, f.event_time, f.copy_no, f.arrival_ms, f.batch_id
  FROM firsts f JOIN r ON f.event_id = r.event_id AND f.arrival_ms = r.t)"""

_CLASSIFIED = """,
pb AS (SELECT batch_id, max(event_time) AS bm FROM {pre} GROUP BY batch_id),
wm AS (
  SELECT batch_id,
         max(bm) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_prev_ms
  FROM pb),
c AS (
  SELECT d.*, wm.max_prev_ms, wm.max_prev_ms - 10001 AS watermark_ms,
         coalesce((d.event_time // 30000) * 30000 + 60000 + 15000 <= wm.max_prev_ms, false) AS is_late
  FROM d LEFT JOIN wm USING (batch_id))"""


def _late_stats_sql(src: str) -> str:
    return f"""
SELECT store_id,
       {_ts_text('(watermark_ms // 3600000) * 3600000')} AS bucket_start,
       count(*) AS late_cnt,
       avg(watermark_ms - event_time) AS avg_lateness_ms,
       max(watermark_ms - event_time) AS max_lateness_ms,
       count(*) >= {LATE_ALERT_THRESHOLD} AS alert
FROM {src}
GROUP BY store_id, (watermark_ms // 3600000) * 3600000"""


def _quality_sql() -> str:
    return f"""WITH {_O},
raw AS (SELECT {_RAW_VALUE} AS value FROM o),
{_parsed('raw')},
q AS (
  SELECT count(*) AS checked,
         count(*) FILTER (WHERE reason = 'malformed_json') AS malformed_json,
         count(*) FILTER (WHERE reason = 'event_id_missing') AS event_id_missing,
         count(*) FILTER (WHERE reason = 'event_time_out_of_range') AS event_time_out_of_range,
         count(*) FILTER (WHERE reason IS NULL AND j_user_id IS NULL) AS user_id_defaulted,
         count(*) FILTER (WHERE reason IS NULL AND j_store_id IS NULL) AS store_id_defaulted,
         count(*) FILTER (WHERE reason IS NULL AND TRY_CAST(j_amount AS DOUBLE) IS NULL) AS amount_defaulted,
         count(*) FILTER (WHERE reason IS NULL AND TRY_CAST(j_event_time AS BIGINT) IS NULL
                          AND TRY_CAST(TRY_CAST(j_event_time AS DOUBLE) AS BIGINT) IS NULL) AS event_time_defaulted,
         count(*) FILTER (WHERE reason IS NULL AND p_amount <= 0) AS amount_not_positive,
         count(*) FILTER (WHERE reason IS NULL AND p_event_time = 0) AS event_time_zero,
         count(*) FILTER (WHERE reason IS NULL AND p_event_time > {AS_OF_MS}) AS event_time_future
  FROM p)
SELECT rule, failed, checked FROM q
UNPIVOT (failed FOR rule IN (malformed_json, event_id_missing, event_time_out_of_range, user_id_defaulted, store_id_defaulted,
                              amount_defaulted, event_time_defaulted, amount_not_positive, event_time_zero,
                              event_time_future))"""


def _job_sql(final: str, keep: str = "true") -> str:
    """Raw arrival copies -> parse -> valid -> TTL dedup -> late classification, then ``final``."""
    return f"""WITH {_A},
rawa AS (SELECT {_RAW_VALUE} AS value, arrival_ms, batch_id, copy_no FROM a WHERE {keep}),
{_parsed('rawa')},
a_valid AS (
  SELECT p_event_id AS event_id, p_user_id AS user_id, p_store_id AS store_id, p_amount AS amount,
         p_event_time AS event_time, copy_no, arrival_ms, batch_id
  FROM p WHERE reason IS NULL),
firsts AS (
  SELECT * FROM a_valid
  QUALIFY row_number() OVER (PARTITION BY event_id, arrival_ms
                             ORDER BY user_id, store_id, amount, event_time, copy_no, batch_id) = 1),
r AS (
  SELECT t.event_id, t.t FROM (
    WITH RECURSIVE chain(event_id, t) AS (
      SELECT event_id, min(arrival_ms) FROM firsts GROUP BY event_id
      UNION ALL
      SELECT n.event_id, n.t FROM (
        SELECT c.event_id,
               (SELECT min(f.arrival_ms) FROM firsts f
                 WHERE f.event_id = c.event_id AND f.arrival_ms >= c.t + 3600000) AS t
        FROM chain c) n
      WHERE n.t IS NOT NULL)
    SELECT * FROM chain) t),
d AS (
  SELECT f.* FROM firsts f JOIN r ON f.event_id = r.event_id AND f.arrival_ms = r.t){_CLASSIFIED.format(pre="a_valid")}
{final}"""


def _rollup_sql(extra: str = "") -> str:
    """Hours and days in one result."""
    one = lambda width: f"SELECT *, {width}::BIGINT AS width_ms{extra} FROM (WITH {_O},{_metrics('o', width, width)})"
    return f"{one(HOUR_MS)} UNION ALL {one(DAY_MS)}"


def _dimensions_sql() -> str:
    parts = []
    for level, store, cat in ((1, "store_id", "NULL"), (2, "NULL", "category"), (0, "store_id", "category")):
        parts.append(f"""
SELECT {_ts_text('ws')} AS window_start, {_ts_text(f'ws + {HOUR_MS}')} AS window_end, {level} AS grouping_id, {store} AS store_id,
       {cat} AS category, count(*) AS order_cnt, floor(sum(amount) * 100 + 0.5) / 100 AS gmv_total, count(DISTINCT user_id) AS user_cnt
FROM panes GROUP BY ws, {", ".join(c for c in (store, cat) if c != "NULL")}""")
    return f"""WITH {_O},
oc AS (SELECT *, 'cat_' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 AS VARCHAR) AS category FROM o),
panes AS (
  SELECT s.*, unnest([pane, pane - {HOUR_MS // 2}]) AS ws
  FROM (SELECT *, (event_time // {HOUR_MS // 2}) * {HOUR_MS // 2} AS pane FROM oc) s)
{" UNION ALL ".join(parts)}"""


def _backfill_sql() -> str:
    final = "," + _metrics("c", where="WHERE max_prev_ms IS NULL OR ws + 60000 + 15000 > max_prev_ms")
    inside = f"window_start >= {_ts_text(str(BACKFILL_FROM_MS))} AND window_end <= {_ts_text(str(BACKFILL_TO_MS))}"
    return f"""
SELECT * FROM ({_job_sql(final)}) WHERE NOT ({inside})
UNION ALL
SELECT * FROM ({_job_sql(final, "arrival_ms / 1000 % 7 <> 0")}) WHERE {inside}"""


def oracle_sql() -> dict[str, str]:
    return _job_oracle_sql() | _llm_oracle_sql()


def _job_oracle_sql() -> dict[str, str]:
    metrics_o = f"WITH {_O},{_metrics('o')}"
    dedup_cols = "event_id, user_id, store_id, amount, event_time, copy_no, arrival_ms, batch_id"
    return {
        "order_metrics_sliding": metrics_o,
        "order_metrics_daily": f"WITH {_O},{_metrics('o', DAY_MS, DAY_MS)}",
        "order_metrics_multi_dim": f"""WITH {_O},
oc AS (SELECT *, 'cat_' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 AS VARCHAR) AS category
       FROM o),{_metrics('oc', keys='store_id, category')}""",
        "encode_orders": f"""WITH {_O}
SELECT to_json(struct_pack(event_id := event_id, user_id := user_id, store_id := store_id,
                           amount := amount, event_time := event_time))::VARCHAR AS value FROM o""",
        "encode_metrics": f"""WITH {_O},
m AS (WITH {_metrics('o')})
SELECT to_json(struct_pack(window_start := window_start, window_end := window_end, store_id := store_id,
                           order_cnt := order_cnt, gmv_total := gmv_total, user_cnt := user_cnt))::VARCHAR AS value
FROM m""",
        "parse_valid": f"""WITH {_O},
raw AS (SELECT id, {_RAW_VALUE} AS value FROM o),
{_parsed('raw')}
SELECT id, p_event_id AS event_id, p_user_id AS user_id, p_store_id AS store_id, p_amount AS amount,
       p_event_time AS event_time
FROM p WHERE reason IS NULL""",
        "parse_anomalies": f"""WITH {_O},
raw AS (SELECT id, {_RAW_VALUE} AS value FROM o),
{_parsed('raw')}
SELECT id, value, reason FROM p WHERE reason IS NOT NULL""",
        "dedup_unbounded": f"""WITH {_A}
SELECT {dedup_cols} FROM a
QUALIFY row_number() OVER (PARTITION BY event_id
                           ORDER BY arrival_ms, user_id, store_id, amount, event_time, copy_no, batch_id) = 1""",
        "dedup_ttl": f"WITH {_A}{_DEDUP_TTL}\nSELECT * FROM d",
        "dedup_ttl_split": f"WITH {_A}{_DEDUP_TTL}\nSELECT * FROM d",
        "classify_late": f"WITH {_A}{_DEDUP_TTL}{_CLASSIFIED.format(pre="a")}\nSELECT * FROM c",
        "late_events": f"""WITH {_A}{_DEDUP_TTL}{_CLASSIFIED.format(pre="a")}
SELECT {dedup_cols}, watermark_ms FROM c WHERE is_late""",
        "late_asof_metrics": f"""WITH {_A}{_DEDUP_TTL}{_CLASSIFIED.format(pre="a")},
m AS (WITH {_metrics('c', where='WHERE max_prev_ms IS NULL OR ws + 60000 + 15000 > max_prev_ms', with_ws=True)})
SELECT c.event_id, c.copy_no, c.store_id, c.event_time, c.watermark_ms, m.ws + 60000 AS window_end_ms, m.window_end,
       m.order_cnt, m.gmv_total, m.user_cnt
FROM c ASOF LEFT JOIN m ON c.store_id = m.store_id AND c.watermark_ms >= m.ws + 60000
WHERE c.is_late""",
        "metrics_excluding_late": f"""WITH {_A}{_DEDUP_TTL}{_CLASSIFIED.format(pre="a")},
{_metrics('c', where='WHERE max_prev_ms IS NULL OR ws + 60000 + 15000 > max_prev_ms')}""",
        "job_metrics": _job_sql(
            ","
            + _metrics("c", where="WHERE max_prev_ms IS NULL OR ws + 60000 + 15000 > max_prev_ms")
        ),
        "job_late_events": _job_sql(f"SELECT {dedup_cols}, watermark_ms FROM c WHERE is_late"),
        "firing_log": _job_sql(""",
p2 AS (SELECT s.*, unnest([pane, pane - 30000]) AS ws FROM (SELECT *, (event_time // 30000) * 30000 AS pane FROM c) s),
alive AS (SELECT * FROM p2 WHERE max_prev_ms IS NULL OR ws + 60000 + 15000 > max_prev_ms),
thr AS (SELECT batch_id, max(bm) OVER (ORDER BY batch_id) AS through FROM pb),
ff AS (SELECT ws, (SELECT min(batch_id) FROM thr WHERE through >= ws + 70000) AS fire
       FROM (SELECT DISTINCT ws FROM alive)),
fires AS (SELECT DISTINCT a.ws, a.store_id, greatest(a.batch_id, ff.fire) AS fb
          FROM alive a JOIN ff ON a.ws = ff.ws WHERE ff.fire IS NOT NULL)
SELECT f.fb AS batch_id, """ + _ts_text("f.ws") + " AS window_start, " + _ts_text("f.ws + 60000") + """ AS window_end,
       f.store_id, count(*) AS order_cnt, floor(sum(a.amount) * 100 + 0.5) / 100 AS gmv_total,
       count(DISTINCT a.user_id) AS user_cnt
FROM fires f JOIN alive a ON a.ws = f.ws AND a.store_id = f.store_id AND a.batch_id <= f.fb
GROUP BY f.fb, f.ws, f.store_id"""),
        "latest_metrics": f"""WITH {_O},
m AS (WITH {_metrics('o', with_ws=True)}),
v AS (
  SELECT window_start, window_end, store_id, order_cnt, gmv_total, user_cnt, 1 AS version FROM m
  UNION ALL
  SELECT window_start, window_end, store_id, order_cnt + 1, gmv_total, user_cnt, 2 AS version FROM m
  WHERE ((ws // 60000) % 60) % 2 = 0)
SELECT * FROM v
QUALIFY row_number() OVER (PARTITION BY window_start, store_id ORDER BY version DESC) = 1""",
        "backfill_range": _backfill_sql(),
        "table_latest": f"""WITH {_O},
m AS (WITH {_metrics('o', with_ws=True)})
SELECT window_start, window_end, store_id,
       CASE WHEN (ws // 60000) % 3 = 0 THEN order_cnt + 10 WHEN (ws // 60000) % 2 = 0 THEN order_cnt + 1
            ELSE order_cnt END AS order_cnt,
       gmv_total, user_cnt, strftime(epoch_ms(ws), '%Y%m%d') AS window_date
FROM m""",
        "late_stats": f"""WITH {_A}{_DEDUP_TTL}{_CLASSIFIED.format(pre="a")},
l AS (SELECT * FROM c WHERE is_late)
{_late_stats_sql('l')}""",
        "lateness_profile": f"""WITH {_A}
SELECT store_id, count(*) AS rows, max(arrival_ms - event_time) AS max_delay_ms,
       quantile_cont(arrival_ms - event_time, 0.5) AS p50,
       quantile_cont(arrival_ms - event_time, 0.95) AS p95,
       quantile_cont(arrival_ms - event_time, 0.99) AS p99
FROM a GROUP BY store_id""",
        "quality_report": _quality_sql(),
        "approx_users": f"SELECT *, true AS within_tolerance FROM (WITH {_O},{_metrics('o', DAY_MS, DAY_MS)})",
        "order_metrics_sql": metrics_o,
        "order_metrics_slices": metrics_o,
        "order_metrics_rollup": _rollup_sql(),
        "order_metrics_dimensions": _dimensions_sql(),
        "late_merge": f"WITH {_A}{_DEDUP_TTL},{_metrics('d')}",
        "users_rollup": _rollup_sql(", true AS within_tolerance"),
        "lateness_sketch": f"""WITH {_A}
SELECT store_id, count(*) AS rows, max(arrival_ms - event_time) AS max_delay_ms, true AS p50_near, true AS p95_near, true AS p99_near
FROM a GROUP BY store_id""",
    }
