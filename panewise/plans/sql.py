"""Q1: the job's tables as Spark SQL views, and the metrics as one SQL text over the parsed events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panewise.schema import Params

METRICS_SQL = """
SELECT date_format(timestampadd(MILLISECOND, unix_millis(window.start), TIMESTAMP_NTZ'1970-01-01 00:00:00'),
                   'yyyy-MM-dd HH:mm:ss') AS window_start,
       date_format(timestampadd(MILLISECOND, unix_millis(window.end), TIMESTAMP_NTZ'1970-01-01 00:00:00'),
                   'yyyy-MM-dd HH:mm:ss') AS window_end,
       {keys},
       count(*) AS order_cnt,
       floor(sum(amount) * 100 + 0.5) / 100 AS gmv_total,
       CAST(count(DISTINCT user_id) AS BIGINT) AS user_cnt
FROM {view}
GROUP BY window(event_ts, '{size} milliseconds', '{slide} milliseconds'), {keys}
"""


def metrics_sql(parsed: DataFrame, params: Params = Params(), view: str = "panewise_parsed_orders") -> DataFrame:
    """Metrics by ``params.keys`` over a temp view of ``parsed``."""
    parsed.createOrReplaceTempView(view)
    keys = ", ".join(f"`{k}`" for k in params.keys)
    return parsed.sparkSession.sql(METRICS_SQL.format(view=view, keys=keys, size=params.size_ms, slide=params.slide_ms))


def create_views(outputs, prefix: str = "panewise_") -> list[str]:
    """Temp views of a job's outputs (``plans.batch.JobOutputs``): parsed, deduped, late and metrics rows."""
    names = []
    for name in ("parsed", "deduped", "late", "metrics"):
        getattr(outputs, name).createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names
