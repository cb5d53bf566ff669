"""Stored partial metrics that later rows can be added to.

``UserDictionary`` gives every user a number that never changes. ``PartialsTable`` keeps partial rows (window, keys,
word of 64 users: count, sum, bits) in folders ``window_date=<d>/source=<s>/batch_id=<n>``, overwritten as a whole, so a
repeated write replaces itself. Reading merges all sources: rows that were late for a window are written as a
source of their own (``late_partials``) and count from then on, without the events that were on time being read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panewise.functions import date_key, timestamp_to_ms
from panewise.operators.distinct import BITS, WORD, number_users
from panewise.operators.late import is_dead
from panewise.operators.slices import merge, partial_rows, window_metrics_of
from panewise.operators.windows import assign_panes
from panewise.schema import Params
from panewise.session import path_exists


class UserDictionary:
    """(user_id, user_no) in folders ``version=<n>``; a version numbers the users that no earlier one has."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def users(self, before: int | None = None) -> DataFrame:
        schema = "user_id string, user_no long, version long"
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        known = self.spark.read.schema(schema).parquet(self.path)
        return known if before is None else known.filter(F.col("version") < before)

    def extend(self, users: DataFrame, version: int) -> None:
        """Number the unknown users of the one column of ``users``. A retry of the same version gives the same numbers."""
        known = self.users(version)
        largest = known.agg(F.max("user_no")).first()[0]
        start = 0 if largest is None else largest + 1
        new = users.select(F.col(users.columns[0]).alias("user_id")).join(known, "user_id", "left_anti")
        number_users(new, start).write.mode("overwrite").parquet(f"{self.path}/version={int(version)}")

    def numbered(self, df: DataFrame, user_col: str = "user_id") -> DataFrame:
        """``df`` with ``user_no``, null where the user has no number."""
        known = self.users().select(F.col("user_id").alias("_known"), "user_no")
        return df.join(known, F.col(user_col) == F.col("_known"), "left").drop("_known")


class PartialsTable:
    """Partial rows of windows by source; ``metrics`` merges them."""

    def __init__(self, spark: SparkSession, path: str, params: Params = Params()):
        self.spark, self.path, self.params = spark, path.rstrip("/"), params
        self.group = ["window_start_ms", *params.keys]

    def write(self, partials: DataFrame, source: str, batch_id: int) -> None:
        """Replace what ``source`` has written under ``batch_id`` for the days of ``partials``."""
        rows = merge(partials, self.group).withColumns({
            "window_date": date_key(F.col("window_start_ms")), "source": F.lit(source), "batch_id": F.lit(int(batch_id)).cast("bigint")})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window_date", "source", "batch_id").parquet(self.path)

    def partials(self, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
        fields = [*[f"`{k}` string" for k in self.params.keys], f"{WORD} long", "order_cnt long", "gmv double", f"{BITS} long"]
        rows = self.spark.read.schema("window_start_ms long, " + ", ".join(fields) + ", window_date string, source string, batch_id long").parquet(self.path)
        for bound, keep in ((date_from, F.col("window_date") >= F.lit(date_from)), (date_to, F.col("window_date") <= F.lit(date_to))):
            rows = rows if bound is None else rows.filter(keep)
        return rows

    def metrics(self, date_from: str | None = None, date_to: str | None = None, sources: list[str] | None = None, keep_ms: bool = False) -> DataFrame:
        """Metric rows over all sources, or over the given ones."""
        rows = self.partials(date_from, date_to)
        rows = rows if sources is None else rows.filter(F.col("source").isin(sources))
        return window_metrics_of(rows, self.params, keep_ms=keep_ms)


def _pane_partials(classified: DataFrame, params: Params, late: bool) -> DataFrame:
    panes = assign_panes(classified.withColumn("event_ts", F.timestamp_millis("event_time")), params)
    dead = is_dead(timestamp_to_ms(F.col("window.end")), F.col("max_prev_ms"), params)
    panes = panes.filter(dead if late else ~dead).withColumn("window_start_ms", timestamp_to_ms(F.col("window.start")))
    return partial_rows(panes, ["window_start_ms", *params.keys], numbered=True)


def on_time_partials(classified: DataFrame, params: Params = Params()) -> DataFrame:
    """Partial rows of the (row, window) pairs that were open; ``classified`` has ``max_prev_ms`` and ``user_no``."""
    return _pane_partials(classified, params, late=False)


def late_partials(classified: DataFrame, params: Params = Params()) -> DataFrame:
    """Partial rows of the pairs that came too late: rows of the late table, and the closed windows of rows that were on time for a newer one."""
    return _pane_partials(classified, params, late=True)
