"""Versioned metric table with latest-per-key reads.

The job's table keeps one row per ``(window_start, store_id)`` by re-inserting
and letting the newest ``update_time`` win. Here every write appends a
*version* ``(epoch, batch_id, folded)`` into its own partition
``window_date=<d>/epoch=<e>/batch_id=<n>/folded=<f>`` with dynamic partition overwrite:
a retried micro-batch rewrites exactly the partitions it wrote before, so it
can never duplicate. ``latest`` keeps the highest version per key with one
combinable ``max(struct)`` aggregation (no sort, no window). A backfill uses a
higher ``epoch``; a row with ``order_cnt = 0`` is a tombstone: the window exists no more.

``compact`` folds the versions of a day into one that ranks just above the
highest it has folded and below every later version, so a stream that goes on
writing still wins, and a retry of an old batch still loses. It reads and deletes
exactly the version folders listed when it starts; folders that appear meanwhile stay.
``update_time`` is recorded for information only and never decides a version.

Rows of the user grain (an update-mode stream's ``user_metrics``) are versioned by (window, keys, user) in a folder
beside the table, and ``latest`` sums their newest versions: a changed user is one row to write, and the exact
distinct count is a count of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panewise.functions import date_key, half_up_round
from panewise.schema import METRIC_ROW
from panewise.session import path_exists

VERSION_COLS = ["epoch", "batch_id", "folded"]


def latest_rows(df: DataFrame, key_cols=("window_start", "store_id"), version_cols=VERSION_COLS) -> DataFrame:
    """The row with the highest version per key (ties broken by the remaining columns)."""
    key_cols, version_cols = list(key_cols), list(version_cols)
    rest = [c for c in df.columns if c not in key_cols and c not in version_cols]
    top = df.groupBy(*key_cols).agg(F.max(F.struct(*version_cols, *rest)).alias("_v"))
    return top.select(*key_cols, "_v.*").select(*df.columns)


class MetricsTable:
    """A directory of versioned metric rows partitioned by day of ``window_start``."""

    def __init__(self, spark: SparkSession, path: str, keys=("store_id",)):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)

    @property
    def by_user(self) -> MetricsTable:
        """The rows of this table that are kept by user."""
        return MetricsTable(self.spark, f"{self.path}_by_user", [*self.keys, "user_id"])

    @property
    def schema(self) -> T.StructType:
        fields = [f for f in METRIC_ROW.fields if f.name != "store_id"]
        key_fields = [T.StructField(k, T.StringType(), True) for k in self.keys]
        return T.StructType(
            fields[:2] + key_fields + fields[2:]
            + [
                T.StructField("update_time", T.TimestampType(), True),
                T.StructField("window_date", T.StringType(), True),
                T.StructField("epoch", T.LongType(), True),
                T.StructField("batch_id", T.LongType(), True),
                T.StructField("folded", T.LongType(), True),
            ]
        )

    def write_batch(self, metrics: DataFrame, batch_id: int, epoch: int = 0, files_per_date: int | None = None) -> None:
        """Write one version of ``metrics`` (``window_metrics(..., keep_window=True)`` or plain rows).

        ``files_per_date``: that many files for each day, dealt by hash of the row's key; None leaves
        the files as the plan's last stage has them.
        """
        if "user_id" in metrics.columns and "user_id" not in self.keys:
            self.by_user.write_batch(metrics, batch_id, epoch, files_per_date)
            return
        version = (F.lit(int(epoch)), F.lit(int(batch_id)), F.lit(0))
        self._write(metrics.withColumns(dict(zip(VERSION_COLS, version, strict=True))), None if files_per_date is None else F.lit(int(files_per_date)))

    def _write(self, rows: DataFrame, files_per_date: Column | None) -> None:
        """Rows that carry their version columns; ``files_per_date`` may differ from row to row only by the day."""
        if "window_start_ms" in rows.columns:
            day = date_key(F.col("window_start_ms"))
        else:
            day = F.regexp_replace(F.substring_index("window_start", " ", 1), "-", "")
        out = rows.select(
            "window_start", "window_end", *self.keys, "order_cnt", "gmv_total", "user_cnt",
            F.current_timestamp().alias("update_time"),
            day.alias("window_date"),
            *[F.col(c).cast("bigint").alias(c) for c in VERSION_COLS],
            *([files_per_date.alias("_files")] if files_per_date is not None else []),
        )
        if files_per_date is not None:
            salt = F.pmod(F.xxhash64("window_start", *self.keys), F.greatest(F.col("_files").cast("long"), F.lit(1)))
            # the files of a day go to partitions one after another, at most all of them
            n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            out = out.repartitionById(n, F.pmod(F.hash("window_date") + salt, F.lit(n)).cast("int")).drop("_files")
        (
            out.sortWithinPartitions("window_date", *VERSION_COLS, "window_start", *self.keys)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("window_date", *VERSION_COLS)
            .parquet(self.path)
        )

    def versions(self, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
        df = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(self.path)
        if date_from is not None:
            df = df.filter(F.col("window_date") >= F.lit(date_from))
        if date_to is not None:
            df = df.filter(F.col("window_date") <= F.lit(date_to))
        return df

    def latest(self, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
        """Current value per ``(window_start, keys)``; date bounds prune partitions before the aggregation."""
        if not path_exists(self.spark, self.by_user.path):
            return self._latest_here(date_from, date_to)
        users = self.by_user._latest_here(date_from, date_to)
        summed = users.groupBy("window_start", "window_end", *self.keys).agg(
            F.sum("order_cnt").alias("order_cnt"), half_up_round(F.sum("gmv_total"), 2).alias("gmv_total"), F.sum("user_cnt").alias("user_cnt"),
            *[F.max(c).alias(c) for c in ("update_time", "window_date", *VERSION_COLS)],
        ).select(*self.schema.names)
        return summed.unionByName(self._latest_here(date_from, date_to)) if path_exists(self.spark, self.path) else summed

    def _latest_here(self, date_from: str | None, date_to: str | None) -> DataFrame:
        v = self.versions(date_from, date_to)
        return latest_rows(v, ["window_start", *self.keys], VERSION_COLS).filter("order_cnt > 0")

    def compact(self, date_from: str, date_to: str, rows_per_file: int = 1_000_000) -> None:
        """Fold every version of the dates that is there now into one, then drop those version folders.

        A day gets a file for about every ``rows_per_file`` rows of its versions, dealt by hash of the row's key, so a
        day of many rows is the work of many tasks. Rows kept by user are folded likewise.

        The folded version is written before anything is removed, so a crash in
        between leaves a readable, still-correct table. The file listing of ``found`` is
        taken once, here; both what is read and what is deleted follow it.
        """
        if "user_id" not in self.keys and path_exists(self.spark, self.by_user.path):
            self.by_user.compact(date_from, date_to, rows_per_file)
        if not path_exists(self.spark, self.path):
            return
        found = self.versions(date_from, date_to)
        listed = [tuple(r) for r in found.groupBy("window_date", *VERSION_COLS).count().collect()]  # a row per version and day
        by_date: dict[str, list[tuple]] = {}
        sizes: dict[str, int] = {}
        for day, *version, n in listed:
            by_date.setdefault(day, []).append(tuple(version))
            sizes[day] = sizes.get(day, 0) + n
        by_date = {d: v for d, v in by_date.items() if len(v) > 1}
        if not by_date:
            return
        tops = {d: max(v) for d, v in by_date.items()}
        target = self.spark.createDataFrame(
            [(d, e, b, f + 1, -(-sizes[d] // rows_per_file)) for d, (e, b, f) in tops.items()],
            "day string, to_epoch long, to_batch_id long, to_folded long, to_files long",
        )
        rows = latest_rows(found, ["window_start", *self.keys], VERSION_COLS)
        rows = rows.join(target, rows["window_date"] == target["day"])
        self._write(rows.withColumns({c: F.col(f"to_{c}") for c in VERSION_COLS}), F.col("to_files"))
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for day, versions in by_date.items():
            for version in versions:
                parts = "/".join(f"{c}={x}" for c, x in zip(VERSION_COLS, version, strict=True))
                folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/window_date={day}/{parts}")
                folder.getFileSystem(conf).delete(folder, True)


def write_rows(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """S8/S9 side tables (anomalies, late events): one partition per batch, overwritten on retry."""
    (
        df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .format(fmt)
        .save(path)
    )
