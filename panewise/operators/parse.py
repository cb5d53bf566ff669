"""Lenient JSON parsing, validation, defaults, valid/anomaly split, event time.

A message becomes at most one order event. The JSON is read with an all-STRING
schema, so a number sent as text or a date in a number field does not flag
the whole record; the text is then coerced leniently (bad numbers become 0).
Three things make a message an anomaly: it is not a JSON object
(``malformed_json``), it has no usable ``event_id`` (``event_id_missing``), or its
event time lies outside the years 1 to 9999 (``event_time_out_of_range``; no
timestamp could hold it, and one such message must not stop the job).

Works unchanged on a streaming DataFrame: every step is a per-row expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panewise.functions import is_container_json, lenient_double, lenient_long, ms_to_timestamp
from panewise.schema import (
    DEFAULT_AMOUNT,
    DEFAULT_EVENT_TIME,
    DEFAULT_STORE_ID,
    DEFAULT_USER_ID,
    MAX_EVENT_MS,
    MIN_EVENT_MS,
    RAW_JSON,
    REASON_MALFORMED,
    REASON_MISSING_ID,
    REASON_TIME_RANGE,
)

_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def parse_orders(
    df: DataFrame,
    value_col: str = "value",
    keep_value: bool = True,
    flags: bool = False,
    extra_fields: tuple[str, ...] = (),
) -> DataFrame:
    """Raw messages -> parsed rows with a ``reason`` column (NULL for valid rows).

    Output: the input columns (``value`` kept unless ``keep_value=False``),
    then ``event_id, user_id, store_id, amount, event_time, event_ts, reason``;
    with ``flags`` also ``<field>_defaulted`` booleans (missing, null or unparsable);
    ``extra_fields`` are further JSON fields kept as text (extra metric dimensions, A6).
    """
    # a new StructType: ``StructType.add`` would mutate the shared RAW_JSON in place
    schema = T.StructType(RAW_JSON.fields + [T.StructField(n, T.StringType(), True) for n in extra_fields])
    j = F.from_json(F.col(value_col), schema, _JSON_OPTIONS)
    # explode of a one-element array is a plan barrier: a later filter on
    # ``reason`` cannot be pushed below it and inline ``from_json`` several
    # times, so every message is parsed exactly once.
    staged = df.select("*", F.explode(F.array(j)).alias("_j"))
    raw_id = F.col("_j.event_id")
    malformed = F.col("_j").isNull() | F.col("_j._corrupt_record").isNotNull()
    missing_id = (
        raw_id.isNull()
        | (raw_id == F.lit(""))
        | is_container_json(F.col(value_col), "event_id", raw_id)
    )
    event_time = lenient_long(F.col("_j.event_time"), DEFAULT_EVENT_TIME)
    in_range = event_time.between(MIN_EVENT_MS, MAX_EVENT_MS)
    reason = (
        F.when(malformed, F.lit(REASON_MALFORMED))
        .when(missing_id, F.lit(REASON_MISSING_ID))
        .when(~in_range, F.lit(REASON_TIME_RANGE))
        .otherwise(F.lit(None).cast("string"))
    )
    out = staged.select(
        *[c for c in df.columns if keep_value or c != value_col],
        raw_id.alias("event_id"),
        F.coalesce(F.col("_j.user_id"), F.lit(DEFAULT_USER_ID)).alias("user_id"),
        F.coalesce(F.col("_j.store_id"), F.lit(DEFAULT_STORE_ID)).alias("store_id"),
        lenient_double(F.col("_j.amount"), DEFAULT_AMOUNT).alias("amount"),
        event_time.alias("event_time"),
        F.when(in_range, ms_to_timestamp(event_time)).alias("event_ts"),
        reason.alias("reason"),
        *(_default_flags() if flags else []),
        *[F.col("_j")[name].alias(name) for name in extra_fields],
    )
    return out


def _default_flags():
    j = F.col("_j")
    return [
        j["user_id"].isNull().alias("user_id_defaulted"),
        j["store_id"].isNull().alias("store_id_defaulted"),
        j["amount"].try_cast("double").isNull().alias("amount_defaulted"),
        (j["event_time"].try_cast("bigint").isNull()
         & j["event_time"].try_cast("double").try_cast("bigint").isNull()).alias("event_time_defaulted"),
    ]


def valid_orders(parsed: DataFrame) -> DataFrame:
    """Rows that became order events (drops the raw text and ``reason``)."""
    return parsed.filter(F.col("reason").isNull()).drop("reason", "value")


def anomalies(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """Dead-letter rows: the raw text, the reason and any pass-through metadata."""
    drop = {"event_id", "user_id", "store_id", "amount", "event_time", "event_ts"}
    cols = [c for c in parsed.columns if c not in drop]
    return parsed.filter(F.col("reason").isNotNull()).select(*cols)


def anomaly_log_lines(dead: DataFrame, value_col: str = "value") -> DataFrame:
    """S8 text form: ``Failed to parse message: <raw>, err=<reason>`` per row."""
    return dead.select(
        F.concat(F.lit("Failed to parse message: "), F.coalesce(F.col(value_col), F.lit("null")),
                 F.lit(", err="), F.col("reason")).alias("value")
    )
