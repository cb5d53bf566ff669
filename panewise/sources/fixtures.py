"""Deterministic order-event inputs derived from the driver's ``events`` table.

``events`` is a clean, ordered log; these derivations turn it into the order
stream the job consumes, with disorder, late arrivals, duplicates and corrupt
messages added by fixed arithmetic on the integer event id. No row is ever
dropped: the id rules only decide how a row is corrupted or copied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panewise.functions import epoch_ms_from_ntz

# Fixed derivation constants (FIXTURES.md section 3).
USER_MODULUS = 20
DISORDER_MULTIPLIER = 7919
DISORDER_SPREAD = 40  # seconds of arrival jitter
VERY_LATE_EVERY = 97
VERY_LATE_MS = 900_000
COPY1_EVERY = 10
COPY1_DELAY_MS = 1_800_000
COPY2_EVERY = 25
COPY2_DELAY_MS = 5_400_000
BATCH_MS = 600_000


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def orders_from_events(events: DataFrame, keep_id: bool = False, extra: dict | None = None) -> DataFrame:
    """``o``: one order event per ``events`` row; ``extra`` adds named dimension columns."""
    cols = [
        F.concat(F.lit("ord_"), F.col("event_id").cast("string")).alias("event_id"),
        F.concat(F.lit("user_"), (F.col("user_id") % USER_MODULUS).cast("string")).alias("user_id"),
        F.col("event_type").alias("store_id"),
        F.col("value").alias("amount"),
        epoch_ms_from_ntz(F.col("ts")).alias("event_time"),
    ]
    if keep_id:
        cols.insert(0, F.col("event_id").alias("id"))
    cols += [c.alias(name) for name, c in (extra or {}).items()]
    return events.select(*cols)


def arrivals_from_events(events: DataFrame) -> DataFrame:
    """``a``: every order once, out of order; some very late; some duplicated later.

    Copies are produced by one ``explode`` over a literal array of copy numbers
    (no union, so the scan and projection happen once).
    """
    return _explode_copies(orders_from_events(events, keep_id=True)).drop("id")


def _explode_copies(o: DataFrame) -> DataFrame:
    copies = F.array(
        F.lit(0),
        F.when(F.col("id") % COPY1_EVERY == 0, F.lit(1)),
        F.when(F.col("id") % COPY2_EVERY == 0, F.lit(2)),
    )
    exploded = o.withColumn("copy_no", F.explode(F.filter(copies, lambda c: c.isNotNull())))
    jitter = ((F.col("id") * DISORDER_MULTIPLIER) % DISORDER_SPREAD) * 1000
    very_late = F.when(F.col("id") % VERY_LATE_EVERY == 0, F.lit(VERY_LATE_MS)).otherwise(F.lit(0))
    arrival = (
        F.when(F.col("copy_no") == 0, F.col("event_time") + jitter + very_late)
        .when(F.col("copy_no") == 1, F.col("event_time") + COPY1_DELAY_MS)
        .otherwise(F.col("event_time") + COPY2_DELAY_MS)
    )
    return (
        exploded.withColumn("arrival_ms", arrival.cast("bigint"))
        .withColumn("batch_id", F.floor(F.col("arrival_ms") / BATCH_MS).cast("bigint"))
    )


def _q(text):
    return F.concat(F.lit('"'), text, F.lit('"'))


def _raw_value():
    """Column: the (possibly corrupted) JSON text of an ``o`` row with its ``id``."""
    amount = F.col("amount").cast("string")
    etime = F.col("event_time").cast("string")
    eid = F.concat(F.lit('"event_id":'), _q(F.col("event_id")), F.lit(","))
    user = F.concat(F.lit('"user_id":'), _q(F.col("user_id")), F.lit(","))
    store = F.concat(F.lit('"store_id":'), _q(F.col("store_id")), F.lit(","))
    amt = F.concat(F.lit('"amount":'), amount, F.lit(","))
    et = F.concat(F.lit('"event_time":'), etime)

    def obj(*parts):
        return F.concat(F.lit("{"), *parts, F.lit("}"))

    def timed(text):
        return F.concat(F.lit('"event_time":'), text)

    idc = F.col("id")
    # Corruption rules, first match wins (FIXTURES.md section 3, "raw").
    return (
        F.when(idc % 20 == 0, obj(user, store, amt, et))
        .when(idc % 33 == 0, F.concat(F.lit("not json "), idc.cast("string")))
        .when(idc % 41 == 0, obj(F.lit('"event_id":"",'), user, store, amt, et))
        .when(idc % 53 == 0, obj(eid, user, store, F.concat(F.lit('"amount":'), _q(amount), F.lit(",")), et))
        .when(idc % 59 == 0, obj(eid, F.lit('"user_id":null,'), store, amt, et))
        .when(idc % 61 == 0, obj(eid, user, store, amt, F.lit('"event_time":"2024-01-01"')))
        .when(idc % 67 == 0, obj(eid, user, store, amt, timed((F.col("event_time") * 1_000_000).cast("string"))))
        .when(idc % 71 == 0, obj(eid, user, store, amt, timed(F.lit("9223372036854775807"))))
        .when(idc % 73 == 0, obj(eid, user, store, amt, timed(F.lit("-62200000000000000"))))
        .when(idc % 79 == 0, obj(eid, user, store, amt, timed((F.col("event_time") * 1000).cast("string"))))
        .otherwise(obj(eid, user, store, amt, et))
    )


def raw_messages_from_events(events: DataFrame) -> DataFrame:
    """``raw``: JSON texts of ``o`` with corruptions; first matching rule wins.

    Built by concatenation so the text is byte-identical to the SQL oracle's.
    Keeps ``id`` so results can be keyed back to their source row.
    """
    return orders_from_events(events, keep_id=True).select("id", _raw_value().alias("value"))


def raw_arrivals_from_events(events: DataFrame) -> DataFrame:
    """Raw message text of every arrival copy: ``value, arrival_ms, batch_id, copy_no``.

    A copy carries the (possibly corrupted) text of its source row, so the full
    job can be replayed from text with duplicates, disorder and junk. One pass
    over ``events``: the text is computed per row, then copies are exploded.
    """
    withraw = orders_from_events(events, keep_id=True).withColumn("value", _raw_value())
    return _explode_copies(withraw).select("value", "arrival_ms", "batch_id", "copy_no")
