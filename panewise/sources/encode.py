"""Encode order events as JSON message values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.schema import ORDER_FIELDS


def encode_orders(df: DataFrame, fields: list[str] | None = None, key_col: str | None = None) -> DataFrame:
    """Order rows -> one JSON text per row in ``value`` (Kafka/text sink shape).

    ``key_col`` becomes the message ``key`` so a Kafka sink partitions by it.
    Other columns are dropped; a per-row ``to_json`` runs inside codegen.
    """
    fields = fields or ORDER_FIELDS
    cols = [F.to_json(F.struct(*fields)).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def encode_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """S6 text form: one JSON object per row (``JSONEachRow`` shape), keys in column order, snake_case."""
    return df.select(F.to_json(F.struct(*(cols or df.columns))).alias("value"))


def write_messages(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write encoded messages as text files (one JSON per line), the file twin of a topic."""
    df.select("value").write.mode(mode).text(path)


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str, **producer) -> None:
    """S5 producer: a bounded write of ``key``/``value`` rows to a topic (needs the Kafka connector jar)."""
    from panewise.sources.kafka import kafka_writer_options

    df.write.format("kafka").options(**kafka_writer_options(bootstrap_servers, topic, **producer)).save()
