"""Kafka source options.

The job reads one topic with a group id, keeps offsets in the streaming
checkpoint (Spark never commits them to Kafka, which is the same guarantee as
commit-on-checkpoint) and starts from ``earliest``, ``latest`` or a timestamp.
Security settings are passed through as ``kafka.*`` options.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def starting_position_options(start_from: str | None, timestamp_ms: int | None = None, *, batch: bool = False) -> dict:
    """Map the start position to Spark options.

    ``earliest``/``latest`` map directly; ``timestamp`` with a value maps to
    ``startingTimestamp``; ``timestamp`` without a value sets nothing (the
    source default applies); anything else means ``latest``. A bounded read
    that starts at ``latest`` would read nothing, and Spark's own default would read the whole
    topic: batch mode wants ``earliest`` or a timestamp and raises otherwise.
    """
    mode = (start_from or "latest").strip().lower()
    if batch and not (mode == "earliest" or mode == "timestamp" and timestamp_ms is not None):
        raise ValueError("a bounded read needs start_from='earliest' or 'timestamp' with timestamp_ms")
    if mode == "earliest":
        return {"startingOffsets": "earliest"}
    if mode == "timestamp":
        return {"startingTimestamp": str(int(timestamp_ms))} if timestamp_ms is not None else {}
    return {"startingOffsets": "latest"}


@dataclass
class KafkaSource:
    bootstrap_servers: str
    topic: str
    group_id: str | None = None
    start_from: str = "latest"
    timestamp_ms: int | None = None
    end_timestamp_ms: int | None = None
    security_protocol: str | None = None
    sasl_mechanism: str | None = None
    sasl_jaas_config: str | None = None
    max_offsets_per_trigger: int | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if not self.bootstrap_servers:
            raise ValueError("bootstrap_servers is required")
        if not self.topic:
            raise ValueError("topic is required")


def kafka_reader_options(src: KafkaSource, *, batch: bool = False) -> dict:
    opts = {
        "kafka.bootstrap.servers": src.bootstrap_servers,
        "subscribe": src.topic,
        "failOnDataLoss": "true",
    }
    if src.group_id:
        opts["kafka.group.id"] = src.group_id
    opts.update(starting_position_options(src.start_from, src.timestamp_ms, batch=batch))
    if batch and src.end_timestamp_ms is not None:
        opts["endingTimestamp"] = str(int(src.end_timestamp_ms))
    if src.security_protocol:
        opts["kafka.security.protocol"] = src.security_protocol
    if src.sasl_mechanism:
        opts["kafka.sasl.mechanism"] = src.sasl_mechanism
    if src.sasl_jaas_config:
        opts["kafka.sasl.jaas.config"] = src.sasl_jaas_config
    if src.max_offsets_per_trigger and not batch:
        opts["maxOffsetsPerTrigger"] = str(int(src.max_offsets_per_trigger))
    opts.update({k: str(v) for k, v in src.extra.items()})
    return opts


def read_kafka(spark: SparkSession, src: KafkaSource, *, batch: bool = False) -> DataFrame:
    """Raw messages as ``value STRING`` plus ``topic, partition, offset, kafka_ts`` and ``ingest_ms``."""
    reader = spark.read if batch else spark.readStream
    try:
        df = reader.format("kafka").options(**kafka_reader_options(src, batch=batch)).load()
    except Exception as e:  # the connector is a separate package of the Spark distribution
        if "kafka" in str(e).lower() and "data source" in str(e).lower():
            raise RuntimeError(
                "the Kafka source needs the spark-sql-kafka-0-10 connector on the classpath "
                "(spark.jars.packages); files can be replayed with sources.files.read_messages"
            ) from e
        raise
    return df.select(
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_ts"),
        F.unix_millis(F.col("timestamp")).alias("ingest_ms"),
    )


def kafka_writer_options(bootstrap_servers: str, topic: str, **producer) -> dict:
    """S5 producer side: acks/retries/linger/batch map to ``kafka.*`` options."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    defaults = {"acks": "all", "retries": 3, "linger.ms": 50, "batch.size": 16384}
    defaults.update({k.replace("_", "."): v for k, v in producer.items()})
    opts.update({f"kafka.{k}": str(v) for k, v in defaults.items()})
    return opts
