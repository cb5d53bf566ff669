"""P9 quality rules; S1-S5 option builders (no Kafka jar or broker is available here)."""

import pytest

from panewise.operators.quality import quality_report
from panewise.sources.kafka import KafkaSource, kafka_reader_options, kafka_writer_options, starting_position_options


def test_quality_report(spark):
    vals = ['{"event_id":"a","amount":0,"event_time":5}', '{"event_id":"b","amount":"x","event_time":"y"}',
            "junk", '{"user_id":"u"}', '{"event_id":"c","user_id":"u","store_id":"s","amount":2,"event_time":99}']
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    got = {r.rule: (r.failed, r.checked) for r in quality_report(df, as_of_ms=50).collect()}
    assert got["malformed_json"] == (1, 5)
    assert got["event_id_missing"] == (1, 5)
    assert got["user_id_defaulted"][0] == 2
    assert got["amount_defaulted"][0] == 1
    assert got["event_time_defaulted"][0] == 1
    assert got["amount_not_positive"][0] == 2
    assert got["event_time_zero"][0] == 1
    assert got["event_time_future"][0] == 1


def test_starting_positions():
    assert starting_position_options("earliest") == {"startingOffsets": "earliest"}
    assert starting_position_options("latest") == {"startingOffsets": "latest"}
    assert starting_position_options("timestamp", 1700000000000) == {"startingTimestamp": "1700000000000"}
    assert starting_position_options("timestamp", None) == {}
    assert starting_position_options("bogus") == {"startingOffsets": "latest"}
    assert starting_position_options(None) == {"startingOffsets": "latest"}
    assert starting_position_options("timestamp", 5, batch=True) == {"startingTimestamp": "5"}
    for start in ("latest", None, "timestamp"):  # a bounded read without a start would read the whole topic
        with pytest.raises(ValueError):
            starting_position_options(start, batch=True)


def test_reader_and_writer_options():
    src = KafkaSource("b:9092", "orders", group_id="g", start_from="earliest", security_protocol="SASL_SSL",
                      sasl_mechanism="PLAIN")
    o = kafka_reader_options(src)
    assert o["kafka.bootstrap.servers"] == "b:9092" and o["subscribe"] == "orders" and o["kafka.group.id"] == "g"
    assert o["startingOffsets"] == "earliest" and o["kafka.security.protocol"] == "SASL_SSL"
    b = kafka_reader_options(KafkaSource("b", "t", start_from="earliest", end_timestamp_ms=5), batch=True)
    assert b["startingOffsets"] == "earliest" and b["endingTimestamp"] == "5"
    w = kafka_writer_options("b", "t", linger_ms=10)
    assert w["kafka.acks"] == "all" and w["kafka.linger.ms"] == "10" and w["topic"] == "t"
    with pytest.raises(ValueError):
        KafkaSource("", "t")


def test_read_kafka_without_connector_explains(spark):
    from panewise.sources.kafka import read_kafka

    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_kafka(spark, KafkaSource("localhost:1", "orders", start_from="earliest"), batch=True)


def test_message_files_roundtrip_and_dead_letter_text(spark, tmp_path):
    from pyspark.sql import functions as F

    from panewise.operators.parse import anomalies, anomaly_log_lines, parse_orders
    from panewise.sources.encode import encode_orders, write_messages
    from panewise.sources.files import read_messages

    orders = spark.createDataFrame([("e1", "u", "s", 1.5, 10)], "event_id string, user_id string, "
                                   "store_id string, amount double, event_time long")
    out = str(tmp_path / "msgs")
    write_messages(encode_orders(orders).union(spark.createDataFrame([("junk",)], "value string")), out)
    msgs = read_messages(spark, out)
    assert set(msgs.columns) == {"value", "ingest_ms"} and msgs.count() == 2
    p = parse_orders(msgs)
    assert p.filter(F.col("reason").isNull()).first().amount == 1.5
    lines = [r.value for r in anomaly_log_lines(anomalies(p)).collect()]
    assert lines == ["Failed to parse message: junk, err=malformed_json"]
