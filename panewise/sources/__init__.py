"""Sources and encoders: Kafka options, JSON encoding, file streams, derived fixtures."""

from panewise.sources.encode import encode_orders
from panewise.sources.kafka import KafkaSource, kafka_reader_options, starting_position_options

__all__ = ["encode_orders", "KafkaSource", "kafka_reader_options", "starting_position_options"]
