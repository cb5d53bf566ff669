"""File twins of the topic: JSON-lines text read as ``value STRING`` (batch or stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_messages(spark: SparkSession, path: str, *, stream: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    """One message per line; ``ingest_ms`` is the file modification time (arrival order in a replay)."""
    if stream:
        reader = spark.readStream.format("text")
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
        df = reader.load(path)
    else:
        df = spark.read.format("text").load(path)
    return df.select(
        "value",
        F.unix_millis(F.col("_metadata.file_modification_time")).alias("ingest_ms"),
    )
