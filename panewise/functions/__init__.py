"""Column-level helpers (JVM-side expressions only, no UDFs)."""

from panewise.functions.numeric import half_up_round, lenient_double, lenient_long
from panewise.functions.timecols import (
    date_key,
    epoch_ms_from_ntz,
    ms_to_text,
    ms_to_timestamp,
    timestamp_to_ms,
    utc_date,
)
from panewise.functions.jsonish import is_container_json

__all__ = [
    "half_up_round",
    "lenient_double",
    "lenient_long",
    "date_key",
    "epoch_ms_from_ntz",
    "ms_to_text",
    "ms_to_timestamp",
    "timestamp_to_ms",
    "utc_date",
    "is_container_json",
]
