"""Schemas and parameters of the order pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Parsed order event: the five fields the job reads from each JSON message.
ORDER_FIELDS = ["event_id", "user_id", "store_id", "amount", "event_time"]

ORDER_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("store_id", T.StringType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("event_time", T.LongType(), False),
    ]
)

# Every field is read as text first, so one odd number never flags the whole record.
RAW_JSON = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in ORDER_FIELDS]
    + [T.StructField("_corrupt_record", T.StringType(), True)]
)

METRIC_FIELDS = ["window_start", "window_end", "store_id", "order_cnt", "gmv_total", "user_cnt"]

METRIC_ROW = T.StructType(
    [
        T.StructField("window_start", T.StringType(), False),
        T.StructField("window_end", T.StringType(), False),
        T.StructField("store_id", T.StringType(), False),
        T.StructField("order_cnt", T.LongType(), False),
        T.StructField("gmv_total", T.DoubleType(), False),
        T.StructField("user_cnt", T.LongType(), False),
    ]
)

# Fixed values that must equal the reference job's behaviour.
DEFAULT_USER_ID = "unknown"
DEFAULT_STORE_ID = "default"
DEFAULT_AMOUNT = 0.0
DEFAULT_EVENT_TIME = 0
REASON_MALFORMED = "malformed_json"
REASON_MISSING_ID = "event_id_missing"
REASON_TIME_RANGE = "event_time_out_of_range"
# Event times from 0001-01-02 up to 9999-12-30 23:59:59.999 UTC; a day is left at either end for windows.
# Others (nanoseconds, say) have no timestamp; such messages go to the dead letters instead of stopping the job.
MIN_EVENT_MS = -62_135_510_400_000
MAX_EVENT_MS = 253_402_214_399_999
TIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_KEY_FORMAT = "yyyyMMdd"


@dataclass(frozen=True)
class Params:
    """Window and lateness parameters, in milliseconds.

    Defaults are the reference job's: 60 s windows sliding by 30 s, a 10 s
    out-of-orderness bound, 5 s allowed lateness and a 1 h dedup TTL.
    """

    size_ms: int = 60_000
    slide_ms: int = 30_000
    bound_ms: int = 10_000
    lateness_ms: int = 5_000
    ttl_ms: int | None = 3_600_000
    keys: tuple[str, ...] = field(default=("store_id",))

    def __post_init__(self):
        if self.size_ms <= 0 or self.slide_ms <= 0:
            raise ValueError("window size and slide must be positive")
        if self.slide_ms > self.size_ms:
            raise ValueError("slide larger than size leaves gaps between windows")

    @property
    def delay_ms(self) -> int:
        """Watermark delay that evicts exactly when the reference drops a window."""
        return self.bound_ms + self.lateness_ms

    @property
    def size(self) -> str:
        return f"{self.size_ms} milliseconds"

    @property
    def slide(self) -> str:
        return f"{self.slide_ms} milliseconds"

    @property
    def delay(self) -> str:
        return f"{self.delay_ms} milliseconds"
