"""Data-quality rules over raw messages, one row per rule.

All rules are counted in a single global aggregation (partial per task, one
row shuffled per task), then turned into rows with ``stack``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.operators.parse import parse_orders
from panewise.schema import REASON_MALFORMED, REASON_MISSING_ID, REASON_TIME_RANGE


def quality_report(raw: DataFrame, as_of_ms: int, value_col: str = "value") -> DataFrame:
    """Counts of rule violations; ``as_of_ms`` is the fixed instant for the future-time rule."""
    p = parse_orders(raw, value_col=value_col, keep_value=False, flags=True)
    ok = F.col("reason").isNull()
    rules = [
        ("malformed_json", F.col("reason") == F.lit(REASON_MALFORMED)),
        ("event_id_missing", F.col("reason") == F.lit(REASON_MISSING_ID)),
        ("event_time_out_of_range", F.col("reason") == F.lit(REASON_TIME_RANGE)),
        ("user_id_defaulted", ok & F.col("user_id_defaulted")),
        ("store_id_defaulted", ok & F.col("store_id_defaulted")),
        ("amount_defaulted", ok & F.col("amount_defaulted")),
        ("event_time_defaulted", ok & F.col("event_time_defaulted")),
        ("amount_not_positive", ok & (F.col("amount") <= F.lit(0.0))),
        ("event_time_zero", ok & (F.col("event_time") == F.lit(0))),
        ("event_time_future", ok & (F.col("event_time") > F.lit(as_of_ms))),
    ]
    counts = p.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in rules],
    )
    pairs = ", ".join(f"'{name}', `{name}`" for name, _ in rules)
    return counts.select(F.expr(f"stack({len(rules)}, {pairs}) AS (rule, failed)"), "checked")
