"""DataFrame -> DataFrame operators of the order pipeline."""

from panewise.operators.parse import anomalies, parse_orders, valid_orders
from panewise.operators.windows import window_metrics

__all__ = ["parse_orders", "valid_orders", "anomalies", "window_metrics"]
