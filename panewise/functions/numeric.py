"""Numeric coercions and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_round(c: Column, digits: int = 2) -> Column:
    """Round half towards +infinity, as ``Math.round(x * 10^d) / 10^d``.

    ``F.round`` rounds half away from zero (-0.125 -> -0.13); the job rounds
    -0.125 to -0.12, which is ``floor(x * 10^d + 0.5) / 10^d``.
    """
    scale = float(10**digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def lenient_double(text: Column, default: float = 0.0) -> Column:
    """JSON value text -> DOUBLE; anything unparsable or missing becomes ``default``."""
    return F.coalesce(_try_cast(text, "DOUBLE"), F.lit(float(default)))


def lenient_long(text: Column, default: int = 0) -> Column:
    """JSON value text -> BIGINT; float text is truncated, anything else becomes ``default``."""
    return F.coalesce(
        _try_cast(text, "BIGINT"),
        _try_cast(_try_cast(text, "DOUBLE"), "BIGINT"),
        F.lit(default).cast("bigint"),
    )


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)
