"""JSON helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_container_json(raw: Column, field: str, text: Column) -> Column:
    """True when ``field`` of the JSON text ``raw`` holds an object or an array.

    ``from_json`` into a STRING field returns nested JSON as text, so an object
    id would look like a valid id. Only rows whose text starts with ``{`` or
    ``[`` pay for the variant parse (CASE evaluates its branch lazily); a quoted
    string such as ``"{x"`` is still a string.
    """
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(raw), f"$.{field}", "variant"))
    container = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    starts = F.substring(text, 1, 1).isin("{", "[")
    return F.when(starts, F.coalesce(container, F.lit(False))).otherwise(F.lit(False))
