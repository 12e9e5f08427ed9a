"""JSON text fields. Malformed JSON gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_field(text: Column, field: str) -> Column:
    """Field of a JSON object as string, named without a path prefix."""
    return F.get_json_object(text, f"$.{field}")


def json_item_field(text: Column, index: int, field: str) -> Column:
    """Field of element ``index`` of a JSON array of objects."""
    return F.get_json_object(text, f"$[{index}].{field}")
