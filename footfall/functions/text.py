"""Small string helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_empty(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0)) == 0


def is_not_empty(text: Column) -> Column:
    return ~is_empty(text)


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def trim_comma(text: Column) -> Column:
    """Remove at most one comma at each end."""
    return F.regexp_replace(text, "^,|,$", "")


def pad2(text: Column) -> Column:
    """Two characters stay; everything else gets one leading zero (``7`` -> ``07``)."""
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def id_name(identifier: Column, name: Column, separator: str = ":") -> Column:
    """``12:Berlin``; NULL when either side is NULL."""
    return F.concat(identifier.cast("string"), F.lit(separator), name)


def unreadable_ids(text: Column) -> Column:
    """The items of a comma list that :func:`id_list` leaves out because they are no numbers."""
    parts = F.split(trim_comma(null_if_empty(text)), ",")
    return F.coalesce(F.filter(parts, lambda p: p.try_cast("bigint").isNull()), F.array().cast("array<string>"))


def id_list(text: Column) -> Column:
    """A comma list of ids as an array of bigint; NULL or empty text gives an empty array.

    Items that are no numbers are left out; :func:`unreadable_ids` has them.
    """
    parts = F.split(trim_comma(text), ",")
    ids = F.filter(F.transform(parts, lambda p: p.try_cast("bigint")), lambda v: v.isNotNull())
    return F.coalesce(ids, F.array().cast("array<bigint>"))
