"""Salt prefixes for two-stage aggregation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def salt_of(row_id: Column, salts: int) -> Column:
    """A salt in ``[0, salts)`` that is the same when a task is run again."""
    return F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")


def add_prefix(key: Column, salt: Column) -> Column:
    return F.concat(salt.cast("string"), F.lit("_"), key.cast("string"))


def strip_prefix(salted: Column) -> Column:
    """Drop only the salt; the key itself may contain underscores."""
    return F.regexp_replace(salted, "^[0-9]+_", "")
