"""Exact two-digit ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio2(part: str, whole: str) -> Column:
    """``part / whole`` of two bigint columns, rounded half-up to two digits; NULL when ``whole`` is 0.

    The rounding is done on integers: hundredths = (200*part + whole) div (2*whole).
    A double quotient such as 29/200 is not exactly representable, so rounding
    the quotient would depend on the engine.
    """
    return F.expr(
        f"CASE WHEN {whole} <> 0 THEN "
        f"CAST((200 * {part} + {whole}) div (2 * {whole}) AS DOUBLE) / CAST(100 AS DOUBLE) END"
    )
