"""Session criteria as Column predicates.

An absent parameter lets everything pass; absent data fails a given parameter.
The predicates are plain expressions, so Catalyst moves the user criteria to
the user table and the session criteria below the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_between(age: Column, low: int | None, high: int | None) -> Column:
    """Age in ``[low, high]``; the criterion is off unless both bounds are given."""
    if low is None or high is None:
        return F.lit(True)
    return F.coalesce(age.between(low, high), F.lit(False))


def in_any(value: Column, wanted: Sequence | None) -> Column:
    """A single value is one of the wanted ones."""
    if wanted is None:
        return F.lit(True)
    return F.coalesce(value.isin(list(wanted)), F.lit(False))


def list_in_any(values: Column, wanted: Sequence | None) -> Column:
    """An array shares at least one element with the wanted values."""
    if wanted is None:
        return F.lit(True)
    return F.coalesce(F.arrays_overlap(values, F.lit(list(wanted))), F.lit(False))


def equals(value: Column, wanted: str | None) -> Column:
    if wanted is None:
        return F.lit(True)
    return F.coalesce(value == F.lit(wanted), F.lit(False))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda left, right: left & right, conditions)


@dataclass(frozen=True)
class Criteria:
    """What a session must satisfy. ``None`` means not restricted."""

    start_age: int | None = None
    end_age: int | None = None
    professionals: Sequence[str] | None = None
    cities: Sequence[str] | None = None
    sex: str | None = None
    keywords: Sequence[str] | None = None
    category_ids: Sequence[int] | None = None

    def user_condition(self) -> Column:
        return all_of(
            age_between(F.col("age"), self.start_age, self.end_age),
            in_any(F.col("professional"), self.professionals),
            in_any(F.col("city"), self.cities),
            equals(F.col("sex"), self.sex),
        )
