"""How a result table changes when new rows arrive, as pure functions.

The same functions serve batch jobs and streaming batches. Upserts are one
union and one aggregation: a single shuffle with partial aggregation, instead
of a full outer join of both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_replace(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], value: str = "click_count"
) -> DataFrame:
    """New keys are inserted; the value of an existing key becomes the update's.

    A NULL update keeps the stored value. Of several updates of one key the largest value counts.
    """
    both = target.select(*keys, value, F.lit(0).alias("_version")).unionByName(
        updates.select(*keys, value, F.lit(1).alias("_version"))
    )
    order = F.when(F.col(value).isNotNull(), F.struct("_version", value))
    return both.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def upsert_increment(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], value: str = "click_count"
) -> DataFrame:
    """New keys are inserted; an update is added to the value of an existing key."""
    both = target.select(*keys, value).unionByName(updates.select(*keys, value))
    return both.groupBy(*keys).agg(F.sum(value).alias(value))


def replace_group(target: DataFrame, new: DataFrame, group: Sequence[str]) -> DataFrame:
    """All rows of every group present in ``new`` are exchanged for the new ones."""
    touched = new.select(*group).distinct()
    return _matching(target, touched, group, "left_anti").unionByName(new)


def newest(log: DataFrame, keys: Sequence[str], value: str, version: str) -> DataFrame:
    """Per key the value with the highest version."""
    return log.groupBy(*keys).agg(F.max_by(value, version).alias(value))


def newest_groups(log: DataFrame, group: Sequence[str], version: str) -> DataFrame:
    """Per group all rows of its highest version."""
    last = log.groupBy(*group).agg(F.max(version).alias(version))
    return _matching(log, last, [*group, version], "left_semi").drop(version)


def _matching(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A semi or anti join in which NULL keys equal each other."""
    renamed = wanted.select(*[F.col(key).alias(f"_k_{key}") for key in keys])
    same = [F.col(key).eqNullSafe(F.col(f"_k_{key}")) for key in keys]
    return rows.join(renamed, same, how)
