"""The first rows of every group for any limit, without sorting a group in one task.

Up to Spark's own limit (``spark.sql.optimizer.windowGroupLimitThreshold``, 1000) a rank filter is
trimmed per task before the shuffle, and a plain window is best. Beyond it, rows are selected by
threshold: a histogram over a coarse prefix of the order tells, per group, in which bucket the limit
falls. Rows of earlier buckets are taken unsorted, only those of the border bucket are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.ordered_groups import rank_in_group

# Fixed value: the largest limit for which Spark trims groups before the shuffle.
TRIMMED = 1000


def _cuts(df: DataFrame, keys: Sequence[str], bucket: str, limit: str) -> DataFrame:
    """Per group with at least ``limit`` rows: the bucket in which its limit-th row lies, and the rows before that bucket."""
    counts = df.groupBy(*keys, F.expr(bucket).alias("_border")).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.expr(limit)).alias("_limit")
    )
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_border").rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_before", upto - F.col("_n"))
    cuts = placed.where("_before < _limit and _before + _n >= _limit").drop("_n")
    return cuts.withColumnsRenamed({key: f"_k_{key}" for key in keys})


def _cut(df: DataFrame, keys: Sequence[str], bucket: str, limit: str, how: str) -> DataFrame:
    cuts = _cuts(df, keys, bucket, limit)
    same = [F.col(key).eqNullSafe(F.col(f"_k_{key}")) for key in keys]
    return df.join(cuts, same, how).drop(*[f"_k_{key}" for key in keys])


def first_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str, limit: str) -> DataFrame:
    """The rows of every group whose number in ``order`` is at most ``limit``.

    ``bucket`` is an SQL expression that never falls along ``order`` and has a bounded number of
    values; ``limit`` one that is the same for all rows of a group.
    """
    rows = _cut(df.where(f"{limit} > 0"), keys, bucket, limit, "left")
    whole = rows.where(f"_border is null or {bucket} < _border")
    ranked = rank_in_group(rows.where(f"{bucket} = _border"), keys, order, "_rank").where("_rank <= _limit - _before")
    return whole.select(*df.columns).union(ranked.select(*df.columns))


def nth_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str, limit: str) -> DataFrame:
    """The row of every group whose number in ``order`` is ``limit``; no row for a smaller group."""
    border = _cut(df.where(f"{limit} > 0"), keys, bucket, limit, "inner").where(f"{bucket} = _border")
    return rank_in_group(border, keys, order, "_rank").where("_rank = _limit - _before").select(*df.columns)
