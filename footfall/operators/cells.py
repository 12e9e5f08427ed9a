"""Scans over a cell table ``(row, family, qualifier, ts, value)``.

Spark compares strings by bytes, as row keys, families and qualifiers need.
The comparisons are plain predicates on stored columns, so they are pushed to
the scan of a stored cell table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.ordered_groups import rank_in_group

COORDINATES = ["row", "family", "qualifier"]
MAP_ENTRIES = 10_000


def row_range(cells: DataFrame, start: str, stop: str) -> DataFrame:
    """All versions of all cells with ``start <= row < stop``."""
    return cells.where((F.col("row") >= start) & (F.col("row") < stop))


def column(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    return cells.where((F.col("family") == family) & (F.col("qualifier") == qualifier))


def row_at_most(cells: DataFrame, row: str) -> DataFrame:
    return cells.where(F.col("row") <= row)


def family_below(cells: DataFrame, family: str) -> DataFrame:
    return cells.where(F.col("family") < family)


def latest(cells: DataFrame) -> DataFrame:
    """Newest version of every cell. A maximum with partial aggregation, no window."""
    newest = F.max(F.struct("ts", "value"))
    return (
        cells.groupBy(*COORDINATES)
        .agg(newest.alias("_newest"))
        .select(*COORDINATES, "_newest.ts", "_newest.value")
    )


def family_map(cells: DataFrame, family: str, entries: int = MAP_ENTRIES) -> DataFrame:
    """Per row a map from qualifier to newest value of one family.

    A row of more than ``entries`` qualifiers has several maps, numbered by ``part`` from 0, in the
    order of the qualifiers: no map, and no task, holds a very wide row whole.
    """
    newest = latest(cells.where(F.col("family") == family))
    numbered = rank_in_group(newest.select("row", "qualifier", "value"), ["row"], ["qualifier"], "_n")
    part = F.expr(f"(_n - 1) div {entries}").alias("part")
    collected = F.collect_list(F.struct("qualifier", "value"))
    return numbered.groupBy("row", part).agg(F.map_from_entries(collected).alias("columns"))


def qualifier_equals(cells: DataFrame, qualifier: str, columns: Sequence[str]) -> DataFrame:
    """Rows having ``qualifier`` in any family, with the named ``family_qualifier`` columns.

    Other qualifiers are filtered out first, so their columns are NULL.
    """
    name = F.concat_ws("_", "family", "qualifier")
    newest = latest(cells.where(F.col("qualifier") == qualifier))
    return newest.groupBy("row").agg(
        *[F.max(F.when(name == wanted, F.col("value"))).alias(wanted) for wanted in columns]
    )


def get_rows(cells: DataFrame, rows: DataFrame, family: str, qualifier: str) -> DataFrame:
    """Newest value of one column for a whole table of row keys."""
    wanted = column(cells, family, qualifier).join(rows.select("row"), "row", "left_semi")
    return latest(wanted)


def get_row(cells: DataFrame, row: str, family: str, qualifier: str) -> DataFrame:
    """Newest value of one column of one row."""
    return latest(column(cells, family, qualifier).where(F.col("row") == row))


def put(cells: DataFrame, written: DataFrame) -> DataFrame:
    """The table after writing cells: earlier versions stay."""
    return cells.unionByName(written)
