"""Session analysis: one filter, five results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from footfall.operators import sessions
from footfall.operators.criteria import Criteria


@dataclass(frozen=True)
class SessionReport:
    aggr_stat: DataFrame
    detail: DataFrame
    top10_category: DataFrame
    top10_session: DataFrame
    random_extract: DataFrame


def session_report(
    actions: DataFrame, users: DataFrame, criteria: Criteria, per_day: int, folder: str
) -> SessionReport:
    """All session results for one set of criteria.

    The passing sessions and their actions feed several results. Both are
    written once below ``folder`` (the detail table is a result anyway), so
    the actions are rolled up and joined once, and a lost executor costs no
    recomputation of either. The statistics are observed while the sessions
    are written: they need no pass of their own.
    """
    counts = sessions.range_counts()
    passing, counted = _stored_and_counted(sessions.session_filter(actions, users, criteria), f"{folder}/passing_sessions", counts)
    detail = _stored(sessions.session_detail(actions, passing), f"{folder}/session_detail")

    top_categories = sessions.top10_category(sessions.category_counts(detail))
    picked = sessions.session_random_extract(passing, per_day)
    return SessionReport(
        aggr_stat=sessions.shares(counted),
        detail=detail,
        top10_category=top_categories,
        top10_session=sessions.top10_session(detail, top_categories),
        random_extract=sessions.extract_report(detail, picked),
    )


def _stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back; its real size then decides how it is joined."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stored_and_counted(df: DataFrame, path: str, counts: list) -> tuple[DataFrame, DataFrame]:
    """Write a table, and take aggregates of it from the same pass, as a frame of one row."""
    seen = Observation()
    written = _stored(df.observe(seen, *counts), path)
    row = seen.get
    return written, df.sparkSession.range(1).select(*[F.lit(value).cast("bigint").alias(name) for name, value in row.items()])
