"""Replay a table of clicks as log files that arrive one time slice after another.

After each arrival the query is started from its checkpoint, works off what is
new (``availableNow``) and stops: the schedule of an incremental job, and a
restart per slice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.session import for_streams, scratch
from footfall.sources import ad_log
from footfall.sources.readers import file_lines

AVAILABLE_NOW = {"availableNow": True}
TIMEOUT_SECONDS = 3600


def slices(clicks: DataFrame, parts: int) -> list[DataFrame]:
    """Equal time slices: slice i has ``(ts - first) div width = i``."""
    micros = F.unix_micros("ts")
    first, last = clicks.agg(F.min(micros), F.max(micros)).first()
    width = (last - first) // parts + 1

    def bound(i: int):
        return F.timestamp_micros(F.lit(first + i * width))

    return [
        clicks.where((F.col("ts") >= bound(i)) & (F.col("ts") < bound(i + 1)))
        for i in range(parts)
    ]


def replay(
    clicks: DataFrame,
    start: Callable[[DataFrame], StreamingQuery],
    order: Sequence[int] = (0, 1, 2, 3),
) -> None:
    """Write the slices in the given order and run the query after each one.

    The lines are the column ``value``, where there is one, else made from the clicks.
    """
    spark = clicks.sparkSession
    streams = for_streams(spark)
    inbox = scratch(spark, "inbox")
    parts = slices(clicks, len(order))
    for i in order:
        lines = parts[i].select("value") if "value" in parts[i].columns else ad_log.lines(parts[i])
        lines.write.text(f"{inbox}/slice-{i}")
        query = start(file_lines(streams, f"{inbox}/*"))
        if not query.awaitTermination(TIMEOUT_SECONDS):
            query.stop()
            raise TimeoutError("the streaming query did not finish")
