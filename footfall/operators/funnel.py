"""Page flow conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.numbers import ratio2
from footfall.operators.ordered_groups import lag_in_group


def page_pairs(actions: DataFrame) -> DataFrame:
    """Every action with the page its session showed just before (NULL for the first)."""
    narrow = actions.select("session_id", "action_time", "event_id", "page_id")
    order = ["action_time", "event_id"]
    return lag_in_group(narrow, ["session_id"], order, {"previous_page_id": "page_id"})


def page_split_pv(pairs: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Views per step of the flow, in long form; a step that never occurs has 0.

    The flow is a short parameter, so each step is one conditional count of a
    single global aggregate: one pass, one row per task shuffled.
    """
    counts = _flow_counts(pairs, flow)
    return _by_step(counts, flow, [f"pv_{i}" for i in range(1, len(flow))], "pv")


def start_page_pv(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Number of actions on the first page of the flow."""
    return actions.agg(F.count_if(F.col("page_id") == flow[0]).alias("start_page_pv"))


def page_convert_rate(pairs: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Per step: its views divided by those of the step before it.

    The first step is divided by the views of the first page. The rate is NULL
    when the divisor is 0.
    """
    steps = range(1, len(flow))
    rates = _flow_counts(pairs, flow).select(
        *[ratio2(f"pv_{i}", f"pv_{i - 1}").alias(f"rate_{i}") for i in steps]
    )
    return _by_step(rates, flow, [f"rate_{i}" for i in steps], "convert_rate")


def page_convert_rate_string(rates: DataFrame) -> DataFrame:
    """All rates in one text ``1_2=0.35|2_3=0.5``, in step order; a NULL rate reads ``null``."""
    steps = F.array_sort(F.collect_list(F.struct("step", "page_split", "convert_rate")))
    entry = F.transform(
        steps,
        lambda s: F.concat(
            s["page_split"], F.lit("="), F.coalesce(s["convert_rate"].cast("string"), F.lit("null"))
        ),
    )
    return rates.agg(F.array_join(entry, "|").alias("convert_rate"))


def _flow_counts(pairs: DataFrame, flow: Sequence[int]) -> DataFrame:
    """``pv_0``: views of the first page; ``pv_i``: views of step i."""
    if len(flow) < 2:
        raise ValueError("a page flow needs at least two pages")
    steps = [
        f"previous_page_id = {int(before)} AND page_id = {int(after)}"
        for before, after in zip(flow, flow[1:])
    ]
    conditions = [f"page_id = {int(flow[0])}", *steps]
    return pairs.agg(
        *[F.expr(f"count_if({condition})").alias(f"pv_{i}") for i, condition in enumerate(conditions)]
    )


def _by_step(wide: DataFrame, flow: Sequence[int], columns: list[str], name: str) -> DataFrame:
    """One row per step from one column per step."""
    steps = [
        f"{i}L, '{before}_{after}', {column}"
        for i, (before, after, column) in enumerate(zip(flow, flow[1:], columns), start=1)
    ]
    return wide.selectExpr(f"stack({len(steps)}, {', '.join(steps)}) AS (step, page_split, {name})")
