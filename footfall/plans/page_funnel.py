"""Page flow conversion for a task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from footfall.operators import funnel


def page_funnel(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Conversion rate per step of the flow."""
    return funnel.page_convert_rate(funnel.page_pairs(actions), flow)
