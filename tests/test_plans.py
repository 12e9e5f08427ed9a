"""What the physical plans must and must not contain."""

import contextlib
import io

import pytest

from footfall.registry.queries import queries
from tests.conftest import SMALL

QUERIES = queries()
BATCH = [name for name in QUERIES if not name.startswith("stream_")]


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


@pytest.mark.parametrize(
    "name", ["area_top3", "province_top3", "top10_session", "session_random_extract", "blacklist_cutoff", "pipeline_area_top3"]
)
def test_top_lists_are_trimmed_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(QUERIES[name](spark, SMALL))


def test_global_top_list_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top10_category"](spark, SMALL))


def test_date_range_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["scan_clicks_by_date"](spark, SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in text
    assert "LessThan(ts,2024-01-21T00:00)" in text
    text = plan(QUERIES["pipeline_area_top3"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text


def test_user_criteria_are_applied_below_the_join(spark):
    text = plan(QUERIES["session_filter"](spark, SMALL))
    scan = next(part for part in text.split("\n\n") if "customer.parquet" in part)
    assert "c_mktsegment" in scan and "PushedFilters" in scan


def test_clicks_are_counted_before_cities_are_joined(spark):
    tree = plan(QUERIES["area_product_count"](spark, SMALL)).split("\n\n")[0]
    lines = tree.splitlines()
    city_join = next(i for i, line in enumerate(lines) if "Join" in line)
    partial = next(i for i, line in enumerate(lines) if "HashAggregate" in line and "Object" not in line)
    assert city_join < partial
