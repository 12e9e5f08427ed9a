"""The windows over dealt parts against a plain computation, with groups that span many parts."""

from collections import defaultdict
from functools import reduce

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.operators import funnel
from footfall.operators.ordered_groups import lag_in_group, rank_in_group, scan_groups
from footfall.sources import fixtures

SCHEMA = "g string, t int, id bigint, v string"


def expected(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    ranks, lags, totals = set(), set(), set()
    for members in groups.values():
        # NULL times come first, as in an ascending sort.
        members.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for i, row in enumerate(members):
            ranks.add((row[2], i + 1))
            lags.add((row[2], members[i - 1][3] if i else None, members[i - 1][2] if i else None))
            upto = members[: i + 1]
            totals.add((row[2], sum(r[1] or 0 for r in upto), reduce(lambda a, r: a ^ r[2], upto, 0)))
    return ranks, lags, totals


def check(spark, data, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(data, SCHEMA)
        ranks, lags, totals = expected(data)
        ranked = rank_in_group(df, ["g"], ["t", "id"], "n")
        assert ranked.columns == [*df.columns, "n"]
        assert {(r.id, r.n) for r in ranked.collect()} == ranks
        lagged = lag_in_group(df, ["g"], ["t", "id"], {"pv": "v", "pid": "id"})
        assert {(r.id, r.pv, r.pid) for r in lagged.collect()} == lags
        summed = scan_groups(df, ["g"], ["t", "id"], running={"s": ("sum", "t"), "x": ("bit_xor", "id")})
        assert {(r.id, r.s, r.x) for r in summed.collect()} == totals
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_hot_group_null_group_and_ties(spark, parts):
    # One group holds a third of the rows, one has no key, and times repeat.
    data = [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"g{i % 20}", (i * 7) % 11, i, f"v{i}") for i in range(600)]
    data += [("hot", None, 1000, None), ("hot", None, 1001, "x")]
    check(spark, data, parts)


def test_one_group_spans_all_parts(spark):
    check(spark, [("only", i // 3, i, f"v{i}") for i in range(500)], 16)


def test_no_rows(spark):
    check(spark, [], 4)


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 5) | st.none()), min_size=1, max_size=60),
    st.integers(1, 9),
)
def test_any_data(spark, drawn, parts):
    check(spark, [(g, t, i, f"v{i}") for i, (g, t) in enumerate(drawn)], parts)


def test_the_dealt_rows_are_shuffled_once(spark, folder):
    """Rows and carried totals must read one and the same shuffle, also if few columns are wanted."""
    pairs = funnel.page_pairs(fixtures.actions(spark, folder)).where("page_id = 3").select("previous_page_id")
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("rangepartitioning(session_id") == 1
    assert "ReusedExchange" in plan
