from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from footfall.operators import criteria, sessions
from footfall.operators.criteria import Criteria
from tests.conftest import rows

START = datetime(2024, 1, 1, 10, 0, 0)
ACTIONS = """event_id bigint, user_id bigint, session_id string, page_id bigint, action_time timestamp,
 search_keyword string, click_category_id bigint, order_category_ids string, pay_category_ids string"""


def action(event_id, session, seconds, keyword=None, category=None, orders=None, pays=None, user=1):
    return (event_id, user, session, 1, START + timedelta(seconds=seconds), keyword, category, orders, pays)


@pytest.fixture
def actions(spark):
    return spark.createDataFrame(
        [
            action(1, "s1", 0, "hotpot", 21),
            action(2, "s1", 5, "pot", 1),
            action(3, "s1", 9, "", 21),
            action(4, "s2", 100, user=2),
            action(5, "s3", 0, "pot", None, "1,2", "2", user=2),
            action(6, "s3", 61, None, 1, ",2,", None, user=2),
        ],
        ACTIONS,
    )


@pytest.fixture
def users(spark):
    return spark.createDataFrame(
        [(1, 30, "it", "city1", "male"), (2, 41, "law", "city2", "female"), (3, 50, "it", "city1", None)],
        "user_id bigint, age int, professional string, city string, sex string",
    )


def test_rollup_keeps_values_that_contain_one_another(actions):
    got = {r.session_id: r for r in sessions.session_rollup(actions).collect()}
    assert got["s1"].search_keywords == ["hotpot", "pot"]
    assert got["s1"].click_category_ids == [1, 21]
    assert (got["s1"].visit_length, got["s1"].step_length, got["s1"].start_time) == (9, 3, START)
    assert (got["s2"].search_keywords, got["s2"].visit_length, got["s2"].step_length) == ([], 0, 1)


def test_measures_agree_with_lists(actions):
    wanted = Criteria(keywords=["pot"], category_ids=[1])
    by_flag = sessions.session_measures(actions, wanted).select("session_id")
    rolled = sessions.session_rollup(actions)
    by_list = rolled.where(
        criteria.list_in_any(F.col("search_keywords"), ["pot"])
        & criteria.list_in_any(F.col("click_category_ids"), [1])
    ).select("session_id")
    assert rows(by_flag) == rows(by_list) == [("s1",), ("s3",)]


def test_absent_parameter_passes_and_absent_data_fails(actions, users):
    everything = sessions.session_filter(actions, users, Criteria())
    assert everything.count() == 3
    assert sessions.session_filter(actions, users, Criteria(start_age=99)).count() == 3
    assert sessions.session_filter(actions, users, Criteria(start_age=30, end_age=40)).count() == 1
    assert sessions.session_filter(actions, users, Criteria(keywords=["none"])).count() == 0
    kept = users.where(criteria.equals(F.col("sex"), "male"))
    assert rows(kept.select("user_id")) == [(1,)]
    assert users.where(criteria.equals(F.col("sex"), None)).count() == 3


def test_zero_length_session_is_counted_but_in_no_length_range(actions, users):
    stat = sessions.session_aggr_stat(sessions.session_filter(actions, users, Criteria())).first()
    assert stat.session_count == 3
    lengths = [stat[c] for c in stat.__fields__ if c.startswith("visit_length")]
    assert sorted(lengths)[-2:] == [0.33, 0.33] and sum(v > 0 for v in lengths) == 2
    assert stat.step_length_1_3_ratio == 1.0


def test_no_session_gives_null_ratios(actions, users):
    none = sessions.session_filter(actions, users, Criteria(keywords=["none"]))
    stat = sessions.session_aggr_stat(none).first()
    assert stat.session_count == 0 and stat.step_length_1_3_ratio is None


def test_category_counts_and_top(actions):
    counts = sessions.category_counts(actions)
    assert rows(counts) == [(1, 2, 1, 0), (2, 0, 2, 1), (21, 2, 0, 0)]
    top = sessions.top10_category(counts, 2)
    assert [r.category_id for r in top.collect()] == [1, 21]
    assert rows(sessions.top10_session(actions, top, 1)) == [(1, "s1", 1), (21, "s1", 2)]


def test_extract_quota_and_whole_small_day(spark):
    hours = [0] * 60 + [1] * 30 + [2] * 10
    data = [(f"s{i}", START.replace(hour=h)) for i, h in enumerate(hours)]
    data += [("lonely", datetime(2024, 1, 2, 5))]
    df = spark.createDataFrame(data, "session_id string, start_time timestamp")
    picked = sessions.session_random_extract(df, 10)
    assert rows(picked.groupBy("date", "hour").count().select("hour", "count")) == [(0, 6), (1, 3), (2, 1), (5, 1)]
    assert rows(picked) == rows(sessions.session_random_extract(df, 10))


def test_rollup_collects_from_distinct_values_only(spark):
    """A session of very many actions reaches the collecting stage as few rows."""
    many = spark.range(60_000).selectExpr(
        "id AS event_id", "id % 9 AS user_id", "if(id % 3 = 0, 'hot', concat('s', id % 500)) AS session_id", "1L AS page_id",
        "timestamp_seconds(1704067200 + id) AS action_time", "concat('kw', id % 4) AS search_keyword", "id % 5 AS click_category_id",
    )
    rolled = sessions.session_rollup(many)
    hot = rolled.where("session_id = 'hot'").first()
    assert (hot.step_length, hot.user_id, hot.click_category_ids) == (20_000, 0, [0, 1, 2, 3, 4])
    plan = rolled._jdf.queryExecution().optimizedPlan().toString().splitlines()
    collecting = next(i for i, line in enumerate(plan) if "collect_set" in line)
    assert any("Aggregate [session_id" in line and "keyword" in line for line in plan[collecting + 1 :])
