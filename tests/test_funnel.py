from datetime import datetime, timedelta

import pytest

from footfall.operators import funnel
from tests.conftest import rows


def visits(spark, *sessions):
    start, data = datetime(2024, 1, 1), []
    for number, pages in enumerate(sessions):
        for step, page in enumerate(pages):
            data.append((f"s{number}", start + timedelta(seconds=step), len(data), page))
    return spark.createDataFrame(data, "session_id string, action_time timestamp, event_id bigint, page_id bigint")


def test_rates(spark):
    pairs = funnel.page_pairs(visits(spark, [3, 5, 2, 3, 5]))
    assert rows(funnel.page_split_pv(pairs, [3, 5, 2])) == [(1, "3_5", 2), (2, "5_2", 1)]
    assert funnel.start_page_pv(pairs, [3, 5, 2]).first()[0] == 2
    rates = funnel.page_convert_rate(pairs, [3, 5, 2])
    assert rows(rates) == [(1, "3_5", 1.0), (2, "5_2", 0.5)]
    assert funnel.page_convert_rate_string(rates).first()[0] == "3_5=1.0|5_2=0.5"


def test_missing_step_and_missing_start(spark):
    pairs = funnel.page_pairs(visits(spark, [3, 5], [1]))
    assert rows(funnel.page_convert_rate(pairs, [3, 4, 5])) == [(1, "3_4", 0.0), (2, "4_5", None)]
    string = funnel.page_convert_rate_string(funnel.page_convert_rate(pairs, [9, 3, 5]))
    assert string.first()[0] == "9_3=null|3_5=null"


def test_repeated_pair_keeps_its_steps(spark):
    pairs = funnel.page_pairs(visits(spark, [1, 2, 1, 2]))
    assert rows(funnel.page_split_pv(pairs, [1, 2, 1, 2])) == [(1, "1_2", 2), (2, "2_1", 1), (3, "1_2", 2)]


def test_pairs_stay_inside_a_session_and_ties_follow_event_id(spark):
    moment = datetime(2024, 1, 1)
    data = [("a", moment, 2, 20), ("a", moment, 1, 10), ("b", moment, 3, 30)]
    df = spark.createDataFrame(data, "session_id string, action_time timestamp, event_id bigint, page_id bigint")
    got = {r.event_id: r.previous_page_id for r in funnel.page_pairs(df).collect()}
    assert got == {1: None, 2: 10, 3: None}


def test_short_flow_is_an_error(spark):
    with pytest.raises(ValueError):
        funnel.page_split_pv(funnel.page_pairs(visits(spark, [1])), [1])
