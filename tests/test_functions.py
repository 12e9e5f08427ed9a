import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.functions import json_fields, labels, numbers, records, salting, sql_functions, text, times


def values(spark, data, schema, *columns):
    return [tuple(row) for row in spark.createDataFrame(data, schema).select(*columns).collect()]


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    "part, whole, expected",
    [(29, 200, 0.15), (1, 8, 0.13), (1, 3, 0.33), (0, 5, 0.0), (1, 0, None), (7, 7, 1.0), (3, 40, 0.08)],
)
def test_ratio2(spark, part, whole, expected):
    got = values(spark, [(part, whole)], "p bigint, w bigint", numbers.ratio2("p", "w"))
    assert got == [(expected,)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=1, max_size=50))
def test_ratio2_is_exact_half_up(spark, pairs):
    got = values(spark, pairs, "p bigint, w bigint", "p", "w", numbers.ratio2("p", "w"))
    for part, whole, ratio in got:
        hundredths = round(ratio * 100)
        # half-up: hundredths - 1/2 <= 100 * part / whole < hundredths + 1/2
        assert (2 * hundredths - 1) * whole <= 200 * part < (2 * hundredths + 1) * whole


def test_text(spark):
    data = [(None,), ("",), ("a",), (",a,b,",), (",,x,,",), ("7",), ("07",), ("123",)]
    got = values(
        spark, data, "t string", text.is_empty(F.col("t")), text.trim_comma(F.col("t")), text.pad2(F.col("t"))
    )
    assert [row[0] for row in got] == [True, True] + [False] * 6
    assert [row[1] for row in got] == [None, "", "a", "a,b", ",x,", "7", "07", "123"]
    assert [row[2] for row in got][2:] == ["0a", "0,a,b,", "0,,x,,", "07", "07", "0123"]
    listed = values(
        spark, [(None,), ("",), ("1,2",), (",3,x,",)], "t string", text.id_list(F.col("t"))
    )
    assert listed == [([],), ([],), ([1, 2],), ([3],)]
    named = values(spark, [(1, "A"), (None, "A"), (1, None)], "i bigint, n string", text.id_name(F.col("i"), F.col("n")))
    assert named == [("1:A",), (None,), (None,)]


RECORD = "a=1|b=|c=3"


@pytest.mark.parametrize(
    "record, field, expected",
    [
        (RECORD, "a", "1"),
        (RECORD, "b", None),
        (RECORD, "c", "3"),
        (RECORD, "d", None),
        ("a=1=2|a=5", "a", "5"),
        ("a=1=", "a", "1"),
        ("aa=1|a=2", "a", "2"),
        ("x=a=1", "a", None),
        ("a=1|a=2", "a", "1"),
        (None, "a", None),
        ("a.b=1", "a.b", "1"),
        ("acb=1", "a.b", None),
    ],
)
def test_record_get(spark, record, field, expected):
    assert values(spark, [(record,)], "r string", records.record_get(F.col("r"), field)) == [(expected,)]


@pytest.mark.parametrize(
    "record, field, expected",
    [
        (RECORD, "c", "a=1|b=|c=$4"),
        (RECORD, "a", "a=$4|b=|c=3"),
        (RECORD, "b", "a=1|b=$4|c=3"),
        (RECORD, "d", RECORD),
        ("a=1|a=2", "a", "a=$4|a=2"),
        ("aa=1|a=2", "a", "aa=1|a=$4"),
        ("a|b=2", "a", "a=$4|b=2"),
        ("b=2|a", "a", "b=2|a=$4"),
        ("a|a=1", "a", "a=$4|a=1"),
    ],
)
def test_record_set(spark, record, field, expected):
    got = values(spark, [(record,)], "r string", records.record_set(F.col("r"), field, F.lit("$4")))
    assert got == [(expected,)]


def test_key_part(spark):
    got = values(spark, [("20240101_7_3",)], "k string", *[records.key_part(F.col("k"), i) for i in (1, 2, 3, 4)])
    assert got == [("20240101", "7", "3", None)]


def test_times(spark):
    early, late, bad = F.lit("2024-01-01 5:03:07"), F.lit("2024-01-01 15:03:08"), F.lit("soon")
    got = one(
        spark,
        times.is_before(early, late),
        times.is_after(early, late),
        times.is_before(bad, late),
        times.minus_seconds(late, early),
        times.minus_seconds(late, bad),
        times.format_time(times.parse_time(early)),
        times.hour_key(times.parse_time(early)),
        times.date_key(times.parse_time(early)),
        times.minute_key(times.parse_time(early)),
        times.format_date(times.parse_date_key(F.lit("20240229"))),
        times.parse_date_key(F.lit("2024x")),
        times.parse_date(F.lit("2024-02-30")),
    )
    assert got == (
        True, False, False, 36001, 0, "2024-01-01 05:03:07", "2024-01-01_05", "20240101", "202401010503",
        "2024-02-29", None, None,
    )
    now = F.lit("2024-03-01 00:30:00").cast("timestamp")
    assert one(spark, times.today(now), times.yesterday(now)) == ("2024-03-01", "2024-02-29")


def test_json(spark):
    data = [('{"product_status": 0}',), ('{"product_status": 1}',), ("broken",), (None,), ("{}",)]
    got = values(
        spark, data, "j string", json_fields.json_field(F.col("j"), "product_status"), labels.product_status(F.col("j"))
    )
    assert got == [("0", "Self"), ("1", "Third Party")] + [(None, "Third Party")] * 3
    items = F.lit('[{"name": "x", "score": 80}, {"name": "y"}]')
    assert one(spark, json_fields.json_item_field(items, 0, "score"), json_fields.json_item_field(items, 1, "score")) == ("80", None)


def test_bucket_edges(spark):
    lengths = [0, 1, 3, 4, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    got = values(spark, [(n,) for n in lengths], "n bigint", labels.visit_bucket("n"))
    assert [row[0] for row in got] == [
        None, "1s_3s", "1s_3s", "4s_6s", "7s_9s", "10s_30s", "10s_30s", "30s_60s", "30s_60s", "1m_3m",
        "1m_3m", "3m_10m", "3m_10m", "10m_30m", "10m_30m", "30m",
    ]
    steps = [1, 3, 4, 9, 10, 30, 31, 60, 61]
    got = values(spark, [(n,) for n in steps], "n bigint", labels.step_bucket("n"))
    assert [row[0] for row in got] == ["1_3", "1_3", "4_6", "7_9", "10_30", "10_30", "30_60", "30_60", "60"]


def test_grades_and_levels(spark):
    got = values(spark, [(85,), (90,), (60,), (73,), (59,)], "g int", labels.grade(F.col("g")), labels.good_or_bad(F.col("g")))
    assert got == [("B", "GOOD"), ("A", "GOOD"), ("D", "BAD"), ("C", "BAD"), ("E", "BAD")]
    got = values(spark, [("China East",), ("West South",), ("Moon",), (None,)], "a string", labels.area_level(F.col("a")))
    assert got == [("A Level",), ("C Level",), ("D Level",), ("D Level",)]
    assert one(spark, labels.area_level(F.lit("Moon"), {"Moon": "M"})) == ("M",)


def test_salt_round_trip(spark):
    df = spark.range(100).withColumn("key", F.lit("1_a_b"))
    salted = df.withColumn("s", salting.add_prefix(F.col("key"), salting.salt_of(F.col("id"), 8)))
    assert salted.select("s").distinct().count() == 8
    assert salted.select(salting.strip_prefix(F.col("s"))).distinct().collect()[0][0] == "1_a_b"


def test_sql_functions(spark):
    sql_functions.register(spark)
    got = spark.sql(
        """SELECT concat_long_string(7, 'x', ':') AS a, json_field('{"f": 0}', 'f') AS b,
        strip_prefix(add_prefix('1_k', 5, 10)) AS c, trim_comma(',a,') AS d, pad2('7') AS e,
        ratio2(29, 200) AS f, ratio2(1, 0) AS g"""
    ).first()
    assert tuple(got) == ("7:x", "0", "1_k", "a", "07", 0.15, None)
