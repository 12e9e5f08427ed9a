from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from footfall.operators import ads, catalogue, cells, merges, products
from tests.conftest import rows

CLICKS = "event_id bigint, ts timestamp, province string, city string, user_id bigint, ad_id bigint"
NOON = datetime(2024, 1, 1, 12)


def click(event_id, seconds, user, ad, province="P"):
    return (event_id, NOON + timedelta(seconds=seconds), province, f"{province}-1", user, ad)


def test_cutoff_against_brute_force_with_a_robot(spark):
    # User 0 makes a third of all clicks, all on one ad.
    data = [click(i, i // 2, 0 if i % 3 == 0 else i % 7, 0 if i % 3 == 0 else i % 4) for i in range(300)]
    counts, cutoff = Counter(), {}
    for event_id, ts, _, _, user, ad in sorted(data, key=lambda r: (r[1], r[0])):
        counts[ts.date(), user, ad] += 1
        if counts[ts.date(), user, ad] == 10:
            cutoff.setdefault(user, ts)
    kept = {r[0] for r in data if r[4] not in cutoff or r[1] <= cutoff[r[4]]}
    got = ads.blacklist_cutoff(spark.createDataFrame(data, CLICKS), 10)
    assert {r.event_id for r in got.collect()} == kept
    assert got.count() < len(data)


def test_threshold_is_per_day_and_ad(spark):
    data = [click(1, 0, 1, 1), click(2, 1, 1, 1), click(3, 2, 1, 2), click(4, 86400, 1, 1), click(5, 0, 2, 1)]
    df = spark.createDataFrame(data, CLICKS)
    daily = ads.daily_user_ad_count(df)
    assert rows(ads.blacklist_users(daily, 2)) == [(1,)]
    assert ads.blacklist_users(daily, 3).count() == 0
    kept = ads.blacklist_filter(df, ads.blacklist_users(daily, 2))
    assert rows(kept.select("event_id")) == [(5,)]


def test_sliding_counts_against_brute_force(spark):
    data = [click(i, i * 97, 1, i % 2) for i in range(80)]
    want = Counter()
    for _, ts, _, _, _, ad in data:
        seconds = int((ts - datetime(2024, 1, 1)).total_seconds())
        last = seconds // 600 * 600
        for start in range(last - 3000, last + 1, 600):
            want[datetime(2024, 1, 1) + timedelta(seconds=start), ad] += 1
    got = ads.sliding_counts(spark.createDataFrame(data, CLICKS), "60 minutes", "10 minutes")
    assert {(r.window_start, r.ad_id): r.click_count for r in got.collect()} == dict(want)


def test_last_hour_is_sixty_whole_minutes(spark):
    data = [click(1, -3600, 1, 1), click(2, -3541, 1, 1), click(3, -3540, 1, 1), click(4, 59, 1, 1), click(5, 60, 1, 1)]
    df = spark.createDataFrame(data, CLICKS)
    kept = ads.last_minutes(df, "2024-01-01 12:00:30")
    assert rows(kept.select("event_id")) == [(3,), (4,)]
    assert rows(ads.last_minutes(df, minutes=2).select("event_id")) == [(4,), (5,)]
    assert ads.last_minutes(df.where("event_id > 9")).count() == 0
    trend = ads.ad_click_trend(kept)
    assert [(str(r.date), r.hour, r.minute, r.click_count) for r in trend.orderBy("hour").collect()] == [
        ("2024-01-01", "11", "01", 1),
        ("2024-01-01", "12", "00", 1),
    ]


def test_province_counts_add_cities_and_rank_per_day(spark):
    stat = spark.createDataFrame(
        [("2024-01-01", "P", c, a, n) for c, a, n in [("x", 1, 5), ("y", 1, 5), ("x", 2, 9), ("x", 3, 9), ("x", 4, 1)]]
        + [("2024-01-02", "P", "x", 4, 1)],
        "date string, province string, city string, ad_id bigint, click_count bigint",
    )
    top = ads.province_top3(ads.province_ad_count(stat))
    assert rows(top) == [
        ("2024-01-01", "P", 1, 10), ("2024-01-01", "P", 2, 9), ("2024-01-01", "P", 3, 9), ("2024-01-02", "P", 4, 1),
    ]


def test_lookup_defaults_to_zero(spark):
    counts = spark.createDataFrame([("d", 1, 1, 7)], "date string, user_id bigint, ad_id bigint, click_count bigint")
    wanted = spark.createDataFrame([("d", 1, 1), ("d", 2, 1)], "date string, user_id bigint, ad_id bigint")
    assert rows(ads.lookup_click_count(wanted, counts)) == [("d", 1, 1, 7), ("d", 2, 1, 0)]


# --- merges ----------------------------------------------------------------------------

KV = "k string, click_count bigint"


def test_merges(spark):
    old = spark.createDataFrame([("a", 5), ("b", 7), (None, 1)], KV)
    new = spark.createDataFrame([("b", 2), ("c", 3), (None, 4)], KV)
    assert rows(merges.upsert_replace(old, new, ["k"])) == rows(
        spark.createDataFrame([("a", 5), ("b", 2), ("c", 3), (None, 4)], KV)
    )
    assert rows(merges.upsert_increment(old, new, ["k"])) == rows(
        spark.createDataFrame([("a", 5), ("b", 9), ("c", 3), (None, 5)], KV)
    )
    # Replacing twice changes nothing: a replayed batch is harmless.
    once = merges.upsert_replace(old, new, ["k"])
    assert rows(merges.upsert_replace(once, new, ["k"])) == rows(once)


def test_replace_group(spark):
    schema = "date string, province string, ad_id bigint"
    old = spark.createDataFrame([("d", "P", 1), ("d", "P", 2), ("d", "Q", 3)], schema)
    new = spark.createDataFrame([("d", "P", 9)], schema)
    assert rows(merges.replace_group(old, new, ["date", "province"])) == [("d", "P", 9), ("d", "Q", 3)]


# --- products --------------------------------------------------------------------------


def test_city_list_is_distinct_sorted_by_number_and_keeps_lookalikes(spark):
    clicks = spark.createDataFrame([(11, 5), (1, 5), (1, 5), (2, 6), (99, 5)], "city_id bigint, product_id bigint")
    cities = spark.createDataFrame([(1, "A", "N"), (11, "A", "N"), (2, "B", "N")], "city_id bigint, city_name string, area string")
    assert rows(products.area_product_count(clicks, cities)) == [("N", 5, 3, "1:A,11:A"), ("N", 6, 1, "2:B")]
    joined = products.join_click_city(clicks, cities)
    assert joined.count() == 4
    listed = products.group_concat_distinct(joined, ["area"], F.col("city_id"), F.col("city_name"), "names")
    assert rows(listed) == [("N", "A,B,A")]


def test_top3_ties_by_product_and_unknown_product_is_dropped(spark):
    counts = spark.createDataFrame([("N", p, n) for p, n in [(1, 5), (2, 5), (3, 5), (4, 5), (5, 9)]], "area string, product_id bigint, click_count bigint")
    info = spark.createDataFrame([(p, f"p{p}", '{"product_status": 0}') for p in (1, 2, 3, 4)], "product_id bigint, product_name string, extend_info string")
    top = products.area_top3(products.join_product_info(counts, info))
    assert rows(top.select("product_id", "product_status", "area_level")) == [(p, "Self", "D Level") for p in (1, 2, 3)]


@pytest.mark.parametrize("salts", [1, 7, 64])
def test_salted_count_equals_plain_count(spark, salts):
    df = spark.range(1000).withColumn("key", F.expr("CASE WHEN id % 3 = 0 THEN '1_hot' ELSE concat('k_', id % 50) END"))
    want = df.groupBy("key").count()
    assert rows(products.salted_count(df, "key", "id", salts)) == rows(want)


# --- cells -----------------------------------------------------------------------------


@pytest.fixture
def table(spark):
    data = [
        ("r1", "f1", "name", 1, "old"), ("r1", "f1", "name", 2, "new"), ("r1", "f1", "id", 1, "7"),
        ("r1", "f2", "id", 1, "8"), ("r2", "f1", "name", 1, "two"), ("r3", "f2", "name", 1, "three"),
    ]
    return spark.createDataFrame(data, "row string, family string, qualifier string, ts bigint, value string")


def test_cell_scans(spark, table):
    assert cells.row_range(table, "r1", "r2").count() == 4
    assert rows(cells.row_at_most(table, "r2").select("row").distinct()) == [("r1",), ("r2",)]
    assert cells.family_below(table, "f2").count() == 4
    maps = {r.row: r["columns"] for r in cells.family_map(table, "f1").collect()}
    assert maps == {"r1": {"name": "new", "id": "7"}, "r2": {"name": "two"}}
    wide = cells.qualifier_equals(table, "id", ["f1_id", "f2_id", "f2_name"])
    assert rows(wide) == [("r1", "7", "8", None)]
    assert cells.get_row(table, "r1", "f1", "name").first().value == "new"
    assert cells.get_row(table, "r9", "f1", "name").count() == 0
    wanted = spark.createDataFrame([("r1",), ("r2",), ("r2",)], "row string")
    assert rows(cells.get_rows(table, wanted, "f1", "name").select("row", "value")) == [("r1", "new"), ("r2", "two")]


def test_a_wide_row_has_several_maps(spark):
    wide = spark.range(250).selectExpr("if(id % 5 = 4, 'small', 'wide') AS row", "'f1' AS family", "concat('q', lpad(id, 3, '0')) AS qualifier", "1L AS ts", "string(id) AS value")
    maps = cells.family_map(wide, "f1", 60).collect()
    assert sorted((r.row, r.part, len(r["columns"])) for r in maps) == [("small", 0, 50), ("wide", 0, 60), ("wide", 1, 60), ("wide", 2, 60), ("wide", 3, 20)]
    parts = {r.part: r["columns"] for r in maps if r.row == "wide"}
    assert max(parts[0]) < min(parts[1]) and parts[1][min(parts[1])] == str(int(min(parts[1])[1:]))


def test_put_adds_a_version(spark, table):
    written = spark.createDataFrame([("r1", "f1", "name", 3, "newest"), ("r9", "f1", "id", 1, "9")], table.schema)
    after = cells.put(table, written)
    assert after.count() == 8
    assert cells.get_row(after, "r1", "f1", "name").first().value == "newest"
    assert cells.latest(after).count() == 6


# --- catalogue -------------------------------------------------------------------------


def test_rank_in_brand(spark):
    parts = spark.createDataFrame([(1, "c1", 980.0), (2, "c1", 975.0), (3, "c1", 990.0), (4, "c1", 960.0)], "p_partkey bigint, p_brand string, p_retailprice double")
    got = {r.part_id: (r.rank_in_brand, r.grade, r.verdict) for r in catalogue.price_grade(parts).collect()}
    assert got == {1: (2, "B", "GOOD"), 2: (3, "C", "BAD"), 3: (1, "A", "GOOD"), 4: (4, "D", "BAD")}


def test_surcharge(spark):
    items = spark.createDataFrame([("A", 30.0, p) for p in (10.0, 20.0, 30.0)] + [("A", 25.0, 99.0)], "l_returnflag string, l_quantity double, l_extendedprice double")
    assert rows(catalogue.quantity_surcharge(items)) == [("A", 63.0, 3)]


def test_segment_slice(spark):
    people = [("12", 0), ("13", 2), ("11", 1), ("18", 1), ("18", 0), ("18", 2), ("18", 2), ("x", 1), ("9", 0), ("100", 0)]
    users = spark.createDataFrame([("Java", a, s) for a, s in people] + [("Go", "50", 1)], "professional string, age_text string, sex int")
    got = [tuple(r) for r in catalogue.segment_slice(users, "J", 12).collect()]
    assert got == [("100", 0), ("13", 2), ("18", 0), ("18", 1), ("18", 2)]
