"""First rows of groups by threshold selection against the plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.operators import ads, group_limits, sessions
from tests.conftest import rows


@pytest.fixture(scope="module")
def table(spark):
    # One group holds a third of the rows, half of them in one bucket; one group has no key.
    numbers = spark.range(9000).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN concat('g', id % 200) END AS g", "if(id % 2 = 0, 7, id % 50) AS t"
    )
    return numbers.repartition(5)


@pytest.mark.parametrize("limit", [0, 1, 9, 46, 1600, 10**6])
def test_any_limit(table, limit):
    window = Window.partitionBy("g").orderBy("t", "id")
    plain = table.withColumn("r", F.row_number().over(window))
    got = group_limits.first_in_group(table, ["g"], ["t", "id"], "t", str(limit))
    assert rows(got) == rows(plain.where(F.col("r") <= limit).drop("r"))
    got = group_limits.nth_in_group(table, ["g"], ["t", "id"], "t", str(limit))
    assert rows(got) == rows(plain.where(F.col("r") == limit).drop("r"))


def test_limit_of_its_own_for_every_group(table):
    own = table.withColumn("k", F.coalesce(F.length("g"), F.lit(5)) * 11)
    plain = own.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")))
    got = group_limits.first_in_group(own, ["g"], ["t", "id"], "t", "k")
    assert rows(got) == rows(plain.where("r <= k").drop("r"))


def test_large_threshold_and_large_extract(spark):
    clicks = spark.range(12_000).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id * 7 % 80000 + id % 2 * 86400) AS ts",
        "if(id % 3 = 0, id % 40, 1L) AS user_id", "0L AS ad_id",
    )
    kept = ads.blacklist_cutoff(clicks, 1500)
    day = Window.partitionBy(F.to_date("ts"), "user_id", "ad_id").orderBy("ts", "event_id")
    numbered = clicks.withColumn("n", F.row_number().over(day)).where("n = 1500")
    cutoff = numbered.groupBy("user_id").agg(F.min("ts").alias("c"))
    want = clicks.join(cutoff, "user_id", "left").where("c IS NULL OR ts <= c")
    assert rows(kept.select("event_id")) == rows(want.select("event_id")) and kept.count() < 12_000

    placed = spark.range(21_600).selectExpr("concat('s', id) AS session_id", "timestamp_seconds(1704067200 + id % 7200) AS start_time")
    got = sessions.session_random_extract(placed, 5000)
    order = Window.partitionBy(F.hour("start_time")).orderBy(F.md5("session_id"))
    want = placed.withColumn("r", F.row_number().over(order)).where("r <= 2500").drop("r")
    assert got.count() == 5000 and rows(got.select("session_id")) == rows(want.select("session_id"))


def test_only_the_border_is_sorted(table):
    """The rows before the border leave without a window over the group."""
    plan = group_limits.first_in_group(table, ["g"], ["t", "id"], "t", "1600")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert not [w for w in windows if "row_number() windowspecdefinition(g#" in w and "_part" not in w], windows
