"""Advertising click statistics over a table of clicks.

Clicks have ``event_id, ts, province, city, user_id, ad_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.group_limits import TRIMMED, nth_in_group

# Fixed value: clicks of one user on one ad in one day that put the user on the blacklist.
BLACKLIST_THRESHOLD = 100


def daily_user_ad_count(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(F.to_date("ts").alias("date"), "user_id", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def blacklist_users(daily: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users that clicked one ad at least ``threshold`` times within a day."""
    return daily.where(F.col("click_count") >= threshold).select("user_id").distinct()


def blacklist_filter(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not on the blacklist."""
    return clicks.join(blacklist.select("user_id"), "user_id", "left_anti")


def crossings(clicks: DataFrame, threshold: int, before: DataFrame | None = None) -> DataFrame:
    """User and time of every click with which a user reaches the threshold on one ad in one day.

    ``before`` holds earlier counts (``date, user_id, ad_id, click_count``) that are added. Up to
    ``TRIMMED`` the rank filter makes Spark trim each group to that many rows per task before the
    shuffle; beyond it a histogram over the minutes of the day finds the border minute. Either way a
    robot's millions of clicks never meet in one task.
    """
    keys = ["date", "user_id", "ad_id"]
    order = ["ts", "event_id"] if "event_id" in clicks.columns else ["ts"]
    rows = clicks.select(F.to_date("ts").alias("date"), "user_id", "ad_id", *order)
    if threshold > TRIMMED:
        if before is not None:
            rows = rows.join(before.select(*keys, F.col("click_count").alias("_earlier")), keys, "left")
        else:
            rows = rows.withColumn("_earlier", F.lit(0))
        wanted = f"{threshold} - coalesce(_earlier, 0)"
        return nth_in_group(rows, keys, order, "hour(ts) * 60 + minute(ts)", wanted).select("user_id", "ts")
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = rows.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= threshold)
    if before is not None:
        ranked = ranked.join(before.select(*keys, F.col("click_count").alias("_earlier")), keys, "left")
        ranked = ranked.withColumn("_n", F.col("_n") + F.coalesce("_earlier", F.lit(0)))
    return ranked.where(F.col("_n") == threshold).select("user_id", "ts")


def before_cutoff(clicks: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Clicks not later than their user's ``cutoff``; all clicks of users without one."""
    limits = cutoffs.select(F.col("user_id").alias("_user"), F.col("cutoff").alias("_cutoff"))
    kept = clicks.join(limits, F.col("user_id") == F.col("_user"), "left").where("_cutoff IS NULL OR ts <= _cutoff")
    return kept.drop("_user", "_cutoff")


def blacklist_cutoff(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Clicks up to the moment their user first reached the threshold, in event time."""
    cutoffs = crossings(clicks, threshold).groupBy("user_id").agg(F.min("ts").alias("cutoff"))
    return before_cutoff(clicks, cutoffs)


def distinct_users(clicks: DataFrame) -> DataFrame:
    return clicks.select("user_id").distinct()


def ad_stat(clicks: DataFrame) -> DataFrame:
    """Clicks per (day, province, city, ad)."""
    return clicks.groupBy(F.to_date("ts").alias("date"), "province", "city", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def province_ad_count(stat: DataFrame) -> DataFrame:
    """City counts added up per (day, province, ad)."""
    return stat.groupBy("date", "province", "ad_id").agg(F.sum("click_count").alias("click_count"))


def province_top3(counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most clicked ads of every day and province."""
    order = Window.partitionBy("date", "province").orderBy(F.desc("click_count"), "ad_id")
    ranked = counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    return ranked.select("date", "province", "ad_id", "click_count")


def minute_columns(minute: Column) -> list[Column]:
    return [
        F.to_date(minute).alias("date"),
        F.date_format(minute, "HH").alias("hour"),
        F.date_format(minute, "mm").alias("minute"),
    ]


def ad_click_trend(clicks: DataFrame) -> DataFrame:
    """Clicks per (minute, ad): the whole trend table."""
    minutes = clicks.groupBy(F.date_trunc("minute", "ts").alias("m"), "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )
    return minutes.select(*minute_columns(F.col("m")), "ad_id", "click_count")


def last_minutes(clicks: DataFrame, as_of: str | None = None, minutes: int = 60) -> DataFrame:
    """Clicks of the ``minutes`` whole minutes that end with the minute of ``as_of``.

    Without ``as_of`` the latest click decides: a maximum over one column.
    """
    latest = F.lit(as_of).cast("timestamp")
    if as_of is None:
        micros = clicks.agg(F.max(F.unix_micros("ts"))).first()[0]
        latest = F.timestamp_micros(F.lit(micros).cast("bigint"))
    end = F.date_trunc("minute", latest) + F.make_dt_interval(mins=F.lit(1))
    start = end - F.make_dt_interval(mins=F.lit(minutes))
    return clicks.where((F.col("ts") >= start) & (F.col("ts") < end))


def sliding_counts(clicks: DataFrame, span: str, slide: str) -> DataFrame:
    """Clicks per ad in every window of length ``span`` that starts each ``slide``.

    ``span`` must be a multiple of ``slide``. Clicks are counted per pane of
    one slide first; only those counts are copied into the windows they belong
    to, so a click is never multiplied by ``span / slide``.
    """
    panes = clicks.groupBy(F.window("ts", slide).alias("pane"), "ad_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    moved = panes.select(F.col("pane.start").alias("pane_start"), "ad_id", "n")
    windows = moved.groupBy(F.window("pane_start", span, slide).alias("w"), "ad_id").agg(
        F.sum("n").alias("click_count")
    )
    return windows.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "ad_id",
        "click_count",
    )


def lookup_click_count(
    wanted: DataFrame, counts: DataFrame, keys: Sequence[str] = ("date", "user_id", "ad_id")
) -> DataFrame:
    """Counts for all wanted keys at once; 0 for a key without one."""
    return wanted.join(counts.select(*keys, "click_count"), list(keys), "left").withColumn(
        "click_count", F.coalesce("click_count", F.lit(0))
    )
