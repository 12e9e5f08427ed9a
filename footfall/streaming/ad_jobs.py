"""The real-time ad statistics as Structured Streaming queries.

All jobs read click lines (Kafka or files), aggregate in event time with a
watermark, and write through ``foreachBatch`` into batch logs. State expires
with the watermark. Aggregations run in update mode: a batch writes only the
keys it changed, with their absolute counts.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.operators import ads
from footfall.sinks import batch_log
from footfall.sources import ad_log

AD_STAT = "date DATE, province STRING, city STRING, ad_id BIGINT, click_count BIGINT"
AD_STAT_KEYS = ["date", "province", "city", "ad_id"]
PROVINCE = "date DATE, province STRING, ad_id BIGINT, click_count BIGINT"
PROVINCE_KEYS = ["date", "province", "ad_id"]
TREND = "date DATE, hour STRING, minute STRING, ad_id BIGINT, click_count BIGINT"
TREND_KEYS = ["date", "hour", "minute", "ad_id"]
BLACKLIST = "user_id BIGINT"
CLICKS = "province STRING, city STRING, user_id BIGINT, ad_id BIGINT, ts TIMESTAMP"

WATERMARK = "1 hour"
# Fixed value: the interval of a continuously running job.
EVERY_FIVE_SECONDS = {"processingTime": "5 seconds"}

# Batches between two that carry earlier rows over: bounds what a batch reads back.
FOLD_EVERY = 100

OnBatch = Callable[[DataFrame, int], None]


def _start(
    changed: DataFrame, on_batch: OnBatch, checkpoint: str, mode: str, trigger: dict
) -> StreamingQuery:
    return (
        changed.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
        .trigger(**trigger)
        .start()
    )


def _counts(lines: DataFrame, length: str, keys: list[str], watermark: str) -> DataFrame:
    """Running counts per tumbling window and keys, as ``start`` plus the keys."""
    clicks = ad_log.clicks(lines).withWatermark("ts", watermark)
    counted = clicks.groupBy(F.window("ts", length).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("click_count")
    )
    return counted.select(F.col("w.start").alias("start"), *keys, "click_count")


def _day(start: Column) -> Column:
    return F.to_date(start).alias("date")


def start_ad_stat(
    lines: DataFrame, out: str, checkpoint: str, trigger: dict, watermark: str = WATERMARK
) -> StreamingQuery:
    """Running counts per (day, province, city, ad)."""
    keys = ["province", "city", "ad_id"]
    counts = _counts(lines, "1 day", keys, watermark).select(_day(F.col("start")), *keys, "click_count")
    batch_log.open_log(lines.sparkSession, out, AD_STAT)
    return _start(
        counts, lambda df, n: batch_log.write_batch(df, out, n), checkpoint, "update", trigger
    )


def read_ad_stat(spark: SparkSession, out: str) -> DataFrame:
    return batch_log.current(batch_log.read_log(spark, out, AD_STAT), AD_STAT_KEYS)


def start_click_trend(
    lines: DataFrame, out: str, checkpoint: str, trigger: dict, watermark: str = WATERMARK
) -> StreamingQuery:
    """Running counts per (minute, ad).

    A one-hour window sliding every few seconds would copy each click hundreds
    of times. Minute counts are kept once; "the last hour" is a filter for the reader.
    """
    counts = _counts(lines, "1 minute", ["ad_id"], watermark).select(
        *ads.minute_columns(F.col("start")), "ad_id", "click_count"
    )
    batch_log.open_log(lines.sparkSession, out, TREND)
    return _start(
        counts, lambda df, n: batch_log.write_batch(df, out, n), checkpoint, "update", trigger
    )


def read_click_trend(spark: SparkSession, out: str) -> DataFrame:
    return batch_log.current(batch_log.read_log(spark, out, TREND), TREND_KEYS)


def start_blacklist(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict,
    threshold: int = ads.BLACKLIST_THRESHOLD,
    watermark: str = WATERMARK,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Users that reach the daily threshold, added in the batch in which they reach it.

    The streaming state is the table of daily counts; no count is looked up
    per row. Every ``fold_every`` batches the log gets the whole list again.
    """
    spark = lines.sparkSession
    counts = _counts(lines, "1 day", ["user_id", "ad_id"], watermark)
    batch_log.open_log(spark, out, BLACKLIST)

    def fold(known: DataFrame, new: DataFrame) -> DataFrame:
        return known.select("user_id").unionByName(new).distinct()

    def on_batch(changed: DataFrame, batch_id: int) -> None:
        log = batch_log.read_log(changed.sparkSession, out, BLACKLIST)
        known = batch_log.recent(log, batch_id, fold_every)
        new = ads.blacklist_filter(ads.blacklist_users(changed, threshold), known)
        batch_log.write_folding(new, out, BLACKLIST, batch_id, fold_every, fold)

    return _start(counts, on_batch, checkpoint, "update", trigger)


def read_blacklist(spark: SparkSession, out: str) -> DataFrame:
    return batch_log.read_log(spark, out, BLACKLIST).select("user_id").distinct()


def start_blacklist_filter(
    lines: DataFrame, blacklist: str, out: str, checkpoint: str, trigger: dict, fold_every: int = FOLD_EVERY
) -> StreamingQuery:
    """Clicks of users that are not blacklisted when their batch starts.

    The blacklist log is read again in every batch, so users added meanwhile
    by :func:`start_blacklist` are left out from the next batch on. Only its last
    folding batch, which has the whole list, and those since are opened.
    ``fold_every`` must be that of the job that writes the list.
    """
    batch_log.open_log(lines.sparkSession, out, CLICKS)

    def on_batch(clicks: DataFrame, batch_id: int) -> None:
        listed = batch_log.since_last_fold(clicks.sparkSession, blacklist, BLACKLIST, fold_every)
        batch_log.write_batch(ads.blacklist_filter(clicks, listed), out, batch_id)

    return _start(ad_log.clicks(lines), on_batch, checkpoint, "append", trigger)


def read_filtered(spark: SparkSession, out: str) -> DataFrame:
    return batch_log.read_log(spark, out, CLICKS).drop(batch_log.VERSION)


def start_province_top3(
    lines: DataFrame,
    counts_out: str,
    out: str,
    checkpoint: str,
    trigger: dict,
    watermark: str = WATERMARK,
    n: int = 3,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Top ads per (day, province), replaced whenever a group's counts change.

    A batch logs its changed counts, then ranks only the groups it touched,
    from their counts since the last folding batch. A folding batch carries
    over the counts of all days the watermark may still leave open.
    """
    spark = lines.sparkSession
    keys = ["province", "ad_id"]
    counts = _counts(lines, "1 day", keys, watermark).select(_day(F.col("start")), *keys, "click_count")
    batch_log.open_log(spark, counts_out, PROVINCE)
    batch_log.open_log(spark, out, PROVINCE)
    open_days = math.ceil(pd.Timedelta(watermark) / pd.Timedelta(days=1)) + 1

    def on_batch(changed: DataFrame, batch_id: int) -> None:
        def fold(earlier: DataFrame, new: DataFrame) -> DataFrame:
            last_day = earlier.agg(F.max("date")).first()[0]
            first_open = F.date_sub(F.lit(last_day).cast("date"), open_days)
            rows = earlier.where(F.col("date") >= first_open).unionByName(
                new.withColumn(batch_log.VERSION, F.lit(batch_id).cast("bigint"))
            )
            return batch_log.current(rows, PROVINCE_KEYS)

        batch_log.write_folding(
            changed, counts_out, PROVINCE, batch_id, fold_every, fold
        )
        log = batch_log.read_log(changed.sparkSession, counts_out, PROVINCE)
        version = F.col(batch_log.VERSION)
        touched = log.where(version == batch_id).select("date", "province").distinct()
        since_fold = log.where(
            version.between(batch_log.fold_start(batch_id, fold_every), batch_id)
        )
        groups = since_fold.join(touched, ["date", "province"], "left_semi")
        ranked = ads.province_top3(batch_log.current(groups, PROVINCE_KEYS), n)
        batch_log.write_batch(ranked, out, batch_id)

    return _start(counts, on_batch, checkpoint, "update", trigger)


def read_province_top3(spark: SparkSession, out: str) -> DataFrame:
    return batch_log.current_groups(
        batch_log.read_log(spark, out, PROVINCE), ["date", "province"]
    )
