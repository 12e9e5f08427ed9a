"""The blacklist at the click itself: the state counts, and each batch finds the clicks that reach the threshold.

Every (day, user, ad) has its count as state of a streaming aggregate, which the watermark drops
with the day. Clicks pass by it unchanged and meet the counts of their batch: only keys whose count
reaches the threshold in this batch have their clicks ranked. Memory per key is one count, however
many clicks a robot makes.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.operators import ads
from footfall.sinks import batch_log
from footfall.sources import ad_log
from footfall.streaming.ad_jobs import CLICKS, FOLD_EVERY, WATERMARK

CUTOFF = "user_id BIGINT, cutoff TIMESTAMP"
CLOCK = "newest BIGINT"
COUNT = "date DATE, user_id BIGINT, ad_id BIGINT, click_count BIGINT"
KEYS = ["date", "user_id", "ad_id"]
_COLUMNS = ["province", "city", "user_id", "ad_id", "ts"]


def _limit(spark: SparkSession, folder: str, batch_id: int, watermark: str) -> int:
    """The microsecond up to which clicks of a batch are late.

    Spark judges a batch by the watermark that its predecessor ran with: the newest click
    of the batches before that one, less the delay.
    """
    log = batch_log.read_log(spark, folder, CLOCK).where(F.col(batch_log.VERSION) == batch_id - 2)
    newest = log.agg(F.max("newest")).first()[0]
    if newest is None:
        return 0
    return max(newest // 1000 * 1000 - pd.Timedelta(watermark) // pd.Timedelta(microseconds=1), 0)


def start_cutoff(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict,
    threshold: int = ads.BLACKLIST_THRESHOLD,
    watermark: str = WATERMARK,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Clicks up to the moment at which their user reached the threshold, and those moments.

    On input in the order of time this is :func:`ads.blacklist_cutoff`. A click that arrives after
    a later one of its user is judged by what is known when it arrives; one that is older than the
    watermark is left out.
    """
    spark = lines.sparkSession
    batch_log.open_log(spark, f"{out}/cutoffs", CUTOFF)
    batch_log.open_log(spark, f"{out}/clicks", CLICKS)
    batch_log.open_log(spark, f"{out}/clock", CLOCK)
    batch_log.open_increments(spark, f"{out}/late", COUNT)
    clicks = ad_log.clicks(lines).withWatermark("ts", watermark)
    counts = clicks.groupBy(F.window("ts", "1 day").alias("w"), "user_id", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))
    text = F.lit(None).cast("string")
    passed = clicks.select(*_COLUMNS, F.lit(None).cast("bigint").alias("click_count")).unionByName(
        counts.select(text.alias("province"), text.alias("city"), "user_id", "ad_id", F.col("w.start").alias("ts"), "click_count")
    )
    open_days = math.ceil(pd.Timedelta(watermark) / pd.Timedelta(days=1)) + 1

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            process(rows, batch_id)
        finally:
            rows.unpersist()

    def process(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        arrived = rows.where("click_count IS NULL").select(*_COLUMNS)
        limit = F.timestamp_micros(F.lit(_limit(spark, f"{out}/clock", batch_id, watermark)))
        before = batch_log.read_log(spark, f"{out}/clock", CLOCK).where(F.col(batch_log.VERSION) == batch_id - 1)
        seen = arrived.select(F.unix_micros("ts").alias("newest")).unionByName(before.select("newest"))
        newest = seen.agg(F.max("newest")).first()[0]
        batch_log.write_batch(spark.createDataFrame([(newest,)], CLOCK), f"{out}/clock", batch_id)
        if batch_id % fold_every and arrived.isEmpty():
            return  # Spark only lets state expire.
        on_time = arrived.where(F.col("ts") > limit)

        # The state drops clicks by their day and has counted late ones of a day still open.
        still_open = F.col("date") >= F.date_sub(F.to_date(limit), open_days)
        late = ads.daily_user_ad_count(arrived.where(F.col("ts") <= limit))
        batch_log.write_increments(late, f"{out}/late", COUNT, KEYS, batch_id, fold_every, still_open)
        late = batch_log.totals_before(spark, f"{out}/late", COUNT, KEYS, batch_id + 1, fold_every).withColumnRenamed("click_count", "_late")
        own = ads.daily_user_ad_count(on_time).withColumnRenamed("click_count", "_own")
        reached = rows.where(F.col("click_count") >= threshold).select(F.to_date("ts").alias("date"), "user_id", "ad_id", "click_count")
        reached = (
            own.join(reached, KEYS)
            .join(late, KEYS, "left")
            .withColumn("click_count", F.col("click_count") - F.coalesce("_late", F.lit(0)))
            .where((F.col("click_count") >= threshold) & (F.col("click_count") - F.col("_own") < threshold))
            .select(*KEYS, (F.col("click_count") - F.col("_own")).alias("click_count"))
        )
        candidates = on_time.withColumn("date", F.to_date("ts")).join(reached, KEYS, "left_semi").select(*_COLUMNS)
        new = ads.crossings(candidates, threshold, reached).groupBy("user_id").agg(F.min("ts").alias("cutoff"))
        batch_log.write_folding(
            new, f"{out}/cutoffs", CUTOFF, batch_id, fold_every,
            lambda before, own: before.select("user_id", "cutoff").unionByName(own).groupBy("user_id").agg(F.min("cutoff").alias("cutoff")),
        )
        # The batch's own cut-offs are read back, and not found again.
        known = batch_log.recent(batch_log.read_log(spark, f"{out}/cutoffs", CUTOFF), batch_id + 1, fold_every)
        kept = ads.before_cutoff(on_time, known.groupBy("user_id").agg(F.min("cutoff").alias("cutoff")))
        batch_log.write_batch(kept, f"{out}/clicks", batch_id)

    return (
        passed.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
        .trigger(**trigger)
        .start()
    )


def read_clicks(spark: SparkSession, out: str) -> DataFrame:
    return batch_log.read_log(spark, f"{out}/clicks", CLICKS).drop(batch_log.VERSION)


def read_cutoffs(spark: SparkSession, out: str) -> DataFrame:
    log = batch_log.read_log(spark, f"{out}/cutoffs", CUTOFF)
    return log.groupBy("user_id").agg(F.min("cutoff").alias("cutoff"))
