"""All ad statistics from one stream: each batch is filtered once and feeds every table.

The tables of a batch carry its number, and what a batch needs of the past it reads from the
batches before it. So a batch that is run again after a failure writes the same rows in the same
places, and every click counts exactly once in each table. What a line becomes:

- ``rejects``  lines that cannot be read
- ``late``     clicks older than the newest click of earlier batches by more than the watermark
- ``trend``    clicks per (minute, ad), of all clicks on time
- ``cutoffs``  users that reached the daily threshold on one ad, and the moment they did
- ``user_counts``, ``ad_stat``, ``province_counts``, ``top``  of clicks up to their user's cut-off
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.operators import ads
from footfall.sinks import batch_log
from footfall.sources import ad_log
from footfall.streaming.ad_jobs import AD_STAT, AD_STAT_KEYS, CLICKS, FOLD_EVERY, PROVINCE, PROVINCE_KEYS, TREND, TREND_KEYS, WATERMARK

USER_COUNT = "date DATE, user_id BIGINT, ad_id BIGINT, click_count BIGINT"
USER_COUNT_KEYS = ["date", "user_id", "ad_id"]
CUTOFF = "user_id BIGINT, cutoff TIMESTAMP"
REJECT = "value STRING"
CLOCK = "newest TIMESTAMP"

# Tables of increments, and those that a batch simply adds rows to.
_COUNTED = {
    "user_counts": (USER_COUNT, USER_COUNT_KEYS),
    "ad_stat": (AD_STAT, AD_STAT_KEYS),
    "province_counts": (PROVINCE, PROVINCE_KEYS),
    "trend": (TREND, TREND_KEYS),
}
_LOGGED = {"cutoffs": CUTOFF, "rejects": REJECT, "late": CLICKS, "clock": CLOCK, "top": PROVINCE}


@dataclass(frozen=True)
class Settings:
    threshold: int = ads.BLACKLIST_THRESHOLD
    watermark: str = WATERMARK
    top: int = 3
    fold_every: int = FOLD_EVERY


def start_ad_pipeline(
    lines: DataFrame, out: str, checkpoint: str, trigger: dict, settings: Settings = Settings()
) -> StreamingQuery:
    """Run the log lines of a stream through all tables below ``out``."""
    spark = lines.sparkSession
    for name, (schema, _) in _COUNTED.items():
        batch_log.open_increments(spark, f"{out}/{name}", schema)
    for name, schema in _LOGGED.items():
        batch_log.open_log(spark, f"{out}/{name}", schema)

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        # Read by every table of the batch: kept on the executors, computed again where one is lost.
        rows.persist()
        try:
            process(rows, batch_id, out, settings)
        finally:
            rows.unpersist()

    return (
        ad_log.parse(lines)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
        .trigger(**trigger)
        .start()
    )


def process(parsed: DataFrame, batch_id: int, out: str, settings: Settings) -> None:
    """Write one batch of parsed lines to all tables."""
    spark = parsed.sparkSession

    def count(rows: DataFrame, name: str, carry=None) -> None:
        schema, keys = _COUNTED[name]
        batch_log.write_increments(rows, f"{out}/{name}", schema, keys, batch_id, settings.fold_every, carry)

    def earlier(name: str) -> DataFrame:
        schema, keys = _COUNTED[name]
        return batch_log.totals_before(spark, f"{out}/{name}", schema, keys, batch_id, settings.fold_every)

    def log(rows: DataFrame, name: str) -> None:
        batch_log.write_batch(rows, f"{out}/{name}", batch_id)

    log(parsed.where(F.col("reject").isNotNull()).select(F.col("reject").alias("value")), "rejects")
    clicks = parsed.where(F.col("reject").isNull()).withColumn("ts", F.timestamp_millis("ts_ms")).drop("reject", "ts_ms")

    # The watermark of this batch is that of the batches before it.
    clock = batch_log.read_log(spark, f"{out}/clock", CLOCK).where(F.col(batch_log.VERSION) == batch_id - 1)
    newest = clock.agg(F.max(F.unix_micros("newest"))).first()[0]
    limit = F.timestamp_micros(F.lit((newest or 0) - pd.Timedelta(settings.watermark) // pd.Timedelta(microseconds=1)))
    on_time = clicks.where(F.col("ts") >= limit)
    log(clicks.where(F.col("ts") < limit).select("province", "city", "user_id", "ad_id", "ts"), "late")
    log(on_time.agg(F.greatest(F.max("ts"), F.timestamp_micros(F.lit(newest).cast("bigint"))).alias("newest")), "clock")
    open_days = math.ceil(pd.Timedelta(settings.watermark) / pd.Timedelta(days=1)) + 1
    still_open = F.col("date") >= F.date_sub(F.to_date(limit), open_days)

    count(
        on_time.groupBy(F.date_trunc("minute", "ts").alias("m"), "ad_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(*ads.minute_columns(F.col("m")), "ad_id", "click_count"),
        "trend",
        still_open,
    )

    # Known cut-offs first, then those this batch reaches.
    known = batch_log.recent(batch_log.read_log(spark, f"{out}/cutoffs", CUTOFF), batch_id, settings.fold_every).drop(batch_log.VERSION)
    candidates = ads.before_cutoff(on_time, known)
    reached = ads.crossings(candidates, settings.threshold, earlier("user_counts"))
    new = reached.groupBy("user_id").agg(F.min("ts").alias("cutoff"))
    batch_log.write_folding(
        new, f"{out}/cutoffs", CUTOFF, batch_id, settings.fold_every,
        lambda before, own: before.select("user_id", "cutoff").unionByName(own).groupBy("user_id").agg(F.min("cutoff").alias("cutoff")),
    )
    new = batch_log.read_log(spark, f"{out}/cutoffs", CUTOFF).where(F.col(batch_log.VERSION) == batch_id)
    kept = ads.before_cutoff(candidates, new)

    count(ads.daily_user_ad_count(kept), "user_counts", still_open)
    count(ads.ad_stat(kept), "ad_stat", still_open)
    # The batch's own counts are read back: few rows, in place of its clicks.
    own = batch_log.read_log(spark, f"{out}/ad_stat/own", AD_STAT).where(F.col(batch_log.VERSION) == batch_id)
    count(ads.province_ad_count(own), "province_counts", still_open)
    touched = own.select("date", "province").distinct()
    both = earlier("province_counts").unionByName(ads.province_ad_count(own))
    groups = both.join(touched, ["date", "province"], "left_semi")
    log(ads.province_top3(ads.province_ad_count(groups), settings.top), "top")


def read_counts(spark: SparkSession, out: str, name: str) -> DataFrame:
    """``user_counts``, ``ad_stat``, ``province_counts`` or ``trend`` as they stand."""
    schema, keys = _COUNTED[name]
    return batch_log.totals(spark, f"{out}/{name}", schema, keys)


def read_blacklist(spark: SparkSession, out: str) -> DataFrame:
    """Users that reached the threshold, and when."""
    log = batch_log.read_log(spark, f"{out}/cutoffs", CUTOFF)
    return log.groupBy("user_id").agg(F.min("cutoff").alias("cutoff"))


def read_top(spark: SparkSession, out: str) -> DataFrame:
    return batch_log.current_groups(batch_log.read_log(spark, f"{out}/top", PROVINCE), ["date", "province"])


def read_rows(spark: SparkSession, out: str, name: str) -> DataFrame:
    """``rejects`` or ``late`` rows of all batches."""
    return batch_log.read_log(spark, f"{out}/{name}", _LOGGED[name]).drop(batch_log.VERSION)
