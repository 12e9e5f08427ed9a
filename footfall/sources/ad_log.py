"""Ad click log lines: ``epoch_millis province city user_id ad_id``, separated by spaces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELD_COUNT = 5


def parse(lines: DataFrame) -> DataFrame:
    """Typed columns, and the whole line in ``reject`` when it cannot be read.

    A line is rejected unless it has exactly five fields and its three numbers parse.
    """
    fields = F.split("value", " ")
    ts_ms = F.get(fields, 0).try_cast("bigint")
    user_id = F.get(fields, 3).try_cast("bigint")
    ad_id = F.get(fields, 4).try_cast("bigint")
    good = (F.size(fields) == FIELD_COUNT) & ts_ms.isNotNull() & user_id.isNotNull() & ad_id.isNotNull()
    good = F.coalesce(good, F.lit(False))
    kept = [column for column in lines.columns if column != "value"]
    return lines.select(
        *kept,
        F.when(good, ts_ms).alias("ts_ms"),
        F.when(good, F.get(fields, 1)).alias("province"),
        F.when(good, F.get(fields, 2)).alias("city"),
        F.when(good, user_id).alias("user_id"),
        F.when(good, ad_id).alias("ad_id"),
        F.when(~good, F.col("value")).alias("reject"),
    )


def clicks(lines: DataFrame) -> DataFrame:
    """Readable lines with their event time; rejects are left out."""
    parsed = parse(lines).where(F.col("reject").isNull())
    return parsed.withColumn("ts", F.timestamp_millis("ts_ms")).drop("reject", "ts_ms")


def lines(clicks_with_ms: DataFrame) -> DataFrame:
    """The text form of clicks, as a producer would write them."""
    return clicks_with_ms.select(
        F.concat_ws(" ", "ts_ms", "province", "city", "user_id", "ad_id").alias("value")
    )
