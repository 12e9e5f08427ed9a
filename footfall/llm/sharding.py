"""Contiguous shards of nearly equal size, from prefix sums over byte sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored

SHARDS = 24
ROW_BYTES = 8  # counted for every document besides its text

ORDER = ["doc_id", "text_crc32", "size"]


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    Documents are laid end to end in the order of doc_id (null first), crc32 and size of the text;
    a document belongs to the shard in which its middle byte lies when the total is cut into
    ``shards`` equal parts. So a shard misses its share by one document at most, and shards are
    contiguous in that order. ``slot`` numbers a shard's documents from 0. Null and empty texts
    have the size of a row alone; repeated rows lie side by side and share slots among them in
    any order. Fewer documents than shards leave shards empty; an empty table gives no rows.
    The law is ``bytes``, which looks at no groups: equal texts may part. Other columns are not looked at.

    The order is dealt out by ranges and stored. A running sum inside each part of the range, plus
    the totals of the parts before it, gives every document its place; the totals (one small row
    for a part) are the only thing that meets in one task. Full repeats of one row beyond a part's
    share stay in one part, as 20-byte rows without their text.
    """
    sized = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    dealt = sized.repartitionByRange(*ORDER).withColumn("part", F.spark_partition_id())
    rows = stored(dealt, "sizes")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    parts = (
        rows.groupBy("part")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(everything).alias("total"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*ORDER)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        rows.withColumn("end", F.sum("size").over(running))
        .withColumn("number", F.row_number().over(inside))
        .join(F.broadcast(parts), "part")  # at most spark.sql.shuffle.partitions rows
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("number") - 1 + F.col("rows_before")).alias("place"),
            F.expr(f"cast(((bytes_before + end) * 2 - size) * {shards} div (2 * total) as int)").alias("shard"),
        )
    )
    placed = stored(placed, "places")
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(  # one row for a shard
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
