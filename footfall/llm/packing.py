"""Packing: optimal length buckets, and batches of a fixed token budget inside each."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import SPACE_REGEX, stored

BUCKETS = 16
BUDGET = 65_536  # tokens of a batch, padding included


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The upper lengths of at most ``buckets`` buckets with the least padding in total.

    ``lengths`` are ascending and different. Dynamic programming over prefixes; the best last
    cut moves only right as the prefix grows, so each layer is solved by halving, a level at a time.
    """
    size = len(lengths)
    if not size:
        return []
    lengths, counts = lengths.astype(np.float64), counts.astype(np.float64)
    rows = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    best = np.concatenate([[0], lengths * rows[1:] - tokens[1:]])  # one bucket for the first i lengths
    choices = []
    for _ in range(min(buckets, size) - 1):
        new, choice = best.copy(), np.zeros(size + 1, np.int64)
        todo = [(1, size, 0, size - 1)]
        while todo:
            deeper = []
            for low, high, from_, to in todo:
                middle = (low + high) // 2
                cuts = np.arange(from_, min(middle - 1, to) + 1)
                cost = best[cuts] + lengths[middle - 1] * (rows[middle] - rows[cuts]) - (tokens[middle] - tokens[cuts])
                pick = int(cost.argmin())
                new[middle], choice[middle] = cost[pick], cuts[pick]
                if low < middle:
                    deeper.append((low, middle - 1, from_, int(cuts[pick])))
                if middle < high:
                    deeper.append((middle + 1, high, int(cuts[pick]), to))
            todo = deeper
        choices.append(choice)
        best = new
    out, at = [], size
    for choice in [*reversed(choices), np.zeros(size + 1, np.int64)]:
        if not at:
            break
        out.append(int(lengths[at - 1]))
        at = int(choice[at])
    return out[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_length, padding, batch, slot of every document.

    Tokens are whitespace-separated words. The histogram of lengths over all documents is counted
    by Spark; the driver gets one row for each different length (few: ``d`` different lengths need
    ``d * d / 2`` tokens). A bucket takes the lengths up to its boundary; a batch holds as many of
    its documents as fit the budget when padded to the boundary, at least one. Batches are numbered
    from 0 in each bucket, slots from 0 in each batch, by doc_id (null first) and length.

    Null and empty texts have no tokens: they share the shortest bucket and take at most ``budget``
    rows a batch. Repeated rows get slots of their own. No input, no rows. Other columns are not
    looked at. Numbers come from counts of parts of the order and the order inside a part, so a
    bucket with most documents is not sorted in one task.
    """
    count = F.expr(f"size(array_remove(split(text, '{SPACE_REGEX.replace(chr(92), chr(92) * 2)}'), ''))")
    counted = docs.select("doc_id", F.coalesce(F.when(F.col("text").isNotNull(), count), F.lit(0)).cast("long").alias("n_tokens"))
    counted = stored(counted, "lengths")
    histogram = counted.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by("n_tokens")
    tops = boundaries(histogram["n_tokens"].to_numpy(), histogram["n"].to_numpy(), buckets)
    bucket = F.lit(0)
    length = F.lit(tops[0] if tops else 0)
    for i in range(1, len(tops)):  # the last condition that holds is outermost
        bucket = F.when(F.col("n_tokens") > tops[i - 1], i).otherwise(bucket)
        length = F.when(F.col("n_tokens") > tops[i - 1], tops[i]).otherwise(length)
    order = ["bucket", "doc_id", "n_tokens"]
    placed = counted.withColumns({"bucket": bucket.cast("int"), "bucket_length": length.cast("long")})
    placed = stored(placed.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "buckets")
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        placed.groupBy("bucket", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bucket", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    )
    inside = Window.partitionBy("bucket", "part").orderBy("doc_id", "n_tokens")
    capacity = f"greatest(1, {budget} div greatest(bucket_length, 1))"
    # At most one row for a bucket and part.
    numbered = placed.withColumn("number", F.row_number().over(inside)).join(F.broadcast(earlier), ["bucket", "part"])
    number = "(earlier + number - 1)"
    return numbered.select(
        "doc_id",
        "n_tokens",
        "bucket",
        "bucket_length",
        F.expr("bucket_length - n_tokens").alias("padding"),
        F.expr(f"{number} div {capacity}").alias("batch"),
        F.expr(f"{number} % {capacity}").alias("slot"),
    )
