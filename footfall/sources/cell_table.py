"""The cell table as stored files in key order.

Every file holds a range of row keys, sorted; row groups are small and carry minimum, maximum and a
Bloom filter of the key. A range scan opens the files and row groups of its range, and a point get
the one row group that can hold the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CELLS = "row STRING, family STRING, qualifier STRING, ts BIGINT, value STRING"
ORDER = ["row", "family", "qualifier", "ts"]
ROW_GROUP_BYTES = 16 << 20


def write_cells(cells: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES, rows_per_file: int = 0) -> None:
    """Store cells in key order; ``rows_per_file`` cuts files further (0: not)."""
    ordered = cells.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    writer = ordered.write.option("parquet.block.size", row_group_bytes)
    # Keys are unlike each other: a dictionary of them would only grow until it is given up.
    writer = writer.option("parquet.bloom.filter.enabled#row", "true").option("parquet.enable.dictionary#row", "false")
    writer.option("maxRecordsPerFile", rows_per_file).parquet(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CELLS).parquet(path)
