"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append(df: DataFrame, path: str, *partition_by: str) -> None:
    """Add result rows to a stored table."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_jdbc(df: DataFrame, table_name: str, batch_size: int = 10_000, **options: str) -> None:
    """Add result rows to a database table in batches, from the executors."""
    writer = df.write.format("jdbc").mode("append").option("dbtable", table_name)
    writer.option("batchsize", batch_size).options(**options).save()
