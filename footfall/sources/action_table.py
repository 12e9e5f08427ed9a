"""The action table as stored files, one folder per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.sources.schemas import ACTIONS_WITH_ID


def write_actions(actions: DataFrame, path: str) -> None:
    """Store a new table. Rows are gathered by day and size, so a day is a few files and a big day is split."""
    actions.hint("rebalance", "date").write.partitionBy("date").parquet(path)


def replace_days(actions: DataFrame, path: str) -> None:
    """Exchange all rows of the days that occur in ``actions``; folders of other days are not touched."""
    writer = actions.hint("rebalance", "date").write.partitionBy("date").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_actions(spark: SparkSession, path: str, schema: str = ACTIONS_WITH_ID) -> DataFrame:
    """The stored table, columns in the order of the schema. Conditions on ``date`` choose folders."""
    return spark.read.schema(schema).parquet(path).select(*StructType.fromDDL(schema).names)


def actions_on_days(actions: DataFrame, days: DataFrame) -> DataFrame:
    """Actions of the days listed in ``days`` (column ``date``).

    The days are few: they are broadcast where Spark sees that, and then also choose, while the
    query runs, which folders of a stored table are read.
    """
    return actions.join(days.select("date").distinct(), "date", "left_semi").select(*actions.columns)


def days_of_tasks(params: DataFrame) -> DataFrame:
    """One row per task and day of its range, from parsed task parameters. A task without a range has none."""
    start, end = F.to_date("start_date"), F.to_date("end_date")
    ranged = params.where(start <= end)
    return ranged.select("task_id", F.explode(F.sequence(start, end)).alias("date"))
