"""Result tables of saved tasks: every row carries the number of its task.

A table holds one folder per task. Writing a task's result again replaces that folder alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import funnel, sessions
from footfall.plans.area_top_products import area_top_products
from footfall.plans.page_funnel import page_funnel
from footfall.sources import readers
from footfall.sources.tasks import Task

TASK = "task_id"


def write_result(result: DataFrame, task_id: int, table: str) -> None:
    """Store the result of one task in a table, in place of an earlier one."""
    rows = result.withColumn(TASK, F.lit(task_id).cast("bigint"))
    writer = rows.write.partitionBy(TASK).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(table)


def read_results(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """Results of all tasks; a condition on ``task_id`` chooses folders."""
    return spark.read.schema(f"{schema}, {TASK} BIGINT").parquet(table)


def area_top_of_task(
    actions: DataFrame, cities: DataFrame, product_info: DataFrame, task: Task, n: int = 3
) -> DataFrame:
    """Most clicked products per area among the product clicks of the task's days."""
    clicks = readers.clicks_by_date(actions, task.start_date, task.end_date)
    return area_top_products(clicks, cities, product_info, n)


def rates_of_task(actions: DataFrame, task: Task) -> DataFrame:
    """The task's conversion rates as one text."""
    ranged = readers.actions_by_date(actions, task.start_date, task.end_date)
    return funnel.page_convert_rate_string(page_funnel(ranged, task.page_flow))


def session_stat_of_task(actions: DataFrame, users: DataFrame, task: Task) -> DataFrame:
    """Number of passing sessions and the shares of every length and depth range, for the task's days and criteria."""
    ranged = readers.actions_by_date(actions, task.start_date, task.end_date)
    return sessions.session_aggr_stat(sessions.session_filter(ranged, users, task.criteria))
