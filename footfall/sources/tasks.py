"""Analysis tasks: a table whose ``task_param`` is a JSON object of string arrays."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.criteria import Criteria

# Parameter names in the JSON and their columns.
PARAMETERS = {
    "startDate": "start_date",
    "endDate": "end_date",
    "startAge": "start_age",
    "endAge": "end_age",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keywords",
    "categoryIds": "category_ids",
    "targetPageFlow": "target_page_flow",
}
NUMBERS = ("start_age", "end_age")


def parse_params(tasks: DataFrame) -> DataFrame:
    """One column per parameter: the first element of its array, NULL when absent."""
    params = F.from_json("task_param", "map<string,array<string>>")

    def first(name: str, alias: str) -> Column:
        value = F.get(params[name], 0)
        return (value.try_cast("int") if alias in NUMBERS else value).alias(alias)

    return tasks.select("task_id", *[first(name, alias) for name, alias in PARAMETERS.items()])


@dataclass(frozen=True)
class Task:
    task_id: int
    start_date: str | None
    end_date: str | None
    page_flow: list[int] | None
    criteria: Criteria


def find(tasks: DataFrame, task_id: int) -> Task:
    """The parameters of one task. Reads one row; an unknown id is an error."""
    found = parse_params(tasks.where(F.col("task_id") == task_id)).limit(1).collect()
    if not found:
        raise LookupError(f"no task {task_id}")
    row = found[0]

    def items(text: str | None) -> list[str] | None:
        return text.split(",") if text else None

    flow, categories = items(row.target_page_flow), items(row.category_ids)
    return Task(
        task_id=row.task_id,
        start_date=row.start_date,
        end_date=row.end_date,
        page_flow=[int(page) for page in flow] if flow else None,
        criteria=Criteria(
            start_age=row.start_age,
            end_age=row.end_age,
            professionals=items(row.professionals),
            cities=items(row.cities),
            sex=row.sex,
            keywords=items(row.keywords),
            category_ids=[int(c) for c in categories] if categories else None,
        ),
    )
