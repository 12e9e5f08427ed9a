"""Bucket and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions.json_fields import json_field

# Visit length ranges in seconds, both ends inclusive, no upper end = open.
VISIT_RANGES = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)

# Step length ranges in actions, both ends inclusive.
STEP_RANGES = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

# Level of each sales area; an area not listed is a D area.
AREA_LEVELS = {
    "China North": "A Level",
    "China East": "A Level",
    "China South": "B Level",
    "China Middle": "B Level",
    "West North": "C Level",
    "West South": "C Level",
}
OTHER_AREA_LEVEL = "D Level"

# Lowest score of each grade.
GRADE_FLOORS = (("A", 90), ("B", 80), ("C", 70), ("D", 60))
LOWEST_GRADE = "E"
GOOD_FLOOR = 80


def in_range(column: str, low: int, high: int | None) -> str:
    """Condition that a column lies in one of the ranges above, as SQL text."""
    return f"{column} >= {low}" if high is None else f"{column} BETWEEN {low} AND {high}"


def _bucket(column: str, ranges: tuple) -> Column:
    branches = [f"WHEN {in_range(column, low, high)} THEN '{name}'" for name, low, high in ranges]
    return F.expr(f"CASE {' '.join(branches)} END")


def visit_bucket(column: str) -> Column:
    """Name of the visit length range; a visit of 0 seconds is in none (NULL)."""
    return _bucket(column, VISIT_RANGES)


def step_bucket(column: str) -> Column:
    return _bucket(column, STEP_RANGES)


def _first_match(branches: list[tuple[Column, str]]) -> Column:
    (condition, label), *rest = branches
    chain = F.when(condition, label)
    for condition, label in rest:
        chain = chain.when(condition, label)
    return chain


def area_level(
    area: Column, levels: dict[str, str] = AREA_LEVELS, other: str = OTHER_AREA_LEVEL
) -> Column:
    return _first_match([(area == name, level) for name, level in levels.items()]).otherwise(other)


def product_status(extend_info: Column) -> Column:
    """Own or third-party product; missing and malformed information is third party."""
    own = json_field(extend_info, "product_status") == "0"
    return F.when(own, "Self").otherwise("Third Party")


def grade(score: Column) -> Column:
    return _first_match([(score >= low, name) for name, low in GRADE_FLOORS]).otherwise(LOWEST_GRADE)


def good_or_bad(score: Column) -> Column:
    return F.when(score >= GOOD_FLOOR, "GOOD").otherwise("BAD")
