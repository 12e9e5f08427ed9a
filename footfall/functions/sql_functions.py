"""The scalar functions under SQL names, for users who write SQL text.

They are SQL functions, so Catalyst inlines them; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "concat_long_string": (
        "(id BIGINT, name STRING, sep STRING) RETURNS STRING RETURN concat(CAST(id AS STRING), sep, name)"
    ),
    "json_field": "(json STRING, field STRING) RETURNS STRING RETURN get_json_object(json, concat('$.', field))",
    "add_prefix": (
        "(val STRING, row_id BIGINT, num INT) RETURNS STRING "
        "RETURN concat(CAST(pmod(xxhash64(row_id), CAST(num AS BIGINT)) AS STRING), '_', val)"
    ),
    "strip_prefix": "(val STRING) RETURNS STRING RETURN regexp_replace(val, '^[0-9]+_', '')",
    "trim_comma": "(val STRING) RETURNS STRING RETURN regexp_replace(val, '^,|,$', '')",
    "pad2": "(val STRING) RETURNS STRING RETURN CASE WHEN length(val) = 2 THEN val ELSE concat('0', val) END",
    "ratio2": (
        "(part BIGINT, whole BIGINT) RETURNS DOUBLE RETURN "
        "CASE WHEN whole <> 0 THEN CAST((200 * part + whole) div (2 * whole) AS DOUBLE) / CAST(100 AS DOUBLE) END"
    ),
}


def register(spark: SparkSession) -> None:
    for name, definition in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{definition}")
