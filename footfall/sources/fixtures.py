"""The engine's input tables, derived from the given star schema and event stream.

Every function is a lazy view: projections over the stored tables, so filters
and column pruning still reach the parquet scans. The rules are in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.sources.readers import table

# 2024-01-01 in epoch seconds, and one day.
EPOCH = 1_704_067_200
DAY = 86_400

# Sales area by city number modulo 7.
AREAS = (
    "China North",
    "China East",
    "China South",
    "China Middle",
    "West North",
    "West South",
    "East North",
)

K = "CAST(get_json_object(props, '$.k') AS BIGINT)"


def _pick(choices: tuple, index: str) -> str:
    """SQL for the element of a fixed list at a computed position (from 0)."""
    branches = [f"WHEN {i} THEN {choice!r}" for i, choice in enumerate(choices)]
    return f"CASE {index} {' '.join(branches)} END"


def _events(spark: SparkSession, folder: str, start: str | None, end: str | None) -> DataFrame:
    """Events, optionally of a closed date range; the range is pushed down on the stored time."""
    events = table(spark, folder, "events")
    if start is not None:
        events = events.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        next_day = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
        events = events.where(F.col("ts") < next_day)
    return events


def actions(
    spark: SparkSession, folder: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """User actions. ``start`` and ``end`` limit the scan to a closed date range."""
    base = _events(spark, folder, start, end).selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "CAST(ts AS DATE) AS date",
        f"{K} AS k",
        f"unix_micros(CAST(ts AS TIMESTAMP)) div 1000000 - {EPOCH} AS sec",
        f"{_pick((1, 3, 10, 30), 'user_id % 4')} AS days_per_session",
        f"{_pick((30, 300, 3000), 'user_id % 3')} AS scale",
    )
    placed = base.selectExpr("*", f"(sec div {DAY}) div days_per_session AS block").selectExpr(
        "*", f"block * days_per_session * {DAY} AS block_start"
    )
    return placed.selectExpr(
        "event_id",
        "date",
        "user_id",
        "concat_ws('_', user_id, block) AS session_id",
        "k % 5 AS page_id",
        f"timestamp_seconds({EPOCH} + block_start + (sec - block_start) div scale) AS action_time",
        "CASE event_type WHEN 'view' THEN concat('kw', k % 10) END AS search_keyword",
        "CASE event_type WHEN 'click' THEN k % 20 END AS click_category_id",
        "CASE event_type WHEN 'click' THEN event_id % 200 END AS click_product_id",
        "CASE event_type WHEN 'signup' THEN concat_ws(',', k % 20, (k + 7) % 20) END AS order_category_ids",
        "CASE event_type WHEN 'signup' THEN CAST(event_id % 200 AS STRING) END AS order_product_ids",
        "CASE event_type WHEN 'purchase' THEN CAST(k % 20 AS STRING) END AS pay_category_ids",
        "CASE event_type WHEN 'purchase' THEN CAST(event_id % 200 AS STRING) END AS pay_product_ids",
        "user_id % 25 AS city_id",
    )


def actions_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The actions as untidy text: hours without zero, stray commas, empty text for missing."""
    untidy = {
        "date": "date_format(date, 'yyyy-MM-dd')",
        "action_time": "date_format(action_time, 'yyyy-MM-dd H:mm:ss')",
        "search_keyword": "concat(search_keyword, ',')",
        "order_category_ids": "concat(',', order_category_ids, ',')",
        "order_product_ids": "concat(',', order_product_ids, ',')",
        "pay_category_ids": "concat(',', pay_category_ids, ',')",
        "pay_product_ids": "concat(',', pay_product_ids, ',')",
    }
    tidy = actions(spark, folder)
    return tidy.selectExpr(
        *[
            f"coalesce({untidy.get(name, f'CAST({name} AS STRING)')}, '') AS {name}"
            for name in tidy.columns
        ]
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "c_custkey AS user_id",
        "c_name AS username",
        "c_name AS name",
        "CAST(10 + (c_custkey * 7) % 60 AS INT) AS age",
        "c_mktsegment AS professional",
        "concat('city', c_nationkey) AS city",
        "CASE c_custkey % 2 WHEN 0 THEN 'male' ELSE 'female' END AS sex",
    )


def cities(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS city_id",
        "n_name AS city_name",
        f"{_pick(AREAS, 'n_nationkey % 7')} AS area",
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        """CASE p_partkey % 50 WHEN 0 THEN 'broken'
           ELSE concat('{"product_status": ', p_partkey % 2, '}') END AS extend_info""",
    )


def product_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """One click per order line: time, buyer, product and the buyer's city."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    bought = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    return bought.selectExpr(
        "l_shipdate AS ts",
        "o_custkey AS user_id",
        "l_partkey AS product_id",
        "CAST(c_nationkey AS BIGINT) AS city_id",
        "l_orderkey AS row_id",
    )


def ad_clicks(
    spark: SparkSession, folder: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Ad clicks: every event is one."""
    province = "concat('province', user_id % 5)"
    return _events(spark, folder, start, end).selectExpr(
        "event_id",
        "CAST(ts AS TIMESTAMP) AS ts",
        "unix_micros(CAST(ts AS TIMESTAMP)) div 1000 AS ts_ms",
        f"{province} AS province",
        f"concat({province}, '-', (user_id div 5) % 2) AS city",
        "user_id",
        f"{K} % 10 AS ad_id",
    )


def ad_clicks_with_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks and their log lines. One event in ten has a field missing, one a number spoilt."""
    return ad_clicks(spark, folder).selectExpr(
        "*",
        """CASE event_id % 10
           WHEN 3 THEN concat_ws(' ', ts_ms, province, city, user_id)
           WHEN 7 THEN concat_ws(' ', ts_ms, province, city, 'x', ad_id)
           ELSE concat_ws(' ', ts_ms, province, city, user_id, ad_id) END AS value""",
    )


def ad_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines by event id, some of them unreadable."""
    return ad_clicks_with_lines(spark, folder).select("event_id", "value")


def row_key(number: str) -> str:
    """SQL for the row key of a part number.

    The digits are reversed, so consecutive numbers are spread over the key
    range and a key range is a fixed share of the table at every scale.
    """
    return f"concat('row', reverse(lpad(CAST({number} AS STRING), 12, '0')))"


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Wide-column cells of the parts: three each, and a renamed version of every third."""
    always = """
        named_struct('family', 'f1', 'qualifier', 'name', 'ts', 1L, 'value', p_name),
        named_struct('family', 'f1', 'qualifier', 'id', 'ts', 1L, 'value', CAST(p_partkey AS STRING)),
        named_struct('family', 'f2', 'qualifier', 'id', 'ts', 1L, 'value', p_brand)"""
    renamed = "named_struct('family', 'f1', 'qualifier', 'name', 'ts', 2L, 'value', concat(p_name, '-v2'))"
    versions = f"CASE p_partkey % 3 WHEN 0 THEN array({always}, {renamed}) ELSE array({always}) END"
    return table(spark, folder, "part").selectExpr(
        f"{row_key('p_partkey')} AS row", f"inline({versions})"
    )


def tasks(spark: SparkSession, folder: str) -> DataFrame:
    """One saved analysis task per customer, with varying parameters; some are malformed."""
    # concat_ws leaves NULL entries out: a CASE without ELSE is an absent parameter.
    whole = """concat('{', concat_ws(',',
        concat('"startDate":["2024-01-', lpad(CAST(c_custkey % 10 + 1 AS STRING), 2, '0'), '"]'),
        concat('"endDate":["2024-01-', lpad(CAST(c_custkey % 10 + 20 AS STRING), 2, '0'), '"]'),
        CASE WHEN c_custkey % 3 <> 0 THEN concat('"startAge":["', c_custkey % 30 + 10, '"]') END,
        CASE WHEN c_custkey % 3 <> 0 THEN concat('"endAge":["', c_custkey % 30 + 40, '"]') END,
        CASE WHEN c_custkey % 2 = 0 THEN concat('"professionals":["', c_mktsegment, ',BUILDING"]') END,
        CASE WHEN c_custkey % 5 = 1 THEN concat('"cities":["city', c_nationkey, '"]') END,
        CASE WHEN c_custkey % 7 < 3 THEN '"sex":["male","female"]' END,
        CASE WHEN c_custkey % 4 = 1
          THEN concat('"keywords":["kw', c_custkey % 10, ',kw', (c_custkey + 3) % 10, '"]') END,
        CASE WHEN c_custkey % 6 = 5
          THEN concat('"categoryIds":["',
            concat_ws(',', c_custkey % 20, (c_custkey + 4) % 20, (c_custkey + 9) % 20), '"]') END,
        '"targetPageFlow":["3,2,0,4,1"]'), '}')"""
    return table(spark, folder, "customer").selectExpr(
        "c_custkey AS task_id",
        "concat('task ', c_custkey) AS task_name",
        "'2024-01-01 00:00:00' AS create_time",
        "'2024-01-01 00:00:00' AS start_time",
        "'2024-01-01 00:00:00' AS finish_time",
        "'session' AS task_type",
        "'ready' AS task_status",
        f"CASE c_custkey % 50 WHEN 0 THEN 'broken' ELSE {whole} END AS task_param",
    )


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as an old ``name=value|name=value`` record and a joined key."""
    events = table(spark, folder, "events").selectExpr("*", f"{K} AS k")
    return events.selectExpr(
        "event_id",
        """concat('sessionid=', event_id,
             '|searchKeywords=', CASE event_type WHEN 'view' THEN concat('kw', k % 10) ELSE '' END,
             '|clickCategoryIds=', concat_ws(',', k % 20, (k + 7) % 20),
             '|age=', user_id % 60) AS record""",
        "concat_ws('_', date_format(ts, 'yyyyMMdd'), user_id, k % 10) AS joined_key",
    )
