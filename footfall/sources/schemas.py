"""Schemas of record."""

from __future__ import annotations

# Column names and types of the input tables.
ACTION_COLUMNS = (
    "date DATE, user_id BIGINT, session_id STRING, page_id BIGINT, action_time TIMESTAMP, "
    "search_keyword STRING, click_category_id BIGINT, click_product_id BIGINT, "
    "order_category_ids STRING, order_product_ids STRING, "
    "pay_category_ids STRING, pay_product_ids STRING, city_id BIGINT"
)
USER_COLUMNS = (
    "user_id BIGINT, username STRING, name STRING, age INT, professional STRING, "
    "city STRING, sex STRING"
)
PRODUCT_COLUMNS = "product_id BIGINT, product_name STRING, extend_info STRING"
CITY_COLUMNS = "city_id BIGINT, city_name STRING, area STRING"

# Actions carry a unique event id: the tie-break of equal times.
ACTIONS_WITH_ID = f"event_id BIGINT, {ACTION_COLUMNS}"

# Columns of the given star schema and event stream that are read here.
STORED = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
}
