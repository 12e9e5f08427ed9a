"""DuckDB SQL for the registered queries, on the same parquet tables.

Written independently of the Spark code: derived tables as CTEs, then the
plainest form of each result.
"""

from __future__ import annotations

# Columns of the derived action table, in order.
_ACTION_COLUMNS = """event_id, date, user_id, session_id, page_id, action_time, search_keyword,
 click_category_id, click_product_id, order_category_ids, order_product_ids,
 pay_category_ids, pay_product_ids, city_id"""

_ACTIONS = """
ev AS (
  SELECT event_id, user_id, event_type, ts,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    epoch_us(ts) // 1000000 - 1704067200 AS sec,
    CASE user_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 10 ELSE 30 END AS dps,
    CASE user_id % 3 WHEN 0 THEN 30 WHEN 1 THEN 300 ELSE 3000 END AS scale
  FROM events),
ev2 AS (SELECT *, (sec // 86400) // dps AS b FROM ev),
acts AS (
  SELECT event_id, CAST(ts AS DATE) AS date, user_id,
    concat(user_id, '_', b) AS session_id, k % 5 AS page_id,
    1704067200 + b * dps * 86400 + (sec - b * dps * 86400) // scale AS action_sec,
    CASE WHEN event_type = 'view' THEN concat('kw', k % 10) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id,
    CASE WHEN event_type = 'click' THEN event_id % 200 END AS click_product_id,
    CASE WHEN event_type = 'signup' THEN concat(k % 20, ',', (k + 7) % 20) END AS order_category_ids,
    CASE WHEN event_type = 'signup' THEN CAST(event_id % 200 AS VARCHAR) END AS order_product_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(k % 20 AS VARCHAR) END AS pay_category_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(event_id % 200 AS VARCHAR) END AS pay_product_ids,
    user_id % 25 AS city_id
  FROM ev2),
actions AS (SELECT *, make_timestamp(action_sec * 1000000) AS action_time FROM acts)"""

_ACTIONS_OUT = """SELECT event_id, strftime(date, '%Y-%m-%d') AS date, user_id, session_id, page_id,
 strftime(action_time, '%Y-%m-%d %H:%M:%S.%f') AS action_time, search_keyword,
 CAST(click_category_id AS BIGINT) AS click_category_id, CAST(click_product_id AS BIGINT) AS click_product_id,
 order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id"""

_USERS = """
users AS (
  SELECT c_custkey AS user_id, CAST(10 + (c_custkey * 7) % 60 AS BIGINT) AS age,
    c_mktsegment AS professional, concat('city', c_nationkey) AS city,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer)"""

_CITIES = """
cities AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name,
    CASE n_nationkey % 7 WHEN 0 THEN 'China North' WHEN 1 THEN 'China East' WHEN 2 THEN 'China South'
      WHEN 3 THEN 'China Middle' WHEN 4 THEN 'West North' WHEN 5 THEN 'West South' ELSE 'East North' END AS area
  FROM nation)"""

_BIG_CLICKS = """
clicks AS (
  SELECT l_shipdate AS ts, o_custkey AS user_id, l_partkey AS product_id,
    CAST(c_nationkey AS BIGINT) AS city_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

_STATUS = "CASE WHEN p_partkey % 50 <> 0 AND p_partkey % 2 = 0 THEN 'Self' ELSE 'Third Party' END"

_LEVEL = """CASE WHEN area IN ('China North', 'China East') THEN 'A Level'
 WHEN area IN ('China South', 'China Middle') THEN 'B Level'
 WHEN area IN ('West North', 'West South') THEN 'C Level' ELSE 'D Level' END"""

_AREA_COUNTS = f"""{_CITIES},{_BIG_CLICKS},
placed AS (SELECT area, product_id, city_id, city_name FROM clicks JOIN cities USING (city_id)),
area_cities AS (SELECT DISTINCT area, product_id, city_id, city_name FROM placed),
area_lists AS (
  SELECT area, product_id, string_agg(concat(city_id, ':', city_name), ',' ORDER BY city_id) AS city_infos
  FROM area_cities GROUP BY ALL),
area_sums AS (SELECT area, product_id, count(*) AS click_count FROM placed GROUP BY ALL),
area_counts AS (
  SELECT area, product_id, click_count, city_infos FROM area_sums JOIN area_lists USING (area, product_id)),
full_counts AS (
  SELECT a.product_id, area, click_count, city_infos, p_name AS product_name, {_STATUS} AS product_status
  FROM area_counts a JOIN part ON a.product_id = p_partkey)"""

_ADS = """
ad_clicks AS (
  SELECT event_id, ts, epoch_us(ts) // 1000 AS ts_ms, CAST(ts AS DATE) AS date,
    concat('province', user_id % 5) AS province, concat('province', user_id % 5, '-', (user_id // 5) % 2) AS city,
    user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS ad_id
  FROM events)"""

_DAILY = f"""{_ADS},
daily AS (SELECT date, user_id, ad_id, count(*) AS click_count FROM ad_clicks GROUP BY ALL)"""

_BLACK = f"{_DAILY}, black AS (SELECT DISTINCT user_id FROM daily WHERE click_count >= 3)"

_CUTOFF = f"""{_BLACK},
numbered AS (
  SELECT ts, user_id, row_number() OVER (PARTITION BY date, user_id, ad_id ORDER BY ts, event_id) AS n
  FROM ad_clicks),
cutoffs AS (SELECT user_id, min(ts) AS cutoff FROM numbered WHERE n = 3 GROUP BY user_id),
kept AS (
  SELECT a.* FROM ad_clicks a LEFT JOIN cutoffs c ON a.user_id = c.user_id
  WHERE c.cutoff IS NULL OR a.ts <= c.cutoff)"""


def _stat(source: str, where: str = "TRUE", factor: int = 1) -> str:
    return f"""SELECT date, province, city, ad_id, CAST(count(*) * {factor} AS BIGINT) AS click_count
 FROM {source} WHERE {where} GROUP BY date, province, city, ad_id"""


def _province(source: str) -> str:
    return f"""SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
 FROM {source} GROUP BY date, province, ad_id"""


def _top3(source: str) -> str:
    return f"""SELECT date, province, ad_id, click_count FROM (
 SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS r
 FROM {source}) WHERE r <= 3"""


_PARTS = f"""{_ADS},
old_stat AS ({_stat('ad_clicks', "date <= DATE '2024-01-20'")}),
new_stat AS ({_stat('ad_clicks', "date >= DATE '2024-01-15'", 2)})"""

_STAT_OUT = "strftime(date, '%Y-%m-%d') AS date, province, city, ad_id, click_count"
_TOP_OUT = "strftime(date, '%Y-%m-%d') AS date, province, ad_id, click_count"

_ROLLUP = f"""{_ACTIONS},
rollup AS (
  SELECT session_id, min(user_id) AS user_id, max(action_sec) - min(action_sec) AS visit_length,
    count(*) AS step_length, min(action_time) AS start_time
  FROM actions GROUP BY session_id),
keyword_lists AS (
  SELECT session_id, string_agg(search_keyword, ',' ORDER BY search_keyword) AS search_keywords
  FROM (SELECT DISTINCT session_id, search_keyword FROM actions WHERE search_keyword IS NOT NULL)
  GROUP BY session_id),
category_lists AS (
  SELECT session_id, string_agg(CAST(click_category_id AS VARCHAR), ',' ORDER BY click_category_id) AS click_category_ids
  FROM (SELECT DISTINCT session_id, click_category_id FROM actions WHERE click_category_id IS NOT NULL)
  GROUP BY session_id),
sessions AS (
  SELECT r.*, coalesce(search_keywords, '') AS search_keywords, coalesce(click_category_ids, '') AS click_category_ids
  FROM rollup r LEFT JOIN keyword_lists USING (session_id) LEFT JOIN category_lists USING (session_id))"""

_SESSION_OUT = """session_id, user_id, visit_length, step_length,
 strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') AS start_time, search_keywords, click_category_ids"""

# The fixed criteria of the filter queries.
_PROFESSIONALS = "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')"
_CITY_NAMES = "(" + ", ".join(f"'city{i}'" for i in range(20)) + ")"
_KEYWORDS = "('kw1', 'kw3', 'kw5', 'kw7')"
_CATEGORIES = "(1, 2, 4, 5, 7, 10, 13, 16, 19)"

_PASSING = f"""{_ROLLUP},{_USERS},
passing AS (
  SELECT s.*, u.age, u.professional, u.city, u.sex FROM sessions s JOIN users u USING (user_id)
  WHERE u.age BETWEEN 20 AND 60 AND u.professional IN {_PROFESSIONALS} AND u.city IN {_CITY_NAMES}
    AND u.sex = 'male'
    AND session_id IN (SELECT session_id FROM actions WHERE search_keyword IN {_KEYWORDS})
    AND session_id IN (SELECT session_id FROM actions WHERE click_category_id IN {_CATEGORIES})),
detail AS (SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM passing))"""


def _ratio(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} <> 0 THEN CAST((200 * ({part}) + {whole}) // (2 * {whole}) AS DOUBLE)"
        " / CAST(100 AS DOUBLE) END"
    )


_VISIT = {
    "1s_3s": "visit_length BETWEEN 1 AND 3",
    "4s_6s": "visit_length BETWEEN 4 AND 6",
    "7s_9s": "visit_length BETWEEN 7 AND 9",
    "10s_30s": "visit_length BETWEEN 10 AND 30",
    "30s_60s": "visit_length > 30 AND visit_length <= 60",
    "1m_3m": "visit_length > 60 AND visit_length <= 180",
    "3m_10m": "visit_length > 180 AND visit_length <= 600",
    "10m_30m": "visit_length > 600 AND visit_length <= 1800",
    "30m": "visit_length > 1800",
}
_STEP = {
    "1_3": "step_length BETWEEN 1 AND 3",
    "4_6": "step_length BETWEEN 4 AND 6",
    "7_9": "step_length BETWEEN 7 AND 9",
    "10_30": "step_length BETWEEN 10 AND 30",
    "30_60": "step_length > 30 AND step_length <= 60",
    "60": "step_length > 60",
}
_RATIOS = {f"visit_length_{n}_ratio": c for n, c in _VISIT.items()} | {
    f"step_length_{n}_ratio": c for n, c in _STEP.items()
}
_STAT_COLUMNS = ", ".join(
    f"{_ratio(f'count(*) FILTER ({c})', 'count(*)')} AS {name}" for name, c in _RATIOS.items()
)

_CATEGORY_COUNTS = """
touched AS (
  SELECT click_category_id AS category_id, 1 AS c, 0 AS o, 0 AS p FROM detail WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 0, 1, 0 FROM detail WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 0, 0, 1 FROM detail WHERE pay_category_ids IS NOT NULL),
categories AS (
  SELECT category_id, CAST(sum(c) AS BIGINT) AS click_count, CAST(sum(o) AS BIGINT) AS order_count,
    CAST(sum(p) AS BIGINT) AS pay_count
  FROM touched GROUP BY category_id),
top_categories AS (
  SELECT * FROM categories ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10),
session_clicks AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count
  FROM detail WHERE click_category_id IN (SELECT category_id FROM top_categories) GROUP BY ALL),
top_sessions AS (
  SELECT category_id, session_id, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS r
    FROM session_clicks) WHERE r <= 10)"""


def _extract(source: str) -> str:
    return f"""
placed AS (
  SELECT *, CAST(start_time AS DATE) AS d, hour(start_time) AS h FROM {source}),
hours AS (SELECT d, h, count(*) AS n FROM placed GROUP BY ALL),
quotas AS (
  SELECT d, h, (4 * running) // total - (4 * (running - n)) // total AS quota FROM (
    SELECT d, h, n, CAST(sum(n) OVER (PARTITION BY d ORDER BY h) AS BIGINT) AS running,
      CAST(sum(n) OVER (PARTITION BY d) AS BIGINT) AS total FROM hours)),
picked AS (
  SELECT * FROM (
    SELECT p.*, quota, row_number() OVER (PARTITION BY d, h ORDER BY md5(session_id), session_id) AS r
    FROM placed p JOIN quotas USING (d, h)) WHERE r <= quota)"""


_PAIRS = f"""{_ACTIONS},
pairs AS (
  SELECT session_id, action_time, event_id, page_id,
    lag(page_id) OVER (PARTITION BY session_id ORDER BY action_sec, event_id) AS previous_page_id
  FROM actions)"""

_FLOW = "flow(step, a, b) AS (VALUES (1, 3, 2), (2, 2, 0), (3, 0, 4), (4, 4, 1))"


def _rates(source: str = "pairs") -> str:
    return f"""{_FLOW},
pv AS (
  SELECT step, concat(a, '_', b) AS page_split,
    (SELECT count(*) FROM {source} p WHERE p.previous_page_id = a AND p.page_id = b) AS pv
  FROM flow),
rates AS (
  SELECT CAST(step AS BIGINT) AS step, page_split, {_ratio('pv', 'before')} AS convert_rate FROM (
    SELECT *, coalesce(lag(pv) OVER (ORDER BY step), (SELECT count(*) FROM {source} WHERE page_id = 3)) AS before
    FROM pv))"""


_CELLS = """
keyed AS (SELECT *, concat('row', reverse(lpad(CAST(p_partkey AS VARCHAR), 12, '0'))) AS row FROM part),
cells AS (
  SELECT row, 'f1' AS family, 'name' AS qualifier, CAST(1 AS BIGINT) AS ts, p_name AS value FROM keyed
  UNION ALL SELECT row, 'f1', 'id', 1, CAST(p_partkey AS VARCHAR) FROM keyed
  UNION ALL SELECT row, 'f2', 'id', 1, p_brand FROM keyed
  UNION ALL SELECT row, 'f1', 'name', 2, concat(p_name, '-v2') FROM keyed WHERE p_partkey % 3 = 0)"""


def _latest(source: str) -> str:
    return f"""SELECT row, family, qualifier, ts, value FROM (
 SELECT *, row_number() OVER (PARTITION BY row, family, qualifier ORDER BY ts DESC) AS r FROM {source}) WHERE r = 1"""


_RANGE = "row >= 'row5000' AND row < 'row8000'"

_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
_CLICK_OUT = f"user_id, event_id, {_TS} AS ts, ts_ms, province, city, ad_id"

_TREND = """SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute,
 ad_id, count(*) AS click_count FROM ad_clicks GROUP BY ALL"""

# The saved task of pipeline_session (number 5): 2024-01-06 to 2024-01-25, ages 15 to 45,
# keywords kw5 and kw8, categories 5, 9 and 14.
_TASK_SESSIONS = f"""{_ACTIONS.replace('FROM acts)', "FROM acts WHERE date BETWEEN DATE '2024-01-06' AND DATE '2024-01-25')")},{_USERS},
passing AS (
  SELECT session_id, max(action_sec) - min(action_sec) AS visit_length, count(*) AS step_length,
    min(action_time) AS start_time, min(action_sec) AS start_sec
  FROM actions GROUP BY session_id
  HAVING min(user_id) IN (SELECT user_id FROM users WHERE age BETWEEN 15 AND 45)
    AND count(*) FILTER (search_keyword IN ('kw5', 'kw8')) > 0
    AND count(*) FILTER (click_category_id IN (5, 9, 14)) > 0),
detail AS (SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM passing))"""

_STAT_ROWS = "\n UNION ALL ".join(
    f"SELECT 'aggr_stat' AS section, '{name}' AS name, CAST(NULL AS VARCHAR) AS item, count(*) AS n1,"
    f" CAST(NULL AS BIGINT) AS n2, CAST(NULL AS BIGINT) AS n3,"
    f" {_ratio(f'count(*) FILTER ({c})', 'count(*)')} AS ratio FROM passing"
    for name, c in _RATIOS.items()
)


def _task_param() -> str:
    """First array elements by key arithmetic; task_param itself is not parsed."""
    key = "c_custkey"
    ok = f"{key} % 50 <> 0"

    def day(first: int) -> str:
        return f"CASE WHEN {ok} THEN concat('2024-01-', lpad(CAST({key} % 10 + {first} AS VARCHAR), 2, '0')) END"

    return f"""SELECT {key} AS task_id, {day(1)} AS start_date, {day(20)} AS end_date,
 CASE WHEN {ok} AND {key} % 3 <> 0 THEN {key} % 30 + 10 END AS start_age,
 CASE WHEN {ok} AND {key} % 3 <> 0 THEN {key} % 30 + 40 END AS end_age,
 CASE WHEN {ok} AND {key} % 2 = 0 THEN concat(c_mktsegment, ',BUILDING') END AS professionals,
 CASE WHEN {ok} AND {key} % 5 = 1 THEN concat('city', c_nationkey) END AS cities,
 CASE WHEN {ok} AND {key} % 7 < 3 THEN 'male' END AS sex,
 CASE WHEN {ok} AND {key} % 4 = 1 THEN concat('kw', {key} % 10, ',kw', ({key} + 3) % 10) END AS keywords,
 CASE WHEN {ok} AND {key} % 6 = 5
   THEN concat({key} % 20, ',', ({key} + 4) % 20, ',', ({key} + 9) % 20) END AS category_ids,
 CASE WHEN {ok} THEN '3,2,0,4,1' END AS target_page_flow
 FROM customer"""


# Time slices of the replayed stream: slice i has (us - first) // width = i.
_SLICES = f"""{_ADS},
span AS (
  SELECT min(epoch_us(ts)) AS first_us, (max(epoch_us(ts)) - min(epoch_us(ts))) // 4 + 1 AS width FROM ad_clicks),
sliced AS (SELECT a.*, (epoch_us(ts) - first_us) // width AS slice FROM ad_clicks a, span)"""


# Readable lines of the replayed log, whose times are whole milliseconds.
_LINES = f"""{_ADS},
good AS (SELECT * REPLACE (make_timestamp(ts_ms * 1000) AS ts) FROM ad_clicks WHERE event_id % 10 NOT IN (3, 7)),
good_numbered AS (SELECT ts, user_id, row_number() OVER (PARTITION BY date, user_id, ad_id ORDER BY ts) AS n FROM good),
good_cutoffs AS (SELECT user_id, min(ts) AS cutoff FROM good_numbered WHERE n = 3 GROUP BY user_id),
good_kept AS (
  SELECT a.* FROM good a LEFT JOIN good_cutoffs c ON a.user_id = c.user_id WHERE c.cutoff IS NULL OR a.ts <= c.cutoff),
good_daily AS (SELECT date, user_id, ad_id, count(*) AS click_count FROM good_kept GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    ranged = "date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
    small_clicks = f"SELECT city_id, click_product_id AS product_id FROM actions WHERE {ranged} AND click_product_id IS NOT NULL"
    sql = {
        # sources and scans
        "scan_actions_by_date": f"WITH {_ACTIONS} {_ACTIONS_OUT} FROM actions WHERE {ranged}",
        "scan_stored_actions_by_date": f"WITH {_ACTIONS} {_ACTIONS_OUT} FROM actions WHERE {ranged}",
        "scan_stored_actions_of_task": f"WITH {_ACTIONS} {_ACTIONS_OUT} FROM actions WHERE date BETWEEN DATE '2024-01-06' AND DATE '2024-01-25'",
        "replace_stored_days": f"""WITH {_ACTIONS}
SELECT strftime(date, '%Y-%m-%d') AS date, CASE WHEN day(date) % 10 = 0 THEN page_id + 1 ELSE page_id END AS page_id, count(*) AS n
FROM actions GROUP BY 1, 2""",
        "scan_clicks_by_date": f"WITH {_ACTIONS} {small_clicks}",
        "scan_ctrl_a_text": f"WITH {_ACTIONS} {_ACTIONS_OUT} FROM actions",
        "parse_ad_log": f"""WITH {_ADS},
flagged AS (SELECT *, event_id % 10 = 3 AS short, event_id % 10 = 7 AS spoilt FROM ad_clicks)
SELECT event_id,
 CASE WHEN NOT short AND NOT spoilt THEN ts_ms END AS ts_ms,
 CASE WHEN NOT short AND NOT spoilt THEN province END AS province,
 CASE WHEN NOT short AND NOT spoilt THEN city END AS city,
 CASE WHEN NOT short AND NOT spoilt THEN user_id END AS user_id,
 CASE WHEN NOT short AND NOT spoilt THEN ad_id END AS ad_id,
 CASE WHEN short THEN concat(ts_ms, ' ', province, ' ', city, ' ', user_id)
  WHEN spoilt THEN concat(ts_ms, ' ', province, ' ', city, ' x ', ad_id) END AS reject
FROM flagged""",
        "parse_task_params": _task_param(),
        "scan_blacklist": f"WITH {_BLACK} SELECT user_id FROM black",
        "lookup_click_count": f"""WITH {_DAILY},
wanted AS (SELECT DISTINCT date, user_id, (ad_id + 1) % 10 AS ad_id FROM ad_clicks)
SELECT strftime(w.date, '%Y-%m-%d') AS date, w.user_id, w.ad_id, coalesce(d.click_count, 0) AS click_count
FROM wanted w LEFT JOIN daily d ON w.date = d.date AND w.user_id = d.user_id AND w.ad_id = d.ad_id""",
        # sinks
        "sink_append": f"""WITH {_PARTS} SELECT {_STAT_OUT} FROM
 (SELECT * FROM old_stat UNION ALL SELECT * FROM new_stat)""",
        "sink_upsert_replace": f"""WITH {_PARTS},
merged AS (SELECT * FROM new_stat UNION ALL SELECT o.* FROM old_stat o ANTI JOIN new_stat n
 ON o.date = n.date AND o.province = n.province AND o.city = n.city AND o.ad_id = n.ad_id)
SELECT {_STAT_OUT} FROM merged""",
        "sink_upsert_increment": f"""WITH {_PARTS},
merged AS (SELECT coalesce(o.date, n.date) AS date, coalesce(o.province, n.province) AS province,
  coalesce(o.city, n.city) AS city, coalesce(o.ad_id, n.ad_id) AS ad_id,
  coalesce(o.click_count, 0) + coalesce(n.click_count, 0) AS click_count
 FROM old_stat o FULL JOIN new_stat n
 ON o.date = n.date AND o.province = n.province AND o.city = n.city AND o.ad_id = n.ad_id)
SELECT {_STAT_OUT} FROM merged""",
        "sink_replace_group": f"""WITH {_PARTS},
old_p AS ({_province('old_stat')}), new_p AS ({_province('new_stat')}),
old_t AS ({_top3('old_p')}), new_t AS ({_top3('new_p')}),
merged AS (SELECT * FROM new_t UNION ALL
 SELECT * FROM old_t o WHERE NOT EXISTS (SELECT 1 FROM new_t n WHERE n.date = o.date AND n.province = o.province))
SELECT {_TOP_OUT} FROM merged""",
        # cells
        "cells_row_range": f"""WITH {_CELLS}, newest AS ({_latest('cells')})
SELECT row, value FROM newest WHERE {_RANGE} AND family = 'f1' AND qualifier = 'name'""",
        "cells_stored_row_range": f"""WITH {_CELLS}, newest AS ({_latest('cells')})
SELECT row, value FROM newest WHERE {_RANGE} AND family = 'f1' AND qualifier = 'name'""",
        "cells_stored_row_filter_le": f"WITH {_CELLS} SELECT DISTINCT row FROM cells WHERE row <= 'row0100'",
        "cells_stored_get": f"""WITH {_CELLS}, newest AS ({_latest('cells')})
SELECT row, ts, value FROM newest WHERE family = 'f1' AND qualifier = 'name' AND row = 'row770000000000'""",
        "cells_family_map": f"""WITH {_CELLS}, newest AS ({_latest('cells')})
SELECT row, qualifier, value FROM newest WHERE {_RANGE} AND family = 'f1'""",
        "cells_all_versions": f"WITH {_CELLS} SELECT row, family, qualifier, ts, value FROM cells WHERE {_RANGE}",
        "cells_row_filter_le": f"WITH {_CELLS} SELECT DISTINCT row FROM cells WHERE row <= 'row0100'",
        "cells_family_filter_lt": f"""WITH {_CELLS}, newest AS ({_latest('cells')})
SELECT row, family, qualifier, ts, value FROM newest WHERE family < 'f2'""",
        "cells_qualifier_eq": f"""WITH {_CELLS}
SELECT row, max(CASE WHEN family = 'f1' THEN value END) AS f1_id, max(CASE WHEN family = 'f2' THEN value END) AS f2_id,
 CAST(NULL AS VARCHAR) AS f2_name
FROM cells WHERE qualifier = 'id' GROUP BY row""",
        "cells_get": f"""WITH {_CELLS}, newest AS ({_latest('cells')})
SELECT row, ts, value FROM newest WHERE family = 'f1' AND qualifier = 'name' AND row IN
 (SELECT row FROM keyed WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'))""",
        "cells_put": f"""WITH {_CELLS},
written AS (SELECT * FROM cells UNION ALL
 SELECT row, 'f1', 'id', 5, concat(p_type, '/', p_size) FROM keyed)
{_latest('written')}""",
        # filters and labels
        "filter_age_between": f"WITH {_USERS} SELECT user_id, age FROM users WHERE age BETWEEN 20 AND 60",
        "filter_in_any": f"""WITH {_ACTIONS},{_USERS}
SELECT session_id,
 CAST(max(u.professional) IN {_PROFESSIONALS} AS BIGINT) AS professional_ok,
 CAST(max(u.city) IN {_CITY_NAMES} AS BIGINT) AS city_ok,
 CAST(count(*) FILTER (search_keyword IN {_KEYWORDS}) > 0 AS BIGINT) AS keyword_ok,
 CAST(count(*) FILTER (click_category_id IN {_CATEGORIES}) > 0 AS BIGINT) AS category_ok,
 CAST(1 AS BIGINT) AS absent_ok
FROM actions JOIN users u USING (user_id) GROUP BY session_id""",
        "filter_equal": f"WITH {_USERS} SELECT user_id, sex FROM users WHERE sex = 'male'",
        "session_filter": f"""WITH {_PASSING}
SELECT user_id, session_id, visit_length, step_length, strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') AS start_time,
 age, professional, city, sex FROM passing""",
        "bucket_visit_length": f"""WITH {_ROLLUP} SELECT session_id, visit_length, CASE
 {' '.join(f"WHEN {c} THEN '{n}'" for n, c in _VISIT.items())} END AS bucket FROM rollup""",
        "bucket_step_length": f"""WITH {_ROLLUP} SELECT session_id, step_length, CASE
 {' '.join(f"WHEN {c} THEN '{n}'" for n, c in _STEP.items())} END AS bucket FROM rollup""",
        "case_area_level": f"""WITH {_CITIES},{_BIG_CLICKS}
SELECT area, {_LEVEL} AS area_level, count(*) AS n FROM clicks JOIN cities USING (city_id) GROUP BY area""",
        "price_grade": """SELECT p_partkey AS part_id, p_brand AS brand,
 CASE WHEN p_retailprice - CAST(900 AS DOUBLE) >= 90 THEN 'A' WHEN p_retailprice - CAST(900 AS DOUBLE) >= 80 THEN 'B'
  WHEN p_retailprice - CAST(900 AS DOUBLE) >= 70 THEN 'C' WHEN p_retailprice - CAST(900 AS DOUBLE) >= 60 THEN 'D'
  ELSE 'E' END AS grade,
 CASE WHEN p_retailprice - CAST(900 AS DOUBLE) >= 80 THEN 'GOOD' ELSE 'BAD' END AS verdict,
 CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS BIGINT) AS rank_in_brand
FROM part""",
        "product_status_label": f"SELECT p_partkey AS product_id, {_STATUS} AS product_status FROM part",
        "quantity_surcharge": """SELECT l_returnflag, count(*) AS n_items,
 CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) + CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(0.05 AS DECIMAL(3,2))) AS DOUBLE)
  AS surcharged
FROM lineitem WHERE l_quantity > 25 GROUP BY l_returnflag""",
        "segment_slice": f"""WITH {_USERS}
SELECT DISTINCT CAST(age AS VARCHAR) AS age_text, sex FROM users
WHERE professional LIKE 'F%' AND age > 12 ORDER BY 1, 2""",
        # joins
        "join_session_user": f"""WITH {_ROLLUP},{_USERS}
SELECT {_SESSION_OUT}, age, professional, city, sex FROM sessions JOIN users USING (user_id)""",
        "session_detail": f"WITH {_PASSING} {_ACTIONS_OUT} FROM detail",
        "join_click_city": f"""WITH {_ACTIONS},{_CITIES}
SELECT city_id, city_name, area, click_product_id AS product_id FROM actions JOIN cities USING (city_id) WHERE click_product_id IS NOT NULL""",
        "skewed_join_click_city": f"""WITH {_CITIES},{_BIG_CLICKS}
SELECT city_id, city_name, area, product_id FROM clicks JOIN cities USING (city_id)""",
        "skewed_join_session_user": f"""WITH {_ROLLUP},{_USERS}
SELECT session_id, user_id, visit_length, step_length, strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') AS start_time,
 age, professional, city, sex FROM sessions JOIN users USING (user_id)""",
        "join_product_info": f"WITH {_AREA_COUNTS} SELECT * FROM full_counts",
        "blacklist_filter": f"""WITH {_BLACK} SELECT {_CLICK_OUT} FROM ad_clicks
WHERE user_id NOT IN (SELECT user_id FROM black)""",
        # aggregations
        "session_rollup": f"WITH {_ROLLUP} SELECT {_SESSION_OUT} FROM sessions",
        "session_aggr_stat": f"WITH {_PASSING} SELECT count(*) AS session_count, {_STAT_COLUMNS} FROM passing",
        "page_split_pv": f"WITH {_PAIRS},{_rates()} SELECT CAST(step AS BIGINT) AS step, page_split, pv FROM pv",
        "start_page_pv": f"WITH {_ACTIONS} SELECT count(*) AS start_page_pv FROM actions WHERE page_id = 3",
        "page_convert_rate": f"WITH {_PAIRS},{_rates()} SELECT step, page_split, convert_rate FROM rates",
        "page_convert_rate_string": f"""WITH {_PAIRS},{_rates()}
SELECT string_agg(concat(page_split, '=', coalesce(CAST(convert_rate AS VARCHAR), 'null')), '|' ORDER BY step) AS convert_rate
FROM rates""",
        "area_product_count": f"WITH {_AREA_COUNTS} SELECT area, product_id, click_count, city_infos FROM area_counts",
        "group_concat_distinct": f"""WITH {_CITIES},{_BIG_CLICKS},
d AS (SELECT DISTINCT product_id, city_id, city_name FROM clicks JOIN cities USING (city_id))
SELECT product_id, string_agg(city_name, ',' ORDER BY city_id) AS city_names FROM d GROUP BY product_id""",
        "daily_user_ad_count": f"""WITH {_DAILY}
SELECT strftime(date, '%Y-%m-%d') AS date, user_id, ad_id, click_count FROM daily""",
        "ad_stat": f"WITH {_ADS}, s AS ({_stat('ad_clicks')}) SELECT {_STAT_OUT} FROM s",
        "province_ad_count": f"WITH {_ADS}, s AS ({_stat('ad_clicks')}), p AS ({_province('s')}) SELECT {_TOP_OUT} FROM p",
        "ad_click_trend": f"WITH {_ADS} {_TREND}",
        "ad_click_trend_last_hour": f"WITH {_ADS} {_TREND}".replace(
            "FROM ad_clicks GROUP",
            """FROM ad_clicks WHERE date_trunc('minute', ts) > (
 SELECT date_trunc('minute', max(ts)) - INTERVAL '60 minutes' FROM ad_clicks) GROUP""",
        ),
        "blacklist_users": f"WITH {_BLACK} SELECT user_id FROM black",
        "category_counts": f"WITH {_PASSING},{_CATEGORY_COUNTS} SELECT * FROM categories",
        # windows, top lists, sets
        "area_top3": f"""WITH {_AREA_COUNTS}
SELECT product_id, area, click_count, city_infos, product_name, product_status, {_LEVEL} AS area_level FROM (
 SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS r FROM full_counts) WHERE r <= 3""",
        "province_top3": f"""WITH {_ADS}, s AS ({_stat('ad_clicks')}), p AS ({_province('s')}), t AS ({_top3('p')})
SELECT {_TOP_OUT} FROM t""",
        "page_pairs": f"""WITH {_PAIRS} SELECT session_id, event_id, page_id, previous_page_id,
 strftime(action_time, '%Y-%m-%d %H:%M:%S.%f') AS action_time FROM pairs""",
        "top10_category": f"WITH {_PASSING},{_CATEGORY_COUNTS} SELECT * FROM top_categories",
        "top10_session": f"WITH {_PASSING},{_CATEGORY_COUNTS} SELECT * FROM top_sessions",
        "session_random_extract": f"""WITH {_ROLLUP},{_extract('sessions')}
SELECT session_id, strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') AS start_time, search_keywords, click_category_ids FROM picked""",
        "sort_actions": f"""WITH {_ACTIONS}
SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY action_sec, event_id) AS action_no,
 event_id, page_id, strftime(action_time, '%Y-%m-%d %H:%M:%S.%f') AS action_time FROM actions""",
        "distinct_users": "SELECT DISTINCT user_id FROM events",
        # functions as table-wide jobs
        "normalize_actions": f"WITH {_ACTIONS} {_ACTIONS_OUT} FROM actions",
        "legacy_record_recode": """WITH r AS (
  SELECT event_id, event_type, user_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
f AS (SELECT *, CASE WHEN event_type = 'view' THEN concat('kw', k % 10) ELSE '' END AS kw,
  concat(k % 20, ',', (k + 7) % 20) AS cats FROM r)
SELECT event_id, nullif(kw, '') AS search_keywords, cats AS click_category_ids, CAST(user_id % 60 AS VARCHAR) AS age,
 concat('sessionid=', event_id, '|searchKeywords=', kw, '|clickCategoryIds=', cats, '|age=0') AS without_age,
 concat('sessionid=', event_id, '|searchKeywords=', kw, '|clickCategoryIds=', cats, '|age=', user_id % 60) AS unchanged,
 strftime(ts, '%Y%m%d') AS key_date, CAST(user_id AS VARCHAR) AS key_user, CAST(k % 10 AS VARCHAR) AS key_ad
FROM f""",
        "action_time_features": f"""WITH {_ACTIONS},
l AS (SELECT event_id, user_id, action_sec, action_time,
  lag(action_sec) OVER w AS previous_sec, lag(action_time) OVER w AS previous_time
  FROM actions WINDOW w AS (PARTITION BY user_id ORDER BY action_sec, event_id))
SELECT event_id, user_id, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS time_text,
 strftime(previous_time, '%Y-%m-%d %H:%M:%S') AS previous_time,
 CAST(coalesce(action_sec > previous_sec, FALSE) AS BIGINT) AS is_after_previous,
 CAST(coalesce(action_sec < previous_sec, FALSE) AS BIGINT) AS is_before_previous,
 coalesce(action_sec - previous_sec, 0) AS gap_seconds,
 strftime(action_time, '%Y-%m-%d') AS date_text, strftime(action_time, '%Y-%m-%d_%H') AS hour_key,
 strftime(action_time, '%Y%m%d') AS date_key, strftime(action_time, '%Y%m%d%H%M') AS minute_key,
 strftime(action_time, '%Y-%m-%d') AS date_of_key
FROM l""",
        "json_extract": """SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS absent,
 json_extract_string(props, '$.k') AS first_item_k, CAST(NULL AS VARCHAR) AS malformed FROM events""",
        "skew_salted_count": """SELECT l_partkey AS product_id, count(*) AS click_count
FROM lineitem GROUP BY l_partkey""",
        # event time and streaming
        "blacklist_cutoff": f"WITH {_CUTOFF} SELECT {_CLICK_OUT} FROM kept",
        "sliding_hour": f"""WITH {_ADS},
moved AS (SELECT ad_id, time_bucket(INTERVAL '10 minutes', ts) - i * INTERVAL '10 minutes' AS s
 FROM ad_clicks, range(6) t(i))
SELECT strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
 strftime(s + INTERVAL '60 minutes', '%Y-%m-%d %H:%M:%S.%f') AS window_end, ad_id, count(*) AS click_count
FROM moved GROUP BY s, ad_id""",
        "stream_ad_stat": f"WITH {_ADS}, s AS ({_stat('ad_clicks')}) SELECT {_STAT_OUT} FROM s",
        # Slice 1 arrives after slice 2, when all its days are closed: its rows are dropped.
        "stream_late_data": f"WITH {_SLICES}, s AS ({_stat('sliced', 'slice <> 1')}) SELECT {_STAT_OUT} FROM s",
        "stream_blacklist": f"WITH {_BLACK} SELECT user_id FROM black",
        "stream_blacklist_filter": f"""WITH {_BLACK}
SELECT user_id, province, city, ad_id,
 strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S.%f') AS ts
FROM ad_clicks WHERE user_id NOT IN (SELECT user_id FROM black)""",
        "stream_blacklist_cutoff": f"""WITH {_LINES.replace('WHERE event_id % 10 NOT IN (3, 7)', '')}
SELECT user_id, province, city, ad_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM good_kept""",
        "stream_province_top3": f"""WITH {_ADS}, s AS ({_stat('ad_clicks')}), p AS ({_province('s')}), t AS ({_top3('p')})
SELECT {_TOP_OUT} FROM t""",
        "stream_click_trend": f"WITH {_ADS} {_TREND}",
        # end to end
        "pipeline_session": f"""WITH {_TASK_SESSIONS},{_CATEGORY_COUNTS},{_extract('passing')},
picked_keywords AS (
 SELECT session_id, string_agg(search_keyword, ',' ORDER BY search_keyword) AS kws
 FROM (SELECT DISTINCT session_id, search_keyword FROM detail WHERE search_keyword IS NOT NULL) GROUP BY session_id)
{_STAT_ROWS}
 UNION ALL SELECT 'detail', session_id, NULL, count(*), NULL, NULL, NULL FROM detail GROUP BY session_id
 UNION ALL SELECT 'top10_category', CAST(category_id AS VARCHAR), NULL, click_count, order_count, pay_count, NULL FROM top_categories
 UNION ALL SELECT 'top10_session', session_id, CAST(category_id AS VARCHAR), click_count, NULL, NULL, NULL FROM top_sessions
 UNION ALL SELECT 'random_extract', session_id, coalesce(kws, ''), start_sec, NULL, NULL, NULL
  FROM picked LEFT JOIN picked_keywords USING (session_id)""",
        "pipeline_funnel": f"""WITH {_PAIRS.replace('FROM actions)', "FROM actions WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-27')")},{_rates()}
SELECT step, page_split, convert_rate FROM rates""",
        "pipeline_area_top3": f"""WITH {_AREA_COUNTS}
SELECT area, {_LEVEL} AS area_level, product_id, click_count, city_infos, product_name, product_status FROM (
 SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS r FROM full_counts) WHERE r <= 3""",
        "pipeline_ads": f"""WITH {_CUTOFF}, s AS ({_stat('kept')}), p AS ({_province('s')}), t AS ({_top3('p')}),
trend AS ({_TREND})
SELECT 'blacklist' AS section, CAST(NULL AS VARCHAR) AS date, CAST(NULL AS VARCHAR) AS province, CAST(NULL AS VARCHAR) AS city,
 CAST(NULL AS VARCHAR) AS hour, CAST(NULL AS VARCHAR) AS minute, user_id, CAST(NULL AS BIGINT) AS ad_id,
 CAST(NULL AS BIGINT) AS click_count FROM black
UNION ALL SELECT 'ad_stat', strftime(date, '%Y-%m-%d'), province, city, NULL, NULL, NULL, ad_id, click_count FROM s
UNION ALL SELECT 'province_top3', strftime(date, '%Y-%m-%d'), province, NULL, NULL, NULL, NULL, ad_id, click_count FROM t
UNION ALL SELECT 'click_trend', date, NULL, NULL, hour, minute, NULL, ad_id, click_count FROM trend""",
        "lookup_click_count_stream": f"""WITH {_LINES},
wanted AS (SELECT DISTINCT date, user_id, (ad_id + 1) % 10 AS ad_id FROM ad_clicks)
SELECT strftime(w.date, '%Y-%m-%d') AS date, w.user_id, w.ad_id, coalesce(d.click_count, 0) AS click_count
FROM wanted w LEFT JOIN good_daily d ON w.date = d.date AND w.user_id = d.user_id AND w.ad_id = d.ad_id""",
        "pipeline_ads_stream": f"""WITH {_LINES}, s AS ({_stat('good_kept')}), p AS ({_province('s')}), t AS ({_top3('p')}),
trend AS ({_TREND.replace('ad_clicks', 'good')})
SELECT 'blacklist' AS section, CAST(NULL AS VARCHAR) AS date, CAST(NULL AS VARCHAR) AS province, CAST(NULL AS VARCHAR) AS city,
 CAST(NULL AS VARCHAR) AS hour, CAST(NULL AS VARCHAR) AS minute, user_id, CAST(NULL AS BIGINT) AS ad_id,
 CAST(NULL AS BIGINT) AS click_count, strftime(cutoff, '%Y-%m-%d %H:%M:%S.%f') AS cutoff FROM good_cutoffs
UNION ALL SELECT 'user_counts', strftime(date, '%Y-%m-%d'), NULL, NULL, NULL, NULL, user_id, ad_id, click_count, NULL FROM good_daily
UNION ALL SELECT 'ad_stat', strftime(date, '%Y-%m-%d'), province, city, NULL, NULL, NULL, ad_id, click_count, NULL FROM s
UNION ALL SELECT 'province_top3', strftime(date, '%Y-%m-%d'), province, NULL, NULL, NULL, NULL, ad_id, click_count, NULL FROM t
UNION ALL SELECT 'click_trend', date, NULL, NULL, hour, minute, NULL, ad_id, click_count, NULL FROM trend
UNION ALL SELECT 'rejects', NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*), NULL FROM ad_clicks WHERE event_id % 10 IN (3, 7)
UNION ALL SELECT 'late', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0, NULL""",
        "task_area_top3": " UNION ALL ".join(
            f"""(WITH {_ACTIONS},{_CITIES},
c AS (SELECT city_id, click_product_id AS product_id FROM actions
 WHERE date BETWEEN DATE '2024-01-{task % 10 + 1:02d}' AND DATE '2024-01-{task % 10 + 20:02d}' AND click_product_id IS NOT NULL),
placed AS (SELECT area, product_id, city_id, city_name FROM c JOIN cities USING (city_id)),
lists AS (SELECT area, product_id, string_agg(concat(city_id, ':', city_name), ',' ORDER BY city_id) AS city_infos
 FROM (SELECT DISTINCT * FROM placed) GROUP BY ALL),
sums AS (SELECT area, product_id, count(*) AS click_count FROM placed GROUP BY ALL),
counts AS (SELECT s.*, city_infos, p_name AS product_name, {_STATUS} AS product_status
 FROM sums s JOIN lists USING (area, product_id) JOIN part ON s.product_id = p_partkey)
SELECT CAST({task} AS BIGINT) AS task_id, area, {_LEVEL} AS area_level, product_id, click_count, city_infos, product_name, product_status FROM (
 SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS r FROM counts) WHERE r <= 3)"""
            for task in (3, 8)
        ),
        "task_convert_rates": f"""WITH {_PAIRS.replace('FROM acts)', "FROM acts WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-27')")},{_rates()}
SELECT CAST(7 AS BIGINT) AS task_id,
 string_agg(concat(page_split, '=', coalesce(CAST(convert_rate AS VARCHAR), 'null')), '|' ORDER BY step) AS convert_rate
FROM rates""",
        "task_session_stat": f"WITH {_TASK_SESSIONS} SELECT CAST(5 AS BIGINT) AS task_id, count(*) AS session_count, {_STAT_COLUMNS} FROM passing",
        "rejected_lines": f"""WITH {_ACTIONS},{_ADS}
SELECT 'export' AS source, concat_ws(chr(1), event_id, strftime(date, '%Y-%m-%d'), user_id, session_id, page_id,
 strftime(action_time, '%Y-%m-%d %H:%M:%S'), coalesce(search_keyword, 'null'), coalesce(CAST(click_category_id AS VARCHAR), 'null'),
 coalesce(CAST(click_product_id AS VARCHAR), 'null'), coalesce(order_category_ids, 'null'), coalesce(order_product_ids, 'null'),
 coalesce(pay_category_ids, 'null'), coalesce(pay_product_ids, 'null')) AS value FROM actions WHERE event_id % 7 = 0
UNION ALL SELECT 'log', CASE event_id % 10 WHEN 3 THEN concat(ts_ms, ' ', province, ' ', city, ' ', user_id)
 ELSE concat(ts_ms, ' ', province, ' ', city, ' x ', ad_id) END FROM ad_clicks WHERE event_id % 10 IN (3, 7)""",
        "unreadable_actions": """SELECT CAST(event_id AS VARCHAR) AS event_id, 'user_id' AS column, 'nobody' AS value FROM events WHERE event_id % 11 = 0
UNION ALL SELECT CAST(event_id AS VARCHAR), 'action_time', '2024-13-01 5:00:00' FROM events WHERE event_id % 13 = 0
UNION ALL SELECT CAST(event_id AS VARCHAR), 'pay_category_ids', unnest(['x', '']) FROM events WHERE event_id % 17 = 0""",
    }
    return sql
