"""Every operator as a named query ``(spark, folder) -> DataFrame``.

Results leave through :func:`edge`, which turns dates, times and lists into
text and whole numbers into bigint, so that any SQL engine can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import labels
from footfall.operators import ads, catalogue, cells, criteria, funnel, merges, products, recode, skew_joins
from footfall.operators import sessions as sess
from footfall.operators.criteria import Criteria
from footfall.plans.ad_report import ad_report
from footfall.plans import task_results
from footfall.plans.area_top_products import area_top_products
from footfall.plans.page_funnel import page_funnel
from footfall.plans.session_report import session_report
from footfall.session import scratch, tune
from footfall.sinks import writers
from footfall.sources import action_table, ad_log, cell_table, fixtures, readers, tasks
from footfall.sources.schemas import ACTIONS_WITH_ID
from footfall.streaming import ad_jobs, ad_pipeline, arrivals, cutoff

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries. The oracle SQL states the same values.
DATES = ("2024-01-05", "2024-01-20")
CRITERIA = Criteria(
    start_age=20,
    end_age=60,
    professionals=["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"],
    cities=[f"city{i}" for i in range(20)],
    sex="male",
    keywords=["kw1", "kw3", "kw5", "kw7"],
    category_ids=[1, 2, 4, 5, 7, 10, 13, 16, 19],
)
FLOW = [3, 2, 0, 4, 1]
PER_DAY = 4
THRESHOLD = 3
SESSION_TASK = 5
FUNNEL_TASK = 7
START_ROW, STOP_ROW, LAST_ROW = "row5000", "row8000", "row0100"
GET_ROW = "row770000000000"  # of part 77

_REGISTRY: dict[str, Query] = {}


def edge(df: DataFrame) -> DataFrame:
    def convert(field: T.StructField) -> str:
        column, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, T.DateType):
            return f"date_format({column}, 'yyyy-MM-dd') AS {column}"
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return f"date_format({column}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {column}"
        if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            return f"CAST({column} AS BIGINT) AS {column}"
        if isinstance(kind, T.ArrayType):
            return f"array_join(CAST({column} AS ARRAY<STRING>), ',') AS {column}"
        return column

    return df.selectExpr(*[convert(field) for field in df.schema.fields])


def query(function: Query) -> Query:
    """Register under the function's own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return edge(function(tune(spark), folder))

    run.__name__ = function.__name__
    _REGISTRY[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- sources and scans -----------------------------------------------------------------


@query
def scan_actions_by_date(spark, folder):
    start, end = DATES
    return readers.actions_by_date(fixtures.actions(spark, folder, start, end), start, end)


@query
def scan_clicks_by_date(spark, folder):
    start, end = DATES
    return readers.clicks_by_date(fixtures.actions(spark, folder, start, end), start, end)


def _stored_actions(spark, folder) -> str:
    path = scratch(spark, "stored-actions")
    action_table.write_actions(fixtures.actions(spark, folder), path)
    return path


@query
def scan_stored_actions_by_date(spark, folder):
    """The range of ``scan_actions_by_date``, from the table that is stored by day."""
    return readers.actions_by_date(action_table.read_actions(spark, _stored_actions(spark, folder)), *DATES)


@query
def scan_stored_actions_of_task(spark, folder):
    """Actions on the days of one saved task: the days are found while the query runs and choose the folders."""
    stored = action_table.read_actions(spark, _stored_actions(spark, folder))
    params = tasks.parse_params(fixtures.tasks(spark, folder).where(F.col("task_id") == SESSION_TASK))
    return action_table.actions_on_days(stored, action_table.days_of_tasks(params))


@query
def replace_stored_days(spark, folder):
    """Actions by day and page after every tenth day was written anew, moved to the next page."""
    path = _stored_actions(spark, folder)
    moved = fixtures.actions(spark, folder).where("day(date) % 10 = 0").withColumn("page_id", F.col("page_id") + 1)
    action_table.replace_days(moved, path)
    after = action_table.read_actions(spark, path)
    return after.groupBy("date", "page_id").agg(F.count(F.lit(1)).alias("n"))


@query
def scan_ctrl_a_text(spark, folder):
    path = scratch(spark, "actions-text")
    readers.write_delimited_text(fixtures.actions(spark, folder), path)
    return readers.delimited_text(spark, path, ACTIONS_WITH_ID)


@query
def parse_ad_log(spark, folder):
    return ad_log.parse(fixtures.ad_lines(spark, folder))


@query
def parse_task_params(spark, folder):
    return tasks.parse_params(fixtures.tasks(spark, folder))


@query
def scan_blacklist(spark, folder):
    # As appended without a check: one row per day and ad on which a user reached the threshold.
    daily = ads.daily_user_ad_count(fixtures.ad_clicks(spark, folder))
    path = scratch(spark, "blacklist")
    reached = daily.where(F.col("click_count") >= THRESHOLD).select("user_id")
    writers.append(reached, path)
    return readers.blacklist(spark.read.parquet(path))


@query
def lookup_click_count(spark, folder):
    clicks = fixtures.ad_clicks(spark, folder)
    next_ad = ((F.col("ad_id") + 1) % 10).alias("ad_id")
    wanted = clicks.select(F.to_date("ts").alias("date"), "user_id", next_ad).distinct()
    return ads.lookup_click_count(wanted, ads.daily_user_ad_count(clicks))


# --- sinks -----------------------------------------------------------------------------


def _stat_parts(spark, folder):
    """Daily ad counts until the 20th, and those from the 15th on (twice as large)."""
    old = ads.ad_stat(fixtures.ad_clicks(spark, folder, end="2024-01-20"))
    new = ads.ad_stat(fixtures.ad_clicks(spark, folder, start="2024-01-15"))
    return old, new.withColumn("click_count", F.col("click_count") * 2)


@query
def sink_append(spark, folder):
    path = scratch(spark, "ad-stat")
    old, new = _stat_parts(spark, folder)
    writers.append(old, path)
    writers.append(new, path)
    return spark.read.parquet(path)


@query
def sink_upsert_replace(spark, folder):
    return merges.upsert_replace(*_stat_parts(spark, folder), ad_jobs.AD_STAT_KEYS)


@query
def sink_upsert_increment(spark, folder):
    return merges.upsert_increment(*_stat_parts(spark, folder), ad_jobs.AD_STAT_KEYS)


@query
def sink_replace_group(spark, folder):
    old, new = (
        ads.province_top3(ads.province_ad_count(part)) for part in _stat_parts(spark, folder)
    )
    return merges.replace_group(old, new, ["date", "province"])


# --- cells -----------------------------------------------------------------------------


@query
def cells_row_range(spark, folder):
    part = cells.row_range(fixtures.cells(spark, folder), START_ROW, STOP_ROW)
    return cells.latest(cells.column(part, "f1", "name")).select("row", "value")


def _stored_cells(spark, folder) -> DataFrame:
    path = scratch(spark, "stored-cells")
    cell_table.write_cells(fixtures.cells(spark, folder), path)
    return cell_table.read_cells(spark, path)


@query
def cells_stored_row_range(spark, folder):
    """``cells_row_range`` on the table stored in key order."""
    part = cells.row_range(_stored_cells(spark, folder), START_ROW, STOP_ROW)
    return cells.latest(cells.column(part, "f1", "name")).select("row", "value")


@query
def cells_stored_row_filter_le(spark, folder):
    return cells.row_at_most(_stored_cells(spark, folder), LAST_ROW).select("row").distinct()


@query
def cells_stored_get(spark, folder):
    """A point get, on the table stored in key order."""
    return cells.get_row(_stored_cells(spark, folder), GET_ROW, "f1", "name").select("row", "ts", "value")


@query
def cells_family_map(spark, folder):
    part = cells.row_range(fixtures.cells(spark, folder), START_ROW, STOP_ROW)
    mapped = cells.family_map(part, "f1")
    return mapped.select("row", F.explode("columns").alias("qualifier", "value"))


@query
def cells_all_versions(spark, folder):
    return cells.row_range(fixtures.cells(spark, folder), START_ROW, STOP_ROW)


@query
def cells_row_filter_le(spark, folder):
    return cells.row_at_most(fixtures.cells(spark, folder), LAST_ROW).select("row").distinct()


@query
def cells_family_filter_lt(spark, folder):
    return cells.latest(cells.family_below(fixtures.cells(spark, folder), "f2"))


@query
def cells_qualifier_eq(spark, folder):
    wanted = ["f1_id", "f2_id", "f2_name"]
    return cells.qualifier_equals(fixtures.cells(spark, folder), "id", wanted)


@query
def cells_get(spark, folder):
    # The rows of all parts that were ever returned.
    items = readers.table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    rows = items.select("l_partkey").distinct().selectExpr(f"{fixtures.row_key('l_partkey')} AS row")
    found = cells.get_rows(fixtures.cells(spark, folder), rows, "f1", "name")
    return found.select("row", "ts", "value")


@query
def cells_put(spark, folder):
    stored = fixtures.cells(spark, folder)
    repriced = readers.table(spark, folder, "part").selectExpr(
        f"{fixtures.row_key('p_partkey')} AS row",
        "'f1' AS family",
        "'id' AS qualifier",
        "5L AS ts",
        "concat(p_type, '/', p_size) AS value",
    )
    return cells.latest(cells.put(stored, repriced))


# --- filters and labels ----------------------------------------------------------------


@query
def filter_age_between(spark, folder):
    users = fixtures.users(spark, folder)
    kept = users.where(criteria.age_between(F.col("age"), CRITERIA.start_age, CRITERIA.end_age))
    return kept.select("user_id", "age")


@query
def filter_in_any(spark, folder):
    rolled = sess.session_rollup(fixtures.actions(spark, folder))
    joined = sess.join_session_user(rolled, fixtures.users(spark, folder))
    return joined.select(
        "session_id",
        criteria.in_any(F.col("professional"), CRITERIA.professionals).alias("professional_ok"),
        criteria.in_any(F.col("city"), CRITERIA.cities).alias("city_ok"),
        criteria.list_in_any(F.col("search_keywords"), CRITERIA.keywords).alias("keyword_ok"),
        criteria.list_in_any(F.col("click_category_ids"), CRITERIA.category_ids).alias("category_ok"),
        criteria.in_any(F.col("city"), None).alias("absent_ok"),
    )


@query
def filter_equal(spark, folder):
    users = fixtures.users(spark, folder)
    return users.where(criteria.equals(F.col("sex"), CRITERIA.sex)).select("user_id", "sex")


def _passing(spark, folder):
    actions, users = fixtures.actions(spark, folder), fixtures.users(spark, folder)
    return actions, sess.session_filter(actions, users, CRITERIA)


@query
def session_filter(spark, folder):
    return _passing(spark, folder)[1]


@query
def bucket_visit_length(spark, folder):
    return sess.visit_buckets(sess.session_measures(fixtures.actions(spark, folder)))


@query
def bucket_step_length(spark, folder):
    return sess.step_buckets(sess.session_measures(fixtures.actions(spark, folder)))


@query
def case_area_level(spark, folder):
    clicks, cities = fixtures.product_clicks(spark, folder), fixtures.cities(spark, folder)
    levels = products.join_click_city(clicks, cities).select(
        "area", labels.area_level(F.col("area")).alias("area_level")
    )
    return levels.groupBy("area", "area_level").agg(F.count(F.lit(1)).alias("n"))


@query
def price_grade(spark, folder):
    return catalogue.price_grade(readers.table(spark, folder, "part"))


@query
def product_status_label(spark, folder):
    info = fixtures.products(spark, folder)
    return info.select(
        "product_id", labels.product_status(F.col("extend_info")).alias("product_status")
    )


@query
def quantity_surcharge(spark, folder):
    return catalogue.quantity_surcharge(readers.table(spark, folder, "lineitem"))


@query
def segment_slice(spark, folder):
    users = fixtures.users(spark, folder).withColumn("age_text", F.col("age").cast("string"))
    return catalogue.segment_slice(users, "F", 12)


# --- joins -----------------------------------------------------------------------------


@query
def join_session_user(spark, folder):
    rolled = sess.session_rollup(fixtures.actions(spark, folder))
    return sess.join_session_user(rolled, fixtures.users(spark, folder))


@query
def session_detail(spark, folder):
    return sess.session_detail(*_passing(spark, folder))


@query
def join_click_city(spark, folder):
    clicks = readers.clicks(fixtures.actions(spark, folder))
    return products.join_click_city(clicks, fixtures.cities(spark, folder))


@query
def skewed_join_click_city(spark, folder):
    """Every click of the big click table with its city, city keys salted where they are heavy."""
    clicks = fixtures.product_clicks(spark, folder)
    cities = fixtures.cities(spark, folder).select("city_id", "city_name", "area")
    joined = skew_joins.salted_join(clicks, cities, "city_id", ["row_id", "product_id"])
    return joined.select("city_id", "city_name", "area", "product_id")


@query
def skewed_join_session_user(spark, folder):
    """Sessions with their user's attributes, heavy users salted."""
    measures = sess.session_measures(fixtures.actions(spark, folder))
    users = fixtures.users(spark, folder).select("user_id", "age", "professional", "city", "sex")
    return skew_joins.salted_join(measures, users, "user_id", ["session_id"], share=0.0005)


@query
def join_product_info(spark, folder):
    counts = products.area_product_count(
        fixtures.product_clicks(spark, folder), fixtures.cities(spark, folder)
    )
    return products.join_product_info(counts, fixtures.products(spark, folder))


@query
def blacklist_filter(spark, folder):
    clicks = fixtures.ad_clicks(spark, folder)
    listed = ads.blacklist_users(ads.daily_user_ad_count(clicks), THRESHOLD)
    return ads.blacklist_filter(clicks, listed)


# --- aggregations ----------------------------------------------------------------------


@query
def session_rollup(spark, folder):
    return sess.session_rollup(fixtures.actions(spark, folder))


@query
def session_aggr_stat(spark, folder):
    return sess.session_aggr_stat(_passing(spark, folder)[1])


@query
def page_split_pv(spark, folder):
    return funnel.page_split_pv(funnel.page_pairs(fixtures.actions(spark, folder)), FLOW)


@query
def start_page_pv(spark, folder):
    return funnel.start_page_pv(fixtures.actions(spark, folder), FLOW)


@query
def page_convert_rate(spark, folder):
    return funnel.page_convert_rate(funnel.page_pairs(fixtures.actions(spark, folder)), FLOW)


@query
def page_convert_rate_string(spark, folder):
    return funnel.page_convert_rate_string(page_convert_rate(spark, folder))


@query
def area_product_count(spark, folder):
    return products.area_product_count(
        fixtures.product_clicks(spark, folder), fixtures.cities(spark, folder)
    )


@query
def group_concat_distinct(spark, folder):
    clicks = fixtures.product_clicks(spark, folder)
    placed = products.join_click_city(clicks, fixtures.cities(spark, folder))
    return products.group_concat_distinct(
        placed, ["product_id"], F.col("city_id"), F.col("city_name"), "city_names"
    )


@query
def daily_user_ad_count(spark, folder):
    return ads.daily_user_ad_count(fixtures.ad_clicks(spark, folder))


@query
def ad_stat(spark, folder):
    return ads.ad_stat(fixtures.ad_clicks(spark, folder))


@query
def province_ad_count(spark, folder):
    return ads.province_ad_count(ad_stat(spark, folder))


@query
def ad_click_trend(spark, folder):
    return ads.ad_click_trend(fixtures.ad_clicks(spark, folder))


@query
def ad_click_trend_last_hour(spark, folder):
    return ads.ad_click_trend(ads.last_minutes(fixtures.ad_clicks(spark, folder)))


@query
def blacklist_users(spark, folder):
    return ads.blacklist_users(daily_user_ad_count(spark, folder), THRESHOLD)


@query
def category_counts(spark, folder):
    return sess.category_counts(sess.session_detail(*_passing(spark, folder)))


# --- windows, top lists, sets ----------------------------------------------------------


@query
def area_top3(spark, folder):
    return products.area_top3(join_product_info(spark, folder))


@query
def province_top3(spark, folder):
    return ads.province_top3(province_ad_count(spark, folder))


@query
def page_pairs(spark, folder):
    return funnel.page_pairs(fixtures.actions(spark, folder))


@query
def top10_category(spark, folder):
    return sess.top10_category(category_counts(spark, folder))


@query
def top10_session(spark, folder):
    detail = sess.session_detail(*_passing(spark, folder))
    return sess.top10_session(detail, sess.top10_category(sess.category_counts(detail)))


@query
def session_random_extract(spark, folder):
    actions = fixtures.actions(spark, folder)
    picked = sess.session_random_extract(sess.session_measures(actions), PER_DAY)
    return sess.extract_report(actions, picked)


@query
def sort_actions(spark, folder):
    numbered = sess.sort_actions(fixtures.actions(spark, folder))
    return numbered.select("session_id", "action_no", "event_id", "page_id", "action_time")


@query
def distinct_users(spark, folder):
    return ads.distinct_users(fixtures.ad_clicks(spark, folder))


# --- functions as table-wide jobs ------------------------------------------------------


@query
def normalize_actions(spark, folder):
    return recode.normalize_actions(fixtures.actions_raw(spark, folder))


@query
def unreadable_actions(spark, folder):
    """Values that cannot be read, of raw actions in which some times, users and payments were spoilt."""
    raw = fixtures.actions_raw(spark, folder)
    event = "bigint(event_id)"
    spoilt = raw.selectExpr(
        *[
            {
                "user_id": f"if({event} % 11 = 0, 'nobody', user_id) AS user_id",
                "action_time": f"if({event} % 13 = 0, '2024-13-01 5:00:00', action_time) AS action_time",
                "pay_category_ids": f"if({event} % 17 = 0, ',3,x,,', pay_category_ids) AS pay_category_ids",
            }.get(name, name)
            for name in raw.columns
        ]
    )
    return recode.unreadable(spoilt)


@query
def legacy_record_recode(spark, folder):
    return recode.legacy_record_recode(fixtures.records(spark, folder))


@query
def action_time_features(spark, folder):
    return sess.action_time_features(fixtures.actions(spark, folder))


@query
def json_extract(spark, folder):
    return recode.json_extract(readers.table(spark, folder, "events"))


@query
def skew_salted_count(spark, folder):
    return products.salted_count(fixtures.product_clicks(spark, folder), "product_id", "row_id")


# --- event time and streaming ----------------------------------------------------------


@query
def blacklist_cutoff(spark, folder):
    return ads.blacklist_cutoff(fixtures.ad_clicks(spark, folder), THRESHOLD)


@query
def sliding_hour(spark, folder):
    return ads.sliding_counts(fixtures.ad_clicks(spark, folder), "60 minutes", "10 minutes")


def _replay(spark, folder, label, start, order=(0, 1, 2, 3)):
    """Run a streaming job over arriving slices; gives the job's folder."""
    base = scratch(spark, label)
    clicks = fixtures.ad_clicks(spark, folder)
    arrivals.replay(clicks, lambda lines: start(lines, base, f"{base}/checkpoint"), order)
    return base


@query
def stream_ad_stat(spark, folder):
    base = _replay(
        spark,
        folder,
        "stream-ad-stat",
        lambda lines, base, checkpoint: ad_jobs.start_ad_stat(
            lines, f"{base}/stat", checkpoint, arrivals.AVAILABLE_NOW
        ),
    )
    return ad_jobs.read_ad_stat(spark, f"{base}/stat")


@query
def stream_late_data(spark, folder):
    base = _replay(
        spark,
        folder,
        "stream-late",
        lambda lines, base, checkpoint: ad_jobs.start_ad_stat(
            lines, f"{base}/stat", checkpoint, arrivals.AVAILABLE_NOW
        ),
        order=(0, 2, 1, 3),
    )
    return ad_jobs.read_ad_stat(spark, f"{base}/stat")


@query
def stream_blacklist(spark, folder):
    base = _replay(
        spark,
        folder,
        "stream-blacklist",
        lambda lines, base, checkpoint: ad_jobs.start_blacklist(
            lines, f"{base}/users", checkpoint, arrivals.AVAILABLE_NOW, THRESHOLD
        ),
    )
    return ad_jobs.read_blacklist(spark, f"{base}/users")


@query
def stream_blacklist_filter(spark, folder):
    listed = scratch(spark, "stored-blacklist")
    found = blacklist_users(spark, folder)
    found.write.parquet(f"{listed}/batch_id=0")
    base = _replay(
        spark,
        folder,
        "stream-filter",
        lambda lines, base, checkpoint: ad_jobs.start_blacklist_filter(
            lines, listed, f"{base}/clicks", checkpoint, arrivals.AVAILABLE_NOW
        ),
    )
    return ad_jobs.read_filtered(spark, f"{base}/clicks")


@query
def stream_blacklist_cutoff(spark, folder):
    base = _replay(
        spark,
        folder,
        "stream-cutoff",
        lambda lines, base, checkpoint: cutoff.start_cutoff(
            lines, f"{base}/out", checkpoint, arrivals.AVAILABLE_NOW, THRESHOLD
        ),
    )
    return cutoff.read_clicks(spark, f"{base}/out")


@query
def stream_province_top3(spark, folder):
    base = _replay(
        spark,
        folder,
        "stream-top3",
        lambda lines, base, checkpoint: ad_jobs.start_province_top3(
            lines, f"{base}/counts", f"{base}/top3", checkpoint, arrivals.AVAILABLE_NOW
        ),
    )
    return ad_jobs.read_province_top3(spark, f"{base}/top3")


@query
def stream_click_trend(spark, folder):
    base = _replay(
        spark,
        folder,
        "stream-trend",
        lambda lines, base, checkpoint: ad_jobs.start_click_trend(
            lines, f"{base}/trend", checkpoint, arrivals.AVAILABLE_NOW
        ),
    )
    return ad_jobs.read_click_trend(spark, f"{base}/trend")


def _composed_stream(spark, folder) -> str:
    """Log lines, some of them unreadable, through the composed stream; gives the folder of its tables."""
    base = scratch(spark, "ad-pipeline")
    settings = ad_pipeline.Settings(threshold=THRESHOLD)
    arrivals.replay(
        fixtures.ad_clicks_with_lines(spark, folder),
        lambda lines: ad_pipeline.start_ad_pipeline(
            lines, f"{base}/tables", f"{base}/checkpoint", arrivals.AVAILABLE_NOW, settings
        ),
    )
    return f"{base}/tables"


@query
def lookup_click_count_stream(spark, folder):
    """The same look-up as ``lookup_click_count``, in the counts that the composed stream keeps."""
    clicks = fixtures.ad_clicks(spark, folder)
    next_ad = ((F.col("ad_id") + 1) % 10).alias("ad_id")
    wanted = clicks.select(F.to_date("ts").alias("date"), "user_id", next_ad).distinct()
    counts = ad_pipeline.read_counts(spark, _composed_stream(spark, folder), "user_counts")
    return ads.lookup_click_count(wanted, counts)


# --- end to end ------------------------------------------------------------------------


def _section(df: DataFrame, section: str, columns: dict[str, object], names: dict[str, str]):
    """Rows of one result in the common columns of a combined report."""
    picked = [
        (columns[name] if name in columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in names.items()
    ]
    return df.select(F.lit(section).alias("section"), *picked)


def _stacked(sections: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, sections)


@query
def pipeline_session(spark, folder):
    """All results of one saved task, stacked."""
    task = tasks.find(fixtures.tasks(spark, folder), SESSION_TASK)
    actions = readers.actions_by_date(
        fixtures.actions(spark, folder, task.start_date, task.end_date),
        task.start_date,
        task.end_date,
    )
    report = session_report(
        actions, fixtures.users(spark, folder), task.criteria, PER_DAY, scratch(spark, "session-report")
    )
    ratios = [name for name in report.aggr_stat.columns if name != "session_count"]
    measure = F.explode(F.map_from_arrays(F.lit(ratios), F.array(*ratios))).alias("name", "ratio")
    stat = report.aggr_stat.select("session_count", measure)
    detail = report.detail.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    names = {
        "name": "string", "item": "string", "n1": "bigint", "n2": "bigint", "n3": "bigint", "ratio": "double",
    }
    c = F.col
    return _stacked(
        [
            _section(stat, "aggr_stat", {"name": c("name"), "n1": c("session_count"), "ratio": c("ratio")}, names),
            _section(detail, "detail", {"name": c("session_id"), "n1": c("n")}, names),
            _section(
                report.top10_category,
                "top10_category",
                {"name": c("category_id"), "n1": c("click_count"), "n2": c("order_count"), "n3": c("pay_count")},
                names,
            ),
            _section(
                report.top10_session,
                "top10_session",
                {"name": c("session_id"), "item": c("category_id"), "n1": c("click_count")},
                names,
            ),
            _section(
                report.random_extract,
                "random_extract",
                {
                    "name": c("session_id"),
                    "item": F.array_join("search_keywords", ","),
                    "n1": F.unix_timestamp("start_time"),
                },
                names,
            ),
        ]
    )


@query
def pipeline_funnel(spark, folder):
    task = tasks.find(fixtures.tasks(spark, folder), FUNNEL_TASK)
    actions = readers.actions_by_date(
        fixtures.actions(spark, folder, task.start_date, task.end_date),
        task.start_date,
        task.end_date,
    )
    return page_funnel(actions, task.page_flow)


@query
def pipeline_area_top3(spark, folder):
    return area_top_products(
        fixtures.product_clicks(spark, folder),
        fixtures.cities(spark, folder),
        fixtures.products(spark, folder),
    )


AREA_TASKS = (3, 8)


def _task_table(spark, folder, label, task_ids, run, schema):
    """Run a plan for saved tasks, store its results by task and read them back."""
    table = scratch(spark, label)
    for task_id in task_ids:
        task = tasks.find(fixtures.tasks(spark, folder), task_id)
        task_results.write_result(run(task), task_id, table)
    return task_results.read_results(spark, table, schema)


@query
def task_area_top3(spark, folder):
    """``pipeline_area_top3`` over the action clicks of saved tasks' days, with the tasks' numbers."""
    cities, info = fixtures.cities(spark, folder), fixtures.products(spark, folder)

    def run(task):
        actions = fixtures.actions(spark, folder, task.start_date, task.end_date)
        return task_results.area_top_of_task(actions, cities, info, task)

    columns = "area STRING, area_level STRING, product_id BIGINT, click_count BIGINT, city_infos STRING, product_name STRING, product_status STRING"
    return _task_table(spark, folder, "task-area", AREA_TASKS, run, columns)


@query
def task_convert_rates(spark, folder):
    def run(task):
        return task_results.rates_of_task(fixtures.actions(spark, folder, task.start_date, task.end_date), task)

    return _task_table(spark, folder, "task-rates", (FUNNEL_TASK,), run, "convert_rate STRING")


@query
def task_session_stat(spark, folder):
    users = fixtures.users(spark, folder)

    def run(task):
        return task_results.session_stat_of_task(fixtures.actions(spark, folder, task.start_date, task.end_date), users, task)

    ratios = [f"{name} DOUBLE" for name in sess.session_aggr_stat(sess.session_measures(fixtures.actions(spark, folder))).columns[1:]]
    return _task_table(spark, folder, "task-session", (SESSION_TASK,), run, ", ".join(["session_count BIGINT", *ratios]))


@query
def rejected_lines(spark, folder):
    """Lines that the readers turn away: of the ad log, and of a text export in which every seventh line is cut short."""
    path = scratch(spark, "actions-cut")
    whole = scratch(spark, "actions-whole")
    readers.write_delimited_text(fixtures.actions(spark, folder), whole)
    last = "concat(char(1), '[^', char(1), ']*$')"
    cut = f"if(bigint(split_part(value, char(1), 1)) % 7 = 0, regexp_replace(value, {last}, ''), value) AS value"
    spark.read.text(whole).selectExpr(cut).write.text(path)
    text = readers.rejected_text(spark, path, ACTIONS_WITH_ID).select(F.lit("export").alias("source"), "value")
    log = ad_log.parse(fixtures.ad_lines(spark, folder)).where("reject is not null")
    return text.unionByName(log.select(F.lit("log").alias("source"), F.col("reject").alias("value")))


@query
def pipeline_ads(spark, folder):
    report = ad_report(fixtures.ad_clicks(spark, folder), THRESHOLD)
    names = {
        "date": "date", "province": "string", "city": "string", "hour": "string", "minute": "string",
        "user_id": "bigint", "ad_id": "bigint", "click_count": "bigint",
    }

    def part(df: DataFrame, section: str) -> DataFrame:
        return _section(df, section, {name: F.col(name) for name in df.columns}, names)

    return _stacked(
        [
            part(report.blacklist, "blacklist"),
            part(report.ad_stat, "ad_stat"),
            part(report.province_top3, "province_top3"),
            part(report.click_trend, "click_trend"),
        ]
    )


@query
def pipeline_ads_stream(spark, folder):
    """All tables of the composed stream, stacked, with its numbers of rejected and late lines."""
    tables = _composed_stream(spark, folder)
    names = {
        "date": "date", "province": "string", "city": "string", "hour": "string", "minute": "string",
        "user_id": "bigint", "ad_id": "bigint", "click_count": "bigint", "cutoff": "timestamp",
    }

    def part(df: DataFrame, section: str) -> DataFrame:
        return _section(df, section, {name: F.col(name) for name in df.columns}, names)

    left_out = [
        part(ad_pipeline.read_rows(spark, tables, name).agg(F.count(F.lit(1)).alias("click_count")), name)
        for name in ("rejects", "late")
    ]
    return _stacked(
        [
            part(ad_pipeline.read_blacklist(spark, tables), "blacklist"),
            part(ad_pipeline.read_counts(spark, tables, "user_counts"), "user_counts"),
            part(ad_pipeline.read_counts(spark, tables, "ad_stat"), "ad_stat"),
            part(ad_pipeline.read_top(spark, tables), "province_top3"),
            part(ad_pipeline.read_counts(spark, tables, "trend"), "click_trend"),
            *left_out,
        ]
    )
