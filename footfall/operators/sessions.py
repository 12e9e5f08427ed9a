"""Session roll-up, filtering and session reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import labels, text, times
from footfall.functions.numbers import ratio2
from footfall.operators.criteria import Criteria
from footfall.operators.group_limits import TRIMMED, first_in_group
from footfall.operators.ordered_groups import lag_in_group, rank_in_group


def _visit_seconds() -> Column:
    last, first = F.max("action_time"), F.min("action_time")
    return F.unix_timestamp(last) - F.unix_timestamp(first)


def session_rollup(actions: DataFrame) -> DataFrame:
    """One row per session with its distinct keywords and clicked categories, sorted.

    Actions are added up per (session, keyword, category) first, in fixed-size aggregates with a
    partial stage; lists are collected from those rows only, however many actions a session has.
    """
    touched = actions.select(
        "session_id", "user_id", "action_time", "click_category_id", text.null_if_empty(F.col("search_keyword")).alias("keyword")
    )
    summed = touched.groupBy("session_id", "keyword", "click_category_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("first"),
        F.max("action_time").alias("last"),
        F.count(F.lit(1)).alias("n"),
    )
    return summed.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.array_sort(F.collect_set("keyword")).alias("search_keywords"),
        F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
        (F.unix_timestamp(F.max("last")) - F.unix_timestamp(F.min("first"))).alias("visit_length"),
        F.sum("n").alias("step_length"),
        F.min("first").alias("start_time"),
    )


def session_measures(actions: DataFrame, criteria: Criteria = Criteria()) -> DataFrame:
    """The roll-up without lists: fixed-size aggregates only.

    Whether a session has a wanted keyword or category is a maximum of a
    condition per row, so no set has to be collected to filter sessions.
    """
    wanted = {"search_keyword": criteria.keywords, "click_category_id": criteria.category_ids}
    hits = [
        F.coalesce(F.bool_or(F.col(name).isin(list(values))), F.lit(False)).alias(f"_hit_{name}")
        for name, values in wanted.items()
        if values is not None
    ]
    measures = actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        _visit_seconds().alias("visit_length"),
        F.count(F.lit(1)).alias("step_length"),
        F.min("action_time").alias("start_time"),
        *hits,
    )
    flags = [name for name in measures.columns if name.startswith("_hit_")]
    for flag in flags:
        measures = measures.where(flag)
    return measures.drop(*flags)


def join_session_user(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with their user's attributes.

    No hint: a user table below the broadcast threshold is broadcast, a larger
    one is shuffled, and a user with very many sessions is split by AQE.
    """
    attributes = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(attributes, "user_id")


def session_filter(actions: DataFrame, users: DataFrame, criteria: Criteria) -> DataFrame:
    """Sessions that satisfy all criteria, with measures and user attributes."""
    measures = session_measures(actions, criteria)
    return join_session_user(measures, users.where(criteria.user_condition()))


def range_counts() -> list[Column]:
    """Aggregates: the number of sessions, and that of every length and depth range."""
    ranges = {
        f"{column}_{name}_ratio": labels.in_range(column, low, high)
        for column, table in (("visit_length", labels.VISIT_RANGES), ("step_length", labels.STEP_RANGES))
        for name, low, high in table
    }
    counts = [F.expr(f"count_if({condition})").alias(name) for name, condition in ranges.items()]
    return [F.count(F.lit(1)).alias("session_count"), *counts]


def shares(counts: DataFrame) -> DataFrame:
    """The one row of :func:`range_counts` with shares in place of the ranges' counts."""
    ranges = [name for name in counts.columns if name != "session_count"]
    return counts.select("session_count", *[ratio2(name, "session_count").alias(name) for name in ranges])


def session_aggr_stat(sessions: DataFrame) -> DataFrame:
    """One row: number of sessions and the share of every length and depth range."""
    return shares(sessions.agg(*range_counts()))


def session_detail(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """All actions of the given sessions."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def sort_actions(actions: DataFrame) -> DataFrame:
    """Number the actions of every session in time order."""
    order = ["action_time", "event_id"]
    return rank_in_group(actions, ["session_id"], order, "action_no")


def category_counts(detail: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category, from one pass over the actions."""

    def tagged(ids: Column, kind: str) -> Column:
        return F.transform(ids, lambda i: F.struct(i.alias("category_id"), F.lit(kind).alias("kind")))

    clicked = F.when(
        F.col("click_category_id").isNotNull(), F.array(F.col("click_category_id"))
    ).otherwise(F.array().cast("array<bigint>"))
    touched = F.concat(
        tagged(clicked, "click"),
        tagged(text.id_list(F.col("order_category_ids")), "order"),
        tagged(text.id_list(F.col("pay_category_ids")), "pay"),
    )
    rows = detail.select(F.explode(touched).alias("t")).select("t.category_id", "t.kind")
    return rows.groupBy("category_id").agg(
        F.count_if(F.col("kind") == "click").alias("click_count"),
        F.count_if(F.col("kind") == "order").alias("order_count"),
        F.count_if(F.col("kind") == "pay").alias("pay_count"),
    )


def top10_category(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` categories with most clicks, then orders, then payments."""
    return counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), "category_id"
    ).limit(n)


def top10_session(detail: DataFrame, categories: DataFrame, n: int = 10) -> DataFrame:
    """For each given category the ``n`` sessions with most clicks on it.

    Clicks are counted per (category, session) first; the rank limit then keeps
    at most ``n`` rows per category and task before the ranking shuffle.
    """
    clicks = (
        detail.where(F.col("click_category_id").isNotNull())
        .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )
    wanted = clicks.join(categories.select("category_id"), "category_id", "left_semi")
    order = Window.partitionBy("category_id").orderBy(F.desc("click_count"), "session_id")
    ranked = wanted.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    return ranked.select("category_id", "session_id", "click_count")


def session_random_extract(sessions: DataFrame, per_day: int) -> DataFrame:
    """Pick ``per_day`` sessions of every day, spread over its hours by their share.

    The shares are rounded cumulatively, so the quotas of a day add up to
    ``per_day``. Within an hour the order of md5(session_id) decides: arbitrary,
    but the same in every run. A day with fewer sessions gives all of them.
    """
    placed = sessions.withColumns(
        {"date": F.to_date("start_time"), "hour": F.hour("start_time")}
    )
    hours = placed.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("n"))
    day = Window.partitionBy("date")
    upto = day.orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    running, total = F.sum("n").over(upto), F.sum("n").over(day)
    share_end = F.call_function("div", running * per_day, total)
    share_start = F.call_function("div", (running - F.col("n")) * per_day, total)
    quotas = hours.select("date", "hour", (share_end - share_start).alias("quota"))

    keys, order = ["date", "hour"], ["_lot", "session_id"]
    drawn = placed.withColumn("_lot", F.md5("session_id"))
    if per_day > TRIMMED:
        # Rows are drawn by the first digits of their lot; only the border digits' rows are ranked.
        quota = drawn.join(quotas, keys)
        return first_in_group(quota, keys, order, "substr(_lot, 1, 3)", "quota").drop("_lot", "quota")
    # No hour's quota exceeds per_day: this constant limit trims groups before the shuffle.
    window = Window.partitionBy(*keys).orderBy(*order)
    candidates = drawn.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= per_day)
    return candidates.join(quotas, keys).where("_rank <= quota").drop("_rank", "_lot", "quota")


def extract_report(actions: DataFrame, picked: DataFrame) -> DataFrame:
    """Start time, keywords and clicked categories of the picked sessions.

    Lists are collected for the picked sessions only.
    """
    rolled = session_rollup(session_detail(actions, picked))
    return rolled.select("session_id", "start_time", "search_keywords", "click_category_ids")


def visit_buckets(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id", "visit_length", labels.visit_bucket("visit_length").alias("bucket")
    )


def step_buckets(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id", "step_length", labels.step_bucket("step_length").alias("bucket")
    )


def action_time_features(actions: DataFrame) -> DataFrame:
    """Time keys of every action and its distance to the same user's previous action."""
    stamped = actions.withColumn("time_text", times.format_time(F.col("action_time")))
    order = ["action_time", "event_id"]
    values = {"previous_time": "time_text"}
    lagged = lag_in_group(stamped, ["user_id"], order, values)
    time_text, previous = F.col("time_text"), F.col("previous_time")
    moment = times.parse_time(time_text)
    return lagged.select(
        "event_id",
        "user_id",
        "time_text",
        "previous_time",
        times.is_after(time_text, previous).alias("is_after_previous"),
        times.is_before(time_text, previous).alias("is_before_previous"),
        times.minus_seconds(time_text, previous).alias("gap_seconds"),
        times.format_date(moment).alias("date_text"),
        times.hour_key(moment).alias("hour_key"),
        times.date_key(moment).alias("date_key"),
        times.minute_key(moment).alias("minute_key"),
        times.format_date(times.parse_date_key(times.date_key(moment))).alias("date_of_key"),
    )
