"""Cleaning raw action text and decoding old record text, table-wide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import json_fields, records, text, times


NUMBERS = ("event_id", "user_id", "page_id", "click_category_id", "click_product_id", "city_id")
ID_LISTS = ("order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids")


def normalize_actions(raw: DataFrame) -> DataFrame:
    """Typed actions from all-text actions.

    Empty text becomes NULL, lists lose a stray comma at each end, hours get
    two digits, and a time or number that cannot be read becomes NULL;
    :func:`unreadable` has those values.
    """
    return raw.select(*[column.alias(name) for name, column in _typed()])


def unreadable(raw: DataFrame) -> DataFrame:
    """Every value that cannot be read, with its column and the row's event id as text.

    Numbers, dates and times that :func:`normalize_actions` makes NULL, and items of id lists that
    are no numbers.
    """
    typed = dict(_typed())

    def lost(name: str) -> Column:
        if name in ID_LISTS:
            return text.unreadable_ids(F.col(name))
        gone = text.is_not_empty(F.col(name)) & typed[name].isNull()
        return F.when(gone, F.array(F.col(name))).otherwise(F.array().cast("array<string>"))

    def named(name: str) -> Column:
        return F.transform(lost(name), lambda value: F.struct(F.lit(name).alias("column"), value.alias("value")))

    every = F.concat(*[named(name) for name in (*NUMBERS, "date", "action_time", *ID_LISTS)])
    return raw.select("event_id", F.explode(every).alias("found")).select("event_id", "found.column", "found.value")


def _typed() -> list[tuple[str, Column]]:
    """Name and typed value of every column."""
    day_and_clock = F.split("action_time", " ")
    clock = F.split(F.get(day_and_clock, 1), ":")
    hour = text.pad2(F.get(clock, 0))
    padded = F.concat_ws(":", hour, F.get(clock, 1), F.get(clock, 2))
    full_time = F.concat_ws(" ", F.get(day_and_clock, 0), padded)

    def number(name: str) -> tuple[str, Column]:
        return name, text.null_if_empty(F.col(name)).try_cast("bigint")

    def tidy(name: str) -> tuple[str, Column]:
        return name, text.null_if_empty(text.trim_comma(F.col(name)))

    return [
        number("event_id"),
        ("date", times.parse_date(F.col("date"))),
        number("user_id"),
        ("session_id", text.null_if_empty(F.col("session_id"))),
        number("page_id"),
        ("action_time", times.parse_time(full_time)),
        tidy("search_keyword"),
        number("click_category_id"),
        number("click_product_id"),
        *[tidy(name) for name in ID_LISTS],
        number("city_id"),
    ]


def legacy_record_recode(recorded: DataFrame) -> DataFrame:
    """Fields read from old ``record`` and ``joined_key`` text, and the record rewritten."""
    record, key = F.col("record"), F.col("joined_key")
    return recorded.select(
        "event_id",
        records.record_get(record, "searchKeywords").alias("search_keywords"),
        records.record_get(record, "clickCategoryIds").alias("click_category_ids"),
        records.record_get(record, "age").alias("age"),
        records.record_set(record, "age", F.lit("0")).alias("without_age"),
        records.record_set(record, "unknown", F.lit("0")).alias("unchanged"),
        records.key_part(key, 1).alias("key_date"),
        records.key_part(key, 2).alias("key_user"),
        records.key_part(key, 3).alias("key_ad"),
    )


def json_extract(events: DataFrame) -> DataFrame:
    """A field of an event's JSON object, and of the first item of a JSON array."""
    props = F.col("props")
    items = F.concat(F.lit("["), props, F.lit(',{"k": -1}]'))
    return events.select(
        "event_id",
        json_fields.json_field(props, "k").alias("k"),
        json_fields.json_field(props, "absent").alias("absent"),
        json_fields.json_item_field(items, 0, "k").alias("first_item_k"),
        json_fields.json_field(F.ltrim(props, F.lit("{")), "k").alias("malformed"),
    )
