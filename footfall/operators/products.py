"""Clicked products per area."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import labels, salting, text


def join_click_city(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks with name and area of their city.

    City tables stay below the broadcast threshold in practice; Spark checks
    the size, and beyond it AQE splits a city that holds very many clicks.
    """
    return clicks.join(cities.select("city_id", "city_name", "area"), "city_id").select(
        "city_id", "city_name", "area", "product_id"
    )


def joined_list(items: Column) -> Column:
    """Texts of an array of ``(sort key, text)`` structs, in key order, comma-joined."""
    return F.array_join(F.transform(F.array_sort(items), lambda item: item["text"]), ",")


def group_concat_distinct(
    df: DataFrame, keys: Sequence[str], sort_key: Column, item: Column, name: str
) -> DataFrame:
    """Comma-joined distinct items per group, ordered by ``sort_key``; NULL items are skipped.

    Duplicates are removed by a hash aggregate first, so the list step only
    sees distinct items however often one repeats.
    """
    entries = df.select(*keys, sort_key.alias("sort_key"), item.alias("text"))
    distinct = entries.where(F.col("text").isNotNull()).distinct()
    return distinct.groupBy(*keys).agg(
        joined_list(F.collect_list(F.struct("sort_key", "text"))).alias(name)
    )


def area_product_count(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and city list per (area, product).

    Clicks are counted per (city, product) before cities are joined, so the
    join and everything after it handle counts, not clicks, and the list of a
    group is at most as long as its area has cities.
    """
    per_city = clicks.groupBy("city_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    placed = per_city.join(cities.select("city_id", "city_name", "area"), "city_id")
    city = F.struct(
        F.col("city_id").alias("sort_key"),
        text.id_name(F.col("city_id"), F.col("city_name")).alias("text"),
    )
    return placed.groupBy("area", "product_id").agg(
        F.sum("n").alias("click_count"),
        joined_list(F.collect_set(city)).alias("city_infos"),
    )


def join_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Counts with product name and status; counts of unknown products are dropped."""
    info = products.select(
        "product_id",
        "product_name",
        labels.product_status(F.col("extend_info")).alias("product_status"),
    )
    return counts.join(info, "product_id")


def area_top3(counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most clicked products of every area, with the area's level.

    The rank filter lets Spark keep at most ``n`` rows per area and task
    before the ranking shuffle.
    """
    order = Window.partitionBy("area").orderBy(F.desc("click_count"), "product_id")
    ranked = counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    return ranked.withColumn("area_level", labels.area_level(F.col("area"))).drop("_rank")


def salted_count(df: DataFrame, key: str, row_id: str, salts: int = 16) -> DataFrame:
    """Rows per key, counted per salted key first and per key afterwards.

    Spark's partial aggregation already evens out a plain count. The two
    visible stages are for aggregates without a partial form, and for engines
    reading the intermediate result. The key keeps its type.
    """
    salted = salting.add_prefix(F.col(key), salting.salt_of(F.col(row_id), salts))
    first = df.groupBy(salted.alias("salted_key")).agg(F.count(F.lit(1)).alias("n"))
    unsalted = salting.strip_prefix(F.col("salted_key")).cast(df.schema[key].dataType)
    return first.groupBy(unsalted.alias(key)).agg(F.sum("n").alias("click_count"))
