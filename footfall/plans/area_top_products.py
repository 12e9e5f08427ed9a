"""Most clicked products per area."""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.operators import products


def area_top_products(
    clicks: DataFrame, cities: DataFrame, product_info: DataFrame, n: int = 3
) -> DataFrame:
    """Top products of every area with level, city list, name and status.

    Counts of unknown products are dropped before the ranking, by their ids alone; names and
    descriptions are joined to the few products of the lists.
    """
    counts = products.area_product_count(clicks, cities)
    known = counts.join(product_info.select("product_id"), "product_id", "left_semi")
    top = products.join_product_info(products.area_top3(known, n), product_info)
    return top.select(
        "area",
        "area_level",
        "product_id",
        "click_count",
        "city_infos",
        "product_name",
        "product_status",
    )
