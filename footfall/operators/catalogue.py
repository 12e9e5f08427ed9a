"""Grading, surcharges and segment slices over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import labels
from footfall.operators.ordered_groups import rank_in_group

# Fixed value: the surcharge rate.
SURCHARGE = "0.05"


def price_grade(parts: DataFrame) -> DataFrame:
    """Grade of every part by its price above 900, and its price rank within the brand."""
    score = F.col("p_retailprice") - F.lit(900).cast("double")
    graded = parts.select(
        F.col("p_partkey").alias("part_id"),
        F.col("p_brand").alias("brand"),
        labels.grade(score).alias("grade"),
        labels.good_or_bad(score).alias("verdict"),
        (-F.col("p_retailprice")).alias("_minus_price"),
    )
    order = ["_minus_price", "part_id"]
    return rank_in_group(graded, ["brand"], order, "rank_in_brand").drop("_minus_price")


def quantity_surcharge(items: DataFrame, above: float = 25) -> DataFrame:
    """Surcharged turnover per return flag of items above a quantity, in exact decimals."""
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    charged = price + price * F.lit(SURCHARGE).cast("decimal(3,2)")
    return (
        items.where(F.col("l_quantity") > above)
        .groupBy("l_returnflag")
        .agg(F.sum(charged).cast("double").alias("surcharged"), F.count(F.lit(1)).alias("n_items"))
    )


def segment_slice(users: DataFrame, prefix: str, age_above: int) -> DataFrame:
    """Distinct (age text, sex) of users whose profession starts with ``prefix`` and whose
    age text is above a number, ordered by the age as text."""
    kept = users.where(
        F.col("professional").startswith(prefix)
        & (F.col("age_text").try_cast("int") > age_above)
    )
    return kept.select("age_text", "sex").distinct().orderBy("age_text", "sex")
