"""Inner joins with a few very frequent keys: those are salted on the big side and replicated on the small one.

Adaptive execution splits a skewed partition of a sort-merge join after the shuffle. This form
spreads a heavy key before it: its rows never meet in one shuffle partition, and it also serves
what follows the join on the same key. Keys keep their type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.salting import salt_of

TRACKED = 10_000  # keys that the sketch follows; bounds what a task holds
HEAVIEST = 100  # keys that are salted at most; bounds what is broadcast
SHARE = 0.01  # of all rows makes a key heavy
SALTS = 16


def heavy_keys(df: DataFrame, key: str, share: float = SHARE, most: int = HEAVIEST) -> DataFrame:
    """At most ``most`` keys that hold about ``share`` of all rows or more, as ``_heavy``, from a sketch of fixed size.

    The sketch can name a key that is a little too light; that only spreads it needlessly.
    """
    sketch = df.agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {max(TRACKED, most)})").alias("found"), F.count(F.lit(1)).alias("total")
    )
    found = sketch.select("total", F.explode("found").alias("k"))
    return found.where((F.col("k.count") >= share * F.col("total")) & F.col("k.item").isNotNull()).select(F.col("k.item").alias("_heavy"))


def salted_join(
    big: DataFrame, small: DataFrame, key: str, row_id: Sequence[str], salts: int = SALTS, share: float = SHARE
) -> DataFrame:
    """``big.join(small, key)``, evenly dealt although some keys of ``big`` hold much of it.

    ``row_id`` are columns of ``big`` by which the rows of a heavy key are spread. Only heavy rows
    of ``small`` are copied, ``salts`` times each.
    """
    heavy = F.broadcast(heavy_keys(big, key, share))  # at most HEAVIEST rows
    salt = F.when(F.col("_heavy").isNull(), F.lit(0)).otherwise(salt_of(F.struct(*row_id), salts))
    left = big.join(heavy, F.col(key) == F.col("_heavy"), "left").withColumn("_salt", salt).drop("_heavy")
    copies = F.when(F.col("_heavy").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(salts - 1)))
    right = small.join(heavy, F.col(key) == F.col("_heavy"), "left").withColumn("_salt", F.explode(copies)).drop("_heavy")
    return left.join(right, [key, "_salt"]).drop("_salt")
