import pytest
from pyspark.sql import functions as F

from footfall.operators import products, skew_joins
from tests.conftest import rows


@pytest.fixture(scope="module")
def big(spark):
    # Every third row has one key, a few have none.
    return spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 5L WHEN id % 100 > 1 THEN id % 500 END AS k", "id AS n").repartition(4)


@pytest.fixture(scope="module")
def small(spark):
    return spark.range(450).selectExpr("id AS k", "concat('name', id) AS name", "id % 7 AS n2").union(spark.sql("SELECT 5L, 'again', 0L"))


def test_heavy_keys(big):
    assert [r._heavy for r in skew_joins.heavy_keys(big, "k", 0.05).collect()] == [5]
    assert skew_joins.heavy_keys(big.where("false"), "k").collect() == []
    assert skew_joins.heavy_keys(big.where("k is null"), "k").collect() == []


@pytest.mark.parametrize("share,salts", [(0.05, 16), (0.0001, 4), (2.0, 16), (0.05, 1)])
def test_equal_to_the_plain_join(big, small, share, salts):
    got = skew_joins.salted_join(big, small, "k", ["n"], salts, share)
    want = big.join(small, "k")
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert rows(got) == rows(want)


def test_text_keys(big, small):
    left, right = (x.withColumn("k", F.concat(F.lit("key"), "k")) for x in (big, small))
    assert rows(skew_joins.salted_join(left, right, "k", ["n"])) == rows(left.join(right, "k"))


def test_no_partition_holds_the_heavy_key(spark, big, small):
    """The join's own shuffle, without broadcast and without adaptive splitting."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {name: spark.conf.get(name) for name in conf}

    def largest(joined):
        return joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        plain = largest(big.join(small.dropDuplicates(["k"]), "k"))
        salted = largest(skew_joins.salted_join(big, small.dropDuplicates(["k"]), "k", ["n"]))
        assert plain >= 3000 and salted < 1200
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_salted_count_keeps_the_type_of_its_key(big):
    counted = products.salted_count(big.where("k is not null"), "k", "n")
    assert dict(counted.dtypes)["k"] == "bigint"
    assert rows(counted) == rows(big.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("click_count")))
