"""Readers for stored tables, delimited text, databases and Kafka."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from footfall.functions.times import TIME_IN
from footfall.sources.schemas import STORED

# Separator and missing-value word of the text exports.
FIELD_SEPARATOR = "\x01"
MISSING = "null"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table ``folder/name.parquet``. Known schemas are not inferred from the files."""
    reader = spark.read.schema(STORED[name]) if name in STORED else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def _fields() -> Column:
    return F.split("value", FIELD_SEPARATOR, -1)


def delimited_text(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Text export with ``\\x01`` between fields and the word ``null`` for missing values.

    Quotes and backslashes mean nothing, empty text stays empty text, and a value that does not
    parse is NULL. Lines with a wrong number of fields are left to :func:`rejected_text`.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    columns = StructType.fromDDL(schema).fields

    def parsed(i: int, field: StructField) -> Column:
        text = F.nullif(F.get(_fields(), F.lit(i)), F.lit(MISSING))
        kind = field.dataType.simpleString()
        if kind == "timestamp":
            return F.try_to_timestamp(text, F.lit(TIME_IN))
        return text if kind == "string" else text.try_cast(kind)

    whole = lines.where(F.size(_fields()) == len(columns))
    return whole.select(*[parsed(i, field).alias(field.name) for i, field in enumerate(columns)])


def rejected_text(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The lines of a text export whose number of fields is not that of the schema, as ``value``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.where(F.size(_fields()) != len(StructType.fromDDL(schema).fields))


def write_delimited_text(df: DataFrame, path: str) -> None:
    """The form :func:`delimited_text` reads. Text with a separator or a line feed, or that is ``null``, cannot be told apart."""

    def written(field: StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if field.dataType.simpleString() == "timestamp":
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        return F.coalesce(value.cast("string"), F.lit(MISSING))

    df.select(F.concat_ws(FIELD_SEPARATOR, *map(written, df.schema.fields)).alias("value")).write.option("lineSep", "\n").text(path)


def jdbc_table(spark: SparkSession, table_name: str, **options: str) -> DataFrame:
    """A database table. The caller passes url, user, password and, for a large table,
    partitionColumn, lowerBound, upperBound and numPartitions to read it in parallel."""
    return spark.read.format("jdbc").option("dbtable", table_name).options(**options).load()


def kafka_lines(spark: SparkSession, servers: str, topics: str, **options: str) -> DataFrame:
    """Stream of text lines from a comma list of Kafka topics."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .options(**options)
        .load()
    )
    return stream.select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Stream of text lines from files that arrive below ``path`` (a glob is allowed)."""
    return spark.readStream.options(**options).text(path)


def actions_by_date(actions: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Actions with ``start <= date <= end``.

    ``date`` is compared as stored, so a date-partitioned table is pruned.
    """
    if start is None or end is None:
        raise ValueError("a date range needs a start and an end")
    return actions.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def clicks(actions: DataFrame) -> DataFrame:
    """City and product of the product clicks."""
    clicked = actions.where(F.col("click_product_id").isNotNull())
    return clicked.select("city_id", F.col("click_product_id").alias("product_id"))


def clicks_by_date(actions: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """City and product of the product clicks in a date range."""
    return clicks(actions_by_date(actions, start, end))


def blacklist(stored: DataFrame) -> DataFrame:
    """Users on the stored blacklist, each once however often appended."""
    return stored.select("user_id").distinct()
