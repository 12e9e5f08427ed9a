"""Tables as logs of streaming batches, of newest values or of increments.

Each micro-batch writes its changed rows to ``folder/batch_id=N`` and the
reader takes the newest value per key. A batch never rewrites the table, and a
batch that is run again after a failure replaces exactly its own folder. The
counts come from streaming state and are absolute, so replaying is harmless.

A table of increments keeps every batch's own counts below ``folder/own``; its value is their
sum. A replayed batch replaces its own increments, so each counts exactly once. Every
``fold_every`` batches the totals of all batches before are written below ``folder/upto``, and a
batch that needs earlier totals reads the last of those and the few batches since.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import merges

VERSION = "batch_id"


def open_log(spark: SparkSession, folder: str, schema: str) -> str:
    """Make sure the log can be read before its first batch: an empty batch -1."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").parquet(f"{folder}/{VERSION}=-1")
    return folder


@contextlib.contextmanager
def _adaptive(session: SparkSession) -> Iterator[None]:
    """Streams run without adaptive execution; what a batch writes may use it, since its rows are planned already."""
    before = session.conf.get("spark.sql.adaptive.enabled")
    session.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        session.conf.set("spark.sql.adaptive.enabled", before)


def write_batch(changed: DataFrame, folder: str, batch_id: int) -> None:
    """Write one batch, in as many files as its size asks for.

    A stateful stage has one task per state partition. Rebalancing by a hash of the row gathers
    them by their real size, and a retried task sends every row to the same place.
    """
    with _adaptive(changed.sparkSession):
        changed.hint("rebalance", *changed.columns).write.mode("overwrite").parquet(f"{folder}/{VERSION}={batch_id}")


def read_log(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All logged rows with their batch number.

    ``schema`` is given, so reading does not open files to infer it.
    """
    return spark.read.schema(f"{schema}, {VERSION} BIGINT").parquet(folder)


def current(log: DataFrame, keys: Sequence[str], value: str = "click_count") -> DataFrame:
    """The table the log describes: newest value per key."""
    return merges.newest(log, keys, value, VERSION)


def current_groups(log: DataFrame, group: Sequence[str]) -> DataFrame:
    """For logs of whole groups: the rows of the newest batch of every group."""
    return merges.newest_groups(log, group, VERSION)


def fold_start(batch_id: int, fold_every: int) -> int:
    """The newest folding batch at or before ``batch_id``."""
    return batch_id - batch_id % fold_every


def recent(log: DataFrame, batch_id: int, fold_every: int) -> DataFrame:
    """Rows of the batches before ``batch_id`` since the last folding batch.

    ``batch_id`` is the partition column: older folders are not opened.
    """
    first = fold_start(max(batch_id - 1, 0), fold_every)
    return log.where(F.col(VERSION).between(first, batch_id - 1))


def since_last_fold(spark: SparkSession, folder: str, schema: str, fold_every: int) -> DataFrame:
    """Rows of the newest folding batch of a log and of those after it. Finds the newest batch by folder names."""
    log = read_log(spark, folder, schema)
    newest = max((int(name.rpartition("=")[2]) for name in _folders(spark, folder)), default=-1)
    return log.where(F.col(VERSION) >= fold_start(max(newest, 0), fold_every))


def _folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the finished batch folders."""
    jvm = spark._jvm.org.apache.hadoop.fs
    path = jvm.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = files.globStatus(jvm.Path(path, f"{VERSION}=*/_SUCCESS")) or []
    return [status.getPath().getParent().getName() for status in found]


def write_folding(
    changed: DataFrame,
    folder: str,
    schema: str,
    batch_id: int,
    fold_every: int,
    fold: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Write a batch; every ``fold_every`` batches write ``fold(recent rows, changed)`` instead.

    A job that needs its own earlier rows then reads at most ``fold_every``
    batches, however long it has been running.
    """
    if batch_id > 0 and batch_id % fold_every == 0:
        log = read_log(changed.sparkSession, folder, schema)
        changed = fold(recent(log, batch_id, fold_every), changed)
    write_batch(changed, folder, batch_id)


def compact(
    spark: SparkSession, folder: str, schema: str, keys: Sequence[str], into: str, upto: int
) -> None:
    """Write the table up to batch ``upto`` as one batch of a new, shorter log."""
    rows = read_log(spark, folder, schema).where(F.col(VERSION) <= upto)
    write_batch(current(rows, keys), into, upto)


def open_increments(spark: SparkSession, folder: str, schema: str) -> None:
    open_log(spark, f"{folder}/own", schema)
    open_log(spark, f"{folder}/upto", schema)


def totals(spark: SparkSession, folder: str, schema: str, keys: Sequence[str], value: str = "click_count") -> DataFrame:
    """The table: all increments of a key added up."""
    log = read_log(spark, f"{folder}/own", schema)
    return log.groupBy(*keys).agg(F.sum(value).alias(value))


def totals_before(
    spark: SparkSession, folder: str, schema: str, keys: Sequence[str], batch_id: int, fold_every: int, value: str = "click_count"
) -> DataFrame:
    """Totals of the batches before ``batch_id``, from the last fold and the batches since.

    Keys that folds no longer carry are missing; see :func:`write_increments`.
    """
    first = fold_start(max(batch_id - 1, 0), fold_every)
    version = F.col(VERSION)
    folded = read_log(spark, f"{folder}/upto", schema).where(version == first)
    since = read_log(spark, f"{folder}/own", schema).where(version.between(first, batch_id - 1))
    return folded.unionByName(since).groupBy(*keys).agg(F.sum(value).alias(value))


def write_increments(
    own: DataFrame, folder: str, schema: str, keys: Sequence[str], batch_id: int, fold_every: int, carry: Column | None = None
) -> None:
    """Log a batch's own counts; every ``fold_every`` batches, also the totals before it.

    ``carry`` says which keys a fold carries on (all without it). Only batches before are read, so
    a replayed batch writes the same again.
    """
    if batch_id > 0 and batch_id % fold_every == 0:
        earlier = totals_before(own.sparkSession, folder, schema, keys, batch_id, fold_every)
        write_batch(earlier.where(carry) if carry is not None else earlier, f"{folder}/upto", batch_id)
    write_batch(own, f"{folder}/own", batch_id)
