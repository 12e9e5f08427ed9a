"""Stored action and cell tables: what is read, what is touched, and statistics without a pass of their own."""

import os
import re

import pytest
from pyspark.sql import functions as F

from footfall.operators import cells, sessions
from footfall.operators.criteria import Criteria
from footfall.plans import session_report
from footfall.session import scratch, tune
from footfall.sources import action_table, cell_table, fixtures, readers, tasks
from tests.conftest import rows


@pytest.fixture(scope="module")
def actions(spark, folder):
    return fixtures.actions(tune(spark), folder)


@pytest.fixture
def stored(spark, actions):
    path = scratch(spark, "days")
    action_table.write_actions(actions, path)
    return path


def executed(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def times(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, files in os.walk(path) for f in files if f.endswith(".parquet")
    }


def test_a_range_of_days_opens_their_folders_only(spark, actions, stored):
    ranged = readers.actions_by_date(action_table.read_actions(spark, stored), "2024-01-05", "2024-01-07")
    plan = executed(ranged)
    found = re.search(r"PartitionFilters: \[(.*?)\]", plan)[1]
    assert "2024-01-05" in found and "2024-01-07" in found
    assert rows(ranged) == rows(readers.actions_by_date(actions, "2024-01-05", "2024-01-07"))
    assert action_table.read_actions(spark, stored).columns == actions.columns


def test_days_known_only_while_running_choose_folders(spark, folder, actions, stored):
    params = tasks.parse_params(fixtures.tasks(spark, folder).where("task_id = 7"))
    days = action_table.days_of_tasks(params)
    some = action_table.actions_on_days(action_table.read_actions(spark, stored), days)
    assert "dynamicpruning" in executed(some)
    wanted = [r.date for r in days.collect()]
    assert rows(some) == rows(actions.where(F.col("date").isin(wanted))) != []


def test_replacing_a_day_leaves_the_other_files(spark, actions, stored):
    before = times(stored)
    day = actions.where("date = date'2024-01-09'").limit(5)
    action_table.replace_days(day, stored)
    after = times(stored)
    others = {f: t for f, t in before.items() if "date=2024-01-09" not in f}
    assert others and all(after.get(f) == t for f, t in others.items())
    table = action_table.read_actions(spark, stored)
    assert rows(table.where("date <> date'2024-01-09'")) == rows(actions.where("date <> date'2024-01-09'"))
    assert table.where("date = date'2024-01-09'").count() == 5


@pytest.fixture(scope="module")
def cell_path(spark, folder):
    path = scratch(spark, "cells")
    many = fixtures.cells(tune(spark), folder).crossJoin(spark.range(60).withColumnRenamed("id", "copy"))
    many = many.withColumn("row", F.concat("row", F.lit("-"), "copy")).drop("copy")
    cell_table.write_cells(many, path, row_group_bytes=16 << 10)
    return path


def scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    nodes, total = [plan], 0
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
            continue
        if "FileSourceScanExec" in kind:
            total += node.metrics().apply("numOutputRows").value()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_a_get_reads_little(spark, cell_path):
    table = cell_table.read_cells(spark, cell_path)
    key = table.agg(F.max("row")).first()[0].rpartition("-")[0] + "-7"
    total, got = table.count(), cells.get_row(table, key, "f1", "name")
    plan = executed(got)
    assert f"EqualTo(row,{key})" in re.search(r"PushedFilters: \[(.*?)\]", plan)[1]
    assert got.count() == table.where(F.col("row") == key).select("row").distinct().count() == 1
    assert scanned_rows(got) < total / 20
    assert scanned_rows(cells.get_row(table, "no such row", "f1", "name")) == 0


def test_a_range_of_keys_reads_its_share(spark, folder, cell_path):
    table = cell_table.read_cells(spark, cell_path)
    part = cells.row_range(table, "row4", "row5")
    assert "GreaterThanOrEqual(row,row4)" in executed(part)
    assert part.count() <= scanned_rows(part.select("row")) < table.count() / 4
    ordered = [r.row for r in spark.read.parquet(table.inputFiles()[0]).select("row").collect()]
    assert ordered == sorted(ordered)


def test_keys_unlike_any_are_ruled_out_by_the_bloom_filter(spark, cell_path):
    """Keys inside the range of a row group: minimum and maximum alone could not tell."""
    table = cell_table.read_cells(spark, cell_path)
    some = [r.row + "x" for r in table.select("row").distinct().limit(40).collect()]
    assert sum(scanned_rows(cells.get_row(table, key, "f1", "name")) > 0 for key in some) < 10


@pytest.mark.parametrize("criteria", [Criteria(), Criteria(sex="nobody")])
def test_statistics_come_from_the_writing_pass(spark, folder, actions, criteria):
    users = fixtures.users(spark, folder)
    report = session_report.session_report(actions, users, criteria, 3, scratch(spark, "report"))
    want = sessions.session_aggr_stat(sessions.session_filter(actions, users, criteria))
    assert report.aggr_stat.collect() == want.collect()
    assert report.aggr_stat.dtypes == want.dtypes
    assert "parquet" not in executed(report.aggr_stat).lower()
