import pytest
from pyspark.sql import functions as F

from footfall.operators import merges, recode
from footfall.operators.criteria import Criteria
from footfall.session import for_streams, scratch, shared_folder
from footfall.sinks import batch_log, writers
from footfall.sources import ad_log, fixtures, readers, tasks
from footfall.sources.schemas import ACTIONS_WITH_ID
from tests.conftest import rows


def test_scratch_lies_in_the_configured_folder_and_is_new(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first.startswith(folder) and first != second


def test_streams_get_a_session_of_their_own(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    streams = for_streams(spark)
    assert streams.conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)
    assert streams.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_date_range_is_required(spark, folder):
    actions = fixtures.actions(spark, folder)
    with pytest.raises(ValueError):
        readers.actions_by_date(actions, None, "2024-01-05")


def test_pushed_range_equals_filtered_range(spark, folder):
    start, end = "2024-01-05", "2024-01-07"
    pushed = readers.actions_by_date(fixtures.actions(spark, folder, start, end), start, end)
    whole = readers.actions_by_date(fixtures.actions(spark, folder), start, end)
    assert rows(pushed) == rows(whole) != []


def test_text_round_trip(spark, folder):
    path = scratch(spark, "text")
    actions = fixtures.actions(spark, folder)
    readers.write_delimited_text(actions, path)
    line = spark.read.text(path).first()[0]
    assert line.count("\x01") == 13 and "\x01null\x01" in line
    assert rows(readers.delimited_text(spark, path, ACTIONS_WITH_ID)) == rows(actions)


def test_text_keeps_quotes_backslashes_and_empty_text(spark):
    path, schema = scratch(spark, "odd"), "a bigint, b string, c string"
    data = [(1, '"tea', "x"), (2, "a\\", '"'), (3, "", None), (None, 'say "hi"', "\\N"), (5, None, "")]
    readers.write_delimited_text(spark.createDataFrame(data, schema), path)
    assert rows(readers.delimited_text(spark, path, schema)) == rows(spark.createDataFrame(data, schema))
    assert readers.rejected_text(spark, path, schema).count() == 0


def test_text_with_a_wrong_number_of_fields_is_rejected(spark):
    path, schema = scratch(spark, "short"), "a bigint, b string"
    spark.createDataFrame([("1\x01x",), ("2",), ("3\x01y\x01z",), ("q\x01null",)], "value string").write.text(path)
    assert sorted(readers.delimited_text(spark, path, schema).collect(), key=str) == [(1, "x"), (None, None)]
    assert sorted(r.value for r in readers.rejected_text(spark, path, schema).collect()) == ["2", "3\x01y\x01z"]


def test_merges_with_nulls_and_ties(spark):
    frame = lambda data: spark.createDataFrame(data, "k string, click_count bigint")
    got = merges.upsert_replace(frame([("a", 1), ("b", 2), (None, 3)]), frame([("a", None), ("b", 5), ("b", 4), (None, 9)]), ["k"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", 1), ("b", 5), (None, 9)], key=str)
    got = merges.replace_group(frame([("a", 1), (None, 2)]), frame([(None, 7), (None, 8)]), ["k"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", 1), (None, 7), (None, 8)], key=str)
    log = spark.createDataFrame([(None, 1, 0), (None, 2, 1), (None, 3, 1)], "k string, click_count bigint, v int")
    assert sorted(map(tuple, merges.newest_groups(log, ["k"], "v").collect()), key=str) == [(None, 2), (None, 3)]


def test_normalize_gives_the_tidy_actions(spark, folder):
    raw = fixtures.actions_raw(spark, folder)
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    assert rows(recode.normalize_actions(raw)) == rows(fixtures.actions(spark, folder))


def test_normalize_does_not_fail_on_junk(spark):
    names = [field.split()[0] for field in ACTIONS_WITH_ID.split(", ")]
    df = spark.createDataFrame([["?"] * len(names), [""] * len(names)], ", ".join(f"{n} string" for n in names))
    got = recode.normalize_actions(df).collect()
    assert got[0].action_time is None and got[0].user_id is None and got[0].search_keyword == "?"
    assert set(got[1]) == {None}


@pytest.mark.parametrize(
    "line, good",
    [
        ("1704067200123 P P-1 7 3", True),
        ("1704067200123 P P-1 7", False),
        ("1704067200123 P P-1 7 3 9", False),
        ("x P P-1 7 3", False),
        ("1704067200123 P P-1 seven 3", False),
        ("", False),
    ],
)
def test_ad_log(spark, line, good):
    lines = spark.createDataFrame([(line,)], "value string")
    row = ad_log.parse(lines).first()
    if good:
        assert (row.ts_ms, row.province, row.city, row.user_id, row.ad_id, row.reject) == (
            1704067200123, "P", "P-1", 7, 3, None,
        )
    else:
        assert row.reject == line and row.user_id is None
    assert ad_log.clicks(lines).count() == int(good)


def test_ad_lines_round_trip(spark, folder):
    clicks = fixtures.ad_clicks(spark, folder)
    back = ad_log.parse(ad_log.lines(clicks)).select("ts_ms", "province", "city", "user_id", "ad_id")
    assert rows(back) == rows(clicks.select(*back.columns))


def test_tasks(spark):
    param = '{"startAge":["20","1"],"endAge":["x"],"cities":["a,b"],"sex":[],"targetPageFlow":["1,2"],"categoryIds":["3,4"]}'
    table = spark.createDataFrame([(1, param), (2, "broken"), (3, None)], "task_id bigint, task_param string")
    task = tasks.find(table, 1)
    assert task.page_flow == [1, 2]
    assert task.criteria == Criteria(start_age=20, cities=["a", "b"], category_ids=[3, 4])
    assert tasks.find(table, 2).criteria == tasks.find(table, 3).criteria == Criteria()
    with pytest.raises(LookupError):
        tasks.find(table, 9)


def test_append(spark):
    path = scratch(spark, "append")
    df = spark.range(5).withColumn("date", F.lit("2024-01-01"))
    writers.append(df, path, "date")
    writers.append(df, path, "date")
    assert spark.read.parquet(path).count() == 10


def test_batch_log(spark):
    schema, keys, folder = "k string, click_count bigint", ["k"], scratch(spark, "log")
    batch_log.open_log(spark, folder, schema)
    batch_log.open_log(spark, folder, schema)
    assert batch_log.read_log(spark, folder, schema).count() == 0
    batches = [[("a", 1), ("b", 1)], [("a", 3)], [("b", 2), ("c", 1)]]
    for number, changed in enumerate(batches):
        batch_log.write_batch(spark.createDataFrame(changed, schema), folder, number)
    # A batch that runs again replaces its own rows only.
    batch_log.write_batch(spark.createDataFrame(batches[1], schema), folder, 1)
    log = batch_log.read_log(spark, folder, schema)
    assert rows(batch_log.current(log, keys)) == [("a", 3), ("b", 2), ("c", 1)]
    assert rows(batch_log.current(batch_log.recent(log, 2, 100), keys)) == [("a", 3), ("b", 1)]
    assert rows(batch_log.current(batch_log.recent(log, 2, 1), keys)) == [("a", 3)]
    assert batch_log.recent(log, 0, 100).count() == 0
    into = scratch(spark, "compacted")
    batch_log.compact(spark, folder, schema, keys, into, 1)
    batch_log.write_batch(spark.createDataFrame(batches[2], schema), into, 2)
    shorter = batch_log.read_log(spark, into, schema)
    assert shorter.count() == 4
    assert rows(batch_log.current(shorter, keys)) == [("a", 3), ("b", 2), ("c", 1)]
