"""The composed ad stream: one filter for all tables, exactly-once counts, and no line lost."""

import pytest
from pyspark.sql import functions as F

from footfall.operators import ads
from footfall.session import scratch, tune
from footfall.sinks import batch_log
from footfall.sources import ad_log, fixtures, readers
from footfall.streaming import ad_jobs, ad_pipeline, arrivals
from tests.conftest import rows
from tests.test_streaming import Inbox, ms


def tables(spark, base):
    out = {name: rows(ad_pipeline.read_counts(spark, base, name)) for name in ("user_counts", "ad_stat", "province_counts", "trend")}
    return out | {"blacklist": rows(ad_pipeline.read_blacklist(spark, base)), "top": rows(ad_pipeline.read_top(spark, base))}


def expected(clicks, threshold, n=3):
    kept = ads.blacklist_cutoff(clicks, threshold)
    stat = ads.ad_stat(kept)
    return {
        "user_counts": rows(ads.daily_user_ad_count(kept)),
        "ad_stat": rows(stat),
        "province_counts": rows(ads.province_ad_count(stat)),
        "trend": rows(ads.ad_click_trend(clicks)),
        "blacklist": rows(ads.crossings(clicks, threshold).groupBy("user_id").agg(F.min("ts").alias("cutoff"))),
        "top": rows(ads.province_top3(ads.province_ad_count(stat), n)),
    }


@pytest.mark.parametrize("fold_every,threshold", [(1, 2), (2, 3), (100, 1100)])
def test_stream_equals_batch_and_every_line_is_somewhere(spark, folder, fold_every, threshold):
    tune(spark)
    base = scratch(spark, "composed")
    lined = fixtures.ad_clicks_with_lines(spark, folder)
    settings = ad_pipeline.Settings(threshold=threshold, fold_every=fold_every)
    arrivals.replay(
        lined,
        lambda lines: ad_pipeline.start_ad_pipeline(lines, f"{base}/t", f"{base}/c", arrivals.AVAILABLE_NOW, settings),
    )
    got = tables(spark, f"{base}/t")
    assert got == expected(ad_log.clicks(lined.select("value")), threshold)
    counted = sum(r[-1] for r in got["trend"])
    rejects = ad_pipeline.read_rows(spark, f"{base}/t", "rejects")
    late = ad_pipeline.read_rows(spark, f"{base}/t", "late")
    assert counted + rejects.count() + late.count() == lined.count() and rejects.count() and not late.count()
    unreadable = lined.where("event_id % 10 in (3, 7)").select("value")
    assert rows(rejects) == rows(unreadable)


def test_late_clicks_leave_by_their_own_table(spark, folder):
    tune(spark)
    base = scratch(spark, "composed-late")
    lined = fixtures.ad_clicks_with_lines(spark, folder)
    arrivals.replay(
        lined,
        lambda lines: ad_pipeline.start_ad_pipeline(lines, f"{base}/t", f"{base}/c", arrivals.AVAILABLE_NOW),
        order=(0, 2, 1, 3),
    )
    counted = sum(r.click_count for r in ad_pipeline.read_counts(spark, f"{base}/t", "trend").collect())
    rejects, late = (ad_pipeline.read_rows(spark, f"{base}/t", name).count() for name in ("rejects", "late"))
    assert late > 0 and counted + rejects + late == lined.count()
    second = arrivals.slices(lined, 4)[1].where("event_id % 10 not in (3, 7)")
    inside = second.where(f"ts >= timestamp'{arrivals.slices(lined, 4)[2].agg(F.max('ts')).first()[0]}' - interval 1 hour")
    assert late == second.count() - inside.count()


def test_a_replayed_batch_replaces_its_own_increments(spark):
    def start(lines, base, checkpoint):
        settings = ad_pipeline.Settings(threshold=3, fold_every=2)
        return ad_pipeline.start_ad_pipeline(lines, f"{base}/t", checkpoint, arrivals.AVAILABLE_NOW, settings)

    inbox = Inbox(spark, start)
    arrived = []
    for day, second in ((0, 10), (0, 20), (0, 30), (1, 5), (1, 50)):
        clicks = [(ms(day, second + i), "P", "P-1", 1 + i % 2, 1) for i in range(3)] + [(ms(day, second), "P", None, 9, 9)]
        arrived.append(clicks)
        inbox.arrive(clicks)
    base = f"{inbox.base}/t"
    before = tables(spark, base)
    assert ("P", "P-1") in {r[1:3] for r in before["ad_stat"]}
    every = spark.createDataFrame([c for part in arrived for c in part], "ts_ms bigint, province string, city string, user_id bigint, ad_id bigint")
    assert before == expected(ad_log.clicks(ad_log.lines(every)), 3)
    # As after a crash between two tables: the last batches run again, in order.
    for batch_id in (2, 3, 4):
        lines = spark.read.text(f"{inbox.base}/in/{batch_id}")
        ad_pipeline.process(ad_log.parse(lines), batch_id, base, ad_pipeline.Settings(threshold=3, fold_every=2))
        assert tables(spark, base) == before
    wanted = spark.createDataFrame([("2024-01-01", 1, 1), ("2024-01-01", 2, 1), ("2024-01-09", 1, 1)], "d string, user_id bigint, ad_id bigint")
    wanted = wanted.selectExpr("cast(d as date) as date", "user_id", "ad_id")
    found = ads.lookup_click_count(wanted, ad_pipeline.read_counts(spark, base, "user_counts"))
    assert sorted((str(r.date), r.user_id, r.click_count) for r in found.collect()) == [("2024-01-01", 1, 3), ("2024-01-01", 2, 3), ("2024-01-09", 1, 0)]


def test_a_batch_writes_as_many_files_as_it_needs(spark):
    base = scratch(spark, "files")
    tune(spark)
    frame = spark.range(1000).selectExpr("id AS user_id").repartition(40)
    batch_log.write_batch(frame, base, 0)
    files = spark.read.parquet(f"{base}/batch_id=0").inputFiles()
    assert len(files) == 1


def test_blacklist_filter_reads_from_the_last_fold(spark):
    base = scratch(spark, "folded")
    for n, users in {-1: [], 0: [1], 1: [2], 2: [1, 2, 3], 3: [4]}.items():
        spark.createDataFrame([(u,) for u in users], "user_id bigint").write.parquet(f"{base}/batch_id={n}")
    listed = batch_log.since_last_fold(spark, base, ad_jobs.BLACKLIST, 2)
    assert sorted(r.user_id for r in listed.collect()) == [1, 2, 3, 4]
    assert {int(f.split("batch_id=")[1].split("/")[0]) for f in listed.inputFiles()} >= {2, 3}
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "batch_id" in plan.split("PartitionFilters")[1][:80]
