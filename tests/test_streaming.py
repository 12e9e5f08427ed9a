from datetime import datetime, timedelta

import pytest

from footfall.operators import ads
from footfall.session import scratch, tune
from footfall.sinks import batch_log
from footfall.sources import ad_log, fixtures, readers
from footfall.streaming import ad_jobs, arrivals
from tests.conftest import rows

CLICKS = "ts_ms bigint, province string, city string, user_id bigint, ad_id bigint"
DAY_ONE = datetime(2024, 1, 1)


def ms(day, second):
    return int(((DAY_ONE - datetime(1970, 1, 1)) + timedelta(days=day, seconds=second)).total_seconds() * 1000)


class Inbox:
    """Files arriving for a job that is started again after every arrival."""

    def __init__(self, spark, start):
        self.spark, self.start = tune(spark), start
        self.base = scratch(spark, "job")
        self.arrived = 0

    def arrive(self, clicks):
        lines = ad_log.lines(self.spark.createDataFrame(clicks, CLICKS))
        lines.write.text(f"{self.base}/in/{self.arrived}")
        self.arrived += 1
        query = self.start(
            readers.file_lines(self.spark, f"{self.base}/in/*"), self.base, f"{self.base}/checkpoint"
        )
        assert query.awaitTermination(300)
        return query


def test_blacklist_adds_a_user_once_in_the_batch_that_reaches_the_threshold(spark):
    def start(lines, base, checkpoint):
        return ad_jobs.start_blacklist(lines, f"{base}/out", checkpoint, arrivals.AVAILABLE_NOW, 3)

    inbox = Inbox(spark, start)

    def log():
        return batch_log.read_log(spark, f"{inbox.base}/out", ad_jobs.BLACKLIST)

    inbox.arrive([(ms(0, s), "P", "P-1", 1, 1) for s in (1, 2)] + [(ms(0, 3), "P", "P-1", 2, 1)])
    assert log().count() == 0
    inbox.arrive([(ms(0, 4), "P", "P-1", 1, 1)])
    assert rows(log().select("user_id")) == [(1,)]
    # Known users are not written again; counts survive the restart; days are separate.
    inbox.arrive([(ms(0, s), "P", "P-1", u, 1) for s, u in ((5, 1), (6, 2), (7, 2))])
    assert rows(log().select("user_id")) == [(1,), (2,)]
    inbox.arrive([(ms(1, s), "P", "P-1", 3, 1) for s in (1, 2)] + [(ms(1, 3), "P", "P-1", 3, 2)])
    assert rows(log().select("user_id")) == [(1,), (2,)]


def test_top3_replaces_only_touched_groups(spark):
    def start(lines, base, checkpoint):
        return ad_jobs.start_province_top3(
            lines, f"{base}/counts", f"{base}/top", checkpoint, arrivals.AVAILABLE_NOW, n=2
        )

    inbox = Inbox(spark, start)
    inbox.arrive(
        [(ms(0, i), "P", "P-1", i, ad) for i, ad in enumerate([1, 1, 2, 2, 3])]
        + [(ms(0, 9), "Q", "Q-1", 1, 7)]
    )
    top = [(str(r.date), r.province, r.ad_id, r.click_count) for r in ad_jobs.read_province_top3(spark, f"{inbox.base}/top").collect()]
    assert sorted(top) == [("2024-01-01", "P", 1, 2), ("2024-01-01", "P", 2, 2), ("2024-01-01", "Q", 7, 1)]
    inbox.arrive([(ms(0, 20 + i), "P", "P-1", i, 3) for i in range(3)])
    top = [(str(r.date), r.province, r.ad_id, r.click_count) for r in ad_jobs.read_province_top3(spark, f"{inbox.base}/top").collect()]
    assert sorted(top) == [("2024-01-01", "P", 1, 2), ("2024-01-01", "P", 3, 4), ("2024-01-01", "Q", 7, 1)]


@pytest.mark.parametrize("fold_every", [1, 3])
def test_folding_batches_keep_results(spark, folder, fold_every):
    """Results do not depend on how often a log is folded; one batch per quarter and restart."""
    tune(spark)
    clicks = fixtures.ad_clicks(spark, folder)
    base = scratch(spark, "fold")

    def top(lines):
        return ad_jobs.start_province_top3(
            lines, f"{base}/counts", f"{base}/top", f"{base}/c1", arrivals.AVAILABLE_NOW, fold_every=fold_every
        )

    arrivals.replay(clicks, top)
    want = ads.province_top3(ads.province_ad_count(ads.ad_stat(clicks)))
    assert rows(ad_jobs.read_province_top3(spark, f"{base}/top")) == rows(want)

    def listed(lines):
        return ad_jobs.start_blacklist(
            lines, f"{base}/users", f"{base}/c2", arrivals.AVAILABLE_NOW, 2, fold_every=fold_every
        )

    arrivals.replay(clicks, listed)
    want = ads.blacklist_users(ads.daily_user_ad_count(clicks), 2)
    assert rows(ad_jobs.read_blacklist(spark, f"{base}/users")) == rows(want) != []


def test_rejects_are_left_out_and_rows_in_the_watermark_are_counted(spark):
    def start(lines, base, checkpoint):
        return ad_jobs.start_click_trend(lines, f"{base}/out", checkpoint, arrivals.AVAILABLE_NOW)

    inbox = Inbox(spark, start)
    inbox.arrive([(ms(0, 7200), "P", "P-1", 1, 1), (ms(0, 7201), "P", None, 1, 1)])
    inbox.arrive([(ms(0, 7200 - 1800), "P", "P-1", 1, 1), (ms(0, 7202), "P", "P-1", 1, 1)])
    got = sorted((r.hour, r.minute, r.click_count) for r in ad_jobs.read_click_trend(spark, f"{inbox.base}/out").collect())
    assert got == [("01", "30", 1), ("02", "00", 2)]


def test_batch_and_stream_agree_and_a_replayed_batch_is_harmless(spark, folder):
    clicks = fixtures.ad_clicks(spark, folder)
    base = scratch(spark, "stat")

    def start(lines):
        return ad_jobs.start_ad_stat(lines, f"{base}/out", f"{base}/checkpoint", arrivals.AVAILABLE_NOW)

    tune(spark)
    arrivals.replay(clicks, start)
    want = rows(ads.ad_stat(clicks))
    assert rows(ad_jobs.read_ad_stat(spark, f"{base}/out")) == want
    log = batch_log.read_log(spark, f"{base}/out", ad_jobs.AD_STAT)
    again = log.where("batch_id = 2").drop("batch_id").collect()
    batch_log.write_batch(spark.createDataFrame(again, ad_jobs.AD_STAT), f"{base}/out", 2)
    assert rows(ad_jobs.read_ad_stat(spark, f"{base}/out")) == want


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_slices_cover_every_click_once(spark, folder, parts):
    clicks = fixtures.ad_clicks(spark, folder)
    slices = arrivals.slices(clicks, parts)
    ids = [row.event_id for part in slices for row in part.select("event_id").collect()]
    assert sorted(ids) == sorted(row.event_id for row in clicks.select("event_id").collect())
