"""The cut-off at the click itself: equal to the batch operator, through restarts, with state that expires."""

from footfall.operators import ads
from footfall.sources import ad_log
from footfall.streaming import arrivals, cutoff
from tests.conftest import rows
from tests.test_streaming import CLICKS, Inbox, ms


def test_stream_equals_batch_through_restarts_and_state_expires(spark):
    queries = []

    def start(lines, base, checkpoint):
        queries.append(cutoff.start_cutoff(lines, f"{base}/out", checkpoint, arrivals.AVAILABLE_NOW, 3, fold_every=2))
        return queries[-1]

    inbox = Inbox(spark, start)
    batches = [
        # User 1 reaches three clicks on ad 1 in the middle of a batch that is not in order.
        [(ms(0, s), "P", "P-1", 1, 1) for s in (9, 1, 5, 7)] + [(ms(0, 6), "P", "P-1", 1, 2), (ms(0, 2), "P", "P-1", 2, 1)],
        # Later clicks of user 1 are cut; user 2 gets there over two batches, user 3 with two clicks at one time.
        [(ms(0, 20 + s), "P", "P-1", 2, 1) for s in (3, 1)] + [(ms(0, 21), "P", "P-1", 1, 7), (ms(0, 30), "P", "P-1", 3, 1), (ms(0, 30), "P", "P-1", 3, 1)],
        [(ms(0, 40), "P", "P-1", 3, 1), (ms(0, 41), "P", "P-1", 3, 1), (ms(0, 40), "P", "P-1", 3, 2)],
        [(ms(1, 5), "P", "P-1", u, 1) for u in (1, 2, 3, 4, 4, 4, 4)],
        [(ms(5, 5), "P", "P-1", 5, 1)],
        [(ms(9, 5), "P", "P-1", 5, 1)],
    ]
    for clicks in batches:
        inbox.arrive(clicks)
    every = ad_log.clicks(ad_log.lines(spark.createDataFrame([c for b in batches for c in b], CLICKS)))
    out = f"{inbox.base}/out"
    want = ads.blacklist_cutoff(every, 3)
    assert rows(cutoff.read_clicks(spark, out)) == rows(want.select("province", "city", "user_id", "ad_id", "ts"))
    moments = {r.user_id: r.cutoff.second for r in cutoff.read_cutoffs(spark, out).collect()}
    assert moments == {1: 7, 2: 23, 3: 40, 4: 5}
    states = [[p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]] for q in queries]
    # Days 0 and 1 are closed when day 9 has come; their keys are gone.
    assert max(max(s) for s in states if s) >= 6 and states[-1][-1] <= 2


def test_counts_are_native_state_and_late_clicks_of_an_open_day_do_not_count(spark):
    def start(lines, base, checkpoint):
        return cutoff.start_cutoff(lines, f"{base}/out", checkpoint, arrivals.AVAILABLE_NOW, 3, fold_every=2)

    inbox = Inbox(spark, start)
    hour = 3600
    first = [(ms(0, 9 * hour), "P", "P-1", 1, 1), (ms(0, 9 * hour + 1), "P", "P-1", 2, 1)]
    query = inbox.arrive(first)
    names = {s["operatorName"] for p in query.recentProgress for s in p["stateOperators"]}
    assert names == {"stateStoreSave"}  # no Python call per key
    inbox.arrive([(ms(0, hour + s), "P", "P-1", 1, 1) for s in range(5)])  # more than an hour behind: all late
    second = [(ms(0, 9 * hour + 2), "P", "P-1", 1, 1), (ms(0, 9 * hour + 3), "P", "P-1", 2, 1)]
    inbox.arrive(second)
    out = f"{inbox.base}/out"
    assert cutoff.read_cutoffs(spark, out).count() == 0
    third = [(ms(0, 9 * hour + s), "P", "P-1", 1, 1) for s in (6, 5)]
    inbox.arrive(third)
    assert [(r.user_id, r.cutoff.second) for r in cutoff.read_cutoffs(spark, out).collect()] == [(1, 5)]
    every = ad_log.clicks(ad_log.lines(spark.createDataFrame(first + second + third[1:], CLICKS)))
    assert rows(cutoff.read_clicks(spark, out)) == rows(every.select("province", "city", "user_id", "ad_id", "ts"))
