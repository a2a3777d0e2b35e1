"""Generations of the publisher: pinned reads, taking back, leases, the gate, compaction, lag and freshness."""

import pytest
from builders import BASE, event, table

from kelpline.operators.intervals import derive_intervals
from kelpline.operators.minutes import minute_deltas
from kelpline.policy import Policy
from kelpline.streaming import publish
from kelpline.streaming.publish import GateFailed, LeaseLost, Publisher

P = Policy()
BATCHES = [
    [event(BASE + 60 * k, session="A", user="U1") for k in range(4)] + [event(BASE + 86_400, session="B")],
    [event(BASE + 86_400 + 60, session="B"), event(BASE + 90, "pause", session="A", user="U1")],
    [event(BASE + 300 + 60 * k, session="C", user="U2") for k in range(3)] + [event(BASE + 120, "resume", session="A", user="U1")],
    [event(BASE + 86_400 + 120 + 60 * k, session="B") for k in range(2)],
]


def plain(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


IV = ("video_session_id", "start_s", "end_s")
DELTA = ("minute", "platform", "delta", "starts", "ends")


def built(spark, upto):
    intervals = derive_intervals(table(spark, [r for b in BATCHES[: upto + 1] for r in b]), P)
    return plain(intervals, *IV), plain(minute_deltas(intervals), *DELTA)


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("generations"))
    publisher = Publisher(spark, folder, P, compact_every=2)
    for k, rows in enumerate(BATCHES):
        publisher.process(table(spark, rows), k)
    return folder, publisher


def test_each_generation_can_be_read(spark, done):
    _, publisher = done
    assert [c["whole"] for c in publisher.commits().values()] == [False, False, True, False] and publisher.generation() == 3
    for g in range(4):
        intervals, deltas = built(spark, g)
        assert plain(publisher.intervals(g), *IV) == intervals and plain(publisher.deltas(g), *DELTA) == deltas
    assert plain(publisher.intervals(), *IV) == built(spark, 3)[0]
    with pytest.raises(ValueError):
        publisher.intervals(9)
    # folders of the batches before the whole one are not read any more
    assert [c["batch"] for c in publisher._chain(None)] == [2, 3]


def test_status_lag_and_freshness(spark, done):
    _, publisher = done
    status = {r.generation: r for r in publisher.status().collect()}
    assert [status[k].status for k in range(4)] == ["committed"] * 4 and [status[k].is_active for k in range(4)] == [False] * 3 + [True]
    arrived = [r for b in BATCHES for r in b] + [event(BASE + 86_400 + 900, session="D"), event(BASE + 10, session="A", user="U1"), BATCHES[0][0]]
    lag = publisher.publish_lag(table(spark, arrived), now_s=BASE + 86_400 + 1000).first()
    assert (lag.publish_cursor, lag.ingest_watermark, lag.publish_lag_s) == (BASE + 86_400 + 180, BASE + 86_400 + 900, 720)
    assert (lag.pending_events, lag.pending_sessions, lag.last_committed, lag.runs_in_flight) == (3, 2, 3, 0)
    assert lag.oldest_pending_s == BASE and lag.retention_headroom_s == 7 * 86_400 - 86_400 - 1000 and not lag.retention_alert and lag.lease_holder == publisher.owner
    assert publisher.publish_lag(table(spark, arrived), now_s=BASE + 7 * 86_400).first().retention_alert
    stages = publisher.freshness(now_s=publisher.commits()[3]["committed_s"] + 10).collect()
    assert {r.verdict for r in stages} == {"FRESH"} and [r.stage for r in stages] == ["events", "intervals", "deltas", "hours", "users"]
    assert {r.verdict for r in publisher.freshness(now_s=publisher.commits()[3]["committed_s"] + 10**6).collect()} == {"LATE"}


def test_nothing_is_published_yet(spark, tmp_path):
    publisher = Publisher(spark, str(tmp_path), P)
    lag = publisher.publish_lag(table(spark, BATCHES[0]), now_s=BASE).first()
    assert publisher.generation() == -1 and publisher.status() is None and publisher.users() is None
    assert (lag.publish_cursor, lag.pending_events, lag.pending_sessions, lag.last_committed) == (None, 5, 2, -1)
    assert {r.verdict for r in publisher.freshness().collect()} == {"MISSING"}


def test_taking_back_leases_and_the_gate(spark, tmp_path, monkeypatch):
    first, second = (Publisher(spark, str(tmp_path), P) for _ in range(2))
    first.process(table(spark, BATCHES[0]), 0)
    second.process(table(spark, BATCHES[1]), 1)
    with pytest.raises(LeaseLost):
        first.process(table(spark, BATCHES[2]), 2)
    assert first.generation() == 1
    second.abandon(1)
    assert first.generation() == 0 and plain(first.intervals(), *IV) == built(spark, 0)[0]
    second.process(table(spark, BATCHES[1]), 1)  # the stream does not get it in again by itself
    assert second.generation() == 0
    with pytest.raises(ValueError):
        second.abandon(1)
    second.process(table(spark, BATCHES[1]), 2)
    assert plain(second.intervals(), *IV) == built(spark, 1)[0] and [c["parent"] for c in second.commits().values()] == [-1, 0]
    real = publish.derive_intervals
    monkeypatch.setattr(publish, "derive_intervals", lambda events, policy, version: real(events, Policy(tail_s=180), version))
    with pytest.raises(GateFailed):
        second.process(table(spark, BATCHES[2]), 3)
    assert second.generation() == 2
    assert [r.status for r in second.status().orderBy("generation").collect()] == ["committed", "abandoned", "committed", "in_flight"]
