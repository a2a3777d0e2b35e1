"""Edges of intervals, minutes, states, order, dimensions, users and late data, each with what follows by hand.

Every case has sessions and a day of its own, so all are derived at once.
"""

import pytest
from builders import BASE, event, table
from pyspark.sql import functions as F

from kelpline.operators.intervals import derive_intervals
from kelpline.operators.minutes import change_curve, dense_curve, minute_deltas, user_curve, user_minutes
from kelpline.policy import Policy
from kelpline.streaming.publish import Publisher

# name: (events, intervals, minutes with one viewer, minutes asserted to have none). Events are (clock, event or event type,
# and what differs from one web session of one user); intervals (start, end, and dimensions that matter); minutes
# (first, last) ranges.
CASES = {
    "start on a minute": ([("10:00:00", "beat"), ("10:00:40", "beat"), ("10:01:20", "beat"), ("10:02:00", "beat")], [("10:00:00", "10:03:00")], [("10:00", "10:03")], []),
    "inner end on a minute": ([("10:00:30", "beat"), ("10:01:10", "beat"), ("10:02:00", "pause"), ("10:02:40", "beat"), ("10:03:20", "beat")], [("10:00:30", "10:02:00")], [("10:00", "10:02")], ["10:03"]),
    "within a minute": ([("10:00:10", "beat"), ("10:00:50", "pause"), ("10:01:30", "beat"), ("10:02:10", "beat")], [("10:00:10", "10:00:50")], [("10:00", "10:00")], ["10:01"]),
    "lone events": ([("10:00:00", "beat"), ("10:10:00", "beat")], [], [], ["10:00", "10:10"]),
    "hour and exact gap": ([("10:58:00", "beat"), ("11:00:30", "beat"), ("11:02:00", "beat")], [("10:58:00", "11:03:00")], [("10:58", "11:03")], ["11:04"]),
    "last minute of an hour": ([("10:57:30", "beat"), ("10:59:10", "pause"), ("10:59:50", "beat"), ("11:00:30", "beat")], [("10:57:30", "10:59:10")], [("10:57", "10:59")], ["11:00"]),
    "across midnight": ([("23:58:30", "beat"), ("23:59:50", "beat"), ("24:01:10", "beat"), ("24:02:30", "beat")], [("23:58:30", "24:03:30")], [("23:58", "24:03")], ["24:04"]),
    "end on an hour": ([("10:58:00", "beat"), ("11:00:00", "pause"), ("11:00:40", "beat"), ("11:01:20", "beat")], [("10:58:00", "11:00:00")], [("10:58", "11:00")], ["11:01"]),
    "pause, then background": ([("10:00:00", "beat"), ("10:00:40", "beat"), ("10:01:00", "pause"), ("10:01:30", "AppBackgrounded")], [("10:00:00", "10:01:00")], [("10:00", "10:01")], ["10:02"]),
    "beats while paused": ([("10:00:00", "beat"), ("10:00:30", "pause"), ("10:01:10", "beat"), ("10:01:50", "beat"), ("10:02:30", "resume"), ("10:03:10", "beat")], [("10:00:00", "10:00:30"), ("10:02:30", "10:04:10")], [("10:00", "10:00"), ("10:02", "10:04")], ["10:01"]),
    "resume without pause": ([("10:00:00", "beat"), ("10:00:40", "beat"), ("10:01:20", "resume"), ("10:02:00", "beat")], [("10:00:00", "10:03:00")], [("10:00", "10:03")], []),
    "two pauses, one resume": ([("10:00:00", "beat"), ("10:00:40", "pause"), ("10:01:20", "pause"), ("10:02:00", "resume"), ("10:02:40", "beat")], [("10:00:00", "10:00:40"), ("10:02:00", "10:03:40")], [("10:00", "10:00"), ("10:02", "10:03")], ["10:01"]),
    "pause as last event": ([("10:00:00", "beat"), ("10:00:40", "beat"), ("10:01:00", "pause")], [("10:00:00", "10:02:00")], [("10:00", "10:02")], []),
    "background bridges gaps": ([("10:00:00", "beat"), ("10:02:20", "AppBackgrounded"), ("10:04:40", "AppForegrounded"), ("10:07:00", "beat")], [("10:00:00", "10:08:00")], [("10:00", "10:08")], []),
    "pause and resume in a minute": ([("10:00:10", "beat"), ("10:00:30", "pause"), ("10:00:50", "resume"), ("10:01:30", "beat")], [("10:00:10", "10:00:30"), ("10:00:50", "10:02:30")], [("10:00", "10:02")], []),
    "resume before pause in a second": ([("10:00:00", "beat"), ("10:01:00.1", "resume"), ("10:01:00.9", "pause"), ("10:01:40", "beat"), ("10:02:20", "beat")], [("10:00:00", "10:03:20")], [("10:00", "10:03")], []),
    "newest first": ([("10:02:00", "beat"), ("10:01:20", "beat"), ("10:00:40", "beat"), ("10:00:00", "beat")], [("10:00:00", "10:03:00")], [("10:00", "10:03")], []),
    "events after the end": ([("10:00:00", "beat"), ("10:00:40", "beat"), ("10:01:20", "VideoSessionEnd"), ("10:02:40", "beat")], [("10:00:00", "10:03:40", {"is_open": False})], [("10:00", "10:03")], []),
    "equal rows": ([("10:00:00", "beat"), ("10:00:00", "beat"), ("10:00:40", "beat"), ("10:00:40", "beat"), ("10:01:20", "beat")], [("10:00:00", "10:02:20")], [("10:00", "10:02")], []),
    "two ends and a restart": ([("10:00:00", "beat"), ("10:00:40", "VideoSessionEnd"), ("10:01:00", "VideoSessionEnd"), ("10:09:00", "beat")], [("10:00:00", "10:02:00", {"is_open": False})], [("10:00", "10:02")], ["10:09"]),
    "a tie of languages": ([("10:00:00", "beat", {"audio": "hin"}), ("10:00:40", "beat", {"audio": "ben"}), ("10:01:20", "beat", {"audio": "hin"}), ("10:02:00", "beat", {"audio": "ben"}), ("10:02:40", "beat", {"audio": "tam"})], [("10:00:00", "10:03:40", {"audio_language": "ben"})], [("10:00", "10:03")], []),
    "another platform after a pause": ([("10:00:00", "beat"), ("10:00:40", "pause"), ("10:01:10", "resume", {"platform": "android"}), ("10:01:30", "beat", {"platform": "android"}), ("10:01:50", "beat", {"platform": "android"})], [("10:00:00", "10:00:40", {"platform": "web"}), ("10:01:10", "10:02:50", {"platform": "android"})], [("10:00", "10:02")], []),
    "extra dimensions stay whole": ([("10:00:00", "beat", {"extra": {"experiment_id": "A", "video_resolution": "1920*1080"}}), ("10:00:40", "beat", {"extra": {"experiment_id": "A", "video_resolution": "1280*720"}}), ("10:01:20", "beat", {"extra": {"experiment_id": "A", "video_resolution": "1920*1080"}})], [("10:00:00", "10:02:20", {"extra_dimensions": {"experiment_id": "A", "video_resolution": "1920*1080"}})], [("10:00", "10:02")], []),
    "extra dimensions vote by key": ([("10:00:00", "beat", {"extra": {"experiment_id": "A", "video_resolution": "1080"}}), ("10:00:40", "beat", {"extra": {"video_resolution": "720", "experiment_id": "A"}}), ("10:01:20", "beat", {"extra": {"experiment_id": "B", "video_resolution": "720"}})], [("10:00:00", "10:02:20", {"extra_dimensions": {"experiment_id": "A", "video_resolution": "720"}})], [("10:00", "10:02")], []),
    "empty is not absent": ([("10:00:00", "beat", {"extra": {}}), ("10:00:40", "beat", {"extra": {"cohort": ""}})], [("10:00:00", "10:01:40", {"extra_dimensions": {"cohort": ""}})], [("10:00", "10:01")], []),
}
#: name: (events that are there first, late ones, intervals at the end, minutes with a viewer, minutes without, platforms of the minutes).
LATE = {
    "extends": ([("10:00:00", "beat"), ("10:00:40", "beat")], [("10:01:20", "beat")], [("10:00:00", "10:02:20")], [("10:00", "10:02")], [], {"web"}),
    "shrinks": ([("10:00:00", "beat"), ("10:00:40", "beat"), ("10:01:20", "beat"), ("10:02:00", "beat")], [("10:00:50", "pause")], [("10:00:00", "10:00:50")], [("10:00", "10:00")], ["10:01", "10:02", "10:03"], {"web"}),
    "bridges": ([("10:00:00", "beat"), ("10:00:40", "beat"), ("10:06:00", "beat"), ("10:06:40", "beat")], [("10:03:00", "beat"), ("10:05:20", "beat")], [("10:00:00", "10:07:40")], [("10:00", "10:07")], [], {"web"}),
    "flips": ([("10:00:00", "beat"), ("10:00:40", "beat"), ("10:01:20", "beat")], [(c, "beat", {"platform": "android"}) for c in ("10:00:20", "10:00:50", "10:01:00", "10:01:10")], [("10:00:00", "10:02:20", {"platform": "android"})], [("10:00", "10:02")], [], {"android"}),
}


def sec(clock: str, day: int) -> int:
    h, m, s = (float(x) for x in (clock + ":00").split(":")[:3])
    return BASE + day * 2 * 86_400 + int((h - 10) * 3600 + m * 60 + s)


def rows_of(name: str, day: int, events: list) -> list:
    out = []
    for clock, what, *more in events:
        kind = what if what[:3] in ("App", "Vid") else None
        out.append(event(sec(clock, day), what, session=name, user=f"U {name}", kind=kind, **(more[0] if more else {})))
    return out


def minutes(ranges: list, day: int) -> set:
    return {m for a, b in ranges for m in range(sec(a, day), sec(b, day) + 1, 60)}


def check(name, day, want, on, off, intervals, curve):
    assert {(r.start_s, r.end_s) for r in intervals} == {(sec(x[0], day), sec(x[1], day)) for x in want}, name
    for x in want:
        (r,) = [r for r in intervals if r.start_s == sec(x[0], day)]
        assert r.is_open == (x[2].get("is_open", True) if len(x) > 2 else True)
        assert all(r[k] == v for k, v in (x[2] if len(x) > 2 else {}).items()), name
    assert {m: c for m, c in curve.items() if c} == dict.fromkeys(minutes(on, day), 1), name
    assert all(curve.get(sec(m, day), 0) == 0 for m in off), name


@pytest.fixture(scope="module")
def derived(spark):
    rows = [r for k, (name, c) in enumerate(CASES.items()) for r in rows_of(name, k, c[0])]
    intervals = derive_intervals(table(spark, rows), Policy()).cache()
    return intervals.collect(), minute_deltas(intervals).cache(), intervals


@pytest.mark.parametrize("name", CASES)
def test_edge(spark, derived, name):
    day = list(CASES).index(name)
    _, want, on, off = CASES[name]
    curve = {r.minute: r.concurrent for r in dense_curve(derived[1], sec("09:00", day), sec("26:00", day)).collect()}
    check(name, day, want, on, off, [r for r in derived[0] if r.video_session_id == name], curve)


def test_shared_minutes_have_the_first_platform(derived):
    day = list(CASES).index("another platform after a pause")
    rows = change_curve(derived[1].where(F.col("minute").between(sec("10:00", day), sec("11:00", day))), ["platform"]).where("concurrent > 0").collect()
    assert {r.platform for r in rows} == {"web"}


def test_users(spark):
    """One user in two sessions, in two platforms, and two users in one session: neither sums up, and users can exceed sessions."""
    rows = []
    for day, (sessions, platforms) in enumerate(((("A", "B"), ("web", "web")), (("C", "D"), ("web", "tv")))):
        rows += [event(sec(c, day), session=s, user=f"U{day}", platform=p) for s, p in zip(sessions, platforms, strict=True) for c in ("10:00:10", "10:00:50")]
    rows += [event(sec(c, 2), n, session="E", user=u) for c, n, u in (("10:00:10", "beat", "UA"), ("10:00:30", "pause", "UA"), ("10:00:50", "resume", "UB"), ("10:01:20", "beat", "UB"))]
    intervals = derive_intervals(table(spark, rows), Policy()).cache()
    deltas, users = minute_deltas(intervals), user_minutes(intervals)
    sessions = lambda day: [r.concurrent for r in dense_curve(deltas, sec("10:00", day), sec("10:03", day)).collect()]
    total = {r.minute: r.concurrent_users for r in user_curve(users).collect()}
    each = {(r.minute, r.platform): r.concurrent_users for r in user_curve(users, ["platform"]).collect()}
    assert sessions(0) == sessions(1) == [2, 2, 0] and sessions(2) == [1, 1, 1]
    assert [total.get(sec(m, day)) for day in (0, 1) for m in ("10:00", "10:01", "10:02")] == [1, 1, None] * 2
    assert each[sec("10:00", 1), "web"] == each[sec("10:00", 1), "tv"] == 1
    assert [total[sec(m, 2)] for m in ("10:00", "10:01", "10:02")] == [2, 1, 1]


def test_late_events(spark, tmp_path):
    """What was published first, less what it said, plus what is true: keys that vanish net to zero."""
    publisher = Publisher(spark, str(tmp_path), Policy())
    for batch in (0, 1):
        publisher.process(table(spark, [r for k, (name, c) in enumerate(LATE.items()) for r in rows_of(name, k, c[batch])]), batch)
    intervals, deltas = publisher.intervals().collect(), publisher.deltas().cache()
    for k, (name, (_, _, want, on, off, platforms)) in enumerate(LATE.items()):
        curve = {r.minute: r.concurrent for r in dense_curve(deltas, sec("09:00", k), sec("12:00", k)).collect()}
        check(name, k, want, on, off, [r for r in intervals if r.video_session_id == name], curve)
        by = change_curve(deltas.where(F.col("minute").between(sec("09:00", k), sec("12:00", k))), ["platform"]).where("concurrent <> 0").collect()
        assert {r.platform for r in by} == platforms
