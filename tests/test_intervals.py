import random

import pytest
from builders import BASE, at, event, interpret, table
from pyspark.sql import functions as F

from kelpline.operators.hours import cube, hour_rollup, window_range
from kelpline.operators.intervals import as_of, derive_intervals, latest
from kelpline.operators.minutes import change_curve, dense_curve, expanded, level_at, minute_deltas, minute_series, naive_curve, user_curve, user_minutes
from kelpline.operators.reconcile import compare, verdict
from kelpline.policy import Policy

P = Policy()
CASES = {
    "plain run with tail": ([("10:00:00", "beat"), ("10:00:40", "beat"), ("10:01:20", "beat"), ("10:02:00", "beat")], [("10:00:00", "10:03:00")]),
    "pause without resume takes the rest": ([("10:00:30", "beat"), ("10:01:10", "beat"), ("10:02:00", "pause"), ("10:02:40", "beat"), ("10:03:20", "beat")], [("10:00:30", "10:02:00")]),
    "early pause": ([("10:00:10", "beat"), ("10:00:50", "pause"), ("10:01:30", "beat"), ("10:02:10", "beat")], [("10:00:10", "10:00:50")]),
    "lone events count for nothing": ([("10:00:00", "beat"), ("10:10:00", "beat")], []),
    "two pauses, one resume": ([("10:00:00", "beat"), ("10:00:40", "pause"), ("10:01:20", "pause"), ("10:02:00", "resume"), ("10:02:40", "beat")], [("10:00:00", "10:00:40"), ("10:02:00", "10:03:40")]),
    "a last pause still earns the tail": ([("10:00:00", "beat"), ("10:00:40", "beat"), ("10:01:00", "pause")], [("10:00:00", "10:02:00")]),
    "resume and pause in one second": ([("10:00:00", "beat"), ("10:01:00.1", "resume"), ("10:01:00.9", "pause"), ("10:01:40", "beat"), ("10:02:20", "beat")], [("10:00:00", "10:03:20")]),
    "a gap of exactly 150 s holds": ([("10:00:00", "beat"), ("10:02:30", "beat")], [("10:00:00", "10:03:30")]),
    "a gap of 151 s does not": ([("10:00:00", "beat"), ("10:02:31", "beat")], []),
}


@pytest.mark.parametrize("name", CASES)
def test_hand_derived(spark, name):
    rows, want = CASES[name]
    got = {(r.start_s, r.end_s) for r in derive_intervals(table(spark, [event(*r) for r in rows]), P).collect()}
    assert got == {(at(a), at(b)) for a, b in want}


def test_close_in_the_last_minute_of_an_hour_leaks_nothing(spark):
    rows = [event("10:57:30"), event("10:59:10", "pause"), event("10:59:50"), event("11:00:30")]
    deltas = minute_deltas(derive_intervals(table(spark, rows), P))
    got = {r.minute: r.concurrent for r in dense_curve(deltas, at("10:56:00"), at("11:02:00")).collect()}
    assert [got[at(f"10:5{k}:00")] for k in (6, 7, 8, 9)] == [0, 1, 1, 1] and got[at("11:00:00")] == 0


def test_votes_and_first_dimensions_win_shared_minutes(spark):
    rows = [event("10:00:00"), event("10:00:40", "pause"), event("10:01:10", "resume", platform="android"), event("10:01:30", platform="android"), event("10:01:50", platform="android")]
    iv = derive_intervals(table(spark, rows), P)
    assert {(r.start_s, r.platform) for r in iv.collect()} == {(at("10:00:00"), "web"), (at("10:01:10"), "android")}
    assert {(r.minute, r.platform) for r in change_curve(minute_deltas(iv), ["platform"]).where("concurrent > 0").collect()} == {(at("10:00:00"), "web")}


def test_map_votes_need_as_many_as_absences(spark):
    rows = [event("10:00:00", extra={"q": "hd", "r": "x"}), event("10:00:30", extra={"q": "sd"}), event("10:01:00", extra={"q": "sd"}), event("10:01:30")]
    got = derive_intervals(table(spark, rows), P).first().extra_dimensions
    assert got == {"q": "sd"}


def test_mode_ties_take_the_smallest(spark):
    rows = [event("10:00:00", audio="b", content=-5), event("10:00:30", audio="a", content=3), event("10:01:00", audio="b", content=3), event("10:01:30", audio="a", content=-5)]
    r = derive_intervals(table(spark, rows), P).first()
    assert (r.audio_language, r.content_id, r.is_open) == ("a", -5, True)


def _random(seed: int, sessions: int = 25):
    rng = random.Random(seed)
    rows = []
    for s in range(sessions):
        t = BASE + rng.randrange(7200)
        for _ in range(rng.randrange(1, 25)):
            name = rng.choices(["beat", "pause", "resume"], [6, 2, 2])[0]
            rows.append(event(t, name, f"s{s}", f"u{s % 7 if rng.random() < 0.9 else 99}", rng.choice(["web", "tv"])))
            if rng.random() < 0.1:
                rows.append(rows[-1])
            t += rng.choice([0, 1, 20, 60, 149, 150, 151, 400])
        if rng.random() < 0.3:
            rows.append(event(t, "end", f"s{s}", "u1", kind="VideoSessionEnd"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_sessions_against_sets_of_seconds(spark, seed):
    rows = _random(seed)
    events = table(spark, rows)
    iv = derive_intervals(events, P).cache()
    assert {(r.video_session_id, r.start_s, r.end_s) for r in iv.collect()} == interpret(rows, P.gap_s, P.tail_s)
    deltas = minute_deltas(iv).cache()
    truth = {r.minute: r.concurrent for r in expanded(iv).collect()}
    lo, hi = BASE, BASE + 6 * 3600
    served = {r.minute: r.concurrent for r in dense_curve(deltas, lo, hi).collect()}
    assert all(served[m] == truth.get(m, 0) for m in served) and set(truth) <= set(served)
    said = verdict(compare(events, deltas, P), P).first()
    assert said.verdict == "PASS" and said.peak == max(truth.values())
    users = {r.minute: r.concurrent_users for r in user_curve(user_minutes(iv)).collect()}
    want: dict[int, set] = {}
    for r in iv.collect():
        for m in range(r.start_s // 60 * 60, r.end_s // 60 * 60 + 1, 60):
            want.setdefault(m, set()).add(r.user_id)
    assert users == {m: len(u) for m, u in want.items()}
    hours = hour_rollup(deltas).cache()
    for a, b in ((lo + 1017, lo + 9000), (lo, lo + 7200), (lo + 600, lo + 1300), (lo + 3601, lo + 3659)):
        got = window_range(deltas, hours, a, b).first()
        clipped = {m: (c, max(m, a), min(m + 60, b)) for m, c in truth.items() if m + 60 > a and m < b}
        assert got.integral == sum(c * (y - x) for c, x, y in clipped.values())
        top = max((c for c, _, _ in clipped.values()), default=0)
        assert got.peak == top and (top == 0 or got.peak_minute == min(x for c, x, _ in clipped.values() if c == top))
        assert got.avg_concurrent == got.integral / (b - a)


def test_interval_expansion_of_empty_input(spark):
    iv = derive_intervals(table(spark, []), P)
    assert iv.count() == 0 and minute_deltas(iv).count() == 0 and hour_rollup(minute_deltas(iv)).count() == 0


def test_cube_keeps_a_real_sentinel_apart(spark):
    rows = [event("10:00:00", platform="*", content=-1), event("10:01:00", platform="*", content=-1), event("10:00:00", session="S2"), event("10:01:00", session="S2")]
    deltas = minute_deltas(derive_intervals(table(spark, rows), P))
    hours = hour_rollup(deltas)
    assert window_range(deltas, hours, at("10:00:00"), at("11:00:00")).first().peak == 2
    assert window_range(deltas, hours, at("10:00:00"), at("11:00:00"), platform="*").first().peak == 1
    assert cube(deltas).select("cube_level").distinct().count() == 8


def test_series_point_lookup_and_guards(spark):
    deltas = minute_deltas(derive_intervals(table(spark, [event("10:00:00"), event("10:02:00")]), P))
    series = {r.minute: r.concurrent for r in minute_series(deltas).collect()}
    assert series[at("10:03:00")] == 1 and series[at("10:04:00")] == 0 and series[at("11:59:00")] == 0
    assert level_at(deltas, at("10:01:30")).first().concurrent == 1
    with pytest.raises(ValueError):
        dense_curve(deltas, at("10:00:30"), at("10:05:00"))
    with pytest.raises(ValueError):
        window_range(deltas, hour_rollup(deltas), 100, 100)


def test_versions_prefixes_and_naive_spans(spark):
    rows = [event("10:00:00"), event("10:01:00"), event("10:02:00")]
    events = table(spark, rows)
    one, two = derive_intervals(events, P, 1), derive_intervals(events, P, 2)
    kept = latest(one.unionByName(two)).collect()
    assert [r.build_version for r in kept] == [2]
    assert as_of(events, at("10:01:30"), P).first().end_s == at("10:02:00")
    assert {r.minute for r in naive_curve(events).collect()} == {at("10:00:00"), at("10:01:00")}


def test_policy_variants(spark):
    rows = [event("10:00:00"), event("10:01:00", "pause"), event("10:02:00"), event("10:03:00")]
    until_next = derive_intervals(table(spark, rows), Policy(unclosed_pause_to_run_end=False))
    assert {(r.start_s, r.end_s) for r in until_next.collect()} == {(at("10:00:00"), at("10:01:00")), (at("10:02:00"), at("10:04:00"))}
    lone = derive_intervals(table(spark, [event("10:00:00")]), Policy(point_activity_counts=True))
    assert [(r.start_s, r.end_s) for r in lone.collect()] == [(at("10:00:00"), at("10:01:00"))]
    with pytest.raises(ValueError):
        Policy(gap_s=0)
    assert Policy().digest != Policy(gap_s=151).digest
    assert F is not None
