"""The variant policies against a plain reading of each, second by second, over random sessions."""

import random

import pytest
from builders import BASE, event, table

from kelpline.operators.intervals import derive_intervals
from kelpline.policy import VARIANTS, Policy


def plain(rows, policy):
    """(session, start, end): runs of live events, what pauses and backgrounds take away as sets of seconds, the tail."""
    out = set()
    for session in {r[1] for r in rows}:
        own = sorted((r[5], r[3], r[4]) for r in rows if r[1] == session)
        at = lambda f: sorted(t for t, k, n in own if f(k, n))
        live = {"all": lambda k: True, "no_background": lambda k: k not in ("AppBackgrounded", "AppForegrounded"), "playback": lambda k: k in ("VideoHeartbeat", "VideoPlay")}[policy.liveness]
        times = sorted(set(at(lambda k, n: live(k))))
        pauses, resumes = at(lambda k, n: n == "pause"), at(lambda k, n: n == "resume")
        away, back, beats = (at(lambda k, n, x=x: k == x) for x in ("AppBackgrounded", "AppForegrounded", "VideoHeartbeat"))
        first = lambda xs, t, strict=False: next((x for x in xs if (x > t if strict else x >= t)), None)
        runs = []
        for t in times:
            if not runs or t - runs[-1][-1] > policy.gap_s:
                runs.append([])
            runs[-1].append(t)
        for run in runs:
            a, b = run[0], run[-1]
            taken = set()

            def take(p, end, a=a, b=b, taken=taken):
                taken |= set(range(p, min(b if end is None else end, b)))

            for p in pauses:
                if a <= p < b:
                    end = first(resumes, p)
                    if end is None and not policy.unclosed_pause_to_run_end:
                        end = first(run, p, True)
                    take(p, end)
            if policy.background != "ignored":
                for p in away:
                    if a <= p < b:
                        end = first(back, p)
                        if end is None:
                            end = {"run_end": None, "next_event": first(run, p, True), "next_heartbeat": first(beats, p, True)}[policy.background]
                        take(p, end)
            if policy.background_carries:
                last = lambda xs, a=a: max((x for x in xs if x < a), default=-1)
                if last(away) > last(back):
                    take(a, first(back, a))
            start = None
            for t in range(a, b + 1):
                if t < b and t not in taken and start is None:
                    start = t
                if start is not None and (t == b or t in taken):
                    tail = 0
                    if t == b:
                        cap = first(away, b) if policy.background_caps_tail else None
                        tail = policy.tail_s if cap is None else min(policy.tail_s, cap - b)
                    out.add((session, start, t + tail))
                    start = None
    return out


def sessions(seed):
    rng = random.Random(seed)
    rows = []
    for s in range(40):
        t = BASE + rng.randrange(3600)
        for _ in range(rng.randrange(1, 30)):
            what = rng.choices(["beat", "pause", "resume", "AppBackgrounded", "AppForegrounded", "VideoPlay"], [8, 2, 2, 2, 2, 1])[0]
            rows.append(event(t, what, f"s{s}", kind=what if what[:3] in ("App", "Vid") else "VideoHeartbeat"))
            t += rng.choice([0, 1, 20, 60, 149, 151, 400])
    return rows


@pytest.mark.parametrize("name", [*VARIANTS, "playback"])
def test_variant(spark, name):
    policy = VARIANTS.get(name) or Policy(liveness="playback", background="next_heartbeat", background_carries=True)
    rows = sessions(sum(map(ord, name)))
    got = {(r.video_session_id, r.start_s, r.end_s) for r in derive_intervals(table(spark, rows), policy).collect()}
    assert got == plain(rows, policy)


def test_what_a_policy_refuses():
    for wrong in ({"liveness": "some"}, {"background": "never"}, {"background_carries": True}, {"background_caps_tail": True}):
        with pytest.raises(ValueError):
            Policy(**wrong)
    assert len({p.digest for p in VARIANTS.values()}) == len(VARIANTS)
