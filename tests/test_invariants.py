"""Invariants between tiers and intervals against sets of minutes, and how many rows they make."""

import random

from builders import BASE

from kelpline.operators import invariants as V

INTERVALS = "video_session_id string, user_id string, platform string, country string, content_id long, start_s long, end_s long"


def _intervals(rng, n):
    """Sessions that change cell and user, share minutes with themselves and cross hours and days; some values are null."""
    starts = [BASE + 39_000 + 60 * k for k in range(0, 9000, 97)]
    rows = []
    for _ in range(n):
        a = rng.choice(starts[:9]) + rng.randrange(4000)
        rows.append((rng.choice(["s1", "s2", "s3", "s4", None]), rng.choice(["u1", "u2", "u3", "u4", "u5", None]), rng.choice(["web", "tv", "*", None]), rng.choice(["IN", "US"]), rng.choice([1, 2, None]), a, a + rng.choice([0, 59, 60, 3599, 3600, 9000])))
    return rows


def _cells(p, c, k):
    return [(g, p if g & 1 else "*", c if g & 2 else "*", k if g & 4 else -1) for g in range(8)]


def _minutes(a, b):
    return range(a // 60 * 60, b // 60 * 60 + 1, 60)


def _truth(rows):
    """Sessions by cell and minute; a session without a name makes the minute, but does not count."""
    found = {}
    for s, _, p, c, k, a, b in rows:
        for m in _minutes(a, b):
            for cell in _cells(p, c, k):
                found.setdefault((cell, m), set()).update({s} - {None})
    return {x: len(v) for x, v in found.items()}


def _rows_made(df):
    """Rows that Generate and Expand made when ``df`` was collected."""
    def walk(node):
        name = node.nodeName()
        below = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else [node.children().apply(i) for i in range(node.children().size())]
        own = node.metrics().apply("numOutputRows").value() if name in ("Generate", "Expand") and node.metrics().contains("numOutputRows") else 0
        assert name != "Expand", "each row once for each distinct count"
        return own + sum(map(walk, below))

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_day_peaks_same_as_sets(spark):
    rng = random.Random(11)
    rows = _intervals(rng, 60)
    days = {}
    for (cell, m), n in _truth(rows).items():
        peak, total = days.get((cell, m // 86400 * 86400), (0, 0))
        days[cell, m // 86400 * 86400] = (max(peak, n), total + 60 * n)
    assert len({d for _, d in days}) > 1
    served = {x: (p + (rng.random() < 0.2), i + 60 * (rng.random() < 0.3)) for x, (p, i) in days.items() if rng.random() < 0.9}
    served[(0, "*", "*", -1), BASE + 86400 * 90 // 86400 * 86400] = (5, 300)
    served = {(cell, d // 86400 * 86400): v for (cell, d), v in served.items()}
    want = {}
    for x in sorted(days.keys() | served.keys(), key=str):
        nameless = None in x[0]  # unknown keys equal nothing: each side is a row of its own
        live = (x in served and served[x] != (0, 0)) and served[x]
        for a, b in [(days.get(x), None), (None, live or None)] if nameless else [(days.get(x), live or None)]:
            if a or b:
                n, p, i = want.get(x[0][0], (0, 0, 0))
                a, b = a or (-1, -1), b or (-1, -1)
                want[x[0][0]] = (n + 1, p + (a[0] != b[0]), i + (a[1] != b[1]))
    hours = spark.createDataFrame([(*cell[1:], cell[0], d + 7200, p, i) for (cell, d), (p, i) in served.items()], "platform string, country string, content_id long, cube_level int, hour long, peak long, integral long")
    got = V.day_peaks(spark.createDataFrame(rows, INTERVALS), hours).collect()
    assert {r.cube_level: (r.rows_compared, r.peak_mismatch, r.integral_mismatch) for r in got} == want
    assert all(r.verdict == "FAIL" for r in got)


def test_day_peaks_make_few_rows_of_long_sessions(spark):
    hours = spark.createDataFrame([], "platform string, country string, content_id long, cube_level int, hour long, peak long, integral long")
    long = spark.createDataFrame([("s1", "u1", "web", "IN", 1, BASE, BASE + 3600 * 1000 - 1)], INTERVALS)
    assert _rows_made(V.day_peaks(long, hours)) <= 12 * 1000  # of 60,000 minutes at eight levels


def test_users_and_sessions_same_as_sets(spark):
    rng = random.Random(12)
    rows = _intervals(rng, 60)
    truth = _truth(rows)
    tier = {(m, p, c, k, u) for _, u, p, c, k, a, b in rows for m in _minutes(a, b)}
    tier |= {(m, "web", "IN", 1, f"x{i}") for m, *_ in rng.sample(sorted(tier, key=str), 40) for i in range(3)}  # users that nobody's session has
    served = {}
    for m, p, c, k, u in tier:
        for cell in _cells(p, c, k):
            served.setdefault((cell, m), set()).update({u} - {None})
    want = {}
    for (cell, m), users in served.items():
        excess = len(users) - (0 if None in cell else truth.get((cell, m), 0))
        n, over, most = want.get(cell[0], (0, 0, -99))
        want[cell[0]] = (n + 1, over + (excess > 0), max(most, excess))
    got = V.users_le_sessions(spark.createDataFrame(rows, INTERVALS), spark.createDataFrame(list(tier), "minute long, platform string, country string, content_id long, user_id string")).collect()
    assert {r.cube_level: (r.cells_compared, r.violations, r.max_excess) for r in got} == want
    assert all(r.verdict == "FAIL" for r in got)


def test_users_and_sessions_make_few_rows_of_long_sessions(spark):
    from kelpline.operators.minutes import user_minutes

    long = spark.createDataFrame([("s1", "u1", "web", "IN", 1, BASE, BASE + 3600 * 1000 - 1)], INTERVALS)
    users = user_minutes(long.selectExpr("*", *[f"'x' AS {c}" for c in ("app_version", "audio_language", "subtitle_language", "player_version")])).localCheckpoint()
    assert _rows_made(V.users_le_sessions(long, users)) <= 24 * 1000  # of 60,000 minutes of sessions and of users at eight levels


def test_users_tier_of_many_tasks(spark, tmp_path, monkeypatch):
    """The minutes of one hour go to several tasks if they are many; each is there once, in its day's folder."""
    from builders import event, table

    from kelpline.plans import model
    from kelpline.policy import Policy

    rows = [event(BASE + 60 * k + 3600 * (s % 30), session=f"S{s}", user=f"U{s // 2}", content=s % 3) for s in range(40) for k in range(5)]
    few, many = (model.Model(table(spark, rows), None, Policy(gap_s=150, tail_s=60)) for _ in range(2))
    want = sorted(tuple(r) for r in few.users.collect())
    monkeypatch.setattr(model, "MINUTES_A_TASK", 3)
    deep = many.users
    assert sorted(tuple(r) for r in deep.collect()) == want and len(want) == len(set(want))
    assert len(deep.inputFiles()) > len(few.users.inputFiles()) and all(r.day == r.minute // 86400 * 86400 for r in deep.collect())
    few.release(), many.release()
