"""Small event tables, and a plain interpreter of the model that works on sets of seconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = 1_785_060_000  # a whole hour
SCHEMA = "content_id long, video_session_id string, user_id string, event_type string, event string, ts_s long, platform string, app_version string, country string, audio_language string, subtitle_language string, player_version string, extra map<string,string>"


def at(clock: str) -> int:
    """Seconds of hh:mm:ss, with 10:00:00 at BASE; fractions are cut off as the model does."""
    h, m, s = clock.split(":")
    return BASE + (int(h) - 10) * 3600 + int(m) * 60 + int(float(s))


def event(clock: str | int, name: str = "beat", session: str = "S1", user: str = "U1", platform: str = "web", kind: str | None = None, extra: dict | None = None, audio: str = "hin", content: int = 1):
    ts = at(clock) if isinstance(clock, str) else clock
    return (content, session, user, kind or ("VideoHeartbeat" if name == "beat" else "VideoPlay"), name, ts, platform, "1.0", "IN", audio, "none", "p1", extra or {})


def table(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)


def interpret(rows: list, gap: int, tail: int) -> set[tuple[str, int, int]]:
    """(session, start, end) of all intervals: runs as lists, pauses as sets of covered half-open seconds."""
    out = set()
    for session in {r[1] for r in rows}:
        own = sorted((r[5], r[4]) for r in rows if r[1] == session)
        times = sorted({t for t, _ in own})
        resumes = [t for t, n in own if n == "resume"]
        runs, run = [], [times[0]]
        for t in times[1:]:
            if t - run[-1] > gap:
                runs.append(run)
                run = []
            run.append(t)
        runs.append(run)
        for run in runs:
            a, b = run[0], run[-1]
            active = set(range(a, b))  # second t stands for [t, t + 1)
            for t, name in own:
                if name == "pause" and a <= t < b:
                    r = next((x for x in resumes if x >= t), None)
                    active -= set(range(t, r if r is not None and r <= b else b + 1))
            start = None
            for t in range(a, b + 1):
                if t in active and start is None:
                    start = t
                if start is not None and t not in active:
                    out.add((session, start, t + (tail if t == b else 0)))
                    start = None
    return out
