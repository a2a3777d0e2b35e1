"""Active intervals of each session: runs of events without a long silence, less pauses, plus a short tail.

Input rows are events (video_session_id, ts_s in whole seconds, event_type, event, user_id, the dimensions
and the map ``extra``). No session is gathered into an array: all steps are windows over one sort by
session and time, so a session of any length spills like any sorted data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.policy import Policy

VOTED = ("user_id", "content_id", "platform", "country", "app_version", "audio_language", "subtitle_language", "player_version")


class _Frames:
    """Windows over a session in order of time and against it.

    What comes next is a running value against time, so no frame is scanned again for each row.
    """

    def __init__(self) -> None:
        self.session = Window.partitionBy("video_session_id")
        self.after, self.before = self.session.orderBy("ts_s"), self.session.orderBy(F.col("ts_s").desc())
        self.so_far, self.onward = (w.rangeBetween(Window.unboundedPreceding, 0) for w in (self.after, self.before))
        self.earlier, self.later = (w.rangeBetween(Window.unboundedPreceding, -1) for w in (self.after, self.before))


def _at(condition: Column) -> Column:
    return F.when(condition, F.col("ts_s"))


def _live(policy: Policy) -> Column:
    kind = F.col("event_type")
    return {"all": F.lit(True), "no_background": ~kind.isin("AppBackgrounded", "AppForegrounded"), "playback": kind.isin("VideoHeartbeat", "VideoPlay")}[policy.liveness]


def _edges(events: DataFrame, policy: Policy) -> DataFrame:
    """Events with _first and _last: does a run begin or end with them?"""
    w = _Frames()
    apart = lambda a, b: F.coalesce(a - b > policy.gap_s, F.lit(True))
    if policy.liveness == "all":
        return events.withColumns({"_first": apart(F.col("ts_s"), F.lead("ts_s").over(w.before)), "_last": apart(F.lag("ts_s").over(w.before), F.col("ts_s"))})
    live = _live(policy)
    beside = lambda order: F.last(_at(live), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = events.withColumn("_first", live & apart(F.col("ts_s"), beside(w.after)))
    return rows.withColumn("_last", live & apart(beside(w.before), F.col("ts_s")))


def with_runs(events: DataFrame, policy: Policy) -> DataFrame:
    """Events with what is known of their run and segment.

    _run (a number within the session), _start and _end: the run, null outside of any. _e: until when the event
    takes time away, if it is a pause (or a background that counts) before its run's end. _from and _to: the segment
    without such time that the event is in, from the run's start or the end of what was taken to the run's end or the next taking;
    null if it is in none. _tail: the segment's grace. Every segment has an event, that which ends it.
    Windows over one exchange and two sorts of a session.
    """
    w = _Frames()
    kind, name, t = F.col("event_type"), F.col("event"), F.col("ts_s")
    rows = _edges(events, policy)
    taking = policy.background != "ignored"
    if policy.background_carries:
        away = F.max(_at(kind == "AppBackgrounded")).over(w.earlier) > F.coalesce(F.max(_at(kind == "AppForegrounded")).over(w.earlier), F.lit(-(1 << 62)))
        rows = rows.withColumn("_away", F.coalesce(away, F.lit(False)))
    following = {"_end": F.min(_at(F.col("_last"))).over(w.onward), "_next_first": F.min(_at(F.col("_first"))).over(w.later), "_resume": F.min(_at(name == "resume")).over(w.onward)}
    if taking:
        following |= {"_fg": F.min(_at(kind == "AppForegrounded")).over(w.onward), "_bg": F.min(_at(kind == "AppBackgrounded")).over(w.onward)}
    if not policy.unclosed_pause_to_run_end or policy.background == "next_event":
        following["_next"] = F.min(_at(_live(policy))).over(w.later)
    if policy.background == "next_heartbeat":
        following["_beat"] = F.min(_at(kind == "VideoHeartbeat")).over(w.later)
    rows = rows.withColumns(following).withColumn("_end", F.when(F.col("_next_first").isNull() | (F.col("_next_first") > F.col("_end")), F.col("_end")))
    past = F.col("_end") + 1
    until = lambda end, unclosed: F.when(end.isNotNull(), F.when(end <= F.col("_end"), end).otherwise(past)).otherwise(F.least(F.coalesce(unclosed, past), past))
    e = F.when(name == "pause", until(F.col("_resume"), past if policy.unclosed_pause_to_run_end else F.col("_next")))
    if taking:
        unclosed = {"run_end": past, "next_event": F.col("_next") if policy.background == "next_event" else past, "next_heartbeat": F.col("_beat") if policy.background == "next_heartbeat" else past}
        e = F.greatest(e, F.when(kind == "AppBackgrounded", until(F.col("_fg"), unclosed[policy.background])))
    rows = rows.withColumn("_e", F.when((t < F.col("_end")) & (e > t), e))
    begin = F.when(F.col("_away"), until(F.col("_fg"), past)).otherwise(t) if policy.background_carries else t
    rows = rows.withColumn("_begin", F.when(F.col("_first"), begin))
    onward = {"_taken": F.min(_at(F.col("_e").isNotNull())).over(w.onward)}
    if policy.background_caps_tail:
        onward["_cap"] = F.min(F.when(F.col("_last"), F.struct("ts_s", "_bg"))).over(w.onward)["_bg"]
    rows = rows.withColumns(onward)
    rows = rows.withColumns({
        "_run": F.when(F.col("_end").isNotNull(), F.sum(F.col("_first").cast("int")).over(w.so_far)), "_start": F.when(F.col("_end").isNotNull(), F.max(_at(F.col("_first"))).over(w.so_far)),
        "_from": F.greatest(F.max("_begin").over(w.so_far), F.max("_e").over(w.earlier)),
    })
    to = F.least(F.coalesce("_taken", "_end"), F.col("_end"))
    active = F.col("_end").isNotNull() & (F.col("_from") <= t) & ((to >= F.col("_from")) if policy.point_activity_counts else (to > F.col("_from")))
    tail = F.least(F.lit(policy.tail_s), F.col("_cap") - F.col("_end")) if policy.background_caps_tail else F.lit(policy.tail_s)
    rows = rows.withColumns({"_from": F.when(active, F.col("_from")), "_to": F.when(active, to), "_tail": F.when(active & (to == F.col("_end")), tail).when(active, 0)})
    return rows.select(*events.columns, "_run", "_start", "_end", "_e", "_from", "_to", "_tail")


def pause_windows(runs: DataFrame, policy: Policy) -> DataFrame:
    """(video_session_id, _run, _start, _end, p, e): each pause before its run's end, to the resume that ends it, of ``with_runs``.

    The resume is the session's first at or after the pause. If it lies beyond the run, the pause lasts past
    the run's end; if there is none, it does too, or to the run's next event if the policy says so.
    """
    return runs.where("_e is not null").select("video_session_id", "_run", "_start", "_end", F.col("ts_s").alias("p"), F.col("_e").alias("e")).distinct()


def segments(events: DataFrame, policy: Policy) -> DataFrame:
    """(video_session_id, _run, seg_start, seg_end, start_s, end_s): what is left of each run without its pauses."""
    rows = with_runs(events, policy).where("_from is not null")
    return rows.select("video_session_id", "_run", F.col("_from").alias("seg_start"), F.col("_to").alias("seg_end"), F.col("_from").alias("start_s"), (F.col("_to") + F.col("_tail")).alias("end_s")).distinct()


def _votes(attributed: DataFrame) -> DataFrame:
    """The most frequent value of each column within a segment, the smallest on a tie."""
    modes = [F.expr(f"mode() within group (order by {c})").alias(c) for c in VOTED]
    return attributed.groupBy("video_session_id", "start_s", "end_s").agg(*modes, F.count(F.lit(1)).alias("_events"), F.first("is_open").alias("is_open"))


def _map_votes(attributed: DataFrame, totals: DataFrame) -> DataFrame:
    """Extra dimensions by key: the most frequent value if it is not less frequent than the key's absence."""
    key = ["video_session_id", "start_s", "end_s"]
    each = attributed.where(F.size("extra") > 0).select(*key, F.explode("extra").alias("k", "v"))
    counts = each.groupBy(*key, "k", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*key, "k").agg(F.sum("n").alias("present"), F.max("n").alias("top"), F.max_by("n", "n").alias("_n"), F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v"))
    kept = best.join(totals.select(*key, "_events"), key).where(F.col("top") >= F.col("_events") - F.col("present"))
    return kept.groupBy(*key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("extra_dimensions"))


def derive_intervals(events: DataFrame, policy: Policy, build_version: int = 1) -> DataFrame:
    """One row per active interval: session, start_s, end_s, the dominant user and dimensions, extra_dimensions, is_open.

    Events at both ends of a segment vote, those under the tail don't. A session is open if it has no
    VideoSessionEnd. Events must have a session, a time and a (maybe empty) map ``extra``.
    """
    runs = with_runs(events, policy).withColumn("is_open", F.max((F.col("event_type") == "VideoSessionEnd").cast("int")).over(_Frames().session) == 0)
    attributed = runs.where("_from is not null").withColumn("start_s", F.col("_from")).withColumn("end_s", F.col("_to") + F.col("_tail"))
    votes = _votes(attributed)
    keys = ["video_session_id", "start_s", "end_s"]
    out = votes.join(_map_votes(attributed, votes), keys, "left")
    extras = F.coalesce("extra_dimensions", F.create_map().cast("map<string,string>"))
    return out.select("video_session_id", *VOTED, extras.alias("extra_dimensions"), "start_s", "end_s", "is_open", F.lit(build_version).cast("long").alias("build_version"))


def session_spans(events: DataFrame) -> DataFrame:
    """(video_session_id, first_s, last_s, events) of each session."""
    return events.groupBy("video_session_id").agg(F.min("ts_s").alias("first_s"), F.max("ts_s").alias("last_s"), F.count(F.lit(1)).alias("events"))


def session_history(intervals: DataFrame, session: str) -> DataFrame:
    """All intervals of one session: a lookup that min-max statistics and bloom filters narrow to a few row groups."""
    return intervals.where(F.col("video_session_id") == session)


def latest(intervals: DataFrame, keys: tuple[str, ...] = ("video_session_id", "start_s"), version: str = "build_version") -> DataFrame:
    """The row of highest version for each key."""
    rest = [c for c in intervals.columns if c not in keys]
    best = intervals.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("_r"))
    return best.select(*keys, "_r.*").select(*intervals.columns)


def as_of(events: DataFrame, seconds: int, policy: Policy) -> DataFrame:
    """Intervals derived from the events before ``seconds`` alone."""
    return derive_intervals(events.where(F.col("ts_s") < seconds), policy)
