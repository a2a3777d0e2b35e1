"""Deterministic event streams of any size, and cohorts whose answers follow from how they are built."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START_S = 1_785_024_000  # 2026-07-26


def event_stream(spark: SparkSession, sessions: int, beats: int = 30, days: int = 1, seed: int = 1) -> DataFrame:
    """``sessions`` x ``beats`` events: each is a function of its number alone, so any part can be made anywhere."""
    draw = lambda salt, n: F.pmod(F.xxhash64("s", F.lit(salt), F.lit(seed)), F.lit(n))
    each = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt), F.lit(seed)), F.lit(n))
    rows = spark.range(sessions * beats).select("id", F.floor(F.col("id") / beats).alias("s"), (F.col("id") % beats).alias("k"))
    name = F.when(each(1, 20) == 0, "pause").when(each(1, 20) == 1, "resume").otherwise("beat")
    return rows.select(
        (draw(2, 200) + 1).alias("content_id"), F.concat(F.lit("s"), F.col("s")).alias("video_session_id"), F.concat(F.lit("u"), draw(3, max(1, sessions * 9 // 10))).alias("user_id"),
        F.when(F.col("k") == beats - 1, "VideoSessionEnd").when(name == "beat", "VideoHeartbeat").otherwise("VideoPlay").alias("event_type"), name.alias("event"),
        (F.lit(START_S) + draw(4, days * 86_400) + F.col("k") * 60 + each(5, 50)).alias("ts_s"), F.concat(F.lit("p"), draw(6, 19)).alias("platform"), F.concat(F.lit("5.0."), draw(7, 9)).alias("app_version"),
        F.concat(F.lit("c"), draw(8, 30)).alias("country"), F.element_at(F.array(*[F.lit(x) for x in ("hin", "HIN", "eng", "off")]), (draw(9, 4) + 1).cast("int")).alias("audio_language"), F.lit("none").alias("subtitle_language"),
        F.lit("pv1").alias("player_version"), F.create_map(F.lit("video_resolution"), F.concat(draw(10, 4) * 360, F.lit("p"))).alias("extra"), F.lit(START_S).cast("long").alias("session_start_s"),
    )


@dataclass(frozen=True)
class Cohort:
    """Sessions that start ``stagger_s`` apart, each ``span_s`` long with an event every ``beat_s`` and one at its end.

    ``pause`` is when each pauses and resumes, with two beats between; every row comes ``copies`` times. Each session is
    active from its start (but for the pause) to its last event and a tail beyond it.
    """

    sessions: int
    span_s: int
    beat_s: int
    stagger_s: int = 0
    pause: tuple[int, int] | None = None
    copies: int = 1

    def active(self, tail_s: int) -> list[tuple[int, int]]:
        """The intervals of the first session, from its start."""
        end = self.span_s + tail_s
        return [(0, end)] if self.pause is None else [(0, self.pause[0]), (self.pause[1], end)]


#: Cohorts whose curves follow from how they are built.
COHORTS = {
    "staircase": Cohort(60, 600, 30, 60), "blocks": Cohort(8, 1800, 40, 300), "paused": Cohort(10, 1800, 30, 0, (300, 600)), "one": Cohort(1, 300, 60), "same_start": Cohort(200, 600, 30), "copied": Cohort(1, 300, 60, copies=5),
    "lone_event": Cohort(1, 0, 60), "empty": Cohort(0, 600, 30),
}


def _events(rows: DataFrame) -> DataFrame:
    """Events of (s, at, event): the session's number, seconds since START_S, and the event, all else being the same."""
    kind = F.when(F.col("event").isin("VideoSessionStart", "VideoSessionEnd"), F.col("event")).otherwise("VideoHeartbeat")
    return rows.select(
        F.lit(1).cast("long").alias("content_id"), F.concat(F.lit("s"), F.col("s")).alias("video_session_id"), F.concat(F.lit("u"), F.col("s")).alias("user_id"), kind.alias("event_type"), "event", (F.col("at") + START_S).cast("long").alias("ts_s"),
        F.lit("p0").alias("platform"), F.lit("5.0.0").alias("app_version"), F.lit("c0").alias("country"), F.lit("hin").alias("audio_language"), F.lit("none").alias("subtitle_language"), F.lit("pv1").alias("player_version"),
        F.create_map().cast("map<string,string>").alias("extra"), F.lit(START_S).cast("long").alias("session_start_s"),
    )


def cohort(spark: SparkSession, name: str) -> DataFrame:
    """Events of one of COHORTS."""
    c = COHORTS[name]
    first = "beat" if c.span_s == 0 else "VideoSessionStart"
    moments = [(0, first), *[(t, "beat") for t in range(c.beat_s, c.span_s, c.beat_s)]] + ([(c.span_s, "VideoSessionEnd")] if c.span_s else [])
    if c.pause:
        third = (c.pause[1] - c.pause[0]) // 3
        moments += [(c.pause[0], "pause"), (c.pause[1], "resume"), (c.pause[0] + third, "beat"), (c.pause[0] + 2 * third, "beat")]
    each = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(e).alias("event")) for t, e in moments for _ in range(c.copies)])
    rows = spark.range(c.sessions).select(F.col("id").alias("s"), F.explode(each).alias("m"))
    return _events(rows.select("s", (F.col("m.t") + F.col("s") * c.stagger_s).alias("at"), F.col("m.event").alias("event")))


def arrivals(spark: SparkSession, sessions: int, over_s: int, mean_s: float, seed: int = 1, uniform: tuple[int, int] | None = None, beat_s: int = 40) -> DataFrame:
    """Sessions that start at any time of ``over_s`` and last 5 s and an exponential time of ``mean_s`` on average, or a ``uniform`` one.

    For checks by expectation: by Little's law concurrency away from the edges is arrivals a second times the mean active time.
    """
    draw = lambda salt: (F.pmod(F.xxhash64("id", F.lit(salt), F.lit(seed)), F.lit(1 << 40)) + 1) / F.lit(float(1 << 40))
    span = (5 + F.floor(-F.log(draw(1)) * mean_s)) if uniform is None else F.floor(uniform[0] + draw(1) * (uniform[1] - uniform[0]))
    rows = spark.range(sessions).select(F.col("id").alias("s"), F.floor(draw(2) * over_s).alias("at"), span.cast("long").alias("span"))
    steps = F.array_union(F.sequence(F.lit(0).cast("long"), F.col("span"), F.lit(beat_s).cast("long")), F.array("span"))
    return _events(rows.select("s", "at", F.explode(steps).alias("t")).select("s", (F.col("at") + F.col("t")).alias("at"), F.lit("beat").alias("event")))


def staircase(spark: SparkSession, sessions: int = 60, length_s: int = 600, beat_s: int = 30, step_s: int = 60) -> DataFrame:
    """One session more every ``step_s``, each ``length_s`` long: ``sessions`` intervals of length_s + tail each."""
    rows = spark.range(sessions).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(length_s // beat_s))))
    base = event_stream(spark, 1, 1).limit(1).drop("video_session_id", "user_id", "ts_s", "event", "event_type")
    made = rows.select(F.concat(F.lit("s"), F.col("id")).alias("video_session_id"), F.concat(F.lit("u"), F.col("id")).alias("user_id"), F.lit("VideoHeartbeat").alias("event_type"), F.lit("beat").alias("event"), (F.lit(START_S) + F.col("id") * step_s + F.col("k") * beat_s).cast("long").alias("ts_s"))
    return made.crossJoin(base)  # one row of constants
