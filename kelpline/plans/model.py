"""The tiers of one event table, built once: intervals, minute deltas, hours, user minutes."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.operators.hours import hour_rollup
from kelpline.operators.intervals import derive_intervals, session_spans
from kelpline.operators.minutes import each_minute, minute, minute_deltas, user_pieces
from kelpline.policy import Policy
from kelpline.sources.schema import KEYS
from kelpline.sources.workspace import removed, shared_dir, written


#: Of the users tier; a row is about 100 bytes while it is sorted.
MINUTES_A_TASK = 1_000_000


@dataclass
class Model:
    events: DataFrame
    catalog: DataFrame
    policy: Policy

    @cached_property
    def folder(self) -> str:
        return f"{shared_dir(self.events.sparkSession)}/kelpline/model-{uuid.uuid4().hex}"

    def release(self) -> None:
        """Delete the tiers; results that still read them become invalid."""
        if "folder" in self.__dict__:
            removed(self.events.sparkSession, self.folder)
            for name in ("folder", "intervals", "spans", "deltas", "hours", "users"):
                self.__dict__.pop(name, None)

    @cached_property
    def intervals(self) -> DataFrame:
        """In order of sessions, each in one file: the order for a session's history, as that of the other tiers is for a time's."""
        return written(derive_intervals(self.events, self.policy).sortWithinPartitions("video_session_id", "start_s"), f"{self.folder}/intervals", lookups=("video_session_id", "content_id"))

    @cached_property
    def spans(self) -> DataFrame:
        """First and last event, and how many, of each session."""
        return written(session_spans(self.events).sortWithinPartitions("video_session_id"), f"{self.folder}/spans", lookups=("video_session_id",))

    @cached_property
    def deltas(self) -> DataFrame:
        """Partitioned by day, so a range reads its days only."""
        return _by_day(minute_deltas(self.intervals), "minute", f"{self.folder}/deltas", "minute")

    @cached_property
    def hours(self) -> DataFrame:
        return _by_day(hour_rollup(self.deltas), "hour", f"{self.folder}/hours", "cube_level", "hour")

    @cached_property
    def users(self) -> DataFrame:
        """Dealt as pieces of an hour, which become minutes where they are written: so many tasks that each sorts its minutes in memory."""
        spans = (minute(F.col("end_s")) - minute(F.col("start_s"))) / 60 + 1
        tasks = -(-int(self.intervals.agg(F.coalesce(F.sum(spans), F.lit(0))).first()[0]) // MINUTES_A_TASK)
        pieces = user_pieces(self.intervals).withColumn("day", F.floor(F.col("hour") / 86400) * 86400)
        # an hour that is more than a task's share goes to several; pieces are put in order of time, which the writer's order of days keeps
        dealt = pieces.repartition(tasks, "hour", F.pmod(F.xxhash64("user_id"), F.lit(-(-tasks // 24)))) if tasks > 1 else pieces.hint("rebalance", "day")
        rows = dealt.sortWithinPartitions("day", "hour").select(each_minute(F.col("first_m"), F.col("last_m")).alias("minute"), *KEYS, "user_id", "day")
        return written(rows, f"{self.folder}/users", "day")

    def build(self) -> None:
        """All tiers; those that do not need each other at the same time."""
        _ = self.intervals
        with ThreadPoolExecutor(3) as pool:
            for done in [pool.submit(getattr, self, name) for name in ("hours", "users", "spans")]:
                done.result()


def _by_day(rows: DataFrame, at: str, path: str, *order: str) -> DataFrame:
    """A tier in folders by day: small days of a task together, large ones dealt over as many tasks as their size asks for."""
    days = rows.withColumn("day", F.floor(F.col(at) / 86400) * 86400)
    return written(days.hint("rebalance", "day").sortWithinPartitions("day", *order), path, "day")


#: Added to a content's number where the catalog is to have no row of it.
UNLISTED = 1_000_000_000
#: The driver's events are far sparser than a player's: a longer silence and tail give runs of several events.
SPARSE = Policy(gap_s=14_400, tail_s=600, minute_cover_s=240)


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` as player events: user_id is the session, two sessions a user, props.k the dimensions.

    Contents are numbered by k and the session; of each twenty two are contents whose ids no part has.
    """
    raw = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("long")
    rows = raw.select("event_id", "user_id", "event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("ts_s"), k.alias("k"))
    kind = F.when((F.col("event_type") == "error") & (F.col("k") < 20), "VideoSessionEnd").when((F.col("event_type") == "error") & (F.col("k") < 45), "AppBackgrounded").when((F.col("event_type") == "error") & (F.col("k") < 70), "AppForegrounded").when(F.col("event_type") == "error", "VideoError").when(F.col("event_type").isin("purchase", "signup"), "VideoPlay").otherwise("VideoHeartbeat")
    name = F.when(F.col("event_type") == "purchase", "pause").when(F.col("event_type") == "signup", "resume").when(kind.isin("AppBackgrounded", "AppForegrounded"), kind).otherwise("beat")
    pick = lambda *values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("k") % len(values) + 1).cast("int"))
    resolution = F.create_map(F.lit("video_resolution"), pick("720p", "1080p", "480p", ""))
    return rows.select(
        (F.col("k") % 20 + 1 + F.when(F.col("k") % 20 < 18, F.col("user_id") % 5 * 20).otherwise(UNLISTED)).cast("long").alias("content_id"), F.concat(F.lit("s"), F.col("user_id")).alias("video_session_id"), F.concat(F.lit("u"), F.floor(F.col("user_id") / 2)).alias("user_id"),
        kind.alias("event_type"), name.alias("event"), "ts_s", F.concat(F.lit("p"), F.col("k") % 4).alias("platform"), F.concat(F.lit("5.0."), F.col("k") % 3, F.lit(".00")).alias("app_version"),
        F.concat(F.lit("c"), F.col("user_id") % 3).alias("country"), pick("hin", "HIN", "hin-Hindi", "eng", "OFF").alias("audio_language"), pick("eng", "none").alias("subtitle_language"),
        pick("pv1", "PV1", "pv2").alias("player_version"), F.when(F.col("k") % 3 != 0, resolution).otherwise(F.create_map().cast("map<string,string>")).alias("extra"), (F.col("ts_s") - F.col("k")).alias("session_start_s"),
    )


def catalog_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as a catalog; titles are shared, some values are blank."""
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet")
    key = F.col("p_partkey")
    return part.select(key.cast("long").alias("content_id"), F.concat(F.lit("title "), key % 7).alias("title"), F.when(key % 6 == 0, "").when(key % 2 == 0, "live").otherwise("vod").alias("video_type"), F.concat(F.lit("cat"), key % 3).alias("category"), F.concat(F.lit("show"), key % 4).alias("show_name"))


_MODELS: dict[tuple[str, str], Model] = {}
_SEEN: dict[tuple[str, str], tuple] = {}


def _written_at(spark: SparkSession, path: str) -> tuple:
    """Length and time of the files at ``path``, by which changed data are told from those seen before."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p))


def model_of(spark: SparkSession, sf_dir: str) -> Model:
    """The tiers of a folder, built by the first query of a session that needs them, and anew if its files have changed."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _MODELS and key not in _SEEN:  # one that was put there
        return _MODELS[key]
    seen = tuple(_written_at(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ("events", "part"))
    if _SEEN.get(key) != seen:
        if key in _MODELS:
            _MODELS[key].release()
        _MODELS[key], _SEEN[key] = Model(events_of(spark, sf_dir), catalog_of(spark, sf_dir), SPARSE), seen
    return _MODELS[key]
