"""The minute tier: signed changes of concurrency, clipped at hours, and curves from them. Times are epoch seconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.sources.schema import DIMS, KEYS

_ORDER = ("app_version", "audio_language", "subtitle_language", "player_version", "platform", "country", "content_id")


def minute(seconds: Column) -> Column:
    return F.floor(seconds / 60) * 60


def hour(seconds: Column) -> Column:
    return F.floor(seconds / 3600) * 3600


def within(rows: DataFrame, column: str, start_s: int, end_s: int) -> DataFrame:
    """Rows whose ``column`` is in [start_s, end_s): plain bounds that reach the scan, and whole days if the table is partitioned by day."""
    rows = rows.where((F.col(column) >= start_s) & (F.col(column) < end_s))
    return rows.where(F.col("day").between(start_s // 86400 * 86400, (end_s - 1) // 86400 * 86400)) if "day" in rows.columns else rows


def merged_runs(intervals: DataFrame, *keys: str) -> DataFrame:
    """Intervals of one ``keys`` (a session, or a session and user) that touch or follow within a minute, as one.

    In minutes: first_m, last_m (inclusive). The merged run has the dimensions of its first interval, in
    order of minutes and then of the dimensions themselves.
    """
    rows = intervals.select(*keys, minute(F.col("start_s")).alias("_s"), minute(F.col("end_s")).alias("_e"), *_ORDER)
    order = Window.partitionBy(*keys).orderBy("_s", "_e", *_ORDER)
    reach = F.max("_e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("_s") > reach + 60, F.lit(True)).cast("int")
    numbered = rows.withColumn("_new", fresh).withColumn("_no", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.min(F.struct("_s", "_e", *_ORDER)).alias("_first")
    groups = numbered.groupBy(*keys, "_no").agg(first, F.max("_e").alias("last_m"))
    return groups.select(*keys, F.col("_first._s").alias("first_m"), "last_m", *[F.col(f"_first.{c}").alias(c) for c in _ORDER])


def minute_deltas(intervals: DataFrame, side: str | None = None) -> DataFrame:
    """(minute, dimensions, delta, starts, ends): +1 where a session opens in an hour, -1 where it closes within it.

    With ``side``, a column of 1 and -1, intervals of -1 are taken back: what is left is a difference.

    Each hour that a session spans opens anew, and a close in the hour's last minute is left out, so a
    running sum from the start of any hour is right without what came before.
    """
    sign = F.col(side).cast("long") if side else F.lit(1).cast("long")
    spans = merged_runs(intervals, "video_session_id", *([side] if side else []))
    pieces = spans.withColumn("_h", F.explode(F.sequence(hour(F.col("first_m")), hour(F.col("last_m")), F.lit(3600).cast("long"))))
    change = lambda at, d: F.struct(at.alias("minute"), F.lit(d).cast("long").alias("d"))
    close = F.col("last_m") + 60
    both = F.array(change(F.greatest("first_m", "_h"), 1), F.when(close < F.col("_h") + 3600, change(close, -1)))
    rows = pieces.select(*DIMS, sign.alias("_sign"), F.explode(F.filter(both, lambda x: x.isNotNull())).alias("c"))
    d, s = F.col("c.d"), F.col("_sign")
    return rows.groupBy(F.col("c.minute").alias("minute"), *DIMS).agg(F.sum(d * s).alias("delta"), F.sum(F.when(d > 0, s).otherwise(0)).alias("starts"), F.sum(F.when(d < 0, s).otherwise(0)).alias("ends"))


def change_curve(deltas: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(minute, ``by``, concurrent) where something changes: deltas are summed over the other dimensions, then along each hour."""
    points = deltas.groupBy("minute", *by).agg(F.sum("delta").alias("d"))
    along = Window.partitionBy(*by, hour(F.col("minute"))).orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    return points.select("minute", *by, F.sum("d").over(along).alias("concurrent"))


def held_curve(deltas: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``change_curve`` with next_minute: until when the level holds, at most to the end of the hour."""
    along = Window.partitionBy(*by, hour(F.col("minute"))).orderBy("minute")
    return change_curve(deltas, by).withColumn("next_minute", F.coalesce(F.lead("minute").over(along), hour(F.col("minute")) + 3600))


def minute_series(deltas: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, minute, concurrent) of every minute in which a level holds, and sixty zeros after each active hour."""
    held = held_curve(deltas, by)
    level = held.select(*by, F.explode(F.sequence("minute", F.col("next_minute") - 60, F.lit(60).cast("long"))).alias("minute"), "concurrent")
    hours = held.select(*by, hour(F.col("minute")).alias("_h")).distinct()
    zero = hours.select(*by, F.explode(F.sequence(F.col("_h") + 3600, F.col("_h") + 7140, F.lit(60).cast("long"))).alias("minute"), F.lit(0).cast("long").alias("concurrent"))
    return level.unionByName(zero).groupBy(*by, "minute").agg(F.max("concurrent").alias("concurrent"))


def dense_curve(deltas: DataFrame, start_s: int, end_s: int) -> DataFrame:
    """(minute, concurrent) of every minute in [start_s, end_s); the hours around it are filled from their start.

    Missing minutes are filled in the deltas, not in the levels, and summed along each hour.
    """
    if start_s % 60 or end_s % 60 or end_s <= start_s:
        raise ValueError("a range of whole minutes is needed")
    first = start_s // 3600 * 3600
    spine = deltas.sparkSession.range(first, end_s, 60).withColumnRenamed("id", "minute")
    points = within(deltas, "minute", first, end_s).groupBy("minute").agg(F.sum("delta").alias("d"))
    filled = spine.join(points, "minute", "left").withColumn("d", F.coalesce("d", F.lit(0)))
    along = Window.partitionBy(hour(F.col("minute"))).orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    return filled.select("minute", F.sum("d").over(along).alias("concurrent")).where(F.col("minute") >= start_s)


def level_at(deltas: DataFrame, at_s: int) -> DataFrame:
    """One row (minute, concurrent): the sum of the hour's deltas up to that minute."""
    at = at_s // 60 * 60
    return within(deltas, "minute", at // 3600 * 3600, at + 60).agg(F.lit(at).cast("long").alias("minute"), F.coalesce(F.sum("delta"), F.lit(0)).alias("concurrent"))


def once_a_minute(spans: DataFrame, start: str, end: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Spans in minutes (inclusive) cut so that those of equal ``keys`` share no minute: an earlier one keeps what they share.

    The spans are moved once, by their keys; minutes that are then made of them are distinct as they are.
    """
    earlier = Window.partitionBy(*keys).orderBy(start, end, *order).rowsBetween(Window.unboundedPreceding, -1)
    cut = spans.withColumn(start, F.greatest(F.col(start), F.coalesce(F.max(end).over(earlier) + 60, F.col(start))))
    return cut.where(F.col(start) <= F.col(end))


def each_minute(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.lit(60).cast("long")))


def expanded(intervals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(minute, ``by``, concurrent): distinct sessions by the interval's own dimensions, minute by minute. The slow truth."""
    spans = intervals.select("video_session_id", *by, minute(F.col("start_s")).alias("_s"), minute(F.col("end_s")).alias("_e"))
    rows = once_a_minute(spans, "_s", "_e", ["video_session_id", *by]).select(*by, each_minute(F.col("_s"), F.col("_e")).alias("minute"))
    return rows.groupBy("minute", *by).agg(F.count(F.lit(1)).alias("concurrent"))


def user_pieces(intervals: DataFrame) -> DataFrame:
    """(hour, first_m, last_m, KEYS, user_id): when a user watched with these keys, no minute twice, cut at hours."""
    spans = once_a_minute(merged_runs(intervals, "video_session_id", "user_id"), "first_m", "last_m", [*KEYS, "user_id"])
    pieces = spans.withColumn("hour", F.explode(F.sequence(hour(F.col("first_m")), hour(F.col("last_m")), F.lit(3600).cast("long"))))
    return pieces.select("hour", F.greatest("first_m", "hour").alias("first_m"), F.least("last_m", F.col("hour") + 3540).alias("last_m"), *KEYS, "user_id")


def user_minutes(intervals: DataFrame) -> DataFrame:
    """(minute, KEYS, user_id), distinct: the users tier. Counts of users are taken from these rows at any grain, never added up."""
    return user_pieces(intervals).select(each_minute(F.col("first_m"), F.col("last_m")).alias("minute"), *KEYS, "user_id")


def user_curve(users: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return users.groupBy("minute", *by).agg(F.countDistinct("user_id").alias("concurrent_users"))


def naive_curve(events: DataFrame) -> DataFrame:
    """(minute, concurrent) if a session counted from its first event to its last; a last event at the very start of a minute doesn't count for it."""
    spans = events.groupBy("video_session_id").agg(F.min("ts_s").alias("a"), F.max("ts_s").alias("b"))
    last = minute(F.col("b") - 1)
    each = spans.where(last >= minute(F.col("a"))).select(each_minute(minute(F.col("a")), last).alias("minute"))
    return each.groupBy("minute").agg(F.count(F.lit(1)).alias("concurrent"))


def stateless_curve(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(minute, ``by``, concurrent): sessions with a heartbeat or a play in the minute."""
    alive = events.where(F.col("event_type").isin("VideoHeartbeat", "VideoPlay"))
    return alive.groupBy(minute(F.col("ts_s")).alias("minute"), *by).agg(F.countDistinct("video_session_id").alias("concurrent"))
