"""What must hold between the tiers and the intervals they are made of, each as a verdict over the whole model."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.operators.hours import SENTINELS, day_view
from kelpline.operators.minutes import hour, minute
from kelpline.sources.schema import KEYS


#: In place of a cube level: all eight, with the keys as they are.
_ALL = -1


def _at_levels(rows: DataFrame, levels: Column) -> DataFrame:
    """Rows once for each of ``levels``, dropped keys as their sentinels."""
    out = rows.withColumn("cube_level", F.explode(levels))
    return out.withColumns({k: F.when(F.col("cube_level").bitwiseAND(bit) != 0, F.col(k)).otherwise(F.lit(SENTINELS[k])) for bit, k in ((1, "platform"), (2, "country"), (4, "content_id"))})


def _each_minute(intervals: DataFrame, *columns: str) -> DataFrame:
    return intervals.select(*columns, F.explode(F.sequence(minute(F.col("start_s")), minute(F.col("end_s")), F.lit(60).cast("long"))).alias("minute"))


def _shifted(value: Column, by: Column) -> Column:
    return F.call_function("shiftleft", value.cast("long"), by.cast("int"))


def _session_hours(intervals: DataFrame) -> DataFrame:
    """(who, KEYS, hour, bits): the minutes of each hour that an interval covers, as bits."""
    spans = intervals.select(F.col("video_session_id").alias("who"), *KEYS, minute(F.col("start_s")).alias("_s"), minute(F.col("end_s")).alias("_e")).where("_s <= _e")
    pieces = spans.withColumn("hour", F.explode(F.sequence(hour(F.col("_s")), hour(F.col("_e")), F.lit(3600).cast("long"))))
    first, last = (F.greatest("_s", "hour") - F.col("hour")) / 60, (F.least(F.col("_e"), F.col("hour") + 3540) - F.col("hour")) / 60
    return pieces.select("who", *KEYS, "hour", _shifted(_shifted(F.lit(1), last - first + 1) - 1, first).alias("bits"))


def _user_hours(users: DataFrame) -> DataFrame:
    """(who, KEYS, hour, bits) of the users tier, whose minutes lie together and so meet before they are moved."""
    at = users.select(F.col("user_id").alias("who"), *KEYS, hour(F.col("minute")).alias("hour"), "minute")
    return at.groupBy("who", *KEYS, "hour").agg(F.bit_or(_shifted(F.lit(1), (F.col("minute") - F.col("hour")) / 60)).alias("bits"))


def _changes(hours_of: DataFrame) -> DataFrame:
    """(cube_level, KEYS, minute, seen, counted): changes of how many ``who`` are there, each once in a cell; null is seen, but not counted.

    Who has one cell in an hour has one at any level, so that these changes are added up before they are fanned out (level
    ``_ALL``). The others are fanned out first, and their minutes united, in the task in which a person's hour lies.
    """
    mine = Window.partitionBy("who", "hour")
    each = hours_of.repartition("who", "hour").groupBy("who", "hour", *KEYS).agg(F.bit_or("bits").alias("bits")).withColumn("_cells", F.count(F.lit(1)).over(mine))
    fanned = _at_levels(each, F.when(F.col("_cells") == 1, F.array(F.lit(_ALL))).otherwise(F.sequence(F.lit(0), F.lit(7))))
    once = fanned.groupBy("who", "hour", "cube_level", *KEYS).agg(F.bit_or("bits").alias("bits"))
    turns = once.withColumn("_turns", F.col("bits").bitwiseXOR(_shifted(F.col("bits"), F.lit(1))))
    at = turns.withColumn("_at", F.explode(F.filter(F.sequence(F.lit(0), F.lit(59)), lambda i: F.getbit("_turns", i) == 1)))
    d = F.when(F.getbit("bits", F.col("_at")) == 1, 1).otherwise(-1).cast("long")
    moves = at.select("cube_level", *KEYS, (F.col("hour") + F.col("_at") * 60).alias("minute"), d.alias("seen"), F.when(F.col("who").isNotNull(), d).otherwise(0).alias("counted"))
    return moves.groupBy("cube_level", *KEYS, "minute").agg(F.sum("seen").alias("seen"), F.sum("counted").alias("counted"))


def _levels(changes: DataFrame, *counts: str) -> DataFrame:
    """(cube_level, KEYS, minute, ``counts``, minutes): what holds in a cell from a change on, and for how many minutes, at most to the hour's end."""
    fanned = _at_levels(changes.withColumnRenamed("cube_level", "_level"), F.when(F.col("_level") == _ALL, F.sequence(F.lit(0), F.lit(7))).otherwise(F.array("_level")))
    points = fanned.groupBy("cube_level", *KEYS, "minute").agg(*[F.sum(c).alias(c) for c in counts])
    along = Window.partitionBy("cube_level", *KEYS, hour(F.col("minute"))).orderBy("minute")
    until = F.coalesce(F.lead("minute").over(along), hour(F.col("minute")) + 3600)
    sums = [F.sum(c).over(along.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in counts]
    return points.select("cube_level", *KEYS, "minute", *sums, F.floor((until - F.col("minute")) / 60).alias("minutes"))


def _said(wrong, rest):
    return F.when(wrong, "FAIL").otherwise(rest)


def peak_not_sum(intervals: DataFrame, hours: DataFrame) -> DataFrame:
    """The served peak is that of the intervals and not the sum of the platforms' peaks (inconclusive if the sum is no larger)."""
    truth = _each_minute(intervals, "video_session_id").groupBy("minute").agg(F.countDistinct("video_session_id").alias("c")).agg(F.max("c").alias("truth_peak"))
    served = day_view(hours, 0).agg(F.max("peak").alias("serving_peak"))
    parts = _each_minute(intervals, "video_session_id", "platform").groupBy("platform", "minute").agg(F.countDistinct("video_session_id").alias("c")).groupBy("platform").agg(F.max("c").alias("p")).agg(F.sum("p").alias("sum_of_platform_peaks"))
    rows = truth.crossJoin(served).crossJoin(parts)  # one row each
    return rows.withColumn("verdict", _said(F.col("serving_peak") != F.col("truth_peak"), F.when(F.col("sum_of_platform_peaks") <= F.col("truth_peak"), "INCONCLUSIVE").otherwise("PASS")))


def users_never_summed(intervals: DataFrame, users: DataFrame) -> DataFrame:
    """The users tier counts each user once a minute, which sums over platforms don't; minutes that only one side has are mismatches."""
    each = _each_minute(intervals, "user_id", "platform")
    truth = each.groupBy("minute").agg(F.countDistinct("user_id").alias("t"))
    summed = each.groupBy("minute", "platform").agg(F.countDistinct("user_id").alias("u")).groupBy("minute").agg(F.sum("u").alias("x"))
    rows = truth.join(summed, "minute").join(users.groupBy("minute").agg(F.countDistinct("user_id").alias("s")), "minute", "full_outer")
    known = F.col("t").isNotNull()
    out = rows.agg(
        F.count_if(known).alias("minutes_compared"), F.count_if(known & (F.coalesce("s", F.lit(0)) != F.col("t"))).alias("serving_mismatch_minutes"), F.count_if(~known).alias("extra_serving_minutes"),
        F.count_if(F.coalesce(F.col("x") > F.col("t"), F.lit(False))).alias("minutes_where_sum_overcounts"), F.max(F.col("x") - F.col("t")).alias("max_overcount"),
    )
    return out.withColumn("verdict", _said((F.col("serving_mismatch_minutes") > 0) | (F.col("extra_serving_minutes") > 0), F.when(F.col("minutes_where_sum_overcounts") == 0, "INCONCLUSIVE").otherwise("PASS")))


def day_peaks(intervals: DataFrame, hours: DataFrame) -> DataFrame:
    """For each cube level, days of which peak or integral differ between the hour tier and the intervals.

    The hour tier attributes a merged run to its first interval; where a session's dimensions change between intervals
    that touch, filtered levels differ by that rule, and only level 0 must agree.
    """
    day = F.floor(F.col("minute") / 86400) * 86400
    held = _levels(_changes(_session_hours(intervals)), "seen", "counted").where("seen > 0")
    truth = held.groupBy("cube_level", *KEYS, day.alias("day")).agg(F.max("counted").alias("tp"), (F.sum(F.col("counted") * F.col("minutes")) * 60).alias("ti"))
    live = hours.where("peak <> 0 or integral <> 0").groupBy("cube_level", *KEYS, (F.floor(F.col("hour") / 86400) * 86400).alias("day")).agg(F.max("peak").alias("sp"), F.sum("integral").alias("si"))
    rows = truth.join(live, ["cube_level", *KEYS, "day"], "full_outer")
    differs = lambda a, b: F.coalesce(F.col(a), F.lit(-1)) != F.coalesce(F.col(b), F.lit(-1))
    out = rows.groupBy("cube_level").agg(F.count(F.lit(1)).alias("rows_compared"), F.count_if(differs("sp", "tp")).alias("peak_mismatch"), F.count_if(differs("si", "ti")).alias("integral_mismatch"))
    return out.withColumn("verdict", _said((F.col("peak_mismatch") > 0) | (F.col("integral_mismatch") > 0), F.lit("PASS")))


def users_le_sessions(intervals: DataFrame, users: DataFrame) -> DataFrame:
    """For each cube level, cells and minutes with more users than sessions: sessions that carry two users in turn."""
    zero = F.lit(0).cast("long")
    served = _changes(_user_hours(users)).select("cube_level", *KEYS, "minute", "seen", F.col("counted").alias("u"), zero.alias("c"))
    truth = _changes(_session_hours(intervals)).select("cube_level", *KEYS, "minute", zero.alias("seen"), zero.alias("u"), F.col("counted").alias("c"))
    held = _levels(served.unionByName(truth), "seen", "u", "c").where("seen > 0")
    unknown = reduce(or_, [F.col(k).isNull() for k in KEYS])  # equals nothing, so its users have no sessions
    excess = F.col("u") - F.when(unknown, 0).otherwise(F.col("c"))
    rows = held.withColumn("excess", excess).groupBy("cube_level")
    out = rows.agg(F.sum("minutes").alias("cells_compared"), F.sum(F.when(F.col("excess") > 0, F.col("minutes")).otherwise(0)).alias("violations"), F.max("excess").alias("max_excess"))
    return out.withColumn("verdict", _said(F.col("violations") > 0, F.lit("PASS")))


def orphan_hours(intervals: DataFrame, catalog: DataFrame) -> DataFrame:
    """Watched seconds (whole minutes of sessions) with and without a catalog row, and the contents that have none."""
    each = _each_minute(intervals, "video_session_id", "content_id").groupBy("content_id").agg((F.countDistinct("video_session_id", "minute") * 60).alias("i"))
    known = catalog.select("content_id", F.lit(True).alias("_known")).distinct()
    rows = each.join(known, "content_id", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    lost = F.when(~F.col("_known"), F.col("content_id"))
    out = rows.agg(F.coalesce(F.sum("i"), F.lit(0)).alias("total_integral"), F.coalesce(F.sum(F.when(F.col("_known"), F.col("i"))), F.lit(0)).alias("catalogued_integral"), F.array_join(F.array_sort(F.collect_set(lost)).cast("array<string>"), ",").alias("orphan_content_ids"))
    orphan = F.col("total_integral") - F.col("catalogued_integral")
    out = out.withColumn("orphan_integral", orphan).withColumn("orphan_pct", F.round(orphan * 100.0 / F.greatest("total_integral", F.lit(1)), 3))
    return out.withColumn("verdict", F.when(F.col("orphan_integral") == 0, "PASS").otherwise("PASS-WITH-DISCLOSURE"))
