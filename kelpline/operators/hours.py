"""The hour tier: peak, its minute and the integral of each hour, for eight subsets of the key dimensions; days and ranges from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.operators.minutes import held_curve, hour, within
from kelpline.sources.schema import KEYS

#: Bits of a cube level: which key dimensions are kept. Dropped ones show a sentinel, so always filter by level.
PLATFORM, COUNTRY, CONTENT = 1, 2, 4
SENTINELS = {"platform": "*", "country": "*", "content_id": -1}


def level_of(**filters) -> int:
    """The cube level that serves filters on these dimensions."""
    return sum(bit for bit, k in ((PLATFORM, "platform"), (COUNTRY, "country"), (CONTENT, "content_id")) if filters.get(k) is not None)


def best_minute(level: Column, at: Column) -> Column:
    """The minute of the highest level, the earliest of equal ones."""
    return F.max_by(at, F.struct(level, -at))


def cube(deltas: DataFrame) -> DataFrame:
    """Deltas by minute at all eight levels: fanned out before any sum along time, as levels don't add up after it."""
    once = deltas.groupBy("minute", *KEYS).agg(F.sum("delta").alias("delta"))
    fanned = once.withColumn("cube_level", F.explode(F.sequence(F.lit(0), F.lit(7))))
    kept = [F.when(F.col("cube_level").bitwiseAND(bit) != 0, F.col(k)).otherwise(F.lit(SENTINELS[k])).alias(k) for bit, k in ((PLATFORM, "platform"), (COUNTRY, "country"), (CONTENT, "content_id"))]
    return fanned.select("minute", "cube_level", *kept, "delta")


def hour_rollup(deltas: DataFrame) -> DataFrame:
    """(KEYS, cube_level, hour, peak, peak_minute, integral): the stored hour tier."""
    held = held_curve(cube(deltas), ["cube_level", *KEYS])
    seconds = F.col("concurrent") * (F.col("next_minute") - F.col("minute"))
    return held.groupBy(*KEYS, "cube_level", hour(F.col("minute")).alias("hour")).agg(F.max("concurrent").alias("peak"), best_minute(F.col("concurrent"), F.col("minute")).alias("peak_minute"), F.sum(seconds).alias("integral"))


def pinned(hours: DataFrame, **filters) -> DataFrame:
    """Rows of the level that serves the filters; hours that were taken back to nothing are left out, negative ones are not."""
    conditions = [F.col("cube_level") == level_of(**filters), (F.col("peak") != 0) | (F.col("integral") != 0)]
    conditions += [F.col(k) == v for k, v in filters.items() if v is not None]
    return hours.where(reduce(lambda a, b: a & b, conditions))


def hour_view(hours: DataFrame, level: int) -> DataFrame:
    """Hours of one level with avg_concurrent over the whole hour, zeros included."""
    rows = hours.where((F.col("cube_level") == level) & ((F.col("peak") != 0) | (F.col("integral") != 0)))
    return rows.select(*KEYS, "cube_level", "hour", "peak", "peak_minute", "integral", (F.col("integral") / 3600).alias("avg_concurrent"))


def day_view(hours: DataFrame, level: int) -> DataFrame:
    """Days of one level: highest peak, earliest minute of it, integral, average over 24 hours, active hours."""
    rows = hours.where((F.col("cube_level") == level) & ((F.col("peak") != 0) | (F.col("integral") != 0)))
    day = F.col("day") if "day" in hours.columns else F.floor(F.col("hour") / 86400) * 86400
    days = rows.groupBy(*KEYS, "cube_level", day.alias("day"))
    best = F.max_by("peak_minute", F.struct("peak", -F.col("peak_minute")))
    return days.agg(F.max("peak").alias("peak"), best.alias("peak_minute"), F.sum("integral").alias("integral"), (F.sum("integral") / 86400).alias("avg_concurrent"), F.count(F.lit(1)).alias("active_hours"))


def peak_and_average(levels: DataFrame, seconds: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(``by``, peak, peak_minute, integral, avg_concurrent) of held levels (minute, next_minute, concurrent)."""
    held = F.col("concurrent") * (F.col("next_minute") - F.col("minute"))
    rows = levels.groupBy(*by).agg(F.coalesce(F.max("concurrent"), F.lit(0)).alias("peak"), F.coalesce(best_minute(F.col("concurrent"), F.col("minute")), F.lit(0)).alias("peak_minute"), F.coalesce(F.sum(held), F.lit(0)).alias("integral"))
    return rows.withColumn("avg_concurrent", F.col("integral") / seconds)


def window_range(deltas: DataFrame, hours: DataFrame, start_s: int, end_s: int, *, platform: str | None = None, country: str | None = None, content_id: int | None = None, known_only: bool = False) -> DataFrame:
    """Peak and time-weighted average over [start_s, end_s), as one row.

    Whole hours come from the hour tier, the at most two ragged ones at the ends from the minute tier; both
    reads are pruned by their hours. Empty ranges have peak 0 at time 0. None filters nothing; any other value is
    taken literally, also one that shows elsewhere where a key is dropped. With ``known_only`` there is no row if the hour
    tier never has the values filtered by, so that a misspelt one does not read as nobody watching.
    """
    if end_s <= start_s:
        raise ValueError("the range must end after its start")
    filters = {"platform": platform, "country": country, "content_id": content_id}
    lo, hi = -(-start_s // 3600) * 3600, end_s // 3600 * 3600
    ragged = sorted({h for h in (start_s // 3600 * 3600, (end_s - 1) // 3600 * 3600) if h < lo or h >= hi})
    # rows of either tier: a level, since when, what it adds to the integral
    parts = []
    if lo < hi:
        parts.append(within(pinned(hours, **filters), "hour", lo, hi).select("peak", F.col("peak_minute").alias("at"), "integral", F.lit(1).alias("h"), F.lit(0).alias("p")))
    if ragged:
        edge = reduce(DataFrame.unionByName, [within(deltas, "minute", h, h + 3600) for h in ragged])
        for k, v in filters.items():
            edge = edge if v is None else edge.where(F.col(k) == v)
        a, b = F.greatest(F.col("minute"), F.lit(start_s)), F.least(F.col("next_minute"), F.lit(end_s))
        clipped = held_curve(edge).select("concurrent", a.alias("a"), b.alias("b")).where("b > a")
        parts.append(clipped.select(F.col("concurrent").alias("peak"), F.col("a").alias("at"), (F.col("concurrent") * (F.col("b") - F.col("a"))).alias("integral"), F.lit(0).alias("h"), F.lit(1).alias("p")))
    zero = F.lit(0).cast("long")
    found = reduce(DataFrame.unionByName, parts).agg(F.coalesce(F.max("peak"), zero).alias("peak"), F.coalesce(best_minute(F.col("peak"), F.col("at")), zero).alias("peak_minute"), F.coalesce(F.sum("integral"), zero).alias("integral"), F.coalesce(F.sum("h"), zero).alias("h"), F.coalesce(F.sum("p"), zero).alias("p"))
    out = found.select(
        F.lit(start_s).cast("long").alias("range_start"), F.lit(end_s).cast("long").alias("range_end"), F.lit(end_s - start_s).cast("long").alias("range_seconds"),
        F.lit("*" if platform is None else platform).alias("platform"), F.lit("*" if country is None else country).alias("country"), F.lit(-1 if content_id is None else content_id).cast("long").alias("content_id"),
        "peak", "peak_minute", "integral", (F.col("integral") / (end_s - start_s)).alias("avg_concurrent"), F.col("h").alias("hours_from_hour_tier"), F.col("p").alias("change_points_from_minute_tier"),
    )
    return out.join(F.broadcast(pinned(hours, **filters).limit(1).select(F.lit(1).alias("_seen"))), F.lit(True), "left_semi") if known_only else out


def tumbling(series: DataFrame, minutes: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Windows of ``minutes`` (a divisor of 60) over a minute series."""
    if minutes <= 0 or 60 % minutes:
        raise ValueError("a window must divide the hour, as the minute tier is clipped there")
    start = F.floor(F.col("minute") / (60 * minutes)) * (60 * minutes)
    rows = series.groupBy(*by, start.alias("window_start")).agg(F.max("concurrent").alias("peak"), best_minute(F.col("concurrent"), F.col("minute")).alias("peak_minute"), (F.sum("concurrent") * 60).alias("integral"), F.count(F.lit(1)).alias("obs_minutes"))
    return rows.select(*by, "window_start", (F.col("window_start") + 60 * minutes).alias("window_end"), F.lit(minutes).alias("window_minutes"), "peak", "peak_minute", "integral", (F.col("integral") / (60 * minutes)).alias("avg_concurrent"), "obs_minutes")


def rolling(series: DataFrame, by: tuple[str, ...] = (), spans: tuple[int, ...] = (5, 15, 60)) -> DataFrame:
    """Trailing windows of 5, 15 and 60 minutes over a minute series, by range of time.

    Without ``by`` the rows are few (one a minute), but one sort over all time would still be one task: the
    series is cut into days, each with the hour before it, and only the day's own rows are returned.
    """
    from pyspark.sql import Window

    reach = 60 * (max(spans) - 1)
    day = F.floor(F.col("minute") / 86400)
    next_day = F.when(F.floor((F.col("minute") + reach) / 86400) > day, day + 1)
    cut = series.withColumn("_day", F.explode(F.filter(F.array(day, next_day), lambda d: d.isNotNull())))
    columns = []
    for m in spans:
        w = Window.partitionBy("_day", *by).orderBy("minute").rangeBetween(-60 * (m - 1), 0)
        columns += [F.max("concurrent").over(w).alias(f"peak_{m}m"), best_minute(F.col("concurrent"), F.col("minute")).over(w).alias(f"peak_{m}m_minute"), (F.sum("concurrent").over(w) * 60).alias(f"integral_{m}m"), (F.sum("concurrent").over(w) * 60 / (60 * m)).alias(f"avg_{m}m"), F.count(F.lit(1)).over(w).alias(f"obs_{m}m")]
    return cut.select("*", *columns).where(F.col("_day") == day).drop("_day")
