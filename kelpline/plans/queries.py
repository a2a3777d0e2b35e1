"""The registered queries of the engine, each with its SQL. All times in results are epoch seconds (UTC)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.functions import normalise as n
from kelpline.operators import catalog as C
from kelpline.operators import health as H
from kelpline.operators import hours as R
from kelpline.operators import intervals as I
from kelpline.operators import invariants as V
from kelpline.operators import minutes as M
from kelpline.operators import reconcile as G
from kelpline.plans.model import SPARSE, Model, model_of
from kelpline.plans.oracle import base, by_minute, peak
from kelpline.policy import VARIANTS, Policy
from kelpline.sources import landing as L
from kelpline.sources import synthetic as S
from kelpline.sources.schema import DIMS, KEYS, VOCABULARY
from kelpline.streaming.publish import Publisher, stateless_minutes

BASE = base(SPARSE)
DAY = 1_704_844_800  # 2024-01-10
HOUR = DAY + 36_000
NEXT = DAY + 86_400
FIRST = 1_704_067_200  # 2024-01-01

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, run: Callable[[Model], DataFrame], sql: str | None) -> None:
    _QUERIES[name] = lambda spark, sf_dir: run(model_of(spark, sf_dir))
    if sql is not None:
        _SQL[name] = BASE + sql


_RANGE = ("peak", "peak_minute", "integral", "avg_concurrent")


def _range(name: str, start: int, end: int, **filters) -> None:
    where = " AND ".join([f"{k} = '{v}'" if isinstance(v, str) else f"{k} = {v}" for k, v in filters.items()] or ["true"])
    shown = [c for c in _RANGE if c != "peak_minute" or end - start > 60]  # of one minute the peak's place says nothing
    register(name, lambda m: R.window_range(m.deltas, m.hours, start, end, **filters).select(*shown), f"SELECT {', '.join(shown)} FROM ({peak(start, end, by_minute(where=where))})")


for _name, _start, _end, _filters in (
    ("b01_day_peak_avg_total", DAY, NEXT, {}), ("b02_day_peak_avg_platform", DAY, NEXT, {"platform": "p1"}), ("b03_day_peak_avg_country", DAY, NEXT, {"country": "c1"}),
    ("b04_day_peak_avg_content", DAY, NEXT, {"content_id": 7}), ("b10_range_13_days", FIRST + 86_400, FIRST + 14 * 86_400, {}), ("b11_range_ragged", DAY + 10 * 3600 + 17 * 60, DAY + 11 * 3600 + 31 * 60, {}),
    ("s01_day_total", NEXT, NEXT + 86_400, {}), ("pm01_minute_range", HOUR + 1800, HOUR + 1860, {}), ("pm03_minute_platform_range", HOUR + 1800, HOUR + 1860, {"platform": "p2"}),
    ("pm04_minute_platform_content_range", HOUR + 1800, HOUR + 1860, {"platform": "p2", "content_id": 3}), ("im01_ragged_total", HOUR + 1020, HOUR + 3 * 3600 + 420, {}), ("im02_aligned_total", HOUR, HOUR + 4 * 3600, {}),
    ("im03_ragged_platform", HOUR + 1020, HOUR + 3 * 3600 + 420, {"platform": "p0"}), ("im04_ragged_platform_content", HOUR + 1020, HOUR + 9 * 3600 + 420, {"platform": "p0", "content_id": 5}),
    ("im05_same_hour_ragged", HOUR + 600, HOUR + 1530, {}), ("id01_interval_13_days", FIRST + 86_400, FIRST + 14 * 86_400, {"country": "c0"}), ("v14_range_all_filters", DAY + 90, NEXT + 45, {"platform": "p3", "country": "c2", "content_id": 12}),
):
    _range(_name, _start, _end, **_filters)

# --- hour and day views
_HOURS = f"(SELECT *, minute // 3600 * 3600 AS hour FROM {by_minute()})"
_PLATFORM_HOURS = f"(SELECT *, minute // 3600 * 3600 AS hour FROM {by_minute('platform')})"


def _hour_sql(source: str, where: str, by: str = "", extra: str = "") -> str:
    keys = f"{by}, " if by else ""
    return f"SELECT {keys}hour, CAST(max(c) AS BIGINT) AS peak, CAST(arg_min(minute, (-c, minute)) AS BIGINT) AS peak_minute, CAST(sum(c) * 60 AS BIGINT) AS integral, CAST(sum(c) * 60 AS DOUBLE) / 3600 AS avg_concurrent FROM {source} WHERE {where} GROUP BY ALL {extra}"


def _hour_rows(m: Model, level: int, where: str, *by: str) -> DataFrame:
    days = m.hours.where(F.col("day") == DAY) if str(NEXT) not in where.split("AND")[0] else m.hours.where(F.col("day") >= NEXT)
    return R.hour_view(days, level).where(where).select(*by, "hour", "peak", "peak_minute", "integral", "avg_concurrent")


_IN_DAY = f"hour >= {DAY} AND hour < {NEXT}"
register("b05_hour_series", lambda m: _hour_rows(m, 0, _IN_DAY), _hour_sql(_HOURS, _IN_DAY))
register("s11_hour_total", lambda m: _hour_rows(m, 0, f"hour >= {NEXT}"), _hour_sql(_HOURS, f"hour >= {NEXT}"))
register("s12_hour_platform", lambda m: _hour_rows(m, R.PLATFORM, f"{_IN_DAY} AND platform = 'p1'"), _hour_sql(_PLATFORM_HOURS, f"{_IN_DAY} AND platform = 'p1'"))
register("ih01_hour_series_day", lambda m: _hour_rows(m, R.COUNTRY, _IN_DAY, "country"), _hour_sql(f"(SELECT *, minute // 3600 * 3600 AS hour FROM {by_minute('country')})", _IN_DAY, "country"))
register("ph01_hour_total", lambda m: _hour_rows(m, 0, f"hour = {HOUR}"), _hour_sql(_HOURS, f"hour = {HOUR}"))
register("ph02_hour_platform", lambda m: _hour_rows(m, R.PLATFORM, f"hour = {HOUR}", "platform"), _hour_sql(_PLATFORM_HOURS, f"hour = {HOUR}", "platform"))
register("ph03_hour_platform_content", lambda m: _hour_rows(m, R.PLATFORM + R.CONTENT, f"hour = {HOUR}", "platform", "content_id"), _hour_sql(f"(SELECT *, minute // 3600 * 3600 AS hour FROM {by_minute('platform, content_id')})", f"hour = {HOUR}", "platform, content_id"))
_SUMMARY = "SELECT CAST(max(peak) AS BIGINT) AS peak, CAST(arg_min(peak_minute, (-peak, peak_minute)) AS BIGINT) AS peak_minute, CAST(sum(integral) AS BIGINT) AS integral, CAST(sum(integral) AS DOUBLE) / 86400 AS avg_concurrent, count(*) AS active_hours"
register("s11b_hour_summary", lambda m: R.day_view(m.hours, 0).where(F.col("day") == DAY).select("peak", "peak_minute", "integral", "avg_concurrent", "active_hours"), f"{_SUMMARY} FROM ({_hour_sql(_HOURS, _IN_DAY)})")


def _day_sql(by: str, where: str = "true", extra: str = "") -> str:
    keys, level = (f"{by}, " if by else ""), by_minute(by)
    return f"SELECT {keys}minute // 86400 * 86400 AS day, CAST(max(c) AS BIGINT) AS peak, CAST(arg_min(minute, (-c, minute)) AS BIGINT) AS peak_minute, CAST(sum(c) * 60 AS BIGINT) AS integral, CAST(sum(c) * 60 AS DOUBLE) / 86400 AS avg_concurrent, count(DISTINCT minute // 3600) AS active_hours FROM {level} WHERE {where} GROUP BY ALL {extra}"


_DAYCOLS = ("day", "peak", "peak_minute", "integral", "avg_concurrent", "active_hours")
for _name, _level, _by, _where in (
    ("b12_all_days", 0, (), None), ("v08_day_country", R.COUNTRY, ("country",), None), ("s02_day_platform", R.PLATFORM, ("platform",), DAY), ("s03_day_country", R.COUNTRY, ("country",), DAY),
    ("pd01_day_total", 0, (), DAY), ("pd02_day_platform", R.PLATFORM, ("platform",), NEXT), ("pd03_day_platform_content", R.PLATFORM + R.CONTENT, ("platform", "content_id"), DAY),
):
    register(
        _name,
        lambda m, lv=_level, by=_by, w=_where: R.day_view(m.hours, lv).where(F.lit(True) if w is None else F.col("day") == w).select(*by, *_DAYCOLS),
        _day_sql(", ".join(_by), "true" if _where is None else f"minute >= {_where} AND minute < {_where + 86_400}"),
    )
register("x06_days_by_peak", lambda m: R.day_view(m.hours, 0).select(*_DAYCOLS).orderBy(F.col("peak").desc(), "day").limit(10), f"SELECT * FROM ({_day_sql('')}) ORDER BY peak DESC, day LIMIT 10")
_CUBE = " UNION ALL ".join(
    f"SELECT {lv} AS cube_level, " + ", ".join(k if lv & bit else (f"'{R.SENTINELS[k]}' AS {k}" if k != "content_id" else "CAST(-1 AS BIGINT) AS content_id") for bit, k in ((1, "platform"), (2, "country"), (4, "content_id"))) + ", minute FROM mins"
    for lv in range(8)
)
register("ag17_hour_cube", lambda m: m.hours.where("peak <> 0 OR integral <> 0").drop("day"), f"SELECT platform, country, content_id, cube_level, hour, CAST(max(c) AS BIGINT) AS peak, CAST(arg_min(minute, (-c, minute)) AS BIGINT) AS peak_minute, CAST(sum(c) * 60 AS BIGINT) AS integral FROM (SELECT *, minute // 3600 * 3600 AS hour FROM (SELECT cube_level, platform, country, content_id, minute, count(*) AS c FROM ({_CUBE}) GROUP BY ALL)) GROUP BY ALL")


# --- top contents
def _top(m: Model, rows: DataFrame, when: str) -> DataFrame:
    return C.with_content(rows, m.catalog).select("content_id", "title", "peak", "peak_minute", "integral").orderBy(F.col("peak").desc(), "content_id").limit(10)


_TOP = "SELECT q.content_id, CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.title END AS title, q.peak, q.peak_minute, q.integral FROM ({}) q LEFT JOIN cat c ON c.content_id = q.content_id ORDER BY q.peak DESC, q.content_id LIMIT 10"
_CONTENT_HOUR = _hour_sql(f"(SELECT *, minute // 3600 * 3600 AS hour FROM {by_minute('content_id')})", f"hour = {HOUR}", "content_id")
for _name in ("b13_hour_top_content", "s13_hour_top_content"):
    register(_name, lambda m: _top(m, R.hour_view(M.within(m.hours, "hour", HOUR, HOUR + 3600), R.CONTENT), "hour"), _TOP.format(_CONTENT_HOUR))
register("s04_day_top_content", lambda m: _top(m, R.day_view(m.hours, R.CONTENT).where(F.col("day") == DAY), "day"), _TOP.format(_day_sql("content_id", f"minute >= {DAY} AND minute < {NEXT}")))

def _series(by: str = "") -> str:
    """Minutes in which a level holds, zeros from the first change of an hour to its end and through the next hour."""
    keys = f"{by}, " if by else ""
    return f"""(SELECT {keys}minute, max(c) AS c FROM (
  SELECT {keys}minute, c FROM {by_minute(by)}
  UNION ALL SELECT {keys}h + 3600 + 60 * i, 0 FROM (SELECT DISTINCT {keys}minute // 3600 * 3600 AS h FROM delta), (SELECT unnest(range(0, 60)) AS i)
  UNION ALL SELECT {keys}m, 0 FROM (SELECT {keys}unnest(range(f, h + 3600, 60)) AS m FROM (SELECT {keys}minute // 3600 * 3600 AS h, min(minute) AS f FROM delta GROUP BY ALL))) GROUP BY ALL)"""


_SERIES = _series()
# --- minute curves
_IN_HOUR, _ON_DAY = f"minute >= {HOUR} AND minute < {HOUR + 3600}", f"minute >= {DAY} AND minute < {NEXT}"


def _day(rows: DataFrame) -> DataFrame:
    return M.within(rows, "minute", DAY, NEXT)


def _dense(start: int, end: int, where: str = "true") -> str:
    return f"SELECT s.minute, CAST(coalesce(l.c, 0) AS BIGINT) AS concurrent FROM (SELECT unnest(range({start}, {end}, 60)) AS minute) s LEFT JOIN {by_minute(where=where)} l ON l.minute = s.minute"


for _name, _start, _end, _platform in (
    ("b06_minute_curve_hour", HOUR, HOUR + 3600, None), ("b07_minute_curve_platform", HOUR, HOUR + 3600, "p1"), ("s15_minute_series_hour", HOUR + 3600, HOUR + 7200, None),
    ("im06_minute_curve_range", HOUR + 1020, HOUR + 5 * 3600, None), ("sl04_dense_day", DAY, NEXT, None),
):
    register(_name, lambda m, a=_start, b=_end, p=_platform: M.dense_curve(m.deltas if p is None else m.deltas.where(F.col("platform") == p), a, b), _dense(_start, _end, "true" if _platform is None else f"platform = '{_platform}'"))


def _dense_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("minutes"), F.max("concurrent").alias("peak"), R.best_minute(F.col("concurrent"), F.col("minute")).alias("peak_minute"), F.avg("concurrent").alias("avg_concurrent"), F.count_if(F.col("concurrent") == 0).alias("idle_minutes"))


_DENSE_SUMMARY = "SELECT count(*) AS minutes, max(concurrent) AS peak, CAST(arg_min(minute, (-concurrent, minute)) AS BIGINT) AS peak_minute, avg(concurrent) AS avg_concurrent, count(*) FILTER (WHERE concurrent = 0) AS idle_minutes FROM ({})"
register("s14_minute_day_summary", lambda m: _dense_summary(M.dense_curve(m.deltas, DAY, NEXT)), _DENSE_SUMMARY.format(_dense(DAY, NEXT)))
register("s16_minute_platform_day_summary", lambda m: _dense_summary(M.dense_curve(m.deltas.where("platform = 'p1'"), DAY, NEXT)), _DENSE_SUMMARY.format(_dense(DAY, NEXT, "platform = 'p1'")))
register("pm02_minute_point", lambda m: M.level_at(m.deltas, HOUR + 1800), f"SELECT CAST({HOUR + 1800} AS BIGINT) AS minute, count(*) AS concurrent FROM mins WHERE minute = {HOUR + 1800}")
register("pm05_minute_point_series", lambda m: M.minute_series(m.deltas).where(F.col("minute") == HOUR + 1800), f"SELECT minute, c AS concurrent FROM {_SERIES} WHERE minute = {HOUR + 1800}")


def _points(by: str = "") -> str:
    """Change points: minutes in which some session opens or closes within an hour."""
    keys, on = (f"{by}, ", " AND ".join(f"l.{k.strip()} = p.{k.strip()}" for k in by.split(",")) + " AND ") if by else ("", "")
    shown = ", ".join(f"p.{k.strip()}" for k in by.split(",")) + ", " if by else ""
    return f"SELECT {shown}p.minute, CAST(coalesce(l.c, 0) AS BIGINT) AS concurrent FROM (SELECT DISTINCT {keys}minute FROM delta) p LEFT JOIN {by_minute(by)} l ON {on}l.minute = p.minute"


register("v01_minute_dims", lambda m: M.change_curve(m.deltas, KEYS), _points("platform, country, content_id"))
register("v01_minute_total", lambda m: M.change_curve(m.deltas), _points())
for _dim in ("platform", "country", "app_version", "audio_language", "subtitle_language", "player_version"):
    register(f"v02_by_{_dim}", lambda m, d=_dim: M.change_curve(m.deltas, [d]), _points(_dim))
register("v03_by_video_resolution", lambda m: C.session_minutes(m.intervals, m.catalog).groupBy("minute", "video_resolution").agg(F.countDistinct("video_session_id").alias("concurrent")), "SELECT minute, video_resolution, count(DISTINCT video_session_id) AS concurrent FROM drill GROUP BY ALL")
_CDELTA = "(SELECT d.minute, CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.title END AS title, CASE WHEN c.content_id IS NULL THEN '(unknown)' WHEN c.video_type = '' THEN '(blank)' ELSE c.video_type END AS video_type, CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.category END AS category, CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.show_name END AS show_name FROM delta d LEFT JOIN cat c ON c.content_id = d.content_id)"


def _content_points(attribute: str) -> str:
    return f"SELECT p.minute, p.{attribute}, CAST(coalesce(l.c, 0) AS BIGINT) AS concurrent FROM (SELECT DISTINCT minute, {attribute} FROM {_CDELTA}) p LEFT JOIN {by_minute(attribute, 'cmins')} l ON l.minute = p.minute AND l.{attribute} = p.{attribute}"


for _a in ("video_type", "category", "show_name"):
    register(f"v04_by_{_a}", lambda m, a=_a: C.attribute_curve(m.deltas, m.catalog, a), _content_points(_a))
    register(f"v06_now_{_a}", lambda m, a=_a: C.current(C.attribute_curve(m.deltas, m.catalog, a), [a]), f"SELECT {_a}, arg_max(concurrent, minute) AS concurrent, max(minute) AS as_of FROM ({_content_points(_a)}) GROUP BY ALL")
register("v04_by_title", lambda m: C.title_curve(m.deltas, m.catalog), f"SELECT q.minute, q.title, coalesce(t.n, 0) AS catalog_content_ids, q.concurrent FROM ({_content_points('title')}) q LEFT JOIN (SELECT title, count(*) AS n FROM cat GROUP BY title) t ON t.title = q.title")
register("v06_now_title", lambda m: C.current(C.attribute_curve(m.deltas, m.catalog, "title"), ["title"]), f"SELECT title, arg_max(concurrent, minute) AS concurrent, max(minute) AS as_of FROM ({_content_points('title')}) GROUP BY ALL")
register("v05_minute_content", lambda m: C.with_content(M.change_curve(m.deltas, KEYS), m.catalog), f"SELECT q.*, CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.title END AS title, CASE WHEN c.content_id IS NULL THEN '(unknown)' WHEN c.video_type = '' THEN '(blank)' ELSE c.video_type END AS video_type, CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.category END AS category, CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.show_name END AS show_name FROM ({_points('platform, country, content_id')}) q LEFT JOIN cat c ON c.content_id = q.content_id")
register("v07_title_collisions", lambda m: C.title_collisions(m.catalog).withColumn("ids", F.array_join("ids", ",")), "SELECT title, count(*) AS content_ids, count(DISTINCT category) AS categories, count(DISTINCT video_type) AS video_types, string_agg(CAST(content_id AS VARCHAR), ',' ORDER BY content_id) AS ids FROM cat GROUP BY title HAVING count(*) > 1")
register("v07_orphans", lambda m: C.orphans(m.events, m.catalog), "SELECT count(DISTINCT content_id) AS orphan_content_ids, count(*) AS orphan_events FROM ev WHERE content_id NOT IN (SELECT content_id FROM cat)")

# --- peak and average by attribute and set
for _name, _a in (("s05_day_video_type", "video_type"), ("s06_day_category", "category"), ("s07_day_show_name", "show_name")):
    register(_name, lambda m, a=_a: R.peak_and_average(C.attribute_levels(_day(m.deltas), m.catalog, a), 86_400, (a,)), peak(DAY, NEXT, by_minute(_a, "cmins"), _a))
register("b08_day_video_type_live", lambda m: R.peak_and_average(M.held_curve(_day(m.deltas).join(m.catalog.where("video_type = 'live'").select("content_id"), "content_id", "left_semi")), 86_400), peak(DAY, NEXT, by_minute("", "cmins", "video_type = 'live'")))
register("s10_day_platform_video_type", lambda m: R.peak_and_average(M.held_curve(_day(m.deltas).where("platform = 'p1'").join(m.catalog.where("video_type = 'vod'").select("content_id"), "content_id", "left_semi")), 86_400), peak(DAY, NEXT, by_minute("", "cmins", "platform = 'p1' AND video_type = 'vod'")))
register("b09_day_platform_in", lambda m: R.peak_and_average(M.held_curve(_day(m.deltas).where(F.col("platform").isin("p1", "p3"))), 86_400), peak(DAY, NEXT, by_minute(where="platform IN ('p1', 'p3')")))
register(
    "s08_day_video_resolution",
    lambda m: R.peak_and_average(C.session_minutes(m.intervals, m.catalog).where(_ON_DAY).groupBy("minute", "video_resolution").agg(F.countDistinct("video_session_id").alias("concurrent")).withColumn("next_minute", F.col("minute") + 60), 86_400, ("video_resolution",)),
    peak(DAY, NEXT, by_minute("video_resolution", "drill"), "video_resolution"),
)


_P1_P3 = "platform IN ('p1', 'p3')"


def _in_against_parts(m: Model) -> DataFrame:
    right = R.peak_and_average(M.held_curve(_day(m.deltas).where(F.col("platform").isin("p1", "p3"))), 86_400).select(F.col("peak").alias("true_peak"))
    parts = R.day_view(m.hours, R.PLATFORM).where(F.col("day") == DAY).where(F.col("platform").isin("p1", "p3")).agg(F.max("peak").alias("max_of_peaks"), F.sum("peak").alias("sum_of_peaks"))
    return right.crossJoin(parts)  # one row each


register("s09_platform_in_not_parts", _in_against_parts, f"SELECT r.peak AS true_peak, x.* FROM ({peak(DAY, NEXT, by_minute(where=_P1_P3))}) r, (SELECT max(peak) AS max_of_peaks, CAST(sum(peak) AS BIGINT) AS sum_of_peaks FROM ({peak(DAY, NEXT, by_minute('platform'), 'platform')}) WHERE platform IN ('p1', 'p3')) x")
register("x03_peak_not_summable", lambda m: R.day_view(m.hours, R.PLATFORM).where(F.col("day") == DAY).agg(F.sum("peak").alias("sum_of_peaks"), F.max("peak").alias("max_of_peaks")).crossJoin(R.day_view(m.hours, 0).where(F.col("day") == DAY).select(F.col("peak").alias("true_peak"))), f"SELECT CAST(sum(x.peak) AS BIGINT) AS sum_of_peaks, max(x.peak) AS max_of_peaks, (SELECT peak FROM ({peak(DAY, NEXT, by_minute())})) AS true_peak FROM ({peak(DAY, NEXT, by_minute('platform'), 'platform')}) x")
register("amb01_hour_readings", lambda m: R.hour_view(m.hours, 0).where(F.col("hour") == HOUR).select("peak", "avg_concurrent").crossJoin(M.level_at(m.deltas, HOUR).select(F.col("concurrent").alias("level_at_start"))), f"SELECT peak, avg_concurrent, (SELECT count(*) FROM mins WHERE minute = {HOUR}) AS level_at_start FROM ({peak(HOUR, HOUR + 3600, by_minute())})")
register("amb02_day_readings", lambda m: R.day_view(m.hours, 0).where(F.col("day") == DAY).select("peak", "avg_concurrent", (F.col("integral") / (F.col("active_hours") * 3600)).alias("avg_active_hours")), f"SELECT peak, avg_concurrent, CAST(integral AS DOUBLE) / (3600 * active_hours) AS avg_active_hours FROM ({_day_sql('', _ON_DAY)})")

# --- windows over the series
register("v10_series_total", lambda m: M.minute_series(m.deltas), f"SELECT minute, c AS concurrent FROM {_SERIES}")
register("v10_series_dim", lambda m: M.minute_series(m.deltas, KEYS), f"SELECT platform, country, content_id, minute, c AS concurrent FROM {_series('platform, country, content_id')}")
for _w in (5, 15, 60):
    register(f"v12_tumbling_{_w}", lambda m, w=_w: R.tumbling(M.minute_series(m.deltas), w), f"SELECT minute // {60 * _w} * {60 * _w} AS window_start, minute // {60 * _w} * {60 * _w} + {60 * _w} AS window_end, {_w} AS window_minutes, max(c) AS peak, CAST(arg_min(minute, (-c, minute)) AS BIGINT) AS peak_minute, CAST(sum(c) * 60 AS BIGINT) AS integral, CAST(sum(c) * 60 AS DOUBLE) / {60 * _w} AS avg_concurrent, count(*) AS obs_minutes FROM {_SERIES} GROUP BY ALL")
register("v12_tumbling_dim_15", lambda m: R.tumbling(M.minute_series(m.deltas, ("platform",)), 15, ("platform",)), f"SELECT platform, minute // 900 * 900 AS window_start, minute // 900 * 900 + 900 AS window_end, 15 AS window_minutes, max(c) AS peak, CAST(arg_min(minute, (-c, minute)) AS BIGINT) AS peak_minute, CAST(sum(c) * 60 AS BIGINT) AS integral, CAST(sum(c) * 60 AS DOUBLE) / 900 AS avg_concurrent, count(*) AS obs_minutes FROM {_series('platform')} GROUP BY ALL")
register("v13_tumbling_hour", lambda m: R.hour_view(m.hours, 7).select(*KEYS, F.col("hour").alias("window_start"), (F.col("hour") + 3600).alias("window_end"), "peak", "peak_minute", "integral", "avg_concurrent"), f"SELECT platform, country, content_id, hour AS window_start, hour + 3600 AS window_end, peak, peak_minute, integral, avg_concurrent FROM ({_hour_sql('(SELECT *, minute // 3600 * 3600 AS hour FROM ' + by_minute('platform, country, content_id') + ')', 'true', 'platform, country, content_id')})")


def _rolling_sql(source: str, by: str = "") -> str:
    part, keys = (f"PARTITION BY {by} ", f"{by}, ") if by else ("", "")
    columns = ", ".join(f"max(c) OVER w{m} AS peak_{m}m, CAST(arg_min(minute, (-c, minute)) OVER w{m} AS BIGINT) AS peak_{m}m_minute, CAST(sum(c) OVER w{m} * 60 AS BIGINT) AS integral_{m}m, CAST(sum(c) OVER w{m} * 60 AS DOUBLE) / {60 * m} AS avg_{m}m, count(*) OVER w{m} AS obs_{m}m" for m in (5, 15, 60))
    windows = ", ".join(f"w{m} AS ({part}ORDER BY minute RANGE BETWEEN {60 * (m - 1)} PRECEDING AND CURRENT ROW)" for m in (5, 15, 60))
    return f"SELECT {keys}minute, c AS concurrent, {columns} FROM {source} WINDOW {windows}"


register("v11_rolling_total", lambda m: R.rolling(M.minute_series(m.deltas)), _rolling_sql(_SERIES))
register("v11_rolling_platform", lambda m: R.rolling(M.minute_series(m.deltas, ("platform",)), ("platform",)), _rolling_sql(_series("platform"), "platform"))

# --- users
_UC = "count(DISTINCT user_id)"
register("v09_users_minute", lambda m: M.user_curve(m.users, KEYS), f"SELECT minute, platform, country, content_id, {_UC} AS concurrent_users FROM um GROUP BY ALL")
register("v09_users_total", lambda m: M.user_curve(m.users), f"SELECT minute, {_UC} AS concurrent_users FROM um GROUP BY ALL")


def _user_levels(m: Model, *by: str) -> DataFrame:
    return M.user_curve(_day(m.users), by).withColumnRenamed("concurrent_users", "concurrent").withColumn("next_minute", F.col("minute") + 60)


register("u01_users_day", lambda m: R.peak_and_average(_user_levels(m), 86_400), peak(DAY, NEXT, by_minute("", "um", "true", _UC)))
register("u02_users_hours", lambda m: R.peak_and_average(_user_levels(m).withColumn("hour", M.hour(F.col("minute"))), 3600, ("hour",)), f"SELECT minute // 3600 * 3600 AS hour, max(c) AS peak, CAST(arg_min(minute, (-c, minute)) AS BIGINT) AS peak_minute, CAST(sum(c) * 60 AS BIGINT) AS integral, CAST(sum(c) * 60 AS DOUBLE) / 3600 AS avg_concurrent FROM {by_minute('', 'um', _ON_DAY, _UC)} GROUP BY ALL")
register("u03_users_curve", lambda m: M.user_curve(M.within(m.users, "minute", HOUR, HOUR + 3600)), f"SELECT minute, {_UC} AS concurrent_users FROM um WHERE {_IN_HOUR} GROUP BY ALL")
register("u04_users_platform", lambda m: R.peak_and_average(_user_levels(m, "platform"), 86_400, ("platform",)), peak(DAY, NEXT, by_minute("platform", "um", "true", _UC), "platform"))
register("h06_users_and_sessions", lambda m: H.users_and_sessions(M.user_curve(m.users), M.expanded(m.intervals)), f"SELECT u.minute, s.c AS sessions, u.c AS users, s.c - u.c AS gap, CAST(s.c AS DOUBLE) / u.c AS ratio FROM {by_minute('', 'um', 'true', _UC)} u JOIN {by_minute()} s ON s.minute = u.minute")

# --- the model itself
_IV = ("start_s", "end_s", "user_id", "content_id", "platform", "country", "app_version", "audio_language", "subtitle_language", "player_version", "is_open")
register("m06_intervals", lambda m: m.intervals.select("video_session_id", *_IV, F.element_at("extra_dimensions", "video_resolution").alias("video_resolution")), f"SELECT sid AS video_session_id, {', '.join(_IV)}, video_resolution FROM iv")
register("m02_runs", lambda m: I.with_runs(m.events, m.policy).groupBy("video_session_id").agg(F.countDistinct("_run").alias("runs"), F.max(F.col("_end") - F.col("_start")).alias("longest_s")), "SELECT sid AS video_session_id, count(*) AS runs, max(re - rs) AS longest_s FROM runs GROUP BY sid")
register("m03_pause_windows", lambda m: I.pause_windows(I.with_runs(m.events, m.policy), m.policy).select("video_session_id", "p", "e"), "SELECT sid AS video_session_id, p, e FROM wins")
register("m07_merged_runs", lambda m: M.merged_runs(m.intervals, "video_session_id").select("video_session_id", "first_m", "last_m", *DIMS), f"SELECT sid AS video_session_id, sm AS first_m, em AS last_m, {', '.join(DIMS)} FROM mr")
register("m08_minute_deltas", lambda m: m.deltas.drop("day"), "SELECT * FROM delta")
register("m09_user_minutes", lambda m: m.users.drop("day"), "SELECT minute, platform, country, content_id, user_id FROM um")
register("m10_expansion_total", lambda m: M.expanded(m.intervals), f"SELECT minute, c AS concurrent FROM {by_minute()}")
register("m10_expansion_dims", lambda m: M.expanded(m.intervals, KEYS), "SELECT minute, platform, country, content_id, count(DISTINCT sid) AS concurrent FROM (SELECT sid, platform, country, content_id, unnest(range(sm, em + 60, 60)) AS minute FROM im) GROUP BY ALL")
_NAIVE = "(SELECT minute, count(DISTINCT sid) AS c FROM (SELECT sid, unnest(range(min(ts_s) // 60 * 60, (max(ts_s) - 1) // 60 * 60 + 1, 60)) AS minute FROM ev GROUP BY sid) GROUP BY minute)"
_STATELESS = "(SELECT ts_s // 60 * 60 AS minute, count(DISTINCT sid) AS c FROM ev WHERE event_type IN ('VideoHeartbeat', 'VideoPlay') GROUP BY ALL)"
register("m11_naive", lambda m: M.naive_curve(m.events), f"SELECT minute, c AS concurrent FROM {_NAIVE}")
register("m12_stateless", lambda m: M.stateless_curve(m.events), f"SELECT minute, c AS concurrent FROM {_STATELESS}")
register("m12_stateless_dims", lambda m: M.stateless_curve(m.events, KEYS), "SELECT ts_s // 60 * 60 AS minute, platform, country, content_id, count(DISTINCT sid) AS concurrent FROM ev WHERE event_type IN ('VideoHeartbeat', 'VideoPlay') GROUP BY ALL")
_DRILL = ("minute", "video_session_id", "user_id", "platform", "country", "content_id", "title", "video_type", "category", "show_name", "app_version", "audio_language", "subtitle_language", "player_version", "video_resolution")
register("m13_session_minutes", lambda m: C.session_minutes(m.intervals, m.catalog).select(*_DRILL), f"SELECT {', '.join(_DRILL)} FROM drill")
register("m15_as_of", lambda m: I.as_of(m.events, DAY, m.policy).select("video_session_id", "start_s", "end_s"), None)
_SQL["m15_as_of"] = BASE.replace("FROM events\n", f"FROM events WHERE epoch(ts) < {DAY}\n") + "SELECT sid AS video_session_id, start_s, end_s FROM iv"
register("v16_dimension_values", lambda m: C.dimension_values(C.session_minutes(m.intervals, m.catalog)), "SELECT minute, video_session_id, user_id, 'video_resolution' AS dimension_name, extra_resolution AS dimension_value FROM drill WHERE extra_resolution IS NOT NULL")
_ATTRS = " UNION ALL ".join(f"SELECT minute, video_session_id, user_id, content_id, '{a}' AS dimension_name, {a} AS dimension_value FROM drill" for a in C.ATTRIBUTES)
register("v16_content_values", lambda m: C.content_dimension_values(C.session_minutes(m.intervals, m.catalog)), _ATTRS)
register("v16_profile", lambda m: C.dimension_profile(C.session_minutes(m.intervals, m.catalog)), f"SELECT 'event' AS dimension_source, 'video_resolution' AS dimension_name, count(*) AS source_rows, count(*) FILTER (WHERE extra_resolution <> '') AS non_empty_rows, count(DISTINCT extra_resolution) AS distinct_values, count(DISTINCT video_session_id) AS distinct_entities FROM drill WHERE extra_resolution IS NOT NULL UNION ALL SELECT 'content', dimension_name, count(*), count(*) FILTER (WHERE dimension_value <> ''), count(DISTINCT dimension_value), count(DISTINCT content_id) FROM ({_ATTRS}) GROUP BY dimension_name")

# --- checks and reports
_GATE = f"""SELECT s.minute, CAST(coalesce(l.c, 0) AS BIGINT) AS truth, CAST(sum(coalesce(d.d, 0)) OVER (PARTITION BY s.minute // 3600 ORDER BY s.minute) AS BIGINT) AS served, CAST(sum(coalesce(d.d, 0)) OVER (PARTITION BY s.minute // 3600 ORDER BY s.minute) - coalesce(l.c, 0) AS BIGINT) AS diff
  FROM (SELECT unnest(range((SELECT min(minute) // 3600 * 3600 FROM delta), (SELECT greatest(max(d.minute), (SELECT max(em) FROM im)) FROM delta d) + 60, 60)) AS minute) s
  LEFT JOIN (SELECT minute, count(DISTINCT sid) AS c FROM (SELECT sid, unnest(range(sm, em + 60, 60)) AS minute FROM im) GROUP BY minute) l ON l.minute = s.minute
  LEFT JOIN (SELECT minute, sum(delta) AS d FROM delta GROUP BY minute) d ON d.minute = s.minute"""
register("x01_gate_minutes", lambda m: G.compare(m.events, m.deltas, m.policy), _GATE)
register("h08_gate_verdict", lambda m: G.verdict(G.compare(m.events, m.deltas, m.policy), m.policy).drop("policy"), f"SELECT count(*) AS minutes_compared, count(*) FILTER (WHERE diff <> 0) AS mismatched, max(abs(diff)) AS max_abs_diff, max(truth) AS peak, CASE WHEN count(*) = 0 THEN 'EMPTY' WHEN count(*) FILTER (WHERE diff <> 0) = 0 THEN 'PASS' ELSE 'MISMATCH' END AS verdict FROM ({_GATE})")
register("x02_integral_crosscheck", lambda m: R.hour_view(m.hours, 0).where(_IN_DAY).agg(F.sum("integral").alias("hour_tier")).crossJoin(M.expanded(m.intervals).where(_ON_DAY).agg((F.sum("concurrent") * 60).alias("session_minutes"))), f"SELECT CAST(count(*) * 60 AS BIGINT) AS hour_tier, CAST(count(*) * 60 AS BIGINT) AS session_minutes FROM mins WHERE {_ON_DAY}")
register(
    "x04_extent",
    lambda m: m.events.agg(F.count(F.lit(1)).alias("events"), F.countDistinct("video_session_id").alias("sessions")).crossJoin(m.intervals.agg(F.count(F.lit(1)).alias("intervals"))).crossJoin(m.deltas.agg(F.count(F.lit(1)).alias("delta_rows"), F.min("minute").alias("first_minute"), F.max("minute").alias("last_minute"))).crossJoin(m.users.agg(F.count(F.lit(1)).alias("user_minutes"))),
    "SELECT (SELECT count(*) FROM ev) AS events, (SELECT count(DISTINCT sid) FROM ev) AS sessions, (SELECT count(*) FROM iv) AS intervals, (SELECT count(*) FROM delta) AS delta_rows, (SELECT min(minute) FROM delta) AS first_minute, (SELECT max(minute) FROM delta) AS last_minute, (SELECT count(*) FROM um) AS user_minutes",
)
register("x05_policy", lambda m: m.policy.frame(m.events.sparkSession).select("gap_s", "tail_s", "policy_hash"), f"SELECT CAST({SPARSE.gap_s} AS BIGINT) AS gap_s, CAST({SPARSE.tail_s} AS BIGINT) AS tail_s, '{SPARSE.digest}' AS policy_hash")
register("v15_watermark", lambda m: H.watermark(m.events, m.deltas, m.hours), "SELECT r AS raw_watermark, s AS sealed_watermark, r - s AS sealed_lag_s, h AS hour_tier_last_hour, CASE WHEN r >= h + 3600 THEN h + 3600 ELSE h END AS hour_final_through, r >= h + 3600 AS hour_tier_last_hour_complete, s AS trend_watermark FROM (SELECT (SELECT max(ts_s) FROM ev) AS r, (SELECT max(minute) FROM delta) AS s, (SELECT max(minute) // 3600 * 3600 FROM mins) AS h)")
register("ss13_finality", lambda m: H.with_finality(M.change_curve(m.deltas), NEXT, m.policy), f"SELECT *, minute <= {NEXT - SPARSE.gap_s - SPARSE.tail_s} AS is_final FROM ({_points()})")
_NORM = "CASE lower(trim({0})) WHEN '' THEN '' ELSE split_part(lower(trim({0})), '-', 1) END"
_CLASS = f"CASE WHEN {_NORM} IN ('', 'unk', 'und', 'nil', 'null', 'na', 'n/a', 'undefined', 'unknown') THEN 'unknown' WHEN {_NORM} IN ('off', 'non', 'none', 'disabled') THEN 'off' WHEN {_NORM} IN ('aut', 'auto') THEN 'auto' ELSE 'named' END"
register("v17_audio_norm", lambda m: H.audio_curve(m.deltas), f"SELECT p.minute, p.audio_language_norm, p.audio_class, CAST(coalesce(l.c, 0) AS BIGINT) AS concurrent FROM (SELECT DISTINCT minute, {_NORM.format('audio_language')} AS audio_language_norm, {_CLASS.format('audio_language')} AS audio_class FROM delta) p LEFT JOIN (SELECT minute, {_NORM.format('audio_language')} AS a, count(*) AS c FROM mins GROUP BY ALL) l ON l.minute = p.minute AND l.a = p.audio_language_norm")
_APP = "regexp_replace(lower(app_version), '^([0-9]+\\.[0-9]+\\.[0-9]+)(\\.0+)+$', '\\1')"
_DRIFT = " UNION ALL ".join(f"SELECT '{d}' AS dimension, {f} AS normalised, {c} AS class, {d} AS raw FROM ev" for d, f, c in (("audio_language", _NORM.format("audio_language"), _CLASS.format("audio_language")), ("subtitle_language", _NORM.format("subtitle_language"), _CLASS.format("subtitle_language")), ("player_version", "lower(player_version)", "'n/a'"), ("app_version", _APP, "'n/a'"), ("platform", "lower(platform)", "'n/a'"), ("country", "lower(country)", "'n/a'")))
_DRIFT = f"SELECT dimension, normalised, class, count(DISTINCT raw) AS variants, string_agg(DISTINCT raw, ',' ORDER BY raw) AS raw_values, count(*) AS rows FROM ({_DRIFT}) GROUP BY ALL HAVING count(DISTINCT raw) > 1"
register("v18_drift", lambda m: H.drift(m.events).withColumn("raw_values", F.array_join("raw_values", ",")), _DRIFT)
register("v18_drift_summary", lambda m: H.drift_summary(m.events), f"SELECT dimension, count(*) AS groups_with_variants, CAST(sum(variants) AS BIGINT) AS raw_values_involved, CAST(sum(rows) AS BIGINT) AS rows_in_split_groups FROM ({_DRIFT}) GROUP BY ALL")


def _hostile(m: Model) -> DataFrame:
    """Events of which every 97th has a blank session and every 89th an impossible time."""
    k = F.pmod(F.col("ts_s"), F.lit(97))
    bad_time = F.pmod(F.col("ts_s"), F.lit(89)) == 0
    return m.events.withColumns({"video_session_id": F.when(k == 0, " ").otherwise(F.col("video_session_id")), "ts_s": F.when(bad_time, F.lit(5).cast("long")).otherwise(F.col("ts_s"))}).drop("extra")


def _flagged(m: Model) -> DataFrame:
    """The same with events without a user, before their session's start, and with a start that is not believed."""
    of = F.col("content_id") % 20
    start = F.when(of == 4, F.col("ts_s") + 9).when(of == 5, F.lit(0).cast("long")).otherwise(F.col("session_start_s"))
    return _hostile(m).withColumns({"user_id": F.when(of == 3, "").otherwise(F.col("user_id")), "session_start_s": start})


_HOSTILE = "(SELECT * REPLACE (CASE WHEN ts_s % 97 = 0 THEN ' ' ELSE sid END AS sid, CASE WHEN ts_s % 89 = 0 THEN 5 ELSE ts_s END AS ts_s) FROM ev)"
_REASON = "CASE WHEN trim(sid) = '' THEN 'session_id_unusable' WHEN ts_s < 1577836800 OR ts_s >= 2051222400 THEN 'ts_out_of_range' ELSE '' END"
_HCOLS = "content_id, sid, user_id, event_type, event, ts_s, platform, app_version, country, audio_language, subtitle_language, player_version, session_start_s"
register("v19_quarantine", lambda m: H.quarantine_summary(H.quarantine(_hostile(m))).withColumn("sample_sessions", F.array_join("sample_sessions", ",")), f"SELECT reason, CAST(sum(copies) AS BIGINT) AS rows, count(*) AS distinct_rows, count(DISTINCT sid) AS sessions, min(ts_s) AS first_seen, max(ts_s) AS last_seen, array_to_string(list_sort(list_distinct(list(sid)))[1:5], ',') AS sample_sessions FROM (SELECT {_REASON} AS reason, {_HCOLS}, count(*) AS copies FROM {_HOSTILE} GROUP BY ALL) WHERE reason <> '' GROUP BY reason")
register("pf01_model_input", lambda m: H.model_input(_hostile(m)).groupBy("event_type", "event").agg(F.count(F.lit(1)).alias("rows")), f"SELECT event_type, event, count(*) AS rows FROM {_HOSTILE} WHERE {_REASON} = '' GROUP BY ALL")
register("v19_flags", lambda m: H.flag_counts(m.events.withColumn("user_id", F.when(F.col("content_id") == 3, "").otherwise(F.col("user_id"))).withColumn("session_start_s", F.when(F.col("content_id") == 4, F.col("ts_s") + 9).otherwise(F.col("session_start_s")))), "SELECT flag, count(*) AS rows, count(DISTINCT sid) AS sessions, min(ts_s) AS first_seen, max(ts_s) AS last_seen FROM (SELECT 'user_id_empty' AS flag, * FROM ev WHERE content_id = 3 UNION ALL SELECT 'event_before_session_start', * FROM ev WHERE content_id = 4) GROUP BY flag")
_FLAGGED = "(SELECT * REPLACE (CASE WHEN content_id % 20 = 3 THEN '' ELSE user_id END AS user_id, CASE WHEN content_id % 20 = 4 THEN ts_s + 9 WHEN content_id % 20 = 5 THEN 0 ELSE session_start_s END AS session_start_s) FROM " + _HOSTILE + ")"
_FLAGS = "[CASE WHEN trim(user_id) = '' THEN 'user_id_empty' END, CASE WHEN session_start_s >= 1577836800 AND session_start_s < 2051222400 AND session_start_s > ts_s THEN 'event_before_session_start' END, CASE WHEN session_start_s < 1577836800 OR session_start_s >= 2051222400 THEN 'session_start_out_of_range' END, CASE WHEN content_id = -1 THEN 'content_id_rollup_sentinel' END, CASE WHEN sid <> trim(sid) OR user_id <> trim(user_id) THEN 'identity_padded' END]"
register("v19_summary", lambda m: H.preprocess_summary(_flagged(m)), f"SELECT count(*) AS raw_rows, count(*) FILTER (WHERE {_REASON} <> '') AS quarantined_rows, count(*) FILTER (WHERE {_REASON} = '') AS model_input_rows, (SELECT count(DISTINCT f) FROM (SELECT unnest({_FLAGS}) AS f FROM {_FLAGGED} WHERE {_REASON} = '')) AS flag_classes_present FROM {_FLAGGED}")
_NOW = DAY + 10 * 86_400
_SHAPE = "(SELECT sid, min(ts_s) AS t, min(session_start_s) AS s, count(DISTINCT session_start_s) AS n, min(ts_s) FILTER (WHERE event_type = 'VideoSessionStart') AS a, min(ts_s) FILTER (WHERE event_type = 'VideoSessionEnd') AS b, count(*) FILTER (WHERE event_type = 'VideoSessionEnd') AS ends FROM ev GROUP BY sid)"
_TIED = "(SELECT sid, ts_s, count(DISTINCT platform) > 1 OR count(DISTINCT country) > 1 OR count(DISTINCT content_id) > 1 AS bad FROM ev GROUP BY sid, ts_s)"
_KNOWN = "event_type IN (" + ", ".join(f"'{t}'" for t in VOCABULARY) + ")"
_PAIR = " OR ".join(f"(event_type = '{t}' AND event IN ({', '.join(repr(e) for e in names)}))" for t, names in VOCABULARY.items())
_EMPTY = ", ".join(f"CASE WHEN count(*) > 0 AND count(*) FILTER (WHERE coalesce({d}, '') = '') = count(*) THEN '{d}' END" for d in ("platform", "country", "app_version", "audio_language", "subtitle_language", "player_version", "event"))
_SPAN = "(SELECT min(ts_s) || ' to ' || max(ts_s) FROM ev)"
_PROBE_SQL = {
    "source_empty": ("(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM ev)", "''"), "time_out_of_range": ("(SELECT count(*) FILTER (WHERE year(make_timestamp(ts_s * 1000000)) NOT BETWEEN 2020 AND 2035) FROM ev)", _SPAN),
    "session_start_zero": ("(SELECT count(*) FROM ev WHERE session_start_s = 0)", "''"), "identity_empty": ("(SELECT count(*) FROM ev WHERE sid = '' OR user_id = '')", "''"), "event_type_unknown": (f"(SELECT count(*) FROM ev WHERE NOT ({_KNOWN}))", "''"),
    "columns_missing": ("0", "''"), "columns_extra": ("0", "''"), "event_unknown": (f"(SELECT count(*) FROM ev WHERE {_KNOWN} AND NOT ({_PAIR}))", "''"), "session_id_reused": (f"(SELECT count(*) FROM {_SHAPE} WHERE n > 1)", "''"),
    "events_before_session_start": (f"(SELECT count(*) FROM {_SHAPE} WHERE t < s)", "''"), "events_in_future": (f"(SELECT count(*) FROM ev WHERE ts_s > {_NOW} + 300)", "''"), "end_before_start": (f"(SELECT count(*) FROM {_SHAPE} WHERE b < a)", "''"),
    "several_ends": (f"(SELECT count(*) FROM {_SHAPE} WHERE ends > 1)", "''"), "dimensions_tied": (f"(SELECT count(*) FROM {_TIED} WHERE bad)", f"(SELECT round(count(*) FILTER (WHERE bad) * 100 / greatest(count(*), 1), 4) || '% of groups' FROM {_TIED})"),
    "duplicate_rows": ("(SELECT count(*) - count(DISTINCT (content_id, sid, user_id, event_type, event, ts_s, platform, app_version, country, audio_language, subtitle_language, player_version, session_start_s)) FROM ev)", "''"),
    "content_id_sentinel": ("(SELECT count(*) FROM ev WHERE content_id = -1)", "''"), "key_sentinel": ("(SELECT count(*) FROM ev WHERE platform = '*' OR country = '*')", "''"), "content_without_catalog": ("(SELECT count(DISTINCT content_id) FROM ev WHERE content_id NOT IN (SELECT content_id FROM cat))", "''"),
    "catalog_conflicts": ("(SELECT count(*) FROM (SELECT content_id FROM cat GROUP BY content_id HAVING count(DISTINCT (title, video_type, category)) > 1))", "''"),
    "dimensions_empty": (f"(SELECT len(list_filter([{_EMPTY}], lambda x: x IS NOT NULL)) FROM ev)", f"(SELECT array_to_string(list_filter([{_EMPTY}], lambda x: x IS NOT NULL), ', ') FROM ev)"),
    "rows": ("(SELECT count(*) FROM ev)", "''"), "sessions": ("(SELECT count(DISTINCT sid) FROM ev)", "(SELECT count(DISTINCT user_id) || ' users' FROM ev)"), "span_minutes": ("(SELECT max(ts_s) // 60 - min(ts_s) // 60 FROM ev)", _SPAN),
    "event_types": ("(SELECT count(DISTINCT event_type) FROM ev)", "(SELECT string_agg(event_type || ':' || n, ' ' ORDER BY n DESC, event_type) FROM (SELECT event_type, count(*) AS n FROM ev GROUP BY event_type))"),
    "contents": ("(SELECT count(DISTINCT content_id) FROM ev)", "(SELECT 'platforms ' || count(DISTINCT platform) || ', countries ' || count(DISTINCT country) FROM ev)"),
}
_CONTRACT = " UNION ALL ".join(f"SELECT '{p}' AS probe, '{sev}' AS severity, CAST({_PROBE_SQL[p][0]} AS BIGINT) AS value, {_PROBE_SQL[p][1]} AS note" for p, sev in H.PROBES)
register("h04_contract", lambda m: H.contract_report(m.events, m.catalog, now_s=_NOW), f"SELECT *, CASE WHEN value = 0 OR severity = 'INFO' THEN 'OK' ELSE severity END AS verdict FROM ({_CONTRACT})")
_COUNTS = "SELECT ts_s // 60 * 60 AS minute, count(*) FILTER (WHERE event_type = 'VideoSessionEnd') AS ends, count(*) FILTER (WHERE event_type = 'VideoSessionStart') AS starts, count(*) FILTER (WHERE event_type = 'VideoHeartbeat') AS hb, count(*) FILTER (WHERE event = 'pause' OR event_type = 'AppBackgrounded') AS pausebg FROM ev GROUP BY ALL"
register("h03_minute_counts", lambda m: H.minute_event_counts(m.events), _COUNTS)


def _base_sql(value: str, source: str) -> str:
    return f"coalesce(list_sort(list({value}) OVER (ORDER BY minute ROWS BETWEEN 17 PRECEDING AND 3 PRECEDING))[(count(*) OVER (ORDER BY minute ROWS BETWEEN 17 PRECEDING AND 3 PRECEDING)) // 2 + 1], 0)"


_DAYCURVE = _dense(DAY, DAY + 3 * 86_400)
register(
    "h01_declines",
    lambda m: H.declines(M.dense_curve(m.deltas, DAY, DAY + 3 * 86_400), H.minute_event_counts(m.events), 3, 0.8, 1).select("minute", "concurrent", "baseline", "fired", "class"),
    f"""SELECT minute, c AS concurrent, b AS baseline, f AS fired, CASE WHEN NOT f THEN '' WHEN hb / greatest(c, 1) < 1.0 AND cov < 0.2 THEN 'OUTAGE' WHEN cov >= 0.7 THEN 'ENDING' WHEN hb / greatest(c, 1) >= 2.5 AND pausebg >= 1.5 * pb THEN 'DISENGAGEMENT' ELSE 'UNCLASSIFIED' END AS class FROM (
  SELECT *, b >= 3 AND c < 0.8 * b AND b - c >= 1 AS f, CASE WHEN lost > 0 THEN CAST(ends AS DOUBLE) / lost ELSE 0.0 END AS cov FROM (
    SELECT minute, c, hb, ends, pausebg, {_base_sql('c', '')} AS b, {_base_sql('pausebg', '')} AS pb, greatest(coalesce(lag(c) OVER (ORDER BY minute), 0) - c, 0) AS lost FROM (
      SELECT q.minute, q.concurrent AS c, coalesce(k.hb, 0) AS hb, coalesce(k.ends, 0) AS ends, coalesce(k.pausebg, 0) AS pausebg FROM ({_DAYCURVE}) q LEFT JOIN ({_COUNTS}) k ON k.minute = q.minute)))""",
)
register("w07_lag_detectors", lambda m: H.lag_detectors(M.dense_curve(m.deltas, DAY, NEXT)), f"SELECT minute, concurrent, coalesce(lag(concurrent, 5) OVER (ORDER BY minute), 0) AS five_ago, avg(concurrent) OVER (ORDER BY minute ROWS BETWEEN 17 PRECEDING AND 3 PRECEDING) AS mean_lag3, coalesce(list_sort(list(concurrent) OVER (ORDER BY minute ROWS BETWEEN 14 PRECEDING AND CURRENT ROW))[(count(*) OVER (ORDER BY minute ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)) // 2 + 1], 0) AS median_nolag, coalesce(lag(concurrent) OVER (ORDER BY minute), 0) AS previous FROM ({_dense(DAY, NEXT)})")
register("jn08_day_on_day", lambda m: H.day_on_day(M.dense_curve(m.deltas, DAY, DAY + 3 * 86_400)), f"SELECT a.minute, a.concurrent, b.concurrent AS day_before, a.concurrent - b.concurrent AS change FROM ({_DAYCURVE}) a JOIN ({_DAYCURVE}) b ON b.minute = a.minute - 86400")
register("h05_model_comparison", lambda m: H.model_comparison(m.events, m.intervals), f"SELECT coalesce(a.minute, s.minute, n.minute) AS minute, coalesce(a.c, 0) AS aware, coalesce(s.c, 0) AS stateless, coalesce(n.c, 0) AS naive FROM {by_minute()} a FULL JOIN {_STATELESS} s ON s.minute = a.minute FULL JOIN {_NAIVE} n ON n.minute = coalesce(a.minute, s.minute)")
register("h05_excluded_hours", lambda m: H.excluded_hours(m.events, m.intervals), "SELECT aware_hours, naive_hours, naive_hours - aware_hours AS excluded_hours FROM (SELECT (SELECT CAST(sum(end_s - start_s) AS DOUBLE) / 3600 FROM iv) AS aware_hours, (SELECT CAST(sum(b - a) AS DOUBLE) / 3600 FROM (SELECT min(ts_s) AS a, max(ts_s) AS b FROM ev GROUP BY sid)) AS naive_hours)")
register(
    "raw_dim_filter",
    lambda m: M.expanded(I.derive_intervals(m.events.join(m.events.where(F.element_at("extra", "video_resolution").isNotNull()).groupBy("video_session_id").agg(F.max_by(F.element_at("extra", "video_resolution"), F.struct("ts_s", F.element_at("extra", "video_resolution"))).alias("_v")).where("_v = '720p'"), "video_session_id", "left_semi"), m.policy)),
    "SELECT minute, count(*) AS concurrent FROM mins WHERE sid IN (SELECT sid FROM (SELECT sid, arg_max(video_resolution, (ts_s, video_resolution)) AS v FROM ev WHERE video_resolution IS NOT NULL GROUP BY sid) WHERE v = '720p') GROUP BY minute",
)
register("q34_users_le_sessions", lambda m: M.expanded(m.intervals).join(M.user_curve(m.users), "minute").agg(F.count(F.lit(1)).alias("minutes"), F.count_if(F.col("concurrent_users") > F.col("concurrent")).alias("more_users")), f"SELECT count(*) AS minutes, count(*) FILTER (WHERE u.c > s.c) AS more_users FROM {by_minute()} s JOIN {by_minute('', 'um', 'true', _UC)} u ON u.minute = s.minute")
_LEVELS = "(SELECT unnest(range(0, 8)) AS g)"
_CELL = "CASE WHEN g & 1 = 1 THEN platform ELSE '*' END AS lv_platform, CASE WHEN g & 2 = 2 THEN country ELSE '*' END AS lv_country, CASE WHEN g & 4 = 4 THEN content_id ELSE -1 END AS lv_content, g"
_TRUTH = f"(SELECT {_CELL}, minute, count(DISTINCT sid) AS c, count(DISTINCT user_id) AS u FROM (SELECT sid, user_id, platform, country, content_id, unnest(range(sm, em + 60, 60)) AS minute FROM im), {_LEVELS} GROUP BY ALL)"
_SERVED = f"(SELECT {_CELL}, minute, count(*) AS c FROM mins, {_LEVELS} GROUP BY ALL)"
_ON = "a.lv_platform = b.lv_platform AND a.lv_country = b.lv_country AND a.lv_content = b.lv_content AND a.g = b.g"
register("h07_peak_not_sum", lambda m: V.peak_not_sum(m.intervals, m.hours), f"""SELECT truth_peak, serving_peak, sum_of_platform_peaks, CASE WHEN serving_peak <> truth_peak THEN 'FAIL' WHEN sum_of_platform_peaks <= truth_peak THEN 'INCONCLUSIVE' ELSE 'PASS' END AS verdict FROM (
  SELECT (SELECT max(c) FROM {_TRUTH} WHERE g = 0) AS truth_peak, (SELECT max(c) FROM {_SERVED} WHERE g = 0) AS serving_peak, (SELECT CAST(sum(p) AS BIGINT) FROM (SELECT max(c) AS p FROM {_TRUTH} WHERE g = 1 GROUP BY lv_platform)) AS sum_of_platform_peaks)""")
register("h07_users_never_summed", lambda m: V.users_never_summed(m.intervals, m.users), f"""SELECT count(*) AS minutes_compared, count(*) FILTER (WHERE coalesce(s, 0) <> t) AS serving_mismatch_minutes, (SELECT count(DISTINCT minute) FROM um WHERE minute NOT IN (SELECT minute FROM {_TRUTH} WHERE g = 0)) AS extra_serving_minutes, count(*) FILTER (WHERE x > t) AS minutes_where_sum_overcounts, max(x - t) AS max_overcount,
  CASE WHEN count(*) FILTER (WHERE coalesce(s, 0) <> t) > 0 OR (SELECT count(DISTINCT minute) FROM um WHERE minute NOT IN (SELECT minute FROM {_TRUTH} WHERE g = 0)) > 0 THEN 'FAIL' WHEN count(*) FILTER (WHERE x > t) = 0 THEN 'INCONCLUSIVE' ELSE 'PASS' END AS verdict
  FROM (SELECT minute, u AS t FROM {_TRUTH} WHERE g = 0) a LEFT JOIN (SELECT minute, CAST(sum(u) AS BIGINT) AS x FROM {_TRUTH} WHERE g = 1 GROUP BY minute) b ON a.minute = b.minute LEFT JOIN (SELECT minute, count(DISTINCT user_id) AS s FROM um GROUP BY minute) d ON a.minute = d.minute""")
register("h07_day_peaks", lambda m: V.day_peaks(m.intervals, m.hours), f"""SELECT g AS cube_level, count(*) AS rows_compared, count(*) FILTER (WHERE coalesce(sp, -1) <> coalesce(tp, -1)) AS peak_mismatch, count(*) FILTER (WHERE coalesce(si, -1) <> coalesce(ti, -1)) AS integral_mismatch, CASE WHEN count(*) FILTER (WHERE coalesce(sp, -1) <> coalesce(tp, -1) OR coalesce(si, -1) <> coalesce(ti, -1)) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM (
  SELECT coalesce(a.g, b.g) AS g, a.p AS tp, a.i AS ti, b.p AS sp, b.i AS si FROM (SELECT g, lv_platform, lv_country, lv_content, minute // 86400 AS day, max(c) AS p, sum(c) * 60 AS i FROM {_TRUTH} GROUP BY ALL) a FULL JOIN (SELECT g, lv_platform, lv_country, lv_content, minute // 86400 AS day, max(c) AS p, sum(c) * 60 AS i FROM {_SERVED} GROUP BY ALL) b ON {_ON} AND a.day = b.day) GROUP BY g""")
register("h07_users_le_sessions", lambda m: V.users_le_sessions(m.intervals, m.users), f"""SELECT a.g AS cube_level, count(*) AS cells_compared, count(*) FILTER (WHERE a.u > coalesce(b.c, 0)) AS violations, max(a.u - coalesce(b.c, 0)) AS max_excess, CASE WHEN count(*) FILTER (WHERE a.u > coalesce(b.c, 0)) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict
  FROM (SELECT {_CELL}, minute, count(DISTINCT user_id) AS u FROM um, {_LEVELS} GROUP BY ALL) a LEFT JOIN {_TRUTH} b ON {_ON} AND a.minute = b.minute GROUP BY a.g""")
register("h07_orphan_hours", lambda m: V.orphan_hours(m.intervals, m.catalog), """SELECT t AS total_integral, t - o AS catalogued_integral, o AS orphan_integral, round(100.0::DOUBLE * o / greatest(t, 1), 3) AS orphan_pct, ids AS orphan_content_ids, CASE WHEN o = 0 THEN 'PASS' ELSE 'PASS-WITH-DISCLOSURE' END AS verdict FROM (
  SELECT CAST(sum(n) * 60 AS BIGINT) AS t, CAST(coalesce(sum(n) FILTER (WHERE lost), 0) * 60 AS BIGINT) AS o, coalesce(string_agg(CAST(content_id AS VARCHAR), ',' ORDER BY content_id) FILTER (WHERE lost), '') AS ids
  FROM (SELECT content_id, count(DISTINCT (sid, minute)) AS n, content_id NOT IN (SELECT content_id FROM cat) AS lost FROM (SELECT sid, content_id, unnest(range(sm, em + 60, 60)) AS minute FROM im) GROUP BY content_id))""")

# --- landing
def _landed(m: Model) -> DataFrame:
    """The events as a folder of CSV files: some times and contents are no numbers, some starts are empty, one column is new."""
    path = f"{m.folder}/landing"
    if not _exists(m.events.sparkSession, path):
        k, ms = F.col("ts_s") - F.col("session_start_s"), ((F.col("ts_s") * 1000) + (F.col("ts_s") - F.col("session_start_s")) % 1000).cast("string")
        time = F.when(k % 50 == 7, "n/a").when(k % 50 == 8, F.concat(F.lit(" "), ms)).otherwise(ms)
        content = F.when(k % 40 == 3, F.concat(F.col("content_id").cast("string"), F.lit(".5"))).otherwise(F.col("content_id").cast("string"))
        start = F.when(k % 30 == 4, "").otherwise((F.col("session_start_s") * 1000).cast("string"))
        rows = m.events.select(content.alias("content_id"), "video_session_id", "user_id", "event_type", "event", time.alias("event_timestamp"), "platform", "app_version", "country", "audio_language", "subtitle_language", "player_version", start.alias("session_start_epoch"), F.coalesce(F.element_at("extra", "video_resolution"), F.lit("")).alias("video_resolution"))
        rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return L.read_landing(m.events.sparkSession, path, "load 1", multi_line=False)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


_LANDED = "(SELECT * EXCLUDE (content_id, session_start_s, video_resolution), CASE WHEN k % 40 = 3 THEN content_id || '.5' ELSE CAST(content_id AS VARCHAR) END AS content_id, CASE WHEN k % 50 = 7 THEN 'n/a' WHEN k % 50 = 8 THEN ' ' || (ts_s * 1000 + k % 1000) ELSE CAST(ts_s * 1000 + k % 1000 AS VARCHAR) END AS event_timestamp, CASE WHEN k % 30 = 4 THEN '' ELSE CAST(session_start_s * 1000 AS VARCHAR) END AS session_start_epoch, coalesce(video_resolution, '') AS video_resolution, k % 50 IN (7, 8) AS rejected, k % 50 IN (7, 8) OR k % 40 = 3 OR k % 30 = 4 AS bad FROM (SELECT *, ts_s - session_start_s AS k FROM ev))"
_TEXTS = "sid AS video_session_id, user_id, event_type, event, platform, app_version, country, audio_language, subtitle_language, player_version"
register("sc01_landing", lambda m: _landed(m).withColumn("video_resolution", F.element_at("extra", "video_resolution")).drop("extra"), f"SELECT content_id, {_TEXTS}, event_timestamp, session_start_epoch, 'load 1' AS load_id, nullif(video_resolution, '') AS video_resolution FROM {_LANDED}")
_TYPED = ("content_id", "video_session_id", "user_id", "event_type", "event", "platform", "app_version", "country", "audio_language", "subtitle_language", "player_version", "ts_s", "session_start_s")
register("sc04_typed", lambda m: L.cast_landing(_landed(m))[0].select(*_TYPED), f"SELECT coalesce(TRY_CAST(CASE WHEN regexp_matches(content_id, '^-?[0-9]+$') THEN content_id END AS BIGINT), 0) AS content_id, {_TEXTS}, ts_s, CASE WHEN session_start_epoch = '' THEN 0 ELSE CAST(session_start_epoch AS BIGINT) // 1000 END AS session_start_s FROM {_LANDED} WHERE NOT rejected")
_LEDGER = f"(SELECT CASE WHEN rejected THEN 'rejected' ELSE 'coalesced' END AS disposition, CASE WHEN rejected THEN 'event_timestamp_not_a_number' ELSE 'number_coalesced' END AS reason, concat_ws('; ', CASE WHEN k % 40 = 3 THEN 'content_id=' || content_id END, CASE WHEN rejected THEN 'event_timestamp=' || event_timestamp END, CASE WHEN k % 30 = 4 THEN 'session_start_epoch=' END) AS detail, count(*) AS copies FROM {_LANDED} WHERE bad GROUP BY ALL, {', '.join(c.split(' AS ')[0] for c in _TEXTS.split(', '))}, content_id, event_timestamp, session_start_epoch, video_resolution)"
_LEDGER = _LEDGER.replace("GROUP BY ALL, ", "GROUP BY rejected, k, ")
register("sc06_ledger", lambda m: L.cast_landing(_landed(m))[1].select("source", "reason", "disposition", "detail", "copies"), f"SELECT 'events' AS source, reason, disposition, detail, copies FROM {_LEDGER}")


def _dispositions(m: Model) -> DataFrame:
    landed = _landed(m)
    return L.disposition_report(landed, *L.cast_landing(landed))


register("sc07_disposition", _dispositions, f"SELECT 'load 1' AS load_id, count(*) AS landed, count(*) FILTER (WHERE rejected) AS rejected, count(*) FILTER (WHERE NOT rejected) AS typed, count(*) FILTER (WHERE bad AND NOT rejected) AS coalesced FROM {_LANDED}")
register("sc08_ledger_summary", lambda m: L.ledger_summary(L.cast_landing(_landed(m))[1]).withColumn("sample_detail", F.array_join("sample_detail", "|")), f"SELECT 'events' AS source, reason, disposition, CAST(sum(copies) AS BIGINT) AS rows, count(*) AS distinct_rows, array_to_string(list_sort(list_distinct(list(detail)))[1:5], '|') AS sample_detail FROM {_LEDGER} GROUP BY reason, disposition")
register("sc13_latest", lambda m: I.latest(m.intervals.unionByName(m.intervals.withColumns({"end_s": F.col("end_s") + 1, "build_version": F.lit(2).cast("long")}))).select("video_session_id", "start_s", "end_s", "build_version"), "SELECT sid AS video_session_id, start_s, end_s + 1 AS end_s, CAST(2 AS BIGINT) AS build_version FROM iv")
register("sc12_session_spans", lambda m: m.spans, "SELECT sid AS video_session_id, min(ts_s) AS first_s, max(ts_s) AS last_s, count(*) AS events FROM ev GROUP BY sid")
register("sc12_session_history", lambda m: I.session_history(m.intervals, "s3").select("video_session_id", *_IV), f"SELECT sid AS video_session_id, {', '.join(_IV)} FROM iv WHERE sid = 's3'")


def _cohorts(m: Model) -> DataFrame:
    curves = [M.expanded(I.derive_intervals(S.cohort(m.events.sparkSession, n), Policy())).select(F.lit(n).alias("cohort"), "minute", "concurrent") for n in S.COHORTS]
    return reduce(DataFrame.unionByName, curves)


_COHORTS = " UNION ALL ".join(
    f"SELECT '{n}' AS cohort, minute, count(DISTINCT i) AS concurrent FROM (SELECT i, unnest(range(({S.START_S + a} + {c.stagger_s} * i) // 60 * 60, ({S.START_S + b} + {c.stagger_s} * i) // 60 * 60 + 60, 60)) AS minute FROM range({c.sessions}) t(i)) GROUP BY minute"
    if len(c.active(60)) == 1 else
    f"SELECT '{n}' AS cohort, minute, count(DISTINCT i) AS concurrent FROM (SELECT i, unnest(range(({S.START_S} + a + {c.stagger_s} * i) // 60 * 60, ({S.START_S} + b + {c.stagger_s} * i) // 60 * 60 + 60, 60)) AS minute FROM range({c.sessions}) t(i), (VALUES {', '.join(map(str, c.active(60)))}) v(a, b)) GROUP BY minute"
    for n, c in S.COHORTS.items() for a, b in c.active(60)[:1] if c.span_s
)  # a lone event is no activity
register("sc18_cohorts", _cohorts, _COHORTS)


# --- publishing: of each four seconds the events of three are published, one batch each, so that most come late
def _published(m: Model) -> Publisher:
    publisher = Publisher(m.events.sparkSession, f"{m.folder}/published", m.policy)
    for batch in range(publisher.generation() + 1, 3):
        publisher.process(m.events.where(F.col("ts_s") % 4 == batch), batch)
    return publisher


def _published_sql(batches: int) -> str:
    return BASE.replace("FROM events\n", f"FROM events WHERE CAST(floor(epoch(ts)) AS BIGINT) % 4 < {batches}\n")


def _register_published(name: str, run: Callable[[Publisher, Model], DataFrame], sql: str, batches: int = 3) -> None:
    register(name, lambda m: run(_published(m), m), None)
    _SQL[name] = _published_sql(batches) + sql


_register_published("ss07_intervals", lambda p, m: p.intervals().select("video_session_id", *_IV), f"SELECT sid AS video_session_id, {', '.join(_IV)} FROM iv")
_register_published("ss08_deltas", lambda p, m: p.deltas(), "SELECT * FROM delta WHERE delta <> 0 OR starts <> 0 OR ends <> 0")
_register_published("ss09_hours", lambda p, m: p.hours().where("peak <> 0 or integral <> 0"), _SQL["ag17_hour_cube"].removeprefix(BASE))
_register_published("ag06_users", lambda p, m: p.users(), "SELECT minute, platform, country, content_id, user_id FROM um")
_register_published("v21_intervals_at", lambda p, m: p.intervals(1).select("video_session_id", *_IV), f"SELECT sid AS video_session_id, {', '.join(_IV)} FROM iv", 2)
_register_published("v21_deltas_at", lambda p, m: p.deltas(0), "SELECT * FROM delta WHERE delta <> 0 OR starts <> 0 OR ends <> 0", 1)
_register_published("v21_status", lambda p, m: p.status().select("generation", "status", "parent", "events", "sessions", "watermark_s", "is_active"), "SELECT ts_s % 4 AS generation, 'committed' AS status, ts_s % 4 - 1 AS parent, count(*) AS events, count(DISTINCT sid) AS sessions, max(ts_s) AS watermark_s, ts_s % 4 = 2 AS is_active FROM ev GROUP BY ts_s % 4")
_register_published(
    "v22_publish_lag",
    lambda p, m: p.publish_lag(m.events, now_s=NEXT).select("publish_cursor", "ingest_watermark", "publish_lag_s", "pending_events", "pending_sessions", "oldest_pending_s", "oldest_pending_age_s", "retention_headroom_s", "retention_alert", "last_committed", "runs_in_flight"),
    f"SELECT *, greatest(0, {NEXT} - oldest_pending_s) AS oldest_pending_age_s, {7 * 86_400} - greatest(0, {NEXT} - oldest_pending_s) AS retention_headroom_s, greatest(0, {NEXT} - oldest_pending_s) > {6 * 86_400} AS retention_alert, CAST(2 AS BIGINT) AS last_committed, CAST(0 AS BIGINT) AS runs_in_flight FROM (SELECT max(ts_s) FILTER (WHERE ts_s % 4 < 3) AS publish_cursor, max(ts_s) AS ingest_watermark, greatest(0, max(ts_s) - max(ts_s) FILTER (WHERE ts_s % 4 < 3)) AS publish_lag_s, count(*) FILTER (WHERE ts_s % 4 = 3) AS pending_events, count(DISTINCT sid) FILTER (WHERE ts_s % 4 = 3) AS pending_sessions, min(ts_s) FILTER (WHERE ts_s % 4 = 3) AS oldest_pending_s FROM ev)",
    4,
)
register("h09_freshness", lambda m: (lambda p: p.freshness(now_s=p.commits()[2]["committed_s"] + 60).select("stage", "rows", "age_s", "verdict"))(_published(m)), None)
_register_published("ss01_stateless", lambda p, m: p.stateless(), "SELECT DISTINCT ts_s // 60 * 60 AS minute, platform, country, content_id, sid AS video_session_id FROM ev WHERE event_type IN ('VideoHeartbeat', 'VideoPlay')")


def _variants(m: Model) -> DataFrame:
    """What each variant policy makes of the events, at the gap and tail that suit them."""

    def one(name: str, policy: Policy) -> DataFrame:
        fitted = replace(policy, gap_s=policy.gap_s if policy.gap_s > m.policy.gap_s else m.policy.gap_s, tail_s=m.policy.tail_s)
        cut = I.segments(m.events, fitted)
        return cut.agg(F.lit(name).alias("variant"), F.count(F.lit(1)).alias("intervals"), F.sum(F.col("end_s") - F.col("start_s")).alias("seconds"), F.countDistinct("video_session_id").alias("sessions"))

    return reduce(DataFrame.unionByName, [one(n, p) for n, p in VARIANTS.items()])


register("m14_variants", _variants, None)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
