"""Hostile requests: one case for each, against truth by hand or by counting sessions minute by minute."""

import datetime

import pytest
from pyspark.sql import functions as F

from kelpline.functions.normalise import norm_lang
from kelpline.operators import catalog as C
from kelpline.operators import hours as R
from kelpline.operators import minutes as M

DAY = int(datetime.datetime(2026, 6, 1, tzinfo=datetime.UTC).timestamp())
#: (session, user, content, platform, audio, start, end), times on the first day unless they begin with +.
INTERVALS = [
    ("s01", "u01", 101, "ANDROID_PHONE", "hin", "10:05:00", "10:25:00"), ("s02", "u02", 101, "ANDROID_PHONE", "HIN", "10:10:00", "10:40:00"), ("s03", "u03", 101, "IOS_PHONE", "hin-hindi", "10:10:00", "10:20:00"),
    ("s04", "u04", 102, "WEB", "hin-Hindi", "10:15:00", "10:45:00"), ("s05", "u01", 102, "IOS_PHONE", "eng", "10:15:00", "10:35:00"), ("s06", "u05", -1, "ANDROID_PHONE", "tam", "10:12:00", "10:50:00"),
    ("s07", "u06", 101, "*", "tel", "10:20:00", "10:30:00"), ("s08", "u07", 999, "ANDROID_PHONE", "hin", "10:22:00", "10:38:00"), ("s09", "u08", 101, "android_phone", "हिन्दी", "10:30:00", "10:44:00"),
    ("s10", "u09", 102, "WEB_TV_RARE", "eng", "14:05:00", "14:20:00"), ("s11", "u10", 102, "ANDROID_PHONE", "eng", "14:00:00", "14:59:59"), ("s12", "u11", 101, "IOS_TV", "hin", "15:30:00", "18:45:00"),
    ("s13", "u12", 101, "WEB", "eng", "19:00:00", "20:00:00"), ("s14", "u13", 101, "WEB", "eng", "20:59:30", "21:00:30"), ("s15", "u14", 102, "IOS_PHONE", "eng", "22:10:10", "22:10:50"),
    ("s16", "u15", 101, "ANDROID_PHONE", "hin", "+09:00:00", "+09:30:00"), ("s17", "u16", 102, "WEB", "eng", "08:00:00", "08:10:00"), ("s18", "u02", 101, "ANDROID_PHONE", "HIN", "10:30:00", "10:35:00"),
]
CATALOG = [(101, "Alpha Live", "live", "sports", ""), (102, "Beta Movie", "vod", "movies", ""), (103, "Gamma Blank", "", "misc", ""), (-1, "Minus One Asset", "live", "sports", "")]


def sec(clock: str) -> int:
    day, clock = (86_400, clock[1:]) if clock[0] == "+" else (0, clock)
    h, m, s = (int(x) for x in (clock + ":00")[:8].split(":"))
    return DAY + day + h * 3600 + m * 60 + s


class Tiers:
    def __init__(self, spark, tmp):
        rows = [(s, u, c, p, "india", "1.0.0", a, "OFF", "p1", {}, sec(x), sec(y), False, 1) for s, u, c, p, a, x, y in INTERVALS]
        schema = "video_session_id string, user_id string, content_id long, platform string, country string, app_version string, audio_language string, subtitle_language string, player_version string, extra_dimensions map<string,string>, start_s long, end_s long, is_open boolean, build_version long"
        self.intervals = spark.createDataFrame(rows, schema)
        self.catalog = spark.createDataFrame(CATALOG, "content_id long, title string, video_type string, category string, show_name string")
        M.minute_deltas(self.intervals).write.parquet(f"{tmp}/deltas")
        self.deltas = spark.read.parquet(f"{tmp}/deltas")
        R.hour_rollup(self.deltas).write.parquet(f"{tmp}/hours")
        self.hours = spark.read.parquet(f"{tmp}/hours")


@pytest.fixture(scope="module")
def tiers(spark, tmp_path_factory):
    return Tiers(spark, str(tmp_path_factory.mktemp("robust")))


def truth(start, end, keep=lambda r: True):
    """(peak, its earliest second, integral) of [start, end) from sets of sessions."""
    levels: dict[int, set] = {}
    for r in INTERVALS:
        if keep(r):
            for m in range(sec(r[5]) // 60 * 60, sec(r[6]) // 60 * 60 + 1, 60):
                levels.setdefault(m, set()).add(r[0])
    cut = {max(m, start): (len(s), min(m + 60, end) - max(m, start)) for m, s in levels.items() if m + 60 > start and m < end}
    peak = max((c for c, _ in cut.values()), default=0)
    return peak, min((m for m, (c, _) in cut.items() if c == peak), default=0), sum(c * n for c, n in cut.values())


def whole(rows):
    return [(r.peak, r.peak_minute, r.integral) for r in rows.collect()]


# Each: start, end, filters, and what is expected: None for no row (of values that no tier has), else truth under a condition.
RANGES = {
    "unknown platform": ("10:00", "11:00", {"platform": "NOKIA_9000"}, None), "platform in other case": ("10:00", "11:00", {"platform": "Android_Phone"}, None), "a platform named like the sentinel": ("10:00", "11:00", {"platform": "*"}, lambda r: r[3] == "*"),
    "real platform": ("10:00", "11:00", {"platform": "ANDROID_PHONE"}, lambda r: r[3] == "ANDROID_PHONE"), "total beside a real sentinel": ("10:00", "11:00", {}, lambda r: True), "a content numbered like the sentinel": ("10:00", "11:00", {"content_id": -1}, lambda r: r[2] == -1),
    "unknown content": ("10:00", "11:00", {"content_id": 777}, None), "no activity": ("12:00", "14:00", {}, lambda r: True), "before all": ("00:00", "00:30", {}, lambda r: True), "after all": ("+22:00", "+23:00", {}, lambda r: True),
    "one minute": ("10:30", "10:31", {}, lambda r: True), "ragged": ("10:17", "11:31", {}, lambda r: True), "within minutes": ("10:17:30", "10:44:30", {}, lambda r: True), "half a minute": ("10:30", "10:30:30", {}, lambda r: True),
    "on hours": ("19:00", "20:00", {}, lambda r: True), "two days": ("00:00", "+23:59:59", {}, lambda r: True), "with an idle hour": ("10:00", "12:00", {}, lambda r: True),
}


@pytest.mark.parametrize("name", RANGES)
def test_ranges(tiers, name):
    a, b, filters, keep = RANGES[name]
    got = R.window_range(tiers.deltas, tiers.hours, sec(a), sec(b), known_only=True, **filters)
    assert whole(got) == ([] if keep is None else [truth(sec(a), sec(b), keep)])
    if keep is None:
        assert whole(R.window_range(tiers.deltas, tiers.hours, sec(a), sec(b), **filters)) == [(0, 0, 0)]


def test_numbers_by_hand(tiers):
    total = lambda a, b, **k: R.window_range(tiers.deltas, tiers.hours, sec(a), sec(b), **k).first()
    r = total("10:00", "11:00")
    assert (r.peak, r.integral) == (8, 12_180) and total("10:00", "11:00", platform="*").peak == 1
    assert (total("10:00", "11:00", content_id=-1).peak, total("10:00", "11:00", content_id=-1).integral) == (1, 2340)
    assert round(total("10:00", "12:00").avg_concurrent, 2) == 1.69 and total("10:30", "10:30:30").integral == 240
    for a, b in (("11:00", "10:00"), ("10:30", "10:30")):
        with pytest.raises(ValueError):
            total(a, b)


def test_hours_and_days(tiers):
    hours = {r.hour: r for r in R.hour_view(tiers.hours, 0).collect()}
    days = {r.day: r for r in R.day_view(tiers.hours, 0).collect()}
    first = [h for h in hours if h < DAY + 86_400]
    assert len(first) == 11 and set(days) == {DAY, DAY + 86_400} and not [h for h in hours if h >= DAY + 4 * 86_400]
    d = days[DAY]
    assert (d.peak, d.peak_minute, d.integral, round(d.avg_concurrent, 4)) == (8, sec("10:30"), 33_000, 0.3819)
    assert (days[DAY + 86_400].peak, days[DAY + 86_400].integral) == (1, 1860)
    at = lambda h: (hours[sec(h)].peak, hours[sec(h)].integral)
    assert (hours[sec("20:00")].peak, hours[sec("20:00")].peak_minute, hours[sec("20:00")].integral) == (1, sec("20:00"), 120)  # of 20:00 and 20:59 the earliest
    assert sec("12:00") not in hours and at("17:00") == (1, 3600) and at("14:00") == (2, 4560) and at("15:00") == (1, 1800)


def test_top_contents_are_unique_and_orphans_named(tiers):
    rows = C.with_content(R.hour_view(tiers.hours.where(F.col("hour") == sec("10:00")), R.CONTENT), tiers.catalog).collect()
    titles = {r.content_id: r.title for r in rows}
    assert len(rows) == len(titles) == 4 and titles[999] == "(unknown)" and titles[-1] == "Minus One Asset"


@pytest.mark.parametrize(("start", "platform"), [("10:00", None), ("10:30", None), ("12:00", None), ("10:00", "android_phone"), ("10:00", "NOKIA_9000")])
def test_curves(tiers, start, platform):
    rows = tiers.deltas if platform is None else tiers.deltas.where(F.col("platform") == platform)
    got = {r.minute: r.concurrent for r in M.dense_curve(rows, sec(start), sec(start) + 3600).collect()}
    keep = lambda r: platform is None or r[3] == platform
    assert got == {m: truth(m, m + 60, keep)[0] for m in range(sec(start), sec(start) + 3600, 60)}


@pytest.mark.parametrize(("kind", "contents"), [("live", (101, -1)), ("vod", (102, 103)), ("stream", None), ("LIVE", None), ("", ())])
def test_video_types(tiers, kind, contents):
    got = whole(C.attribute_range(tiers.deltas, tiers.catalog, "video_type", kind, DAY, DAY + 86_400))
    assert got == ([] if contents is None else [truth(DAY, DAY + 86_400, lambda r: r[2] in contents and (kind != "vod" or r[2] == 102))])


PLATFORMS = sorted({r[3] for r in INTERVALS})


@pytest.mark.parametrize("chosen", [["ANDROID_PHONE", "IOS_PHONE"], ["ANDROID_PHONE", "ANDROID_PHONE"], [], ["WEB_TV_RARE"], ["ANDROID_PHONE", "NOKIA_9000"], [*PLATFORMS, *[f"FAKE_{k}" for k in range(490)]]])
def test_lists_of_platforms(tiers, chosen):
    rows = M.within(tiers.deltas, "minute", DAY, DAY + 86_400).where(F.col("platform").isin(*chosen))
    assert whole(R.peak_and_average(M.held_curve(rows), 86_400)) == [truth(DAY, DAY + 86_400, lambda r: r[3] in chosen)]


def test_spellings_of_a_language(tiers):
    peak = lambda condition: M.held_curve(tiers.deltas.where(condition)).agg(F.coalesce(F.max("concurrent"), F.lit(0))).first()[0]
    assert peak(F.col("audio_language") == "hin") == 2
    assert peak(norm_lang(F.col("audio_language")) == norm_lang(F.lit("HIN"))) == 4
    assert peak(norm_lang(F.col("audio_language")) == norm_lang(F.lit("हिन्दी"))) == 1
    with pytest.raises(Exception, match="(?i)audio_language"):
        tiers.hours.where("audio_language = 'hin'").count()


def test_users_and_platforms_at_the_peak(tiers):
    users = M.user_minutes(tiers.intervals).where(F.col("minute") == sec("10:30"))
    assert users.agg(F.countDistinct("user_id")).first()[0] == 7
    tops = {r.platform: r.peak for r in R.hour_view(tiers.hours.where(F.col("hour") == sec("10:00")), R.PLATFORM).collect()}
    assert tops == {"ANDROID_PHONE": 4, "IOS_PHONE": 2, "WEB": 1, "*": 1, "android_phone": 1}
