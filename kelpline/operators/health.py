"""Freshness, drift, quarantine and contract reports, decline detection and model comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.functions import normalise as n
from kelpline.operators.minutes import change_curve, expanded, minute, naive_curve, stateless_curve
from kelpline.policy import Policy
from kelpline.sources.schema import VOCABULARY


def watermark(events: DataFrame, deltas: DataFrame, hours: DataFrame) -> DataFrame:
    """How far the raw events, the minute tier and the hour tier reach, and through which hour results are final."""
    raw = events.agg(F.max("ts_s").alias("raw_watermark"))
    sealed = deltas.agg(F.max("minute").alias("sealed_watermark"))
    last = hours.agg(F.max("hour").alias("hour_tier_last_hour"))
    rows = raw.crossJoin(sealed).crossJoin(last)  # one row each
    complete = F.col("raw_watermark") >= F.col("hour_tier_last_hour") + 3600
    return rows.select("raw_watermark", "sealed_watermark", (F.col("raw_watermark") - F.col("sealed_watermark")).alias("sealed_lag_s"), "hour_tier_last_hour", F.when(complete, F.col("hour_tier_last_hour") + 3600).otherwise(F.col("hour_tier_last_hour")).alias("hour_final_through"), complete.alias("hour_tier_last_hour_complete"), F.col("sealed_watermark").alias("trend_watermark"))


def with_finality(curve: DataFrame, watermark_s: int, policy: Policy, allowed_lateness_s: int = 0) -> DataFrame:
    """A curve with is_final: minutes that only late events can still change."""
    return curve.withColumn("is_final", F.col("minute") <= watermark_s - policy.final_after_s - allowed_lateness_s)


def normalised_deltas(deltas: DataFrame) -> DataFrame:
    forms = {"platform_norm": n.norm_case(F.col("platform")), "country_norm": n.norm_case(F.col("country")), "audio_language_norm": n.norm_lang(F.col("audio_language")), "subtitle_language_norm": n.norm_lang(F.col("subtitle_language")), "player_version_norm": n.norm_version(F.col("player_version")), "app_version_norm": n.norm_app_version(F.col("app_version")), "audio_class": n.lang_class(F.col("audio_language")), "subtitle_class": n.lang_class(F.col("subtitle_language"))}
    return deltas.withColumns(forms)


def audio_curve(deltas: DataFrame) -> DataFrame:
    return change_curve(normalised_deltas(deltas), ["audio_language_norm", "audio_class"])


_DRIFT = {"audio_language": n.norm_lang, "subtitle_language": n.norm_lang, "player_version": n.norm_version, "app_version": n.norm_app_version, "platform": n.norm_case, "country": n.norm_case}


def drift(events: DataFrame) -> DataFrame:
    """Normalised values that are written in more than one way: one scan, each row fanned out to its six dimensions."""
    parts = [F.struct(F.lit(d).alias("dimension"), f(F.col(d)).alias("normalised"), (n.lang_class(F.col(d)) if d.endswith("language") else F.lit("n/a")).alias("class"), F.col(d).alias("raw")) for d, f in _DRIFT.items()]
    rows = events.select(F.explode(F.array(*parts)).alias("x")).select("x.*")
    groups = rows.groupBy("dimension", "normalised", "class").agg(F.countDistinct("raw").alias("variants"), F.array_sort(F.collect_set("raw")).alias("raw_values"), F.count(F.lit(1)).alias("rows"))
    return groups.where("variants > 1")


def drift_summary(events: DataFrame) -> DataFrame:
    return drift(events).groupBy("dimension").agg(F.count(F.lit(1)).alias("groups_with_variants"), F.sum("variants").alias("raw_values_involved"), F.sum("rows").alias("rows_in_split_groups"))


def model_input(events: DataFrame) -> DataFrame:
    """Events that can be modelled."""
    return events.where(n.q_reason(F.col("video_session_id"), F.col("user_id"), F.col("ts_s")) == "")


def quarantine(events: DataFrame) -> DataFrame:
    """Events that can't, equal ones once with ``copies``, their reason and a hash that names them."""
    columns = [c for c in events.columns if c != "extra"]
    bad = events.withColumn("reason", n.q_reason(F.col("video_session_id"), F.col("user_id"), F.col("ts_s"))).where("reason <> ''")
    bad = bad.withColumn("extra_json", F.to_json(F.array_sort(F.map_entries("extra")))) if "extra" in events.columns else bad.withColumn("extra_json", F.lit("[]"))
    rows = bad.groupBy("reason", *columns, "extra_json").agg(F.count(F.lit(1)).alias("copies"))
    return rows.withColumn("src_hash", F.xxhash64(*columns, "extra_json"))


def quarantine_summary(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy("reason").agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"), F.countDistinct("video_session_id").alias("sessions"), F.min("ts_s").alias("first_seen"), F.max("ts_s").alias("last_seen"), F.slice(F.array_sort(F.collect_set("video_session_id")), 1, 5).alias("sample_sessions"))


def _flags(events: DataFrame) -> Column:
    dims = ("platform", "country", "audio_language", "subtitle_language", "app_version", "player_version", "event_type", "event")
    valid = reduce(lambda a, b: a & b, [n.valid_utf8(F.col(d)) for d in dims])
    start = F.col("session_start_s") if "session_start_s" in events.columns else F.lit(None).cast("long")
    return n.q_flags(F.col("video_session_id"), F.col("user_id"), F.col("ts_s"), start, F.col("content_id"), valid)


def flag_counts(events: DataFrame) -> DataFrame:
    """Rows and sessions by oddity, among the events that are modelled."""
    rows = model_input(events).withColumn("flag", F.explode(_flags(events)))
    return rows.groupBy("flag").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("video_session_id").alias("sessions"), F.min("ts_s").alias("first_seen"), F.max("ts_s").alias("last_seen"))


def preprocess_summary(events: DataFrame) -> DataFrame:
    reason = n.q_reason(F.col("video_session_id"), F.col("user_id"), F.col("ts_s"))
    counts = events.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(reason != "").alias("quarantined_rows"), F.count_if(reason == "").alias("model_input_rows"))
    return counts.crossJoin(flag_counts(events).agg(F.count(F.lit(1)).alias("flag_classes_present")))  # one row each


#: Probes of the source in order, with their severity.
PROBES = (
    ("source_empty", "FAIL"), ("time_out_of_range", "FAIL"), ("session_start_zero", "FAIL"), ("identity_empty", "FAIL"), ("event_type_unknown", "FAIL"), ("columns_missing", "FAIL"),
    ("columns_extra", "WARN"), ("event_unknown", "WARN"), ("session_id_reused", "WARN"), ("events_before_session_start", "WARN"), ("events_in_future", "WARN"), ("end_before_start", "WARN"),
    ("several_ends", "WARN"), ("dimensions_tied", "WARN"), ("duplicate_rows", "WARN"), ("content_id_sentinel", "WARN"), ("key_sentinel", "WARN"), ("content_without_catalog", "WARN"),
    ("catalog_conflicts", "WARN"), ("dimensions_empty", "WARN"), ("rows", "INFO"), ("sessions", "INFO"), ("span_minutes", "INFO"), ("event_types", "INFO"), ("contents", "INFO"),
)
_CONTRACT = ("content_id", "video_session_id", "user_id", "event_type", "event", "ts_s", "platform", "app_version", "country", "audio_language", "subtitle_language", "player_version", "session_start_s")
#: Event times in 2020 to 2035.
_FIRST_S, _PAST_S = 1_577_836_800, 2_082_758_400


def contract_report(events: DataFrame, catalog: DataFrame, *, now_s: int | None = None, vocabulary: dict[str, tuple[str, ...]] = VOCABULARY) -> DataFrame:
    """Named probes of the source: (probe, severity, value, note, verdict). A FAIL probe with a value above zero fails; WARN ones warn, INFO never does.

    Columns that ``events`` lacks are told by ``columns_missing`` and count for nothing elsewhere. ``now_s`` is the time
    that events in the future are told by, the current one if not given. Nulls count as empty or absent values.
    """
    missing = [c for c in _CONTRACT if c not in events.columns]
    extra = [c for c in events.columns if c not in (*_CONTRACT, "extra")]
    rows = events.withColumns({c: F.lit(None).cast("long" if c in ("content_id", "ts_s", "session_start_s") else "string") for c in missing}) if missing else events
    c, text = F.col, lambda name: F.coalesce(F.col(name), F.lit(""))
    count = lambda x: F.count_if(F.coalesce(x, F.lit(False)))
    now = F.lit(now_s).cast("long") if now_s is not None else F.unix_timestamp(F.current_timestamp())
    kind = text("event_type")
    known = reduce(lambda a, b: a | b, [(kind == t) & text("event").isin(*names) for t, names in vocabulary.items()], F.lit(False))
    typed = kind.isin(*vocabulary)
    dims = ("platform", "country", "app_version", "audio_language", "subtitle_language", "player_version", "event")
    given = lambda name: name not in missing
    none = F.lit(0)
    one = rows.agg(
        F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) == 0).cast("long").alias("source_empty"), count(~((c("ts_s") >= _FIRST_S) & (c("ts_s") < _PAST_S)) | c("ts_s").isNull()).alias("time_out_of_range"),
        count(c("session_start_s") == 0).alias("session_start_zero"), count((text("video_session_id") == "") | (text("user_id") == "")).alias("identity_empty"), count(~typed).alias("event_type_unknown"),
        count(typed & ~known).alias("event_unknown"), count(c("ts_s") > now + 300).alias("events_in_future"), count(c("content_id") == -1).alias("content_id_sentinel"),
        count((c("platform") == "*") | (c("country") == "*")).alias("key_sentinel"), F.countDistinct("video_session_id").alias("sessions"), F.countDistinct("event_type").alias("event_types"), F.countDistinct("content_id").alias("contents"),
        F.coalesce(F.floor(F.max("ts_s") / 60) - F.floor(F.min("ts_s") / 60), none).alias("span_minutes"), F.lit(len(missing)).alias("columns_missing"), F.lit(len(extra)).alias("columns_extra"),
        F.array_join(F.array(*[F.when((F.count(F.lit(1)) > 0) & (count(text(d) == "") == F.count(F.lit(1))), d) for d in dims if given(d)]), ", ").alias("_empty"),
        F.countDistinct("user_id").alias("_users"), F.min("ts_s").alias("_from"), F.max("ts_s").alias("_to"), F.countDistinct("platform").alias("_platforms"), F.countDistinct("country").alias("_countries"),
    )
    at = lambda name: F.min(F.when(kind == name, c("ts_s")))
    shape = rows.groupBy("video_session_id").agg(F.min("ts_s").alias("t"), F.min("session_start_s").alias("s"), F.countDistinct("session_start_s").alias("n"), at("VideoSessionStart").alias("a"), at("VideoSessionEnd").alias("b"), F.count_if(kind == "VideoSessionEnd").alias("ends"))
    shape = shape.agg(count(c("n") > 1).alias("session_id_reused"), count(c("t") < c("s")).alias("events_before_session_start"), count(c("b") < c("a")).alias("end_before_start"), count(c("ends") > 1).alias("several_ends"))
    tied = rows.groupBy("video_session_id", "ts_s").agg(*[F.countDistinct(d).alias(d) for d in ("platform", "country", "content_id")])
    tied = tied.agg(count((c("platform") > 1) | (c("country") > 1) | (c("content_id") > 1)).alias("dimensions_tied"), F.count(F.lit(1)).alias("_groups"))
    twice = rows.groupBy(*_CONTRACT).count().agg(F.coalesce(F.sum(c("count") - 1), none).alias("duplicate_rows"))
    lost = rows.join(catalog.select("content_id").distinct(), "content_id", "left_anti").agg(F.countDistinct("content_id").alias("content_without_catalog"))
    clash = catalog.groupBy("content_id").agg(F.countDistinct(F.struct("title", "video_type", "category")).alias("n")).agg(count(c("n") > 1).alias("catalog_conflicts"))
    kinds = rows.groupBy(kind.alias("k")).count().agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-c("count")).alias("n"), "k"))), lambda x: F.concat_ws(":", x["k"], (-x["n"]).cast("string"))), " ").alias("_kinds"))
    all_ = reduce(lambda a, b: a.crossJoin(b), [shape, tied, twice, lost, clash, kinds], one)  # one row each
    all_ = all_.withColumn("dimensions_empty", F.when(c("_empty") == "", 0).otherwise(F.size(F.split("_empty", ", "))))
    span = F.concat_ws(" to ", c("_from").cast("string"), c("_to").cast("string"))
    notes = {
        "time_out_of_range": span, "columns_missing": F.lit(", ".join(missing)), "columns_extra": F.lit(", ".join(extra)), "dimensions_tied": F.concat(F.round(c("dimensions_tied") * 100 / F.greatest(c("_groups"), F.lit(1)), 4).cast("string"), F.lit("% of groups")),
        "dimensions_empty": c("_empty"), "sessions": F.concat(c("_users").cast("string"), F.lit(" users")), "span_minutes": span, "event_types": c("_kinds"),
        "contents": F.concat(F.lit("platforms "), c("_platforms").cast("string"), F.lit(", countries "), c("_countries").cast("string")),
    }
    each = F.array(*[F.struct(F.lit(p).alias("probe"), F.lit(s).alias("severity"), c(p).cast("long").alias("value"), notes.get(p, F.lit("")).alias("note")) for p, s in PROBES])
    said = F.when(c("value") == 0, "OK").when(c("severity") == "FAIL", "FAIL").when(c("severity") == "WARN", "WARN").otherwise("OK")
    return all_.select(F.explode(each).alias("p")).select("p.*").withColumn("verdict", said)


def minute_event_counts(events: DataFrame) -> DataFrame:
    """Session ends and starts, heartbeats, and pauses or backgroundings by minute."""
    kind, name = F.col("event_type"), F.col("event")
    return events.groupBy(minute(F.col("ts_s")).alias("minute")).agg(F.count_if(kind == "VideoSessionEnd").alias("ends"), F.count_if(kind == "VideoSessionStart").alias("starts"), F.count_if(kind == "VideoHeartbeat").alias("hb"), F.count_if((name == "pause") | (kind == "AppBackgrounded")).alias("pausebg"))


def baseline(value: str, first: int = -17, last: int = -3) -> Column:
    """Median of the rows from ``first`` to ``last`` before each, by minute: the value at half of their number, counted from 0."""
    frame = Window.partitionBy("_one").orderBy("minute").rowsBetween(first, last)
    seen = F.array_sort(F.collect_list(value).over(frame))
    return F.coalesce(F.try_element_at(seen, (F.floor(F.size(seen) / 2) + 1).cast("int")), F.lit(0))


def declines(curve: DataFrame, counts: DataFrame, floor: int = 100, drop: float = 0.8, least: int = 50) -> DataFrame:
    """(minute, concurrent, baseline, fired, class): falls of concurrency against the lagged median, and what they look like.

    One row a minute; the frame of seventeen rows runs over the whole curve, which is as long as time, not data.
    """
    rows = curve.join(counts, "minute", "left").na.fill(0, ["ends", "starts", "hb", "pausebg"]).withColumn("_one", F.lit(1))
    rows = rows.withColumn("baseline", baseline("concurrent")).withColumn("_pausebg", baseline("pausebg"))
    before = F.coalesce(F.lag("concurrent").over(Window.partitionBy("_one").orderBy("minute")), F.lit(0))
    rows = rows.withColumn("_lost", F.greatest(before - F.col("concurrent"), F.lit(0)))
    c, b = F.col("concurrent"), F.col("baseline")
    fired = (b >= floor) & (c < drop * b) & (b - c >= least)
    heart = F.col("hb") / F.greatest(c, F.lit(1))
    covered = F.when(F.col("_lost") > 0, F.col("ends") / F.col("_lost")).otherwise(F.lit(0.0))
    kind = F.when((heart < 1.0) & (covered < 0.2), "OUTAGE").when(covered >= 0.7, "ENDING").when((heart >= 2.5) & (F.col("pausebg") >= 1.5 * F.col("_pausebg")), "DISENGAGEMENT").otherwise("UNCLASSIFIED")
    return rows.select("minute", "concurrent", "baseline", fired.alias("fired"), F.when(fired, kind).otherwise("").alias("class"))


def lag_detectors(curve: DataFrame) -> DataFrame:
    """The level five rows ago, the mean of rows -17 to -3 and the median without a lag: the detectors that were not chosen."""
    w = Window.partitionBy("_one").orderBy("minute")
    rows = curve.withColumn("_one", F.lit(1))
    return rows.select("minute", "concurrent", F.coalesce(F.lag("concurrent", 5).over(w), F.lit(0)).alias("five_ago"), F.avg("concurrent").over(w.rowsBetween(-17, -3)).alias("mean_lag3"), baseline("concurrent", -14, 0).alias("median_nolag"), F.coalesce(F.lag("concurrent", 1).over(w), F.lit(0)).alias("previous"))


def day_on_day(curve: DataFrame) -> DataFrame:
    """A curve against itself a day before."""
    old = curve.select((F.col("minute") + 86400).alias("minute"), F.col("concurrent").alias("day_before"))
    return curve.join(old, "minute").select("minute", "concurrent", "day_before", (F.col("concurrent") - F.col("day_before")).alias("change"))


def model_comparison(events: DataFrame, intervals: DataFrame) -> DataFrame:
    """Sessions by minute as modelled, by mere heartbeats, and by whole spans."""
    aware, plain, naive = expanded(intervals), stateless_curve(events), naive_curve(events)
    rows = aware.withColumnRenamed("concurrent", "aware").join(plain.withColumnRenamed("concurrent", "stateless"), "minute", "full_outer").join(naive.withColumnRenamed("concurrent", "naive"), "minute", "full_outer")
    return rows.na.fill(0)


def excluded_hours(events: DataFrame, intervals: DataFrame) -> DataFrame:
    """Watched hours of the model against those of whole spans."""
    watched = intervals.agg((F.coalesce(F.sum(F.col("end_s") - F.col("start_s")), F.lit(0)) / 3600).alias("aware_hours"))
    spans = events.groupBy("video_session_id").agg((F.max("ts_s") - F.min("ts_s")).alias("s")).agg((F.coalesce(F.sum("s"), F.lit(0)) / 3600).alias("naive_hours"))
    return watched.crossJoin(spans).withColumn("excluded_hours", F.col("naive_hours") - F.col("aware_hours"))  # one row each


def users_and_sessions(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Users against sessions by minute: gap and ratio."""
    rows = users.join(sessions, "minute")
    return rows.select("minute", F.col("concurrent").alias("sessions"), F.col("concurrent_users").alias("users"), (F.col("concurrent") - F.col("concurrent_users")).alias("gap"), (F.col("concurrent") / F.col("concurrent_users")).alias("ratio"))
