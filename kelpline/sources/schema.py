"""Column contracts of the event and catalog tables, and the comparison of a header with them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

EVENT_COLUMNS = (
    "content_id", "video_session_id", "user_id", "event_type", "event", "event_timestamp", "platform",
    "app_version", "country", "audio_language", "subtitle_language", "player_version", "session_start_epoch",
)
EVENT_REQUIRED = ("event_timestamp", "video_session_id")
CONTENT_COLUMNS = ("content_id", "title", "video_type", "category")
CONTENT_REQUIRED = ("content_id",)
#: Filter dimensions of the minute tier, and those of the hour and user tiers.
DIMS = ("platform", "country", "content_id", "subtitle_language", "player_version", "audio_language", "app_version")
KEYS = ("platform", "country", "content_id")

# The event names that players send, by event type.
VOCABULARY: dict[str, tuple[str, ...]] = {
    "AppBackgrounded": ("AppBackgrounded",),
    "AppForegrounded": ("AppForegrounded",),
    "VideoError": ("VideoError",),
    "VideoHeartbeat": (
        "network-activity", "buffer-health", "video-resize", "BufferStart", "BufferEnd", "video_forward", "Seek", "resume", "network-bandwidth", "pause",
        "upshift", "dropped-frames", "downshift", "video_rewind", "AdSkipTrueView", "network-change", "download_asset_played", "next_video_click",
        "go_live_click", "download_initiated", "speed-change", "golive", "speed-pause", "speed-resume", "download_completed", "audio-language",
        "preroll-disabled", "video_quality_change", "subtitle-language", "AdBufferStart", "AdBufferEnd", "AdPause", "AdResume", "preview_watched",
        "download_deleted", "download_asset_play_stop", "chromecast_clicked", "chromecast_started", "download_resumed", "AdClick",
        "premium_button_click",
    ),
    "VideoPlay": ("Play",),
    "VideoSessionEnd": ("VideoSessionEnd",),
    "VideoSessionStart": ("VideoSessionStart",),
}

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


class HeaderError(ValueError):
    """A file's header that can't be loaded as it is."""


@dataclass(frozen=True)
class HeaderPlan:
    present: tuple[str, ...]
    missing: tuple[str, ...]
    extra: tuple[str, ...]


def plan_header(header: list[str], columns: tuple[str, ...], required: tuple[str, ...], acknowledged: tuple[str, ...] = ()) -> HeaderPlan:
    """Which contract columns a header has, lacks and adds.

    Order is free. New columns go to the map of extras. Missing ones are refused unless acknowledged, and
    required ones always; so are names that occur twice or are no identifiers.
    """
    names = [h.lstrip("﻿").strip() for h in header]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise HeaderError(f"columns occur twice: {', '.join(twice)}")
    if odd := [n for n in names if not _NAME.match(n)]:
        raise HeaderError(f"not a column name: {odd}")
    missing = tuple(c for c in columns if c not in names)
    if lost := [c for c in missing if c in required]:
        raise HeaderError(f"required columns are missing: {', '.join(lost)}")
    if lost := [c for c in missing if c not in acknowledged]:
        raise HeaderError(f"missing columns must be acknowledged: {', '.join(lost)}")
    return HeaderPlan(tuple(c for c in columns if c in names), missing, tuple(n for n in names if n not in columns))


def landing_schema(header: list[str]) -> T.StructType:
    return T.StructType([T.StructField(h.lstrip("﻿").strip(), T.StringType()) for h in header])
