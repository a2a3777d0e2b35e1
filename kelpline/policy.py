"""The model's tunables, declared once and named in results by a digest."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Policy:
    """gap_s: a longer silence ends a run. tail_s: grace after a run's last event. unclosed_pause_to_run_end: a pause
    that no resume follows lasts to the run's end, else to the next event. point_activity_counts: segments
    of no length count.

    For evaluation: ``liveness`` says which events make runs (``all``, ``no_background``: all but AppBackgrounded and
    AppForegrounded, ``playback``: heartbeats and plays). ``background`` says whether AppBackgrounded takes time away until the next
    AppForegrounded, and until when if none follows: ``ignored``, ``run_end``, ``next_event`` of the run or
    ``next_heartbeat``. ``background_carries``: a run that begins in the background is paused until the next AppForegrounded.
    ``background_caps_tail``: no grace beyond the next AppBackgrounded. The rest bounds how late the incremental path looks back."""

    gap_s: int = 150
    tail_s: int = 60
    unclosed_pause_to_run_end: bool = True
    point_activity_counts: bool = False
    liveness: str = "all"
    background: str = "ignored"
    background_carries: bool = False
    background_caps_tail: bool = False
    settle_s: int = 5
    lookback_s: int = 900
    minute_cover_s: int = 240
    hour_cover_s: int = 7200
    queue_ttl_days: int = 7
    version: int = 1

    def __post_init__(self) -> None:
        if self.gap_s <= 0 or self.tail_s < 0:
            raise ValueError("gap_s must be positive and tail_s not negative")
        if self.minute_cover_s < min(self.tail_s, 180) + 60 or self.hour_cover_s < self.minute_cover_s:
            raise ValueError("covers must be wider than the tail by a minute")
        if self.liveness not in ("all", "no_background", "playback") or self.background not in ("ignored", "run_end", "next_event", "next_heartbeat"):
            raise ValueError("unknown liveness or background")
        if self.background == "ignored" and (self.background_carries or self.background_caps_tail):
            raise ValueError("background is ignored: it can neither carry nor cap")

    @property
    def digest(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()[:16]

    @property
    def final_after_s(self) -> int:
        """Seconds behind the watermark after which a minute can't change but by late events."""
        return self.gap_s + self.tail_s

    def frame(self, spark: SparkSession) -> DataFrame:
        """The policy as one row."""
        row = {k: v if isinstance(v, str) else int(v) for k, v in asdict(self).items()} | {"policy_hash": self.digest}
        return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'string' if isinstance(v, str) else 'long'}" for k, v in row.items()))


#: The state machines that were weighed against the default one, by what they do about the background.
VARIANTS: dict[str, Policy] = {
    "default": Policy(),
    "background_to_run_end": Policy(background="run_end", background_caps_tail=True),
    "background_to_next_event": Policy(background="next_event", background_caps_tail=True),
    "background_to_next_heartbeat": Policy(background="next_heartbeat", background_caps_tail=True),
    "background_carried": Policy(background="run_end", background_carries=True, background_caps_tail=True),
    "background_carried_full_tail": Policy(background="run_end", background_carries=True),
    "background_no_liveness": Policy(liveness="no_background", background="run_end", background_carries=True, background_caps_tail=True),
    "explicit_only": Policy(gap_s=10**9, background="run_end", background_carries=True, background_caps_tail=True),
    "permissive_pause": Policy(unclosed_pause_to_run_end=False),
}
