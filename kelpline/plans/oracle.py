"""The same results as SQL over the raw events, minute by minute and written another way than the tiers."""

from __future__ import annotations

from kelpline.policy import Policy

_MODE_COLUMNS = ("user_id", "platform", "country", "app_version", "audio_language", "subtitle_language", "player_version")


def base(policy: Policy) -> str:
    """Common table expressions: ev, cat, iv (intervals), mr (merged runs), mins (session, minute), delta, um (user minutes)."""
    votes = " UNION ALL ".join(f"SELECT sid, a, b, '{c}' AS col, {c} AS val FROM voters" for c in _MODE_COLUMNS)
    votes += " UNION ALL SELECT sid, a, b, 'content_id', lpad(CAST(content_id AS VARCHAR), 20, '0') FROM voters"
    picked = ", ".join(f"max(val) FILTER (WHERE col = '{c}') AS {c}" for c in _MODE_COLUMNS)
    return f"""
WITH raw AS (
  SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS ts_s, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events
), ev AS (
  SELECT event_id, k % 20 + 1 + CASE WHEN k % 20 < 18 THEN user_id % 5 * 20 ELSE 1000000000 END AS content_id, 's' || user_id AS sid, 'u' || (user_id // 2) AS user_id, ts_s,
    CASE WHEN event_type = 'error' AND k < 20 THEN 'VideoSessionEnd' WHEN event_type = 'error' AND k < 45 THEN 'AppBackgrounded' WHEN event_type = 'error' AND k < 70 THEN 'AppForegrounded' WHEN event_type = 'error' THEN 'VideoError'
         WHEN event_type IN ('purchase', 'signup') THEN 'VideoPlay' ELSE 'VideoHeartbeat' END AS event_type,
    CASE WHEN event_type = 'purchase' THEN 'pause' WHEN event_type = 'signup' THEN 'resume' WHEN event_type = 'error' AND k >= 20 AND k < 45 THEN 'AppBackgrounded' WHEN event_type = 'error' AND k >= 45 AND k < 70 THEN 'AppForegrounded' ELSE 'beat' END AS event,
    'p' || (k % 4) AS platform, '5.0.' || (k % 3) || '.00' AS app_version, 'c' || (user_id % 3) AS country,
    ['hin', 'HIN', 'hin-Hindi', 'eng', 'OFF'][k % 5 + 1] AS audio_language, ['eng', 'none'][k % 2 + 1] AS subtitle_language,
    ['pv1', 'PV1', 'pv2'][k % 3 + 1] AS player_version, CASE WHEN k % 3 <> 0 THEN ['720p', '1080p', '480p', ''][k % 4 + 1] END AS video_resolution, ts_s - k AS session_start_s
  FROM raw
), cat AS (
  SELECT p_partkey AS content_id, 'title ' || (p_partkey % 7) AS title, CASE WHEN p_partkey % 6 = 0 THEN '' WHEN p_partkey % 2 = 0 THEN 'live' ELSE 'vod' END AS video_type,
    'cat' || (p_partkey % 3) AS category, 'show' || (p_partkey % 4) AS show_name FROM part
), runs0 AS (
  SELECT *, sum(fresh) OVER (PARTITION BY sid ORDER BY ts_s, event_id) AS run FROM (
    SELECT *, CASE WHEN ts_s - lag(ts_s) OVER (PARTITION BY sid ORDER BY ts_s, event_id) > {policy.gap_s} THEN 1 ELSE 0 END AS fresh FROM ev)
), runs AS (SELECT sid, run, min(ts_s) AS rs, max(ts_s) AS re FROM runs0 GROUP BY sid, run
), pauses AS (SELECT DISTINCT r.sid, r.run, r.rs, r.re, e.ts_s AS p FROM runs0 e JOIN runs r ON e.sid = r.sid AND e.run = r.run WHERE e.event = 'pause' AND e.ts_s < r.re
), ended AS (
  SELECT p.sid, p.run, p.rs, p.re, p.p, min(e.ts_s) AS r FROM pauses p LEFT JOIN ev e ON e.sid = p.sid AND e.event = 'resume' AND e.ts_s >= p.p GROUP BY p.sid, p.run, p.rs, p.re, p.p
), wins AS (SELECT * FROM (SELECT sid, run, rs, re, p, CASE WHEN r <= re THEN r ELSE re + 1 END AS e FROM ended) WHERE e > p
), isl0 AS (SELECT *, CASE WHEN p > max(e) OVER (PARTITION BY sid, run ORDER BY p, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS n FROM wins
), isl1 AS (SELECT *, sum(n) OVER (PARTITION BY sid, run ORDER BY p, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS i FROM isl0
), isl AS (SELECT sid, run, i, min(p) AS p, max(e) AS e FROM isl1 GROUP BY sid, run, i
), seg0 AS (
  SELECT r.sid, r.run, r.re, r.rs AS a, coalesce((SELECT min(p) FROM isl i WHERE i.sid = r.sid AND i.run = r.run), r.re) AS b FROM runs r
  UNION ALL
  SELECT i.sid, i.run, r.re, i.e, coalesce(lead(i.p) OVER (PARTITION BY i.sid, i.run ORDER BY i.p), r.re) FROM isl i JOIN runs r ON i.sid = r.sid AND i.run = r.run
), seg AS (SELECT sid, run, a, b, b + CASE WHEN b = re THEN {policy.tail_s} ELSE 0 END AS e FROM seg0 WHERE b > a
), voters AS (SELECT s.a, s.b, v.* FROM seg s JOIN runs0 v ON v.sid = s.sid AND v.run = s.run AND v.ts_s BETWEEN s.a AND s.b
), ballots AS (SELECT sid, a, b, col, val, row_number() OVER (PARTITION BY sid, a, b, col ORDER BY count(*) DESC, val) AS rk FROM ({votes}) GROUP BY sid, a, b, col, val
), res0 AS (SELECT sid, a, b, video_resolution AS val, count(*) AS n, sum(count(*)) OVER (PARTITION BY sid, a, b) AS total FROM voters GROUP BY sid, a, b, video_resolution
), res AS (
  SELECT sid, a, b, arg_min(val, (-n, val)) AS video_resolution FROM res0 r WHERE val IS NOT NULL
  GROUP BY sid, a, b, total HAVING max(n) >= total - sum(n)
), iv AS (
  SELECT s.sid, s.a AS start_s, s.e AS end_s, x.* EXCLUDE (sid, a, b), r.video_resolution,
    NOT EXISTS (SELECT 1 FROM ev WHERE ev.sid = s.sid AND ev.event_type = 'VideoSessionEnd') AS is_open
  FROM seg s JOIN (SELECT sid, a, b, {picked}, CAST(max(val) FILTER (WHERE col = 'content_id') AS BIGINT) AS content_id FROM ballots WHERE rk = 1 GROUP BY sid, a, b) x ON x.sid = s.sid AND x.a = s.a AND x.b = s.b
  LEFT JOIN res r ON r.sid = s.sid AND r.a = s.a AND r.b = s.b
), im AS (SELECT *, start_s // 60 * 60 AS sm, end_s // 60 * 60 AS em FROM iv
), mr0 AS (SELECT *, CASE WHEN sm <= 60 + max(em) OVER (PARTITION BY sid ORDER BY sm, em, app_version, audio_language, subtitle_language, player_version, platform, country, content_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM im
), mr1 AS (SELECT *, sum(n) OVER (PARTITION BY sid ORDER BY sm, em, app_version, audio_language, subtitle_language, player_version, platform, country, content_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM mr0
), mr AS (
  SELECT sid, min(sm) AS sm, max(em) AS em, max(app_version) FILTER (WHERE n = 1) AS app_version, max(audio_language) FILTER (WHERE n = 1) AS audio_language, max(subtitle_language) FILTER (WHERE n = 1) AS subtitle_language,
    max(player_version) FILTER (WHERE n = 1) AS player_version, max(platform) FILTER (WHERE n = 1) AS platform, max(country) FILTER (WHERE n = 1) AS country, max(content_id) FILTER (WHERE n = 1) AS content_id
  FROM mr1 GROUP BY sid, g
), mins AS (SELECT sid, unnest(range(sm, em + 60, 60)) AS minute, * EXCLUDE (sid, sm, em) FROM mr
), pieces AS (SELECT *, unnest(range(sm // 3600 * 3600, em // 3600 * 3600 + 1, 3600)) AS h FROM mr
), changes AS (
  SELECT greatest(sm, h) AS minute, 1 AS d, * EXCLUDE (sid, sm, em, h) FROM pieces
  UNION ALL SELECT em + 60, -1, * EXCLUDE (sid, sm, em, h) FROM pieces WHERE em + 60 < h + 3600
), delta AS (
  SELECT minute, platform, country, content_id, subtitle_language, player_version, audio_language, app_version,
    CAST(sum(d) AS BIGINT) AS delta, count(*) FILTER (WHERE d > 0) AS starts, count(*) FILTER (WHERE d < 0) AS ends
  FROM changes GROUP BY ALL
), ur0 AS (SELECT *, CASE WHEN sm <= 60 + max(em) OVER (PARTITION BY sid, user_id ORDER BY sm, em, app_version, audio_language, subtitle_language, player_version, platform, country, content_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM im
), ur1 AS (SELECT *, sum(n) OVER (PARTITION BY sid, user_id ORDER BY sm, em, app_version, audio_language, subtitle_language, player_version, platform, country, content_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM ur0
), ur AS (
  SELECT sid, user_id, min(sm) AS sm, max(em) AS em, max(platform) FILTER (WHERE n = 1) AS platform, max(country) FILTER (WHERE n = 1) AS country, max(content_id) FILTER (WHERE n = 1) AS content_id FROM ur1 GROUP BY sid, user_id, g
), um AS (SELECT DISTINCT unnest(range(sm, em + 60, 60)) AS minute, platform, country, content_id, user_id FROM ur
), cmins AS (
  SELECT m.*, CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.title END AS title,
    CASE WHEN c.content_id IS NULL THEN '(unknown)' WHEN c.video_type = '' THEN '(blank)' ELSE c.video_type END AS video_type,
    CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.category END AS category, CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.show_name END AS show_name
  FROM mins m LEFT JOIN cat c ON c.content_id = m.content_id
), drill0 AS (
  SELECT *, row_number() OVER (PARTITION BY sid, minute ORDER BY start_s DESC) AS rk FROM (SELECT *, unnest(range(sm, em + 60, 60)) AS minute FROM im)
), drill AS (
  SELECT d.minute, d.sid AS video_session_id, d.user_id, d.platform, d.country, d.content_id, d.app_version, d.audio_language, d.subtitle_language, d.player_version,
    coalesce(d.video_resolution, '') AS video_resolution, d.video_resolution AS extra_resolution,
    CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.title END AS title,
    CASE WHEN c.content_id IS NULL THEN '(unknown)' WHEN c.video_type = '' THEN '(blank)' ELSE c.video_type END AS video_type,
    CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.category END AS category, CASE WHEN c.content_id IS NULL THEN '(unknown)' ELSE c.show_name END AS show_name
  FROM drill0 d LEFT JOIN cat c ON c.content_id = d.content_id WHERE rk = 1
)
"""


def by_minute(by: str = "", source: str = "mins", where: str = "true", count: str = "count(*)") -> str:
    """Levels minute by minute: (by, minute, c)."""
    keys = f"{by}, " if by else ""
    return f"(SELECT {keys}minute, {count} AS c FROM {source} WHERE {where} GROUP BY ALL)"


def peak(start: int, end: int, levels: str, by: str = "", seconds: int | None = None) -> str:
    """Peak, earliest minute of it, integral and average of levels clipped to [start, end)."""
    keys = f"{by}, " if by else ""
    clipped = f"(SELECT *, greatest(minute, {start}) AS a, least(minute + 60, {end}) AS b FROM {levels} WHERE minute + 60 > {start} AND minute < {end})"
    return f"""SELECT {keys}CAST(coalesce(max(c), 0) AS BIGINT) AS peak, CAST(coalesce(arg_min(a, (-c, a)), 0) AS BIGINT) AS peak_minute, CAST(coalesce(sum(c * (b - a)), 0) AS BIGINT) AS integral,
  CAST(coalesce(sum(c * (b - a)), 0) AS DOUBLE) / {seconds or end - start} AS avg_concurrent FROM {clipped}""" + (f" GROUP BY {by}" if by else "")
