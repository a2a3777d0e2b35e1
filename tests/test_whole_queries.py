"""The queries without a time bound or choice of probes, on a small fixture against brute force."""

from builders import BASE, SCHEMA, event, table

import __spark_entry__ as entry
from kelpline.plans import model
from kelpline.policy import Policy


def _fixture(spark, monkeypatch, rows):
    events = table(spark, rows)
    catalog = spark.createDataFrame([(1, "one", "", "cat", "show"), (2, "two", "live", "cat", "show")], "content_id long, title string, video_type string, category string, show_name string")
    key = (spark.sparkContext.applicationId, "fixture")
    monkeypatch.setitem(model._MODELS, key, model.Model(events, catalog, Policy(gap_s=150, tail_s=60)))
    return lambda name: entry.queries()[name](spark, "fixture")


def test_all_minutes_of_sessions_far_apart(spark, monkeypatch):
    """Sessions forty days apart: every minute of each from its first event to its last one's tail."""
    starts = [("S1", BASE, 1), ("S2", BASE + 86_400 * 3 + 7, 2), ("S3", BASE + 86_400 * 40, 3)]
    rows = [event(t + 60 * k, session=s, content=c, extra={"video_resolution": "720p"}) for s, t, c in starts for k in range(5)]
    run = _fixture(spark, monkeypatch, rows)
    want = {(m, s) for s, t, _ in starts for m in range(t // 60 * 60, (t + 240 + 60) // 60 * 60 + 1, 60)}
    assert sorted((r.minute, r.video_session_id) for r in run("m13_session_minutes").collect()) == sorted(want)
    got = run("v16_dimension_values").collect()
    assert sorted((r.minute, r.video_session_id, r.dimension_name, r.dimension_value) for r in got) == sorted((m, s, "video_resolution", "720p") for m, s in want)
    shown = {"S1": ("one", "(blank)", "cat", "show"), "S2": ("two", "live", "cat", "show"), "S3": ("(unknown)",) * 4}
    values = sorted((r.minute, r.video_session_id, r.dimension_name, r.dimension_value) for r in run("v16_content_values").collect())
    assert values == sorted((m, s, a, v) for m, s in want for a, v in zip(("title", "video_type", "category", "show_name"), shown[s], strict=True))


def _named(spark, rows):
    """Events with a declared start, and event names of the contract."""
    return spark.createDataFrame([(*r[:-1], s) for r, s in rows], SCHEMA.partition(", extra")[0] + ", session_start_s long")


def test_each_probe_tells_its_own(spark):
    from kelpline.operators.health import PROBES, contract_report

    e = event("10:00:00", "network-activity", kind="VideoHeartbeat")
    names = ("content", "session", "user", "kind", "name", "ts", "platform", "version", "country", "audio", "sub", "player", "extra")
    put = lambda **c: tuple(c.get(k, v) for k, v in zip(names, e, strict=True))
    t = e[5]
    clean = [(put(session=f"C{k}", ts=t + k), t) for k in range(4)]
    catalog = [(1, "one", "vod", "cat", "show")]
    cases = {
        "time_out_of_range": (2, [(put(session="A", ts=5), 1), (put(session="B", ts=None), 1)]), "session_start_zero": (1, [(put(session="A"), 0)]), "identity_empty": (2, [(put(session=""), t), (put(session="A", user=""), t)]),
        "event_type_unknown": (1, [(put(session="A", kind="Other"), t)]), "event_unknown": (1, [(put(session="A", name="new-thing"), t)]), "session_id_reused": (1, [(put(session="C1", ts=t + 50), t + 1)]),
        "events_before_session_start": (1, [(put(session="A"), t + 9)]), "events_in_future": (1, [(put(session="A", ts=t + 901), t)]), "end_before_start": (1, [(put(session="A", kind="VideoSessionStart", name="VideoSessionStart", ts=t + 5), t), (put(session="A", kind="VideoSessionEnd", name="VideoSessionEnd"), t)]),
        "several_ends": (1, [(put(session="A", kind="VideoSessionEnd", name="VideoSessionEnd", ts=t + k), t) for k in range(2)]), "dimensions_tied": (1, [(put(session="C1", ts=t + 1, platform="tv"), t)]), "duplicate_rows": (2, [clean[0], clean[0]]),
        "content_id_sentinel": (1, [(put(session="A", content=-1), t)]), "key_sentinel": (2, [(put(session="A", platform="*"), t), (put(session="B", country="*"), t)]), "content_without_catalog": (1, [(put(session="A", content=9), t), (put(session="B", content=9), t)]),
    }
    def report(rows, titles=catalog, drop=()):
        frame = spark.createDataFrame(titles, "content_id long, title string, video_type string, category string, show_name string")
        return {r.probe: (r.value, r.verdict) for r in contract_report(_named(spark, rows).drop(*drop), frame, now_s=t + 600).collect()}

    severity = dict(PROBES)
    fine = report(clean)
    assert list(fine) == [p for p, _ in PROBES] and len(fine) == 25 and all(v == "OK" for _, v in fine.values()) and fine["rows"] == (4, "OK") and fine["span_minutes"] == (0, "OK")
    for name, (value, rows) in cases.items():
        got = report(clean + rows)
        also = {"content_id_sentinel": {"content_without_catalog"}, "time_out_of_range": {"session_id_reused"}}.get(name, set())
        assert got[name] == (value, severity[name]), name
        assert {p for p, (_, v) in got.items() if v != "OK"} <= {name} | also, name
    assert report([])["source_empty"] == (1, "FAIL") and report(clean, [*catalog, (1, "two", "vod", "cat", "show")])["catalog_conflicts"] == (1, "WARN")
    assert report(clean, drop=("session_start_s", "country"))["columns_missing"] == (2, "FAIL")
    assert report([(put(session=f"C{k}", country=""), t) for k in range(3)])["dimensions_empty"] == (1, "WARN")
