import pytest

from kelpline.functions import normalise as n
from kelpline.sources.landing import cast_landing, disposition_report, ledger_summary, read_landing, write_landing
from kelpline.sources.schema import EVENT_COLUMNS, EVENT_REQUIRED, HeaderError, plan_header

HEAD = list(EVENT_COLUMNS)


def test_headers():
    assert plan_header(HEAD[::-1] + ["net"], EVENT_COLUMNS, EVENT_REQUIRED).extra == ("net",)
    for bad in (HEAD + ["country"], HEAD + ["a b"], [c for c in HEAD if c != "event_timestamp"], [c for c in HEAD if c != "country"]):
        with pytest.raises(HeaderError):
            plan_header(bad, EVENT_COLUMNS, EVENT_REQUIRED)
    assert plan_header([c for c in HEAD if c != "country"], EVENT_COLUMNS, EVENT_REQUIRED, ("country",)).missing == ("country",)
    with pytest.raises(HeaderError):
        plan_header([c for c in HEAD if c != "event_timestamp"], EVENT_COLUMNS, EVENT_REQUIRED, ("event_timestamp",))


def _row(**kw):
    base = dict.fromkeys(HEAD, "x") | {"content_id": "5", "event_timestamp": "1785060000123", "session_start_epoch": "1785059000000"} | kw
    return ",".join('"' + base[c].replace('"', '""') + '"' for c in HEAD)


def test_landing_casts_and_ledger(spark, tmp_path):
    file = tmp_path / "load.csv"
    lines = [",".join(HEAD), _row(), _row(content_id="-7", user_id="two\nlines, \"quoted\""), _row(event_timestamp="abc"), _row(event_timestamp="abc"), _row(event_timestamp=" 5"), _row(content_id="1.5"), _row(session_start_epoch="")]
    file.write_text("\n".join(lines) + "\n")
    landed = read_landing(spark, str(file), "L1").cache()
    typed, ledger = cast_landing(landed)
    got = typed.orderBy("content_id").collect()
    assert landed.count() == 7 and [r.content_id for r in got] == [-7, 0, 5, 5] and got[0].user_id == 'two\nlines, "quoted"'
    assert {r.ts_s for r in got} == {1785060000}
    report = disposition_report(landed, typed, ledger).first()
    assert (report.landed, report.rejected, report.typed, report.coalesced) == (7, 3, 4, 2)
    rows = {(r.disposition): (r.rows, r.distinct_rows) for r in ledger_summary(ledger).collect()}
    assert rows["rejected"] == (3, 2)
    write_landing(landed, str(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)exist"):
        write_landing(landed, str(tmp_path / "out"))


def test_unknown_columns_become_extras(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text(",".join([*HEAD, "video_resolution"]) + "\n" + _row() + ",hd\n" + _row() + ",\n")
    got = sorted(str(r.extra) for r in read_landing(spark, str(file), "L").collect())
    assert got == ["{'video_resolution': 'hd'}", "{}"]


LITERALS = [
    (n.norm_lang, "hin", "hin"), (n.norm_lang, "HIN", "hin"), (n.norm_lang, "hin-Hindi", "hin"), (n.norm_lang, "  ENG  ", "eng"), (n.norm_lang, "-soundhandler", ""), (n.norm_lang, "", ""),
    (n.norm_version, "3.33.50_ADE", "3.33.50_ade"), (n.norm_version, "v-0.0.1_adNE", "v-0.0.1_adne"), (n.norm_app_version, "5.0.36.00", "5.0.36"), (n.norm_app_version, "5.0.36", "5.0.36"),
    (n.norm_app_version, "9.0.0", "9.0.0"), (n.lang_class, "UNK", "unknown"), (n.lang_class, "", "unknown"), (n.lang_class, "OFF", "off"), (n.lang_class, "NON", "off"), (n.lang_class, "AUT", "auto"),
    (n.lang_class, "zzq", "named"), (n.norm_lang, "hin​", "hin"), (n.norm_case, " ENG ", "eng"), (n.norm_case, "﻿HIN", "hin"), (n.norm_case, "H\tIN", "hin"), (n.norm_scrub, "a b", "a b"),
]


def test_normalised_literals(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(*[f(F.lit(v)).alias(f"c{k}") for k, (f, v, _) in enumerate(LITERALS)]).first()
    assert [row[k] for k in range(len(LITERALS))] == [w for _, _, w in LITERALS]


def test_reasons_and_flags(spark):
    from pyspark.sql import functions as F

    ok, L = 1_785_060_000, F.lit
    cases = [("s1", "u1", ok, ""), ("", "u1", ok, "session_id_unusable"), ("   ", "u1", ok, "session_id_unusable"), ("​​", "u1", ok, "session_id_unusable"), ("s1", "u1", 0, "ts_out_of_range"), ("s1", "u1", 2_051_222_400, "ts_out_of_range"), ("", "u1", 0, "session_id_unusable")]
    row = spark.range(1).select(*[n.q_reason(L(s), L(u), L(t)).alias(f"c{k}") for k, (s, u, t, _) in enumerate(cases)]).first()
    assert [row[k] for k in range(len(cases))] == [c[3] for c in cases]
    flags = [(("s1", "u1", ok, ok - 9, 42, True), []), (("s1", "", ok, ok - 9, 42, True), ["user_id_empty"]), (("s1", "u1", ok, ok + 1, 42, True), ["event_before_session_start"]), (("s1", "u1", ok, ok - 1, -1, True), ["content_id_rollup_sentinel"]), ((" s1", "u1", ok, ok - 1, 42, True), ["identity_padded"])]
    row = spark.range(1).select(*[n.q_flags(*[L(x) for x in a]).alias(f"c{k}") for k, (a, _) in enumerate(flags)]).first()
    assert [row[k] for k in range(len(flags))] == [w for _, w in flags]
