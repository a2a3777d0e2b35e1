"""Registered queries against their SQL, on the smallest tables."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = [
    "b01_day_peak_avg_total", "b08_day_video_type_live", "b09_day_platform_in", "b11_range_ragged", "b12_all_days", "ag17_hour_cube", "s04_day_top_content", "s08_day_video_resolution", "s14_minute_day_summary",
    "im06_minute_curve_range", "v01_minute_dims", "v04_by_title", "v11_rolling_total", "v12_tumbling_15", "v16_profile", "u04_users_platform", "m06_intervals", "m08_minute_deltas", "x01_gate_minutes", "h01_declines", "h04_contract", "v18_drift", "v19_quarantine",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def plain(x):
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    return float(x) if isinstance(x, decimal.Decimal) else x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(str(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    found = duck.sql(entry.oracle_sql()[name])
    assert sorted(found.columns) == columns
    want = sorted(str(tuple(plain(r[found.columns.index(c)]) for c in columns)) for r in found.fetchall())
    assert got == want


def test_entry_and_registry(spark):
    assert entry.entry(spark).columns == ["peak", "peak_minute", "integral", "avg_concurrent"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_traps(spark):
    """Readings that look right and are not: what the engine must not serve."""
    from kelpline.operators import hours as R
    from kelpline.operators import minutes as M
    from kelpline.plans.model import model_of

    m = model_of(spark, SF)
    total = R.day_view(m.hours, 0).agg({"peak": "max"}).first()[0]
    parts = R.day_view(m.hours, 7).agg({"peak": "max"}).first()[0]
    assert parts <= total  # the largest part is no peak
    points = {r.minute for r in M.change_curve(m.deltas).collect()}
    dense = {r.minute for r in M.minute_series(m.deltas).collect()}
    assert points < dense  # between change points there are levels too
    unpinned = m.hours.agg({"integral": "sum"}).first()[0]
    pinned = R.pinned(m.hours).agg({"integral": "sum"}).first()[0]
    assert unpinned == 8 * pinned
    with pytest.raises(Exception, match="(?i)audio_language"):
        m.hours.where("audio_language = 'hin'").count()
