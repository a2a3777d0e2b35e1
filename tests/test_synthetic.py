from pyspark.sql import functions as F

from kelpline.operators.intervals import derive_intervals
from kelpline.operators.minutes import expanded, minute_deltas
from kelpline.operators.reconcile import compare, verdict
from kelpline.policy import Policy
from kelpline.sources.synthetic import COHORTS, START_S, arrivals, cohort, event_stream, staircase


def test_staircase_has_its_closed_form(spark):
    iv = derive_intervals(staircase(spark), Policy())
    assert iv.agg(F.count("*"), F.sum(F.col("end_s") - F.col("start_s"))).first()[:] == (60, 39_600)
    assert expanded(iv).agg(F.max("concurrent")).first()[0] == 12


def test_stream_is_the_same_in_parts_and_passes_the_gate(spark):
    events = event_stream(spark, 40, 20)
    assert sorted(map(str, events.collect())) == sorted(map(str, event_stream(spark, 40, 20).repartition(3).collect()))
    said = verdict(compare(events, minute_deltas(derive_intervals(events, Policy())), Policy()), Policy()).first()
    assert said.verdict == "PASS" and said.peak > 0


def test_cohorts_by_hand(spark):
    watched = lambda name: derive_intervals(cohort(spark, name), Policy()).agg(F.count("*"), F.sum(F.col("end_s") - F.col("start_s"))).first()[:]
    want = {"staircase": (60, 60 * 660), "blocks": (8, 8 * 1860), "paused": (20, 10 * (300 + 1260)), "one": (1, 360), "same_start": (200, 200 * 660), "copied": (1, 360), "lone_event": (0, None), "empty": (0, None)}
    assert {n: watched(n) for n in COHORTS} == want
    curve = expanded(derive_intervals(cohort(spark, "paused"), Policy())).collect()
    assert {r.concurrent for r in curve} == {10} and len(curve) == 6 + 22  # no one in the four minutes within the pause
    assert derive_intervals(cohort(spark, "lone_event"), Policy(point_activity_counts=True)).first().end_s - START_S == 60


def test_arrivals_keep_to_expectations(spark):
    """Total time within four deviations; concurrency away from the edges by Little's law, four deviations of its mean over time."""
    for n, over, mean, uniform in ((720, 6 * 3600, 1200.0, None), (240, 4 * 3600, 0.0, (600, 1800))):
        iv = derive_intervals(arrivals(spark, n, over, mean, uniform=uniform), Policy()).cache()
        span = 5 + mean + 60 if uniform is None else 1200 + 60
        deviation = mean if uniform is None else 346.7
        watched = iv.agg(F.sum(F.col("end_s") - F.col("start_s"))).first()[0]
        assert abs(watched - n * span) < 4 * deviation * n**0.5 + n
        settled = 3 * 1200 if uniform is None else 1860
        level = n / over * span
        seen = iv.select(F.greatest(F.lit(0), F.least("end_s", F.lit(START_S + over)) - F.greatest("start_s", F.lit(START_S + settled))).alias("t")).agg(F.sum("t")).first()[0] / (over - settled)
        assert abs(seen - level) < 4 * level**0.5 * (2 * span / (over - settled)) ** 0.5
