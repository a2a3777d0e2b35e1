import random

from builders import BASE, SCHEMA, event, table
from pyspark.sql import functions as F

from kelpline.operators.hours import hour_rollup
from kelpline.operators.intervals import derive_intervals
from kelpline.operators.minutes import minute_deltas, user_minutes
from kelpline.policy import Policy
from kelpline.streaming.publish import Publisher, replay, stateless_minutes

P = Policy()


def _rows(df, *drop):
    names = [c for c in df.columns if c not in drop]
    return sorted(str([r[c] for c in names]) for r in df.select(*names).collect())


def test_late_batches_converge_to_a_full_build(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for s in range(8):
        t = BASE + rng.randrange(4000)
        for _ in range(14):
            rows.append(event(t, rng.choice(["beat", "beat", "pause", "resume"]), f"s{s}", f"u{s % 3}", rng.choice(["web", "tv"])))
            t += rng.choice([20, 60, 140, 160])
    rng.shuffle(rows)
    source = tmp_path / "in"
    for k in range(3):
        table(spark, rows[k::3]).coalesce(1).write.mode("append").parquet(str(source))
    publisher = Publisher(spark, str(tmp_path / "out"), P)
    assert publisher.generation() == -1 and publisher.intervals() is None
    stream = replay(spark, str(source), spark.createDataFrame([], SCHEMA))
    publisher.start(stream, str(tmp_path / "ck")).awaitTermination(120)
    assert publisher.generation() == 2 and publisher.status().agg(F.sum("events")).first()[0] == len(rows)
    iv = derive_intervals(table(spark, rows), P).cache()
    deltas = minute_deltas(iv)
    assert _rows(publisher.intervals(), "build_version", "extra_dimensions") == _rows(iv, "build_version", "extra_dimensions")
    assert _rows(publisher.deltas().where("delta <> 0 or starts <> 0"), "x") == _rows(deltas.where("delta <> 0 or starts <> 0").select(publisher.deltas().columns), "x")
    live = lambda h: h.where("peak <> 0 or integral <> 0").select("platform", "country", "content_id", "cube_level", "hour", "peak", "peak_minute", "integral")
    assert _rows(live(publisher.hours())) == _rows(live(hour_rollup(deltas)))
    assert _rows(publisher.users().select("minute", "platform", "user_id")) == _rows(user_minutes(iv).select("minute", "platform", "user_id"))
    before = _rows(publisher.deltas(), "x")
    publisher.process(table(spark, rows[2::3]), 2)  # the last batch again, as after a crash
    assert _rows(publisher.deltas(), "x") == before
    assert stateless_minutes(table(spark, rows)).count() > 0
