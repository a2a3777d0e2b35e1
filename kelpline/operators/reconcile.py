"""The gate: the served curve against one that is recomputed from the events in another way."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelpline.operators.minutes import hour, minute
from kelpline.policy import Policy


def truth_segments(events: DataFrame, policy: Policy) -> DataFrame:
    """(video_session_id, start_s, end_s) by islands of pauses rather than a cursor over them.

    Pauses of a run get the resume after them and are merged into islands; activity is what lies between the
    run's start, the islands, and its end. Events are grouped into runs by an order of rows, not by values of time.
    """
    if policy.point_activity_counts or not policy.unclosed_pause_to_run_end:
        raise ValueError("the gate recomputes the default policy's handling of points and unclosed pauses")
    order = Window.partitionBy("video_session_id").orderBy("ts_s", "_k")
    rows = events.select("video_session_id", "ts_s", "event", F.monotonically_increasing_id().alias("_k"))
    fresh = (F.row_number().over(order) == 1) | (F.col("ts_s") - F.lag("ts_s").over(order) > policy.gap_s)
    rows = rows.withColumn("_run", F.sum(fresh.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    back = Window.partitionBy("video_session_id").orderBy(F.col("ts_s").desc()).rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("r", F.min(F.when(F.col("event") == "resume", F.col("ts_s"))).over(back))
    of_run = Window.partitionBy("video_session_id", "_run")
    rows = rows.withColumns({"rs": F.min("ts_s").over(of_run), "re": F.max("ts_s").over(of_run), "_first": F.row_number().over(of_run.orderBy("ts_s", "_k")) == 1})
    end = F.when(F.col("r") <= F.col("re"), F.col("r")).otherwise(F.col("re") + 1)
    pause = (F.col("event") == "pause") & (F.col("ts_s") < F.col("re")) & (end > F.col("ts_s"))
    span = lambda p, e: F.struct(p.alias("p"), e.alias("e"))
    # the run's start is as the end of a pause before all others
    both = F.array(F.when(F.col("_first"), span(F.lit(-(1 << 62)), F.col("rs"))), F.when(pause, span(F.col("ts_s"), end)))
    spans = rows.select("video_session_id", "_run", "re", F.explode(F.filter(both, lambda x: x.isNotNull())).alias("s")).select("video_session_id", "_run", "re", "s.*")
    in_order = of_run.orderBy("p", "e")
    new = F.coalesce(F.col("p") > F.max("e").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int")
    numbered = spans.withColumn("_n", new).withColumn("_i", F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    islands = numbered.groupBy("video_session_id", "_run", "re", "_i").agg(F.min("p").alias("p"), F.max("e").alias("e"))
    out = islands.withColumn("b", F.coalesce(F.lead("p").over(of_run.orderBy("p")), F.col("re"))).where("b > e")
    return out.select("video_session_id", F.col("e").alias("start_s"), (F.col("b") + F.when(F.col("b") == F.col("re"), policy.tail_s).otherwise(0)).alias("end_s"))


def compare(events: DataFrame, deltas: DataFrame, policy: Policy) -> DataFrame:
    """(minute, truth, served, diff) of every minute between the first and the last active one, idle ones too."""
    truth = truth_segments(events, policy).select("video_session_id", minute(F.col("start_s")).alias("a"), minute(F.col("end_s")).alias("b"))
    # a session counts once a minute: a segment begins after the minutes that earlier ones have
    before = F.max("b").over(Window.partitionBy("video_session_id").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1))
    fresh = truth.withColumn("a", F.greatest("a", F.coalesce(before + 60, F.col("a")))).where("a <= b")
    each = fresh.select(F.explode(F.sequence("a", "b", F.lit(60).cast("long"))).alias("minute"))
    levels = each.groupBy("minute").agg(F.count(F.lit(1)).alias("truth"))
    points = deltas.groupBy("minute").agg(F.sum("delta").alias("d"))
    bounds = levels.select("minute").unionByName(points.select("minute")).agg(hour(F.min("minute")).alias("a"), F.max("minute").alias("b"))
    spine = bounds.where("a is not null").select(F.explode(F.sequence("a", "b", F.lit(60).cast("long"))).alias("minute"))
    along = Window.partitionBy(hour(F.col("minute"))).orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    served = spine.join(points, "minute", "left").withColumn("served", F.sum(F.coalesce("d", F.lit(0))).over(along))
    rows = served.join(levels, "minute", "left").withColumn("truth", F.coalesce("truth", F.lit(0)))
    return rows.select("minute", "truth", "served", (F.col("served") - F.col("truth")).alias("diff"))


def verdict(compared: DataFrame, policy: Policy) -> DataFrame:
    """One row: minutes compared, mismatches, largest difference, peak, and PASS, MISMATCH or EMPTY."""
    rows = compared.agg(F.count(F.lit(1)).alias("minutes_compared"), F.count_if(F.col("diff") != 0).alias("mismatched"), F.coalesce(F.max(F.abs("diff")), F.lit(0)).alias("max_abs_diff"), F.coalesce(F.max("truth"), F.lit(0)).alias("peak"))
    said = F.when(F.col("minutes_compared") == 0, "EMPTY").when(F.col("mismatched") == 0, "PASS").otherwise("MISMATCH")
    return rows.select("*", said.alias("verdict"), F.lit(policy.digest).alias("policy"))
