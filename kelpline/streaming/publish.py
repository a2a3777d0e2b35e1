"""Incremental publishing: each micro-batch corrects the tiers by the difference it makes, however late its events are.

A batch writes a folder of its own and is committed last, by one small file that is created exclusively and
names the folder, the batch it builds on, and what it holds; readers follow committed batches only. A batch that is run again
writes another folder, so a restart from the stream's checkpoint is exact, and a writer that has lost its lease can
neither commit nor touch what another one wrote. Tables lie in folders by day, and from time to time a batch writes all
of them anew (``compact_every``), so neither reads nor the number of files grow with all of history.
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kelpline.operators.hours import hour_rollup
from kelpline.operators.intervals import derive_intervals
from kelpline.operators.minutes import expanded, hour, minute, minute_deltas, minute_series, user_minutes
from kelpline.operators.reconcile import compare, verdict
from kelpline.policy import Policy

_SUMS = ("delta", "starts", "ends")


class LeaseLost(RuntimeError):
    """Another writer has taken over the folder."""


class GateFailed(RuntimeError):
    """What a batch would publish is not what its events say."""


class Publisher:
    """Tiers in a folder, kept up to date from a stream of events (columns as ``derive_intervals`` takes them)."""

    TABLES = ("events", "index", "intervals", "sessions", "deltas", "hours", "users", "touched", "stateless")

    def __init__(self, spark: SparkSession, folder: str, policy: Policy, *, verify: bool = True, compact_every: int = 16) -> None:
        self.spark, self.folder, self.policy, self.verify, self.compact_every = spark, folder.rstrip("/"), policy, verify, compact_every
        self.owner, self.epoch = uuid.uuid4().hex, None

    # --- files

    def _path(self, *parts: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        p, fs = self._path(*parts)
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def _create(self, text: str, *parts: str) -> bool:
        """Write a file that nobody has written yet; False if somebody has."""
        p, fs = self._path(*parts)
        fs.mkdirs(p.getParent())
        try:
            out = fs.create(p, False)
        except Exception:
            if fs.exists(p):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _text(self, *parts: str) -> str:
        p, fs = self._path(*parts)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    # --- lease

    def acquire(self) -> None:
        """Take over the folder: later writers win, and whoever held it can't commit any more."""
        while True:
            epochs = [int(n) for n in self._names("lease")]
            self.epoch = max(epochs, default=0) + 1
            if self._create(self.owner, "lease", f"{self.epoch:09d}"):
                return

    def _check_lease(self) -> None:
        if max(int(n) for n in self._names("lease")) != self.epoch:
            raise LeaseLost(f"epoch {self.epoch} of {self.folder} has ended")

    # --- commits

    def commits(self) -> dict[int, dict]:
        """The committed batches that were not abandoned, by number."""
        names = self._names("commits")
        gone = {n.removesuffix(".abandoned") for n in names if n.endswith(".abandoned")}
        return {int(n.removesuffix(".json")): json.loads(self._text("commits", n)) for n in names if n.endswith(".json") and n.removesuffix(".json") not in gone}

    def generation(self) -> int:
        """The last committed batch, or -1."""
        names = self._names("commits")
        gone = {n.removesuffix(".abandoned") for n in names if n.endswith(".abandoned")}
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json") not in gone), default=-1)

    def abandon(self, batch_id: int) -> None:
        """Take the last committed batch back: readers and later batches go on from the one it was built on."""
        if batch_id != self.generation():
            raise ValueError("only the last committed batch can be abandoned")
        self._create("", "commits", f"{batch_id:012d}.abandoned")

    def _chain(self, upto: int | None) -> list[dict]:
        """The commits that make up a generation, from the last that holds everything on."""
        last = self.generation() if upto is None else upto
        out: list[dict] = []
        while last >= 0 and not (out and out[0]["whole"]):
            name = f"{last:012d}.json"
            if name not in self._names("commits"):
                raise ValueError(f"batch {last} is not committed")
            out.insert(0, json.loads(self._text("commits", name)))
            last = out[0]["parent"]
        return out

    # --- tables

    def _write(self, df: DataFrame, data: str, table: str, day: str | None = None) -> DataFrame:
        path = f"{self.folder}/data/{data}/{table}"
        if day is None:
            df.write.mode("overwrite").parquet(path)
        else:
            df.withColumn("day", (F.floor(F.col(day) / 86400) * 86400).cast("long")).hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)
        return self._folder(df, data, table, day is not None)

    def _folder(self, like: DataFrame, data: str, table: str, by_day: bool) -> DataFrame:
        fields = [f for f in like.schema.fields if f.name != "day"] + ([T.StructField("day", T.LongType())] if by_day else [])
        return self.spark.read.schema(T.StructType(fields)).parquet(f"{self.folder}/data/{data}/{table}")

    def _read(self, table: str, chain: list[dict]) -> DataFrame | None:
        """Rows of all folders of a chain, with the batch that wrote them."""
        parts = [self._folder(self._like(c, table), c["data"], table, table in c["by_day"]).withColumn("batch", F.lit(c["batch"])) for c in chain]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def _like(self, commit: dict, table: str) -> DataFrame:
        return self.spark.createDataFrame([], T.StructType.fromJson(commit["schemas"][table]))

    def _current(self, table: str, scope: str, key: str, chain: list[dict]) -> DataFrame | None:
        """Rows of the last batch that touched their key; a key that was emptied has none."""
        rows, scopes = self._read(table, chain), self._read(scope, chain)
        if rows is None:
            return None
        last = scopes.groupBy(key).agg(F.max("batch").alias("batch"))
        return rows.join(last, [key, "batch"], "left_semi").drop("batch", "day")

    def intervals(self, generation: int | None = None) -> DataFrame | None:
        """Intervals of the last committed batch, or as they were after an earlier one."""
        return self._current("intervals", "sessions", "video_session_id", self._chain(generation))

    def deltas(self, generation: int | None = None) -> DataFrame | None:
        rows = self._read("deltas", self._chain(generation))
        return None if rows is None else _summed(rows.drop("batch", "day"))

    def hours(self, generation: int | None = None) -> DataFrame | None:
        return self._current("hours", "touched", "hour", self._chain(generation))

    def users(self, generation: int | None = None) -> DataFrame | None:
        rows = self._current("users", "touched", "hour", self._chain(generation))
        return None if rows is None else rows.drop("hour")

    def stateless(self, generation: int | None = None) -> DataFrame | None:
        """(minute, dimensions, session) of heartbeats and plays, each once: no state is kept to count them at any grain."""
        rows = self._read("stateless", self._chain(generation))
        return None if rows is None else rows.drop("batch", "day").distinct()

    # --- publishing

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Publish one micro-batch: re-derive the sessions it touches, write the difference, then the hours and users it changes.

        Raises GateFailed, and commits nothing, if the recomputed minutes of the touched sessions or the levels of the touched
        hours differ from what would be published; LeaseLost if another writer has taken over.
        """
        if batch_id <= self.generation() or f"{batch_id:012d}.abandoned" in self._names("commits"):
            return  # committed before a restart
        began = time.time()
        if self.epoch is None:
            self.acquire()
        self._check_lease()
        chain = self._chain(None)
        whole = len(chain) >= self.compact_every
        data = f"{batch_id:012d}-{self.epoch:09d}"
        put = lambda df, table, day=None: self._write(df, data, table, day)

        arrived = put(batch, "events", "ts_s")
        touched = put(arrived.select("video_session_id").distinct(), "sessions")
        days = put(arrived.select("video_session_id", F.col("day").alias("on_day")).distinct(), "index")
        known = self._read("index", chain)
        if known is not None:  # the days on which the touched sessions have events, few whatever the history
            days = days.unionByName(known.drop("batch").join(touched, "video_session_id", "left_semi"))
        on = [r.on_day for r in days.select("on_day").distinct().collect()]
        full, before = arrived.drop("day"), self._read("events", chain)
        if before is not None:
            full = full.unionByName(before.where(F.col("day").isin(on)).drop("day", "batch").join(touched, "video_session_id", "left_semi"))
        new = put(derive_intervals(full, self.policy, batch_id), "intervals", "start_s").drop("day")

        held = self._current("intervals", "sessions", "video_session_id", chain)
        old = None if held is None else held.join(touched, "video_session_id", "left_semi")
        sides = new.withColumn("_side", F.lit(1))
        if old is not None:
            sides = sides.unionByName(old.withColumn("_side", F.lit(-1)).select(sides.columns))
        change = minute_deltas(sides, "_side").where("delta <> 0 or starts <> 0 or ends <> 0")
        changed = put(change, "deltas", "minute")  # what goes and what comes in one write: no reader sees the dip between

        spans = new.select("start_s", "end_s") if old is None else new.select("start_s", "end_s").unionByName(old.select("start_s", "end_s"))
        covered = spans.select(F.explode(F.sequence(hour(F.col("start_s")), hour(F.col("end_s")), F.lit(3600).cast("long"))).alias("hour"))
        hours = put(changed.select(hour(F.col("minute")).alias("hour")).unionByName(covered).distinct(), "touched")
        at = [r.day for r in hours.select((F.floor(F.col("hour") / 86400) * 86400).alias("day")).distinct().collect()]
        deltas = changed.drop("day")
        if chain:
            deltas = deltas.unionByName(self._read("deltas", chain).where(F.col("day").isin(at)).drop("day", "batch"))
        served = _summed(deltas).withColumn("hour", hour(F.col("minute"))).join(hours, "hour", "left_semi").drop("hour")
        now = new if held is None else new.unionByName(held.join(touched, "video_session_id", "left_anti").select(new.columns))
        spanning = now.withColumn("hour", F.explode(F.sequence(hour(F.col("start_s")), hour(F.col("end_s")), F.lit(3600).cast("long")))).join(hours, "hour", "left_semi").select("video_session_id").distinct()
        around = now.join(spanning, "video_session_id", "left_semi")
        jobs = [lambda: put(hour_rollup(served), "hours", "hour"), lambda: put(user_minutes(around).withColumn("hour", hour(F.col("minute"))).join(hours, "hour", "left_semi"), "users", "minute"), lambda: put(stateless_minutes(arrived), "stateless", "minute")]
        if self.verify:
            jobs.append(lambda: self._gate(full, new, served, around, hours))
        with ThreadPoolExecutor(len(jobs)) as pool:  # none of them needs another one's result
            for done in [pool.submit(job) for job in jobs]:
                done.result()
        about = arrived.agg(F.count(F.lit(1)).alias("events"), F.countDistinct("video_session_id").alias("sessions"), F.max("ts_s").alias("watermark_s")).first()
        commit = {
            "batch": batch_id, "parent": chain[-1]["batch"] if chain else -1, "data": data, "whole": False, "events": about.events, "sessions": about.sessions, "watermark_s": about.watermark_s or 0,
            "policy": self.policy.digest, "owner": self.owner, "committed_s": int(time.time()), "elapsed_ms": int((time.time() - began) * 1000), "by_day": ["events", "intervals", "deltas", "hours", "users", "stateless"],
        }
        if whole:
            self._compact(commit, chain)
        shapes = {"events": arrived, "index": days, "intervals": new, "sessions": touched, "deltas": changed, "hours": hour_rollup(changed), "users": user_minutes(new).withColumn("hour", hour(F.col("minute"))), "touched": hours, "stateless": stateless_minutes(arrived)}
        commit["schemas"] = {t: shapes[t].drop("day").schema.jsonValue() if t in commit["by_day"] else shapes[t].schema.jsonValue() for t in self.TABLES}
        self._check_lease()
        if not self._create(json.dumps(commit), "commits", f"{batch_id:012d}.json"):
            raise LeaseLost(f"batch {batch_id} was committed by another writer")

    def _compact(self, commit: dict, chain: list[dict]) -> None:
        """Write all tables as they are after this batch, in one folder that needs none before it."""
        every = [*chain, {**commit, "schemas": chain[-1]["schemas"]}]
        commit["data"] += "-whole"
        commit["whole"] = True
        put = lambda df, table, day=None: self._write(df, commit["data"], table, day)
        put(self._read("events", every).drop("batch", "day"), "events", "ts_s")
        put(self._read("index", every).drop("batch").distinct(), "index")
        put(self._read("stateless", every).drop("batch", "day").distinct(), "stateless", "minute")
        for table, scope, key, day in (("intervals", "sessions", "video_session_id", "start_s"), ("hours", "touched", "hour", "hour"), ("users", "touched", "hour", "minute")):
            put(self._current(table, scope, key, every), table, day)
        for scope in ("sessions", "touched"):
            put(self._read(scope, every).drop("batch").distinct(), scope)
        put(_summed(self._read("deltas", every).drop("batch", "day")), "deltas", "minute")

    def _gate(self, events: DataFrame, intervals: DataFrame, served: DataFrame, around: DataFrame, hours: DataFrame) -> None:
        """The touched sessions derived in another way, and the touched hours counted session by session."""
        standard = self.policy.unclosed_pause_to_run_end and not self.policy.point_activity_counts and self.policy.liveness == "all" and self.policy.background == "ignored"
        if standard and (said := verdict(compare(events, minute_deltas(intervals), self.policy), self.policy).first()).verdict == "MISMATCH":
            raise GateFailed(f"{said.mismatched} minutes of the touched sessions differ by up to {said.max_abs_diff}")
        levels = expanded(around).withColumn("hour", hour(F.col("minute"))).join(hours, "hour", "left_semi").select("minute", F.col("concurrent").alias("truth"))
        shown = minute_series(served).where("concurrent <> 0")
        wrong = levels.join(shown, "minute", "full_outer").where(F.coalesce("truth", F.lit(0)) != F.coalesce("concurrent", F.lit(0))).count()
        if wrong:
            raise GateFailed(f"{wrong} minutes of the touched hours are not what their intervals say")

    # --- views

    def status(self) -> DataFrame | None:
        """The batches, newest last: status (committed, abandoned or in_flight), what each held, and is_active."""
        names = self._names("commits")
        if not names:
            return None
        gone = {int(n.split(".")[0]) for n in names if n.endswith(".abandoned")}
        active = self.generation()
        rows = [json.loads(self._text("commits", n)) for n in names if n.endswith(".json")]
        done = {r["data"].removesuffix("-whole") for r in rows}
        flying = [n for n in self._names("data") if n.removesuffix("-whole") not in done and int(n.split("-")[0]) > active]
        out = [(r["batch"], "abandoned" if r["batch"] in gone else "committed", r["parent"], r["events"], r["sessions"], r["watermark_s"], r["committed_s"], r["elapsed_ms"], r["whole"], r["policy"], r["owner"], r["batch"] == active) for r in rows]
        out += [(int(n.split("-")[0]), "in_flight", None, None, None, None, None, None, None, None, None, False) for n in flying]
        return self.spark.createDataFrame(out, "generation long, status string, parent long, events long, sessions long, watermark_s long, committed_s long, elapsed_ms long, whole boolean, policy string, owner string, is_active boolean")

    def publish_lag(self, arrivals: DataFrame, now_s: int | None = None) -> DataFrame:
        """One row: how far what is published is behind the events that have arrived (``arrivals``, all of them or the tail of a queue).

        publish_cursor and ingest_watermark are the newest event times of either, publish_lag_s their distance (never negative),
        pending_events and pending_sessions what no committed batch has; oldest_pending_s, its age and the headroom before the queue
        forgets it (null without any), with an alert a day before; the lease's holder, the last committed batch and runs in flight.
        """
        now = int(time.time()) if now_s is None else now_s
        chain = self._chain(None)
        last = chain[-1] if chain else {"batch": -1, "watermark_s": None, "elapsed_ms": None, "sessions": None}
        cursor = max((c["watermark_s"] for c in self.commits().values()), default=None)
        columns = arrivals.columns
        rows = arrivals.groupBy(*[c for c in columns if c != "extra"]).agg(F.count(F.lit(1)).alias("_n"))
        before = self._read("events", chain)
        if before is not None:
            seen = before.groupBy(*[c for c in columns if c != "extra"]).agg(F.count(F.lit(1)).alias("_m"))
            on = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(seen[c]) for c in columns if c != "extra"])
            rows = rows.join(seen, on, "left").select(rows["video_session_id"], rows["ts_s"], (F.col("_n") - F.coalesce("_m", F.lit(0))).alias("_n"))
        pending = F.when(F.col("_n") > 0, F.col("ts_s"))
        found = rows.agg(F.max("ts_s").alias("ingest_watermark"), F.coalesce(F.sum(F.greatest("_n", F.lit(0))), F.lit(0)).alias("pending_events"), F.countDistinct(F.when(F.col("_n") > 0, F.col("video_session_id"))).alias("pending_sessions"), F.min(pending).alias("oldest_pending_s"))
        ttl = self.policy.queue_ttl_days * 86_400
        cursor_col = F.lit(cursor).cast("long")
        age = F.greatest(F.lit(0), F.lit(now) - F.col("oldest_pending_s"))
        leases = self._names("lease")
        return found.select(
            cursor_col.alias("publish_cursor"), "ingest_watermark", F.greatest(F.lit(0).cast("long"), F.col("ingest_watermark") - F.coalesce(cursor_col, F.lit(0))).alias("publish_lag_s"), "pending_events", "pending_sessions", "oldest_pending_s",
            F.lit(ttl).cast("long").alias("retention_ttl_s"), F.when(F.col("oldest_pending_s").isNotNull(), age).alias("oldest_pending_age_s"), F.when(F.col("oldest_pending_s").isNotNull(), F.lit(ttl) - age).alias("retention_headroom_s"),
            F.coalesce(F.col("oldest_pending_s").isNotNull() & (age > ttl - 86_400), F.lit(False)).alias("retention_alert"), F.lit(self._text("lease", leases[-1]) if leases else None).cast("string").alias("lease_holder"),
            F.lit(last["batch"]).cast("long").alias("last_committed"), F.lit(last["elapsed_ms"]).cast("long").alias("last_run_ms"), F.lit(last["sessions"]).cast("long").alias("last_run_sessions"),
            F.lit(0 if (s := self.status()) is None else s.where("status = 'in_flight'").count()).cast("long").alias("runs_in_flight"),
        )

    def freshness(self, now_s: int | None = None, late_after_s: int = 3600) -> DataFrame:
        """(stage, rows, built_s, age_s, verdict) of each published table: FRESH, LATE, or MISSING without a committed batch."""
        now = int(time.time()) if now_s is None else now_s
        chain = self._chain(None)
        built = chain[-1]["committed_s"] if chain else None
        counts = {"events": self._read("events", chain), "intervals": self.intervals(), "deltas": self.deltas(), "hours": self.hours(), "users": self.users()} if chain else {}
        out = [(t, counts[t].count() if chain else None, built, now - built if chain else None, "MISSING" if not chain else "LATE" if now - built > late_after_s else "FRESH") for t in ("events", "intervals", "deltas", "hours", "users")]
        return self.spark.createDataFrame(out, "stage string, rows long, built_s long, age_s long, verdict string")

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """Run ``process`` for each micro-batch of ``stream``; late events are never dropped."""
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")).start()


def _summed(deltas: DataFrame) -> DataFrame:
    """Deltas with one row a minute and dimensions; those that came to nothing are gone."""
    keys = [c for c in deltas.columns if c not in _SUMS]
    return deltas.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS]).where("delta <> 0 or starts <> 0 or ends <> 0")


def replay(spark: SparkSession, folder: str, like: DataFrame, files_per_batch: int = 1) -> DataFrame:
    """A stream of the Parquet files in a folder, oldest first, a few at a time."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def stateless_minutes(batch: DataFrame) -> DataFrame:
    """Distinct (minute, dimensions, session) of a batch's heartbeats and plays: appended rows that stay countable at any grain."""
    alive = batch.where(F.col("event_type").isin("VideoHeartbeat", "VideoPlay"))
    return alive.select(minute(F.col("ts_s")).alias("minute"), "platform", "country", "content_id", "video_session_id").distinct()
