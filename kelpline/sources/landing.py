"""CSV landing: every column as text, cast row by row, and a ledger of what could not be cast."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.sources.schema import CONTENT_COLUMNS, CONTENT_REQUIRED, EVENT_COLUMNS, EVENT_REQUIRED, HeaderPlan, landing_schema, plan_header

_NUMBERS = {"events": ("content_id", "event_timestamp", "session_start_epoch"), "content": ("content_id",)}


def read_landing(spark: SparkSession, path: str, load_id: str, kind: str = "events", acknowledged: tuple[str, ...] = (), multi_line: bool = True) -> DataFrame:
    """A CSV file, or a folder of them with the same header, as text columns of the contract, ``extra`` with all further ones, and load_id.

    Quoted values may hold commas, quotes and, with ``multi_line``, line ends; without it a large file is cut into several tasks. Missing columns that are acknowledged are empty.
    """
    columns, required = (EVENT_COLUMNS, EVENT_REQUIRED) if kind == "events" else (CONTENT_COLUMNS, CONTENT_REQUIRED)
    head = spark.read.text(path).first()
    header = next(csv.reader([head[0] if head else ""]))
    plan: HeaderPlan = plan_header(header, columns, required, acknowledged)
    rows = spark.read.schema(landing_schema(header)).option("header", True).option("multiLine", multi_line).option("escape", '"').option("enforceSchema", True).csv(path)
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in plan.present else F.lit("")
    extras = [x for c in plan.extra for x in (F.lit(c), F.coalesce(F.col(c), F.lit("")))]
    extra = F.map_filter(F.create_map(*extras), lambda k, v: v != "") if extras else F.create_map()
    return rows.select(*[text(c).alias(c) for c in columns], extra.cast("map<string,string>").alias("extra"), F.lit(load_id).alias("load_id"))


def write_landing(rows: DataFrame, path: str) -> None:
    """One folder a load; a load that is there already is refused, so nothing is counted twice."""
    loads = [r.load_id for r in rows.select("load_id").distinct().limit(2).collect()]
    for load in loads:
        rows.where(F.col("load_id") == load).drop("load_id").write.mode("errorifexists").parquet(f"{path.rstrip('/')}/load_id={load}")


def whole_number(text: Column) -> Column:
    """The number that a text is, digit for digit: no blanks, no fraction; null otherwise."""
    return F.when(text.rlike(r"^-?[0-9]{1,19}$"), F.try_cast(text, "long") if hasattr(F, "try_cast") else text.try_cast("long"))


def _detail(kind: str, fatal: tuple[str, ...]) -> Column:
    bad = [F.when(whole_number(F.col(c)).isNull(), F.concat(F.lit(f"{c}="), F.col(c))) for c in _NUMBERS[kind]]
    return F.concat_ws("; ", *bad)


def cast_landing(rows: DataFrame, kind: str = "events") -> tuple[DataFrame, DataFrame]:
    """(typed rows, ledger). Rejected are only rows whose time (events) or content_id (catalog) is no number; other numbers become 0.

    The ledger has each distinct bad row once: source, reason, disposition (rejected or coalesced), copies,
    detail, a hash that names it, and the row's texts as a map.
    """
    fatal = "event_timestamp" if kind == "events" else "content_id"
    numbers = {c: whole_number(F.col(c)) for c in _NUMBERS[kind]}
    typed = rows.where(numbers[fatal].isNotNull())
    if kind == "events":
        typed = typed.withColumns({"content_id": F.coalesce(numbers["content_id"], F.lit(0)), "_ms": numbers["event_timestamp"], "_start": F.coalesce(numbers["session_start_epoch"], F.lit(0))})
        typed = typed.withColumns({"event_timestamp": F.timestamp_millis("_ms"), "ts_s": F.floor(F.col("_ms") / 1000), "session_start_s": F.floor(F.col("_start") / 1000), "session_start_epoch": F.timestamp_millis("_start")}).drop("_ms", "_start")
    else:
        typed = typed.withColumn("content_id", numbers["content_id"]).withColumn("show_name", F.coalesce(F.element_at("extra", "show_name"), F.lit("")))
    names = [c for c in rows.columns if c not in ("extra", "load_id")]
    bad = rows.withColumn("detail", _detail(kind, (fatal,))).where("detail <> ''")
    disposition = F.when(numbers[fatal].isNull(), "rejected").otherwise("coalesced")
    raw = F.map_concat(F.create_map(*[x for c in names for x in (F.lit(c), F.col(c))]), F.col("extra"))
    bad = bad.select("load_id", F.lit(kind).alias("source"), disposition.alias("disposition"), F.when(disposition == "rejected", F.lit(f"{fatal}_not_a_number")).otherwise("number_coalesced").alias("reason"), "detail", raw.alias("raw"))
    named = bad.withColumn("src_hash", F.xxhash64(F.to_json(F.map_from_entries(F.array_sort(F.map_entries("raw"))))))
    ledger = named.groupBy("load_id", "source", "reason", "disposition", "src_hash").agg(F.count(F.lit(1)).alias("copies"), F.min("detail").alias("detail"), F.min_by("raw", "detail").alias("raw"))
    return typed, ledger


def disposition_report(landed: DataFrame, typed: DataFrame, ledger: DataFrame) -> DataFrame:
    """(load_id, landed, rejected, typed, coalesced) of each load."""
    bad = ledger.groupBy("load_id").agg(F.sum(F.when(F.col("disposition") == "rejected", F.col("copies")).otherwise(0)).alias("rejected"), F.sum(F.when(F.col("disposition") == "coalesced", F.col("copies")).otherwise(0)).alias("coalesced"))
    rows = landed.groupBy("load_id").agg(F.count(F.lit(1)).alias("landed")).join(typed.groupBy("load_id").agg(F.count(F.lit(1)).alias("typed")), "load_id", "left").join(bad, "load_id", "left")
    return rows.na.fill(0, ["typed", "rejected", "coalesced"]).select("load_id", "landed", "rejected", "typed", "coalesced")


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """(source, reason, disposition, rows, distinct_rows, up to five details)."""
    return ledger.groupBy("source", "reason", "disposition").agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"), F.slice(F.array_sort(F.collect_set("detail")), 1, 5).alias("sample_detail"))
