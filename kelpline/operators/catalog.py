"""Content attributes on concurrency: joins to the catalog, curves by attribute, drill-down rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.operators.hours import peak_and_average
from kelpline.operators.minutes import change_curve, held_curve, minute, within

ATTRIBUTES = ("title", "video_type", "category", "show_name")
#: A catalog of more rows than this is joined by shuffle (Spark decides), not sent to all executors.
BROADCAST_ROWS = 200_000


def one_per_content(catalog: DataFrame) -> DataFrame:
    """One row for each content_id: the one least in all attributes, so reruns agree."""
    best = catalog.groupBy("content_id").agg(F.min(F.struct(*[F.coalesce(F.col(a).cast("string"), F.lit("")).alias(a) for a in ATTRIBUTES])).alias("_a"))
    return best.select("content_id", "_a.*")


def with_content(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """``rows`` with the catalog's attributes: '(unknown)' without a catalog row, '(blank)' for an empty value."""
    known = one_per_content(catalog).select("content_id", *[F.col(a).alias(f"_{a}") for a in ATTRIBUTES], F.lit(1).alias("_known"))
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    joined = rows.join(known, "content_id", "left")
    shown = [F.when(F.col("_known").isNull(), "(unknown)").when(F.col(f"_{a}") == "", "(blank)").otherwise(F.col(f"_{a}")).alias(a) for a in ATTRIBUTES]
    return joined.select(*rows.columns, *shown)


def attribute_curve(deltas: DataFrame, catalog: DataFrame, attribute: str) -> DataFrame:
    """Change points by a catalog attribute: joined first, then summed, then run along the hour."""
    return change_curve(with_content(deltas, catalog), [attribute])


def attribute_levels(deltas: DataFrame, catalog: DataFrame, attribute: str) -> DataFrame:
    return held_curve(with_content(deltas, catalog), [attribute])


def attribute_range(deltas: DataFrame, catalog: DataFrame, attribute: str, value: str, start_s: int, end_s: int) -> DataFrame:
    """Peak and average over [start_s, end_s), whole hours, of contents with one value of an attribute ('' for a blank one).

    No row if no content has the value, so that a misspelt one does not read as nobody watching.
    """
    having = one_per_content(catalog).where(F.col(attribute) == value).select("content_id")
    rows = within(deltas, "minute", start_s, end_s).join(having, "content_id", "left_semi")
    return peak_and_average(held_curve(rows), end_s - start_s).join(F.broadcast(having.limit(1).select(F.lit(1).alias("_seen"))), F.lit(True), "left_semi")


def title_curve(deltas: DataFrame, catalog: DataFrame) -> DataFrame:
    """As ``attribute_curve`` by title, with how many catalog entries share it."""
    shared = one_per_content(catalog).withColumn("title", F.when(F.col("title") == "", "(blank)").otherwise(F.col("title"))).groupBy("title").agg(F.count(F.lit(1)).alias("catalog_content_ids"))
    return attribute_curve(deltas, catalog, "title").join(shared, "title", "left").select("minute", "title", F.coalesce("catalog_content_ids", F.lit(0)).alias("catalog_content_ids"), "concurrent")


def current(curve: DataFrame, by: Sequence[str]) -> DataFrame:
    """The level of each ``by`` at its last change point."""
    return curve.groupBy(*by).agg(F.max_by("concurrent", "minute").alias("concurrent"), F.max("minute").alias("as_of"))


def title_collisions(catalog: DataFrame) -> DataFrame:
    """Titles that name more than one content."""
    rows = one_per_content(catalog).groupBy("title").agg(F.count(F.lit(1)).alias("content_ids"), F.countDistinct("category").alias("categories"), F.countDistinct("video_type").alias("video_types"), F.array_sort(F.collect_set("content_id")).alias("ids"))
    return rows.where("content_ids > 1")


def orphans(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """How many contents and events the catalog lacks."""
    lost = events.join(catalog.select("content_id").distinct(), "content_id", "left_anti")
    return lost.agg(F.countDistinct("content_id").alias("orphan_content_ids"), F.count(F.lit(1)).alias("orphan_events"))


def session_minutes(intervals: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row for each session and minute, of the interval that starts last, with attributes and extra dimensions."""
    dims = ("user_id", "platform", "country", "content_id", "app_version", "audio_language", "subtitle_language", "player_version", "extra_dimensions")
    each = intervals.withColumn("minute", F.explode(F.sequence(minute(F.col("start_s")), minute(F.col("end_s")), F.lit(60).cast("long"))))
    rows = each.groupBy("minute", "video_session_id").agg(F.max_by(F.struct(*dims), "start_s").alias("_d")).select("minute", "video_session_id", "_d.*")
    rows = rows.withColumn("video_resolution", F.coalesce(F.element_at("extra_dimensions", "video_resolution"), F.lit("")))
    return with_content(rows, catalog)


def dimension_values(rows: DataFrame) -> DataFrame:
    """(minute, session, user, dimension_name, dimension_value) of all extra dimensions of ``session_minutes``."""
    return rows.select("minute", "video_session_id", "user_id", F.explode("extra_dimensions").alias("dimension_name", "dimension_value"))


def content_dimension_values(rows: DataFrame) -> DataFrame:
    """The same of the catalog attributes."""
    pairs = F.array(*[F.struct(F.lit(a).alias("n"), F.col(a).alias("v")) for a in ATTRIBUTES])
    return rows.select("minute", "video_session_id", "user_id", "content_id", F.explode(pairs).alias("_p")).select("minute", "video_session_id", "user_id", "content_id", F.col("_p.n").alias("dimension_name"), F.col("_p.v").alias("dimension_value"))


def dimension_profile(rows: DataFrame) -> DataFrame:
    """For each extra and catalog dimension: rows, non-empty rows, distinct values and sessions or contents."""

    def profile(values: DataFrame, source: str, entity: str) -> DataFrame:
        return values.groupBy("dimension_name").agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(F.col("dimension_value") != "").alias("non_empty_rows"), F.countDistinct("dimension_value").alias("distinct_values"), F.countDistinct(entity).alias("distinct_entities")).select(F.lit(source).alias("dimension_source"), "dimension_name", "source_rows", "non_empty_rows", "distinct_values", "distinct_entities")

    return profile(dimension_values(rows), "event", "video_session_id").unionByName(profile(content_dimension_values(rows), "content", "content_id"))
