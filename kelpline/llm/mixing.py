"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.llm.storage import materialise

#: A word is a run of anything but space and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def offset_of(source: Column, seed: int) -> Column:
    """The one random offset of a source, in [0, 1): the same in every run with the same seed."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _in_order(rows: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """``rows`` dealt by range and sorted, with _part and _at: their partition, and a number that grows by one within it."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), name)


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """(source, source_size) with a target for each source: all sizes shared by weight, none above cap x its size.

    Sources by code point, null last, take ``weights`` in turn; they are ranked by ranges, however many there are. Each round shares
    by weight what the sources found to be above their cap leave, until no other is above; a round is one sum over the sources.
    """
    ranked = _in_order(sizes, [F.col("source").asc_nulls_last()], "mix-sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")).select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    rank = (F.col("_at") + F.col("_shift")) % len(weights) + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), rank.cast("int"))
    shares = ranked.join(starts, "_part").select("source", "source_size", weight.alias("_weight"), (F.lit(float(cap)) * F.col("source_size")).alias("_cap"))
    shares = materialise(shares, "mix-shares").withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    level = -1.0
    while True:
        above = F.col("_ratio") < level
        total, capped, rest = shares.agg(F.sum("source_size"), F.sum(F.when(above, F.col("_cap"))), F.sum(F.when(~above, F.col("_weight")))).first()
        new = (float(total) - (capped or 0.0)) / rest if rest else level
        if new <= level or not rest:
            break
        level = new
    return shares.select("source", "source_size", F.least(F.col("_cap"), F.lit(level) * F.col("_weight")).alias("target"))


def _with_copies(slim: DataFrame, weights: Sequence[float], cap: float, seed: int, ties: Sequence[str] = ()) -> DataFrame:
    """Rows of ``slim`` (doc_id, source, size, ties) with source_size, target and copies; ``ties`` order rows that agree in the rest."""
    placed = _in_order(slim, ["source", "size", "doc_id", *ties], "mix-order")
    parts = placed.groupBy("_part", "source").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", F.col("source").alias("_source"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap).withColumnRenamed("source", "_name")
    starts = starts.join(targets, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name").withColumnRenamed("_part", "_of")
    rows = placed.join(starts, (F.col("_part") == F.col("_of")) & F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank, shift = (F.col("_at") + F.col("_shift")).cast("double"), offset_of(F.col("source"), seed)
    copies = F.floor((rank + 1) * F.col("_rate") + F.col("_offset")) - F.floor(rank * F.col("_rate") + F.col("_offset"))
    return rows.withColumn("_rate", rate).withColumn("_offset", shift).withColumn("copies", copies)


def mix_sources(df: DataFrame, *, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken (copies x size) of every row.

    A document's expected copies are its source's target over its source's size. They are summed along
    each source, shortest documents first; one random offset is added, and a document is emitted once
    for each whole number that its part of the sum crosses. In this order the words taken from a source
    stay within a few documents of its target, and no document is taken more than ``cap`` times, rounded up.

    The running sum is one rank per row: rows are dealt by range over (source, size, id), so a source of
    any share spreads over all partitions; each partition counts its rows by source, and the counts
    before it, a row for each partition and source, are added. Reruns agree.

    Null and empty texts have size 0 and may be emitted but take no words; a null source is a source of
    its own; equal rows are separate rows; an empty table gives an empty result; other columns are ignored.
    """
    slim = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = _with_copies(materialise(slim, "mix-sizes"), weights, cap, seed)
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(df: DataFrame, *, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df`` as the mix emits them: each as often as ``mix_sources`` takes it, with its columns and ``copy``.

    Every row is written once with a number of its own and emitted by its own crossings, so equal rows and
    rows without an id keep their source's target too. Rows that agree in source, size and id go by text,
    then by number, which also lets the ranges divide them.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    numbered = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), F.xxhash64(text_col).alias("hash"), F.struct(*df.columns).alias("doc"))
    numbered = materialise(numbered, "mix-documents")
    taken = _with_copies(numbered.select("row", "doc_id", "source", "size", "hash"), weights, cap, seed, ("hash", "row")).where("copies > 0").select("row", F.col("copies").cast("int").alias("copies"))
    joined = numbered.select("row", "doc").join(taken, "row")
    return joined.select("doc.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
