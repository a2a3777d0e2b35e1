"""Groups of any size: connected components, buckets dealt over block pairs, and groups streamed through Arrow."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.llm.storage import materialise

#: A bucket is compared block by block, each pair of blocks in its own place, if it has more members or more values than these.
BLOCK, BLOCK_VALUES = 512, 1 << 21


def _own_exchange(minima: DataFrame) -> DataFrame:
    """The same rows under a computed key.

    A join right after an aggregation on its key shares the aggregation's exchange, and then a hub's rows
    stay in one task. With an exchange of its own for either side the join can be split where it is skewed.
    """
    return _rekeyed(minima, "u")


def _rekeyed(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumn(key, F.col(key).bitwiseXOR(F.lit(0).cast("long")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v): root is the least node that can be reached.

    Alternating large and small stars: neighbours move to the least node seen until all hang on their
    root, in a number of rounds that grows with the logarithm of the longest chain. Minima are taken
    with partial aggregation and joined back, so a hub is split as any skewed join is. Each round is a
    table in the shared folder; nothing is collected but a count and a checksum.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = materialise(pairs, "components")
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _own_exchange(both.groupBy("u").agg(F.min("v").alias("_m"))).select("u", F.least("u", "_m").alias("_m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        least = _own_exchange(large.groupBy("u").agg(F.min("v").alias("_m")))
        small = large.join(least, "u").where("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        pairs = materialise(small.unionByName(least.select("u", F.col("_m").alias("v"))).distinct(), "components")
        sign = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if sign == seen:
            break
        seen = sign
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def shared(rows: DataFrame) -> DataFrame:
    """Rows (path, did, n, ...) of the paths that at least two have, with _n members and _w, the sum of their n."""
    sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("n").cast("long")).alias("_w")).where("_n > 1")
    return rows.join(_rekeyed(sizes, "path"), "path")


def gathered(ready: DataFrame, about: DataFrame, block: int | None = None) -> DataFrame:
    """Rows (path, _i, _j, _own, did, paths, columns of ``about``) of the members of all buckets.

    ``ready`` are rows of ``shared``, ``about`` has one row a did. ``paths`` are all buckets of the member, whose
    number is bounded by the method. A bucket of one block is one place (0, 0); the blocks of a larger one go
    to all their pairs, so no task holds more than about two blocks, and every two members meet in exactly
    one place, that of their own blocks.
    """
    blocks = F.greatest(F.ceil(F.col("_n") / (block or BLOCK)), F.ceil(F.col("_w") / BLOCK_VALUES)).cast("int")
    rows = ready.select("path", "did", F.least(blocks, F.col("_n").cast("int")).alias("_blocks"))
    rows = rows.withColumn("_own", F.pmod(F.xxhash64("did", F.lit(3)), F.col("_blocks").cast("long")).cast("int"))
    lists = rows.groupBy("did").agg(F.collect_list(F.struct("path", "_blocks", "_own")).alias("_p")).join(about, "did")
    each = lists.select("did", *[c for c in about.columns if c != "did"], F.transform("_p", lambda x: x["path"]).alias("paths"), F.explode("_p").alias("_k"))
    rows = each.select("_k.*", *[c for c in each.columns if c != "_k"]).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return rows.withColumn("_i", F.least("_own", "_other")).withColumn("_j", F.greatest("_own", "_other")).drop("_blocks", "_other")


PLACE = ["path", "_i", "_j"]


def decided_here(table: pa.Table) -> np.ndarray:
    """Which pairs of the rows at one place are decided there.

    Two members may share many buckets; the one of the least path decides, so that a pair is compared
    and counted once, wherever else it meets. Of two blocks only pairs across them are.
    """
    lists = table.column("paths").combine_chunks()
    at, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy()
    n = len(at) - 1
    owner = np.repeat(np.arange(n), np.diff(at))
    early = flat < table.column("path")[0].as_py()
    term, owner = flat[early], owner[early]
    _, term, times = np.unique(term, return_inverse=True, return_counts=True)
    again = times > 1
    rank = np.cumsum(again) - 1
    on = again[term]
    term, owner = rank[term[on]], owner[on]
    order = np.argsort(term, kind="stable")
    term, owner = term[order], owner[order]
    met = np.zeros((n, n), bool)
    for lo in range(0, int(again.sum()), 4096):
        a, b = np.searchsorted(term, (lo, lo + 4096))
        part = np.zeros((n, min(4096, int(again.sum()) - lo)), np.float32)
        part[owner[a:b], term[a:b] - lo] = 1
        met |= part @ part.T > 0
    i, j, own = table.column("_i")[0].as_py(), table.column("_j")[0].as_py(), table.column("_own").to_numpy()
    here = ~np.eye(n, dtype=bool) if i == j else own[:, None] != own[None, :]
    return here & ~met


def alike_pairs(table: pa.Table, alike: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> pa.RecordBatch | None:
    """Rows (PLACE, _own, did, paths) of a place that have a partner there which looks alike, among the pairs decided there."""
    x, y = np.nonzero(np.triu(decided_here(table)))
    seen = np.zeros(table.num_rows, bool)
    for lo in range(0, len(x), 1 << 16):
        a, b = x[lo : lo + (1 << 16)], y[lo : lo + (1 << 16)]
        on = alike(a, b)
        seen[a[on]] = seen[b[on]] = True
    if not seen.any():
        return None
    return table.select([*PLACE, "_own", "did", "paths"]).take(pa.array(np.flatnonzero(seen))).combine_chunks().to_batches()[0]


ALIKE_SCHEMA = "path long, _i int, _j int, _own int, did long, paths array<long>"


def with_places(wanted: DataFrame) -> DataFrame:
    """(did, paths, places) of rows of ``alike_pairs``: where each member is to be compared exactly."""
    return wanted.groupBy("did").agg(F.first("paths").alias("paths"), F.collect_list(F.struct(*PLACE, "_own")).alias("places"))


def at_places(rows: DataFrame) -> DataFrame:
    """Rows of ``with_places``, whatever else they carry, one for each place."""
    rest = [c for c in rows.columns if c != "places"]
    return rows.select(*rest, F.explode("places").alias("_k")).select("_k.*", *rest)


def links_of(table: pa.Table, linked: np.ndarray) -> pa.RecordBatch:
    """(did, links, hangs) of a symmetric matrix of links: rows of the table linked to each, and the least one it hangs with."""
    did, copies = table.column("did").to_numpy(), table.column("copies").to_numpy().astype(np.float64)
    return pa.RecordBatch.from_arrays([pa.array(did), pa.array((linked @ copies).astype(np.int64)), pa.array(did[least_labels(linked)])], names=["did", "links", "hangs"])


def streamed(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` on the rows of each group of ``keys`` in turn; a task holds one group and one Arrow batch at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows, bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                now = tuple(c[lo] for c in columns)
                if held and now != last:
                    out = work(pa.Table.from_batches(held))
                    held = []
                    if out is not None and out.num_rows:
                        yield out
                held.append(batch.slice(lo, hi - lo))
                last = now
        if held and (out := work(pa.Table.from_batches(held))) is not None and out.num_rows:
            yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def least_labels(linked: np.ndarray) -> np.ndarray:
    """Component of each row of a symmetric boolean matrix, as the least row in it."""
    n = len(linked)
    labels = np.arange(n)
    linked = linked | np.eye(n, dtype=bool)
    while True:
        new = np.where(linked, labels[None, :], n).min(1)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new
