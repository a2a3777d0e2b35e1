"""N-gram Jaccard self-join by chosen paths."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.llm.bytetools import buffers, mix, shingles, slices, words
from kelpline.llm.groups import ALIKE_SCHEMA, PLACE, alike_pairs, at_places, connected_components, decided_here, gathered, links_of, shared, streamed, with_places
from kelpline.llm.storage import materialise

#: Sampled tokens of a set: its least shingle under each of so many hash functions.
TOKENS = 128
#: Of the tokens, so many give a byte each to the sketch by which a bucket's sets are compared.
SKETCH = 64
#: Buckets of more sets are split again, at most so often; then they are compared in blocks.
BUCKET, DEPTH = 256, 3
#: Share of the pairs at the similarity asked for that the runs are to find; pairs that are more alike are found more surely.
RECALL = 0.999

_rng = np.random.default_rng(8)
_XOR = _rng.integers(0, 1 << 32, TOKENS, dtype=np.uint32)
_ODD = _rng.integers(0, 1 << 31, TOKENS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def runs_for(similarity: float, recall: float, depth: int) -> int:
    """How many runs bring two sets of this similarity together with probability ``recall``.

    On each level they agree on Poisson(share / similarity) of the chosen tokens, so whether they are still together after
    ``depth`` splits is the survival of a branching process. The share of equal tokens is taken three
    deviations below the similarity, as all runs see the same sample of tokens.
    """
    share = max(similarity - 3 * (similarity * (1 - similarity) / TOKENS) ** 0.5, similarity / 4)
    together = 1.0
    for _ in range(depth):
        together = 1 - math.exp(-share / similarity * together)
    return math.ceil(math.log(1 - recall) / math.log(1 - together))


def sampled_tokens(values: np.ndarray) -> np.ndarray:
    """The least shingle hash under each of TOKENS functions."""
    low = (values >> np.uint64(32)).astype(np.uint32)
    best = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(low), 4096):
        best = np.minimum(best, ((low[lo : lo + 4096, None] ^ _XOR) * _ODD).min(0))
    return best


def _sets(part: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text of a slice."""
    hashes, owner, _, _ = words(*buffers(part.column("text")))
    values, of = shingles(hashes, owner, part.num_rows, width)
    cuts = np.searchsorted(of, np.arange(part.num_rows + 1))
    for k in range(part.num_rows):
        yield np.unique(values[cuts[k] : cuts[k + 1]])


def _name(values: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return np.array([mix(values).sum(dtype=np.uint64), mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)], np.uint64).tobytes()


def shingle_sets(df: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, name, n, tokens) of every row: what tells it apart, its set's name (null without words), size and sampled tokens."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("hash"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = list(_sets(part, width))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("hash"), pa.array([_name(v) if len(v) else None for v in found], pa.binary()), pa.array([len(v) for v in found], pa.int32()), pa.array([sampled_tokens(v).tobytes() if len(v) else None for v in found], pa.binary())],
                names=["doc_id", "hash", "name", "n", "tokens"],
            )

    sets = rows.mapInArrow(run, T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("hash", T.LongType()), T.StructField("name", T.BinaryType()), T.StructField("n", T.IntegerType()), T.StructField("tokens", T.BinaryType())]))
    return sets.select("doc_id", F.struct("hash", F.col("doc_id").alias("id")).alias("row"), "name", "n", "tokens")


def _chosen(path: np.ndarray, similarity: float) -> np.ndarray:
    """For each path, which tokens it is split on: each with probability 1 / (similarity * TOKENS), by a hash of the path."""
    limit = np.uint64(int((1 << 64) / (similarity * TOKENS)))
    return mix(path[:, None] ^ mix(np.arange(1, TOKENS + 1, dtype=np.uint64))[None, :]) < limit


def _split(rows: DataFrame, similarity: float) -> DataFrame:
    """(path, did, n) one level further down: a row for each chosen token of the set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                path = part.column("path").to_numpy().view(np.uint64)
                data, _ = buffers(part.column("tokens"))
                tokens = data.view(np.uint32).reshape(-1, TOKENS)
                row, which = np.nonzero(_chosen(path, similarity))
                below = mix(mix(path[row] + np.uint64(0x1234567) * (which + 1).astype(np.uint64)) ^ tokens[row, which].astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(below.view(np.int64)), part.column("did").take(pa.array(row)), part.column("n").take(pa.array(row))], names=["path", "did", "n"])

    return rows.mapInArrow(run, "path long, did long, n int")


def buckets(sets: DataFrame, similarity: float, runs: int, bucket: int, depth: int) -> DataFrame:
    """(path, did, n, _n, _w): the buckets in which sets (did, n, tokens) meet.

    Each run starts from a path of its own. On every level a path is split on tokens chosen by its hash,
    1 / similarity of them on average; sets with the same token there stay together. Buckets of one set
    end, those of up to ``bucket`` are ready, larger ones are split again; what is still larger after
    ``depth`` splits, sets that are nearly all alike, is ready as it is.
    """
    roots = F.explode(F.array(*[F.lit(int(x)) for x in mix(np.arange(1001, 1001 + runs, dtype=np.uint64)).view(np.int64)]))
    rows = sets.select("did", "n", "tokens", roots.alias("path"))
    ready = []
    for level in range(1, depth + 1):
        kept = materialise(shared(materialise(_split(rows, similarity), "paths")), "paths-shared")
        large = kept.where(F.col("_n") > bucket)
        if level == depth or large.isEmpty():
            ready.append(kept)
            break
        ready.append(kept.where(F.col("_n") <= bucket))
        rows = large.select("path", "did").join(sets.select("did", "n", "tokens"), "did")
    return reduce(DataFrame.unionByName, ready)


def _look_alike(similarity: float):
    """Sets of a bucket that may be similar: by size exactly, by their tokens within four and a half deviations."""

    def work(table: pa.Table) -> pa.RecordBatch | None:
        data, _ = buffers(table.column("sketch").combine_chunks())
        sketch, n = data.reshape(-1, SKETCH), table.column("n").to_numpy().astype(np.float64)

        def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
            least = similarity - 4.5 * np.sqrt(similarity * (1 - similarity) / np.minimum(small, SKETCH))
            return (small >= similarity * large - 1e-6) & ((sketch[a] == sketch[b]).mean(1) >= least)

        return alike_pairs(table, alike)

    return work


def _exact_links(similarity: float):
    """Exact comparison of the sets at a place: for each, the rows of documents linked to it and the least set it hangs with."""
    num = int(round(similarity * 1000))

    def work(table: pa.Table) -> pa.RecordBatch | None:
        # a join that was split may give a set more than once
        table = table.take(pa.array(np.unique(table.column("did").to_numpy(), return_index=True)[1]))
        n = table.num_rows
        column = table.column("shingles").combine_chunks()
        at, values = column.offsets.to_numpy(), column.values.to_numpy()
        size = np.diff(at).astype(np.int64)
        owner = np.repeat(np.arange(n), size)
        _, term, freq = np.unique(values[at[0] : at[-1]], return_inverse=True, return_counts=True)
        common = freq > 1
        rank = np.cumsum(common) - 1
        on = common[term]
        term, owner = rank[term[on]], owner[on]
        order = np.argsort(term, kind="stable")
        term, owner = term[order], owner[order]
        both, top = np.zeros((n, n), np.float32), int(common.sum())
        step = max(256, (1 << 22) // n)
        for lo in range(0, top, step):
            a, b = np.searchsorted(term, (lo, lo + step))
            dense = np.zeros((n, min(step, top - lo)), np.float32)
            dense[owner[a:b], term[a:b] - lo] = 1
            both += dense @ dense.T
        equal = both.astype(np.int64)
        linked = equal * 1000 >= num * (size[:, None] + size[None, :] - equal)
        return links_of(table, linked & decided_here(table))

    return work


def _labelled(df: DataFrame, similarity: float, width: int, recall: float, bucket: int, depth: int, id_col: str, text_col: str) -> DataFrame:
    """Every row's doc_id, row and name, with class_id, n_links, component_id and root, which are null for rows without words."""
    docs = materialise(shingle_sets(df, width, id_col, text_col), "jaccard-documents")
    named = docs.where(F.col("name").isNotNull())
    classes = named.groupBy("name").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies"), F.min("row").alias("first"), F.min(F.struct("n", "tokens")).alias("_s"))
    every = F.concat(*[F.substring("_s.tokens", 4 * k + 1, 1) for k in range(SKETCH)])
    classes = classes.select("name", "class_id", "copies", "first", F.col("_s.n").alias("n"), F.col("_s.tokens").alias("tokens"), every.alias("sketch"), F.monotonically_increasing_id().alias("did"))
    classes = materialise(classes, "jaccard-classes")
    members = gathered(buckets(classes, similarity, runs_for(similarity, recall, depth), bucket, depth), classes.select("did", "n", "sketch"))
    wanted = materialise(streamed(members, PLACE, _look_alike(similarity), ALIKE_SCHEMA), "jaccard-alike")
    places = with_places(wanted).join(classes.select("did", "first", "copies"), "did")
    texts = df.select(F.struct(F.xxhash64(F.col(text_col)).alias("hash"), F.col(id_col).alias("id")).alias("row"), F.col(text_col).alias("text"))
    chosen = texts.join(places.hint("merge"), texts["row"] == places["first"]).select("did", "copies", "paths", "places", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            # rows that agree in id and text follow each other, and one of them stands for all
            did = batch.column("did").to_numpy()
            new = np.concatenate([did[:1] != last, did[1:] != did[:-1]])
            last = did[-1] if len(did) else last
            for part in slices([batch.filter(pa.array(new))], "text"):
                found = [v.view(np.int64) for v in _sets(part, width)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.list_(pa.int64()))], names=[*part.schema.names[:-1], "shingles"])

    sets = chosen.mapInArrow(run, "did long, copies long, paths array<long>, places array<struct<path:long,_i:int,_j:int,_own:int>>, shingles array<long>")
    exact = materialise(streamed(at_places(sets), PLACE, _exact_links(similarity), "did long, links long, hangs long"), "jaccard-links")
    counts = exact.groupBy("did").agg(F.sum("links").alias("links"))
    components = connected_components(exact.select(F.col("did").alias("u"), F.col("hangs").alias("v")))
    about = classes.select("name", "class_id", "copies", "did").join(counts, "did", "left").join(components.withColumnRenamed("node", "did"), "did", "left")
    about = about.select("name", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "did").alias("root"))
    least = about.groupBy("root").agg(F.min("class_id").alias("component_id"))
    about = about.join(least, "root").select("name", "class_id", "n_links", "component_id", "root")
    return docs.select("doc_id", "row", "name").join(about, "name", "left")


def jaccard_links(df: DataFrame, *, similarity: float = 0.8, width: int = 5, recall: float = RECALL, bucket: int = BUCKET, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, n_links, component_id and kept of every row.

    A document's set are its runs of ``width`` words (A-Z as a-z, punctuation aside); two documents are
    linked if the Jaccard similarity of their sets is at least ``similarity``. Documents with the same
    set are one class: class_id is its smallest doc_id, and the join below works on classes. n_links
    counts the other documents linked directly, component_id is the smallest doc_id reachable by
    links, kept says that it is the document's own.

    The runs are as many as bring a pair together with probability ``recall``. In each bucket pairs are first
    compared by a sketch of their tokens; what looks alike travels once to each bucket that decides about
    a pair of it, and is compared exactly there, large buckets in pairs of blocks. A pair is decided in
    one bucket only, and none below ``similarity`` is reported.

    A text of fewer than ``width`` words is one shingle of all its words; one without words, or null,
    links with nothing. Null ids count as links but name no class or component unless it has no other
    id. Equal rows are separate documents with the same id. Columns that are not named are ignored.
    """
    rows = _labelled(df, similarity, width, recall, bucket, depth, id_col, text_col)
    out = rows.select("doc_id", F.when(F.col("name").isNotNull(), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("name").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_per_component(df: DataFrame, *, similarity: float = 0.8, width: int = 5, recall: float = RECALL, bucket: int = BUCKET, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(hash, id, copies) of the row that stays of each component: of smallest id, then of smallest text hash.

    Rows without an id are members as all others and stay only where no member has one. ``hash`` is xxhash64
    of the text; ``copies`` counts the rows that agree in both, as they can't be told apart here. A row
    without words is a component of its own, with the rows equal to it.
    """
    each = _labelled(df, similarity, width, recall, bucket, depth, id_col, text_col).groupBy("root", "row").agg(F.count(F.lit(1)).alias("copies"))
    each = each.select("root", F.col("row.hash").alias("hash"), F.col("row.id").alias("id"), "copies")
    first = each.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("_unnamed"), "id", "hash", "copies")).alias("_r"))
    return first.select("_r.hash", "_r.id", "_r.copies").unionByName(each.where("root is null").select("hash", "id", "copies"))
