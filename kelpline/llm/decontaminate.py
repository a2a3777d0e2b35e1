"""Benchmark decontamination with suffix arrays over shards of the training words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.llm.bytetools import buffers, slices, words
from kelpline.llm.storage import materialise

#: Bytes of the index in a worker's memory; a larger benchmark is looked up in several passes.
INDEX_BYTES = 128 << 20
#: Words of an item that one entry of the index holds; longer items are cut, with ``window`` - 1 words in common.
ITEM_WORDS = 1 << 16
_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass
class TestIndex:
    """Words of the benchmark's items and their test suffixes cut to ``window`` words.

    ``vocabulary`` has the hashes of all words in order, ``spelled`` and ``spelled_at`` their bytes. ``flat`` holds
    the items' words as ids, 0 past an item's end; ``begin`` and ``lengths`` are the distinct suffixes in it, and ``at``,
    ``items`` and ``offsets`` list the items of each and where it starts in them.
    """

    vocabulary: np.ndarray
    spelled: np.ndarray
    spelled_at: np.ndarray
    pairs: np.ndarray
    single: np.ndarray
    flat: np.ndarray
    begin: np.ndarray
    lengths: np.ndarray
    at: np.ndarray
    items: np.ndarray
    offsets: np.ndarray
    ids: list[str]


def build_index(items: list[tuple[str, int, str]], window: int) -> TestIndex:
    """Index of (id, first word, text) entries. A window is ``window`` words in a row; a shorter item, but not an empty one, is one window."""
    data, offsets = buffers(pa.array([t or "" for *_, t in items], pa.string()))
    hashes, owner, first, past = words(data, offsets)
    cuts = np.searchsorted(owner, np.arange(len(items) + 1))
    vocabulary, one, word = np.unique(hashes, return_index=True, return_inverse=True)
    size = past[one] - first[one]
    spelled_at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    spelled = lowered(data)[np.repeat(first[one] - spelled_at[:-1], size) + np.arange(spelled_at[-1])]
    if not spelled_alike(data, first, past, word, spelled, spelled_at).all():
        raise ValueError("two words of the benchmark have the same 64-bit hash")
    flat, suffixes, owners, starts, base = [], [], [], [], 0
    for k, (_, at, _) in enumerate(items):
        n = int(cuts[k + 1] - cuts[k])
        if n:
            flat += [word[cuts[k] : cuts[k + 1]].astype(np.int32) + 1, np.zeros(window, np.int32)]
            own = np.arange(max(1, n - window + 1))
            suffixes.append(base + own)
            owners.append(np.full(len(own), k, np.int32))
            starts.append(at + own)
            base += n + window
    join = lambda x, kind: np.concatenate(x).astype(kind, copy=False) if x else np.zeros(0, kind)
    flat, suffix, owner, start = join(flat, np.int32), join(suffixes, np.int64), join(owners, np.int32), join(starts, np.int64)
    table = flat[suffix[:, None] + np.arange(window)]
    rows, one, of = np.unique(table, axis=0, return_index=True, return_inverse=True) if len(table) else (table, suffix, suffix)
    order = np.argsort(of.ravel(), kind="stable")
    at = np.searchsorted(of.ravel()[order], np.arange(len(rows) + 1))
    lengths = (rows > 0).sum(1).astype(np.int32)
    width = len(vocabulary) + 1
    pairs = np.unique(rows[lengths > 1, 0].astype(np.int64) * width + rows[lengths > 1, 1]) if window > 1 and len(rows) else np.zeros(0, np.int64)
    single = np.unique(rows[lengths == 1, 0]) if len(rows) else np.zeros(0, np.int32)
    return TestIndex(vocabulary, spelled, spelled_at, pairs, single, flat, suffix[one], lengths, at, owner[order], start[order], [i for i, *_ in items])


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def spelled_alike(data: np.ndarray, first: np.ndarray, past: np.ndarray, word: np.ndarray, spelled: np.ndarray, spelled_at: np.ndarray) -> np.ndarray:
    """Are the words [first, past) of ``data`` really the words they are taken for, byte by byte?"""
    size = past - first
    same = size == np.diff(spelled_at)[word]
    on = np.flatnonzero(same)
    for lo in range(0, len(on), 1 << 16):
        part = on[lo : lo + (1 << 16)]
        n = size[part]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        differs = lowered(data[np.repeat(first[part], n) + step]) != spelled[np.repeat(spelled_at[word[part]], n) + step]
        same[part[np.repeat(np.arange(len(part)), n)[differs]]] = False
    return same


def shard_suffixes(ids: np.ndarray, owner: np.ndarray, index: TestIndex) -> np.ndarray:
    """Start words of the shard's suffixes that share two words (or a one-word item) with some test suffix."""
    width = len(index.vocabulary) + 1
    known = ids > 0
    both = known[:-1] & known[1:] & (owner[:-1] == owner[1:])
    starts = np.flatnonzero(both)
    if len(starts) and len(index.pairs):
        pair = ids[starts].astype(np.int64) * width + ids[starts + 1]
        starts = starts[index.pairs[np.minimum(np.searchsorted(index.pairs, pair), len(index.pairs) - 1)] == pair]
    else:
        starts = np.zeros(0, np.int64)
    if len(index.single):
        starts = np.union1d(starts, np.flatnonzero(np.isin(ids, index.single)))
    return starts


def suffix_array(ids: np.ndarray, owner: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts`` in word order: (their start words, their first ``depth`` words, -1 past the text's end)."""
    at = starts[:, None] + np.arange(depth)
    inside = at < len(ids)
    at = np.minimum(at, max(0, len(ids) - 1))
    table = np.where(inside & (owner[at] == owner[starts][:, None]), ids[at], -1)
    order = np.lexsort(table.T[::-1]) if len(starts) else np.zeros(0, np.int64)
    return starts[order], table[order]


def search(table: np.ndarray, index: TestIndex) -> tuple[np.ndarray, np.ndarray]:
    """Ranges [lo, hi) of the sorted ``table`` whose suffixes begin with each test suffix: binary search, a word at a time.

    The range of the first k words lies within that of the first k - 1, so each step is two binary
    searches over (range, word) keys of one column.
    """
    lo, hi = np.zeros(len(index.begin), np.int64), np.full(len(index.begin), len(table), np.int64)
    for k in range(table.shape[1]):
        on = np.flatnonzero((index.lengths > k) & (lo < hi))
        if not len(on):
            break
        word = index.flat[index.begin[on] + k]
        lo[on], hi[on] = _bisect(table[:, k], word, lo[on], hi[on], False), _bisect(table[:, k], word, lo[on], hi[on], True)
    return lo, hi


def _bisect(column: np.ndarray, key: np.ndarray, lo: np.ndarray, hi: np.ndarray, after: bool) -> np.ndarray:
    lo, hi = lo.copy(), hi.copy()
    while True:
        on = lo < hi
        if not on.any():
            return lo
        mid = (lo + hi) >> 1
        seen = column[np.minimum(mid, len(column) - 1)]
        right = on & ((seen <= key) if after else (seen < key))
        lo = np.where(right, mid + 1, lo)
        hi = np.where(on & ~right, mid, hi)


def longest_matches(place: np.ndarray, length: np.ndarray, item: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, ...]:
    """(item, first, past, offset) of the longest matches that windows at ``place``, each at ``offset`` of an item, are part of.

    Windows that follow each other at the same distance in both texts are one match, extended word by word.
    """
    order = np.lexsort((place, place - offset, item))
    place, length, item, offset = place[order], length[order], item[order], offset[order]
    new = np.concatenate([[True], (item[1:] != item[:-1]) | (place[1:] - offset[1:] != place[:-1] - offset[:-1]) | (place[1:] != place[:-1] + 1)]) if len(place) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(place)) - 1 if len(head) else head
    return item[head], place[head], place[last] + length[last], offset[head]


def _scan(part: pa.RecordBatch, index: TestIndex, window: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Of a slice: words of each text; (text, item, first, past, offset) of all longest matches, places being words of their text."""
    data, bounds = buffers(part.column("text"))
    hashes, owner, first, past = words(data, bounds)
    counts = np.bincount(owner, minlength=part.num_rows)
    none = [np.zeros(0, np.int64)] * 5
    if not len(index.begin) or not len(hashes):
        return counts, none
    at = np.minimum(np.searchsorted(index.vocabulary, hashes), len(index.vocabulary) - 1)
    ids = np.where(index.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)
    starts = shard_suffixes(ids, owner, index)
    # only words near a start can be part of a match; what has a word's hash but not its bytes is another word
    near = np.zeros(len(ids) + window + 1, np.int32)
    np.add.at(near, starts, 1)
    np.add.at(near, starts + window, -1)
    near = np.flatnonzero((np.cumsum(near)[: len(ids)] > 0) & (ids > 0))
    false = near[~spelled_alike(data, first[near], past[near], ids[near] - 1, index.spelled, index.spelled_at)]
    if len(false):
        ids[false] = 0
        starts = shard_suffixes(ids, owner, index)
    starts, table = suffix_array(ids, owner, starts, window)
    lo, hi = search(table, index)
    hit = np.flatnonzero(lo < hi)
    times = hi[hit] - lo[hit]
    suffix, place = np.repeat(hit, times), starts[np.repeat(lo[hit] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))]
    owners = index.at[suffix + 1] - index.at[suffix]
    which = np.repeat(index.at[suffix] - (np.cumsum(owners) - owners), owners) + np.arange(int(owners.sum()))
    place, length = np.repeat(place, owners), np.repeat(index.lengths[suffix], owners)
    item, start, end, offset = longest_matches(place, length, index.items[which], index.offsets[which])
    text = owner[start] if len(start) else start
    heads = np.cumsum(counts) - counts
    return counts, [text, item, start - heads[text], end - heads[text], offset]


_MATCH = pa.struct([("first", pa.int64()), ("past", pa.int64()), ("item_id", pa.string()), ("item_first", pa.int64())])


def _entries(benchmark: DataFrame, window: int, item_col: str, item_text_col: str) -> DataFrame:
    """(item, first, text, weight): the benchmark's items, long ones cut, and the bytes that each takes in the index."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    n = F.regexp_count("text", F.lit(_WORDS))
    short, long = items.where(n <= ITEM_WORDS), items.where(n > ITEM_WORDS)
    step = ITEM_WORDS - window + 1
    cut = long.withColumn("_w", F.regexp_extract_all("text", F.lit(f"({_WORDS})"), F.lit(1))).withColumn("first", F.explode(F.expr(f"sequence(0L, cast(size(_w) as bigint) - {window}, {step}L)")))
    cut = cut.select("item", "first", F.array_join(F.slice("_w", F.col("first").cast("int") + 1, F.lit(ITEM_WORDS)), " ").alias("text"))
    entries = short.select("item", F.lit(0).cast("long").alias("first"), "text").unionByName(cut)
    # a word takes 4 bytes in flat, 40 for the suffix at it and its owner, and, if it is new, its bytes and 24 more
    return entries.withColumn("weight", F.regexp_count("text", F.lit(_WORDS)).cast("long") * 68 + F.octet_length("text") + F.octet_length("item") + 4 * window + 64)


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", index_bytes: int = INDEX_BYTES, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, matches, spans, item_ids of every row, and the columns ``keep``.

    ``matches`` are the longest verbatim matches (first, past, item_id, item_first): words [first, past) of the
    document are those of the item from item_first on, and neither word beside them is part of a common
    window too. ``spans`` is their union, in disjoint ranges; ``item_ids`` are the items that match, each once.

    Each slice of a partition is a shard: a suffix array is built over its words (only suffixes that
    start with two words of some test suffix can matter) and every test suffix is binary-searched in it;
    windows found one after another, in the document and in the item, join into the longest matches. Words
    are compared by hashes and then by their bytes.

    The index of test suffixes is broadcast. The bytes it takes are counted first; if they are more than
    ``index_bytes``, the benchmark is split into parts below that size (items longer than ITEM_WORDS words are
    cut with an overlap), one pass over the documents each, whose matches are joined by row.

    A null text has no words; a null item id is written as an empty string; equal ids of items count
    once; rows of documents with equal or null ids stay apart; an empty benchmark hits nothing; other
    columns are ignored.
    """
    spark = docs.sparkSession
    entries = _entries(benchmark, window, item_col, item_text_col)
    weight = entries.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    n_parts = max(1, -(-2 * int(weight) // index_bytes)) if weight > index_bytes else 1
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(k).alias(f"_kept_{k}") for k in keep])
    kept = [f"_kept_{k}" for k in keep]
    carried = ["doc_id", "text", *kept] if n_parts > 1 else ["doc_id", *kept]
    match = T.StructType([T.StructField("first", T.LongType()), T.StructField("past", T.LongType()), T.StructField("item_id", T.StringType()), T.StructField("item_first", T.LongType())])
    before = T.StructField("matches", T.ArrayType(match))
    for p in range(n_parts):
        part_entries = entries if n_parts == 1 else entries.where(F.pmod(F.xxhash64("item", "first"), F.lit(n_parts)) == p)
        index = spark.sparkContext.broadcast(build_index([(r.item, r.first, r.text) for r in part_entries.select("item", "first", "text").collect()], window))
        own = carried if p < n_parts - 1 else ["doc_id", *kept]
        schema = T.StructType([*[rows.schema[c] for c in own], T.StructField("n_words", T.LongType()), before])

        def run(batches: Iterable[pa.RecordBatch], index=index, own=own, p=p) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text"):
                counts, (text, item, first, past, offset) = _scan(part, index.value, window)
                order = np.argsort(text, kind="stable")
                text, item, first, past, offset = (x[order] for x in (text, item, first, past, offset))
                cuts = np.searchsorted(text, np.arange(part.num_rows + 1))
                ids = np.array(index.value.ids, object)[item] if len(item) else []
                flat = pa.StructArray.from_arrays([pa.array(first, pa.int64()), pa.array(past, pa.int64()), pa.array(ids, pa.string()), pa.array(offset, pa.int64())], fields=list(_MATCH))
                found = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat)
                if p:
                    found = pa.array([a + b for a, b in zip(part.column("matches").to_pylist(), found.to_pylist(), strict=True)], pa.list_(_MATCH))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in own], pa.array(counts, pa.int64()), found], names=[*own, "n_words", "matches"])

        rows = rows.mapInArrow(run, schema)
        if p < n_parts - 1:  # a worker holds one part of the index at a time
            rows = materialise(rows, "decontaminate")
    if entries.where("first > 0").limit(1).count():
        rows = rows.withColumn("matches", _joined("matches"))
    spans = _union(F.transform("matches", lambda m: F.struct(m["first"].alias("first"), m["past"].alias("past"))))
    return rows.select("doc_id", "n_words", F.array_sort("matches").alias("matches"), spans.alias("spans"), F.array_sort(F.array_distinct("matches.item_id")).alias("item_ids"), *kept)


def _joined(matches: str) -> Column:
    """Matches of one item that continue each other at the same distance, as one: they come from entries that overlap."""
    pick = lambda m: F.struct(m["item_id"].alias("item_id"), (m["first"] - m["item_first"]).alias("d"), m["first"].alias("first"), m["past"].alias("past"))
    ordered = F.array_sort(F.transform(matches, pick))
    last = lambda acc: F.element_at(acc, -1)
    follows = lambda acc, x: (F.size(acc) > 0) & (last(acc)["item_id"] == x["item_id"]) & (last(acc)["d"] == x["d"]) & (x["first"] <= last(acc)["past"])
    grown = lambda acc, x: F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(x["item_id"].alias("item_id"), x["d"].alias("d"), last(acc)["first"].alias("first"), F.greatest(last(acc)["past"], x["past"]).alias("past"))))
    empty = F.expr("cast(array() as array<struct<item_id:string,d:bigint,first:bigint,past:bigint>>)")
    done = F.aggregate(ordered, empty, lambda acc, x: F.when(follows(acc, x), grown(acc, x)).otherwise(F.array_append(acc, x)))
    return F.transform(done, lambda m: F.struct(m["first"].alias("first"), m["past"].alias("past"), m["item_id"].alias("item_id"), (m["first"] - m["d"]).alias("item_first")))


def _union(ranges: Column) -> Column:
    """Union of the ranges [first, past), in order and disjoint."""
    last = lambda acc: F.element_at(acc, -1)
    touches = lambda acc, x: (F.size(acc) > 0) & (last(acc)["past"] >= x["first"])
    grown = lambda acc, x: F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last(acc)["first"].alias("first"), F.greatest(last(acc)["past"], x["past"]).alias("past"))))
    empty = F.expr("cast(array() as array<struct<first:bigint,past:bigint>>)")
    return F.aggregate(F.array_sort(ranges), empty, lambda acc, x: F.when(touches(acc, x), grown(acc, x)).otherwise(F.array_append(acc, x)))


def contamination_report(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of what ``find_contamination`` returned."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["past"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
