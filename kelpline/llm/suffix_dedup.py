"""Removal of repeated byte strings by a hash-compared suffix sort."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.llm.bytetools import _BASE, _INVERSE, buffers, mix, powers, slices
from kelpline.llm.storage import bucketed, materialise

#: Bytes of the sampled strings; any repeated string of ``length`` bytes holds the one of least hash in it.
SAMPLE = 64
#: Places of one sample that a task takes at once; of more, equal surroundings are merged, and the rest is told apart by longer samples.
HOT = 256
_TILE = 1 << 18
_PLACE = np.uint64((1 << 20) - 1)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, modulo 2**64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), dtype=np.uint64, out=out[1:])
    return out


def substring_hashes(prefix: np.ndarray, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Hashes of the strings of ``size`` bytes at ``start``: two prefix hashes and a shift back to the start."""
    return (prefix[start + size] - prefix[start]) * powers(_INVERSE, len(prefix))[start]


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: the least to the end of a block and from the start of the next."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    onward = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], onward[width - 1 : width - 1 + n])


def pieces(data: np.ndarray, length: int, sample: int = SAMPLE) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows of ``length`` bytes of one text, in runs that share their least string of ``sample`` bytes.

    Yields arrays (sample hash, first window, number of windows, place of the sample in the run, whether it
    is in it twice). Runs are at most as long as a window has samples; tiles keep the memory bounded.
    """
    wide = length - sample + 1
    for lo in range(0, len(data) - length + 1, _TILE):
        part = data[lo : min(len(data), lo + _TILE + length - 1)]
        prefix = prefix_hashes(part)
        hashes = mix(substring_hashes(prefix, np.arange(len(part) - sample + 1), sample))
        ranked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        least = sliding_least(ranked, wide)
        place = (least & _PLACE).astype(np.int64)
        value = hashes[place]
        run = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        sizes = np.diff(np.append(run, len(value)))
        cuts = -(-sizes // wide)
        first = np.repeat(run, cuts) + wide * (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts))
        last = np.minimum(first + wide, np.repeat(run + sizes, cuts))
        twice = place[first] != place[last - 1]
        yield value[first], first + lo, last - first, place[first] - first, twice


class Contexts:
    """Pieces of texts around equal samples, in groups: a buffer of their bytes with prefix hashes over it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, place: np.ndarray, group: np.ndarray) -> None:
        self.data, self.start, self.end = data, offsets[:-1], offsets[1:]
        self.at = self.start + place
        self.group = group
        self.prefix = prefix_hashes(data)

    def common(self, x: np.ndarray, y: np.ndarray, left: bool) -> np.ndarray:
        """Common extension of rows x and y from their sample to the right, or to the left: binary search over prefix hashes."""
        if left:
            cap = np.minimum(self.at[x] - self.start[x], self.at[y] - self.start[y])
        else:
            cap = np.minimum(self.end[x] - self.at[x], self.end[y] - self.at[y])
        lo, hi = np.zeros_like(cap), cap.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            a, b = (self.at[x] - mid, self.at[y] - mid) if left else (self.at[x], self.at[y])
            same = substring_hashes(self.prefix, a, mid) == substring_hashes(self.prefix, b, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def less(self, x: np.ndarray, y: np.ndarray, left: bool) -> np.ndarray:
        """Does row x's extension come before row y's? One common extension, then one byte."""
        n = self.common(x, y, left)
        if left:
            a, b, done_x, done_y = self.at[x] - n - 1, self.at[y] - n - 1, self.at[x] - n == self.start[x], self.at[y] - n == self.start[y]
        else:
            a, b, done_x, done_y = self.at[x] + n, self.at[y] + n, self.at[x] + n == self.end[x], self.at[y] + n == self.end[y]
        top = len(self.data) - 1
        return np.where(done_x | done_y, done_x & ~done_y, self.data[np.clip(a, 0, top)] < self.data[np.clip(b, 0, top)])

    def sort(self, left: bool) -> np.ndarray:
        """Rows in order of their extensions, group by group: a mergesort of all groups at once.

        Each level merges neighbouring runs; a row's place is its own rank and its rank in the other
        run, found by binary search.
        """
        n = len(self.group)
        order = np.arange(n)
        first = np.flatnonzero(np.concatenate([[True], self.group[1:] != self.group[:-1]]))
        sizes = np.diff(np.append(first, n))
        base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        within = np.arange(n) - base
        width = 1
        while width < sizes.max(initial=0):
            run = within // width
            own = within % width
            other = base + (run ^ 1) * width
            lo = np.zeros(n, np.int64)
            hi = np.clip(base + size - other, 0, width)
            after = run % 2 == 1  # of equal ones those of the earlier run come first
            while True:
                on = np.flatnonzero(lo < hi)
                if not len(on):
                    break
                mid = (lo[on] + hi[on]) >> 1
                mine, theirs = order[on], order[other[on] + mid]
                right = np.where(after[on], ~self.less(mine, theirs, left), self.less(theirs, mine, left))
                lo[on] = np.where(right, mid + 1, lo[on])
                hi[on] = np.where(right, hi[on], mid)
            moved = np.empty(n, np.int64)
            moved[base + (run // 2) * 2 * width + own + lo] = order
            order = moved
            width *= 2
        return order

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Are the bytes really equal? (a, b: places in the buffer)"""
        out = np.ones(len(a), bool)
        for lo in range(0, len(a), 8192):
            s = size[lo : lo + 8192]
            owner = np.repeat(np.arange(len(s)), s)
            step = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
            differs = self.data[a[lo : lo + 8192][owner] + step] != self.data[b[lo : lo + 8192][owner] + step]
            out[lo + np.unique(owner[differs])] = False
        return out

    def repeated(self, length: int, twice: np.ndarray, again: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, from, to): byte ranges of rows, from their start, that windows found elsewhere in the group cover.

        A row's neighbours in suffix order to the right share the longest right extension with it, those in
        order to the left the longest left one. A range that a neighbour shares on both sides is repeated
        if it has ``length`` bytes, and none reaches further than the longest ones. Where the two
        don't settle it, and in groups with a sample that is in a run twice, all windows are compared. Rows
        that are known to occur ``again`` as a whole are repeated as a whole.
        """
        n = len(self.group)
        best_left, best_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        got_left, got_right = np.full(n, -1), np.full(n, -1)
        doubt = np.isin(self.group, self.group[twice])
        for left in (False, True):
            order = self.sort(left)
            x, y = order[:-1], order[1:]
            on = self.group[x] == self.group[y]
            x, y = x[on], y[on]
            l, r = self.common(x, y, True), self.common(x, y, False)
            for a, b in ((x, y), (y, x)):
                np.maximum.at(*((best_left, a, l) if left else (best_right, a, r)))
                long = l + r >= length
                true = self.equal(self.at[a[long]] - l[long], self.at[b[long]] - l[long], (l + r)[long])
                doubt[a[long][~true]] = True
                np.maximum.at(got_left, a[long], l[long])
                np.maximum.at(got_right, a[long], r[long])
        possible = best_left + best_right >= length
        doubt |= possible & ((got_left < best_left) | (got_right < best_right))
        doubt &= ~again
        settled, whole = np.flatnonzero(possible & ~doubt & ~again), np.flatnonzero(again)
        place = self.at - self.start
        rows, begin, past = [settled, whole], [place[settled] - best_left[settled], 0 * whole], [place[settled] + best_right[settled], (self.end - self.start)[whole]]
        if doubt.any():
            member = np.isin(self.group, self.group[doubt])
            a, b, c = self.windows(np.flatnonzero(member), length)
            keep = doubt[a]
            rows.append(a[keep])
            begin.append(b[keep])
            past.append(c[keep])
        return np.concatenate(rows), np.concatenate(begin), np.concatenate(past)

    def windows(self, rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``repeated``, from the hashes of all windows of ``rows``; equal hashes are verified byte by byte."""
        count = self.end[rows] - self.start[rows] - length + 1
        owner = np.repeat(rows, count)
        start = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + self.start[owner]
        hashes = substring_hashes(self.prefix, start, length)
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        x, y = order[:-1][same], order[1:][same]
        true = self.equal(start[x], start[y], np.full(len(x), length))
        hit = np.zeros(len(start), bool)
        hit[x[true]] = hit[y[true]] = True
        on = np.flatnonzero(hit)
        return owner[on], start[on] - self.start[owner[on]], start[on] - self.start[owner[on]] + length


def _unpacked(column: pa.Array) -> list[np.ndarray]:
    codec = pa.Codec("zstd")
    return [np.frombuffer(codec.decompress(x[8:], int.from_bytes(x[:8], "little")), np.uint8) for x in column.to_pylist()]


def _packed(texts: DataFrame, length: int) -> DataFrame:
    """(key, packed) of all texts of at least ``length`` bytes: SHA-256, and the compressed bytes after their number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for part in slices(batches, "text"):
            data, at = buffers(part.column("text"))
            raw = [data[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]
            raw = [x for x in raw if len(x) >= length]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(x).digest() for x in raw], pa.binary()), pa.array([len(x).to_bytes(8, "little") + codec.compress(x, asbytes=True) for x in raw], pa.binary())], names=["key", "packed"])

    return texts.mapInArrow(run, "key binary, packed binary")


def _samples(texts: DataFrame, length: int) -> DataFrame:
    """(sample, key, first, windows, place, twice) of every piece of every text (key, packed)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                for sample, first, windows, place, twice in pieces(_unpacked(part.column("packed"))[0], length):
                    key = pa.array(part.column("key").to_pylist() * len(sample), pa.binary())
                    where = (first.astype(np.int64) << 18) | (windows << 9) | (place << 1) | twice
                    yield pa.RecordBatch.from_arrays([pa.array(sample.view(np.int64)), key, pa.array(where)], names=["sample", "key", "place"])

    return texts.mapInArrow(run, "sample long, key binary, place long")


def _joined(texts: DataFrame, places: DataFrame) -> DataFrame:
    """(key, packed, places) of the texts that have places (key, sample, place)."""
    lists = places.groupBy("key").agg(F.collect_list(F.struct("sample", "place")).alias("places"))
    return texts.join(lists, "key").select("key", "packed", "places")


def _placed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for k in range(batch.num_rows):
            part = batch.slice(k, 1)
            flat = part.column("places").flatten()
            sample, place = (flat.field(f).to_numpy(zero_copy_only=False) for f in (0, 1))
            yield part.column("key")[0].as_py(), _unpacked(part.column("packed"))[0], sample, place


class _Merged:
    """Pieces (sample, key, place, again, bytes) of which equal ones are merged while they are held.

    Of equal bytes the first goes on, told that it occurs ``again``; the others are settled, and go on as
    places without bytes, under samples of their own that spread them.
    """

    LIMIT = 16 << 20

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.first: dict[bytes, int] = {}
        self.kept: list[list] = []
        self.settled: list[tuple] = []
        self.size = 0

    def add(self, sample: int, key: bytes, place: int, again: bool, raw: bytes) -> None:
        at = self.first.setdefault(raw, len(self.kept))
        if at == len(self.kept):
            self.kept.append([sample, key, place, again, raw])
            self.size += len(raw) + 100
        else:
            self.kept[at][3] = True
            self.settled.append((key, place))
            self.size += 60

    def flush(self) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(self.kept), 20_000):
            sample, key, place, again, raw = zip(*self.kept[lo : lo + 20_000], strict=True)
            yield _piece_batch(np.array(sample), key, np.array(place), again, raw)
        for lo in range(0, len(self.settled), 50_000):
            key, place = zip(*self.settled[lo : lo + 50_000], strict=True)
            where = np.array(place)
            spread = mix(where.view(np.uint64) ^ mix(np.frombuffer(b"".join(k[:8] for k in key), np.uint64))).view(np.int64)
            yield _piece_batch(spread, key, where, [True] * len(key), [None] * len(key))
        self.clear()


def _piece_batch(sample: np.ndarray, key, place: np.ndarray, again, raw) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(sample, pa.int64()), pa.array(key, pa.binary()), pa.array(place, pa.int64()), pa.array(again, pa.bool_()), pa.array(raw, pa.binary())], names=["sample", "key", "place", "again", "bytes"])


_PIECES = "sample long, key binary, place long, again boolean, bytes binary"


def _pieces_of(texts: DataFrame, length: int) -> DataFrame:
    """(sample, key, place, again, bytes): the bytes that each piece's windows cover, equal ones of a task merged."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Merged()
        for key, data, sample, place in _placed(batches):
            first, size = place >> 18, ((place >> 9) & 511) + length - 1
            for s, p, a, n in zip(sample.tolist(), place.tolist(), first.tolist(), size.tolist(), strict=True):
                held.add(s, key, p, False, data[a : a + n].tobytes())
                if held.size > held.LIMIT:
                    yield from held.flush()
        yield from held.flush()

    return texts.mapInArrow(run, _PIECES)


def _finer(rows: DataFrame, length: int, sample: int) -> DataFrame:
    """The same windows as the pieces in ``rows`` have, in pieces by longer samples, equal ones of a task merged."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Merged()
        for batch in batches:
            data, at = buffers(batch.column("bytes"))
            for k, (key, place, again) in enumerate(zip(batch.column("key").to_pylist(), batch.column("place").to_pylist(), batch.column("again").to_pylist(), strict=True)):
                own = data[at[k] : at[k + 1]]
                for name, first, windows, inside, twice in pieces(own, length, sample):
                    where = (first.astype(np.int64) + (place >> 18) << 18) | (windows << 9) | (inside << 1) | twice
                    for s, p, a, n in zip(name.view(np.int64).tolist(), where.tolist(), first.tolist(), (windows + length - 1).tolist(), strict=True):
                        held.add(s, key, p, again, own[a : a + n].tobytes())
            if held.size > held.LIMIT:
                yield from held.flush()
        yield from held.flush()

    return rows.mapInArrow(run, _PIECES)


def _ranges(contexts: DataFrame, length: int, rows: int = 8192) -> DataFrame:
    """(key, first, past) of the bytes that repeated windows cover; tasks work on whole groups of ``sample``, many at a time."""

    def work(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        place, keys = table.column("place").to_numpy(), table.column("key").chunk(0)
        with_bytes = np.flatnonzero(table.column("bytes").is_valid().to_numpy(zero_copy_only=False))
        settled = np.flatnonzero(table.column("bytes").is_null().to_numpy(zero_copy_only=False))
        row, first, past = settled, 0 * settled, ((place[settled] >> 9) & 511) + length - 1
        if len(with_bytes):
            part = table.take(pa.array(with_bytes)).combine_chunks()
            data, at = buffers(part.column("bytes").chunk(0))
            of = place[with_bytes]
            again = part.column("again").to_numpy(zero_copy_only=False).astype(bool)
            r, a, b = Contexts(data, at, (of >> 1) & 255, part.column("sample").to_numpy()).repeated(length, (of & 1).astype(bool), again)
            row, first, past = np.concatenate([row, with_bytes[r]]), np.concatenate([first, a]), np.concatenate([past, b])
        return pa.RecordBatch.from_arrays([keys.take(pa.array(row)), pa.array((place >> 18)[row] + first), pa.array((place >> 18)[row] + past)], names=["key", "first", "past"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                sample = part.column("sample").to_numpy()
                # all but the last group of this part are whole now
                cut = int(np.searchsorted(sample, sample[-1]))
                if held and (cut or held[-1].column("sample")[0].as_py() != sample[0]):
                    if cut:
                        held.append(part.slice(0, cut))
                    yield work(pa.Table.from_batches(held))
                    held = []
                elif cut:
                    yield work(pa.Table.from_batches([part.slice(0, cut)]))
                held.append(part.slice(cut))
        if held:
            yield work(pa.Table.from_batches(held))

    return contexts.repartition("sample").sortWithinPartitions("sample").mapInArrow(run, "key binary, first long, past long")


def _hot_ranges(texts: DataFrame, length: int, hot: int) -> list[DataFrame]:
    """(key, first, past) for the pieces of samples that occur very often, as parts of one result.

    Equal pieces of a task are merged, as common strings mostly stand in equal surroundings. Samples that are then
    left with up to ``hot`` pieces are sorted as all others. The pieces of the rest are cut anew by samples of 128
    and 192 bytes, each of which has fewer places, and at last into single windows, which are equal or not by all their bytes.
    """
    whole = lambda df: df.select("key", F.shiftright("place", 18).alias("first"), (F.shiftright("place", 18) + F.shiftright("place", 9).bitwiseAND(511) + (length - 1)).alias("past"))
    found, rows = [], _pieces_of(texts, length)
    for sample in [*range(2 * SAMPLE, length, SAMPLE), length]:
        rows = materialise(rows, "suffix-hot")
        found.append(whole(rows.where("bytes is null")))
        rows = rows.where("bytes is not null")
        many = materialise(rows.groupBy("sample").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot).select("sample"), "suffix-hot-samples")
        found.append(_ranges(rows.join(many, "sample", "left_anti"), length))
        if many.isEmpty():
            return found
        rows = _finer(rows.join(many, "sample", "left_semi"), length, sample)
    rows = materialise(rows, "suffix-windows")
    found.append(whole(rows.where("again")))
    # at most one row of a window from each round of a task is not settled yet
    groups = rows.where("bytes is not null").groupBy("bytes").agg(F.collect_list(F.struct("key", "place", "again")).alias("places")).where(F.size("places") > 1)
    found.append(whole(groups.select(F.explode("places").alias("p")).select("p.*").where("not again")))
    return found


def remove_repeats(df: DataFrame, *, length: int = 200, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row (and ``kept``, the bytes left, if ``with_text``).

    Each byte is removed that is covered by a string of ``length`` bytes which also starts anywhere else,
    in the same text or another. Equal texts are one text with copies: if it is long enough, all of it goes.
    Of each window of ``length`` bytes the string of SAMPLE bytes with the least hash is its sample, so equal
    windows have equal samples, and one in seventy places is a sample. Only places whose sample
    occurs again are taken further: the bytes around them meet by sample, are sorted as suffixes to the
    right and to the left by a mergesort whose comparisons are binary searches over prefix hashes, and the
    common extensions of neighbours, verified byte by byte, are the repeats. Samples of more than ``hot`` places
    are first told apart by merging equal surroundings and by longer samples (see ``_hot_ranges``).

    Texts are stored once, compressed and bucketed by their SHA-256, in the shared folder, and both joins with
    places and ranges read the buckets without moving the texts. Null texts count as empty; shorter
    texts stay whole; equal rows are separate rows; null ids are kept; columns that are not named are ignored.
    """
    if not SAMPLE < length <= SAMPLE + 255:
        raise ValueError(f"length must be from {SAMPLE + 1} to {SAMPLE + 255}")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    whole = [text.alias("whole")] if with_text else []
    rows = df.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"), *whole)
    packed = _packed(df.select(F.col(text_col).alias("text")), length)
    packed = packed.groupBy("key").agg(F.first("packed").alias("packed"), F.count(F.lit(1)).alias("copies"))
    texts = bucketed(packed, "key", "texts")
    places = _samples(texts.select("key", "packed"), length)
    again = materialise(places.groupBy("sample").agg(F.sum(1 + F.col("place").bitwiseAND(1)).alias("n")).where("n > 1"), "suffix-samples")
    repeated = materialise(places.join(again, "sample").select("sample", "key", "place", "n"), "suffix-places")
    contexts = _pieces_of(_joined(texts, repeated.where(F.col("n") <= hot)), length)
    ranges = [_ranges(contexts, length)]
    if again.where(F.col("n") > hot).limit(1).count():
        ranges += _hot_ranges(_joined(texts, repeated.where(F.col("n") > hot)), length, hot)
    ranges = reduce(DataFrame.unionByName, ranges)
    ranges = materialise(ranges, "suffix-ranges").groupBy("key").agg(F.collect_list(F.struct("first", "past")).alias("ranges"))
    touched = texts.join(ranges, "key", "left").where((F.col("copies") > 1) | F.col("ranges").isNotNull())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                data = _unpacked(part.column("packed"))[0]
                gone = np.zeros(len(data) + 1, np.int64)
                if part.column("copies")[0].as_py() > 1:
                    gone[0], gone[-1] = 1, -1
                else:
                    flat = part.column("ranges").flatten()
                    np.add.at(gone, flat.field(0).to_numpy(), 1)
                    np.add.at(gone, flat.field(1).to_numpy(), -1)
                out = np.cumsum(gone)[:-1] > 0
                left = data[~out].tobytes()
                spans = int(out[0]) + int((out[1:] & ~out[:-1]).sum())
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([int(out.sum())]), pa.array([spans]), pa.array([hashlib.sha256(left).hexdigest()]), pa.array([left if with_text else None], pa.binary())], names=["key", "n_removed", "n_spans", "kept_sha", "left"])

    done = touched.select("key", "packed", "copies", "ranges").mapInArrow(run, "key binary, n_removed long, n_spans long, kept_sha string, left binary")
    columns = ["doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha", F.lower(F.hex("key"))).alias("kept_sha256")]
    return rows.join(done, "key", "left").select(*columns, *([F.coalesce("left", "whole").alias("kept")] if with_text else []))
