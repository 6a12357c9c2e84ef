"""Strings compared block by block, for where keys would bring most of them together anyway.

Strings are dealt to blocks of neighbours in alphabetical order; each two blocks are one group, so what is shuffled are strings, once for
each block, and pairs are made, judged and returned in one place. In a group the strings of the right block are columns, which all take the
next character of a left string at once, in the part of the edit matrix where distances within the limits can run. Left strings of a length are walked as the
tree of what they start with, so that a start in common is done once, and columns too far from a start are left out of all that stands behind it.
Few strings with one start are also walked from behind, as the tree of what they end with, and distances are sums of both rows where they meet.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import accumulate
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.scratch import stage
from wicketflow.session import importable

#: Most strings and most characters of a block, the blocks a table is dealt to, the strings of a block that are not made fewer for that, and ranges of a block.
_BLOCK, _LETTERS, _BLOCKS, _LEAST, _RANGES = 8192, 1 << 21, 8, 512, 4
#: Most tasks, cells of a matrix of characters and pairs of a batch.
_TASKS, _CELLS, _PAIRS = 4096, 1 << 21, 1 << 16
#: Strings with one start that are walked from both ends, and cells of their rows.
_FEW, _ROWS = 64, 1 << 21
#: Columns are left out where no more than this share stays.
_STAYS = 0.9

_SCHEMA = "name1 string, name2 string, similarity double, count1 bigint, count2 bigint"


def _behind(keys: list[str], rows: np.ndarray, advance: Callable[[int, list[tuple[int, str]], np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each key its number and the row behind it, all of a depth at once; what keys start with in common is gone through once."""
    node, going = [0] * len(keys), range(len(keys))
    for depth in range(max(map(len, keys)) + 1):
        yield from ((k, rows[:, node[k]]) for k in going if len(keys[k]) == depth)
        going = [k for k in going if len(keys[k]) > depth]
        if going:
            children: dict[tuple[int, str], int] = {}
            for k in going:
                node[k] = children.setdefault((node[k], keys[k][depth]), len(children))
            rows = advance(depth, list(children), rows)


def _runs(keys: list[str], low: int, high: int, at: int) -> Iterator[tuple[int, int]]:
    """Neighbours with the same character at this place."""
    while low < high:
        upto = low + 1
        while upto < high and keys[upto][at] == keys[low][at]:
            upto += 1
        yield low, upto
        low = upto


class Columns:
    """Strings as columns of characters."""

    def __init__(self, texts: list[str]):
        self.sizes = np.array([len(t) for t in texts], np.int32)
        letters = sorted(set().union(*texts))
        kind = np.uint8 if len(letters) < 255 else np.uint32
        # What is no character of any column gets 0 and the room behind a column the number after the last.
        self.letters = defaultdict(int, {c: k for k, c in enumerate(letters, 1)})
        self.codes = np.full((len(texts), int(self.sizes.max())), len(letters) + 1, kind)
        known = np.array([ord(c) for c in letters], np.uint32)
        for row, t in zip(self.codes, texts):
            row[: len(t)] = np.searchsorted(known, np.frombuffer(t.encode("utf-32-le"), "<u4")) + 1
        self.codes = np.ascontiguousarray(self.codes.T)

    def distances(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Edit distances of each text, given in alphabetical order, to all columns."""
        found = {k: far for k, _, far in self.near(texts, lambda size, other: size + other)}
        yield from (found[k] for k in range(len(texts)))

    def near(self, texts: list[str], limit: Callable[[int, int], int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For texts, given in alphabetical order, their number, the columns within the limit for the two lengths (below 0: none) and the distances."""
        by_size: dict[int, list[int]] = {}
        for k, t in enumerate(texts):
            by_size.setdefault(len(t), []).append(k)
        lengths = np.unique(self.sizes).tolist()
        for size, some in by_size.items():
            limits = np.full(lengths[-1] + 1, -1, np.int32)
            limits[lengths] = [limit(size, m) for m in lengths]
            at = np.flatnonzero(np.abs(self.sizes - size) <= limits[self.sizes])
            if len(at):
                band = _Band(size, at, self.sizes[at], limits[self.sizes[at]], self.codes[:, at], self.letters)
                for k, close, far in _tree([texts[k] for k in some], band):
                    yield some[k], close, far


class _Band:
    """The part of the edit matrices of strings of one length and of some columns where a distance within the limits can run.

    Row i of a matrix has, for the first i characters (or those behind) and what a column starts (or ends) with, from the place
    `i + low` to `i + high`, the sum of both lengths less their distance: a character that stays counts 2, one replaced by another 1.
    Cells outside are farther than any limit.
    """

    def __init__(self, size: int, at: np.ndarray, sizes: np.ndarray, limits: np.ndarray, codes: np.ndarray, letters: dict[str, int]):
        self.size, self.at, self.sizes, self.limits, self.codes, self.letters = size, at, sizes, limits, codes, letters
        longer = sizes - size
        self.low, self.high, self.longest = int((longer - limits).min()) // 2, -(int(-(longer + limits).max()) // 2), int(sizes.max())
        most = size + self.longest + 4 * (self.high - self.low + 1)
        self.kind = np.uint8 if most < 256 else np.uint16 if most < 65536 else np.uint32
        # The room behind a column counts nothing, so a way through it is no shorter than it is.
        self.counts = (np.arange(self.longest)[:, None] < sizes).astype(self.kind)
        # A way through the cell at the place i + d ends at a distance of `2 i + rest - cell` at least.
        rest = np.maximum(longer, 2 * np.arange(self.low, self.high + 1)[:, None] - longer)
        self.top = int(rest.max())
        self.rest, self.needed = (self.top - rest).astype(self.kind), (size + sizes - limits).astype(self.kind)

    def places(self, i: int) -> tuple[int, int]:
        return max(0, i + self.low), min(self.longest, i + self.high) + 1

    def part(self, keep: np.ndarray, i: int, row: np.ndarray) -> tuple[_Band, np.ndarray]:
        """The band of these columns alone and the row in it."""
        part = _Band(self.size, self.at[keep], self.sizes[keep], self.limits[keep], self.codes.take(keep, axis=1), self.letters)
        (low, _), (first, last) = self.places(i), part.places(i)
        return part, row[first - low : last - low].take(keep, axis=2).astype(part.kind, copy=False)

    def start(self, i: int) -> np.ndarray:
        """Row 0 of the starts, or the row behind all of the ends."""
        first, last = self.places(i)
        return np.zeros((last - first, 1, len(self.at)), self.kind)

    def _advanced(self, rows: np.ndarray, characters: list[tuple[int, str]], places: int, both: tuple[slice, slice, slice], alone: tuple[slice, slice]) -> np.ndarray:
        """New rows, each from the row of its parent, by a character of both (cells of the new row, of the parent's, codes) or of the string alone."""
        new = np.empty((places, len(characters), len(self.at)), self.kind)
        new[: both[0].start] = 0
        new[both[0].stop :] = 0
        wins = {}
        for k, (parent, c) in enumerate(characters):
            if c not in wins:
                wins[c] = self.counts[both[2]] + (self.codes[both[2]] == self.letters[c]).view(np.uint8)
            np.add(rows[both[1], parent], wins[c], new[both[0], k])
            np.maximum(new[alone[0], k], rows[alone[1], parent], new[alone[0], k])
        return new

    def forward(self, i: int, characters: list[tuple[int, str]], rows: np.ndarray) -> np.ndarray:
        """Rows i + 1 of starts, each from the row i of its parent and a character."""
        (low, high), (first, last) = self.places(i), self.places(i + 1)
        begin = max(first, 1)
        both = slice(begin - first, last - first), slice(begin - 1 - low, last - 1 - low), slice(begin - 1, last - 1)
        new = self._advanced(rows, characters, last - first, both, (slice(0, high - first), slice(first - low, None)))
        _through(list(new))
        return new

    def backward(self, i: int, characters: list[tuple[int, str]], rows: np.ndarray) -> np.ndarray:
        """Rows i of ends, each from the row i + 1 of its parent and a character."""
        (low, high), (first, last) = self.places(i + 1), self.places(i)
        upto = min(last, high - 1)
        both = slice(0, upto - first), slice(first + 1 - low, upto + 1 - low), slice(first, upto)
        new = self._advanced(rows, characters, last - first, both, (slice(low - first, None), slice(0, last - low)))
        _through(list(new)[::-1])
        return new

    def can(self, i: int, row: np.ndarray) -> np.ndarray:
        """The columns for which some string with this row of its start can be within the limit."""
        first, last = self.places(i)
        most = (row[:, 0] + self.rest[first - i - self.low : last - i - self.low]).max(axis=0)
        return np.flatnonzero(most >= 2 * i + self.top - self.limits)


def _through(rows: list[np.ndarray]) -> None:
    """A cell is no less than the one before it."""
    for before, cells in zip(rows, rows[1:]):
        np.maximum(cells, before, cells)


def _tree(texts: list[str], band: _Band) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For texts of the band's length, in alphabetical order, their number, the columns within the limits and the distances."""
    waiting = [(0, len(texts), 0, band, band.start(0))]
    while waiting:
        low, high, depth, band, row = waiting.pop()
        shared = len(commonprefix([texts[low], texts[high - 1]]))
        for k in range(depth, shared):
            row = band.forward(k, [(0, texts[low][k])], row)
        keep = band.can(shared, row)
        if not len(keep):
            continue
        if len(keep) <= _STAYS * len(band.at):
            band, row = band.part(keep, shared, row)
        if high - low <= max(1, min(_FEW, _ROWS // row.size)) or shared == band.size:
            for k, close, far in _from_both_ends(texts[low:high], shared, band, row):
                yield low + k, close, far
        else:
            waiting.extend((*run, shared, band, row) for run in _runs(texts, low, high, shared))


def _from_both_ends(texts: list[str], depth: int, band: _Band, row: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For texts with a row of what they start with, their number, the columns within the limits and the distances."""
    with_next = [len(commonprefix(pair)) for pair in zip(texts, texts[1:])]
    # A string is walked from the start as far as it goes with another one.
    upto = [max(pair) for pair in zip([depth, *with_next], [*with_next, depth])]
    starts = [t[depth:n] for t, n in zip(texts, upto)]
    rows = dict(_behind(starts, row, lambda k, c, r: band.forward(depth + k, c, r)))
    ends = [t[n:][::-1] for t, n in zip(texts, upto)]
    for k, behind in _behind(ends, band.start(band.size), lambda k, c, r: band.backward(band.size - 1 - k, c, r)):
        both = (rows[k] + behind).max(axis=0)
        close = np.flatnonzero(both >= band.needed)
        if len(close):
            yield k, band.at[close], band.size + band.sizes[close] - both[close]


def _pieces(texts: list[str]) -> Iterator[np.ndarray]:
    """Places of strings, the shorter ones first, some at a time so that their characters fit `_CELLS`."""
    order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
    piece: list[int] = []
    for k in order:
        if piece and (len(piece) + 1) * (len(texts[k]) + 64) > _CELLS:
            yield np.array(piece)
            piece = []
        piece.append(k)
    yield np.array(piece)


def _compare(allowed: Callable[[int, int], int], least: int = 0) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def limit(size: int, other: int) -> int:
        return allowed(min(size, other), max(size, other))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).combine_chunks()
        texts, ids = rows.column("text").to_pylist(), rows.column("id").to_numpy()
        names, counts = rows.column("name").combine_chunks(), rows.column("n").to_numpy()
        size = np.array([len(t) for t in texts], np.int32)
        # The place of each name among the names, by which the lesser one of a pair comes first.
        rank = np.empty(len(texts), np.int32)
        rank[sorted(range(len(texts)), key=names.to_pylist().__getitem__)] = np.arange(len(texts), dtype=np.int32)
        second = rows.column("second").to_numpy(zero_copy_only=False)
        # A block beside itself comes once.
        left = np.array(sorted(np.flatnonzero(~second).tolist(), key=texts.__getitem__))
        right = np.flatnonzero(second) if second.any() else left
        itself = not second.any()

        def found(one: list[int], other: list[np.ndarray], distance: list[np.ndarray]) -> pa.RecordBatch:
            a, b = np.repeat(np.array(one, np.int32), [len(o) for o in other]), np.concatenate(other).astype(np.int32)
            similarity = 1.0 - np.concatenate(distance) / np.maximum(size[a], size[b])
            turned = rank[a] > rank[b]
            a, b = np.where(turned, b, a), np.where(turned, a, b)
            columns = [names.take(pa.array(a)), names.take(pa.array(b)), pa.array(similarity), pa.array(counts[a]), pa.array(counts[b])]
            return pa.RecordBatch.from_arrays(columns, names=["name1", "name2", "similarity", "count1", "count2"])

        for piece in _pieces([texts[k] for k in right.tolist()]):
            at = right[piece]
            one, other, distance, many = [], [], [], 0
            for k, close, far in Columns([texts[k] for k in at.tolist()]).near([texts[k] for k in left.tolist()], limit):
                k, close = left[k], at[close]
                if itself or least:
                    pairs = far >= least
                    if itself:
                        pairs &= ids[close] > ids[k]
                    close, far = close[pairs], far[pairs]
                one.append(k)
                other.append(close)
                distance.append(far)
                many += len(close)
                if many >= _PAIRS:
                    yield found(one, other, distance)
                    one, other, distance, many = [], [], [], 0
            if many:
                yield found(one, other, distance)

    # Spark takes the iterating form by the types of the function's own signature.
    run.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return run


def _numbers(ranges: list[tuple[int, int]], block: int) -> list[tuple[int, int]]:
    """For each range, given with its rows, the block that its middle is in."""
    ends = accumulate(n for _, n in ranges)
    places = [int((end - n / 2) // block) for (_, n), end in zip(ranges, ends)]
    numbers = {place: k for k, place in enumerate(dict.fromkeys(places))}
    return [(r, numbers[place]) for (r, _), place in zip(ranges, places)]


def near_pairs(names: DataFrame, allowed: Callable[[int, int], int], least: int = 0) -> DataFrame:
    """Pairs of `names` (id, name, text, n) whose texts have the least distance or more and are within the edits allowed for their two lengths (-1: none), the lesser name first."""
    importable(names.sparkSession)
    count, letters = names.agg(F.count("*"), F.sum(F.length("text"))).first()
    block = max(1, min(_BLOCK, _LETTERS * count // max(1, letters or 0), max(_LEAST, math.ceil(count / _BLOCKS))))
    spark = names.sparkSession
    # Ranges come from a sample, so they are stored: both uses see the same blocks, which are neighbouring ranges.
    ranges = names.select("id", "name", "text", "n").repartitionByRange(max(1, math.ceil(_RANGES * count / block)), "text")
    stored = stage(spark, ranges.withColumn("range", F.spark_partition_id()))
    numbers = _numbers(sorted((r["range"], r["count"]) for r in stored.groupBy("range").count().collect()), block)
    blocks = max([b for _, b in numbers], default=0) + 1
    own = stored.join(F.broadcast(spark.createDataFrame(numbers, "range int, own int")), "range").drop("range")
    first = own.select("*", F.col("own").alias("a"), F.explode(F.sequence("own", F.lit(blocks - 1))).alias("b"), F.lit(False).alias("second"))
    second = own.where("own > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("a"), F.col("own").alias("b"), F.lit(True).alias("second"))
    # The number is given, as few bytes are much work here: twice the groups, so that few of them meet in a task.
    tasks = min(_TASKS, blocks * (blocks + 1))
    dealt = first.unionByName(second).drop("own").repartition(tasks, "a", "b")
    return dealt.groupBy("a", "b").applyInArrow(_compare(allowed, least), _SCHEMA)
