"""Removal of repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes if it lies in a string of `length` bytes that starts anywhere else too, in the same document
or another. Each start of such a string ("window") is dealt to one place where all equal windows meet:

1. A window's anchor is the 64-byte gram in it with the smallest hash, the leftmost of equals. It follows
   from the window's bytes alone, so equal windows have equal anchors. Windows with the same anchor in a
   document are neighbours and form a context, on average some 170 windows long; every window is in
   exactly one.
2. Anchors met once are done: no window of theirs repeats. Contexts with equal bytes (a 128-bit digest)
   repeat as a whole, however many there are, and one of them stands for all.
3. Anchors with different contexts need a closer look. The contexts' bytes are cut from the texts, dealt by
   anchor, and joined to blocks of about `_BLOCK` bytes. Of a block the Burrows-Wheeler transform is taken
   (suffixes sorted to the depth `length`) and intervals are extended backward, breadth first: each round
   finds the boundaries with the next common prefix length, and rounds stop at `length`. Neighbours without
   a boundary by then share a window.
4. Contexts of one anchor that hold more than a block are divided first, by binary descent over the places
   where the anchor can stand in a window. All windows of a half share the bytes around the anchor that every
   window with such a place holds; only contexts in which these agree stay together. Contexts that agree in
   all bytes of their windows of a half repeat there, and one of them stands for them further on. Groups are
   halved until they fit a block, which goes to the transform, or until all their contexts agree. So a
   context gives two rows a level at most, and no task gathers a hot anchor.

What was found for a context goes to all its documents, and the spans are united in each document. Texts
cross the network twice, compressed.

Defined cases: null and empty texts have no bytes; texts shorter than `length` lose nothing; matches overlap
freely, and long runs of one byte count as repeating themselves; null doc_ids and repeated rows are rows of
their own (a repeated row is a copy); an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.llm.common import ROW, with_row
from wicketflow.scratch import stage

LENGTH = 400
_GRAM = 64
_BLOCK = 1 << 20
#: An odd multiplier and the constants of a mixing step; any would do.
_BASE = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(size, _BASE, np.uint64), np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the gram at every place; equal grams have equal hashes."""
    size = 1 << max(12, int(len(data)).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    h = (total[gram:] - total[:-gram]) * down[: len(data) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(_MIX)
    h ^= h >> np.uint64(29)
    h *= np.uint64(_MIX)
    return h


def contexts(text: bytes, length: int = LENGTH, gram: int = _GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor hash of each context of a text."""
    none = np.empty(0, np.int64)
    if len(text) < length:
        return none, none, none
    h = _hashes(np.frombuffer(text, np.uint8), gram)
    # Ordered by hash, then place: the minimum over a window names its leftmost smallest gram.
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    wide = length - gram + 1
    padded = np.full(-(-len(key) // wide) * wide, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(key)] = key
    folded = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(folded, axis=1).ravel()
    behind = np.minimum.accumulate(folded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(text) - length + 1
    place = (np.minimum(behind[:n], ahead[wide - 1 : wide - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
    many = np.diff(np.concatenate([first, [n]]))
    return first, many, h[place[first]].view(np.int64)


def _digest(data: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(data)
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


_CONTEXTS = "row bigint, first bigint, many int, anchor bigint, c1 bigint, c2 bigint"


def _find_contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            digests: list[bytes] = []
            for row, text in zip(batch.column(ROW).to_pylist(), batch.column("text").to_pylist()):
                data = (text or "").encode()
                first, many, anchor = contexts(data, length)
                if len(first):
                    for column, values in zip(out, (np.full(len(first), row, np.int64), first, many.astype(np.int32), anchor)):
                        column.append(values)
                    digests += [xxhash.xxh3_128_digest(data[a : a + m + length - 1]) for a, m in zip(first.tolist(), many.tolist())]
            if digests:
                pair = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
                columns = [pa.array(np.concatenate(c)) for c in out] + [pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "first", "many", "anchor", "c1", "c2"])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        packed = [pack((t or "").encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("doc_id"), pa.array(packed, pa.binary())], names=["row", "doc_id", "packed"])


_PART = [("anchor", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
         ("row", pa.int64()), ("first", pa.int64()), ("at", pa.int64()), ("many", pa.int64()), ("place", pa.int64()), ("bytes", pa.binary())]
_PARTS = pa.schema(_PART)
_PARTS_DDL = ", ".join(f"{n} {'binary' if n == 'bytes' else 'bigint'}" for n, _ in _PART)


def _part_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += len(row[-1])
        if size > 16 * _BLOCK:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PARTS)], schema=_PARTS)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PARTS)], schema=_PARTS)


def _cut(length: int):
    """Bytes of the wanted contexts, each one part with all places of the anchor, from 0 to `length - _GRAM`."""

    def rows(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row, packed, wanted in zip(*[batch.column(n).to_pylist() for n in ("row", "packed", "wanted")]):
                data = unpack(packed)
                for x in wanted:
                    first, many = x["first"], x["many"]
                    part = data[first : first + many + length - 1]
                    place = _anchor_place(part, length) if x["hot"] else None
                    yield x["anchor"], 0, length - _GRAM + 1, None, None, None, None, row, first, 0, many, place, part

    return lambda batches: _part_batches(rows(batches))


def _anchor_place(part: bytes, length: int) -> int:
    """Where the anchor of a context stands in it."""
    h = _hashes(np.frombuffer(part, np.uint8), _GRAM)[: length - _GRAM + 1]
    return int(np.argmin(h >> np.uint64(32)))


def _halve(length: int):
    """Each part as two, by the place of the anchor in a window, with the digests of what all windows of that
    half would share (w) and of all bytes of the part (f). Windows of a part are numbered by context."""

    def rows(batches):
        names = ("anchor", "low", "high", "row", "first", "at", "many", "place", "bytes")
        for batch in batches:
            for anchor, low, high, row, first, at, many, place, data in zip(*[batch.column(n).to_pylist() for n in names]):
                middle = (low + high) // 2
                for x, y in ((low, middle), (middle, high)):
                    # The window j has the anchor at place - j.
                    a, b = max(at, place - y + 1), min(at + many, place - x + 1)
                    if a < b:
                        part = data[a - at : b - 1 - at + length]
                        core = data[place - x - at : place - y + 1 + length - at]
                        whole = b"%d %d " % (place - a, place - b) + part
                        yield anchor, x, y, *_digest(core), *_digest(whole), row, first, a, b - a, place, part

    return lambda batches: _part_batches(rows(batches))


def sort_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the rotations of `text` (small codes) in the order of their first `depth` codes or more."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    h = 62 // bits
    key = np.zeros(n, np.int64)
    for j in range(h):
        key = (key << bits) | np.roll(text, -j)
    order = np.argsort(key, kind="stable")
    tied = np.concatenate([[False], np.diff(key[order]) == 0])
    rank = np.empty(n, np.int64)
    while True:
        place = np.arange(n)
        place[tied] = 0
        rank[order] = np.maximum.accumulate(place)  # the first place of each group of equals
        if h >= depth:
            return order
        open_ = np.flatnonzero(tied | np.concatenate([tied[1:], [False]]))
        if not len(open_):
            return order
        at = order[open_]
        key = rank[at] * n + rank[(at + h) % n]
        sorted_ = np.argsort(key, kind="stable")
        order[open_] = at[sorted_]
        key = key[sorted_]
        tied = np.zeros(n, bool)
        tied[open_[1:]] = key[1:] == key[:-1]
        h *= 2


def shared_prefixes(text: np.ndarray, least: int) -> np.ndarray:
    """For each start in `text`, whether another start has the same `least` codes; by rotations.

    Backward extension, breadth first: the interval of a string that ends at boundary b and is the
    first of its length to do so shows that the suffixes on the two sides of b share one code less
    than the string has. Round l sets all boundaries with l codes in common.
    """
    order = sort_suffixes(text, least)
    n = len(text)
    last = text[order - 1]  # the transform: the code before each suffix
    step = np.empty(n, np.int64)  # from a suffix's place to that of the suffix one code longer
    step[np.argsort(last, kind="stable")] = np.arange(n)
    found = np.zeros(n + 1, bool)
    found[0] = found[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(least):
        single = high - low == 1
        ends = step[low[single]] + 1
        lows = [ends - 1]
        highs = [ends]
        low, high = low[~single], high[~single]
        if len(low):
            size = high - low
            start = np.cumsum(size) - size
            inside = np.arange(int(size.sum())) - np.repeat(start, size) + np.repeat(low, size)
            group = np.repeat(np.arange(len(low)), size)
            to = step[inside]
            by = np.argsort(to, kind="stable")
            to, group = to[by], group[by]
            cut = np.flatnonzero((np.diff(to) != 1) | (np.diff(group) != 0) | (np.diff(text[order[to]]) != 0)) + 1
            lows.append(to[np.concatenate([[0], cut])])
            highs.append(to[np.concatenate([cut - 1, [len(to) - 1]])] + 1)
        low, high = np.concatenate(lows), np.concatenate(highs)
        fresh = ~found[high]
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
        found[high] = True
    shared = np.zeros(n, bool)
    joined = ~found[1:n]
    shared[order[1:][joined]] = True
    shared[order[:-1][joined]] = True
    return shared


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each byte string, which of its windows occur elsewhere among the given ones."""
    codes = np.frombuffer(b"".join(p + b"\0" for p in parts), np.uint8).astype(np.int64) + 1
    ends = np.cumsum([len(p) + 1 for p in parts])
    codes[ends - 1] = 0  # parts the strings; a window never holds it
    used = np.flatnonzero(np.bincount(codes, minlength=257))
    small = np.zeros(257, np.int64)
    small[used] = np.arange(len(used))
    shared = shared_prefixes(small[codes], length)
    return [shared[e - 1 - len(p) : e - length] for p, e in zip(parts, ends.tolist())]


def _runs(flags: np.ndarray) -> list[list[int]]:
    """[first, end) of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges.reshape(-1, 2).tolist()


_FOUND = "row bigint, first bigint, found array<array<bigint>>"


def _expand(length: int):
    """Parts come sorted by group; blocks end between groups, so equal windows are in one block."""
    schema = pa.schema([("row", pa.int64()), ("first", pa.int64()), ("found", pa.list_(pa.list_(pa.int64())))])
    names = ("anchor", "low", "w1", "w2", "row", "first", "at", "bytes")

    def solve(block):
        flags = repeated_windows([b for *_, b in block], length)
        out = [(row, first, [[a + at, b + at] for a, b in _runs(f)]) for (row, first, at, _), f in zip(block, flags) if f.any()]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema) if out else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, last = [], 0, None
        for batch in batches:
            for *group, row, first, at, data in zip(*[batch.column(n).to_pylist() for n in names]):
                if size >= _BLOCK and group != last:
                    done = solve(block)
                    if done is not None:
                        yield done
                    block, size = [], 0
                block.append((row, first, at, data))
                size, last = size + len(data), group
        if block:
            done = solve(block)
            if done is not None:
                yield done

    return run


def _by_transform(parts: DataFrame, length: int) -> DataFrame:
    group = ("anchor", "low", "w1", "w2")
    ordered = parts.repartition(*group).sortWithinPartitions(*group, "row", "first")
    return ordered.mapInArrow(_expand(length), _FOUND)


def _descend(spark, parts: DataFrame, length: int) -> list[DataFrame]:
    """What is found in the contexts of anchors that hold more than a block."""
    group, kind = ["anchor", "low", "w1", "w2"], ["f1", "f2"]
    found = []
    while parts.take(1):
        halves = stage(spark, parts.mapInArrow(_halve(length), _PARTS_DDL))
        kinds = halves.groupBy(*group, *kind).agg(
            F.count("*").alias("copies"), F.min(F.struct("row", "first")).alias("one"), F.max(F.length("bytes")).alias("size")
        )
        groups = kinds.groupBy(*group).agg(F.count("*").alias("kinds"), F.sum("size").alias("held"))
        # Kinds that are alone with their core repeat nowhere, or as a whole.
        open_ = kinds.join(groups.where("kinds > 1"), group).select(*group, *kind, "one", (F.col("held") > _BLOCK).alias("hot"))
        open_ = stage(spark, open_)
        copied = kinds.where("copies > 1").select(*group, *kind)
        span = F.array(F.array("at", F.col("at") + F.col("many")))
        found.append(halves.join(copied, [*group, *kind], "left_semi").select("row", "first", span.alias("found")))
        ones = open_.select(*group, "one.row", "one.first", "hot")
        going = halves.join(ones, [*group, "row", "first"])
        found.append(_by_transform(going.where("NOT hot"), length))
        parts = stage(spark, going.where("hot").select(*[n for n, _ in _PART]))
    return found


def repeated_spans(docs: DataFrame, packed: DataFrame, length: int = LENGTH) -> DataFrame:
    """row, spans: byte intervals [start, end) of a document that are covered by repeated windows."""
    spark = docs.sparkSession
    all_contexts = stage(spark, docs.select(ROW, "text").mapInArrow(_find_contexts(length), _CONTEXTS))
    again = all_contexts.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    repeated = stage(spark, all_contexts.join(again, "anchor", "left_semi"))
    kinds = repeated.groupBy("anchor", "c1", "c2").agg(
        F.count("*").alias("copies"), F.min(F.struct("row", "first", "many")).alias("one")
    )
    size = F.col("one.many").cast("bigint") + (length - 1)
    different = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum(size).alias("held")).filter("kinds > 1")
    kinds = stage(spark, kinds.join(different, "anchor", "left").select(
        "anchor", "c1", "c2", "copies", "one.row", "one.first", "one.many",
        F.coalesce("kinds", F.lit(1)).alias("kinds"), (F.col("held") > _BLOCK).alias("hot"),
    ))
    wanted = kinds.filter("kinds > 1").groupBy("row").agg(F.collect_list(F.struct("first", "many", "anchor", "hot")).alias("wanted"))
    cut = stage(spark, packed.join(wanted, "row").select("row", "packed", "wanted").mapInArrow(_cut(length), _PARTS_DDL))
    found = [_by_transform(cut.filter("place IS NULL"), length), *_descend(spark, cut.filter("place IS NOT NULL"), length)]
    found = reduce(DataFrame.unionByName, found).groupBy("row", "first").agg(F.flatten(F.collect_list("found")).alias("found"))
    verdicts = kinds.join(found, ["row", "first"], "left").select(
        "anchor", "c1", "c2",
        F.when(F.col("copies") > 1, F.array(F.array(F.lit(0).cast("bigint"), F.col("many").cast("bigint")))).otherwise(F.col("found")).alias("found"),
    ).filter("found IS NOT NULL")
    spans = repeated.join(verdicts, ["anchor", "c1", "c2"]).select(
        "row", F.transform("found", lambda x: F.struct((F.col("first") + x[0]).alias("a"), (F.col("first") + x[1] + (length - 1)).alias("b"))).alias("spans")
    )
    return spans.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for doc_id, packed, spans in zip(*[batch.column(n).to_pylist() for n in ("doc_id", "packed", "spans")]):
            data = unpack(packed)
            runs: list[list[int]] = []
            for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            kept, at = hashlib.sha256(), 0
            for a, b in runs:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            out.append((doc_id, len(data), sum(b - a for a, b in runs), len(runs), kept.hexdigest(), [x for r in runs for x in r]))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]
            )


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (start and end of each removed run)."""
    keyed = with_row(docs).select(ROW, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    packed = keyed.mapInArrow(_pack, "row bigint, doc_id bigint, packed binary")
    spans = repeated_spans(keyed, packed, length)
    return packed.join(spans, "row", "left").select("doc_id", "packed", "spans").mapInArrow(
        _remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, removed array<bigint>"
    )
