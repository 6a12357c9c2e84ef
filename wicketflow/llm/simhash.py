"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: the 64 majority bits of the XXH64 hashes of a text's word shingles. Only distinct
fingerprints are compared, so that any number of copies costs one comparison.

Tiles: a fingerprint's tile is the vector of population counts of its four 16-bit quarters. Two
fingerprints at d differing bits have tiles whose counts differ by at most d in sum, so tiles
further apart than the radius are skipped. Each fingerprint goes to its own tile and, for comparison,
to the later ones of the 129 tiles within the radius: a fixed number per fingerprint, whatever the
data. Inside a pair of tiles everything is compared exactly, block by block, with numpy's exclusive-or
and bit counts. A block of pairs gives a spanning forest of its links, never all pairs of a group. Tiles with many fingerprints are
dealt in chunks: the visiting side is spread over chunks, the resident side is joined to each.

Components: alternating large-star and small-star steps on the links between fingerprints, each
written to the shared folder, until nothing changes. No links or labels go to the driver, only counts.

Defined cases: null counts as empty; a text without a word has fingerprint zero and is linked like any
other; fewer words than a shingle give one shingle of them all; repeated rows share fingerprint and
component; null doc_ids are left out when a component's smallest id is taken, and a component that has
no other id gets null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wicketflow.llm.common import ROW, with_row
from wicketflow.scratch import stage

SEED = 42
SHINGLE = 3
RADIUS = 3
_QUARTERS = 4
#: Fingerprints compared with 256 others at a time.
_BLOCK = 2048
#: Keys that share the work of one tile.
_PARTS = 8


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 majority bits of the shingle hashes, as an unsigned integer."""
    # bytes.lower and bytes.split treat exactly A-Z and the six ASCII space characters.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist())])
    ones = np.zeros(64, np.int64)
    octets = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for k in range(0, n, 1 << 16):
        bits = np.unpackbits(octets[k : k + (1 << 16)], axis=1)
        # Sums of up to 255 rows fit a byte, which is how numpy adds them fastest.
        whole = len(bits) // 255 * 255
        if whole:
            ones += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle, seed) for t in batch.column("text").to_pylist()]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("doc_id"), pa.array(signed)], names=["row", "doc_id", "print"])

    return run


def with_fingerprints(keyed: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """row, doc_id and print (the fingerprint as a signed 64-bit number) of a `with_row` table."""
    narrow = keyed.select(ROW, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return narrow.mapInArrow(_fingerprints(shingle, seed), "row bigint, doc_id bigint, print bigint")


def _tile(print_):
    """Population counts of the quarters, five bits each in one number."""
    counts = [F.bit_count(F.shiftrightunsigned(print_, 16 * k).bitwiseAND(F.lit(0xFFFF))) for k in range(_QUARTERS)]
    return sum((c.cast("int") * (32**k) for k, c in enumerate(counts[1:], 1)), counts[0].cast("int"))


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences between a tile and the later tiles within the radius; a pair of tiles is met once."""
    near = [v for v in product(range(-radius, radius + 1), repeat=_QUARTERS) if 0 < sum(map(abs, v)) <= radius]
    return [v for v in near if v > (0,) * _QUARTERS]


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the given links over n nodes."""
    root = list(range(n))

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def compare_blocks(own: np.ndarray, others: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """Spanning links between two arrays of fingerprints (the same one twice: inside it)."""
    links = []
    for i in range(0, len(own), 256):
        rows = own[i : i + 256]
        near = np.bitwise_count(rows[:, None] ^ others[None, :]) <= radius
        if same:
            near = np.triu(near, i + 1)
        a, b = np.nonzero(near)
        if len(a):
            left, right = rows[a], others[b]
            nodes, codes = np.unique(np.concatenate([left, right]), return_inverse=True)
            forest = _forest(len(nodes), codes[: len(a)], codes[len(a) :])
            links += [(nodes[x], nodes[y]) for x, y in forest]
    return links


def _compare(radius: int):
    """Rows come sorted by tile and side: first the tile's own fingerprints, then its visitors.

    Held in memory: the tile's own fingerprints, 8 bytes each, and one batch of visitors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, own, home = None, [], np.empty(0, np.uint64)
        for batch in batches:
            tiles = batch.column("slot").to_numpy()
            visits = batch.column("visits").to_numpy(zero_copy_only=False)
            prints = batch.column("print").to_numpy().view(np.uint64)
            cuts = np.flatnonzero((np.diff(tiles) != 0) | (np.diff(visits.astype(np.int8)) != 0)) + 1
            links = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tiles)]):
                if a == b:
                    continue
                part = prints[a:b]
                if tiles[a] != tile:
                    tile, home = tiles[a], np.empty(0, np.uint64)
                if visits[a]:
                    for k in range(0, len(home), _BLOCK):
                        links += compare_blocks(part, home[k : k + _BLOCK], radius, False)
                else:
                    inside = range(0, len(part), _BLOCK) if tile % _PARTS == 0 else ()
                    for k in range(0, len(home), _BLOCK) if inside else ():
                        links += compare_blocks(part, home[k : k + _BLOCK], radius, False)
                    for k in inside:
                        links += compare_blocks(part[k : k + _BLOCK], part[k : k + _BLOCK], radius, True)
                        links += compare_blocks(part[k : k + _BLOCK], part[k + _BLOCK :], radius, False)
                    home = np.concatenate([home, part])
            if links:
                pairs = np.array(links, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of column `print` as all pairs within the radius would."""
    def spot(visits: bool, step: int, part: int):
        return F.struct(F.lit(visits).alias("visits"), F.lit(step * _PARTS + part).alias("step"))

    near = [sum(d * 32**k for k, d in enumerate(v)) for v in _steps(radius)]
    spots = [spot(False, 0, p) for p in range(_PARTS)] + [spot(True, d, k % _PARTS) for k, d in enumerate(near)]
    placed = (
        prints.select("print").distinct()
        .select("print", (_tile(F.col("print")) * _PARTS).alias("at"), F.explode(F.array(*spots)).alias("s"))
        .select((F.col("at") + F.col("s.step")).alias("slot"), F.col("s.visits").alias("visits"), "print")
    )
    sorted_ = placed.repartition("slot").sortWithinPartitions("slot", "visits", "print")
    return sorted_.mapInArrow(_compare(radius), "a bigint, b bigint")


def components(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """(node, root) for every node in a link; root is the smallest node that links reach.

    Large star: each node links its larger neighbours to its smallest one. Small star: each node
    links its smaller neighbours and itself to the smallest. Both keep components as they are; the
    links become stars around the smallest node in a number of rounds that grows with the logarithm
    of the longest path.
    """
    def smallest(nodes: DataFrame) -> DataFrame:
        low = nodes.groupBy("u").agg(F.min("v").alias("low"))
        return nodes.join(low, "u").withColumn("m", F.least("u", "low"))

    edges = stage(spark, pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = smallest(large)
        edges = stage(
            spark,
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
            .filter("u != v").distinct(),
        )
        # The links of a state that no step changes are (node, smallest node): count and sums stay.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def near_duplicates(keyed: DataFrame, radius: int = RADIUS) -> DataFrame:
    """row number, doc_id, print, root (a component's name), component_id (its smallest doc_id) of a `with_row` table."""
    spark = keyed.sparkSession
    prints = stage(spark, with_fingerprints(keyed))
    roots = components(spark, links(prints, radius))
    lowest = prints.groupBy("print").agg(F.min("doc_id").alias("lowest"))
    rooted = lowest.join(roots, lowest["print"] == roots["node"], "left").select("print", "lowest", F.coalesce("root", "print").alias("root"))
    rooted = rooted.join(rooted.groupBy("root").agg(F.min("lowest").alias("component_id")), "root")
    rooted = rooted.select("print", "root", "component_id")
    return prints.join(rooted, "print").select(F.col("row").alias(ROW), "doc_id", "print", "root", "component_id")


def mark_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    found = near_duplicates(with_row(docs), radius)
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with all its columns."""
    keyed = with_row(docs)
    found = near_duplicates(keyed, radius)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
    kept = found.groupBy("root").agg(F.min(first)[ROW].alias(ROW)).select(ROW)
    return keyed.join(kept, ROW).drop(ROW)
