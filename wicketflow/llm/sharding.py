"""Sharding by sampled splitters, in DataFrame functions only.

Law `bytes`: shards hold contiguous ranges of the keys' order and nearly the same number of bytes.
The key of a document is a digest of its text, so equal texts are neighbours and go together.

1. Sample: a record is drawn with a chance in proportion to its size, so the sample's quantiles are
   quantiles of the bytes. The number drawn follows the number of ranges, not the input.
2. Splitters: the quantiles of the sample cut the order of (key, doc_id, row number) into ranges,
   many more than shards. A record finds its range by binary search in a constant array.
3. Overfull ranges, by exact sums over all records, are sampled again and get more splitters. As the
   order goes on behind the key, a text that a third of all rows share is cut like any other range.
4. Records are summed up inside their range only; with the sums of the ranges before, each record
   knows its place in the whole order. Its middle byte names its shard, so that a shard departs from
   its share by one record at most.
5. A group of equal texts that a border cuts goes to one side as a whole, by its own middle byte,
   if it has at most `SLACK` of a shard; a larger one stays cut.

The text is read once; what follows reads a stored table of five numbers for each document. To the
driver go the splitters and the sums of the ranges (at most `MOST_RANGES`) and one row per shard.

Defined cases: a null text is empty (size 16, checksum 0); a null doc_id comes first; repeated rows
follow each other; a record larger than a shard has a shard alone, neighbours may then be empty; an
empty table gives no rows. Input columns called `shard` or `slot` are replaced, others don't matter.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wicketflow.llm.common import ROW, with_row
from wicketflow.scratch import stage

#: Bytes that a document takes beside its text.
OVERHEAD = 16
#: A group of equal texts up to this share of a shard is not cut.
SLACK = 0.02
#: Ranges for each shard at least; records for each range about; ranges at most, for the driver's sake.
RANGES_PER_SHARD, RECORDS_PER_RANGE, MOST_RANGES = 16, 1_000_000, 65_536
#: Records drawn for each range.
_DRAWS = 8
_LEAST = -(2**63)
_ORDER = ("k", "tie", ROW)
_PLACE = "array<struct<k:bigint,tie:bigint,row:bigint>>"


def text_key(text: Column) -> Column:
    """Sixty bits of a digest of the text; any SQL engine can repeat it."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def text_records(docs: DataFrame) -> DataFrame:
    """A `with_row` table as records: row number, doc_id, key, tie, size, checksum."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(
        ROW, doc_id.alias("doc_id"), text_key(text).alias("k"), F.coalesce(doc_id, F.lit(_LEAST)).alias("tie"),
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def _constant(values: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), kind)


def _place() -> Column:
    return F.struct("k", "tie", F.col(ROW).alias("row"))


def range_of(splitters: list[tuple[int, int, int]]) -> Column:
    """How many splitters are not above a record, by binary search."""
    if not splitters:
        return F.lit(0)
    cuts = _constant([dict(zip(("k", "tie", "row"), s)) for s in splitters], _PLACE)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(splitters).bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda found, step: F.when(F.get(cuts, found + step - 1) <= _place(), found + step).otherwise(found)
    )


def draw_splitters(records: DataFrame, total: int, ranges: int, seed: int) -> list[tuple[int, int, int]]:
    """Quantile borders of a size-weighted sample of `records`, which hold `total` bytes."""
    share = F.col("size") * (ranges * _DRAWS / max(total, 1))
    chance = F.pmod(F.xxhash64(*_ORDER, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    # A record that expects more than one draw is drawn once and counts for as many.
    drawn = records.where(chance < share).select(*_ORDER, F.greatest(share, F.lit(1.0)).alias("weight"))
    ordered = Window.orderBy(*_ORDER)
    sums = drawn.select(
        _place().alias("place"), F.sum("weight").over(ordered.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.sum("weight").over(Window.partitionBy()).alias("all"),
    )
    quantile = F.floor(F.col("before") * ranges / F.col("all"))
    borders = sums.where("before IS NOT NULL").groupBy(quantile.alias("q")).agg(F.min("place").alias("place"))
    return sorted(tuple(r.place) for r in borders.collect())


def split_ranges(records: DataFrame, ranges: int, rounds: int = 8) -> tuple[list[tuple[int, int, int]], list]:
    """Splitters such that no range holds much more than its share, one record aside; exact (bytes, rows) of each range."""
    total = records.agg(F.sum("size")).first()[0] or 0
    limit = 2 * total / ranges
    splitters = draw_splitters(records, total, ranges, 0)
    for seed in range(1, rounds + 1):
        known = records.withColumn("range", range_of(splitters))
        sums = {
            r.range: r for r in known.groupBy("range").agg(
                F.sum("size").alias("bytes"), F.count("*").alias("records"), F.max("size").alias("largest")
            ).collect()
        }
        overfull = {k: r.bytes for k, r in sums.items() if r.bytes - r.largest > limit}
        if not overfull or seed == rounds or len(splitters) > 2 * MOST_RANGES:
            break
        inside = known.where(F.array_contains(_constant(sorted(overfull), "array<int>"), F.col("range")))
        held = sum(overfull.values())
        # No border may fall on the first record of all, or a range would stay empty; that does no harm.
        more = draw_splitters(inside, held, max(2 * len(overfull), round(2 * held / limit)), seed)
        if not set(more) - set(splitters):
            break
        splitters = sorted({*splitters, *more})
    empty = (0, 0)
    return splitters, [(sums[k].bytes, sums[k].records) if k in sums else empty for k in range(len(splitters) + 1)]


def _running(values) -> list[int]:
    sums, held = [], 0
    for v in values:
        sums.append(held)
        held += v
    return sums


def _by_number(values: dict[int, int], key: Column) -> Column:
    """A look-up in a small table of numbers; null where it has none."""
    if not values:
        return F.lit(None).cast("bigint")
    kind = "map<string,bigint>"
    return F.try_element_at(_constant({str(k): v for k, v in values.items()}, kind), key.cast("string"))


def assign(spark: SparkSession, records: DataFrame, shards: int) -> DataFrame:
    """`records` with shard (from 0) and slot (gapless from 0 inside the shard, in the keys' order)."""
    records = stage(spark, records)
    n = records.count()
    ranges = min(MOST_RANGES, max(RANGES_PER_SHARD * shards, n // RECORDS_PER_RANGE))
    splitters, sums = split_ranges(records, ranges)
    total = max(1, sum(b for b, _ in sums))
    inside = Window.partitionBy("range").orderBy(*_ORDER)
    first = lambda k: F.get(_constant(_running(s[k] for s in sums), "array<bigint>"), F.col("range"))
    middle = lambda start, size: F.least(F.lit(shards - 1), F.expr(f"div((2 * {start} + {size}) * {shards}L, {2 * total}L)"))
    placed = (
        records.withColumn("range", range_of(splitters))
        .withColumn("start", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .withColumn("number", F.row_number().over(inside) - 1)
        .withColumn("start", F.col("start") + first(0))
        .withColumn("number", F.col("number") + first(1))
        .withColumn("shard", middle("start", "size"))
    )
    placed = stage(spark, placed.drop("range", "tie"))
    ends = placed.groupBy("shard").agg(F.min_by("k", "start").alias("lo"), F.max_by("k", "start").alias("hi")).orderBy("shard").collect()
    cut = sorted({a.hi for a, b in zip(ends, ends[1:]) if a.hi == b.lo})
    groups = placed.where(F.array_contains(_constant(cut, "array<bigint>"), F.col("k"))).groupBy("k").agg(
        F.min("start").alias("start"), F.sum("size").alias("size")
    )
    whole = groups.where(F.col("size") * shards <= SLACK * total).select("k", middle("start", "size").alias("shard")).collect() if cut else []
    settled = placed.withColumn("shard", F.coalesce(_by_number({r.k: r.shard for r in whole}, F.col("k")), "shard"))
    firsts = {r.shard: r.first for r in settled.groupBy("shard").agg(F.min("number").alias("first")).collect()}
    slot = F.col("number") - _by_number(firsts, F.col("shard"))
    return settled.withColumn("slot", slot).withColumn("shard", F.col("shard").cast("int")).drop("start", "number", "k")


def plan_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: this law moves rows when it grows)."""
    placed = assign(docs.sparkSession, text_records(with_row(docs.select("doc_id", "text"))), shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """The documents with all their columns, their shard and their slot in it."""
    keyed = with_row(docs.drop("shard", "slot"))
    placed = assign(docs.sparkSession, text_records(keyed), shards).select(ROW, "shard", "slot")
    return keyed.join(placed, ROW).drop(ROW)


def write_shards(docs: DataFrame, folder: str, shards: int = 40) -> None:
    """A folder `shard=N` for each shard, its documents in the order of their slots.

    Rows of a shard are dealt out by parts of 100,000 slots, so a shard is written by many tasks.
    """
    part = F.floor(F.col("slot") / 100_000)
    dealt = shard(docs, shards).withColumn("part", part).repartition("shard", "part").sortWithinPartitions("shard", "slot")
    dealt.drop("part").write.partitionBy("shard").parquet(folder)
