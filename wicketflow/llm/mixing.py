"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share the words of
all sources by weight; a target stops at `most` times its source's words and the excess goes to the
others by weight, until none is above.

Sampling: every document of a source expects `target / source words` copies. Along a fixed order of
the source's documents the expected copies are summed up, one random offset per source is added, and
a document is emitted once for each whole number that its step crosses. The order goes by size, so
the words taken differ from the target by about one step in size, not by chance.

The running sum inside a source has two levels, so that a source with a third of all rows is not one
task: documents are grouped by (source, size class, hash of doc_id), groups are counted with map-side
combine, the counts are summed up within the source (a few thousand small rows at most), and rows are
numbered only inside their group.

Defined cases: null text has size 0; a null source is a source of its own, the last; null doc_ids
come first; repeated rows are numbered one after the other, which of equal rows gets the copy makes
no difference; a source without a word has target 0 and takes nothing; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.llm.common import WORD

#: Weights of the sources in turn.
WEIGHTS = (5, 2, 1)
#: Hash groups inside a size class of a source.
SPREAD = 64
_STEPS = 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _hash(value: Column, digits: int) -> Column:
    """A number from the first hex digits of a digest; any SQL engine can repeat it."""
    return F.conv(F.substring(F.md5(value.cast("string").cast("binary")), 1, digits), 16, 10).cast("bigint")


def source_targets(totals: DataFrame, most: int = 3) -> DataFrame:
    """`totals` (source, source_size) with weight and target: one row per source.

    The level L solves sum(min(weight * L, most * size)) = all words. Sources in order of
    most * size / weight reach their limit one after the other, so running sums find L.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("rank", F.row_number().over(ordered))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    ratio = F.col("limit") / F.col("weight")
    before = Window.orderBy(ratio, "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(ratio, "rank").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(after)
    levels = capped.withColumn("level", level).withColumn("free", ratio >= F.col("level"))
    found = F.min(F.when(F.col("free"), F.struct(ratio.alias("r"), "rank", "level"))).over(everything)["level"]
    return levels.withColumn("found", found).select(
        "source", "source_size", "weight",
        F.when(F.col("found").isNull(), F.col("limit").cast("double"))
        .otherwise(F.least(F.col("limit").cast("double"), F.col("weight") * F.col("found"))).alias("target"),
    )


def with_copies(docs: DataFrame, most: int = 3, seed: int = 7) -> DataFrame:
    """`docs` (doc_id, source, text, ...) with size, source_size, target and copies.

    Columns of these four names in the input are replaced.
    """
    keys = ["source", "size_class", "spread"]
    bits = F.bin("size")
    size_class = F.length(bits) * 2 + (F.substring(bits, 2, 1) == "1").cast("int")
    sized = (
        docs.drop("size", "source_size", "target", "copies", "size_class", "spread", "before", "place")
        .withColumn("size", word_count(F.col("text")))
        .withColumn("size_class", size_class)
        .withColumn("spread", F.coalesce(_hash(F.col("doc_id"), 8) % SPREAD, F.lit(0)))
    )
    groups = sized.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    up_to = Window.partitionBy("source").orderBy("size_class", "spread").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(groups.groupBy("source").agg(F.sum("words").alias("source_size")), most)
    placed = groups.withColumn("before", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
    offsets = placed.select(*keys, "before").alias("g").join(
        targets.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source"))
    ).select("g.source", "size_class", "spread", "before", "source_size", "target")
    inside = Window.partitionBy(*keys).orderBy(F.col("size"), F.col("doc_id").asc_nulls_first())
    numbered = sized.withColumn("place", F.row_number().over(inside))
    joined = numbered.alias("d").join(
        offsets.alias("o"),
        F.col("d.source").eqNullSafe(F.col("o.source"))
        & (F.col("d.size_class") == F.col("o.size_class")) & (F.col("d.spread") == F.col("o.spread")),
    )
    last = F.col("o.before") + F.col("d.place")
    rate = F.when(F.col("o.source_size") > 0, F.col("o.target") / F.col("o.source_size")).otherwise(F.lit(0.0))
    start = (_hash(F.concat(F.coalesce(F.concat(F.lit("s"), F.col("d.source")), F.lit("n")), F.lit(f":{seed}")), 8) % _STEPS) / F.lit(float(_STEPS))
    copies = F.floor(last * rate + start) - F.floor((last - 1) * rate + start)
    return joined.select(
        *[F.col(f"d.`{c}`") for c in sized.columns if c not in ("size_class", "spread")],
        "o.source_size", "o.target", F.least(copies, F.lit(most)).cast("bigint").alias("copies"),
    )


def plan_mix(docs: DataFrame, most: int = 3, seed: int = 7) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    mixed = with_copies(docs.select("doc_id", "source", "text"), most, seed)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, most: int = 3, seed: int = 7) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns."""
    # No column of the input can clash with those that are added.
    names = [c if c in ("doc_id", "source", "text") else f"c{k}" for k, c in enumerate(docs.columns)]
    mixed = with_copies(docs.toDF(*names), most, seed)
    again = mixed.withColumn("__copy__", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return again.select(*[F.col(a).alias(b) for a, b in zip(names, docs.columns)])
