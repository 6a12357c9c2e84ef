"""Ranked lexical search of whole texts for a set of items, by bag deduplication.

Terms are the maximal runs of characters that are neither ASCII control, space nor punctuation, only
A-Z lower-cased. To an item a document is no more than the counts of the item's terms and its length
class m. Documents that agree in both are one class:

1. Restrict: each document becomes its bag, the counts of its terms that occur in any item, as bytes
   in the terms' order. This is the only pass over the texts; what follows reads the stored bags.
2. Totals N and L, and the number of documents of each term, are sums over all bags.
3. Classes: bags meet by the digest of (bag, m) and are told apart by the whole bag and m. Each class
   keeps its `top` smallest doc_ids, for no item can take more of one class; they are chosen on both
   sides of the shuffle, so a bag that a third of all documents share sends `top` rows a task.
4. A class is scored once, for all items that hold one of its terms, in 64-bit whole numbers.
5. Its members are put in by ascending doc_id; a task hands on the `top` best of each item.

Items are taken in blocks of about `VOCABULARY` terms; each block is a job of its own over all
documents, so what a task holds (the terms of a block) doesn't grow with the items. One block does
for 100,000 terms' worth of items and more.

Defined cases: a null text has no term; an item without a term that any document holds gets no rows;
repeated documents are documents of their own; equal doc_ids follow each other, a null one is the
first; repeated item_ids are items of their own, each with its own ranks; empty tables give no rows.
Other columns of the input are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wicketflow.scratch import stage

#: Distinct terms of a block of items, about; an item with more is a block alone.
VOCABULARY = 500_000
#: Fixed values of the score.
_SCALE, _DAMP, _LENGTH, _SHARE = 1_000_000_000, 1000, 8, 90
#: Pairs of a class's term and an item, and scores, that are worked on at a time.
_PAIRS = 4_000_000
_LEAST = -(2**63)

#: Every ASCII byte that belongs to no term becomes a space, A-Z become a-z.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """Number, id and distinct terms of each item that has any."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            terms = [sorted(set(terms_of(t or b""))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("number"), batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], names=["number", "item_id", "terms"]
            )

    numbered = items.select(F.monotonically_increasing_id().alias("number"), F.col("item_id").cast("bigint").alias("item_id"), "text")
    return numbered.mapInArrow(split, "number bigint, item_id bigint, terms array<binary>").where("size(terms) > 0")


class Block:
    """Items of one block: the terms' numbers, and the items of each term (`items[starts[t]:starts[t + 1]]`)."""

    def __init__(self, rows: list):
        self.ids = [r.item_id for r in rows]
        self.terms = {t: k for k, t in enumerate(sorted({bytes(t) for r in rows for t in r.terms}))}
        held = [[] for _ in self.terms]
        for item, r in enumerate(rows):
            for t in r.terms:
                held[self.terms[bytes(t)]].append(item)
        self.starts = np.cumsum([0, *map(len, held)])
        self.items = np.array([i for own in held for i in own], np.int64)


def blocks(items: DataFrame) -> Iterator[Block]:
    """Items in blocks; the driver holds one block at a time."""
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    parts = -(-total // VOCABULARY)
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("number"), F.lit(parts)) == part)
        rows = sorted(mine.collect(), key=lambda r: r.number)
        if rows:
            yield Block(rows)


def bags(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats) and bag of each document with a term.

    A bag is the numbers of its terms, ascending, then their counts, each as 32-bit whole numbers; it
    is null where the document has none of `terms`.
    """

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text"):
                words = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                counted = Counter(words)
                held = sorted((terms[w], counted[w]) for w in counted.keys() & terms.keys())
                out.append((len(words), np.array(held, "<u4").T.tobytes() if held else None))
            n, bag = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(bag, pa.binary())], names=["doc_id", "n", "bag"]
            )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return narrow.mapInArrow(restrict, "doc_id bigint, n bigint, bag binary").where("n > 0")


def document_counts(bagged: DataFrame, terms: int) -> np.ndarray:
    """Number of documents that hold each term."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(terms, np.int64)
        for batch in batches:
            for bag in batch.column("bag").to_pylist():
                held = np.frombuffer(bag, "<u4")
                found[held[: len(held) // 2]] += 1
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[some])], names=["term", "df"])

    sums = bagged.where("bag IS NOT NULL").select("bag").mapInArrow(add_up, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(terms, np.int64)
    for r in sums.collect():
        out[r.term] = r.df
    return out


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def length_class(n: Column, n_docs: int, length: int) -> Column:
    return F.lit(100 - _SHARE) + F.expr(f"div({_SHARE}L * n * {n_docs}L, {max(length, 1)}L)")


def class_members(bagged: DataFrame, n_docs: int, length: int, top: int) -> DataFrame:
    """digest, bag, m, doc_id: of each class of equal (bag, m) the `top` smallest doc_ids."""
    classed = bagged.where("bag IS NOT NULL").select("doc_id", "bag", length_class(F.col("n"), n_docs, length).alias("m"))
    classed = classed.withColumn("digest", F.xxhash64("bag", "m"))
    members = Window.partitionBy("digest", "bag", "m").orderBy(F.col("doc_id").asc_nulls_first())
    return classed.withColumn("member", F.row_number().over(members)).where(F.col("member") <= top)


def _scores(found: list[tuple[np.ndarray, np.ndarray, int]], block: Block, w: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For classes (terms, counts, m): the position of the first of some classes and their scores, classes by items."""
    sizes, items = np.diff(block.starts), len(block.ids)
    k = 0
    while k < len(found):
        pairs, first = 0, k
        while k < len(found) and (k == first or pairs < _PAIRS and (k - first) * items < _PAIRS):
            pairs += int(sizes[found[k][0]].sum())
            k += 1
        part = found[first:k]
        terms = np.concatenate([t for t, _, _ in part]).astype(np.int64)
        tf = np.concatenate([c for _, c, _ in part]).astype(np.int64)
        each = [len(t) for t, _, _ in part]
        m = np.repeat(np.array([m for _, _, m in part], np.int64), each)
        gain = w[terms] * (_SCALE * tf // (_DAMP * tf + _LENGTH * m))
        some = sizes[terms]
        ends = np.cumsum(some)
        place = np.arange(ends[-1]) + np.repeat(block.starts[terms] - ends + some, some)
        row = np.repeat(np.repeat(np.arange(len(part)) * items, each), some)
        sums = np.zeros(len(part) * items, np.int64)
        np.add.at(sums, row + block.items[place], np.repeat(gain, some))
        yield first, sums.reshape(len(part), items)


class Best:
    """The `top` best rows of each item: highest score first, then smallest doc_id."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.zeros(items, np.int64)
        self.rows: list[list] = [[] for _ in range(items)]

    def add(self, scores: np.ndarray, members: list[list[int]]) -> None:
        """Scores of classes by items, and the doc_ids of each class."""
        able = np.nonzero((scores > 0) & (scores >= self.least))
        for own, item, score in zip(*(a.tolist() for a in able), scores[able].tolist()):
            rows = self.rows[item]
            rows += [(-score, doc_id) for doc_id in members[own]]
            if len(rows) >= 4 * self.top:
                self.cut(item)

    def cut(self, item: int) -> None:
        rows = self.rows[item] = sorted(self.rows[item])[: self.top]
        if len(rows) == self.top:
            self.least[item] = -rows[-1][0]

    def all(self) -> Iterator[tuple[int, int, int]]:
        for item in range(len(self.rows)):
            self.cut(item)
            yield from ((item, doc_id, -score) for score, doc_id in self.rows[item])


def rank_block(spark: SparkSession, docs: DataFrame, block: Block, top: int) -> DataFrame:
    """item_id, rank, doc_id, score for the items of one block."""
    bagged = stage(spark, bags(docs, block.terms))
    totals = bagged.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    w = weights(document_counts(bagged, len(block.terms)), totals.docs)
    members = class_members(bagged, totals.docs, totals.terms or 0, top)
    # A class's rows come together and by doc_id: the window has sorted them so, and nothing deals them out anew.

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(block.ids), top)
        held: list[tuple[bytes, int, list[int]]] = []

        def settle(classes):
            found = [(*np.frombuffer(bag, "<u4").reshape(2, -1), m) for bag, m, _ in classes]
            for first, scores in _scores(found, block, w):
                best.add(scores, [ids for _, _, ids in classes[first : first + len(scores)]])

        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("bag", "m", "doc_id"))
            for bag, m, doc_id in zip(*columns):
                doc_id = _LEAST if doc_id is None else doc_id
                if held and held[-1][1] == m and held[-1][0] == bag:
                    held[-1][2].append(doc_id)
                else:
                    held.append((bag, m, [doc_id]))
            settle(held[:-1])
            held = held[-1:]
        settle(held)
        rows = list(best.all())
        columns = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    ids = block.ids

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([ids[i] for i in batch.column("item").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([own, *batch.columns[1:]], names=["item_id", "rank", "doc_id", "score"])

    found = members.select("bag", "m", "doc_id").mapInArrow(score, "item bigint, doc_id bigint, score bigint")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    ranked = ranked.select("item", F.col("rank").cast("bigint").alias("rank"), "doc_id", "score")
    out = ranked.mapInArrow(named, "item_id bigint, rank bigint, doc_id bigint, score bigint")
    return out.select(
        "item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc_id") != _LEAST, F.col("doc_id")).alias("doc_id"), "score"
    )


def search(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """The `top` highest-scoring documents of each item: item_id, rank (from 1), doc_id, score.

    `docs` has doc_id and text, `items` item_id and text.
    """
    spark = docs.sparkSession
    found = None
    for block in blocks(stage(spark, item_terms(items))):
        ranked = rank_block(spark, docs, block, top)
        found = ranked if found is None else found.unionAll(ranked)
    return found if found is not None else spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
