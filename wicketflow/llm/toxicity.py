"""Toxicity by nearest labelled examples.

Examples are a bounded sample of labelled rows (`TOXIC_ROWS` and `CLEAN_ROWS`, in hash order; rows with
held-out labels are never used), one of each family of near-copies, so that the words of one much copied
text with a wrong label are not taken for signs of it. Terms are the words whose presence depends on the label by a likelihood-ratio
test over the sample, corrected for the number of words tested. Document frequencies of the terms are
counted over all documents. Each example is the vector of (1 + log tf) * idf of its terms, scaled to length
one.

The index is inverted: a term has, for each block of `_BLOCK` neighbouring examples, its weights there and
their maximum. A text's neighbours are its k examples of highest cosine, found exactly: blocks are visited
by falling upper bound (sum over the text's terms of its weight times the block's maximum) until the bound
falls below the k-th cosine found. The index is bounded by the sample, so it goes to the tasks whole.

Score: neighbours vote with weight cosine / (distance + `_SOFT`), smoothed by the share of toxic rows, and a
logistic curve fitted on the examples' own leave-one-out votes turns the vote into a probability, with
classes weighted as in the labels. The nearest neighbours are returned as evidence.

Defined cases: null and empty texts, and texts without any term, have no neighbour and get the score of
the vote that is only the prior; without labels of both kinds every score is 0; several labels of one doc_id
count as toxic if one does; a null doc_id is scored and counts as not held out; repeated rows get equal
rows; an empty table gives an empty result; no other column is looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.llm.common import held_out
from wicketflow.llm.simhash import fingerprint
from wicketflow.scratch import stage

TOXIC_ROWS, CLEAN_ROWS = 3_000, 4_500
TERMS = 2_000
NEIGHBOURS = 15
THRESHOLD = 0.7
_BLOCK = 64
_SOFT = 0.2
_EVIDENCE = 3
_LEAST_ROWS = 3
#: Bits by which fingerprints of near-copies may differ; of unrelated texts about 32 differ.
_FAMILY = 13
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def examples(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """doc_id, text, toxic of the sample; stored. Its ids are bounded, so they are broadcast."""
    known = (
        labels.select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isNotNull() & F.col("labelled").isNotNull() & ~held_out(F.col("labelled")))
        .groupBy("labelled").agg(F.max("toxic").alias("toxic"))
    )
    pick = lambda value, n: known.filter(F.col("toxic") == value).orderBy(F.xxhash64("labelled"), "labelled").limit(n)
    sample = pick(1, toxic_rows).union(pick(0, clean_rows))
    narrow = docs.select("doc_id", "text")
    found = narrow.join(F.broadcast(sample), F.col("doc_id") == F.col("labelled")).select("doc_id", "text", "toxic")
    # Repeated rows of an id: one of them.
    once = found.groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    stored = stage(docs.sparkSession, once.mapInArrow(_with_print, "doc_id bigint, toxic int, text string, print bigint"))
    leaders = _family_leaders([(r["doc_id"], r["print"]) for r in stored.select("doc_id", "print").collect()])
    chosen = docs.sparkSession.createDataFrame([(i,) for i in leaders], "doc_id bigint")
    return stored.drop("print").join(F.broadcast(chosen), "doc_id")


def _with_print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), batch.column("toxic"), batch.column("text"), pa.array(prints)], names=["doc_id", "toxic", "text", "print"]
        )


def _family_leaders(rows: list[tuple[int, int]]) -> list[int]:
    """Ids such that no two have fingerprints within `_FAMILY` bits, and every other row is that near to one."""
    rows = sorted(rows)
    prints = np.array([p for _, p in rows], np.int64).view(np.uint64)
    free, leaders = np.ones(len(rows), bool), []
    for k, (i, _) in enumerate(rows):
        if free[k]:
            leaders.append(i)
            free &= np.bitwise_count(prints ^ prints[k]) > _FAMILY
    return leaders


def _present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(t, y) for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()) for t in set(words(text))]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.string()), pa.array([y for _, y in rows], pa.int32())], names=["term", "toxic"])


def choose_terms(sample: DataFrame, toxic: int, clean: int, most: int = TERMS) -> list[str]:
    """Terms that depend on the label, the most dependent first."""
    seen = sample.select("text", "toxic").mapInArrow(_present, "term string, toxic int")
    counts = seen.groupBy("term").agg(F.sum("toxic").alias("a"), F.count("*").alias("n")).filter(F.col("n") >= _LEAST_ROWS)
    total = toxic + clean
    a, n = F.col("a").cast("double"), F.col("n").cast("double")
    cells = ((a, n * toxic / total), (n - a, n * clean / total), (toxic - a, (total - n) * toxic / total), (clean - n + a, (total - n) * clean / total))
    chi = sum((F.when(seen_ > 0, 2 * seen_ * F.log(seen_ / wanted)).otherwise(0.0) for seen_, wanted in cells), F.lit(0.0))
    scored = counts.withColumn("chi", chi)
    tested = scored.count()
    # About one term in all words tested would pass by chance.
    least = 2 * log(max(tested, 2))
    return [r["term"] for r in scored.filter(F.col("chi") > least).orderBy(F.desc("chi"), "term").limit(most).select("term").collect()]


def _term_counts(terms: list[str]):
    place = {t: k for k, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = Counter(), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n += 1
                found.update({place[w] for w in words(text) if w in place})
        found[-1] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["term", "n"])

    return run


def document_frequencies(docs: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """Number of documents, and of those that hold each term; over all documents."""
    counted = docs.select("text").mapInArrow(_term_counts(terms), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    by = {r["term"]: r["n"] for r in counted}
    return by.get(-1, 0), np.array([by.get(k, 0) for k in range(len(terms))], float)


@dataclass
class Index:
    terms: dict[str, int]
    idf: np.ndarray
    ids: list[int]
    toxic: np.ndarray
    weights: dict[tuple[int, int], np.ndarray]  # by term and block, for each place in the block; only blocks that hold the term
    bounds: np.ndarray  # by term and block
    prior: float
    curve: tuple[float, float] = (1.0, 0.0)

    @staticmethod
    def build(terms: list[str], n_docs: int, df: np.ndarray, rows: list[tuple[int, int, dict[int, int]]], prior: float) -> Index:
        """rows: id, toxic, counts of terms. Examples with the same terms lie side by side, which sharpens the blocks' bounds."""
        idf = np.log((1 + n_docs) / (1 + df)) + 1
        rows = sorted(rows, key=lambda r: (sorted(r[2]), r[0]))
        blocks = max(1, -(-len(rows) // _BLOCK))
        weights: dict[tuple[int, int], np.ndarray] = {}
        bounds = np.zeros((len(terms), blocks))
        for k, (_, _, counts) in enumerate(rows):
            b, p = divmod(k, _BLOCK)
            for t, w in Index.vector(counts, idf).items():
                weights.setdefault((t, b), np.zeros(_BLOCK))[p] = w
                bounds[t, b] = max(bounds[t, b], w)
        place = {t: k for k, t in enumerate(terms)}
        return Index(place, idf, [r[0] for r in rows], np.array([r[1] for r in rows], float), weights, bounds, prior)

    @staticmethod
    def vector(counts: dict[int, int], idf: np.ndarray) -> dict[int, float]:
        raw = {t: (1 + log(c)) * float(idf[t]) for t, c in counts.items()}
        length = sum(w * w for w in raw.values()) ** 0.5
        return {t: w / length for t, w in raw.items()} if length else {}

    def counts(self, text: str | None) -> dict[int, int]:
        return Counter([self.terms[w] for w in words(text) if w in self.terms])

    def nearest(self, counts: dict[int, int], k: int = NEIGHBOURS, without: int = -1) -> list[tuple[float, int]]:
        """(cosine, place of the example), by falling cosine, then place; only cosines above 0."""
        query = self.vector(counts, self.idf)
        if not query:
            return []
        terms, values = np.array(sorted(query)), np.array([query[t] for t in sorted(query)])
        bound = values @ self.bounds[terms]
        order = np.argsort(-bound, kind="stable")
        best: list[tuple[float, int]] = []
        for b in order.tolist():
            least = -best[-1][0] if len(best) >= k else 0.0
            if bound[b] <= 0 or bound[b] < least - 1e-12:
                break
            cosine = sum((v * self.weights[t, b] for t, v in zip(terms.tolist(), values.tolist()) if (t, b) in self.weights), np.zeros(_BLOCK))
            places = np.flatnonzero(cosine > max(0.0, least - 1e-12))
            best += [(-round(float(cosine[p]), 12), b * _BLOCK + p) for p in places.tolist() if b * _BLOCK + p != without]
            best = sorted(best)[:k]
        return [(-c, p) for c, p in best]

    def vote(self, near: list[tuple[float, int]]) -> float:
        weight = [c / (1 - min(c, 1.0) + _SOFT) for c, _ in near]
        for_ = sum(w * self.toxic[p] for w, (_, p) in zip(weight, near))
        return (for_ + self.prior) / (sum(weight) + 1)

    def score(self, near: list[tuple[float, int]]) -> float:
        a, b = self.curve
        return float(1 / (1 + np.exp(-(a * _logit(self.vote(near)) + b))))


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one input by Newton's method, with a small pull towards (1, 0)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        h = weight * p * (1 - p)
        grad = np.array([np.sum(weight * (p - y) * x) + (a - 1), np.sum(weight * (p - y)) + b])
        hess = np.array([[np.sum(h * x * x) + 1, np.sum(h * x)], [np.sum(h * x), np.sum(h) + 1]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 0.0), float(b)


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Index | None:
    sample = examples(docs, labels, toxic_rows, clean_rows)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return None
    terms = choose_terms(sample, toxic, clean)
    if not terms:
        return None
    n_docs, df = document_frequencies(docs, terms)
    place = {t: k for k, t in enumerate(terms)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter([place[w] for w in words(t) if w in place]) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array([list(c) for c in found], pa.list_(pa.int32())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "terms", "counts"],
            )

    rows = sample.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic", "text").mapInArrow(vectors, "doc_id bigint, toxic int, terms array<int>, counts array<int>").collect()
    rates = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    prior = min(max(rates, 1e-3), 1 - 1e-3)
    index = Index.build(terms, n_docs, df, [(r["doc_id"], r["toxic"], dict(zip(r["terms"], r["counts"]))) for r in rows], prior)
    counts = {r["doc_id"]: dict(zip(r["terms"], r["counts"])) for r in rows}
    votes = np.array([index.vote(index.nearest(counts[i], without=k)) for k, i in enumerate(index.ids)])
    y = index.toxic
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    index.curve = _fit_curve(_logit(votes), y, weight)
    return index


def _score(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple] = {}
        blank = (index.score([]), [])
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                counts = index.counts(text)
                if not counts:
                    out.append(blank)
                    continue
                key = tuple(sorted(counts.items()))
                done = known.get(key)
                if done is None:
                    near = index.nearest(counts)
                    evidence = [{"example_id": index.ids[p], "cosine": c, "toxic": int(index.toxic[p])} for c, p in near[:_EVIDENCE]]
                    done = (index.score(near), evidence)
                    if len(known) < 100_000:
                        known[key] = done
                out.append(done)
            kind = pa.list_(pa.struct([("example_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s for s, _ in out], pa.float64()), pa.array([e for _, e in out], kind)], names=["doc_id", "score", "evidence"]
            )

    return run


def score_documents(docs: DataFrame, index: Index | None) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (nearest examples: id, cosine, label)."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if index is None:
        none = F.array().cast("array<struct<example_id:bigint,cosine:double,toxic:int>>")
        scored = narrow.select("doc_id", F.lit(0.0).alias("score"), none.alias("evidence"))
    else:
        scored = narrow.mapInArrow(_score(index), "doc_id bigint, score double, evidence array<struct<example_id:bigint,cosine:double,toxic:int>>")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence"
    )


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, fit(docs, labels))
