"""Quality rules as a learned decision list, in DataFrame functions only.

Statistics of each whole text come from built-in functions. From a bounded sample of labelled rows
(`SAMPLE_ROWS`, taken in hash order; rows with held-out labels are never used) sequential covering
learns conjunctions of thresholds: a rule grows condition by condition on two thirds of the sample
by information gain, is pruned back on the last third, and is accepted while it is right often
enough there; rows it covers are set aside and the next rule is learned. The rules become one
ordered Spark conditional expression, which is applied to all rows.

Counting in the learner is by bit sets over the sample (one integer per condition), so the driver
holds no more than the sample.

Defined cases: null and empty texts have no word and fail the base rules; a null doc_id is kept and
judged like any other; without labels no rule is learned and only the base rules judge; each of
repeated rows is judged alike; extra columns of the input are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketflow.llm.common import SPACE, WORD, held_out

#: Labelled rows that are used for learning, at most.
SAMPLE_ROWS = 20_000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_PLACE_BITS = 20
_MASK = (1 << _PLACE_BITS) - 1

# Words in 3-word windows that a text holds twice or more. Windows are encoded as 44 bits of a hash
# and 20 bits of the place, so that sorting plain numbers brings equal windows together. Neighbours
# are then compared word by word. `_EXACT` sorts the windows themselves; it serves texts of more
# than a million words and the texts in which two different windows share the 44 bits.
_COVERED = (
    "aggregate({places}, struct(0L AS c, 0 AS e), "
    "(a, p) -> struct(a.c + p + 3 - greatest(a.e, p) AS c, p + 3 AS e), a -> a.c)"
)
_SORTED = f"sort_array(transform(sequence(0, size(w) - 3), i -> shiftleft(xxhash64(w[i], w[i+1], w[i+2]), {_PLACE_BITS}) | i))"
_NEAR = f"((x ^ {{y}}) BETWEEN 0 AND {_MASK})"
_SAME = (
    f"({_NEAR} AND w[int(x & {_MASK})] = w[int({{y}} & {_MASK})] AND w[int(x & {_MASK}) + 1] = w[int({{y}} & {_MASK}) + 1] "
    f"AND w[int(x & {_MASK}) + 2] = w[int({{y}} & {_MASK}) + 2])"
)
_UP, _DOWN = "get(s, k + 1)", "get(s, k - 1)"
_EXACT = _COVERED.format(
    places=(
        "transform(array(sort_array(transform(sequence(0, size(w) - 3), i -> struct(concat_ws(' ', w[i], w[i+1], w[i+2]) AS h, i AS i)))), "
        "s -> sort_array(transform(filter(s, (x, k) -> coalesce(get(s, k - 1).h = x.h, false) OR coalesce(get(s, k + 1).h = x.h, false)), x -> x.i)))[0]"
    )
)
_REPEATED = f"""
CASE WHEN size(w) < 3 THEN 0L
WHEN size(w) > {_MASK} THEN {_EXACT}
ELSE transform(array({_SORTED}), s -> CASE
  WHEN NOT exists(zip_with(s, slice(s, 2, size(s)), (x, y) -> x ^ y), z -> z BETWEEN 0 AND {_MASK}) THEN 0L
  WHEN exists(transform(s, (x, k) -> coalesce({_NEAR.format(y=_UP)} AND NOT {_SAME.format(y=_UP)}, false)), b -> b) THEN {_EXACT}
  ELSE {_COVERED.format(places=f"sort_array(transform(filter(s, (x, k) -> coalesce({_SAME.format(y=_UP)}, false) OR coalesce({_SAME.format(y=_DOWN)}, false)), x -> int(x & {_MASK})))")}
END)[0] END
"""


def with_statistics(docs: DataFrame) -> DataFrame:
    """`docs` with the five base statistics, base_failed and the features that rules are learned on.

    The counts come out of an `explode` of one struct: the optimizer doesn't push later filters below
    it, where each use of a count would compute that count again.
    """
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    counts = F.struct(
        F.size("w").cast("bigint").alias("n_words"),
        (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.expr(_REPEATED).cast("bigint").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.regexp_count(text, F.lit("[A-ZÀ-ÖØ-Þ]")).alias("n_upper"),
        F.regexp_count(text, F.lit("!")).alias("n_bangs"),
    )
    counted = split.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array(counts)).alias("counts"))
    a_word, a_char, a_line = (F.greatest(f"counts.{c}", F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return counted.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        *[f"counts.{c}" for c in BASE],
        ((F.col("counts.n_words") < 50) | (100 * F.col("counts.n_repeat_words") > 50 * F.col("counts.n_words"))).alias("base_failed"),
        (F.col("counts.word_chars") / a_word).alias("word_length"),
        (F.col("counts.n_symbols") / a_word).alias("symbol_rate"),
        (F.col("counts.n_dup_lines") / a_line).alias("dup_line_share"),
        (F.col("counts.n_repeat_words") / a_word).alias("repeat_share"),
        (F.col("counts.n_upper") / a_char).alias("upper_share"),
        (F.col("counts.n_bangs") / a_word).alias("bang_rate"),
        (F.col("counts.n_words") / a_line).alias("line_words"),
    )


FEATURES = ("word_length", "symbol_rate", "dup_line_share", "repeat_share", "upper_share", "bang_rate", "line_words", "n_words")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, value: float) -> bool:
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def labelled_statistics(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Features and label of at most `rows` labelled documents; the rest of the pass is pruned by the join."""
    sample = (
        labels.select(F.col("doc_id").alias("labelled_id"), F.col("quality").alias("label"))
        .filter(~held_out(F.col("labelled_id")) & F.col("label").isNotNull())
        .orderBy(F.xxhash64("labelled_id"), "labelled_id", "label").limit(rows)
    )
    narrow = docs.select("doc_id", "text")
    found = narrow.join(F.broadcast(sample), F.col("doc_id") == F.col("labelled_id"))
    return with_statistics(found).filter(~F.col("base_failed")).select("doc_id", "label", *FEATURES)


def _cuts(values: list[float], most: int = 24) -> list[float]:
    """Thresholds between neighbouring quantiles of the rows, and of the distinct values (for features that are mostly 0)."""
    cuts = set()
    for ordered in (sorted(values), sorted(set(values))):
        picked = sorted({ordered[k * (len(ordered) - 1) // most] for k in range(most + 1)})
        cuts |= {(a + b) / 2 for a, b in zip(picked, picked[1:])}
    return sorted(cuts)


def learn(rows: list, most_rules: int = 12, most_conditions: int = 4, least_precision: float = 0.9, least_rows: int = 5) -> list[Rule]:
    """Ordered rules for rejecting, from rows of (doc_id, label, *FEATURES)."""
    if not rows:
        return []
    rows = sorted(rows, key=lambda r: tuple((v is None, v) for v in r))
    bad = sum(1 << k for k, r in enumerate(rows) if not r["label"])
    conditions: dict[Condition, int] = {}
    for f in FEATURES:
        column = [r[f] for r in rows]
        for cut in _cuts(column):
            over = sum(1 << k for k, v in enumerate(column) if v > cut)
            conditions[Condition(f, True, cut)] = over
            conditions[Condition(f, False, cut)] = ~over
    everyone = (1 << len(rows)) - 1
    pruning = sum(1 << k for k in range(2, len(rows), 3))
    growing = everyone & ~pruning

    def counts(mask: int) -> tuple[int, int]:
        p = (mask & bad).bit_count()
        return p, mask.bit_count() - p

    rules, left = [], everyone
    while len(rules) < most_rules:
        rule: list[Condition] = []
        mask = left & growing
        p0, n0 = counts(mask)
        while p0 and n0 and len(rule) < most_conditions:
            best = (0.0, None, 0)
            base = log2(p0 / (p0 + n0))
            for c, m in conditions.items():
                p, n = counts(mask & m)
                if p >= least_rows and (gain := p * (log2(p / (p + n)) - base)) > best[0]:
                    best = (gain, c, mask & m)
            if best[1] is None:
                break
            rule.append(best[1])
            mask = best[2]
            p0, n0 = counts(mask)

        def worth(k: int) -> tuple[float, int]:
            p, n = counts(reduce(lambda m, c: m & conditions[c], rule[:k], left & pruning))
            return (p + 1) / (p + n + 2), -k

        if not rule:
            break
        rule = rule[: max(range(1, len(rule) + 1), key=worth)]
        covered = reduce(lambda m, c: m & conditions[c], rule, left)
        p, n = counts(covered & pruning)
        if p < least_rows // 2 or p < least_precision * (p + n):
            break
        rules.append(tuple(rule))
        left &= ~covered
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True for rows to keep: the first rule that holds rejects."""
    out = F
    for rule in rules:
        out = out.when(reduce(lambda a, b: a & b, [c.column() for c in rule]), F.lit(False))
    return F.lit(True) if out is F else out.otherwise(F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[Rule]:
    return learn(labelled_statistics(docs, labels, rows).collect())


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the base statistics, base_failed, kept."""
    rules = fit(docs, labels)
    judged = with_statistics(docs.select("doc_id", "text"))
    return judged.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & verdict(rules)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    rules = fit(docs, labels)
    columns = [f"c{k}" for k in range(len(docs.columns))]  # no column of the input can clash with a statistic
    renamed = docs.toDF(*columns).withColumn("text", F.col(columns[docs.columns.index("text")]))
    kept = with_statistics(renamed).filter(~F.col("base_failed") & verdict(rules))
    return kept.select(*[F.col(a).alias(b) for a, b in zip(columns, docs.columns)])
