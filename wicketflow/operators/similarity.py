"""Pairs of similar names.

Comparing all pairs is avoided by a prefix filter on q-grams. If two strings differ by few
edits, all but a few of their q-grams survive, so among the rarest q-grams of each (as many as
the edits can destroy, plus one) at least one is shared. Strings meet only on such rare
q-grams, on their two lengths and on nearby positions. Two bit masks, of the q-grams and of the
characters of a name, turn most pairs away where they meet. No filter loses a pair.

Where the allowed edits could destroy every q-gram (short strings, low thresholds) strings meet on
segments instead: the shorter one is cut into one segment more than there are edits, so one segment
is left whole and stands in the longer one. Of the edits before the k-th segment there are k at most
and behind it the others at most, or an earlier or later segment is whole too; so the k-th one is only
looked for at the few places that both sides allow.

Short strings with one edit between them meet on what is left without one character: of equal lengths that
is the same character's place on both sides, otherwise the shorter one stands whole. Such a key is shared by
a handful of strings, however many start or end alike, so what meets grows with the strings.

Where names are so alike that even their rarest q-grams are shared by many (URLs of a site), a name would meet others
far more often than there are others, and the pairs that met would be what fills the disk. Then the names whose
partners would be found by q-grams are compared block by block instead (`edit_blocks`), which gives the same pairs
and shuffles no pair.

Names get numbers, and keys carry these and the masks, but no text. What has met is made distinct as
pairs of numbers; only then are the texts joined and the edit distances computed, each once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketflow.operators.edit_blocks import near_pairs
from wicketflow.scratch import stage

_SLACK = 1e-9

# Lengths from here on count as one when asking whether a length occurs at all.
_LONGEST = (1 << 16) - 1


def _edits(high: Column, threshold: float) -> Column:
    """Most edits between strings, the longer of this length, that still reach the threshold."""
    return F.floor(F.lit(1.0 - threshold) * high + F.lit(_SLACK)).cast("int")


def _partner_lengths(length: Column, threshold: float) -> Column:
    """Lengths a partner can have."""
    low = F.ceil(length * threshold - _SLACK).cast("int")
    high = F.floor(length / threshold + _SLACK).cast("int")
    return F.sequence(F.least(low, length), F.greatest(high, length))


# Keys on segments. Of a string of length low there are edits + 1 segments, the last ones one
# character longer where the length doesn't divide; side 0 marks the shorter string's segments,
# side 1 the places of the longer string where they can stand.
_SIZE = "(low DIV (edits + 1) + int(k >= edits + 1 - low % (edits + 1)))"
_START = "(k * (low DIV (edits + 1)) + greatest(0, k - (edits + 1 - low % (edits + 1))))"
_KEY = "named_struct('token', xxhash64('segment', k, substring(text, {at} + 1, {size})), 'at', 0, 'side', {side})"
_SEGMENTS = f"transform(sequence(0, edits), k -> {_KEY.format(at=_START, size=_SIZE, side=0)})"
_FROM = f"greatest({_START} - k, {_START} + high - low - (edits - k))"
_TO = f"least({_START} + k, {_START} + high - low + (edits - k))"
_PLACES = (
    f"flatten(transform(sequence(0, edits), k -> transform(filter(if({_FROM} <= {_TO}, sequence({_FROM}, {_TO}), array()), "
    f"p -> p >= 0 AND p + {_SIZE} <= high), p -> {_KEY.format(at='p', size=_SIZE, side=1)})))"
)

# Keys of one edit: side 2 where the lengths are equal (the place belongs to the key), else the whole shorter
# string (side 0) and the longer one without each of its characters (side 1).
_REST = "concat(substring(text, 1, p), substring(text, p + 2))"
_REST_KEY = "named_struct('token', xxhash64('{kind}', {what}), 'at', 0, 'side', {side})"
_WITHOUT = (
    f"CASE WHEN low = high THEN transform(sequence(0, high - 1), p -> {_REST_KEY.format(kind='same', what=f'p, {_REST}', side=2)}) "
    f"WHEN len = low THEN array({_REST_KEY.format(kind='whole', what='text', side=0)}) "
    f"ELSE transform(sequence(0, high - 1), p -> {_REST_KEY.format(kind='whole', what=_REST, side=1)}) END"
)
# Longest string that gives a key for each of its characters.
_SHORT = 64
# What meets on a key and is made distinct costs as much as so many comparisons in a block.
_MEETING = 64


def _mask(numbers: Column, how: str) -> Column:
    """64 bits of a list of numbers: which ones occur (``or``), or occur an odd number of times.

    An edit changes a bounded number of q-grams and at most two characters, so masks of similar
    strings differ in few bits.
    """
    bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(n, F.lit(64)))
    join = (lambda m, b: m.bitwiseOR(b)) if how == "or" else (lambda m, b: m.bitwiseXOR(b))
    return F.aggregate(F.transform(numbers, bit), F.lit(0).cast("bigint"), join)


def _numbered(df: DataFrame, column: str, lower: bool) -> DataFrame:
    """The distinct values of a column with the text to compare, the number of rows and a number of their own, stored: all that follows goes by that."""
    names = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("name")).agg(F.count("*").alias("n"))
    text = F.lower("name") if lower else F.col("name")
    return stage(df.sparkSession, names.select("name", text.alias("text"), "n", F.monotonically_increasing_id().alias("id")))


def _ranked(names: DataFrame, q: int) -> DataFrame:
    """Each name with its q-grams, the rarest first."""
    length = F.length("text")
    starts = F.sequence(F.lit(1), F.greatest(length - (q - 1), F.lit(1)))
    # A q-gram is replaced by one of 65536 numbers, which bounds the table of frequencies.
    # Two q-grams with one number can only add candidates, which are tested anyway.
    token = lambda k: F.pmod(F.xxhash64(F.substring("text", k, q)), F.lit(1 << 16)).cast("int")
    tokens = names.select("id", "text", F.transform(starts, token).alias("tokens"))
    grams = tokens.select("id", F.posexplode("tokens").alias("at", "token"))
    frequency = grams.groupBy("token").agg(F.count("*").alias("uses"))
    return (
        grams.join(F.broadcast(frequency), "token")
        .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("uses", "token", "at"))).alias("grams"))
        .join(names.select("id", "text"), "id")
    )


def _by_grams(low: Column, high: Column, threshold: float, q: int) -> Column:
    """Whether names of these lengths meet on q-grams: more of them stay than the edits can destroy, and it is not one edit between short ones."""
    edits = _edits(high, threshold)
    return (low - (q - 1) - edits * q > 0) & ~((edits == 1) & (high <= _SHORT))


def _lengths(names: DataFrame, threshold: float, q: int, by_grams: bool) -> DataFrame:
    """The lengths, of those there are, with a partner that is met on q-grams, or otherwise."""
    lengths = names.select(F.length("text").alias("len")).distinct()
    both = lengths.select("len", F.explode(_partner_lengths(F.col("len"), threshold)).alias("other"))
    there = both.join(lengths.withColumnRenamed("len", "other"), "other", "left_semi")
    met = _by_grams(F.least("len", "other"), F.greatest("len", "other"), threshold, q)
    return there.where(met if by_grams else ~met).select("len").distinct()


def _crowded(names: DataFrame, threshold: float, q: int) -> DataFrame | None:
    """The names that have partners by q-grams, if they would meet others too often on these, else None."""
    wide = _lengths(names, threshold, q, True)
    if wide.isEmpty():
        return None
    some = names.join(wide, F.length("text") == F.col("len"), "left_semi")
    lost = _edits(F.length("text"), threshold) * q
    uses = F.aggregate(F.slice("grams", F.lit(1), lost + 1), F.lit(0).cast("bigint"), lambda n, g: n + g["uses"])
    meets, count = _ranked(some, q).agg(F.avg(uses), F.count("*")).first()
    return some if meets * _MEETING > count else None


def _signatures(names: DataFrame, threshold: float, q: int, grams: bool = True) -> DataFrame:
    """Rare q-grams, or segments, of each name for each length a partner can have: the keys to meet on.

    Without `grams` the keys of names that would meet on q-grams are left out.
    """
    length = F.length("text")
    ranked = _ranked(names, q)
    # Lengths that no name has need no keys. At most 65536 lengths are told apart.
    lengths = names.select(F.least(length, F.lit(_LONGEST)).alias("there")).distinct()
    spread = (
        ranked.select("*", length.alias("len"), F.explode(_partner_lengths(length, threshold)).alias("other"))
        .withColumn("there", F.least("other", F.lit(_LONGEST)))
        .join(F.broadcast(lengths), "there", "left_semi")
    )
    low, high = F.least("len", "other"), F.greatest("len", "other")
    if not grams:
        spread = spread.where(~_by_grams(low, high, threshold, q))
    keyed = spread.select(
        "id", "text", "grams", "len", "other", low.alias("low"), high.alias("high"),
        _edits(high, threshold).alias("edits"),
    )
    keyed = keyed.select(
        "*", (F.col("edits") * q).alias("lost"), (2 * F.col("edits") * q).alias("differing"),
        (F.col("low") - (q - 1) - F.col("edits") * q).alias("left_over"),
    )
    key = lambda token, at: F.struct(token.cast("bigint").alias("token"), at.cast("int").alias("at"), F.lit(2).alias("side"))
    rare = F.transform(F.slice("grams", 1, F.col("lost") + 1), lambda x: key(x["token"], x["at"]))
    none = F.array().cast("array<struct<token:bigint,at:int,side:int>>")
    segments = F.concat(
        F.when(F.col("len") == F.col("low"), F.expr(_SEGMENTS)).otherwise(none),
        F.when(F.col("len") == F.col("high"), F.expr(_PLACES)).otherwise(none),
    )
    one_edit = (F.col("edits") == 1) & (F.col("high") <= _SHORT)
    keys = F.when(one_edit, F.array_distinct(F.expr(_WITHOUT))).when(F.col("left_over") <= 0, F.array_distinct(segments)).otherwise(rare)
    return keyed.select(
        "id", "low", "high", "edits", "len", "differing",
        _mask(F.transform("grams", lambda g: g["token"]), "or").alias("gram_mask"),
        _mask(F.transform(F.split("text", ""), lambda c: F.pmod(F.xxhash64(c), F.lit(64)).cast("int")), "xor").alias("char_mask"),
        F.inline(keys),
    )


def similar_names(
    df: DataFrame,
    column: str,
    threshold: float = 0.9,
    lower: bool = False,
    strict: bool = False,
    q: int = 3,
    counts: bool = False,
) -> DataFrame:
    """Pairs of distinct values of a column that are similar: ``name1, name2, similarity``.

    The similarity is ``1 - edit distance / longer length``. ``lower`` compares in lower case.
    ``strict`` wants it above the threshold and below 1, otherwise it may equal the threshold.
    With ``counts`` each name comes with its number of rows, ``count1, count2``.
    """
    if not 0.5 < threshold <= 1.0:
        raise ValueError("threshold must be above 0.5 and at most 1")
    found = _scored(_numbered(df, column, lower), threshold, q, strict)
    return found if counts else found.select("name1", "name2", "similarity")


def _met(names: DataFrame, threshold: float, q: int, grams: bool) -> DataFrame:
    """Pairs that met on a key and are within the edits of their lengths."""
    signatures = stage(names.sparkSession, _signatures(names, threshold, q, grams))

    # A merge join: a hot key can be split at run time.
    left, right = signatures.alias("a").hint("merge"), signatures.alias("b")
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    met = (
        (a("low") == b("low")) & (a("high") == b("high")) & (a("token") == b("token"))
        & (a("len") == a("low")) & (b("len") == b("high")) & (a("side") != 1) & (b("side") != 0)
        & ((a("low") < a("high")) | (a("id") < b("id")))
        & (F.abs(a("at") - b("at")) <= a("edits"))
        & (F.bit_count(a("char_mask").bitwiseXOR(b("char_mask"))) <= 2 * a("edits"))
        & (F.bit_count(a("gram_mask").bitwiseXOR(b("gram_mask"))) <= a("differing"))
    )
    pairs = left.join(right, met).select(a("id").alias("id1"), b("id").alias("id2"), a("edits").alias("edits"), a("high").alias("longer")).distinct()
    side = lambda k: names.select(F.col("id").alias(f"id{k}"), F.col("name").alias(f"name{k}"), F.col("text").alias(f"t{k}"), F.col("n").alias(f"n{k}"))
    compared = pairs.join(side(1), "id1").join(side(2), "id2")
    # The bounded distance stops early and is -1 beyond the bound.
    near = compared.withColumn("distance", F.expr("levenshtein(t1, t2, edits)")).where("distance >= 0")
    return near.select("name1", "name2", "n1", "n2", "longer", "distance")


def _in_blocks(names: DataFrame, threshold: float, q: int, strict: bool) -> DataFrame:
    """The pairs that q-grams would find, from blocks."""

    def allowed(low: int, high: int) -> int:
        edits = math.floor((1.0 - threshold) * high + _SLACK)
        if low - (q - 1) - edits * q <= 0 or edits == 1 and high <= _SHORT:
            return -1
        # Similarities as they come out, so nothing is found that the threshold turns away.
        while edits >= 0 and (1.0 - edits / high <= threshold if strict else 1.0 - edits / high < threshold):
            edits -= 1
        return edits

    return near_pairs(names, allowed, int(strict))


def _scored(names: DataFrame, threshold: float, q: int, strict: bool) -> DataFrame:
    """Similar pairs with their similarity, the lesser name first, and the rows of each."""
    crowded = _crowded(names, threshold, q)
    in_blocks, others = None, names
    if crowded is not None:
        in_blocks, rest = _in_blocks(crowded, threshold, q, strict), _lengths(names, threshold, q, False)
        if rest.isEmpty():
            return in_blocks
        others = names.join(rest, F.length("text") == F.col("len"), "left_semi")
    near = _met(others, threshold, q, crowded is None)
    similarity = F.lit(1.0) - F.col("distance").cast("double") / F.col("longer")
    ordered = F.col("name1") <= F.col("name2")
    scored = near.select(
        F.least("name1", "name2").alias("name1"), F.greatest("name1", "name2").alias("name2"), similarity.alias("similarity"),
        F.when(ordered, F.col("n1")).otherwise(F.col("n2")).alias("count1"), F.when(ordered, F.col("n2")).otherwise(F.col("n1")).alias("count2"),
    )
    s = F.col("similarity")
    found = scored.where((s > threshold) & (s < 1.0) if strict else s >= threshold)
    return found if in_blocks is None else found.unionByName(in_blocks)


def similar_names_with_counts(df: DataFrame, column: str, threshold: float = 0.8) -> DataFrame:
    """Similar but not equal values, each with its number of rows."""
    return similar_names(df, column, threshold, strict=True, counts=True)
