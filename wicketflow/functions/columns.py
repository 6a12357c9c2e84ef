"""Small column helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wicketflow.constants import CREDITED_KINDS


def per(numerator: Column, denominator: Column, factor: float = 1.0) -> Column:
    """``numerator * factor / denominator`` as DOUBLE; NULL when the denominator is 0 or NULL."""
    bottom = F.nullif(denominator.cast("double"), F.lit(0.0))
    return numerator.cast("double") * F.lit(factor) / bottom


def percent(part: Column, whole: Column) -> Column:
    return per(part, whole, 100.0)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also when it is NULL)."""
    return F.when(condition, 1).otherwise(0)


def total(value: Column) -> Column:
    return F.sum(value.cast("bigint"))


def computed_once(value: Column) -> Column:
    """The same value, as a generator of one row: what follows, a filter too, reads it instead of computing it again."""
    return F.explode_outer(F.array(value))


def credited() -> Column:
    """A wicket of a kind that counts for the bowler."""
    return F.col("is_wicket") & F.col("wicket_kind").isin(*CREDITED_KINDS)


def boundary() -> Column:
    return F.col("batter_runs").isin(4, 6)


def ident(*parts: Column) -> Column:
    """Composite id; NULL when a part is NULL."""
    texts = [p.cast("string") for p in parts]
    joined = [texts[0]]
    for text in texts[1:]:
        joined += [F.lit("_"), text]
    return F.concat(*joined)
