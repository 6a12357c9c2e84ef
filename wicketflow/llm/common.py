"""What several operators of this folder share."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wicketflow.session import importable

#: A word, in Java's and Python's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
#: The columns of `documents`.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Name of the row number that operators add; a table with a column of this name is refused.
ROW = "__row__"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row(df: DataFrame) -> DataFrame:
    """Number the rows; the same input files give the same numbers in every pass over them.

    Behind a shuffle nothing fixes the order, so a table that does not come straight from files is to be stored
    before it is given to an operator that passes over it more than once.
    """
    if ROW in df.columns:
        raise ValueError(f"{ROW} is a reserved column name")
    return df.withColumn(ROW, F.monotonically_increasing_id())


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels no model may see: crc32 of the id as text is 1 mod 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def is_held_out(doc_id: int | None) -> bool:
    """`held_out` for one id."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


class Recent(dict):
    """A table that forgets: of at most about twice `most` entries, those used lately."""

    def __init__(self, most: int):
        super().__init__()
        self.old: dict = {}
        self.most = most

    def recall(self, key):
        """The value of a key that is not in the table itself, from before the last turn, or None."""
        found = self.old.get(key)
        if found is not None:
            self[key] = found
        return found

    def missing(self, keys: set) -> list:
        """Those of the keys that neither the table nor its past has; those of the past are brought back."""
        gone = keys.difference(self)
        past = gone.intersection(self.old)
        for key in past:
            self[key] = self.old[key]
        return list(gone.difference(past))

    def turn(self) -> None:
        """Start anew when full; called only where no look-up relies on the entries."""
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
