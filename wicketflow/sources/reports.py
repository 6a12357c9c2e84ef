"""CSV and report outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row; NULL is written as an empty field."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", '""').csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """What :func:`write_csv` wrote: an empty field is NULL, a quoted empty one an empty text."""
    # No field holds the character that stands for NULL here.
    return spark.read.option("header", True).option("nullValue", "\0").option("emptyValue", "").schema(schema).csv(path)


def report(df: DataFrame, section: str, key: str, *values: str) -> DataFrame:
    """Rows of a report in long form: ``section, key, value``."""
    pairs = F.inline(
        F.array(
            *[
                F.struct(
                    F.concat_ws(".", F.col(key).cast("string"), F.lit(v)).alias("key"),
                    F.col(v).cast("string").alias("value"),
                )
                for v in values
            ]
        )
    )
    return df.select(F.lit(section).alias("section"), pairs)


def single_row_report(df: DataFrame, section: str) -> DataFrame:
    """The columns of a one-row result as report rows."""
    pairs = F.inline(
        F.array(
            *[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in df.columns]
        )
    )
    return df.select(F.lit(section).alias("section"), pairs)


def write_report(rows: DataFrame, path: str) -> None:
    """Report rows as JSON lines in reading order."""
    rows.orderBy("section", "key").write.mode("overwrite").json(path)
