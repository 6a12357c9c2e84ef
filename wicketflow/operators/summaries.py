"""Generic summaries of any table: counts, ranges, NULLs, descriptions."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wicketflow.functions.columns import flag, percent, total


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _long(row: DataFrame, entries: list[Column]) -> DataFrame:
    """A one-row result turned into one row per entry."""
    return row.select(F.inline(F.array(*entries)))


def top_k(df: DataFrame, column: str, k: int, *ties: str) -> DataFrame:
    """The ``k`` rows with the largest value of ``column``; further columns break ties."""
    return df.orderBy(F.col(column).desc(), *ties).limit(k)


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; NULLs are left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    if k is None:
        return counts.orderBy(F.desc("count"), column)
    return top_k(counts, "count", k, column)


def table_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    return union_all(
        [
            df.agg(
                F.lit(name).alias("table"), F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns")
            )
            for name, df in tables.items()
        ]
    )


def sample(df: DataFrame, n: int = 20, order_by: tuple[str, ...] = ()) -> DataFrame:
    """The first ``n`` rows, in the given order if any."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def column_ranges(tables: dict[str, DataFrame], spec: dict[str, tuple[str, ...]]) -> DataFrame:
    """Smallest and largest value of listed columns as text, one pass per table.

    A column that is not there is reported in the values instead of failing the others.
    """
    frames = []
    for name, columns in spec.items():
        df = tables[name]
        here = [c for c in columns if c in df.columns]
        aggregates = [f(F.col(c)).cast("string").alias(f"{w}_{c}") for c in here for w, f in (("lo", F.min), ("hi", F.max))]
        missing = "Error: no column {}"
        entries = [
            F.struct(
                F.lit(name).alias("table"), F.lit(c).alias("column"),
                (F.col(f"lo_{c}") if c in here else F.lit(missing.format(c))).alias("min_value"),
                (F.col(f"hi_{c}") if c in here else F.lit(missing.format(c))).alias("max_value"),
            )
            for c in columns
        ]
        frames.append(_long(df.agg(F.count("*").alias("rows"), *aggregates), entries))
    return union_all(frames)


def null_profile(tables: dict[str, DataFrame], only_nulls: bool = False) -> DataFrame:
    """NULLs per column and table in one pass per table: count, rows and percentage.

    ``only_nulls`` keeps the columns that have some, most NULLs first.
    """
    frames = []
    for name, df in tables.items():
        counted = df.agg(
            F.count("*").alias("total_rows"),
            *[total(flag(F.col(c).isNull())).alias(f"n{k}") for k, c in enumerate(df.columns)],
        )
        entries = [
            F.struct(
                F.lit(name).alias("table"), F.lit(c).alias("column"),
                F.coalesce(f"n{k}", F.lit(0).cast("bigint")).alias("null_count"), F.col("total_rows"),
                F.coalesce(percent(F.col(f"n{k}"), F.col("total_rows")), F.lit(0.0)).alias("null_percentage"),
            )
            for k, c in enumerate(df.columns)
        ]
        frames.append(_long(counted, entries))
    out = union_all(frames)
    if only_nulls:
        out = out.where(F.col("null_count") > 0).orderBy(F.desc("null_count"), "table", "column")
    return out


def _describe_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    stats = {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
    }
    row = df.agg(
        *[
            f(F.col(c).cast("double")).alias(f"{s}{k}") for k, c in enumerate(columns) for s, f in stats.items()
        ]
    )
    none = F.lit(None)
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"count{k}").alias("count"),
            none.cast("bigint").alias("unique"), none.cast("string").alias("top"),
            none.cast("bigint").alias("freq"),
            *[F.col(f"{s}{k}").alias(s) for s in ("mean", "std", "min", "max")],
        )
        for k, c in enumerate(columns)
    ]
    return _long(row, entries)


# Bytes of a stored table that make a task of its counted values, and most tasks where the size is a guess.
_TASK_BYTES, _MOST_TASKS = 4 << 20, 2000


def _counted_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    """How often each value of each column occurs: ``column, value, n``.

    A batch of rows is counted where it is read, so a frequent value is one row of each batch, and a column of distinct
    values fills no table in front of the shuffle. Counts meet in as many parts as the size of the table asks for.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, values in zip(columns, batch.columns):
                found = values.drop_null().value_counts()
                names = pa.array([name] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays([names, found.field(0).cast(pa.string()), found.field(1)], names=["column", "value", "n"])

    texts = df.select(*[F.col(c).cast("string").alias(f"c{k}") for k, c in enumerate(columns)])
    counted = texts.mapInArrow(count, "column string, value string, n bigint")
    stored = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-stored // _TASK_BYTES), _MOST_TASKS))
    return counted.repartition(parts, "column", "value").groupBy("column", "value").agg(F.sum("n").alias("n"))


def _describe_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    none = F.lit(None).cast("double")
    return _counted_texts(df, columns).groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    ).select("*", *[none.alias(s) for s in ("mean", "std", "min", "max")])


def describe_all(df: DataFrame) -> DataFrame:
    """Count, unique, top and freq of text and flag columns; mean, std, min, max of numbers.

    Equal top values are settled by the smaller one. Values are counted before they are
    compared, so a frequent value is one row after the first aggregation.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    texts = [f.name for f in df.schema.fields if f.name not in numeric]
    frames = [make(df, names) for make, names in ((_describe_numbers, numeric), (_describe_texts, texts)) if names]
    return union_all(frames)


def describe_runs(deliveries: DataFrame, columns=("batter_runs", "extras", "total_runs")) -> DataFrame:
    """Count, mean, std, min, quartiles and max of the runs of a ball.

    Quartiles are exact and interpolated. Runs are counted per value first: what meets in one
    place is one row per distinct number of runs.
    """
    values = F.inline(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("value")) for c in columns])
    )
    counts = deliveries.select(values).groupBy("column", "value").agg(F.count("*").alias("n"))
    n, v = F.sum("n"), F.col("value").cast("double")
    mean = F.sum(v * F.col("n")) / n
    spread = F.sum(v * v * F.col("n")) - n * mean * mean
    return counts.where(F.col("value").isNotNull()).groupBy("column").agg(
        n.alias("count"),
        mean.alias("mean"),
        F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1))).alias("std"),
        F.min("value").alias("min"),
        *[
            F.expr(f"percentile(value, {q}, n)").alias(name)
            for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
        ],
        F.max("value").alias("max"),
    )


def share_of(df: DataFrame, column: str, values: range) -> DataFrame:
    """Percentage of rows at each of a few values, in one pass."""
    row = df.agg(
        F.count("*").alias("rows"),
        *[total(flag(F.col(column) == v)).alias(f"n{v}") for v in values],
    )
    entries = [
        F.struct(F.lit(v).alias(column), percent(F.col(f"n{v}"), F.col("rows")).alias("percentage")) for v in values
    ]
    return _long(row, entries)
