"""Stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wicketflow.constants import TABLES

# How each table is laid out for lookups on its usual keys. Ranges over several columns also
# cut a long innings or match into more than one file.
LAYOUT = {
    "matches": {"partition_by": ["match_type"], "order_by": ["match_type", "date", "match_id"]},
    "players": {"order_by": ["player_id"]},
    "innings": {"order_by": ["match_id", "innings_id"]},
    "overs": {"order_by": ["innings_id", "over_number"]},
    "deliveries": {"order_by": ["match_id", "innings_id", "over_number", "ball_number"]},
    "player_match_stats": {"order_by": ["match_id", "player_team", "player_id"]},
}

# Feature tables keep the order they are computed in: dividing the large ones into ranges would
# compute their last step twice, once for the sample. The mart is laid out for its lookups.
FEATURE_LAYOUT = {k: LAYOUT[k] for k in ("matches", "player_match_stats")}


def _replace(spark: SparkSession, write, path: str) -> None:
    """Write a table next to the one it replaces and swap them when it is complete.

    A run that fails on the way leaves the old table as it is.
    """
    make = spark._jvm.org.apache.hadoop.fs.Path
    target = make(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    mark = uuid.uuid4().hex
    aside = lambda kind: make(target.getParent(), f"_{target.getName()}.{kind}.{mark}")
    fresh, old = aside("new"), aside("old")
    try:
        write(fresh.toString())
    except Exception:
        files.delete(fresh, True)
        raise
    replaced = files.exists(target)
    if replaced and not files.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(fresh, target):
        raise OSError(f"cannot move the new table to {path}; the old one is at {old.toString()}")
    if replaced:
        files.delete(old, True)


def write_tables(
    tables: dict[str, DataFrame],
    path: str,
    mode: str = "overwrite",
    layout: dict | None = None,
    distinct: bool = True,
) -> None:
    """Write each table without duplicate rows as Parquet under ``path``.

    ``distinct=False`` spares the shuffle that finds duplicates when there are none.

    ``mode="overwrite"`` replaces a table once the new one is complete, ``"ignore"`` keeps one that is
    there. ``layout`` maps a table to ``partition_by`` and ``order_by`` columns.
    """
    for name, df in tables.items():
        plan = (layout or {}).get(name, {})
        out = df.dropDuplicates() if distinct else df
        order = plan.get("order_by")
        if order:
            out = out.repartitionByRange(*order).sortWithinPartitions(*order)

        def write(to: str, out=out, plan=plan):
            writer = out.write.mode("errorifexists" if mode == "overwrite" else mode)
            if plan.get("partition_by"):
                writer = writer.partitionBy(*plan["partition_by"])
            writer.parquet(to)

        if mode == "overwrite":
            _replace(df.sparkSession, write, f"{path}/{name}")
        else:
            write(f"{path}/{name}")


# Bytes of a stored table that make a bucket, whose rows one task sorts and joins.
_BUCKET_BYTES = 16 << 20


def buckets_for(stored: DataFrame, least: int, size: int = _BUCKET_BYTES) -> int:
    """As many buckets as the size of a stored table asks for, so that a bucket does not grow with the table."""
    return max(least, -(-int(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // size))


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int, column: str = "innings_id") -> None:
    """Save as a catalog table bucketed on a join key, so that joins on it need no shuffle.

    ``buckets`` is the number of tasks that a later join can use; take it from the table's size. The rows
    are dealt out by the key first, so each bucket is one file.
    """
    writer = df.repartition(buckets, column).write.mode("overwrite").bucketBy(buckets, column).sortBy(column)
    writer.option("path", path).saveAsTable(table)


def join_bucketed(spark: SparkSession, tables: dict[str, DataFrame], path: str, buckets: int, column: str = "innings_id") -> DataFrame:
    """Tables stored in buckets of ``column`` and joined on it, bucket by bucket, without a shuffle."""
    joined = None
    for name, df in tables.items():
        table = f"{name}_{uuid.uuid4().hex[:12]}"
        save_bucketed(df, table, f"{path}/{name}", buckets, column)
        stored = spark.table(table).hint("merge")
        joined = stored if joined is None else joined.join(stored, column)
    return joined


def read_tables(spark: SparkSession, path: str, names=TABLES) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def catalog_schema(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Columns and types of a set of tables: ``table, position, column, type``."""
    rows = [
        (name, at, field.name, field.dataType.simpleString())
        for name, df in tables.items()
        for at, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, "`table` string, position int, `column` string, type string")


def catalog_tables(spark: SparkSession, database: str = "default") -> dict[str, DataFrame]:
    """The tables of a catalog database."""
    return {t.name: spark.table(f"{database}.{t.name}") for t in spark.catalog.listTables(database)}
