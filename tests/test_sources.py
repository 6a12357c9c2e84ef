"""Stored tables, catalog listings and reports."""

import pytest
import uuid

from pyspark.sql import functions as F

from wicketflow.operators import profiling, quality, summaries
from wicketflow.scratch import stage
from wicketflow.sources import reports, tables
from wicketflow.sources.documents import read_raw


def _balls(spark):
    return spark.range(60).select(
        (F.col("id") % 5).cast("string").alias("innings_id"), F.col("id").cast("string").alias("delivery_id")
    )


def test_replace_and_keep(spark, tmp_path):
    first, second = spark.range(3).toDF("player_id"), spark.range(5).toDF("player_id")
    write = lambda df, mode: tables.write_tables({"players": df}, str(tmp_path), mode=mode)
    count = lambda: tables.read_tables(spark, str(tmp_path), ("players",))["players"].count()
    write(first.union(first), "overwrite")
    assert count() == 3
    write(second, "ignore")
    assert count() == 3
    write(second, "overwrite")
    assert count() == 5


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    names = [f"t{uuid.uuid4().hex[:8]}" for _ in range(2)]
    for name in names:
        tables.save_bucketed(_balls(spark), name, str(tmp_path / name), buckets=4)
    try:
        listed = tables.catalog_tables(spark)
        left, right = (listed[n] for n in names)
        joined = left.hint("merge").join(right, "innings_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 5 * 12 * 12
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_schema_listing_and_diff(spark):
    before = {"overs": spark.range(3).selectExpr("id AS total_runs", "'x' AS over_id")}
    after = quality.retype_tables(before, {"overs": {"total_runs": "tinyint"}})
    listing = tables.catalog_schema(spark, before)
    assert [tuple(r) for r in listing.collect()] == [("overs", 1, "total_runs", "bigint"), ("overs", 2, "over_id", "string")]
    diff = {r.column: (r.type_before, r.type_after, r.changed) for r in quality.schema_diff(listing, tables.catalog_schema(spark, after)).collect()}
    assert diff == {"total_runs": ("bigint", "tinyint", True), "over_id": ("string", "string", False)}


def test_missing_column_is_reported_not_raised(spark):
    ranges = summaries.column_ranges({"t": spark.range(3)}, {"t": ("id", "nothing")}).collect()
    assert {r.column: r.min_value for r in ranges} == {"id": "0", "nothing": "Error: no column nothing"}


def test_values_that_do_not_fit(spark):
    df = spark.createDataFrame([(5,), (300,), (None,)], "n int")
    assert [r.n for r in quality.retype(df, {"n": "tinyint"}).collect()] == [5, None, None]
    assert quality.retype_losses(df, {"n": "tinyint"}).collect()[0].lost == 1
    assert [tuple(r) for r in quality.unfit_values(df, {"n": "tinyint"}).collect()] == [("n", "tinyint", "300")]
    assert quality.unfit_values(df, {"n": "smallint"}, "n").collect() == []


def test_report_rows(spark, tmp_path):
    rows = reports.single_row_report(spark.sql("SELECT 1 AS a, 'x' AS b"), "s")
    reports.write_report(rows, str(tmp_path / "r"))
    assert {(r.section, r.key, r.value) for r in spark.read.json(str(tmp_path / "r")).collect()} == {("s", "a", "1"), ("s", "b", "x")}


def test_field_presence_survives_gaps(spark, documents_dir):
    """Matches without innings, innings without overs and overs without balls take nothing away."""
    raw = read_raw(spark, documents_dir)
    rows = {r.field: r for r in profiling.field_presence(raw).collect()}
    balls = sum(r["count"] for r in profiling.schema_variants(raw, "delivery").collect())
    assert rows["batter"].deliveries == balls and rows["batter"].required and not rows["extras"].required
    assert rows["runs"].deliveries == balls - 1 and rows["batter"].files_percentage > 100


def test_types_of_values(spark):
    raw = spark.createDataFrame([('{"info": {"a": 1, "b": "x", "c": null, "d": [1], "e": 1.5, "f": true},'
                                  ' "innings": [{"overs": [{"deliveries": [{"runs": {"total": 4}, "batter": "Z"}]}]}]}',)], "raw string")
    found = {(r.section, r.field): r.type for r in profiling.json_types(raw).collect()}
    assert found == {
        ("info", "a"): "int", ("info", "b"): "str", ("info", "c"): "NoneType", ("info", "d"): "list", ("info", "e"): "float",
        ("info", "f"): "bool", ("delivery", "runs"): "dict", ("delivery", "runs.total"): "int", ("delivery", "batter"): "str",
    }


def test_staged_tables_lie_in_the_named_folder(spark, tmp_path):
    class Session:
        """The session with the setting a cluster would have."""

        class conf:
            get = staticmethod(lambda key, default=None: str(tmp_path) if key == "spark.checkpoint.dir" else default)

        read, sparkContext, _jvm = spark.read, spark.sparkContext, spark._jvm

    assert str(tmp_path) in stage(Session, spark.range(3)).inputFiles()[0]


def test_no_machine_local_folder_on_a_cluster():
    from wicketflow.scratch import base_folder

    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            base_folder(None, master)
        assert base_folder("hdfs://shared/x/", master) == "hdfs://shared/x"
    assert base_folder(None, "local[4]") == base_folder(None, "local")


def test_buckets_grow_with_the_table(spark, tmp_path):
    spark.range(200000).selectExpr("id", "md5(string(id)) AS x").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    size = sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet"))
    assert tables.buckets_for(stored, 8) == 8
    assert size // 100_000 <= tables.buckets_for(stored, 8, size=100_000) <= size // 100_000 + 1
