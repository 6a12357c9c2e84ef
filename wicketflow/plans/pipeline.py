"""The whole job: documents in, tables, reports, features and mart out.

Every step reads stored tables and writes stored tables, so a step can be run on its own and
lost executors cost no more than the work of one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wicketflow.constants import RANGE_SPEC, RETYPE_SPEC, TABLE_KEYS, TABLES
from wicketflow.operators import (
    careers, consistency, features, identity, match_stats, profiling, quality, similarity, summaries, unnest,
)
from wicketflow.sources import reports
from wicketflow.sources.documents import documents_of, double_files, parse, read_raw, reject_messages, rejects_of
from wicketflow.sources.tables import FEATURE_LAYOUT, LAYOUT, catalog_schema, read_tables, write_tables


def _store(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def ingest(spark: SparkSession, source: str, out: str) -> DataFrame:
    """Parse the JSON files once; one write holds the documents and the rejected files.

    Equal files of one match come once, so the tables made from documents need no search for
    duplicates; they are found by name and digest, no text is shuffled. The numbers of the run are
    counted while the documents are written.
    """
    doubles = _store(spark, double_files(spark, source), f"{out}/double_files")
    parsed = parse(read_raw(spark, source, skip=doubles))
    observed, seen = profiling.observe_profile(parsed)
    split = observed.select("match_id", "doc", "reason", F.when(F.col("reason").isNotNull(), F.col("raw")).alias("raw"))
    split.withColumn("ok", F.col("reason").isNull()).write.mode("overwrite").partitionBy("ok").parquet(f"{out}/files")
    _store(spark, profiling.profile_summary(spark, seen), f"{out}/profile/summary")
    return read_documents(spark, out)


def _read_files(spark: SparkSession, out: str, ok: bool) -> DataFrame:
    return spark.read.parquet(f"{out}/files").where(F.col("ok") == ok)


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    return documents_of(_read_files(spark, out, True))


def read_rejected(spark: SparkSession, out: str) -> DataFrame:
    return rejects_of(_read_files(spark, out, False))


def profile(spark: SparkSession, source: str, out: str) -> None:
    """Tables, CSV outputs and a report on the documents and on the texts they come from."""
    docs = read_documents(spark, out)
    texts = read_raw(spark, source, skip=spark.read.parquet(f"{out}/double_files"))
    raw = _store(spark, profiling.raw_profile(texts), f"{out}/profile/raw")
    meta = _store(spark, profiling.match_metadata(docs), f"{out}/profile/metadata")
    results = {
        "key_sets": profiling.variants_of(raw),
        "value_types": profiling.types_of(raw),
        "field_presence": profiling.presence_of(raw),
        "metadata_description": summaries.describe_all(meta),
        "completeness_by_type": profiling.completeness_by_type(meta),
        "over_stats_by_type": profiling.over_stats_by_type(docs),
        "outlier_overs": profiling.outlier_overs(docs),
        "rejected_files": reject_messages(read_rejected(spark, out)),
    }
    stored = {name: _store(spark, df, f"{out}/profile/{name}") for name, df in results.items()}
    venues = similarity.similar_names(meta, "venue", 0.9, lower=True)
    reports.write_csv(meta, f"{out}/profile/metadata_csv")
    reports.write_csv(venues.orderBy(F.desc("similarity"), "name1", "name2"), f"{out}/profile/similar_venues_csv")
    reports.write_csv(profiling.quality_issues(meta), f"{out}/profile/matches_with_issues_csv")
    rejects = read_rejected(spark, out)
    sections = [
        reports.report(spark.read.parquet(f"{out}/profile/summary"), "profile", "key", "value"),
        reports.report(profiling.reject_report(rejects), "rejects", "key", "value"),
        reports.report(stored["rejected_files"], "messages", "match_id", "message"),
        reports.report(profiling.empty_matches(meta), "empty_matches", "match_id", "match_type"),
        reports.report(summaries.null_profile({"metadata": meta}, only_nulls=True), "nulls", "column", "null_count", "null_percentage"),
        reports.report(profiling.matches_per_year(meta), "years", "year", "matches"),
        reports.report(summaries.value_counts(meta, "venue", 20), "top_venues", "venue", "count"),
        reports.report(summaries.value_counts(meta, "teams", 20), "top_teams", "teams", "count"),
        reports.report(profiling.top_variants(stored["key_sets"]).withColumn("at", F.concat_ws(":", "level", "keys")), "key_sets", "at", "count"),
        reports.report(stored["field_presence"], "fields", "field", "deliveries", "percentage", "required"),
        reports.report(stored["completeness_by_type"], "completeness", "match_type", *[c for c in stored["completeness_by_type"].columns if c != "match_type"]),
        reports.report(stored["over_stats_by_type"], "overs", "match_type", "count", "mean", "std", "min", "max"),
        reports.single_row_report(profiling.registry_stats(meta), "registry"),
    ]
    reports.write_report(summaries.union_all(sections), f"{out}/profile/report")


def store_names(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The ledger of names, its sums by spelling, the ids found for gaps, and the latter as one map per match."""
    names = _store(spark, identity.ledger(read_documents(spark, out)), f"{out}/names")
    counted = _store(spark, identity.spellings(names), f"{out}/name_spellings")
    resolved = _store(spark, identity.resolved_names(counted), f"{out}/resolved_names")
    gaps = _store(spark, identity.gap_maps(identity.resolve_gaps(names, resolved)), f"{out}/name_gap_maps")
    return names, counted, resolved, gaps


def unnest_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The five tables as they come from the documents, which are read once for the names and once for each table.

    What is found out about names is stored first: the planner then knows how large it is when it
    joins it with the documents.
    """
    docs = read_documents(spark, out)
    _, counted, resolved, gaps = store_names(spark, out)
    raw = {
        "matches": unnest.matches(docs, gaps),
        "innings": unnest.innings(docs),
        "overs": unnest.overs(docs),
        "deliveries": unnest.deliveries(docs, gaps),
        "players": identity.players(counted, resolved),
    }
    write_tables(raw, f"{out}/unnested", distinct=False)
    return read_tables(spark, f"{out}/unnested")


def retype_stored(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables with narrow types, laid out for lookups.

    The types are the same in every run. A value that does not fit becomes NULL and is kept, with
    its key, in a table of its own.
    """
    raw = read_tables(spark, f"{out}/unnested")
    unfit = [
        quality.unfit_values(raw[name], spec, *TABLE_KEYS[name])
        .select(F.lit(name).alias("table"), F.concat_ws(",", *TABLE_KEYS[name]).alias("key"), "column", "type", "value")
        for name, spec in RETYPE_SPEC.items()
    ]
    _store(spark, summaries.union_all(unfit), f"{out}/quality/unfit_values")
    typed = quality.retype_tables(raw)
    # Rows are already distinct; a second pass over them would only shuffle them again.
    write_tables(typed, f"{out}/tables", layout=LAYOUT, distinct=False)
    diff = quality.schema_diff(catalog_schema(spark, raw), catalog_schema(spark, typed))
    _store(spark, diff, f"{out}/quality/schema_diff")
    return read_tables(spark, f"{out}/tables")


def check_rows(spark: SparkSession, t: dict[str, DataFrame], persons: DataFrame, out: str) -> None:
    """The results of the checks that are more than a few numbers, a table each under ``quality``."""
    d, m, i, o = (t[k] for k in ("deliveries", "matches", "innings", "overs"))
    pairs = consistency.id_name_pairs(d)
    results = {
        "runs_description": summaries.describe_runs(d),
        "run_shares": profiling.run_share(d),
        "total_run_counts": profiling.runs_distribution_raw(d),
        "suspicious_deliveries": profiling.suspicious_deliveries(d),
        "invalid_runs": quality.invalid_runs(d),
        "batter_run_counts": quality.batter_run_dist(d),
        "run_outliers": quality.run_outliers(d),
        "high_totals": quality.high_totals(d),
        "extras_counts": quality.extras_dist(d),
        "match_overs": quality.match_overs_stats(m, i, o),
        "overs_exceeded": quality.overs_exceeded(m, i, o),
        "over_lengths_by_type": quality.over_length_by_type(o, i, m),
        "over_length_factors": quality.over_length_factors(o, d),
        "long_overs": quality.long_overs(o, i, m),
        "venue_counts": summaries.value_counts(m, "venue"),
        "similar_venues": similarity.similar_names_with_counts(m, "venue", 0.8),
        "name_issues": consistency.player_id_issues(persons),
        "names_with_many_ids": consistency.multiple_ids(persons),
        "matches_of_unknown_names": consistency.missing_id_matches(persons),
        "ids_with_many_names": consistency.ids_with_many_names(pairs),
        "name_variants": consistency.name_variant_counts(pairs),
        "name_consistency": consistency.player_consistency(persons),
    }
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{out}/quality/{name}")


def quality_sections(t: dict[str, DataFrame], diff: DataFrame, unfit: DataFrame, persons: DataFrame) -> list[DataFrame]:
    """The sections of the quality report on the tables ``t``, as rows ``section, key, value``."""
    shape = summaries.table_shape(t)
    at = lambda df, *columns: df.withColumn("at", F.concat_ws(".", *columns))
    lost = unfit.groupBy("table", "column", "type").agg(F.count("*").alias("lost"))
    return [
        reports.report(shape, "tables", "table", "rows", "columns"),
        reports.report(at(summaries.column_ranges(t, RANGE_SPEC), "table", "column"), "ranges", "at", "min_value", "max_value"),
        reports.report(at(summaries.null_profile(t, only_nulls=True), "table", "column"), "nulls", "at", "null_count", "null_percentage"),
        reports.single_row_report(diff.agg(F.count_if("changed").alias("type_conversions")), "conversions"),
        reports.report(at(lost, "table", "column"), "unfit_values", "at", "type", "lost"),
        reports.report(quality.storage_estimate(diff, shape), "storage", "table", "bytes_before", "bytes_after", "savings_pct"),
        reports.single_row_report(quality.invalid_runs_count(t["deliveries"]), "validation"),
        reports.single_row_report(quality.seven_run_share(t["deliveries"]), "validation"),
        reports.single_row_report(quality.overs_exceeded_count(t["matches"], t["innings"], t["overs"]), "validation"),
        reports.report(quality.over_length_dist(t["overs"]), "over_lengths", "num_deliveries", "over_count", "percentage"),
        reports.report(consistency.reduced_consistency(persons), "players", "key", "value"),
        reports.report(at(consistency.text_health(t), "table", "column", "class"), "text", "at", "values", "percentage"),
        quality.summary(t),
    ]


def check_tables(spark: SparkSession, out: str) -> None:
    """Quality report on the stored tables, and the results of the checks as tables."""
    t = read_tables(spark, f"{out}/tables")
    persons = _store(spark, consistency.person_table(t["deliveries"], t["players"]), f"{out}/quality/persons")
    check_rows(spark, t, persons, out)
    diff, unfit = (spark.read.parquet(f"{out}/quality/{name}") for name in ("schema_diff", "unfit_values"))
    reports.write_report(summaries.union_all(quality_sections(t, diff, unfit, persons)), f"{out}/quality/report")


def build_features(spark: SparkSession, out: str, variant: str = "full") -> dict[str, DataFrame]:
    """Feature tables and the player-by-match mart, stored with a verification report."""
    t = read_tables(spark, f"{out}/tables")
    d, m, i, o, p = (t[k] for k in ("deliveries", "matches", "innings", "overs", "players"))
    built = {
        "deliveries": features.add_delivery_features(d),
        "innings": features.add_innings_features(i, d),
        "matches": features.add_match_features(m, i),
        "overs": features.add_over_features(o, i, d),
        "players": careers.player_features(p, d, m, century_cap=variant == "full"),
        "player_match_stats": match_stats.player_match_stats(d, m, i, p, variant=variant),
    }
    write_tables(built, f"{out}/features", layout=FEATURE_LAYOUT, distinct=False)
    stored = read_tables(spark, f"{out}/features", (*TABLES, "player_match_stats"))
    checks = features.verify_features(stored)
    reports.write_report(reports.report(checks, "features", "feature", "rows"), f"{out}/features/report")
    return stored


def run(spark: SparkSession, source: str, out: str, variant: str = "full") -> dict[str, DataFrame]:
    """From a folder of match files to features and mart under ``out``."""
    ingest(spark, source, out)
    profile(spark, source, out)
    unnest_tables(spark, out)
    retype_stored(spark, out)
    check_tables(spark, out)
    return build_features(spark, out, variant)
