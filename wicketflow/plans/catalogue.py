"""The registered queries: one or more per operator, on tables projected from the given ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wicketflow import constants
from wicketflow.operators import (
    careers, consistency, features, identity, match_stats, profiling, quality, similarity, summaries, unnest,
)
from wicketflow.constants import RETYPE_SPEC
from wicketflow.plans import oracles, pipeline, projection
from wicketflow.scratch import shared_folder, stage
from wicketflow.sources import documents, reports, tables

Query = Callable[[SparkSession, str], DataFrame]


def _six_places(c: Column) -> Column:
    """A double rounded to 6 places as `round` does it, which goes through text: only where a number is large or halfway between two."""
    millionths = c * 1e6
    below = F.floor(millionths)
    plain = (F.abs(c) < 1e5) & (F.abs(millionths - below - 0.5) > 1e-3)
    return F.when(plain, F.floor(millionths + 0.5) / 1e6).otherwise(F.round(c, 6))


def tidy(df: DataFrame) -> DataFrame:
    """One type per kind of value: BIGINT, DOUBLE rounded to 6 places, dates as text."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.NumericType):
            c = _six_places(c.cast("double"))
        elif isinstance(field.dataType, (T.DateType, T.TimestampType)):
            c = c.cast("string")
        columns.append(c.alias(field.name))
    return df.select(*columns)


_PREPARED: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Stored once for each session and folder: queries then start from stored tables, as the job does."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _PREPARED:
        _PREPARED[key] = make()
    return _PREPARED[key]


def flat_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _once(spark, sf_dir, "flat", lambda: projection.flat_tables(spark, sf_dir))


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "documents", lambda: stage(spark, projection.documents(spark, sf_dir)))


def _flat(build: Callable[[dict[str, DataFrame]], DataFrame], *columns: str) -> Query:
    """A query on the flat projected tables, cut to ``columns``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = build(flat_tables(spark, sf_dir))
        return tidy(out.select(*columns) if columns else out)

    return run


def _deliveries(t):
    return features.add_delivery_features(t["deliveries"])


def _innings(t):
    return features.add_innings_features(t["innings"], t["deliveries"])


def _matches(t):
    return features.add_match_features(t["matches"], t["innings"])


def _overs(t):
    return features.add_over_features(t["overs"], t["innings"], t["deliveries"])


def _careers(t, **options):
    return careers.player_features(t["players"], t["deliveries"], t["matches"], **options)


def _mart(t, **options):
    return match_stats.player_match_stats(t["deliveries"], t["matches"], t["innings"], t["players"], **options)


def _featured(t):
    return {
        "deliveries": _deliveries(t), "innings": _innings(t), "matches": _matches(t),
        "overs": _overs(t), "players": _careers(t, groups=("basic",)), "player_match_stats": _mart(t),
    }


def _feature_queries() -> dict[str, Query]:
    return {
        "f_scorecard": _flat(_innings, "innings_id", "batting_team", "total_runs", "total_wickets", "run_rate"),
        "f01_boundary_type": _flat(_deliveries, "delivery_id", "batter_runs", "boundary_type"),
        "f02_is_dot_ball": _flat(_deliveries, "delivery_id", "total_runs", "is_dot_ball"),
        "f03_cumulative_runs": _flat(_deliveries, "delivery_id", "innings_id", "cumulative_runs_in_innings"),
        "f04_ball_in_over": _flat(_deliveries, "delivery_id", "over_id", "ball_in_over"),
        "f05_innings_totals": _flat(_innings, "innings_id", "total_runs", "total_wickets"),
        "f06_innings_run_rate": _flat(_innings, "innings_id", "run_rate"),
        "f07_boundary_count": _flat(_innings, "innings_id", "boundary_count"),
        "f08_dot_ball_percentage": _flat(_innings, "innings_id", "dot_ball_percentage", "dot_ball_share"),
        "f09_powerplay_runs": _flat(_innings, "innings_id", "powerplay_runs"),
        "f10_match_result": _flat(_matches, "match_id", "match_result"),
        "f11_margin_description": _flat(_matches, "match_id", "margin_description"),
        "f12_chasing_setting_team": _flat(_matches, "match_id", "chasing_team", "setting_team"),
        "f13_over_run_rate": _flat(_overs, "over_id", "run_rate"),
        "f14_is_powerplay": _flat(_overs, "over_id", "is_powerplay"),
        "f15_over_boundaries_dots": _flat(_overs, "over_id", "boundaries_in_over", "dot_balls_in_over"),
        "f16_over_cumulatives": _flat(
            _overs, "over_id", "cumulative_runs_in_innings", "cumulative_wickets_in_innings"
        ),
        **{
            name: _flat(lambda t, make=make, key=columns[0]: summaries.sample(make(t), 10, (key,)), *columns)
            for make, (name, columns) in zip((_innings, _deliveries, _matches, _overs), oracles.SAMPLES.items())
        },
        "f17_verify_features": _flat(lambda t: features.verify_features(_featured(t))),
    }


def _career_queries() -> dict[str, Query]:
    def groups(columns):
        return tuple(g for g, names in careers.GROUPS.items() if set(names) & set(columns))

    out = {
        key: _flat(lambda t, g=groups(columns): _careers(t, groups=g), "player_id", *columns)
        for key, columns in oracles.CAREER_QUERIES.items()
    }
    out["l10_centuries_uncapped"] = _flat(
        lambda t: _careers(t, groups=("milestones",), century_cap=False), "player_id", "centuries"
    )
    out["l26_top_run_scorers"] = _flat(
        lambda t: careers.top_run_scorers(_careers(t, groups=("basic", "highlights"))),
        "player_id", "player_name", *oracles._TOP,
    )
    return out


def _mart_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the mart with their types and the rows behind them."""
    mart = {"player_match_stats": _mart(flat_tables(spark, sf_dir))}
    rows = summaries.table_shape(mart).select("table", "rows")
    return tidy(tables.catalog_schema(spark, mart).join(rows, "table"))


def _mart_queries() -> dict[str, Query]:
    out = {
        key: _flat(_mart, *oracles._mart_columns(columns)) for key, columns in oracles.MART_QUERIES.items()
    }
    reduced = lambda t: _mart(t, variant="reduced")
    out["m01_role_join_reduced"] = _flat(reduced)
    out["m04_player_team_reduced"] = _flat(reduced, "match_id", "player_id", "player_team")
    out["m02_group_sizes"] = _flat(lambda t: _mart(t).groupBy("match_id").agg(F.count("*").alias("players")))
    out["m21_columns"] = _mart_listing
    out["m21_null_profile"] = _flat(lambda t: summaries.null_profile({"player_match_stats": _mart(t)}))
    out["m22_notable_performances"] = _flat(
        lambda t: match_stats.notable_performances(_mart(t)), *oracles._NOTABLE
    )
    return out


def _documents(build: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """A query on the projected match documents, stored once as the reader would."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = build(match_documents(spark, sf_dir))
        return tidy(out.select(*columns) if columns else out)

    return run


def _raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    """A query on the JSON text of the projected documents."""
    return _documents(lambda docs: build(projection.raw_documents(docs)))


def _named(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A query on stored deliveries with names and ids, and a stored players table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        deliveries, players = (
            _once(spark, sf_dir, n, lambda n=n: stage(spark, projection.table(spark, sf_dir, n))) for n in ("nd", "np")
        )
        return tidy(build(deliveries, players))

    return run


def _given(table: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    """A query on a given table."""
    return lambda spark, sf_dir: tidy(build(spark.read.parquet(f"{sf_dir}/{table}.parquet")))


class _Names:
    """What the job finds out about names, stored as the job stores it, from one pass over the documents."""

    def __init__(self, docs: DataFrame):
        self.docs, spark = docs, docs.sparkSession
        self.ledger = stage(spark, identity.ledger(docs))
        self.counted = stage(spark, identity.spellings(self.ledger))
        self.resolved = stage(spark, identity.resolved_names(self.counted))

    def gaps(self) -> DataFrame:
        return identity.resolve_gaps(self.ledger, self.resolved)

    def maps(self) -> DataFrame:
        return stage(self.docs.sparkSession, identity.gap_maps(self.gaps()))


def _unnested_matches(docs):
    return unnest.matches(docs, _Names(docs).maps())


def _unnested_deliveries(docs):
    return unnest.deliveries(docs, _Names(docs).maps())


def _unnested_players(docs):
    found = _Names(docs)
    return identity.players(found.counted, found.resolved)


def _all_names(docs):
    found = _Names(docs)
    return identity.player_names(found.ledger, found.resolved)


def _resolved_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every role of all deliveries by name, with the ids looked up in the names of the documents."""
    names = _all_names(match_documents(spark, sf_dir))
    balls = projection.table(spark, sf_dir, "n").select("delivery_id", "match_id", *oracles.ROLES)
    return tidy(identity.resolve_ids(balls, names, oracles.ROLES))


def _unnest_queries() -> dict[str, Query]:
    return {
        "u01_matches": _documents(_unnested_matches),
        "u02_event": _documents(_unnested_matches, "match_id", "match_event_name", "match_event_id", "match_number"),
        "u03_innings": _documents(unnest.innings),
        "u04_powerplay": _documents(unnest.innings, "innings_id", "powerplay_start_over", "powerplay_end_over"),
        "u05_bowling_team": _documents(unnest.innings, "innings_id", "bowling_team"),
        "u06_overs": _documents(unnest.overs),
        "u07_over_totals": _documents(unnest.overs, "over_id", "total_runs", "wickets", "num_deliveries"),
        "u08_over_extras": _documents(
            unnest.overs, "over_id", "total_extras", *[f"extras_{k}" for k in constants.EXTRAS_KINDS]
        ),
        "u09_deliveries": _documents(_unnested_deliveries),
        "u10_first_extras": _documents(_unnested_deliveries, "delivery_id", "extras_type", "extras_value"),
        "u11_first_wicket": _documents(
            _unnested_deliveries, "delivery_id", "is_wicket", "wicket_player_out", "wicket_kind", "wicket_fielder"
        ),
        "u12_player_names": _documents(_all_names),
        "u12_resolve_gaps": _documents(lambda docs: _Names(docs).gaps()),
        "u12_resolve_ids": _resolved_roles,
        "u13_players": _documents(_unnested_players),
        "u14_variant_stats": _documents(lambda docs: identity.player_variant_stats(_unnested_players(docs))),
        "u15_synthetic_count": _documents(lambda docs: identity.synthetic_count(_unnested_players(docs))),
    }


def _on_meta(build, *columns):
    return _documents(lambda docs: build(profiling.match_metadata(docs)), *columns)


def _profile_summary(raw):
    """The numbers of a run, counted while the documents are written: texts that are broken or without innings among them."""
    spark = raw.sparkSession
    observed, seen = profiling.observe_profile(documents.parse(_with_odd(raw)))
    stage(spark, observed.select("match_id", "doc", "reason"))
    return profiling.profile_summary(spark, seen)


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the deliveries and of the metadata."""
    tables_ = {
        "deliveries": flat_tables(spark, sf_dir)["deliveries"],
        "metadata": profiling.match_metadata(match_documents(spark, sf_dir)),
    }
    return tidy(summaries.union_all([summaries.describe_all(df).withColumn("table", F.lit(k)) for k, df in tables_.items()]))


def _profile_queries() -> dict[str, Query]:
    deliveries = lambda t: t["deliveries"]
    return {
        "p01_doc_structure": _raw(lambda raw: profiling.doc_structure(documents.parse(raw))),
        "p02_schema_variants": _raw(profiling.schema_profile),
        "p02_schema_variants_props": _given(
            "events", lambda e: profiling.schema_variants(e.select(F.col("props").alias("raw")), "top")
        ),
        "p03_top_variants": _raw(lambda raw: profiling.top_variants(profiling.schema_profile(raw))),
        "p04_match_type_counts": _documents(profiling.match_type_counts),
        "p05_reject_report": _given(
            "documents",
            lambda d: profiling.reject_report(
                documents.rejects_of(documents.parse(d.select(F.col("doc_id").cast("string").alias("match_id"), F.col("text").alias("raw"))))
            ),
        ),
        "p06_field_presence": _raw(profiling.field_presence),
        "p07_match_metadata": _on_meta(lambda meta: meta),
        "p07_short_metadata": _on_meta(profiling.short_metadata),
        "p08_document_totals": _on_meta(lambda meta: meta, "match_id", "total_overs_recorded", "total_deliveries"),
        "p09_describe_all": _described,
        "p10_null_profile": _on_meta(lambda meta: summaries.null_profile({"metadata": meta}, only_nulls=True)),
        "p11_empty_matches": _raw(
            lambda raw: profiling.empty_matches(
                profiling.match_metadata(documents.documents_of(documents.parse(_with_odd(raw))))
            ).select("match_id", "match_type")
        ),
        "p12_completeness_by_type": _on_meta(profiling.completeness_by_type),
        "p13_matches_per_year": _on_meta(profiling.matches_per_year),
        "p14_top_venues": _on_meta(lambda meta: summaries.value_counts(meta, "venue", 20)),
        "p14_top_team_pairs": _on_meta(lambda meta: summaries.value_counts(meta, "teams", 20)),
        "p15_similar_names": _given(
            "customer", lambda c: similarity.similar_names(c, "c_name", 0.9, lower=True)
        ),
        "p15_similar_venues": _on_meta(lambda meta: similarity.similar_names(meta, "venue", 0.85, lower=True)),
        "p16_registry_stats": _on_meta(profiling.registry_stats),
        "p17_quality_issues": _on_meta(
            profiling.quality_issues,
            "match_id", "match_type", "total_deliveries", "team1_players", "team2_players", "registry_count",
        ),
        "p18_json_types": _raw(profiling.json_types),
        "p19_describe_runs": _flat(lambda t: summaries.describe_runs(deliveries(t))),
        "p20_suspicious_deliveries": _named(lambda d, p: profiling.suspicious_deliveries(d)),
        "p21_run_share": _flat(lambda t: profiling.run_share(deliveries(t))),
        "p22_runs_distribution": _flat(lambda t: profiling.runs_distribution_raw(deliveries(t))),
        "p23_over_stats_by_type": _documents(profiling.over_stats_by_type),
        "p24_outlier_overs": _documents(profiling.outlier_overs),
        "p25_profile_summary": _raw(_profile_summary),
    }


def _schemas(spark, t):
    before = tables.catalog_schema(spark, t)
    after = tables.catalog_schema(spark, quality.retype_tables(t))
    return quality.schema_diff(before, after)


def _on_schemas(build) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = flat_tables(spark, sf_dir)
        return tidy(build(_schemas(spark, t), t))

    return run


def _with_ranges(diff, t):
    """All columns, changed or not, with the range of their values where one is reported."""
    ranges = summaries.column_ranges(quality.retype_tables(t), oracles.RANGES)
    return diff.join(ranges, ["table", "column"], "left")


def _quality_queries() -> dict[str, Query]:
    d = lambda build: _flat(lambda t: build(t["deliveries"]))
    mio = lambda build: _flat(lambda t: build(t["matches"], t["innings"], t["overs"]))
    names = lambda n, p: consistency.player_names_seen(n)
    small = {"over_number": "tinyint", "ball_number": "tinyint", "worth": "tinyint"}
    worth = lambda x: x.withColumn("worth", F.col("total_runs") * 20)
    pairs = lambda n, p: consistency.id_name_pairs(n)
    persons = lambda build: _named(lambda n, p: build(consistency.person_table(n, p)))
    return {
        "q01_table_shape": _flat(summaries.table_shape),
        "q01_sample": d(lambda x: summaries.sample(x, 20, ("delivery_id",))),
        "q02_column_ranges": _flat(lambda t: summaries.column_ranges(t, oracles.RANGES)),
        "q03_retype": d(lambda x: quality.retype(worth(x), small).select("delivery_id", "worth", *list(small)[:2])),
        "q03_retype_losses": d(lambda x: quality.retype_losses(worth(x), small)),
        "q04_schema_diff": _on_schemas(_with_ranges),
        "q05_conversion_summary": _on_schemas(
            lambda diff, t: quality.conversion_summary(diff, summaries.table_shape(t))
        ),
        "q06_storage_estimate": _on_schemas(
            lambda diff, t: quality.storage_estimate(diff, summaries.table_shape(t))
        ),
        "q07_null_profile": _flat(summaries.null_profile),
        "q08_venue_counts": _flat(lambda t: summaries.value_counts(t["matches"], "venue")),
        "q09_similar_venues": _flat(lambda t: similarity.similar_names_with_counts(t["matches"], "venue", 0.8)),
        "q09_similar_urls": _given("pages", lambda x: similarity.similar_names_with_counts(x, "url", 0.8)),
        "q10_invalid_runs": _named(lambda n, p: quality.invalid_runs(n)),
        "q10_invalid_runs_count": d(quality.invalid_runs_count),
        "q11_seven_run_share": d(quality.seven_run_share),
        "q12_match_overs_stats": mio(quality.match_overs_stats),
        "q13_overs_exceeded": mio(quality.overs_exceeded),
        "q13_overs_exceeded_count": mio(quality.overs_exceeded_count),
        "q14_over_length_dist": _flat(lambda t: quality.over_length_dist(t["overs"])),
        "q15_batter_run_dist": d(quality.batter_run_dist),
        "q16_run_outliers": _named(lambda n, p: quality.run_outliers(n)),
        "q17_extras_dist": d(quality.extras_dist),
        "q18_high_totals": _named(lambda n, p: quality.high_totals(n)),
        "q19_over_length_by_type": _flat(
            lambda t: quality.over_length_by_type(t["overs"], t["innings"], t["matches"])
        ),
        "q20_long_overs": _flat(lambda t: quality.long_overs(t["overs"], t["innings"], t["matches"])),
        "q21_over_length_factors": _flat(lambda t: quality.over_length_factors(t["overs"], t["deliveries"])),
        "q22_names_seen": _named(names),
        "q22_names_seen_reduced": _named(lambda n, p: consistency.reduced_names_seen(n)),
        "q23_player_id_issues": persons(consistency.player_id_issues),
        "q23_player_id_issues_reduced": persons(lambda x: consistency.player_id_issues(x, "reduced")),
        "q24_multiple_ids": persons(consistency.multiple_ids),
        "q25_missing_id_matches": persons(consistency.missing_id_matches),
        "q26_ids_with_many_names": _named(lambda n, p: consistency.ids_with_many_names(pairs(n, p))),
        "q27_name_variant_counts": _named(lambda n, p: consistency.name_variant_counts(pairs(n, p))),
        "q28_player_consistency": persons(consistency.player_consistency),
        "q28_reduced_consistency": persons(consistency.reduced_consistency),
        "q29_text_health": _given("documents", lambda x: consistency.text_health({"documents": x})),
        "q30_text_health_issues": _given(
            "documents", lambda x: consistency.text_health_issues(consistency.text_health({"documents": x}))
        ),
        "q31_summary": _flat(quality.summary),
    }


def _stored(build: Callable[[SparkSession, str, dict[str, DataFrame]], DataFrame]) -> Query:
    """A query that writes projected tables to a fresh shared folder and reads them back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(build(spark, shared_folder(spark), flat_tables(spark, sf_dir)))

    return run


def _written_twice(spark, folder, t):
    """Duplicate rows go in, distinct rows come out; the first write does not survive."""
    innings = t["innings"]
    tables.write_tables({"innings": innings.withColumn("batting_team", F.lit("replaced"))}, folder)
    tables.write_tables({"innings": innings.unionAll(innings)}, folder)
    return tables.read_tables(spark, folder, ("innings",))["innings"]


def _written_if_absent(spark, folder, t):
    innings = t["innings"]
    tables.write_tables({"innings": innings}, folder, mode="ignore")
    tables.write_tables({"innings": innings.where("innings_number = 1")}, folder, mode="ignore")
    return tables.read_tables(spark, folder, ("innings",))["innings"]


def _laid_out(spark, folder, t):
    """Both tables whole, as they lie stored: the deliveries in their ranges, the matches by type."""
    tables.write_tables({k: t[k] for k in ("deliveries", "matches")}, folder, layout=tables.LAYOUT)
    stored = tables.read_tables(spark, folder, ("deliveries", "matches"))
    return stored["deliveries"].join(stored["matches"].select("match_id", "match_type", "date"), "match_id")


#: Fewest buckets of the registered query; larger tables have more.
_BUCKETS = 8


def _bucketed(spark, folder, t):
    """Balls and innings stored in buckets and joined, with the number of shuffles in the plan of the join."""
    parts = {"innings": t["innings"].drop("match_id"), "deliveries": t["deliveries"]}
    joined = tables.join_bucketed(spark, parts, folder, tables.buckets_for(t["deliveries"], _BUCKETS))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    return joined.withColumn("shuffles", F.lit(plan.count("Exchange")))


def _mart_laid_out(spark, folder, t):
    tables.write_tables({"player_match_stats": _mart(t)}, folder, layout=tables.LAYOUT, distinct=False)
    return tables.read_tables(spark, folder, ("player_match_stats",))["player_match_stats"]


def _schema_listing(spark, folder, t):
    """The columns of stored tables with the rows behind them."""
    tables.write_tables(t, folder, distinct=False)
    stored = tables.read_tables(spark, folder)
    rows = summaries.table_shape(stored).select("table", "rows")
    return tables.catalog_schema(spark, stored).join(rows, "table")


def _through_csv(spark, folder, df):
    """What a table is after a way through CSV files."""
    df = tidy(df)
    reports.write_csv(df, folder)
    return reports.read_csv(spark, folder, df.schema)


def _csv(spark, folder, t):
    return _through_csv(spark, folder, t["overs"])


def _profile_csv(build: Callable[[DataFrame], DataFrame]) -> Query:
    """One of the CSV outputs of the job, on the metadata of the documents."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        meta = profiling.match_metadata(match_documents(spark, sf_dir))
        return tidy(_through_csv(spark, shared_folder(spark), build(meta)))

    return run


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole quality report, written and read back; values that are numbers as numbers."""
    t = flat_tables(spark, sf_dir)
    balls, players = (projection.table(spark, sf_dir, n) for n in ("nd", "np"))
    unfit = summaries.union_all([
        quality.unfit_values(t[name], spec).withColumn("table", F.lit(name)) for name, spec in RETYPE_SPEC.items()
    ])
    sections = pipeline.quality_sections(t, _schemas(spark, t), unfit, consistency.person_table(balls, players))
    folder = shared_folder(spark)
    reports.write_report(summaries.union_all(sections), folder)
    rows = spark.read.schema("section string, key string, value string").json(folder)
    number = F.col("value").try_cast("double")
    return tidy(rows.select("section", "key", number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text")))


def _with_odd(raw: DataFrame) -> DataFrame:
    """The texts of the documents, numbers written in other ways; for each fourth match a text without
    innings, for each fifth one that is broken and one that is no object."""
    odd = F.regexp_replace("raw", '"overs":([0-9]+)', '"overs":$1.0')
    odd = F.regexp_replace(odd, '"match_type_number":([0-9]+)', '"match_type_number":"$1"')
    number = F.regexp_extract("match_id", "([0-9]+)", 1).cast("bigint")
    named = lambda mark: F.concat("match_id", F.lit(mark))
    kind = F.regexp_extract("raw", '"match_type":"([^"]*)"', 1)
    no_balls = F.concat(F.lit('{"info":{"match_type":"'), kind, F.lit('","overs":"20.0"},"innings":[]}'))
    text = lambda match, raw: F.struct(match.alias("match_id"), raw.alias("raw"))
    # The texts of a document come from one look at it.
    texts = F.array(
        text(F.col("match_id"), odd),
        F.when(number % 4 == 0, text(named("-empty"), no_balls)),
        F.when(number % 5 == 0, text(named("-broken"), F.concat(F.lit("{"), "raw"))),
        F.when(number % 5 == 0, text(named("-list"), F.concat(F.lit("["), "raw", F.lit("]")))),
    )
    return raw.select(F.inline_outer(F.filter(texts, lambda x: x.isNotNull())))


def _match_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a JSON file for each odd text, as the job finds it."""
    folder = shared_folder(spark)
    documents.write_raw(_with_odd(projection.raw_documents(match_documents(spark, sf_dir))), folder)
    return folder


def _read_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(profiling.match_metadata(documents.read_matches(spark, _match_files(spark, sf_dir))))


def _read_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file with the start of its text, and what became of it."""
    folder = _match_files(spark, sf_dir)
    rejects = documents.read_rejects(spark, folder).select("match_id", "reason")
    # Cut before the join: the whole texts would be shuffled otherwise.
    starts = documents.read_raw(spark, folder).select("match_id", F.substring("raw", 1, 2).alias("start"))
    files = starts.join(rejects, "match_id", "left")
    return tidy(files.select("match_id", "start", F.coalesce("reason", F.lit("read")).alias("outcome")))


def _reader_queries() -> dict[str, Query]:
    return {"s01_read_matches": _read_matches, "s02_read_raw": _read_raw}


def _sink_queries() -> dict[str, Query]:
    return {
        "s04_write_replace": _stored(_written_twice),
        "s05_write_if_absent": _stored(_written_if_absent),
        "s06_layout": _stored(_laid_out),
        "m23_mart_layout": _stored(_mart_laid_out),
        "s10_catalog_schema": _stored(_schema_listing),
        "s06_bucketed_join": _stored(_bucketed),
        "s07_csv": _stored(_csv),
        "s07_metadata_csv": _profile_csv(lambda meta: meta),
        "s07_similar_venues_csv": _profile_csv(lambda meta: similarity.similar_names(meta, "venue", 0.85, lower=True)),
        "s07_issues_csv": _profile_csv(profiling.quality_issues),
        "s08_report": _report,
    }


def queries() -> dict[str, Query]:
    return {
        **_feature_queries(), **_career_queries(), **_mart_queries(),
        **_unnest_queries(), **_profile_queries(), **_quality_queries(), **_reader_queries(), **_sink_queries(),
    }
