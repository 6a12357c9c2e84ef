"""Quality reports on the unnested tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.constants import DEFAULT_TYPE_BYTES, LIMITED_OVERS_TYPES, RETYPE_SPEC, TYPE_BYTES
from wicketflow.functions.columns import flag, per, percent, total
from wicketflow.operators.summaries import top_k, union_all, value_counts

# ------------------------------------------------------------------ types


def retype(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Cast the listed columns; a value that does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in spec.items() if c in df.columns})


def retype_tables(tables: dict[str, DataFrame], spec: dict = RETYPE_SPEC) -> dict[str, DataFrame]:
    return {name: retype(df, spec.get(name, {})) for name, df in tables.items()}


def retype_losses(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """How many values of each listed column do not fit its new type."""
    columns = [c for c in spec if c in df.columns]
    row = df.agg(
        *[
            total(flag(F.col(c).isNotNull() & F.col(c).try_cast(spec[c]).isNull())).alias(f"n{k}")
            for k, c in enumerate(columns)
        ]
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(spec[c]).alias("type"), F.coalesce(f"n{k}", F.lit(0)).alias("lost"))
        for k, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*entries)))


def unfit_values(df: DataFrame, spec: dict[str, str], *keys: str) -> DataFrame:
    """Every value that does not fit its new type, with the row's keys: ``keys, column, type, value``."""
    columns = [c for c in spec if c in df.columns]
    entries = [
        F.when(
            F.col(c).isNotNull() & F.col(c).try_cast(spec[c]).isNull(),
            F.struct(F.lit(c).alias("column"), F.lit(spec[c]).alias("type"), F.col(c).cast("string").alias("value")),
        )
        for c in columns
    ]
    kept = F.filter(F.array(*entries), lambda x: x.isNotNull())
    return df.select(*keys, F.inline(kept))


def schema_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Types of each column in two schema listings, and whether they differ."""
    joined = before.select("table", "column", F.col("type").alias("type_before")).join(
        after.select("table", "column", F.col("type").alias("type_after")), ["table", "column"]
    )
    return joined.withColumn("changed", F.col("type_before") != F.col("type_after"))


def conversion_summary(diff: DataFrame, row_counts: DataFrame) -> DataFrame:
    """Changed columns by pair of types, with the values converted and the share of columns."""
    everything = Window.partitionBy()
    counted = diff.join(row_counts.select("table", F.col("rows").alias("row_count")), "table")
    pairs = counted.groupBy("type_before", "type_after", "changed").agg(
        F.count("*").alias("columns"), F.sum("row_count").alias("values")
    )
    return (
        pairs.withColumn("column_share", percent(F.col("columns"), F.sum("columns").over(everything)))
        .where("changed").drop("changed")
    )


def storage_estimate(diff: DataFrame, row_counts: DataFrame) -> DataFrame:
    """Estimated bytes of each table before and after retyping."""
    sizes = F.create_map(*[F.lit(x) for pair in TYPE_BYTES.items() for x in pair])
    width = lambda c: F.coalesce(F.try_element_at(sizes, F.col(c)), F.lit(DEFAULT_TYPE_BYTES))
    per_table = diff.groupBy("table").agg(
        F.sum(width("type_before")).alias("width_before"), F.sum(width("type_after")).alias("width_after")
    )
    rows = row_counts.select("table", F.col("rows").alias("row_count"))
    sized = per_table.join(rows, "table").select(
        "table", "row_count",
        (F.col("width_before") * F.col("row_count")).alias("bytes_before"),
        (F.col("width_after") * F.col("row_count")).alias("bytes_after"),
    )
    saved = F.col("bytes_before") - F.col("bytes_after")
    return sized.select("*", saved.alias("savings"), percent(saved, F.col("bytes_before")).alias("savings_pct"))


# ------------------------------------------------------------------ runs

_BALL = ("delivery_id", "match_id", "batter", "bowler", "batter_runs", "extras", "total_runs")


def invalid_runs(deliveries: DataFrame, above: int = 7, n: int = 10) -> DataFrame:
    """Balls with more batter runs than can be scored, highest first."""
    rows = deliveries.where(F.col("batter_runs") > above)
    return top_k(rows.select("delivery_id", "batter", "bowler", "match_id", "batter_runs"), "batter_runs", n, "delivery_id")


def invalid_runs_count(deliveries: DataFrame, above: int = 7) -> DataFrame:
    return deliveries.agg(total(flag(F.col("batter_runs") > above)).alias("count_invalid"))


def seven_run_share(deliveries: DataFrame) -> DataFrame:
    sevens = total(flag(F.col("batter_runs") == 7))
    return deliveries.agg(
        F.coalesce(sevens, F.lit(0)).alias("count_7_runs"),
        F.count("*").alias("total_deliveries"),
        percent(sevens, F.count("*")).alias("percentage"),
    )


def batter_run_dist(deliveries: DataFrame) -> DataFrame:
    return deliveries.groupBy("batter_runs").agg(F.count("*").alias("frequency")).orderBy("batter_runs")


def run_outliers(deliveries: DataFrame, above: int = 6, n: int = 100) -> DataFrame:
    return top_k(deliveries.where(F.col("batter_runs") > above).select(*_BALL), "batter_runs", n, "delivery_id")


def high_totals(deliveries: DataFrame, above: int = 7, n: int = 100) -> DataFrame:
    return top_k(deliveries.where(F.col("total_runs") > above).select(*_BALL), "total_runs", n, "delivery_id")


def extras_dist(deliveries: DataFrame) -> DataFrame:
    value = F.col("extras_value")
    return (
        deliveries.where(F.col("extras") > 0).groupBy("extras_type")
        .agg(F.count("*").alias("frequency"), F.avg(value).alias("avg_value"), F.max(value).alias("max_value"))
        .orderBy(F.desc("frequency"), "extras_type")
    )


# ------------------------------------------------------------------ overs


def match_overs(matches: DataFrame, innings: DataFrame, overs: DataFrame) -> DataFrame:
    """Declared and played overs of each match. Overs are counted per innings before the joins."""
    per_innings = overs.groupBy("innings_id").agg(
        F.max("over_number").alias("last_over"), F.count_distinct("over_id").alias("played")
    )
    per_match = (
        per_innings.join(innings.select("innings_id", "match_id"), "innings_id")
        .groupBy("match_id")
        .agg((F.max("last_over") + 1).alias("max_over_number"), F.sum("played").alias("actual_overs_count"))
    )
    facts = matches.select("match_id", "match_type", F.col("overs").alias("declared_overs"), "outcome_winner")
    return facts.join(per_match, "match_id")


def _limited(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("declared_overs").isNotNull() & F.col("match_type").isin(*LIMITED_OVERS_TYPES))


def match_overs_stats(matches: DataFrame, innings: DataFrame, overs: DataFrame) -> DataFrame:
    """Declared and played overs by match type, for limited-overs types."""
    no_result = F.col("outcome_winner").isNull()
    declared = F.col("declared_overs").cast("double")
    short = F.col("actual_overs_count") < declared * 0.7
    return (
        _limited(match_overs(matches, innings, overs)).groupBy("match_type")
        .agg(
            F.count("*").alias("matches"),
            F.avg(declared).alias("avg_declared_overs"),
            F.avg("max_over_number").alias("avg_max_over"),
            F.avg("actual_overs_count").alias("avg_actual_overs"),
            total(flag(no_result)).alias("no_result_matches"),
            total(flag(short & ~no_result)).alias("shortened_with_result"),
        )
        .orderBy(F.desc("matches"), "match_type")
    )


def _exceeded(matches, innings, overs) -> DataFrame:
    declared = F.col("declared_overs").cast("double")
    return _limited(match_overs(matches, innings, overs)).where(F.col("max_over_number") > declared * 1.1)


def overs_exceeded(matches: DataFrame, innings: DataFrame, overs: DataFrame, n: int = 10) -> DataFrame:
    """Matches that went more than 10 % over the declared limit, furthest first."""
    beyond = F.col("max_over_number") - F.col("declared_overs")
    rows = _exceeded(matches, innings, overs).withColumn("beyond", beyond)
    return top_k(rows, "beyond", n, "match_id").select(
        "match_id", "match_type", "declared_overs", "max_over_number", "actual_overs_count", "outcome_winner"
    )


def overs_exceeded_count(matches: DataFrame, innings: DataFrame, overs: DataFrame) -> DataFrame:
    return _exceeded(matches, innings, overs).agg(F.count("*").alias("matches_exceeded"))


def over_length_dist(overs: DataFrame) -> DataFrame:
    """Overs by number of deliveries; the window sees one row per distinct length."""
    counts = overs.groupBy("num_deliveries").agg(F.count("*").alias("over_count"))
    share = percent(F.col("over_count"), F.sum("over_count").over(Window.partitionBy()))
    return counts.select("*", share.alias("percentage")).orderBy("num_deliveries")


def over_length_by_type(overs: DataFrame, innings: DataFrame, matches: DataFrame) -> DataFrame:
    """Deliveries per over by match type. Overs are added up per innings before the joins."""
    size = F.col("num_deliveries")
    per_innings = overs.groupBy("innings_id").agg(
        total(size).alias("balls"), F.count(size).alias("sized"), F.min(size).alias("low"),
        F.max(size).alias("high"), F.count("*").alias("overs"),
    )
    return (
        per_innings.join(innings.select("innings_id", "match_id"), "innings_id")
        .join(matches.select("match_id", "match_type"), "match_id")
        .groupBy("match_type")
        .agg(
            per(F.sum("balls"), F.sum("sized")).alias("avg_deliveries_per_over"),
            F.min("low").alias("min_deliveries"),
            F.max("high").alias("max_deliveries"),
            F.sum("overs").alias("over_count"),
        )
        .orderBy(F.desc("avg_deliveries_per_over"), "match_type")
    )


def long_overs(overs: DataFrame, innings: DataFrame, matches: DataFrame, above: int = 8, n: int = 100) -> DataFrame:
    """The longest overs with their match and teams; only long overs reach the joins."""
    rows = (
        overs.where(F.col("num_deliveries") > above)
        .join(innings.select("innings_id", "match_id", "batting_team", "bowling_team"), "innings_id")
        .join(matches.select("match_id", "match_type"), "match_id")
        .select(
            "over_id", "match_id", "match_type", "batting_team", "bowling_team",
            "over_number", "num_deliveries", "total_runs", "wickets",
        )
    )
    return top_k(rows, "num_deliveries", n, "over_id")


def over_length_factors(overs: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Average extras, wickets and runs of overs by their length."""
    per_over = deliveries.groupBy("over_id").agg(
        total(flag(F.col("extras") > 0)).alias("extras_count"),
        total(flag(F.col("is_wicket"))).alias("wicket_count"),
        total(F.col("total_runs")).alias("runs"),
    )
    return (
        overs.select("over_id", "num_deliveries").join(per_over, "over_id")
        .groupBy("num_deliveries")
        .agg(
            F.count("*").alias("over_count"),
            F.avg("extras_count").alias("avg_extras"),
            F.avg("wicket_count").alias("avg_wickets"),
            F.avg("runs").alias("avg_runs"),
        )
        .orderBy("num_deliveries")
    )


# ------------------------------------------------------------------ summary


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts, matches by type and the range of dates: ``section, key, value``."""
    line = lambda df, section, key, value: df.select(
        F.lit(section).alias("section"), key.alias("key"), value.cast("string").alias("value")
    )
    frames = [
        line(df.agg(F.count("*").alias("n")), "rows", F.lit(name), F.col("n")) for name, df in tables.items()
    ]
    matches = tables["matches"]
    types = value_counts(matches, "match_type")
    frames.append(line(types, "match_types", F.col("match_type"), F.col("count")))
    dates = matches.agg(F.min("date").alias("earliest"), F.max("date").alias("latest"))
    frames += [line(dates, "date_range", F.lit(k), F.col(k)) for k in ("earliest", "latest")]
    return union_all(frames)
