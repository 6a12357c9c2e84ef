"""Features added to deliveries, innings, matches and overs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.functions.columns import boundary, flag, per, percent, total


def add_delivery_features(deliveries: DataFrame) -> DataFrame:
    """``boundary_type``, ``is_dot_ball``, ``cumulative_runs_in_innings``, ``ball_in_over``.

    The running total is built in two steps so that no task has to order a whole innings of
    balls: a running total inside each over, plus the total of the overs before it. ``over_id``
    stands for ``(innings_id, over_number)``, so one shuffle on that pair serves both windows.
    """
    over = ["innings_id", "over_number"]
    earlier = Window.partitionBy("innings_id").orderBy("over_number").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = (
        deliveries.groupBy(*over)
        .agg(total(F.col("total_runs")).alias("over_runs"))
        .select(*over, F.sum("over_runs").over(earlier).alias("runs_before"))
    )
    balls = Window.partitionBy(*over).orderBy("ball_number")
    within = F.sum(F.col("total_runs").cast("bigint")).over(balls)
    running = F.when(
        F.col("runs_before").isNull() & F.col("runs_within").isNull(), None
    ).otherwise(F.coalesce("runs_before", F.lit(0)) + F.coalesce("runs_within", F.lit(0)))
    featured = deliveries.select(
        "*",
        F.when(F.col("batter_runs") == 4, "four").when(F.col("batter_runs") == 6, "six").alias("boundary_type"),
        F.coalesce(F.col("total_runs") == 0, F.lit(False)).alias("is_dot_ball"),
        within.alias("runs_within"),
        F.row_number().over(balls).alias("ball_in_over"),
    )
    joined = featured.join(before, over, "left")
    return joined.select(
        *deliveries.columns, "boundary_type", "is_dot_ball",
        running.alias("cumulative_runs_in_innings"), "ball_in_over",
    )


def add_innings_features(innings: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Totals, run rate, boundaries, dot balls and powerplay runs of each innings.

    Balls are first added up per over, which shrinks the data before the join with the
    powerplay bounds. ``dot_ball_percentage`` is 100 or NULL by its original definition;
    ``dot_ball_share`` is the share of dot balls.
    """
    per_over = deliveries.groupBy("innings_id", "over_number").agg(
        total(F.col("total_runs")).alias("runs"),
        total(flag(F.col("is_wicket"))).alias("outs"),
        F.count("*").alias("balls"),
        total(flag(boundary())).alias("boundaries"),
        total(flag(F.col("total_runs") == 0)).alias("dots"),
        F.max("ball_number").alias("last_ball"),
    )
    bounds = innings.select("innings_id", "powerplay_start_over", "powerplay_end_over")
    in_powerplay = F.col("over_number").between(F.col("powerplay_start_over"), F.col("powerplay_end_over"))
    overs_faced = F.max("over_number").cast("double") + F.max("last_ball").cast("double") / 6
    totals = (
        per_over.join(bounds, "innings_id")
        .groupBy("innings_id")
        .agg(
            F.sum("runs").alias("total_runs"),
            F.sum("outs").alias("total_wickets"),
            per(F.sum("runs"), overs_faced).alias("run_rate"),
            F.sum("boundaries").alias("boundary_count"),
            F.when(F.sum("dots") > 0, F.lit(100.0)).alias("dot_ball_percentage"),
            F.sum(F.when(in_powerplay, F.col("runs"))).alias("powerplay_runs"),
            percent(F.sum("dots"), F.sum("balls")).alias("dot_ball_share"),
        )
    )
    return innings.join(totals, "innings_id", "left").select(
        *innings.columns, "total_runs", "total_wickets", "run_rate",
        F.coalesce("boundary_count", F.lit(0)).alias("boundary_count"),
        "dot_ball_percentage", "powerplay_runs", "dot_ball_share",
    )


def add_match_features(matches: DataFrame, innings: DataFrame) -> DataFrame:
    """``match_result``, ``margin_description``, ``chasing_team``, ``setting_team``."""
    winner = F.col("outcome_winner")
    won = lambda team: F.concat(F.col(team), F.lit(" won"))
    counted = lambda c, unit: F.concat(F.col(c).cast("int").cast("string"), F.lit(f" {unit}"))
    first = (
        innings.where(F.col("innings_number") == 1)
        .groupBy("match_id")
        .agg(
            F.min_by(F.struct("bowling_team", "batting_team"), "innings_id").alias("first")
        )
    )
    return matches.join(first, "match_id", "left").select(
        *matches.columns,
        F.when(winner.isNull(), "No Result")
        .when(winner == F.col("team1"), won("team1"))
        .when(winner == F.col("team2"), won("team2"))
        .otherwise("Tie")
        .alias("match_result"),
        F.when(F.col("outcome_by_runs") > 0, counted("outcome_by_runs", "runs"))
        .when(F.col("outcome_by_wickets") > 0, counted("outcome_by_wickets", "wickets"))
        .otherwise(F.col("outcome_method"))
        .alias("margin_description"),
        F.col("first.bowling_team").alias("chasing_team"),
        F.col("first.batting_team").alias("setting_team"),
    )


def add_over_features(overs: DataFrame, innings: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Run rate, powerplay flag, boundaries, dot balls and running totals of each over."""
    balls = deliveries.groupBy("over_id").agg(
        total(flag(boundary())).alias("boundaries_in_over"),
        total(flag(F.col("total_runs") == 0)).alias("dot_balls_in_over"),
    )
    bounds = innings.select("innings_id", "powerplay_start_over", "powerplay_end_over")
    length = F.when(F.col("num_deliveries") > 0, F.col("num_deliveries").cast("double") / 6).otherwise(1.0)
    so_far = Window.partitionBy("innings_id").orderBy("over_number")
    return (
        overs.join(balls, "over_id", "left")
        .join(bounds, "innings_id", "left")
        .select(
            *[overs[c] for c in overs.columns],
            (F.col("total_runs").cast("double") / length).alias("run_rate"),
            F.coalesce(
                F.col("over_number").between(F.col("powerplay_start_over"), F.col("powerplay_end_over")),
                F.lit(False),
            ).alias("is_powerplay"),
            F.coalesce("boundaries_in_over", F.lit(0)).alias("boundaries_in_over"),
            F.coalesce("dot_balls_in_over", F.lit(0)).alias("dot_balls_in_over"),
            F.sum(F.col("total_runs").cast("bigint")).over(so_far).alias("cumulative_runs_in_innings"),
            F.sum(F.col("wickets").cast("bigint")).over(so_far).alias("cumulative_wickets_in_innings"),
        )
    )


def verify_features(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows with a value in the leading feature column of each table, and the mart's rows."""
    probes = {
        "deliveries": ("deliveries_features", "boundary_type"),
        "innings": ("innings_features", "total_runs"),
        "matches": ("matches_features", "match_result"),
        "overs": ("overs_features", "run_rate"),
        "players": ("players_features", "total_matches_played"),
        "player_match_stats": ("player_match_stats", None),
    }
    counts = [
        tables[t].agg(F.lit(label).alias("feature"), F.count(column or F.lit(1)).alias("rows"))
        for t, (label, column) in probes.items()
        if t in tables
    ]
    return reduce(DataFrame.unionByName, counts)
