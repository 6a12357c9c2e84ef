"""The player-by-match mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.constants import ALL_ROLES, FIELD_ROLES
from wicketflow.functions.columns import flag, per, percent, total
from wicketflow.operators.player_innings import player_innings

# Names of the output columns.
REDUCED_COLUMNS = (
    "match_id", "date", "venue", "match_type", "team1", "team2", "player_id", "player_name",
    "player_team", "innings_batted", "balls_faced", "runs_scored", "fours", "sixes",
    "balls_bowled", "runs_conceded", "wickets_taken", "is_half_century", "is_century",
    "is_five_wicket_haul", "is_player_of_match",
)


def _with_positions(rows: DataFrame) -> DataFrame:
    """Batting position in each innings, by the first ball faced."""
    innings = Window.partitionBy("match_id", "innings_id")
    by_ball = innings.orderBy(F.col("first_ball").asc_nulls_last(), "player_id")
    by_key = innings.orderBy(F.col("first_ball_key").asc_nulls_last(), "first_ball", "player_id")
    batted = F.col("balls_faced") > 0
    return rows.select(
        "*",
        F.when(batted, F.row_number().over(by_key)).alias("position_by_key"),
        F.when(batted, F.row_number().over(by_ball)).alias("position_by_ball"),
    )


def player_match_stats(
    deliveries: DataFrame,
    matches: DataFrame,
    innings: DataFrame,
    players: DataFrame,
    variant: str = "full",
    credited_only: bool | None = None,
) -> DataFrame:
    """One row per match and player.

    ``variant="full"`` takes a player in any of five roles, ``"reduced"`` in three.
    ``credited_only`` counts only the dismissal kinds credited to the bowler (default in the
    full variant). ``player_team`` and ``match_result`` follow the original rule, by which a
    player of either side is placed in team 1 when that team took part in the innings;
    ``actual_team`` goes by the side the player was on. ``batting_position`` orders by
    ``over * 6 + ball``, ``batting_order_position`` by over, then ball.

    Deliveries shrink to player innings before anything is joined. The windows run on those
    rows or on mart rows, never on raw balls.
    """
    full = variant == "full"
    if credited_only is None:
        credited_only = full
    sides = innings.join(matches.select("match_id", "team1"), "match_id").select(
        "innings_id", "innings_number", "batting_team", "bowling_team",
        ((F.col("batting_team") == F.col("team1")) | (F.col("bowling_team") == F.col("team1"))).alias("team1_involved"),
        (F.col("batting_team") == F.col("team1")).alias("team1_bats"),
    )
    rows = player_innings(deliveries, ALL_ROLES if full else FIELD_ROLES)
    rows = _with_positions(rows).join(sides, "innings_id", "left")

    in_team1 = (
        (F.col("on_field") == 1) & F.col("team1_involved")
        if full
        else (F.col("balls_faced") > 0) & F.col("team1_bats")
    )
    side = F.when(F.col("batting_side") == 1, F.col("batting_team")).otherwise(F.col("bowling_team"))
    wickets = "credited_wickets" if credited_only else "any_wickets"
    add = lambda c: F.sum(c).alias(c)
    by_match = rows.groupBy("match_id", "player_id").agg(
        F.max(flag(in_team1)).alias("in_team1"),
        F.min_by(side, F.when(side.isNotNull(), F.col("innings_number"))).alias("actual_team"),
        total(flag(F.col("balls_faced") > 0)).alias("innings_batted"),
        add("balls_faced"), add("runs_scored"), add("fours"), add("sixes"),
        F.max("was_dismissed").alias("was_dismissed"),
        F.max("dismissal_type").alias("dismissal_type"),
        add("overs_bowled"), add("balls_bowled"), add("runs_conceded"),
        F.sum(wickets).alias("wickets_taken"),
        add("wides_bowled"), add("noballs_bowled"), add("dot_balls_bowled"), add("catches_taken"),
        F.min("position_by_key").alias("batting_position"),
        F.min("position_by_ball").alias("batting_order_position"),
    )
    facts = matches.select(
        "match_id", "date", "venue", "match_type", "team1", "team2", "outcome_winner", "player_of_match_id"
    )
    named = by_match.join(players.select("player_id", "player_name"), "player_id")
    named = named.join(facts, "match_id").withColumn(
        "player_team", F.when(F.col("in_team1") == 1, F.col("team1")).otherwise(F.col("team2"))
    )
    runs, taken = F.col("runs_scored"), F.col("wickets_taken")
    faced, bowled = F.col("balls_faced"), F.col("balls_bowled")
    team = Window.partitionBy("match_id", "player_team")
    share = lambda c: F.when(F.col(c) > 0, percent(F.col(c), F.sum(c).over(team)))
    mart = named.select(
        "match_id", "date", "venue", "match_type", "team1", "team2", "player_id", "player_name",
        "player_team", "innings_batted", "balls_faced", "runs_scored", "fours", "sixes",
        percent(runs, faced).alias("batting_strike_rate"),
        "was_dismissed", "dismissal_type",
        runs.alias("total_runs"),
        "overs_bowled", "balls_bowled", "runs_conceded", "wickets_taken",
        "wides_bowled", "noballs_bowled", "dot_balls_bowled",
        F.when(bowled >= 6, per(F.col("runs_conceded"), bowled, 6.0)).alias("bowling_economy_rate"),
        "catches_taken",
        F.when(F.col("outcome_winner") == F.col("player_team"), "won")
        .when(F.col("outcome_winner").isNull(), "no result")
        .otherwise("lost")
        .alias("match_result"),
        F.coalesce(F.col("player_of_match_id") == F.col("player_id"), F.lit(False)).alias("is_player_of_match"),
        ((runs >= 50) & (runs < 100)).alias("is_half_century"),
        (runs >= 100).alias("is_century"),
        (taken >= 5).alias("is_five_wicket_haul"),
        percent(F.col("fours") + F.col("sixes"), faced).alias("boundary_percentage"),
        percent(F.col("dot_balls_bowled"), bowled).alias("dot_ball_percentage_bowled"),
        per(bowled, taken).alias("bowling_strike_rate"),
        share("runs_scored").alias("match_runs_contribution_percentage"),
        share("wickets_taken").alias("match_wickets_contribution_percentage"),
        "batting_position", "batting_order_position", "actual_team",
    )
    return mart if full else mart.select(*REDUCED_COLUMNS)


def notable_performances(mart: DataFrame, n: int = 5) -> DataFrame:
    """Latest performances with more than 50 runs or more than 2 wickets."""
    return (
        mart.where((F.col("runs_scored") > 50) | (F.col("wickets_taken") > 2))
        .orderBy(F.desc("date"), F.desc("runs_scored"), "match_id", "player_id")
        .limit(n)
    )
