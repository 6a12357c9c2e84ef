"""Career features of players."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.constants import FIELD_ROLES, FORMATS
from wicketflow.functions.columns import credited, flag, per, percent, total
from wicketflow.operators.player_innings import player_innings

# Names of the output columns.
GROUPS = {
    "basic": (
        "total_matches_played", "total_runs_scored", "batting_strike_rate", "total_wickets_taken",
        "bowling_economy_rate", "batting_average", "bowling_average", "boundary_percentage",
    ),
    "milestones": (
        "half_centuries", "centuries", "double_centuries", "triple_centuries",
        "five_wicket_hauls", "ten_wicket_hauls", "four_wicket_hauls",
    ),
    "highlights": (
        "highest_score", "best_bowling_wickets", "ducks", "not_outs", "hat_tricks", "true_hat_tricks",
    ),
    "formats": tuple(
        f"{fmt}_{what}"
        for what in ("matches", "batting_average", "bowling_average", "runs", "wickets")
        for fmt in FORMATS
    ),
}

# Features that are a count and so 0, not NULL, for a player without deliveries.
_COUNTS = (
    "total_matches_played", "total_wickets_taken", *GROUPS["milestones"],
    "ducks", "not_outs", "hat_tricks", "true_hat_tricks",
    *[f"{fmt}_matches" for fmt in FORMATS],
)


def true_hat_tricks(deliveries: DataFrame) -> DataFrame:
    """Per bowler, how often three balls in a row of one innings were credited wickets.

    Balls are first put in order per over, where a group is a handful of balls. The window over
    an innings then sees one row per over and looks back at the last balls of the two overs
    bowled before, which is all a run of three can reach.
    """
    spell = ["match_id", "innings_id", "bowler_id"]
    overs = (
        deliveries.where(F.col("bowler_id").isNotNull())
        .groupBy(*spell, "over_number")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("ball_number", F.coalesce(credited(), F.lit(False)).alias("hit")))
            ).alias("balls")
        )
        .select(*spell, "over_number", F.transform("balls", lambda b: b["hit"]).alias("hits"))
    )
    order = Window.partitionBy(*spell).orderBy("over_number")
    none = F.array().cast("array<boolean>")
    tail = lambda hits: F.slice(hits, F.greatest(F.size(hits) - 1, F.lit(1)), 2)
    context = tail(
        F.concat(
            F.coalesce(F.lag("hits", 2).over(order), none), F.coalesce(F.lag("hits", 1).over(order), none)
        )
    )
    line = F.concat("carried", "hits")
    thirds = F.filter(
        F.sequence(F.lit(3), F.greatest(F.size(line), F.lit(3))),
        lambda i: (i > F.size("carried"))
        & (i <= F.size(line))
        & F.get(line, i - 1) & F.get(line, i - 2) & F.get(line, i - 3),
    )
    return (
        overs.select("bowler_id", "hits", context.alias("carried"))
        .groupBy("bowler_id")
        .agg(total(F.size(thirds)).alias("true_hat_tricks"))
    )


def _by_match(innings_rows: DataFrame) -> DataFrame:
    batted, bowled = F.col("balls_faced") > 0, F.col("balls_bowled") > 0
    runs, wickets = F.col("runs_scored"), F.col("credited_wickets")
    out = F.col("out_on_strike") == 1
    times = lambda condition: total(flag(condition))
    return innings_rows.groupBy("match_id", "player_id").agg(
        F.max("on_field").alias("on_field"),
        *[
            F.sum(c).alias(c)
            for c in ("balls_faced", "runs_scored", "boundaries", "balls_bowled", "runs_conceded", "credited_wickets")
        ],
        times(batted & out).alias("dismissals"),
        times(batted & (runs >= 50) & (runs < 100)).alias("half_centuries"),
        times(batted & (runs >= 100) & (runs < 200)).alias("centuries"),
        times(batted & (runs >= 200) & (runs < 300)).alias("double_centuries"),
        times(batted & (runs >= 300)).alias("triple_centuries"),
        times(bowled & (wickets >= 5)).alias("five_wicket_hauls"),
        times(bowled & (wickets == 4)).alias("four_wicket_hauls"),
        F.max(F.when(batted, runs)).alias("highest_score"),
        F.max(F.when(bowled, wickets)).alias("best_bowling_wickets"),
        times(batted & (runs == 0) & out).alias("ducks"),
        times(batted & ~out).alias("not_outs"),
        times(bowled & (wickets >= 3)).alias("hat_tricks"),
    )


def _in_format(fmt: str) -> Column:
    return F.coalesce(F.col("match_type").isin(*FORMATS[fmt]), F.lit(False))


def player_features(
    players: DataFrame,
    deliveries: DataFrame,
    matches: DataFrame,
    groups=tuple(GROUPS),
    century_cap: bool = True,
) -> DataFrame:
    """Career columns of each player, from few grouped passes over the deliveries.

    Deliveries are aggregated to player innings, then to player matches, and only those are
    joined with the matches, so neither a long match nor a busy player reaches a join as raw
    balls. ``century_cap=False`` counts every score of 100 or more as a century. ``hat_tricks``
    keeps its original definition (innings with three credited wickets); ``true_hat_tricks``
    counts three in a row.
    """
    wanted = [c for g in groups for c in GROUPS[g]]
    by_match = _by_match(player_innings(deliveries, FIELD_ROLES, detail=False))
    by_match = by_match.join(matches.select("match_id", "match_type"), "match_id", "left")

    batted, bowled = F.col("balls_faced") > 0, F.col("balls_bowled") > 0
    add = lambda c, condition=F.lit(True): F.sum(F.when(condition, F.col(c)))
    once = lambda condition: total(flag(condition & (F.col("on_field") == 1)))
    hundreds = F.col("centuries")
    if not century_cap:
        hundreds = hundreds + F.col("double_centuries") + F.col("triple_centuries")
    features = [
        once(F.lit(True)).alias("total_matches_played"),
        add("runs_scored", batted).alias("total_runs_scored"),
        percent(add("runs_scored"), add("balls_faced")).alias("batting_strike_rate"),
        add("credited_wickets").alias("total_wickets_taken"),
        per(add("runs_conceded"), add("balls_bowled"), 6.0).alias("bowling_economy_rate"),
        per(add("runs_scored"), add("dismissals")).alias("batting_average"),
        per(add("runs_conceded"), add("credited_wickets")).alias("bowling_average"),
        percent(add("boundaries"), add("balls_faced")).alias("boundary_percentage"),
        F.sum(hundreds).alias("centuries"),
        *[
            F.sum(c).alias(c)
            for c in (
                "half_centuries", "double_centuries", "triple_centuries", "five_wicket_hauls",
                "four_wicket_hauls", "ducks", "not_outs", "hat_tricks",
            )
        ],
        total(flag(F.col("credited_wickets") >= 10)).alias("ten_wicket_hauls"),
        F.max("highest_score").alias("highest_score"),
        F.max("best_bowling_wickets").alias("best_bowling_wickets"),
    ]
    for fmt in FORMATS:
        played = _in_format(fmt)
        features += [
            once(played).alias(f"{fmt}_matches"),
            per(add("runs_scored", played & batted), add("dismissals", played)).alias(f"{fmt}_batting_average"),
            per(add("runs_conceded", played), add("credited_wickets", played)).alias(f"{fmt}_bowling_average"),
            add("runs_scored", played & batted).alias(f"{fmt}_runs"),
            add("credited_wickets", played & bowled).alias(f"{fmt}_wickets"),
        ]
    joined = players.join(by_match.groupBy("player_id").agg(*features), "player_id", "left")
    if "true_hat_tricks" in wanted:
        in_a_row = true_hat_tricks(deliveries).withColumnRenamed("bowler_id", "player_id")
        joined = joined.join(in_a_row, "player_id", "left")
    return joined.select(
        *players.columns,
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in _COUNTS else F.col(c) for c in wanted],
    )


def top_run_scorers(featured: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` players with most runs; players without runs come last."""
    return featured.orderBy(F.col("total_runs_scored").desc_nulls_last(), "player_id").limit(n)
