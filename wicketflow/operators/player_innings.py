"""Player totals per innings: the shared first step of careers and of the match mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.constants import ALL_ROLES, FIELD_ROLES
from wicketflow.functions.columns import boundary, credited, flag, total

# Distance between over numbers in a single sortable (over, ball) value.
_OVER_STEP = 1 << 20

_SUMS = (
    "balls_faced", "runs_scored", "fours", "sixes", "boundaries",
    "balls_bowled", "runs_conceded", "credited_wickets", "any_wickets",
    "wides_bowled", "noballs_bowled", "dot_balls_bowled", "catches_taken",
)
_FLAGS = ("out_on_strike", "was_dismissed", "on_field", "batting_side")
_FIRSTS = ("first_ball", "first_ball_key")


def player_innings(deliveries: DataFrame, roles=ALL_ROLES, detail: bool = True) -> DataFrame:
    """One row per match, innings and player with the totals of all roles.

    Every delivery gives one row per role instead of an IN-list join with the players: each
    measure belongs to one role, so nothing is counted twice. All buffers of the first
    aggregation are primitive, which keeps it a hash aggregation with map-side combine;
    ``detail`` adds the overs bowled, as bits of 64 overs each, and the dismissal kind by way of the grouping key.
    """
    is_role = lambda *names: F.col("role").isin(*names)
    batting, bowling = is_role("batter_id"), is_role("bowler_id")
    out, fielding = is_role("wicket_player_out_id"), is_role("wicket_fielder_id")
    role_rows = F.inline(
        F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("player_id")) for r in roles])
    )
    tagged = deliveries.select(
        "match_id", "innings_id", "over_number", "ball_number", "batter_runs", "total_runs",
        "extras_type", "is_wicket", "wicket_kind", "wicket_player_out_id", role_rows,
    ).where(F.col("player_id").isNotNull())

    keys = ["match_id", "innings_id", "player_id"]
    fine = list(keys)
    bowled_in = []
    if detail:
        number = F.when(bowling, F.col("over_number").cast("bigint"))
        tagged = tagged.select(
            "*",
            F.coalesce(F.shiftright(number, 6), F.lit(0)).alias("overs_from"),
            F.when(number.isNotNull(), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(64)).cast("int")))
            .alias("over_bit"),
            F.when(out, F.col("wicket_kind")).alias("dismissal_kind"),
        )
        fine += ["overs_from", "dismissal_kind"]
        bowled_in = [F.bit_or("over_bit").alias("over_bits")]

    struck_out = batting & F.col("is_wicket") & (F.col("wicket_player_out_id") == F.col("player_id"))
    over, ball = F.col("over_number").cast("bigint"), F.col("ball_number").cast("bigint")
    rows = tagged.groupBy(*fine).agg(
        total(flag(batting)).alias("balls_faced"),
        total(F.when(batting, F.col("batter_runs")).otherwise(0)).alias("runs_scored"),
        total(flag(batting & (F.col("batter_runs") == 4))).alias("fours"),
        total(flag(batting & (F.col("batter_runs") == 6))).alias("sixes"),
        total(flag(batting & boundary())).alias("boundaries"),
        total(flag(bowling)).alias("balls_bowled"),
        total(F.when(bowling, F.col("total_runs")).otherwise(0)).alias("runs_conceded"),
        total(flag(bowling & credited())).alias("credited_wickets"),
        total(flag(bowling & F.col("is_wicket"))).alias("any_wickets"),
        total(flag(bowling & (F.col("extras_type") == "wides"))).alias("wides_bowled"),
        total(flag(bowling & (F.col("extras_type") == "noballs"))).alias("noballs_bowled"),
        total(flag(bowling & (F.col("total_runs") == 0))).alias("dot_balls_bowled"),
        total(flag(fielding)).alias("catches_taken"),
        F.max(flag(struck_out)).alias("out_on_strike"),
        F.max(flag(out)).alias("was_dismissed"),
        F.max(flag(is_role(*FIELD_ROLES))).alias("on_field"),
        F.max(flag(is_role("batter_id", "non_striker_id", "wicket_player_out_id"))).alias("batting_side"),
        F.min(F.when(batting, over * _OVER_STEP + ball)).alias("first_ball"),
        F.min(F.when(batting, over * 6 + ball)).alias("first_ball_key"),
        *bowled_in,
    )
    if not detail:
        return rows
    # A bowler's rows have no kind of dismissal, so the bits of 64 overs stand in one row.
    return rows.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        *[F.max(c).alias(c) for c in _FLAGS],
        *[F.min(c).alias(c) for c in _FIRSTS],
        F.coalesce(F.sum(F.bit_count("over_bits").cast("bigint")), F.lit(0)).alias("overs_bowled"),
        F.max("dismissal_kind").alias("dismissal_type"),
    )
