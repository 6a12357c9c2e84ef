"""One innings and one pair of players hold a third of all balls; results and plans hold up."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from wicketflow.operators.careers import player_features
from wicketflow.operators.features import add_delivery_features, add_innings_features
from wicketflow.operators.match_stats import player_match_stats

ROWS = 60_000


@pytest.fixture(scope="module")
def tables(spark):
    n = F.col("id")
    hot = n % 3 == 0
    match = F.when(hot, F.lit("H")).otherwise(F.concat(F.lit("M"), (n % 40).cast("string")))
    innings = F.when(hot, F.lit("H_1")).otherwise(F.concat(match, F.lit("_"), (n % 2 + 1).cast("string")))
    step = F.floor(F.when(hot, n / 3).otherwise(n / 80)).cast("int")
    over, ball = F.floor(step / 6).cast("int"), step % 6 + 1
    kind = F.when(n % 7 == 0, F.lit("bowled")).when(n % 11 == 0, F.lit("caught"))
    deliveries = spark.range(ROWS).select(
        F.concat_ws("_", innings, over, ball, n).alias("delivery_id"), F.concat_ws("_", innings, over).alias("over_id"),
        innings.alias("innings_id"), match.alias("match_id"), over.alias("over_number"), ball.alias("ball_number"),
        F.when(hot, "star").otherwise(F.concat(F.lit("b"), (n % 9).cast("string"))).alias("batter_id"),
        F.when(hot, "ace").otherwise(F.concat(F.lit("w"), (n % 5).cast("string"))).alias("bowler_id"),
        F.lit("partner").alias("non_striker_id"), (n % 7).cast("int").alias("batter_runs"),
        (n % 13 == 0).cast("int").alias("extras"), (n % 7 + (n % 13 == 0).cast("int")).cast("int").alias("total_runs"),
        F.when(n % 13 == 0, "wides").alias("extras_type"), kind.isNotNull().alias("is_wicket"), kind.alias("wicket_kind"),
        F.when(kind.isNotNull(), F.when(hot, "star").otherwise("b1")).alias("wicket_player_out_id"),
        F.when(kind == "caught", "catcher").alias("wicket_fielder_id"),
    )
    inns = deliveries.select("innings_id", "match_id").distinct().select(
        "*", F.substring_index("innings_id", "_", -1).cast("int").alias("innings_number"),
        F.lit("X").alias("batting_team"), F.lit("Y").alias("bowling_team"),
        F.lit(0.0).alias("powerplay_start_over"), F.lit(5.0).alias("powerplay_end_over"),
    )
    matches = deliveries.select("match_id").distinct().select(
        "match_id", F.lit("2020-01-01").cast("date").alias("date"), F.lit("V").alias("venue"), F.lit("T20").alias("match_type"),
        F.lit("X").alias("team1"), F.lit("Y").alias("team2"), F.lit("X").alias("outcome_winner"), F.lit("star").alias("player_of_match_id"),
    )
    people = deliveries.select(F.explode(F.array("batter_id", "bowler_id", "non_striker_id")).alias("player_id")).distinct()
    return {"d": deliveries, "i": inns, "m": matches, "p": people.withColumn("player_name", F.col("player_id"))}


@pytest.fixture(scope="module")
def con(tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toPandas())
    return con


def test_running_total_of_a_long_innings(tables, con):
    ours = {r.delivery_id: r.cumulative_runs_in_innings for r in add_delivery_features(tables["d"]).select("delivery_id", "cumulative_runs_in_innings").collect()}
    theirs = dict(con.execute("SELECT delivery_id, CAST(sum(total_runs) OVER (PARTITION BY innings_id ORDER BY over_number, ball_number) AS BIGINT) FROM d").fetchall())
    assert len(ours) == ROWS and ours == theirs


def test_innings_and_careers(tables, con):
    hot = add_innings_features(tables["i"], tables["d"]).where("innings_id = 'H_1'").collect()[0]
    assert (hot.total_runs, hot.powerplay_runs) == con.execute("SELECT CAST(sum(total_runs) AS BIGINT), CAST(sum(total_runs) FILTER (over_number<=5) AS BIGINT) FROM d WHERE innings_id='H_1'").fetchone()
    career = {r.player_id: r for r in player_features(tables["p"], tables["d"], tables["m"]).collect()}
    runs = con.execute("SELECT sum(batter_runs) FROM d WHERE batter_id='star'").fetchone()[0]
    assert career["star"].total_runs_scored == runs and career["star"].total_matches_played == 1
    triple = con.execute("""SELECT count(*) FROM (SELECT h, lag(h,1) OVER w AS a, lag(h,2) OVER w AS b FROM (SELECT *, coalesce(is_wicket AND wicket_kind IN ('bowled','caught'), false) AS h FROM d WHERE bowler_id='ace') x
      WINDOW w AS (PARTITION BY innings_id ORDER BY over_number, ball_number)) y WHERE h AND a AND b""").fetchone()[0]
    assert career["ace"].true_hat_tricks == triple


def test_mart(tables, con):
    mart = player_match_stats(tables["d"], tables["m"], tables["i"], tables["p"]).where("match_id = 'H'")
    rows = {r.player_id: r for r in mart.collect()}
    balls, overs = con.execute("SELECT count(*), count(DISTINCT over_number) FROM d WHERE bowler_id='ace'").fetchone()
    assert (rows["ace"].balls_bowled, rows["ace"].overs_bowled) == (balls, overs) and set(rows) == {"star", "ace", "partner"}


@pytest.mark.parametrize("name", ["f03_cumulative_runs", "f09_powerplay_runs", "l_player_features", "m01_player_match_stats", "q09_similar_urls", "q12_match_overs_stats", "p15_similar_names"])
def test_no_cross_join(spark, name):
    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
