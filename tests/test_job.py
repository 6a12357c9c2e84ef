"""The whole job on the hand-made files, and the features that follow from them."""

import pytest
from pyspark.sql import functions as F


def one(df, **where):
    for column, value in where.items():
        df = df.where(F.col(column) == value)
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_outputs_are_written(spark, built):
    out, _ = built
    report = {(r.section, r.key): r.value for r in spark.read.json(f"{out}/quality/report").collect()}
    assert report[("rows", "matches")] == "23" and report[("tables", "matches.rows")] == "23"
    # 15 columns are listed; the runs of one over do not fit a byte, so that column stays.
    assert report[("conversions", "type_conversions")] == "15"
    assert report[("unfit_values", "overs.total_runs.lost")] == "1"
    (unfit,) = spark.read.parquet(f"{out}/quality/unfit_values").collect()
    assert (unfit.table, unfit.column, unfit.type) == ("overs", "total_runs", "tinyint") and int(unfit.value) > 127
    checks = {r.key.split(".")[0]: int(r.value) for r in spark.read.json(f"{out}/features/report").collect()}
    assert checks["matches_features"] == 23
    csv = spark.read.option("header", True).csv(f"{out}/profile/metadata_csv")
    assert csv.count() == 23 and len(csv.columns) == 35
    issues = {r.match_id for r in spark.read.option("header", True).csv(f"{out}/profile/matches_with_issues_csv").collect()}
    assert "e03" in issues and "e15b" in issues
    profile = {r.key.split(".")[0]: r.value for r in spark.read.json(f"{out}/profile/report").collect()}
    assert profile["total_files"] == "24" and profile["files_rejected"] == "1" and profile["matches_with_innings"] == "22"


def test_results_of_all_checks_are_stored(spark, built):
    out, t = built
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    sets = {(r.level, r["keys"]): r["count"] for r in read("profile/key_sets").collect()}
    assert sets["top", "info,innings,meta"] == 22 and sets["top", "info,meta"] == 1 and sets["delivery", "batter,bowler,non_striker"] == 1
    presence = {r.field: r for r in read("profile/field_presence").collect()}
    balls = t["deliveries"].count()
    assert presence["batter"].deliveries == balls and presence["runs"].deliveries == balls - 1 and presence["batter"].percentage == 100.0
    types = {(r.section, r.field, r.type) for r in read("profile/value_types").collect()}
    assert {("delivery", "runs.total", "int"), ("info", "event", "str"), ("info", "event", "dict"), ("info", "registry", "dict")} <= types
    (message,) = read("profile/rejected_files").collect()
    assert message.match_id == "e02" and "line 1 column" in message.message
    long = {r.over_id: r.num_deliveries for r in read("quality/long_overs").collect()}
    assert long == {"e18_1_248": 19}
    names = {r.key: r.value for r in read("quality/name_consistency").collect()}
    # Each spelling counts as a name here; only primary names are in the table of players.
    assert names["players_missing_ids"] == 1 and {r.player_name for r in read("quality/matches_of_unknown_names").collect()} == {"Mister A3"}
    assert {r.player_id for r in read("quality/ids_with_many_names").collect()} == {"id-A3"}
    for name in ("runs_description", "run_shares", "extras_counts", "match_overs", "over_length_factors", "similar_venues", "name_variants"):
        read(f"quality/{name}").collect()


def test_retyped_columns(built):
    _, t = built
    types = dict(t["deliveries"].dtypes)
    assert types["over_number"] == "smallint" and types["batter_runs"] == "tinyint" and types["is_wicket"] == "boolean"
    assert dict(t["matches"].dtypes)["overs"] == "decimal(4,1)"


def test_running_totals(built):
    _, t = built
    rows = t["deliveries"].where("innings_id = 'e01_1'").orderBy("over_number", "ball_number").collect()
    assert [r.cumulative_runs_in_innings for r in rows] == [4, 4, 10, 11, 11]
    assert [r.ball_in_over for r in rows] == [1, 2, 3, 1, 2]
    assert [r.boundary_type for r in rows] == ["four", None, "six", None, None]
    overs = t["overs"].where("innings_id = 'e01_1'").orderBy("over_number").collect()
    assert [(r.cumulative_runs_in_innings, r.cumulative_wickets_in_innings) for r in overs] == [(10, 0), (11, 1)]


def test_innings_features(built):
    _, t = built
    row = one(t["innings"], innings_id="e01_1")
    assert (row.total_runs, row.total_wickets, row.boundary_count) == (11, 1, 2)
    assert row.run_rate == pytest.approx(11 / (1 + 3 / 6)) and row.dot_ball_percentage == 100.0
    assert row.dot_ball_share == pytest.approx(40.0) and row.powerplay_runs is None
    assert one(t["innings"], innings_id="e06_1").powerplay_runs == 3
    empty = one(t["innings"], innings_id="e04_1")
    assert empty.total_runs is None and empty.boundary_count == 0


def test_over_without_balls(built):
    row = one(built[1]["overs"], over_id="e05_1_0")
    assert row.run_rate == 0.0 and row.boundaries_in_over == 0 and row.is_powerplay is False


def test_match_results(built):
    m = built[1]["matches"]
    row = one(m, match_id="e01")
    assert (row.match_result, row.margin_description, row.chasing_team, row.setting_team) == ("Alpha won", "12 runs", "Beta", "Alpha")
    assert one(m, match_id="e17").match_result == "Tie" and one(m, match_id="e17b").match_result == "No Result"


def test_hat_tricks(built):
    p = built[1]["players"]
    spread, in_a_row = one(p, player_id="id-B11"), one(p, player_id="id-B10")
    assert (spread.hat_tricks, spread.true_hat_tricks) == (1, 0)
    assert (in_a_row.hat_tricks, in_a_row.true_hat_tricks) == (1, 1)


def test_run_out_of_the_partner(built):
    mart = built[1]["player_match_stats"]
    partner = one(mart, match_id="e20", player_id="id-A2")
    assert partner.was_dismissed == 1 and partner.dismissal_type == "run out" and partner.innings_batted == 0
    assert one(mart, match_id="e20", player_id="id-B5").catches_taken == 1
    assert one(mart, match_id="e20", player_id="id-B11").wickets_taken == 0


def test_fielder_joins_only_by_five_roles(spark, built):
    from wicketflow.operators.match_stats import player_match_stats

    _, t = built
    full = t["player_match_stats"]
    assert one(full, match_id="e21", player_id="id-B9").player_team == "Beta"
    reduced = player_match_stats(t["deliveries"], t["matches"], t["innings"], t["players"], variant="reduced")
    assert reduced.where("match_id = 'e21' AND player_id = 'id-B9'").count() == 0
    anyone = player_match_stats(t["deliveries"], t["matches"], t["innings"], t["players"], credited_only=False)
    assert one(anyone, match_id="e20", player_id="id-B11").wickets_taken == 1


def test_batting_positions(built):
    mart = built[1]["player_match_stats"].where("match_id = 'e22'")
    rows = {r.player_id: (r.batting_position, r.batting_order_position) for r in mart.collect()}
    # Ball 7 of over 0 and ball 1 of over 1 share one key; the earlier ball goes first.
    assert rows["id-A1"] == (1, 1) and rows["id-A5"] == (2, 2) and rows["id-A3"] == (3, 3)


def test_totals_agree(spark, built):
    out, t = built
    total = lambda df, c: df.agg(F.sum(c)).collect()[0][0]
    runs = total(t["deliveries"], "total_runs")
    # An over total beyond the column's type is NULL there and stands among the unfit values.
    unfit = spark.read.parquet(f"{out}/quality/unfit_values").where("table = 'overs' AND column = 'total_runs'")
    beyond = total(unfit.select(F.col("value").cast("bigint")), "value")
    assert runs == total(t["overs"], "total_runs") + beyond == total(t["innings"], "total_runs")
    batter_runs = total(t["deliveries"], "batter_runs")
    assert batter_runs == total(t["player_match_stats"], "runs_scored") == total(t["players"], "total_runs_scored")
    mart = t["player_match_stats"]
    assert mart.count() == mart.select("match_id", "player_id").distinct().count()
