"""SQL forms of the registered queries, for a second engine on the same tables."""

from __future__ import annotations

from wicketflow.constants import RANGE_SPEC, RETYPE_SPEC
from wicketflow.operators.careers import GROUPS
from wicketflow.plans.projection import ALL, FLAT

_BOWL5 = "('bowled','caught','lbw','stumped','hit wicket')"
_LIMITED = "('ODI','T20','IT20','ODM','T20M')"


def _shape(body: str, dbl: str = "", big: str = "", txt: str = "", ctes: str = FLAT, extra: str = "") -> str:
    """Wrap ``body`` so that ratios, whole numbers and dates have one type on both engines."""
    parts = [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in dbl.split()]
    parts += [f"CAST({c} AS BIGINT) AS {c}" for c in big.split()]
    parts += [f"CAST({c} AS VARCHAR) AS {c}" for c in txt.split()]
    replace = f" REPLACE ({', '.join(parts)})" if parts else ""
    return f"{ctes.rstrip()}{extra}\nSELECT *{replace} FROM ({body}) q"


# ---------------------------------------------------------------- features

_DELIVERIES = """SELECT d.*, CASE WHEN batter_runs=4 THEN 'four' WHEN batter_runs=6 THEN 'six' END AS boundary_type,
  total_runs=0 AS is_dot_ball,
  sum(total_runs) OVER (PARTITION BY innings_id ORDER BY over_number, ball_number) AS cumulative_runs_in_innings,
  row_number() OVER (PARTITION BY over_id ORDER BY ball_number) AS ball_in_over FROM d"""

_INNINGS = """SELECT i.*, runs AS total_runs, outs AS total_wickets, runs/nullif(last_over+last_ball/6.0, 0) AS run_rate, coalesce(bounds, 0) AS boundary_count,
  CASE WHEN dots>0 THEN 100.0 END AS dot_ball_percentage, powerplay_runs, CAST(dots AS DOUBLE)*100/balls AS dot_ball_share
FROM i LEFT JOIN (
  SELECT innings_id, sum(total_runs) AS runs, count(*) FILTER (is_wicket) AS outs, CAST(max(over_number) AS DOUBLE) AS last_over, max(ball_number) AS last_ball,
    count(*) FILTER (batter_runs IN (4,6)) AS bounds, count(*) FILTER (total_runs=0) AS dots, count(*) AS balls FROM d GROUP BY innings_id) b ON b.innings_id=i.innings_id
LEFT JOIN (
  SELECT o.innings_id, sum(o.total_runs) AS powerplay_runs FROM o JOIN i ON i.innings_id=o.innings_id AND over_number BETWEEN powerplay_start_over AND powerplay_end_over
  GROUP BY o.innings_id) w ON w.innings_id=i.innings_id"""

_MATCHES = """SELECT m.*, CASE WHEN outcome_winner IS NULL THEN 'No Result' WHEN outcome_winner=team1 THEN team1||' won' WHEN outcome_winner=team2 THEN team2||' won' ELSE 'Tie' END AS match_result,
  CASE WHEN outcome_by_runs>0 THEN outcome_by_runs||' runs' WHEN outcome_by_wickets>0 THEN outcome_by_wickets||' wickets' WHEN outcome_method IS NOT NULL THEN outcome_method END AS margin_description,
  f.bowling_team AS chasing_team, f.batting_team AS setting_team
FROM m LEFT JOIN (SELECT * FROM i WHERE innings_number=1) f ON f.match_id=m.match_id"""

_OVERS = """SELECT o.*, CASE WHEN num_deliveries>0 THEN o.total_runs*6.0/num_deliveries ELSE o.total_runs END AS run_rate,
  coalesce(over_number BETWEEN powerplay_start_over AND powerplay_end_over, false) AS is_powerplay, bounds AS boundaries_in_over, dots AS dot_balls_in_over,
  sum(o.total_runs) OVER (PARTITION BY o.innings_id ORDER BY over_number) AS cumulative_runs_in_innings,
  sum(o.wickets) OVER (PARTITION BY o.innings_id ORDER BY over_number) AS cumulative_wickets_in_innings
FROM o LEFT JOIN i ON i.innings_id=o.innings_id
LEFT JOIN (SELECT over_id, count(*) FILTER (batter_runs IN (4,6)) AS bounds, count(*) FILTER (total_runs=0) AS dots FROM d GROUP BY over_id) b ON b.over_id=o.over_id"""


def _pick(columns: str, body: str) -> str:
    return f"SELECT {columns} FROM ({body}) z"


_F = {
    "f01_boundary_type": _shape(_pick("delivery_id, batter_runs, boundary_type", _DELIVERIES), big="batter_runs"),
    "f02_is_dot_ball": _shape(_pick("delivery_id, total_runs, is_dot_ball", _DELIVERIES), big="total_runs"),
    "f03_cumulative_runs": _shape(_pick("delivery_id, innings_id, cumulative_runs_in_innings", _DELIVERIES), big="cumulative_runs_in_innings"),
    "f04_ball_in_over": _shape(_pick("delivery_id, over_id, ball_in_over", _DELIVERIES), big="ball_in_over"),
    "f05_innings_totals": _shape(_pick("innings_id, total_runs, total_wickets", _INNINGS), big="total_runs total_wickets"),
    "f06_innings_run_rate": _shape(_pick("innings_id, run_rate", _INNINGS), dbl="run_rate"),
    "f07_boundary_count": _shape(_pick("innings_id, boundary_count", _INNINGS), big="boundary_count"),
    "f08_dot_ball_percentage": _shape(_pick("innings_id, dot_ball_percentage, dot_ball_share", _INNINGS), dbl="dot_ball_percentage dot_ball_share"),
    "f09_powerplay_runs": _shape(_pick("innings_id, powerplay_runs", _INNINGS), big="powerplay_runs"),
    "f10_match_result": _shape(_pick("match_id, match_result", _MATCHES)),
    "f11_margin_description": _shape(_pick("match_id, margin_description", _MATCHES)),
    "f12_chasing_setting_team": _shape(_pick("match_id, chasing_team, setting_team", _MATCHES)),
    "f13_over_run_rate": _shape(_pick("over_id, run_rate", _OVERS), dbl="run_rate"),
    "f14_is_powerplay": _shape(_pick("over_id, is_powerplay", _OVERS)),
    "f15_over_boundaries_dots": _shape(_pick("over_id, boundaries_in_over, dot_balls_in_over", _OVERS), big="boundaries_in_over dot_balls_in_over"),
    "f16_over_cumulatives": _shape(_pick("over_id, cumulative_runs_in_innings, cumulative_wickets_in_innings", _OVERS), big="cumulative_runs_in_innings cumulative_wickets_in_innings"),
    "f_scorecard": _shape(_pick("innings_id, batting_team, total_runs, total_wickets, run_rate", _INNINGS), dbl="run_rate", big="total_runs total_wickets"),
}

INNINGS_SAMPLE = [
    "innings_id", "batting_team", "total_runs", "total_wickets", "run_rate", "boundary_count",
    "dot_ball_percentage", "powerplay_runs",
]
SAMPLES = {
    "f18_feature_sample": INNINGS_SAMPLE,
    "f18_delivery_sample": ["delivery_id", "innings_id", "over_number", "ball_number", "batter_runs", "total_runs", "boundary_type", "is_dot_ball", "cumulative_runs_in_innings", "ball_in_over"],
    "f18_match_sample": ["match_id", "team1", "team2", "outcome_winner", "match_result", "margin_description", "chasing_team", "setting_team"],
    "f18_over_sample": ["over_id", "innings_id", "over_number", "total_runs", "wickets", "run_rate", "is_powerplay", "boundaries_in_over", "dot_balls_in_over", "cumulative_runs_in_innings", "cumulative_wickets_in_innings"],
}
_SAMPLE_TEXTS = ("boundary_type", "is_dot_ball", "is_powerplay", "batting_team", "team1", "team2", "outcome_winner", "match_result", "margin_description", "chasing_team", "setting_team")
for (_name, _columns), _body in zip(SAMPLES.items(), (_INNINGS, _DELIVERIES, _MATCHES, _OVERS)):
    _ratios = [c for c in _columns if c in ("run_rate", "dot_ball_percentage")]
    _F[_name] = _shape(
        f"SELECT {', '.join(_columns)} FROM ({_body}) z ORDER BY {_columns[0]} LIMIT 10",
        big=" ".join(c for c in _columns if c not in (*_ratios, *_SAMPLE_TEXTS) and not c.endswith("_id")), dbl=" ".join(_ratios),
    )

# ---------------------------------------------------------------- careers

_CAREERS = f""",
dm AS (SELECT d.*, m.match_type FROM d LEFT JOIN m ON m.match_id=d.match_id),
app AS (SELECT DISTINCT player_id, match_id, match_type FROM (SELECT batter_id AS player_id, match_id, match_type FROM dm
  UNION ALL SELECT bowler_id, match_id, match_type FROM dm UNION ALL SELECT non_striker_id, match_id, match_type FROM dm) x),
apps AS (SELECT player_id, count(*) AS total_matches_played, count(*) FILTER (match_type='Test') AS test_matches,
  count(*) FILTER (match_type='ODI') AS odi_matches, count(*) FILTER (match_type IN ('T20','IT20')) AS t20_matches FROM app GROUP BY player_id),
bat AS (SELECT batter_id AS player_id, sum(batter_runs) AS runs, count(*) AS balls, count(*) FILTER (batter_runs IN (4,6)) AS bounds,
  count(DISTINCT CASE WHEN is_wicket AND wicket_player_out_id=batter_id THEN match_id||'-'||innings_id END) AS outs,
  sum(batter_runs) FILTER (match_type='Test') AS test_runs, sum(batter_runs) FILTER (match_type='ODI') AS odi_runs, sum(batter_runs) FILTER (match_type IN ('T20','IT20')) AS t20_runs,
  count(DISTINCT CASE WHEN is_wicket AND wicket_player_out_id=batter_id AND match_type='Test' THEN innings_id END) AS test_outs,
  count(DISTINCT CASE WHEN is_wicket AND wicket_player_out_id=batter_id AND match_type='ODI' THEN innings_id END) AS odi_outs,
  count(DISTINCT CASE WHEN is_wicket AND wicket_player_out_id=batter_id AND match_type IN ('T20','IT20') THEN innings_id END) AS t20_outs
  FROM dm GROUP BY batter_id),
bowl AS (SELECT bowler_id AS player_id, sum(total_runs) AS conceded, count(*) AS balls,
  count(*) FILTER (is_wicket AND wicket_kind IN {_BOWL5}) AS wickets,
  sum(total_runs) FILTER (match_type='Test') AS test_conceded, sum(total_runs) FILTER (match_type='ODI') AS odi_conceded, sum(total_runs) FILTER (match_type IN ('T20','IT20')) AS t20_conceded,
  sum(CASE WHEN is_wicket AND wicket_kind IN {_BOWL5} THEN 1 ELSE 0 END) FILTER (match_type='Test') AS test_wickets,
  sum(CASE WHEN is_wicket AND wicket_kind IN {_BOWL5} THEN 1 ELSE 0 END) FILTER (match_type='ODI') AS odi_wickets,
  sum(CASE WHEN is_wicket AND wicket_kind IN {_BOWL5} THEN 1 ELSE 0 END) FILTER (match_type IN ('T20','IT20')) AS t20_wickets
  FROM dm GROUP BY bowler_id),
ir AS (SELECT match_id, innings_id, batter_id, sum(batter_runs) AS r, max(CASE WHEN is_wicket AND wicket_player_out_id=batter_id THEN 1 ELSE 0 END) AS got_out FROM d GROUP BY 1,2,3),
irs AS (SELECT batter_id AS player_id, count(*) FILTER (r>=50 AND r<100) AS half_centuries, count(*) FILTER (r>=100 AND r<200) AS centuries,
  count(*) FILTER (r>=100) AS hundreds_uncapped,
  count(*) FILTER (r>=200 AND r<300) AS double_centuries, count(*) FILTER (r>=300) AS triple_centuries, max(r) AS highest_score,
  count(*) FILTER (r=0 AND got_out=1) AS ducks, count(*) FILTER (got_out=0) AS not_outs FROM ir GROUP BY 1),
iw AS (SELECT match_id, innings_id, bowler_id, sum(CASE WHEN is_wicket AND wicket_kind IN {_BOWL5} THEN 1 ELSE 0 END) AS w FROM d GROUP BY 1,2,3),
iws AS (SELECT bowler_id AS player_id, count(*) FILTER (w>=5) AS five_wicket_hauls, count(*) FILTER (w=4) AS four_wicket_hauls, max(w) AS best_bowling_wickets FROM iw GROUP BY 1),
mw AS (SELECT bowler_id AS player_id, count(*) FILTER (w>=10) AS ten_wicket_hauls FROM (SELECT match_id, bowler_id, sum(w) AS w FROM iw GROUP BY 1,2) x GROUP BY 1),
ht AS (SELECT bowler_id AS player_id, count(*) AS hat_tricks FROM (SELECT bowler_id, match_id, innings_id FROM d WHERE is_wicket AND wicket_kind IN {_BOWL5} GROUP BY ALL HAVING count(*)>=3) x GROUP BY 1),
ab AS (SELECT bowler_id, h, lag(h,1) OVER w AS p1, lag(h,2) OVER w AS p2 FROM (SELECT *, is_wicket AND wicket_kind IN {_BOWL5} AS h FROM d) y
  WINDOW w AS (PARTITION BY match_id, innings_id, bowler_id ORDER BY over_number, ball_number)),
tht AS (SELECT bowler_id AS player_id, count(*) AS true_hat_tricks FROM ab WHERE h AND p1 AND p2 GROUP BY 1),
c AS (SELECT p.player_id, p.player_name, coalesce(total_matches_played,0) AS total_matches_played, bat.runs AS total_runs_scored,
  CAST(bat.runs AS DOUBLE)*100/nullif(bat.balls,0) AS batting_strike_rate, coalesce(bowl.wickets,0) AS total_wickets_taken,
  CAST(bowl.conceded AS DOUBLE)*6/nullif(bowl.balls,0) AS bowling_economy_rate, CAST(bat.runs AS DOUBLE)/nullif(bat.outs,0) AS batting_average,
  CAST(bowl.conceded AS DOUBLE)/nullif(bowl.wickets,0) AS bowling_average, CAST(bat.bounds AS DOUBLE)*100/nullif(bat.balls,0) AS boundary_percentage,
  coalesce(half_centuries,0) AS half_centuries, coalesce(centuries,0) AS centuries, coalesce(hundreds_uncapped,0) AS hundreds_uncapped, coalesce(double_centuries,0) AS double_centuries,
  coalesce(triple_centuries,0) AS triple_centuries, coalesce(five_wicket_hauls,0) AS five_wicket_hauls, coalesce(ten_wicket_hauls,0) AS ten_wicket_hauls,
  coalesce(four_wicket_hauls,0) AS four_wicket_hauls, highest_score, best_bowling_wickets, coalesce(ducks,0) AS ducks, coalesce(not_outs,0) AS not_outs,
  coalesce(hat_tricks,0) AS hat_tricks, coalesce(true_hat_tricks,0) AS true_hat_tricks,
  coalesce(test_matches,0) AS test_matches, coalesce(odi_matches,0) AS odi_matches, coalesce(t20_matches,0) AS t20_matches,
  CAST(bat.test_runs AS DOUBLE)/nullif(test_outs,0) AS test_batting_average, CAST(bat.odi_runs AS DOUBLE)/nullif(odi_outs,0) AS odi_batting_average, CAST(bat.t20_runs AS DOUBLE)/nullif(t20_outs,0) AS t20_batting_average,
  CAST(test_conceded AS DOUBLE)/nullif(test_wickets,0) AS test_bowling_average, CAST(odi_conceded AS DOUBLE)/nullif(odi_wickets,0) AS odi_bowling_average, CAST(t20_conceded AS DOUBLE)/nullif(t20_wickets,0) AS t20_bowling_average,
  test_runs, odi_runs, t20_runs, test_wickets, odi_wickets, t20_wickets
  FROM p LEFT JOIN apps ON apps.player_id=p.player_id LEFT JOIN bat ON bat.player_id=p.player_id LEFT JOIN bowl ON bowl.player_id=p.player_id
  LEFT JOIN irs ON irs.player_id=p.player_id LEFT JOIN iws ON iws.player_id=p.player_id LEFT JOIN mw ON mw.player_id=p.player_id
  LEFT JOIN ht ON ht.player_id=p.player_id LEFT JOIN tht ON tht.player_id=p.player_id)"""

CAREER_QUERIES = {
    "l01_matches_played": ["total_matches_played"],
    "l02_total_runs": ["total_runs_scored"],
    "l03_batting_strike_rate": ["batting_strike_rate"],
    "l04_total_wickets": ["total_wickets_taken"],
    "l05_bowling_economy": ["bowling_economy_rate"],
    "l06_batting_average": ["batting_average"],
    "l07_bowling_average": ["bowling_average"],
    "l08_boundary_percentage": ["boundary_percentage"],
    "l09_half_centuries": ["half_centuries"],
    "l10_centuries": ["centuries"],
    "l11_double_centuries": ["double_centuries"],
    "l12_triple_centuries": ["triple_centuries"],
    "l13_five_wicket_hauls": ["five_wicket_hauls"],
    "l14_ten_wicket_hauls": ["ten_wicket_hauls"],
    "l15_four_wicket_hauls": ["four_wicket_hauls"],
    "l16_highest_score": ["highest_score"],
    "l17_best_bowling": ["best_bowling_wickets"],
    "l18_ducks": ["ducks"],
    "l19_not_outs": ["not_outs"],
    "l20_hat_tricks": ["hat_tricks", "true_hat_tricks"],
    "l21_format_matches": ["test_matches", "odi_matches", "t20_matches"],
    "l22_format_batting_average": ["test_batting_average", "odi_batting_average", "t20_batting_average"],
    "l23_format_bowling_average": ["test_bowling_average", "odi_bowling_average", "t20_bowling_average"],
    "l24_format_runs": ["test_runs", "odi_runs", "t20_runs"],
    "l25_format_wickets": ["test_wickets", "odi_wickets", "t20_wickets"],
    "l_player_features": [c for g in GROUPS.values() for c in g],
}


def _is_ratio(column: str) -> bool:
    return column.endswith(("_rate", "_average", "_percentage", "_bowled")) and not column.startswith(
        ("balls_", "dot_balls_", "overs_", "wides_", "noballs_")
    )


def _typed(columns: list[str], texts: tuple[str, ...] = ()) -> dict[str, str]:
    ratios = [c for c in columns if _is_ratio(c)]
    return {"dbl": " ".join(ratios), "big": " ".join(c for c in columns if c not in ratios and c not in texts)}


_L = {
    key: _shape(f"SELECT player_id, {', '.join(columns)} FROM c", extra=_CAREERS, **_typed(columns))
    for key, columns in CAREER_QUERIES.items()
}
_L["l10_centuries_uncapped"] = _shape(
    "SELECT player_id, hundreds_uncapped AS centuries FROM c", extra=_CAREERS, big="centuries"
)
_TOP = ["total_matches_played", "total_runs_scored", "total_wickets_taken", "batting_average", "bowling_average", "highest_score"]
_L["l26_top_run_scorers"] = _shape(
    f"SELECT player_id, player_name, {', '.join(_TOP)} FROM c ORDER BY total_runs_scored DESC NULLS LAST, player_id LIMIT 10",
    extra=_CAREERS, **_typed(_TOP),
)

# ---------------------------------------------------------------- match mart


def _mart(full: bool) -> str:
    """Roles are rows here too, but all measures come from one filtered aggregation of all balls."""
    roles = {"bat": "batter_id", "bowl": "bowler_id", "partner": "non_striker_id"}
    if full:
        roles |= {"out": "wicket_player_out_id", "field": "wicket_fielder_id"}
    measured = "match_id, innings_id, over_number, batter_runs, total_runs, extras_type, is_wicket, wicket_kind"
    rows = " UNION ALL ".join(f"SELECT '{role}' AS role, {column} AS pid, {measured} FROM d WHERE {column} IS NOT NULL" for role, column in roles.items())
    counted = f"is_wicket AND wicket_kind IN {_BOWL5}" if full else "is_wicket"
    side = "role IN ('bat','bowl','partner') AND team1 IN (batting_team, bowling_team)" if full else "role='bat' AND team1=batting_team"
    n = lambda test: f"count(*) FILTER ({test})"
    runs = lambda column, test: f"coalesce(sum({column}) FILTER ({test}), 0)"
    return f""",
r AS ({rows}),
t1 AS (SELECT DISTINCT r.match_id, pid FROM r JOIN i ON i.innings_id=r.innings_id JOIN m ON m.match_id=r.match_id WHERE {side}),
w AS (SELECT match_id, pid, count(DISTINCT innings_id) FILTER (role='bat') AS innings_batted, {n("role='bat'")} AS balls_faced, {runs('batter_runs', "role='bat'")} AS runs_scored,
  {n("role='bat' AND batter_runs=4")} AS fours, {n("role='bat' AND batter_runs=6")} AS sixes, least({n("role='out'")}, 1) AS was_dismissed, max(wicket_kind) FILTER (role='out') AS dismissal_type,
  count(DISTINCT innings_id||'/'||over_number) FILTER (role='bowl') AS overs_bowled, {n("role='bowl'")} AS balls_bowled, {runs('total_runs', "role='bowl'")} AS runs_conceded,
  {n(f"role='bowl' AND {counted}")} AS wickets_taken, {n("role='bowl' AND extras_type='wides'")} AS wides_bowled, {n("role='bowl' AND extras_type='noballs'")} AS noballs_bowled,
  {n("role='bowl' AND total_runs=0")} AS dot_balls_bowled, {n("role='field'")} AS catches_taken FROM r GROUP BY match_id, pid),
g AS (SELECT w.*, date, venue, match_type, team1, team2, outcome_winner, player_of_match_id, player_id, player_name
  FROM w JOIN m ON m.match_id=w.match_id JOIN p ON p.player_id=w.pid),
bo AS (SELECT match_id, innings_id, batter_id, row_number() OVER (PARTITION BY match_id, innings_id ORDER BY k, b, batter_id) AS pk, row_number() OVER (PARTITION BY match_id, innings_id ORDER BY b, batter_id) AS pb
  FROM (SELECT match_id, innings_id, batter_id, min(over_number*6+ball_number) AS k, min(over_number*100000+ball_number) AS b FROM d GROUP BY 1,2,3) x),
bp AS (SELECT match_id, batter_id, min(pk) AS batting_position, min(pb) AS batting_order_position FROM bo GROUP BY 1,2),
sd AS (SELECT match_id, innings_id, player_id, max(s) AS s FROM (SELECT match_id, innings_id, batter_id AS player_id, 1 AS s FROM d UNION ALL SELECT match_id, innings_id, non_striker_id, 1 FROM d
  UNION ALL SELECT match_id, innings_id, wicket_player_out_id, 1 FROM d UNION ALL SELECT match_id, innings_id, bowler_id, 0 FROM d UNION ALL SELECT match_id, innings_id, wicket_fielder_id, 0 FROM d) x WHERE player_id IS NOT NULL GROUP BY 1,2,3),
ac AS (SELECT sd.match_id, sd.player_id, arg_min(CASE WHEN s=1 THEN batting_team ELSE bowling_team END, innings_number) AS actual_team FROM sd JOIN i ON i.innings_id=sd.innings_id GROUP BY 1,2),
g2 AS (SELECT g.*, CASE WHEN t1.pid IS NOT NULL THEN team1 ELSE team2 END AS player_team, bp.batting_position, bp.batting_order_position, ac.actual_team FROM g
  LEFT JOIN t1 ON t1.match_id=g.match_id AND t1.pid=g.player_id LEFT JOIN bp ON bp.match_id=g.match_id AND bp.batter_id=g.player_id LEFT JOIN ac ON ac.match_id=g.match_id AND ac.player_id=g.player_id),
mart AS (SELECT match_id, date, venue, match_type, team1, team2, player_id, player_name, player_team, innings_batted, balls_faced, runs_scored, fours, sixes,
  CASE WHEN balls_faced>0 THEN CAST(runs_scored AS DOUBLE)*100/balls_faced END AS batting_strike_rate, was_dismissed, dismissal_type, runs_scored AS total_runs,
  overs_bowled, balls_bowled, runs_conceded, wickets_taken, wides_bowled, noballs_bowled, dot_balls_bowled,
  CASE WHEN balls_bowled>=6 THEN CAST(runs_conceded AS DOUBLE)*6/balls_bowled END AS bowling_economy_rate, catches_taken,
  CASE WHEN outcome_winner=player_team THEN 'won' WHEN outcome_winner IS NULL THEN 'no result' ELSE 'lost' END AS match_result,
  CASE WHEN player_of_match_id=player_id THEN true ELSE false END AS is_player_of_match,
  runs_scored>=50 AND runs_scored<100 AS is_half_century, runs_scored>=100 AS is_century, wickets_taken>=5 AS is_five_wicket_haul,
  CASE WHEN balls_faced>0 THEN CAST(fours+sixes AS DOUBLE)*100/balls_faced END AS boundary_percentage,
  CASE WHEN balls_bowled>0 THEN CAST(dot_balls_bowled AS DOUBLE)*100/balls_bowled END AS dot_ball_percentage_bowled,
  CASE WHEN wickets_taken>0 THEN CAST(balls_bowled AS DOUBLE)/wickets_taken END AS bowling_strike_rate,
  CASE WHEN runs_scored>0 THEN CAST(runs_scored AS DOUBLE)*100/nullif(sum(runs_scored) OVER team,0) END AS match_runs_contribution_percentage,
  CASE WHEN wickets_taken>0 THEN CAST(wickets_taken AS DOUBLE)*100/nullif(sum(wickets_taken) OVER team,0) END AS match_wickets_contribution_percentage,
  batting_position, batting_order_position, actual_team FROM g2 WINDOW team AS (PARTITION BY match_id, player_team))"""


_MART_WHOLE = {
    "innings_batted", "balls_faced", "runs_scored", "fours", "sixes", "was_dismissed", "total_runs",
    "overs_bowled", "balls_bowled", "runs_conceded", "wickets_taken", "wides_bowled", "noballs_bowled",
    "dot_balls_bowled", "catches_taken", "batting_position", "batting_order_position",
}
_MART_RATIOS = {
    "batting_strike_rate", "bowling_economy_rate", "boundary_percentage", "dot_ball_percentage_bowled",
    "bowling_strike_rate", "match_runs_contribution_percentage", "match_wickets_contribution_percentage",
}
MART_COLUMNS = [
    "match_id", "date", "venue", "match_type", "team1", "team2", "player_id", "player_name", "player_team",
    "innings_batted", "balls_faced", "runs_scored", "fours", "sixes", "batting_strike_rate", "was_dismissed",
    "dismissal_type", "total_runs", "overs_bowled", "balls_bowled", "runs_conceded", "wickets_taken",
    "wides_bowled", "noballs_bowled", "dot_balls_bowled", "bowling_economy_rate", "catches_taken",
    "match_result", "is_player_of_match", "is_half_century", "is_century", "is_five_wicket_haul",
    "boundary_percentage", "dot_ball_percentage_bowled", "bowling_strike_rate",
    "match_runs_contribution_percentage", "match_wickets_contribution_percentage",
    "batting_position", "batting_order_position", "actual_team",
]
MART_QUERIES = {
    "m01_player_match_stats": MART_COLUMNS,
    "m03_player_team": ["player_team", "actual_team"],
    "m05_batting": ["innings_batted", "balls_faced", "runs_scored", "fours", "sixes"],
    "m06_batting_strike_rate": ["batting_strike_rate"],
    "m07_dismissal": ["was_dismissed", "dismissal_type"],
    "m08_total_runs": ["total_runs"],
    "m09_overs_bowled": ["overs_bowled"],
    "m10_bowling": ["balls_bowled", "runs_conceded", "wickets_taken"],
    "m11_extras_and_dots": ["wides_bowled", "noballs_bowled", "dot_balls_bowled"],
    "m12_bowling_economy": ["bowling_economy_rate"],
    "m13_catches": ["catches_taken"],
    "m14_match_result": ["match_result"],
    "m15_player_of_match": ["is_player_of_match"],
    "m16_flags": ["is_half_century", "is_century", "is_five_wicket_haul"],
    "m17_rates": ["boundary_percentage", "dot_ball_percentage_bowled", "bowling_strike_rate"],
    "m18_runs_contribution": ["match_runs_contribution_percentage"],
    "m19_wickets_contribution": ["match_wickets_contribution_percentage"],
    "m20_batting_position": ["batting_position", "batting_order_position"],
}


def _mart_columns(columns: list[str]) -> list[str]:
    return columns if "match_id" in columns else ["match_id", "player_id", *columns]


def _mart_types(columns) -> dict[str, str]:
    return {
        "dbl": " ".join(c for c in columns if c in _MART_RATIOS),
        "big": " ".join(c for c in columns if c in _MART_WHOLE),
        "txt": "date" if "date" in columns else "",
    }


def _mart_query(columns: list[str], full: bool = True, tail: str = "") -> str:
    return _shape(f"SELECT {', '.join(columns)} FROM mart {tail}", extra=_mart(full), **_mart_types(columns))


_REDUCED = [c for c in MART_COLUMNS if c in (
    "match_id", "date", "venue", "match_type", "team1", "team2", "player_id", "player_name", "player_team",
    "innings_batted", "balls_faced", "runs_scored", "fours", "sixes", "balls_bowled", "runs_conceded",
    "wickets_taken", "is_half_century", "is_century", "is_five_wicket_haul", "is_player_of_match")]
_NOTABLE = [
    "match_id", "player_name", "player_team", "runs_scored", "wickets_taken", "batting_strike_rate",
    "bowling_economy_rate", "is_half_century", "is_century", "is_five_wicket_haul", "boundary_percentage",
    "match_runs_contribution_percentage", "match_wickets_contribution_percentage", "batting_position",
    "is_player_of_match", "match_result",
]

_M = {key: _mart_query(_mart_columns(columns)) for key, columns in MART_QUERIES.items()}
_M["m01_role_join_reduced"] = _mart_query(_REDUCED, full=False)
_M["m04_player_team_reduced"] = _mart_query(["match_id", "player_id", "player_team"], full=False)
_M["m02_group_sizes"] = _shape("SELECT match_id, count(*) AS players FROM mart GROUP BY 1", extra=_mart(True), big="players")
_M["m22_notable_performances"] = _mart_query(
    _NOTABLE, tail="WHERE runs_scored>50 OR wickets_taken>2 ORDER BY date DESC, runs_scored DESC, match_id, player_id LIMIT 5"
)
_F["f17_verify_features"] = _shape(
    f"""SELECT 'deliveries_features' AS feature, count(boundary_type) AS rows FROM ({_DELIVERIES}) a
    UNION ALL SELECT 'innings_features', count(total_runs) FROM ({_INNINGS}) b UNION ALL SELECT 'matches_features', count(match_result) FROM ({_MATCHES}) c2
    UNION ALL SELECT 'overs_features', count(run_rate) FROM ({_OVERS}) e UNION ALL SELECT 'players_features', count(*) FROM p
    UNION ALL SELECT 'player_match_stats', count(*) FROM mart""",
    extra=_mart(True), big="rows",
)


# ---------------------------------------------------------------- unnesting

_DOCS = """,
md AS (SELECT m.*, k, player_of_match,
  CASE WHEN k%2=0 THEN 'male' ELSE 'female' END AS gender, concat('20', CAST(20+k%3 AS VARCHAR)) AS season,
  CASE WHEN k%8<>1 THEN concat('City ', CAST(k%12 AS VARCHAR)) END AS city,
  CASE WHEN k%11=4 THEN '2020-13-01' ELSE CAST(m.date AS VARCHAR) END AS date_raw,
  CASE WHEN k%11=4 THEN NULL ELSE CAST(m.date AS VARCHAR) END AS parsed,
  CASE k%3 WHEN 0 THEN 'Cup' WHEN 1 THEN 'Cup Series' END AS event_name, CASE WHEN k%3=0 THEN 'A' END AS event_group,
  CASE WHEN k%3=0 THEN k END AS event_number, CASE WHEN k%2=0 THEN 'bat' ELSE 'field' END AS decision
  FROM (SELECT *, CAST(substring(match_id,2) AS INT) AS k FROM m) m JOIN pom ON pom.match_id=m.match_id),
um AS (SELECT md.match_id, parsed AS date, city, venue, match_type, gender, season, event_name AS match_event_name, event_group AS match_event_id,
  event_number AS match_number, CAST(overs AS INT) AS overs, team1, team2, team2 AS toss_winner, decision AS toss_decision, outcome_winner,
  outcome_by_runs, outcome_by_wickets, outcome_method, player_of_match, ids.player_id AS player_of_match_id, date_raw
  FROM md LEFT JOIN ids ON ids.match_id=md.match_id AND ids.name=md.player_of_match),
uo AS (SELECT over_id, innings_id, over_number, sum(total_runs) AS total_runs, sum(CASE WHEN is_wicket THEN 1 ELSE 0 END) AS wickets, count(*) AS num_deliveries,
  sum(extras) AS total_extras, coalesce(sum(extras) FILTER (extras_type='wides'),0) AS extras_wides,
  coalesce(sum(extras) FILTER (extras_type='noballs'),0)+count(*) FILTER (extras_type='legbyes' AND ball_number%2=1) AS extras_noballs,
  coalesce(sum(extras) FILTER (extras_type='byes'),0) AS extras_byes, coalesce(sum(extras) FILTER (extras_type='legbyes'),0) AS extras_legbyes FROM n GROUP BY 1,2,3),
ud AS (SELECT delivery_id, over_id, innings_id, match_id, over_number, ball_number, batter, batter_id, bowler, bowler_id, non_striker, non_striker_id,
  batter_runs, extras, total_runs, extras_type, extras_value, CASE WHEN is_wicket THEN 1 ELSE 0 END AS is_wicket, wicket_player_out, wicket_player_out_id, wicket_kind, wicket_fielder, wicket_fielder_id FROM nd),
pc AS (SELECT player_id, name, count(*) AS times FROM (SELECT batter_id AS player_id, batter AS name FROM nd UNION ALL SELECT bowler_id, bowler FROM nd UNION ALL SELECT non_striker_id, non_striker FROM nd
  UNION ALL SELECT wicket_player_out_id, wicket_player_out FROM nd UNION ALL SELECT wicket_fielder_id, wicket_fielder FROM nd UNION ALL SELECT player_of_match_id, player_of_match FROM um
  UNION ALL SELECT registered_id, name FROM roster WHERE registered_id IS NOT NULL) x WHERE player_id IS NOT NULL GROUP BY 1,2),
pr AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY times DESC, name) AS rn FROM pc),
up AS (SELECT player_id, max(CASE WHEN rn=1 THEN name END) AS player_name, string_agg(name, ';' ORDER BY rn) FILTER (rn>1) AS name_variations, count(*) AS variant_count FROM pr GROUP BY 1),
meta AS (SELECT md.match_id, '1.0.0' AS data_version, '2024-01-01' AS created_date, k%3 AS revision, match_type, k AS match_type_number, gender, concat(team1,'|',team2) AS teams, 'international' AS team_type,
  CAST(overs AS INT) AS overs, CASE WHEN k%3<>0 THEN 6 END AS balls_per_over, date_raw AS date, city, venue, season, event_name, event_group, 'U One|U Two' AS umpires, CASE WHEN k%2=0 THEN 'R One' END AS referees,
  team2 AS toss_winner, decision AS toss_decision, outcome_winner, CASE WHEN outcome_winner IS NULL THEN 'no result' END AS outcome_result, outcome_method, outcome_by_runs, outcome_by_wickets,
  coalesce(player_of_match,'') AS player_of_match,
  (SELECT count(*) FROM roster r WHERE r.match_id=md.match_id AND r.team=md.team1) AS team1_players, (SELECT count(*) FROM roster r WHERE r.match_id=md.match_id AND r.team=md.team2) AS team2_players,
  (SELECT count(*) FROM roster r WHERE r.match_id=md.match_id AND registered_id IS NOT NULL) AS registry_count,
  CASE WHEN k%6=2 THEN 'umpires|toss' ELSE '' END AS missing_fields, true AS has_innings_data,
  (SELECT count(*) FROM i WHERE i.match_id=md.match_id) AS innings_count, (SELECT count(*) FROM o JOIN i ON i.innings_id=o.innings_id WHERE i.match_id=md.match_id) AS total_overs_recorded,
  (SELECT count(*) FROM d WHERE d.match_id=md.match_id) AS total_deliveries FROM md)"""


def _docs(body: str, **types) -> str:
    return _shape(body, ctes=ALL, extra=_DOCS, **types)


def _named(body: str, **types) -> str:
    return _shape(body, ctes=ALL, **types)


#: The columns of a delivery that hold a name.
ROLES = ("batter", "bowler", "non_striker", "wicket_player_out", "wicket_fielder")
_EXTRAS = "total_extras extras_wides extras_noballs extras_byes extras_legbyes"
_U = {
    "u01_matches": _docs("SELECT * FROM um", big="match_number overs outcome_by_runs outcome_by_wickets"),
    "u02_event": _docs("SELECT match_id, match_event_name, match_event_id, match_number FROM um", big="match_number"),
    "u03_innings": _docs("SELECT * FROM i", big="innings_number", dbl="powerplay_start_over powerplay_end_over"),
    "u04_powerplay": _docs("SELECT innings_id, powerplay_start_over, powerplay_end_over FROM i", dbl="powerplay_start_over powerplay_end_over"),
    "u05_bowling_team": _docs("SELECT innings_id, bowling_team FROM i"),
    "u06_overs": _docs("SELECT * FROM uo", big="over_number total_runs wickets num_deliveries " + _EXTRAS),
    "u07_over_totals": _docs("SELECT over_id, total_runs, wickets, num_deliveries FROM uo", big="total_runs wickets num_deliveries"),
    "u08_over_extras": _docs(f"SELECT over_id, {', '.join(_EXTRAS.split())} FROM uo", big=_EXTRAS),
    "u09_deliveries": _docs("SELECT * FROM ud", big="over_number ball_number batter_runs extras total_runs extras_value is_wicket"),
    "u10_first_extras": _docs("SELECT delivery_id, extras_type, extras_value FROM ud", big="extras_value"),
    "u11_first_wicket": _docs("SELECT delivery_id, is_wicket, wicket_player_out, wicket_kind, wicket_fielder FROM ud", big="is_wicket"),
    "u12_player_names": _named("SELECT match_id, name, player_id FROM ids"),
    "u12_resolve_gaps": _named("SELECT ids.match_id, ids.name, ids.player_id FROM ids JOIN roster ON roster.match_id=ids.match_id AND roster.name=ids.name WHERE registered_id IS NULL"),
    "u12_resolve_ids": _named(" UNION ALL ".join(f"SELECT match_id, {r} AS name, delivery_id, '{r}' AS role, {r}_id AS player_id FROM nd WHERE {r} IS NOT NULL" for r in ROLES)),
    "u13_players": _docs("SELECT * FROM up", big="variant_count"),
    "u14_variant_stats": _docs("SELECT count(*) FILTER (variant_count>1) AS players_with_variants, max(variant_count) FILTER (variant_count>1) AS max_variants FROM up", big="players_with_variants max_variants"),
    "u15_synthetic_count": _docs("SELECT count(*) FILTER (starts_with(player_id,'SYNTH_')) AS synthetic_ids FROM up", big="synthetic_ids"),
}

# ---------------------------------------------------------------- raw profiling

_META_COLUMNS = (
    "match_id data_version created_date revision match_type match_type_number gender teams team_type overs balls_per_over date city venue "
    "season event_name event_group umpires referees toss_winner toss_decision outcome_winner outcome_result outcome_method outcome_by_runs "
    "outcome_by_wickets player_of_match team1_players team2_players registry_count missing_fields has_innings_data innings_count "
    "total_overs_recorded total_deliveries"
).split()
_META_WHOLE = (
    "revision match_type_number overs balls_per_over outcome_by_runs outcome_by_wickets team1_players team2_players registry_count "
    "innings_count total_overs_recorded total_deliveries"
)


def _describe(table: str, source: str, column: str, text: bool) -> str:
    if not text:
        return (
            f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", count({column}) AS \"count\", CAST(NULL AS BIGINT) AS \"unique\", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq,"
            f" avg({column}) AS mean, stddev_samp({column}) AS std, min({column}) AS min, max({column}) AS max FROM {source}"
        )
    counts = f"(SELECT CAST({column} AS VARCHAR) AS v, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)"
    return (
        f"SELECT '{table}', '{column}', sum(n), count(*), (SELECT v FROM {counts} y ORDER BY n DESC, v LIMIT 1), max(n),"
        f" NULL, NULL, NULL, NULL FROM {counts} x HAVING count(*)>0"
    )


def _describe_all() -> str:
    whole = _META_WHOLE.split()
    numbers = [c for c, t in _TYPES["deliveries"].items() if t != "boolean"]
    columns = [("deliveries", "d", c, c not in numbers) for c in _COLUMNS["deliveries"]] + [("metadata", "meta", c, c not in whole) for c in _META_COLUMNS]
    return " UNION ALL ".join(_describe(*c) for c in sorted(columns, key=lambda c: c[3]))


def _nulls(source: str, table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", count(*)-count({c}) AS null_count, count(*) AS total_rows,"
        f" CAST(count(*)-count({c}) AS DOUBLE)*100/count(*) AS null_percentage FROM {source}"
        for c in columns
    )


_INFO_KEYS = """concat_ws(',', CASE WHEN k%3<>0 THEN 'balls_per_over' END, CASE WHEN city IS NOT NULL THEN 'city' END, 'dates', CASE WHEN event_name IS NOT NULL THEN 'event' END,
  'gender,match_type,match_type_number', CASE WHEN k%6=2 THEN 'missing' END, 'officials,outcome', CASE WHEN overs IS NOT NULL THEN 'overs' END,
  CASE WHEN player_of_match IS NOT NULL THEN 'player_of_match' END, 'players,registry,season,team_type,teams,toss,venue')"""
_INFO_VARIANTS = f"SELECT 'info' AS level, {_INFO_KEYS} AS keys, count(*) AS count FROM md GROUP BY 2"
_VARIANTS = f"""SELECT 'top' AS level, 'info,innings,meta' AS keys, count(*) AS count FROM md UNION ALL {_INFO_VARIANTS}
  UNION ALL SELECT 'innings', CASE WHEN powerplay_start_over IS NULL THEN 'overs,team' ELSE 'overs,powerplays,team' END, count(*) FROM i GROUP BY 2
  UNION ALL SELECT 'over', 'deliveries,over', count(*) FROM o
  UNION ALL SELECT 'delivery', concat_ws(',', 'batter,bowler', CASE WHEN extras>0 THEN 'extras' END, 'non_striker,runs', CASE WHEN is_wicket THEN 'wickets' END), count(*) FROM d GROUP BY 2"""
_PRESENCE = """SELECT field, n AS deliveries, CAST(n AS DOUBLE)*100/(SELECT count(*) FROM d) AS percentage, CAST(n AS DOUBLE)*100/(SELECT count(*) FROM m) AS files_percentage,
  CAST(n AS DOUBLE)/(SELECT count(*) FROM d)>=0.95 AS required FROM (SELECT unnest(['batter','bowler','non_striker','runs']) AS field, count(*) AS n FROM d
  UNION ALL SELECT 'extras', count(*) FROM d WHERE extras>0 UNION ALL SELECT 'wickets', count(*) FROM d WHERE is_wicket) x WHERE n>0"""


def _types() -> str:
    always = {
        "match_type": "str", "match_type_number": "int", "gender": "str", "season": "str", "venue": "str", "team_type": "str",
        "teams": "list", "dates": "list", "officials": "dict", "toss": "dict", "outcome": "dict", "players": "dict", "registry": "dict",
    }
    parts = [f"SELECT 'info' AS section, '{f}' AS field, '{t}' AS type, count(*) AS count FROM md" for f, t in always.items()]
    sometimes = {
        "city": ("str", "city IS NOT NULL"), "overs": ("int", "overs IS NOT NULL"), "balls_per_over": ("int", "k%3<>0"),
        "player_of_match": ("list", "player_of_match IS NOT NULL"), "missing": ("list", "k%6=2"), "event": ("str", "event_name IS NOT NULL"),
    }
    parts += [f"SELECT 'info', '{f}', '{t}', count(*) FROM md WHERE {w}" for f, (t, w) in sometimes.items()]
    balls = {
        "batter": "str", "bowler": "str", "non_striker": "str", "runs": "dict", "runs.batter": "int", "runs.extras": "int", "runs.total": "int",
    }
    parts += [f"SELECT 'delivery', '{f}', '{t}', count(*) FROM d" for f, t in balls.items()]
    parts += [
        "SELECT 'delivery', 'extras', 'dict', count(*) FROM d WHERE extras>0",
        "SELECT 'delivery', 'wickets', 'list', count(*) FROM d WHERE is_wicket",
        "SELECT 'delivery', 'extras.noballs', 'int', count(*) FROM d WHERE extras>0 AND (extras_type='noballs' OR extras_type='legbyes' AND ball_number%2=1)",
    ]
    parts += [f"SELECT 'delivery', 'extras.{t}', 'int', count(*) FROM d WHERE extras>0 AND extras_type='{t}'" for t in ("wides", "byes", "legbyes")]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) x WHERE count>0"


def _similar(source: str, column: str, threshold: float, lower: bool, strict: bool = False, counts: bool = False) -> str:
    text = f"lower({column})" if lower else column
    names = f"(SELECT {column} AS name, {text} AS t, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1,2)"
    test = f"similarity>{threshold} AND similarity<1.0" if strict else f"similarity>={threshold}"
    extra = ", count1, count2" if counts else ""
    return f"""SELECT name1, name2, similarity{extra} FROM (SELECT a.name AS name1, b.name AS name2, a.n AS count1, b.n AS count2,
      1.0-CAST(levenshtein(a.t,b.t) AS DOUBLE)/greatest(length(a.t),length(b.t)) AS similarity FROM {names} a JOIN {names} b ON a.name<b.name) s WHERE {test}"""


# What the odd texts add: for each fourth match one without innings, for each fifth two that are no documents.
_NUMBER = "CAST(regexp_extract(match_id,'[0-9]+') AS BIGINT)"
_FOURTH, _FIFTH = f"{_NUMBER}%4=0", f"{_NUMBER}%5=0"
_EMPTY_META = ("match_id||'-empty' AS match_id, match_type, 20 AS overs, '' AS teams, '' AS player_of_match, '' AS missing_fields, 0 AS team1_players, 0 AS team2_players,"
  " 0 AS registry_count, false AS has_innings_data, 0 AS innings_count, 0 AS total_overs_recorded, 0 AS total_deliveries")

_P = {
    "p01_doc_structure": _docs("""SELECT md.match_id, 'meta,info,innings' AS top_level_keys, '{"data_version":"1.0.0","created":"2024-01-01","revision":'||CAST(k%3 AS VARCHAR)||'}' AS meta, true AS has_innings,
      (SELECT count(*) FROM i WHERE i.match_id=md.match_id) AS innings_count, f.batting_team AS first_innings_team, (SELECT count(*) FROM o WHERE o.innings_id=f.innings_id) AS first_innings_overs
      FROM md JOIN (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY innings_number) AS rn FROM i) f ON f.match_id=md.match_id AND rn=1""", big="innings_count first_innings_overs"),
    "p02_schema_variants": _docs(_VARIANTS, big="count"),
    "p02_schema_variants_props": _shape("SELECT 'top' AS level, array_to_string(list_sort(json_keys(props)), ',') AS keys, count(*) AS count FROM events GROUP BY 2", ctes="", big="count"),
    "p03_top_variants": _docs(f"SELECT level, keys, count FROM (SELECT *, row_number() OVER (PARTITION BY level ORDER BY count DESC, keys) AS rn FROM ({_VARIANTS}) v WHERE count>0) w WHERE rn<=5", big="count"),
    "p04_match_type_counts": _docs("SELECT match_type, count(*) AS count FROM md GROUP BY 1", big="count"),
    "p05_reject_report": _shape("""SELECT 'error_count' AS key, CAST(count(*) AS VARCHAR) AS value FROM documents WHERE NOT json_valid(text) OR NOT starts_with(ltrim(text),'{')
      UNION ALL SELECT CAST(doc_id AS VARCHAR), concat(CASE WHEN json_valid(text) THEN 'not a JSON object' ELSE 'not JSON' END, ', ', length(text), ' characters, ', md5(text))
      FROM documents WHERE NOT json_valid(text) OR NOT starts_with(ltrim(text),'{')""", ctes=""),
    "p06_field_presence": _docs(_PRESENCE, big="deliveries", dbl="percentage files_percentage"),
    "p07_match_metadata": _docs("SELECT * FROM meta", big=_META_WHOLE),
    "p07_short_metadata": _docs("SELECT match_id, match_type, teams, date, city, venue, has_innings_data, innings_count, total_deliveries FROM meta", big="innings_count total_deliveries"),
    "p08_document_totals": _docs("SELECT match_id, total_overs_recorded, total_deliveries FROM meta", big="total_overs_recorded total_deliveries"),
    "p10_null_profile": _docs(f"SELECT * FROM ({_nulls('meta', 'metadata', _META_COLUMNS)}) x WHERE null_count>0", big="null_count total_rows", dbl="null_percentage"),
    "p11_empty_matches": _docs("SELECT concat(match_id, '-empty') AS match_id, match_type FROM meta WHERE CAST(regexp_extract(match_id,'[0-9]+') AS BIGINT)%4=0"),
    "s01_read_matches": _docs(f"SELECT * FROM meta UNION ALL BY NAME SELECT {_EMPTY_META} FROM meta WHERE {_FOURTH}", big=_META_WHOLE),
    "s02_read_raw": _docs(f"""SELECT match_id, '{{"' AS start, 'read' AS outcome FROM meta UNION ALL SELECT match_id||'-empty', '{{"', 'read' FROM meta WHERE {_FOURTH}
      UNION ALL SELECT match_id||'-broken', '{{{{', 'not JSON' FROM meta WHERE {_FIFTH} UNION ALL SELECT match_id||'-list', '[{{', 'not a JSON object' FROM meta WHERE {_FIFTH}"""),
    "p12_completeness_by_type": _docs("""SELECT match_type, count(*) AS count, sum(total_deliveries) AS total_deliveries, avg(innings_count) AS avg_innings,
      avg(CASE WHEN city IS NULL THEN 100.0 ELSE 0 END) AS pct_null_city, avg(CASE WHEN venue IS NULL THEN 100.0 ELSE 0 END) AS pct_null_venue,
      avg(CASE WHEN outcome_winner IS NULL THEN 0 ELSE 100.0 END) AS pct_with_winner, avg(CASE WHEN outcome_result IS NULL THEN 0 ELSE 100.0 END) AS pct_with_result,
      avg(CASE WHEN player_of_match='' THEN 0 ELSE 100.0 END) AS pct_with_pom, avg(CASE WHEN missing_fields='' THEN 0 ELSE 100.0 END) AS pct_with_missing_fields FROM meta GROUP BY 1""",
      big="count total_deliveries", dbl="avg_innings pct_null_city pct_null_venue pct_with_winner pct_with_result pct_with_pom pct_with_missing_fields"),
    "p13_matches_per_year": _docs("SELECT year(try_cast(date AS DATE)) AS year, count(*) AS matches FROM meta WHERE try_cast(date AS DATE) IS NOT NULL GROUP BY 1", big="year matches"),
    "p14_top_venues": _docs("SELECT venue, count(*) AS count FROM meta GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20", big="count"),
    "p14_top_team_pairs": _docs("SELECT teams, count(*) AS count FROM meta GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20", big="count"),
    "p15_similar_names": _shape(_similar("customer", "c_name", 0.9, True), ctes="", dbl="similarity"),
    "p15_similar_venues": _docs(_similar("meta", "venue", 0.85, True), dbl="similarity"),
    "p16_registry_stats": _docs("SELECT avg(registry_count) AS avg_players, min(registry_count) AS min_players, max(registry_count) AS max_players FROM meta", dbl="avg_players", big="min_players max_players"),
    "p17_quality_issues": _docs("SELECT match_id, match_type, total_deliveries, team1_players, team2_players, registry_count FROM meta WHERE total_deliveries<10 OR team1_players<11 OR team2_players<11 OR registry_count<22",
      big="total_deliveries team1_players team2_players registry_count"),
    "p18_json_types": _docs(_types(), big="count"),
    "p19_describe_runs": _shape(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c},0.25) AS p25, quantile_cont({c},0.5) AS p50, quantile_cont({c},0.75) AS p75, max({c}) AS max FROM d"""
        for c in ("batter_runs", "extras", "total_runs")), big='"count" min max', dbl="mean std p25 p50 p75"),
    "p20_suspicious_deliveries": _named("SELECT match_id, coalesce(batter,'unknown') AS batter, coalesce(bowler,'unknown') AS bowler, batter_runs, extras, total_runs FROM nd WHERE total_runs>7", big="batter_runs extras total_runs"),
    "p21_run_share": _shape("SELECT v AS total_runs, (SELECT avg(CASE WHEN total_runs=v THEN 100.0 ELSE 0 END) FROM d) AS percentage FROM (SELECT unnest(generate_series(0,7)) AS v) x", big="total_runs", dbl="percentage"),
    "p22_runs_distribution": _shape("SELECT total_runs, count(*) AS count FROM d GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5", big="total_runs count"),
    "p23_over_stats_by_type": _shape("SELECT match_type, count(*) AS count, avg(num_deliveries) AS mean, stddev_pop(num_deliveries) AS std, min(num_deliveries) AS min, max(num_deliveries) AS max FROM o JOIN i ON i.innings_id=o.innings_id JOIN m ON m.match_id=i.match_id GROUP BY 1",
      big="count min max", dbl="mean std"),
    "p24_outlier_overs": _shape("SELECT m.match_id, match_type, 6 AS expected, over_number, num_deliveries AS deliveries FROM o JOIN i ON i.innings_id=o.innings_id JOIN m ON m.match_id=i.match_id WHERE num_deliveries>8", big="expected over_number deliveries"),
    "p25_profile_summary": _docs(f"""SELECT 'files_processed' AS key, count(*)+count(*) FILTER ({_FOURTH}) AS value FROM meta UNION ALL SELECT 'files_rejected', 2*count(*) FILTER ({_FIFTH}) FROM meta
      UNION ALL SELECT 'total_files', count(*)+count(*) FILTER ({_FOURTH})+2*count(*) FILTER ({_FIFTH}) FROM meta UNION ALL SELECT 'match_types', count(DISTINCT match_type) FROM meta
      UNION ALL SELECT 'matches_with_data', count(*)+count(*) FILTER ({_FOURTH}) FROM meta UNION ALL SELECT 'matches_with_innings', count(*) FROM meta""", big="value"),
}

# ---------------------------------------------------------------- table quality

RANGES = RANGE_SPEC
_SOURCES = {"deliveries": "d", "matches": "m", "innings": "i", "overs": "o", "players": "p"}
_COLUMNS = {
    "deliveries": "delivery_id over_id innings_id match_id over_number ball_number batter_id bowler_id non_striker_id batter_runs extras total_runs extras_type extras_value is_wicket wicket_kind wicket_player_out_id wicket_fielder_id".split(),
    "matches": "match_id date venue match_type overs team1 team2 outcome_winner outcome_by_runs outcome_by_wickets outcome_method player_of_match_id".split(),
    "innings": "innings_id match_id innings_number batting_team bowling_team powerplay_start_over powerplay_end_over".split(),
    "overs": "over_id innings_id over_number total_runs wickets num_deliveries total_extras".split(),
    "players": "player_id player_name".split(),
}
# Columns whose type changes: all whole numbers here start as INT, sums and counts as BIGINT.
_CHANGED = [
    (t, c, "bigint" if t == "overs" and c != "over_number" else "int", kind)
    for t, spec in RETYPE_SPEC.items() for c, kind in spec.items() if kind in ("tinyint", "smallint")
]


def _ranges(table: str, column: str, cast: str = "") -> str:
    value = f"TRY_CAST({column} AS {cast})" if cast else column
    return (
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", CAST(min({value}) AS VARCHAR) AS min_value,"
        f" CAST(max({value}) AS VARCHAR) AS max_value FROM {_SOURCES[table]}"
    )


_CHANGED_VALUES = ", ".join(f"('{t}','{c}','{a}','{b}')" for t, c, a, b in _CHANGED)
_CHANGED_ROWS = f'SELECT * FROM (VALUES {_CHANGED_VALUES}) v("table", "column", type_before, type_after)'
_ROWS = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n FROM {s}" for t, s in _SOURCES.items())
_WIDTHS = "SELECT * FROM (VALUES ('deliveries',225,184),('innings',88,81),('matches',152,139),('overs',72,45),('players',32,32)) v(\"table\", b, a)"
_MATCH_OVERS = """SELECT m.match_id, match_type, overs AS declared_overs, highest+1 AS max_over_number, n AS actual_overs_count, outcome_winner
  FROM m JOIN (SELECT match_id, max(highest) AS highest, CAST(sum(n) AS BIGINT) AS n FROM i JOIN (SELECT innings_id, max(over_number) AS highest, count(*) AS n FROM o GROUP BY innings_id) x ON x.innings_id=i.innings_id
    GROUP BY match_id) y ON y.match_id=m.match_id"""
_SEEN = """SELECT DISTINCT batter AS player_name FROM nd UNION SELECT bowler FROM nd UNION SELECT non_striker FROM nd UNION SELECT wicket_player_out FROM nd WHERE wicket_player_out IS NOT NULL"""
_SEEN_ALL = _SEEN + " UNION SELECT wicket_fielder FROM nd WHERE wicket_fielder IS NOT NULL"


def _issues(seen: str) -> str:
    return f"""SELECT s.player_name, count(DISTINCT np.player_id) AS id_count FROM ({seen}) s LEFT JOIN np ON np.player_name=s.player_name GROUP BY 1 HAVING count(DISTINCT np.player_id)<>1"""


_PAIRS = "SELECT batter_id AS player_id, batter AS player_name FROM nd UNION ALL SELECT bowler_id, bowler FROM nd UNION ALL SELECT non_striker_id, non_striker FROM nd UNION ALL SELECT wicket_player_out_id, wicket_player_out FROM nd WHERE wicket_player_out_id IS NOT NULL UNION ALL SELECT wicket_fielder_id, wicket_fielder FROM nd WHERE wicket_fielder_id IS NOT NULL"
_MANY = f"SELECT player_id, count(DISTINCT player_name) AS name_count, string_agg(DISTINCT player_name, ', ' ORDER BY player_name) AS names FROM ({_PAIRS}) x GROUP BY 1 HAVING count(DISTINCT player_name)>1"
_HEALTH = r"""SELECT 'documents' AS "table", c AS "column", cls AS class, n AS values, CAST(n AS DOUBLE)*100/sum(n) OVER (PARTITION BY c) AS percentage FROM (SELECT c, CASE WHEN contains(v, chr(65533)) THEN 'replacement_char'
  WHEN regexp_matches(v, 'Ã[\x{80}-\x{BF}]|Â[\x{80}-\x{BF}]|â€') THEN 'mojibake' WHEN regexp_matches(v, '[^\x00-\x7F]') THEN 'non_ascii' ELSE 'ascii' END AS cls, count(*) AS n
  FROM (SELECT 'text' AS c, text AS v FROM documents UNION ALL SELECT 'lang', lang FROM documents UNION ALL SELECT 'source', source FROM documents) x WHERE v IS NOT NULL GROUP BY 1,2) y"""
_BALL = "delivery_id, match_id, batter, bowler, batter_runs, extras, total_runs"

_Q = {
    "q01_table_shape": _shape(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows, {len(_COLUMNS[t])} AS columns FROM {s}" for t, s in _SOURCES.items()), big="rows columns"),
    "q01_sample": _shape("SELECT * FROM d ORDER BY delivery_id LIMIT 20", big="over_number ball_number batter_runs extras total_runs extras_value"),
    "q02_column_ranges": _shape(" UNION ALL ".join(_ranges(t, c) for t, cs in RANGES.items() for c in cs)),
    "q03_retype": _shape("SELECT delivery_id, TRY_CAST(total_runs*20 AS TINYINT) AS worth, over_number, ball_number FROM d", big="worth over_number ball_number"),
    "q03_retype_losses": _shape("SELECT 'over_number' AS \"column\", 'tinyint' AS type, count(*) FILTER (over_number>127) AS lost FROM d UNION ALL SELECT 'ball_number', 'tinyint', count(*) FILTER (ball_number>127) FROM d UNION ALL SELECT 'worth', 'tinyint', count(*) FILTER (total_runs*20>127) FROM d", big="lost"),
    "q04_schema_diff": None,  # below, with the types of all columns
    "q05_conversion_summary": _shape(f"SELECT type_before, type_after, count(*) AS columns, sum(n) AS values, CAST(count(*) AS DOUBLE)*100/{sum(len(c) for c in _COLUMNS.values())} AS column_share FROM ({_CHANGED_ROWS}) v JOIN ({_ROWS}) r ON r.\"table\"=v.\"table\" GROUP BY 1,2", big="columns values", dbl="column_share"),
    "q06_storage_estimate": _shape(f"SELECT w.\"table\", n AS row_count, b*n AS bytes_before, a*n AS bytes_after, (b-a)*n AS savings, CAST((b-a)*n AS DOUBLE)*100/(b*n) AS savings_pct FROM ({_WIDTHS}) w JOIN ({_ROWS}) r ON r.\"table\"=w.\"table\"", big="row_count bytes_before bytes_after savings", dbl="savings_pct"),
    "q07_null_profile": _shape(" UNION ALL ".join(_nulls(s, t, _COLUMNS[t]) for t, s in _SOURCES.items()), big="null_count total_rows", dbl="null_percentage"),
    "q08_venue_counts": _shape("SELECT venue, count(*) AS count FROM m WHERE venue IS NOT NULL GROUP BY 1", big="count"),
    "q09_similar_venues": _shape(_similar("m", "venue", 0.8, False, True, True), dbl="similarity", big="count1 count2"),
    "q09_similar_urls": _shape(_similar("pages", "url", 0.8, False, True, True), ctes="", dbl="similarity", big="count1 count2"),
    "q10_invalid_runs": _named("SELECT delivery_id, batter, bowler, match_id, batter_runs FROM nd WHERE batter_runs>7 ORDER BY batter_runs DESC, delivery_id LIMIT 10", big="batter_runs"),
    "q10_invalid_runs_count": _shape("SELECT count(*) AS count_invalid FROM d WHERE batter_runs>7", big="count_invalid"),
    "q11_seven_run_share": _shape("SELECT count(*) AS count_7_runs, (SELECT count(*) FROM d) AS total_deliveries, CAST(count(*) AS DOUBLE)*100/(SELECT count(*) FROM d) AS percentage FROM d WHERE batter_runs=7", big="count_7_runs total_deliveries", dbl="percentage"),
    "q12_match_overs_stats": _shape(f"""SELECT match_type, count(*) AS matches, avg(CAST(declared_overs AS DOUBLE)) AS avg_declared_overs, avg(max_over_number) AS avg_max_over, avg(actual_overs_count) AS avg_actual_overs,
      count(*) FILTER (outcome_winner IS NULL) AS no_result_matches, count(*) FILTER (actual_overs_count<CAST(declared_overs AS DOUBLE)*0.7 AND outcome_winner IS NOT NULL) AS shortened_with_result
      FROM ({_MATCH_OVERS}) x WHERE declared_overs IS NOT NULL AND match_type IN {_LIMITED} GROUP BY 1""", big="matches no_result_matches shortened_with_result", dbl="avg_declared_overs avg_max_over avg_actual_overs"),
    "q13_overs_exceeded": _shape(f"""SELECT * FROM ({_MATCH_OVERS}) x WHERE declared_overs IS NOT NULL AND match_type IN {_LIMITED} AND max_over_number>CAST(declared_overs AS DOUBLE)*1.1
      ORDER BY max_over_number-declared_overs DESC, match_id LIMIT 10""", big="max_over_number actual_overs_count", dbl="declared_overs"),
    "q13_overs_exceeded_count": _shape(f"SELECT count(*) AS matches_exceeded FROM ({_MATCH_OVERS}) x WHERE declared_overs IS NOT NULL AND match_type IN {_LIMITED} AND max_over_number>CAST(declared_overs AS DOUBLE)*1.1", big="matches_exceeded"),
    "q14_over_length_dist": _shape("SELECT num_deliveries, count(*) AS over_count, CAST(count(*) AS DOUBLE)*100/(SELECT count(*) FROM o) AS percentage FROM o GROUP BY 1", big="num_deliveries over_count", dbl="percentage"),
    "q15_batter_run_dist": _shape("SELECT batter_runs, count(*) AS frequency FROM d GROUP BY 1", big="batter_runs frequency"),
    "q16_run_outliers": _named(f"SELECT {_BALL} FROM nd WHERE batter_runs>6 ORDER BY batter_runs DESC, delivery_id LIMIT 100", big="batter_runs extras total_runs"),
    "q17_extras_dist": _shape("SELECT extras_type, count(*) AS frequency, avg(extras_value) AS avg_value, max(extras_value) AS max_value FROM d WHERE extras>0 GROUP BY 1", big="frequency max_value", dbl="avg_value"),
    "q18_high_totals": _named(f"SELECT {_BALL} FROM nd WHERE total_runs>7 ORDER BY total_runs DESC, delivery_id LIMIT 100", big="batter_runs extras total_runs"),
    "q19_over_length_by_type": _shape("SELECT match_type, avg(num_deliveries) AS avg_deliveries_per_over, min(num_deliveries) AS min_deliveries, max(num_deliveries) AS max_deliveries, count(*) AS over_count FROM o JOIN i ON i.innings_id=o.innings_id JOIN m ON m.match_id=i.match_id GROUP BY 1", dbl="avg_deliveries_per_over", big="min_deliveries max_deliveries over_count"),
    "q20_long_overs": _shape("SELECT over_id, m.match_id, match_type, batting_team, bowling_team, over_number, num_deliveries, total_runs, wickets FROM o JOIN i ON i.innings_id=o.innings_id JOIN m ON m.match_id=i.match_id WHERE num_deliveries>8 ORDER BY num_deliveries DESC, over_id LIMIT 100", big="over_number num_deliveries total_runs wickets"),
    "q21_over_length_factors": _shape("""SELECT num_deliveries, count(*) AS over_count, avg(e) AS avg_extras, avg(w) AS avg_wickets, avg(r) AS avg_runs FROM (SELECT o.over_id, o.num_deliveries, count(CASE WHEN d.extras>0 THEN 1 END) AS e, count(CASE WHEN d.is_wicket THEN 1 END) AS w, sum(d.total_runs) AS r
      FROM o JOIN d ON d.over_id=o.over_id GROUP BY 1,2) x GROUP BY 1""", big="num_deliveries over_count", dbl="avg_extras avg_wickets avg_runs"),
    "q22_names_seen": _named(_SEEN_ALL),
    "q22_names_seen_reduced": _named(_SEEN),
    "q23_player_id_issues": _named(_issues(_SEEN_ALL), big="id_count"),
    "q23_player_id_issues_reduced": _named(_issues(_SEEN), big="id_count"),
    "q24_multiple_ids": _named(f"SELECT s.player_name, id_count, (SELECT string_agg(player_id, ', ' ORDER BY player_id) FROM np WHERE np.player_name=s.player_name) AS player_ids FROM ({_issues(_SEEN_ALL)}) s WHERE id_count>1", big="id_count"),
    "q25_missing_id_matches": _named(f"SELECT player_name, greatest((SELECT count(DISTINCT match_id) FROM nd WHERE batter=s.player_name), (SELECT count(DISTINCT match_id) FROM nd WHERE bowler=s.player_name)) AS matches_played FROM ({_issues(_SEEN_ALL)}) s WHERE id_count=0", big="matches_played"),
    "q26_ids_with_many_names": _named(_MANY, big="name_count"),
    "q27_name_variant_counts": _named(f"SELECT player_id, player_name, count(*) AS occurrence_count FROM ({_PAIRS}) x WHERE player_id IN (SELECT player_id FROM ({_MANY}) z) GROUP BY 1,2", big="occurrence_count"),
    "q28_player_consistency": _named(f"""SELECT 'total_unique_players' AS key, CAST((SELECT count(DISTINCT player_name) FROM ({_SEEN_ALL}) s) AS DOUBLE) AS value UNION ALL SELECT 'total_players_with_ids', (SELECT count(DISTINCT player_name) FROM np)
      UNION ALL SELECT 'players_missing_ids', (SELECT count(*) FROM ({_issues(_SEEN_ALL)}) s WHERE id_count=0) UNION ALL SELECT 'players_with_multiple_ids', (SELECT count(*) FROM ({_issues(_SEEN_ALL)}) s WHERE id_count>1)
      UNION ALL SELECT 'ids_with_multiple_names', 0 UNION ALL SELECT 'missing_ids_pct', (SELECT CAST(count(*) AS DOUBLE)*100 FROM ({_issues(_SEEN_ALL)}) s WHERE id_count=0)/(SELECT count(DISTINCT player_name) FROM ({_SEEN_ALL}) s)
      UNION ALL SELECT 'multiple_ids_pct', (SELECT CAST(count(*) AS DOUBLE)*100 FROM ({_issues(_SEEN_ALL)}) s WHERE id_count>1)/(SELECT count(DISTINCT player_name) FROM ({_SEEN_ALL}) s)""", dbl="value"),
    "q28_reduced_consistency": _named(f"""SELECT 'players_missing_ids' AS key, (SELECT count(*) FROM ({_SEEN}) s WHERE player_name NOT IN (SELECT player_name FROM np)) AS value
      UNION ALL SELECT 'players_with_multiple_ids', (SELECT count(*) FROM (SELECT player_name FROM np GROUP BY 1 HAVING count(DISTINCT player_id)>1) z) UNION ALL SELECT 'synthetic_player_ids', (SELECT count(*) FROM np WHERE starts_with(player_id,'SYNTH_'))""", big="value"),
    "q29_text_health": _shape(_HEALTH, ctes="", big="values", dbl="percentage"),
    "q30_text_health_issues": _shape(f"SELECT \"table\", \"column\", count(*) AS classes FROM ({_HEALTH}) z GROUP BY 1,2 HAVING count(*)>1", ctes="", big="classes"),
    "q31_summary": _shape(" UNION ALL ".join(f"SELECT 'rows' AS section, '{t}' AS key, CAST(count(*) AS VARCHAR) AS value FROM {s}" for t, s in _SOURCES.items())
      + " UNION ALL SELECT 'match_types', match_type, CAST(count(*) AS VARCHAR) FROM m GROUP BY 2 UNION ALL SELECT 'date_range', 'earliest', CAST(min(date) AS VARCHAR) FROM m UNION ALL SELECT 'date_range', 'latest', CAST(max(date) AS VARCHAR) FROM m"),
}

# ---------------------------------------------------------------- sinks

_BALL_WHOLE = "over_number ball_number batter_runs extras total_runs extras_value"
_INNINGS_TYPES = {"big": "innings_number", "dbl": "powerplay_start_over powerplay_end_over"}
_S = {
    "s04_write_replace": _shape("SELECT * FROM i", **_INNINGS_TYPES),
    "s05_write_if_absent": _shape("SELECT * FROM i", **_INNINGS_TYPES),
    "s06_layout": _shape("SELECT d.*, m.match_type, m.date FROM d JOIN m ON m.match_id=d.match_id", big=_BALL_WHOLE, txt="date"),
    "s06_bucketed_join": _shape("SELECT d.*, innings_number, batting_team, bowling_team, powerplay_start_over, powerplay_end_over, 0 AS shuffles FROM d JOIN i ON i.innings_id=d.innings_id", big=_BALL_WHOLE + " innings_number shuffles", dbl="powerplay_start_over powerplay_end_over"),
    "s07_csv": _shape("SELECT * FROM o", big="over_number total_runs wickets num_deliveries total_extras"),
    "s07_metadata_csv": _docs("SELECT * FROM meta", big=_META_WHOLE),
    "s07_similar_venues_csv": _docs(_similar("meta", "venue", 0.85, True), dbl="similarity"),
    "s07_issues_csv": _docs("SELECT * FROM meta WHERE total_deliveries<10 OR team1_players<11 OR team2_players<11 OR registry_count<22", big=_META_WHOLE),
}

_M["m21_null_profile"] = _shape(_nulls("mart", "player_match_stats", MART_COLUMNS), extra=_mart(True), big="null_count total_rows", dbl="null_percentage")
_S["m23_mart_layout"] = _mart_query(MART_COLUMNS)

_TYPES = {
    "deliveries": {"over_number": "int", "ball_number": "int", "batter_runs": "int", "extras": "int", "total_runs": "int", "extras_value": "int", "is_wicket": "boolean"},
    "matches": {"date": "date", "overs": "decimal(4,1)", "outcome_by_runs": "int", "outcome_by_wickets": "int"},
    "innings": {"innings_number": "int", "powerplay_start_over": "double", "powerplay_end_over": "double"},
    "overs": {"over_number": "int", "total_runs": "bigint", "wickets": "bigint", "num_deliveries": "bigint", "total_extras": "bigint"},
    "players": {},
}
_LISTING = ", ".join(
    f"('{t}',{at},'{c}','{_TYPES[t].get(c, 'string')}')" for t, cs in _COLUMNS.items() for at, c in enumerate(cs, 1)
)
_S["s10_catalog_schema"] = _shape(
    f'SELECT v."table", v.position, v."column", v.type, r.n AS rows FROM (VALUES {_LISTING}) v("table", position, "column", type) JOIN ({_ROWS}) r ON r."table"=v."table"',
    big="position rows",
)


_P["p09_describe_all"] = _docs(_describe_all(), big='"count" "unique" freq', dbl="mean std min max")
_AFTER = {(t, c): kind for t, c, _, kind in _CHANGED}
_DIFF = ", ".join(
    f"('{t}','{c}','{a}','{b}',{str(a != b).lower()})"
    for t, cs in _COLUMNS.items() for c in cs for a in [_TYPES[t].get(c, "string")] for b in [_AFTER.get((t, c), a)]
)
_REPORTED = " UNION ALL ".join(_ranges(t, c, _AFTER.get((t, c), "")) for t, cs in RANGES.items() for c in cs)
_Q["q04_schema_diff"] = _shape(
    f'SELECT v."table", v."column", type_before, type_after, changed, min_value, max_value FROM (VALUES {_DIFF}) v("table", "column", type_before, type_after, changed)'
    f' LEFT JOIN ({_REPORTED}) r ON r."table"=v."table" AND r."column"=v."column"'
)
#: Types of the mart's columns as they come from the flat tables.
_MART_TYPES = {
    **dict.fromkeys(_MART_WHOLE, "bigint"), **dict.fromkeys(_MART_RATIOS, "double"), "date": "date",
    **dict.fromkeys(("is_player_of_match", "is_half_century", "is_century", "is_five_wicket_haul"), "boolean"),
    **dict.fromkeys(("was_dismissed", "batting_position", "batting_order_position"), "int"),
}
_MART_LISTING = ", ".join(f"({at},'{c}','{_MART_TYPES.get(c, 'string')}')" for at, c in enumerate(MART_COLUMNS, 1))
_M["m21_columns"] = _shape(
    f'SELECT \'player_match_stats\' AS "table", v.position, v."column", v.type, (SELECT count(*) FROM mart) AS rows FROM (VALUES {_MART_LISTING}) v(position, "column", type)',
    extra=_mart(True), big="position rows",
)




def _section(name: str, sql: str, key: str, *values: str, where: str = "") -> list[str]:
    """One section of a report from the SQL form of the result it shows."""
    label = lambda v: f"concat_ws('.', {key}, '{v}')" if key else f"'{v}'"
    return [f"SELECT '{name}' AS section, {label(v)} AS key, CAST({v} AS VARCHAR) AS value FROM ({sql}) r {where}" for v in values]


_AT = '"table", "column"'
_TEXT_VALUES = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", 'ascii' AS class, count({c}) AS values, 100.0 AS percentage FROM {_SOURCES[t]}"
    for t, cs in _COLUMNS.items() for c in cs if c not in _TYPES[t]
)
_REPORT = " UNION ALL ".join([
    *_section("tables", _Q["q01_table_shape"], '"table"', "rows", "columns"),
    *_section("ranges", _Q["q02_column_ranges"], _AT, "min_value", "max_value"),
    *_section("nulls", _Q["q07_null_profile"], _AT, "null_count", "null_percentage", where="WHERE null_count>0"),
    f"SELECT 'conversions', 'type_conversions', CAST(count(*) FILTER (changed) AS VARCHAR) FROM ({_Q['q04_schema_diff']}) r",
    *_section("storage", _Q["q06_storage_estimate"], '"table"', "bytes_before", "bytes_after", "savings_pct"),
    *_section("validation", _Q["q10_invalid_runs_count"], "", "count_invalid"),
    *_section("validation", _Q["q11_seven_run_share"], "", "count_7_runs", "total_deliveries", "percentage"),
    *_section("validation", _Q["q13_overs_exceeded_count"], "", "matches_exceeded"),
    *_section("over_lengths", _Q["q14_over_length_dist"], "num_deliveries", "over_count", "percentage"),
    *_section("players", _Q["q28_reduced_consistency"], "key", "value"),
    *_section("text", _shape(_TEXT_VALUES), f"{_AT}, class", "values", "percentage", where="WHERE values>0"),
    f"SELECT * FROM ({_Q['q31_summary']}) r",
])
_S["s08_report"] = f"SELECT section, key, round(TRY_CAST(value AS DOUBLE), 6) AS number, CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN value END AS text FROM ({_REPORT}) z"


def oracles() -> dict[str, str]:
    return {**_F, **_L, **_M, **_U, **_P, **_Q, **_S}
