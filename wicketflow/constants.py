"""Fixed values of the match domain and of the stored tables."""

# Dismissal kinds credited to the bowler.
CREDITED_KINDS = ("bowled", "caught", "lbw", "stumped", "hit wicket")

# Extras kinds counted per over.
EXTRAS_KINDS = ("wides", "noballs", "byes", "legbyes")

# Match types that belong to each format.
FORMATS = {"test": ("Test",), "odi": ("ODI",), "t20": ("T20", "IT20")}

# Match types with a limited number of overs.
LIMITED_OVERS_TYPES = ("ODI", "T20", "IT20", "ODM", "T20M")

# Id columns of the roles a player can have on a delivery.
FIELD_ROLES = ("batter_id", "bowler_id", "non_striker_id")
ALL_ROLES = FIELD_ROLES + ("wicket_player_out_id", "wicket_fielder_id")

# Name columns of the same roles.
FULL_NAME_ROLES = ("batter", "bowler", "non_striker", "wicket_player_out", "wicket_fielder")
REDUCED_NAME_ROLES = ("batter", "bowler", "non_striker", "wicket_player_out")

# First number of the ids made for players without one.
SYNTHETIC_PREFIX = "SYNTH_"
SYNTHETIC_START = 1000000

# Column types of the stored tables after retyping.
RETYPE_SPEC = {
    "deliveries": {
        "over_number": "smallint",
        "ball_number": "tinyint",
        "batter_runs": "tinyint",
        "extras": "tinyint",
        "total_runs": "tinyint",
        "extras_value": "tinyint",
        "is_wicket": "boolean",
    },
    "innings": {"innings_number": "tinyint"},
    "matches": {
        "date": "date",
        "overs": "decimal(4,1)",
        "outcome_by_runs": "smallint",
        "outcome_by_wickets": "tinyint",
    },
    "overs": {
        "over_number": "smallint",
        "total_runs": "tinyint",
        "wickets": "tinyint",
        "num_deliveries": "tinyint",
    },
}

# Keys by which a value of a table is found again.
TABLE_KEYS = {
    "deliveries": ("delivery_id",), "innings": ("innings_id",), "matches": ("match_id",), "overs": ("over_id",),
}

# Columns whose smallest and largest value are reported.
RANGE_SPEC = {
    "deliveries": (
        "over_number", "ball_number", "batter_runs", "extras",
        "total_runs", "extras_value", "is_wicket",
    ),
    "innings": ("innings_number",),
    "matches": ("date", "overs", "outcome_by_runs", "outcome_by_wickets"),
    "overs": ("over_number", "total_runs", "wickets", "num_deliveries"),
}

# Assumed bytes per stored value by type name.
TYPE_BYTES = {
    "string": 16,
    "bigint": 8,
    "double": 8,
    "tinyint": 1,
    "smallint": 2,
    "boolean": 1,
    "date": 4,
    "decimal(4,1)": 4,
}
DEFAULT_TYPE_BYTES = 8

# Names of the stored tables.
TABLES = ("matches", "players", "innings", "overs", "deliveries")
