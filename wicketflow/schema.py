"""Schema of a match document."""

from pyspark.sql import types as T

_STRINGS = "array<string>"

DOCUMENT_DDL = f"""
    meta struct<data_version:string, created:string, revision:int>,
    info struct<
        match_type:string, match_type_number:int, gender:string, season:string,
        city:string, venue:string, team_type:string, overs:int, balls_per_over:int,
        teams:{_STRINGS}, dates:{_STRINGS}, player_of_match:{_STRINGS}, missing:{_STRINGS},
        event:string,
        officials:struct<umpires:{_STRINGS}, referees:{_STRINGS}>,
        toss:struct<winner:string, decision:string>,
        outcome:struct<winner:string, result:string, method:string,
                       by:struct<runs:int, wickets:int>>,
        players:map<string,{_STRINGS}>,
        registry:struct<people:map<string,string>>>,
    innings array<struct<
        team:string,
        powerplays:array<struct<type:string, `from`:double, `to`:double>>,
        overs:array<struct<
            over:int,
            deliveries:array<struct<
                batter:string, bowler:string, non_striker:string,
                runs:struct<batter:int, extras:int, total:int>,
                extras:map<string,int>,
                wickets:array<struct<
                    player_out:string, kind:string,
                    fielders:array<struct<name:string>>>>>>>>>>
"""

def document_schema() -> T.StructType:
    """The parsed schema; needs an active session."""
    return T.StructType.fromDDL(DOCUMENT_DDL)
