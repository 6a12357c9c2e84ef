"""Match documents to the tables ``matches``, ``innings``, ``overs`` and ``deliveries``.

Each table is a projection of the nested rows: no shuffle is needed, totals of an over are
computed inside its array of deliveries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketflow.constants import EXTRAS_KINDS
from wicketflow.functions.columns import ident
from wicketflow.operators.identity import GAPS, registered, with_gaps


def event_part(name: str) -> Column:
    """Part of ``info.event``, which is an object or, giving only the name, a bare string."""
    event = F.col("info.event")
    is_object = F.ltrim(event).startswith("{")
    part = F.when(is_object, F.get_json_object(event, f"$.{name}"))
    return part.otherwise(event) if name == "name" else part


def first_date() -> Column:
    return F.get("info.dates", F.lit(0))


def parsed_date(text: Column) -> Column:
    """The date, or NULL when the text is not one."""
    return F.try_to_date(text, "yyyy-M-d")


def _ids() -> Column:
    """All names of a document that have an id, from its registry or among the gaps; no name is in both."""
    return F.map_concat(registered(), F.coalesce(GAPS, F.create_map().cast("map<string,string>")))


def _id_of(name: Column) -> Column:
    return F.when(F.length(name) > 0, F.try_element_at("ids", name))


def matches(docs: DataFrame, gaps: DataFrame) -> DataFrame:
    """One row per document. ``date_raw`` keeps the text of a date that does not parse."""
    info = lambda name: F.col(f"info.{name}")
    first = lambda name, k=0: F.get(f"info.{name}", F.lit(k))
    pom = first("player_of_match")
    return with_gaps(docs, gaps).withColumn("ids", _ids()).select(
        "match_id",
        parsed_date(first_date()).alias("date"),
        info("city"), info("venue"), info("match_type"), info("gender"), info("season"),
        event_part("name").alias("match_event_name"),
        event_part("group").alias("match_event_id"),
        event_part("match_number").try_cast("int").alias("match_number"),
        info("overs"),
        first("teams").alias("team1"),
        first("teams", 1).alias("team2"),
        info("toss.winner").alias("toss_winner"),
        info("toss.decision").alias("toss_decision"),
        info("outcome.winner").alias("outcome_winner"),
        info("outcome.by.runs").alias("outcome_by_runs"),
        info("outcome.by.wickets").alias("outcome_by_wickets"),
        info("outcome.method").alias("outcome_method"),
        pom.alias("player_of_match"),
        _id_of(pom).alias("player_of_match_id"),
        first_date().alias("date_raw"),
    )


def innings(docs: DataFrame) -> DataFrame:
    """One row per innings; the last mandatory powerplay counts."""
    teams = F.col("info.teams")
    rows = docs.select("match_id", "info", F.posexplode("innings").alias("at", "inning"))
    batting = F.col("inning.team")
    mandatory = F.try_element_at(
        F.filter("inning.powerplays", lambda p: p["type"] == "mandatory"), F.lit(-1)
    )
    others = F.filter(teams, lambda t: t != batting)
    return rows.select(
        ident(F.col("match_id"), F.col("at") + 1).alias("innings_id"),
        "match_id",
        (F.col("at") + 1).alias("innings_number"),
        batting.alias("batting_team"),
        F.when(F.array_contains(teams, batting), F.get(others, F.lit(0))).alias("bowling_team"),
        mandatory["from"].alias("powerplay_start_over"),
        mandatory["to"].alias("powerplay_end_over"),
    )


def _over_rows(docs: DataFrame) -> DataFrame:
    per_innings = docs.select("match_id", F.posexplode("innings").alias("at", "inning"))
    per_over = per_innings.select(
        ident(F.col("match_id"), F.col("at") + 1).alias("innings_id"), F.explode("inning.overs").alias("o")
    )
    return per_over.select(
        "innings_id",
        ident(F.col("innings_id"), F.col("o.over")).alias("over_id"),
        F.col("o.over").alias("over_number"),
        F.col("o.deliveries").alias("balls"),
    )


def _sum(balls: Column, value) -> Column:
    values = F.transform(balls, lambda b: F.coalesce(value(b).cast("bigint"), F.lit(0).cast("bigint")))
    return F.coalesce(
        F.aggregate(values, F.lit(0).cast("bigint"), lambda total, v: total + v), F.lit(0).cast("bigint")
    )


def overs(docs: DataFrame) -> DataFrame:
    """One row per over with its totals. ``wickets`` counts deliveries with a wicket."""
    balls = F.col("balls")
    with_extras = F.filter(balls, lambda b: b["extras"].isNotNull())
    size = lambda items: F.coalesce(F.when(items.isNotNull(), F.size(items)), F.lit(0))
    return _over_rows(docs).select(
        "over_id", "innings_id", "over_number",
        _sum(balls, lambda b: b["runs"]["total"]).alias("total_runs"),
        size(F.filter(balls, lambda b: b["wickets"].isNotNull())).alias("wickets"),
        size(balls).alias("num_deliveries"),
        _sum(with_extras, lambda b: b["runs"]["extras"]).alias("total_extras"),
        *[
            _sum(balls, lambda b, k=kind: F.try_element_at(b["extras"], F.lit(k))).alias(f"extras_{kind}")
            for kind in EXTRAS_KINDS
        ],
    )


def _ball(b: Column) -> Column:
    """One ball as the row it becomes, ids included."""
    number = lambda c: F.coalesce(c, F.lit(0))
    wicket = F.get(b["wickets"], F.lit(0))
    fielder = F.get(wicket["fielders"], F.lit(0))["name"]
    person = lambda c, name: (c.alias(name), _id_of(c).alias(f"{name}_id"))
    return F.struct(
        *person(b["batter"], "batter"), *person(b["bowler"], "bowler"), *person(b["non_striker"], "non_striker"),
        number(b["runs"]["batter"]).alias("batter_runs"),
        number(b["runs"]["extras"]).alias("extras"),
        number(b["runs"]["total"]).alias("total_runs"),
        F.get(F.map_keys(b["extras"]), F.lit(0)).alias("extras_type"),
        number(F.get(F.map_values(b["extras"]), F.lit(0))).alias("extras_value"),
        b["wickets"].isNotNull().cast("int").alias("is_wicket"),
        *person(wicket["player_out"], "wicket_player_out"),
        wicket["kind"].alias("wicket_kind"),
        *person(fielder, "wicket_fielder"),
    )


def deliveries(docs: DataFrame, gaps: DataFrame) -> DataFrame:
    """One row per ball. The first kind of extras and the first wicket of a ball are kept.

    Balls are finished inside their document, where its names are at hand; what is exploded then carries
    neither the registry nor the gaps.
    """
    finished = F.transform(
        "innings",
        lambda i: F.transform(i["overs"], lambda o: F.struct(o["over"].alias("over"), F.transform(o["deliveries"], _ball).alias("balls"))),
    )
    nested = with_gaps(docs, gaps).select("match_id", "innings", _ids().alias("ids")).select("match_id", finished.alias("innings"))
    # The outer form: the other one filters on the size first and so finishes all balls twice.
    per_innings = nested.select("match_id", F.posexplode_outer("innings").alias("at", "overs"))
    per_over = per_innings.select("match_id", ident(F.col("match_id"), F.col("at") + 1).alias("innings_id"), F.explode("overs").alias("o"))
    per_ball = per_over.select(
        "match_id", "innings_id", ident(F.col("innings_id"), F.col("o.over")).alias("over_id"),
        F.col("o.over").alias("over_number"), F.posexplode("o.balls").alias("at", "b"),
    )
    return per_ball.select(
        ident(F.col("over_id"), F.col("at") + 1).alias("delivery_id"),
        "over_id", "innings_id", "match_id", "over_number",
        (F.col("at") + 1).alias("ball_number"), "b.*",
    )
