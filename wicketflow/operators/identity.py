"""Player ids and names.

One pass over the documents writes a ledger: per match every name with its id in the registry of that
match, or none, and how often the match uses it. The rows are made inside the document, without a
shuffle. All that is asked about names comes from the ledger, which has some thirty rows a match: the
ids of names missing in a registry, the numbers of names missing in all, the players.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.constants import SYNTHETIC_PREFIX, SYNTHETIC_START
from wicketflow.functions.columns import flag, total

GAPS = "gap_ids"

# Hex digits of the name digest that make a bucket: at most 4096 buckets.
_BUCKET_DIGITS = 3


def registered() -> Column:
    """The registry of a document: name to id, entries without an id left out."""
    people = F.map_filter("info.registry.people", lambda name, pid: pid.isNotNull())
    return F.coalesce(people, F.create_map().cast("map<string,string>"))


def _names_used() -> Column:
    """All names a document uses, with repeats, sorted: player of the match and every role of every ball."""
    balls = F.flatten(
        F.transform(
            F.coalesce(F.flatten(F.transform("innings", lambda i: F.coalesce(i["overs"], F.array()))), F.array()),
            lambda o: F.coalesce(o["deliveries"], F.array()),
        )
    )
    named = lambda b: F.array(
        b["batter"], b["bowler"], b["non_striker"],
        F.get(b["wickets"], F.lit(0))["player_out"],
        F.get(F.get(b["wickets"], F.lit(0))["fielders"], F.lit(0))["name"],
    )
    pom = F.array(F.get("info.player_of_match", F.lit(0)))
    every = F.concat(pom, F.coalesce(F.flatten(F.transform(balls, named)), F.array()))
    return F.sort_array(F.filter(every, lambda n: F.length(n) > 0))


def ledger(docs: DataFrame) -> DataFrame:
    """``match_id, date, name, player_id, times``: the registry entries and the names used of each match.

    ``player_id`` is NULL where the registry has no id, ``times`` 0 where the match does not use the name.
    """
    date = F.try_to_date(F.get("info.dates", F.lit(0)), "yyyy-M-d")
    rows = docs.select("match_id", date.alias("date"), registered().alias("people"), _names_used().alias("names"))
    rows = rows.withColumn("used", F.array_distinct("names"))
    # The names are sorted: those equal to one end where the next one starts.
    starts = lambda name: F.coalesce(F.array_position("names", name), F.size("names").cast("bigint") + 1)
    used = F.transform(
        "used",
        lambda n, k: F.struct(
            n.alias("name"), F.try_element_at("people", n).alias("player_id"),
            (starts(F.get("used", k + 1)) - starts(n)).alias("times"),
        ),
    )
    others = F.transform(
        F.array_except(F.map_keys("people"), F.col("used")),
        lambda n: F.struct(n.alias("name"), F.try_element_at("people", n).alias("player_id"), F.lit(0).cast("bigint").alias("times")),
    )
    # The outer form: the other one filters on the size first and so computes the entries twice.
    return rows.select("match_id", "date", F.inline_outer(F.concat(used, others))).where("name IS NOT NULL")


def spellings(names: DataFrame) -> DataFrame:
    """A ledger added up by name and id: ``name, player_id, times, entries, last``.

    ``entries`` counts the registries, ``last`` is the latest date and match. Names without an id in
    their match are one row of a name, next to its ids from other matches.
    """
    return names.groupBy("name", "player_id").agg(
        F.sum("times").alias("times"), F.count("player_id").alias("entries"), F.max(F.struct("date", "match_id")).alias("last")
    )


def number_names(names: DataFrame) -> DataFrame:
    """Synthetic ids for distinct names, numbered in the order of their digest; a name with a ``known`` id keeps that.

    The digest spreads the names evenly over 4096 buckets, so numbers are given inside a bucket
    and shifted by the size of the buckets before it. The only window over everything sees
    those 4096 counts.
    """
    known = F.col("known") if "known" in names.columns else F.lit(None).cast("string")
    hashed = names.select("name", known.alias("known"), F.md5("name").alias("digest")).withColumn(
        "bucket", F.substring("digest", 1, _BUCKET_DIGITS)
    )
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("bucket").agg(F.count_if(F.col("known").isNull()).alias("names"))
        .select("bucket", F.coalesce(F.sum("names").over(earlier), F.lit(0)).alias("offset"))
    )
    unnumbered = F.col("known").isNull()
    inside = F.row_number().over(Window.partitionBy("bucket", unnumbered).orderBy("digest", "name"))
    number = F.lit(SYNTHETIC_START - 1) + F.col("offset") + F.col("at")
    return (
        hashed.select("name", "known", "bucket", inside.alias("at"))
        .join(offsets, "bucket")
        .select("name", F.coalesce("known", F.concat(F.lit(SYNTHETIC_PREFIX), number.cast("string"))).alias("player_id"))
    )


def resolved_names(counted: DataFrame) -> DataFrame:
    """Ids of the names that some match uses without an id: ``name, player_id``.

    Such a name has the id of its latest registry entry anywhere, or else a number. ``counted`` is a
    result of :func:`spellings`; one aggregation tells the two kinds apart.
    """
    has_id = F.col("player_id").isNotNull()
    told = counted.groupBy("name").agg(
        F.max(F.when(has_id, F.struct("last", "player_id")))["player_id"].alias("known"), F.bool_or(~has_id).alias("missing")
    )
    return number_names(told.where("missing"))


def resolve_gaps(names: DataFrame, resolved: DataFrame) -> DataFrame:
    """The names of a ledger that have no id in their match, with the one found: ``match_id, name, player_id``."""
    missing = names.where("player_id IS NULL").select("match_id", "name")
    return missing.join(resolved, "name").select("match_id", "name", "player_id")


def gap_maps(gaps: DataFrame) -> DataFrame:
    """One map of name to id per match that has gaps; its size is bounded by the document's."""
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "player_id"))))
    return gaps.groupBy("match_id").agg(entries.alias(GAPS))


def with_gaps(docs: DataFrame, gaps: DataFrame) -> DataFrame:
    """Documents with the ids of their unregistered names.

    Given a stored table of gaps, the planner knows its size: it sends a small one to every
    executor and shuffles on ``match_id`` otherwise.
    """
    return docs.join(gaps, "match_id", "left")


def player_names(names: DataFrame, resolved: DataFrame) -> DataFrame:
    """Every name of every match with its id, its own or the one found: ``match_id, name, player_id``."""
    listed = names.where("player_id IS NOT NULL").select("match_id", "name", "player_id")
    return listed.unionByName(resolve_gaps(names, resolved))


def resolve_ids(df: DataFrame, names: DataFrame, roles: tuple[str, ...] = ("name",)) -> DataFrame:
    """The ids of the names in the columns ``roles``, in long form: the other columns, ``role, name, player_id``.

    The names of a match are one map, so a row of ``df`` meets them once, before its roles become rows; a row
    without a name in a role gives none.
    """
    others = [c for c in df.columns if c not in roles]
    # A list for each name: a name with several ids gives several rows, as a join would.
    found = names.where("match_id IS NOT NULL AND name IS NOT NULL").groupBy("match_id", "name").agg(
        F.collect_list(F.struct("player_id")).alias("found")
    )
    known = found.groupBy("match_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "found"))).alias("known"))
    look_up = [
        F.struct(F.lit(r).alias("role"), F.col(r).alias("name"), F.try_element_at("known", F.col(r)).alias("found")) for r in roles
    ]
    named = F.filter(F.array(*look_up), lambda x: x["name"].isNotNull())
    long = df.join(known, "match_id", "left").select(*others, F.explode(named).alias("at"))
    each = long.select(*others, "at.role", "at.name", F.explode_outer("at.found").alias("one"))
    return each.select("match_id", "name", *[c for c in others if c != "match_id"], "role", F.col("one.player_id").alias("player_id"))


def players(counted: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row per player id with the most frequent name first and the other spellings joined.

    Appearances in deliveries and as player of the match count, and so does each registry
    entry. Equal counts are ordered by name. ``counted`` is a result of :func:`spellings`.
    """
    found = resolved.withColumnRenamed("player_id", "found")
    counts = (
        counted.join(found, "name", "left")
        .groupBy(F.coalesce("player_id", "found").alias("player_id"), "name")
        .agg(F.sum(F.col("times") + F.col("entries")).alias("times"))
    )
    ranked = F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("times")).alias("rank"), F.col("name").alias("name")))),
        lambda x: x["name"],
    )
    others = F.slice("names", 2, F.greatest(F.size("names") - 1, F.lit(1)))
    return counts.groupBy("player_id").agg(ranked.alias("names")).select(
        "player_id",
        F.get("names", F.lit(0)).alias("player_name"),
        F.when(F.size("names") > 1, F.array_join(others, ";")).alias("name_variations"),
        F.size("names").alias("variant_count"),
    )


def player_variant_stats(players: DataFrame) -> DataFrame:
    """Players with more than one spelling, and the largest number of spellings."""
    several = F.col("variant_count") > 1
    return players.agg(
        total(flag(several)).alias("players_with_variants"),
        F.max(F.when(several, F.col("variant_count"))).alias("max_variants"),
    )


def synthetic_count(players: DataFrame) -> DataFrame:
    is_synthetic = F.col("player_id").startswith(SYNTHETIC_PREFIX)
    return players.agg(total(flag(is_synthetic)).alias("synthetic_ids"))
