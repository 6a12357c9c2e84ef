"""Consistency of player names and ids, and health of text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wicketflow.constants import FULL_NAME_ROLES, REDUCED_NAME_ROLES, SYNTHETIC_PREFIX
from wicketflow.functions.columns import flag, percent, total
from wicketflow.operators.summaries import union_all

# Roles whose missing names are part of the full listing.
_ALWAYS_NAMED = ("batter", "bowler", "non_striker")


def player_names_seen(deliveries: DataFrame, roles=FULL_NAME_ROLES, keep_missing: bool = True) -> DataFrame:
    """Distinct names in any role. ``keep_missing`` lists a missing batter, bowler or partner too."""
    entries = F.inline(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("player_name")) for r in roles]))
    named = F.col("player_name").isNotNull()
    wanted = named | F.col("role").isin(*_ALWAYS_NAMED) if keep_missing else named
    return deliveries.select(entries).where(wanted).select("player_name").distinct()


def reduced_names_seen(deliveries: DataFrame) -> DataFrame:
    return player_names_seen(deliveries, REDUCED_NAME_ROLES, keep_missing=False)


def person_table(deliveries: DataFrame, players: DataFrame) -> DataFrame:
    """One row per name and one per id, from one scan of the balls and one of the players.

    ``kind`` (name or id), ``key``; for a name whether it is in the full and in the reduced listing and in how
    many matches it batted and bowled; ``rows`` of ``players`` with it; ``others``, the ids of a name or the
    names of an id there, sorted. All numbers about names and ids are filters on this table.
    """
    entries = F.inline(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("name")) for r in FULL_NAME_ROLES]))
    named, role = F.col("name").isNotNull(), F.col("role")
    # One row per match and name first: a ball names five people, a match some thirty.
    seen = deliveries.select("match_id", entries).groupBy("match_id", "name").agg(
        F.bool_or(named | role.isin(*_ALWAYS_NAMED)).alias("full"),
        F.bool_or(named & role.isin(*REDUCED_NAME_ROLES)).alias("reduced"),
        F.bool_or(named & (role == "batter")).alias("batted"), F.bool_or(named & (role == "bowler")).alias("bowled"),
    )
    no = F.lit(False)
    seen = seen.select(
        F.lit("name").alias("kind"), F.col("name").alias("key"), "full", "reduced", "batted", "bowled", no.alias("listed"), F.lit(None).cast("string").alias("other")
    )
    flags = [no.alias(c) for c in ("full", "reduced", "batted", "bowled")]
    sides = F.inline(
        F.array(
            F.struct(F.lit("name").alias("kind"), F.col("player_name").alias("key"), F.col("player_id").alias("other")),
            F.struct(F.lit("id").alias("kind"), F.col("player_id").alias("key"), F.col("player_name").alias("other")),
        )
    )
    listed = players.select(sides).select("kind", "key", *flags, F.lit(True).alias("listed"), "other")
    return seen.unionByName(listed).groupBy("kind", "key").agg(
        F.bool_or("full").alias("full"), F.bool_or("reduced").alias("reduced"),
        F.count_if("batted").alias("matches_batted"), F.count_if("bowled").alias("matches_bowled"),
        F.count_if("listed").alias("rows"), F.sort_array(F.collect_set("other")).alias("others"),
    )


def _id_count() -> Column:
    """Ids of a name; a missing name has none."""
    return F.when(F.col("key").isNull(), 0).otherwise(F.size("others"))


def _names(persons: DataFrame, listing: str) -> DataFrame:
    return persons.where((F.col("kind") == "name") & F.col(listing)).select(
        F.col("key").alias("player_name"), _id_count().alias("id_count"), "others", "matches_batted", "matches_bowled"
    )


def player_id_issues(persons: DataFrame, listing: str = "full") -> DataFrame:
    """Names of a listing (``full`` or ``reduced``) without an id or with more than one."""
    issues = _names(persons, listing).where(F.col("id_count") != 1)
    return issues.select("player_name", "id_count").orderBy(F.desc("id_count"), "player_name")


def _listed(values: Column) -> Column:
    return F.array_join(F.sort_array(F.collect_set(values)), ", ")


def multiple_ids(persons: DataFrame) -> DataFrame:
    """The ids of names that have several."""
    several = _names(persons, "full").where(F.col("id_count") > 1)
    return several.select("player_name", "id_count", F.array_join("others", ", ").alias("player_ids"))


def missing_id_matches(persons: DataFrame) -> DataFrame:
    """For names without an id, the larger of their matches as batter and as bowler."""
    missing = _names(persons, "full").where(F.col("id_count") == 0)
    return missing.select("player_name", F.greatest("matches_batted", "matches_bowled").alias("matches_played"))


def id_name_pairs(deliveries: DataFrame) -> DataFrame:
    """Id and name of every appearance, for the checks on names of one id."""
    entries = F.inline(
        F.array(
            *[F.struct(F.col(f"{r}_id").alias("player_id"), F.col(r).alias("player_name")) for r in FULL_NAME_ROLES]
        )
    )
    return deliveries.select(entries).where(F.col("player_id").isNotNull())


def ids_with_many_names(pairs: DataFrame) -> DataFrame:
    """Ids that go with more than one name. Takes ``players`` or the pairs of deliveries."""
    return (
        pairs.select("player_id", "player_name").distinct()
        .groupBy("player_id")
        .agg(F.count("player_name").alias("name_count"), _listed(F.col("player_name")).alias("names"))
        .where(F.col("name_count") > 1)
    )


def name_variant_counts(pairs: DataFrame) -> DataFrame:
    """How often each name of such an id occurs; pairs are counted before they are compared."""
    counts = pairs.groupBy("player_id", "player_name").agg(F.count("*").alias("occurrence_count"))
    names = F.count("player_name").over(Window.partitionBy("player_id"))
    return counts.withColumn("names", names).where(F.col("names") > 1).drop("names")


def _numbers(row: DataFrame) -> DataFrame:
    """The columns of a one-row result as ``key, value``."""
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in row.columns])))


def player_consistency(persons: DataFrame) -> DataFrame:
    """Overall numbers of the checks above: ``key, value``."""
    name, known = F.col("kind") == "name", F.col("key").isNotNull()
    full, ids = name & F.col("full"), _id_count()
    seen, missing, several = F.count_if(full & known), F.count_if(full & (ids == 0)), F.count_if(full & (ids > 1))
    numbers = {
        "total_unique_players": seen,
        "total_players_with_ids": F.count_if(name & known & (F.col("rows") > 0)),
        "players_missing_ids": missing,
        "players_with_multiple_ids": several,
        "ids_with_multiple_names": F.count_if(~name & (F.size("others") > 1)),
        "missing_ids_pct": percent(missing, seen),
        "multiple_ids_pct": percent(several, seen),
    }
    return _numbers(persons.agg(*[v.cast("double").alias(k) for k, v in numbers.items()]))


def reduced_consistency(persons: DataFrame) -> DataFrame:
    """Names without an id, names with several ids and synthetic ids: ``key, value``."""
    name = F.col("kind") == "name"
    synthetic = ~name & F.col("key").startswith(SYNTHETIC_PREFIX)
    numbers = {
        "players_missing_ids": F.count_if(name & F.col("reduced") & (F.size("others") == 0)),
        "players_with_multiple_ids": F.count_if(name & (F.size("others") > 1)),
        "synthetic_player_ids": F.coalesce(F.sum(F.when(synthetic, F.col("rows"))), F.lit(0)).cast("bigint"),
    }
    return _numbers(persons.agg(*[v.alias(k) for k, v in numbers.items()]))


# Classes of text, the first that fits is taken.
TEXT_CLASSES = ("invalid_utf8", "replacement_char", "mojibake", "non_ascii", "ascii")

# UTF-8 bytes read as Latin-1 or Windows-1252.
MOJIBAKE = "Ã[\u0080-¿]|Â[\u0080-¿]|â€"


def _text_class(c: Column) -> Column:
    return (
        F.when(~F.is_valid_utf8(c), "invalid_utf8")
        .when(F.instr(c, "�") > 0, "replacement_char")
        .when(c.rlike(MOJIBAKE), "mojibake")
        .when(c.rlike("[^\\x00-\\x7F]"), "non_ascii")
        .otherwise("ascii")
    )


def text_health(tables: dict[str, DataFrame]) -> DataFrame:
    """Class of the text in every string column: ``table, column, class, values, percentage``.

    All values are looked at, in one pass per table.
    """
    frames = []
    for name, df in tables.items():
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        if not columns:
            continue
        classed = df.select(*[F.when(F.col(c).isNotNull(), _text_class(F.col(c))).alias(f"c{k}") for k, c in enumerate(columns)])
        row = classed.agg(
            *[
                total(flag(F.col(f"c{k}") == cls)).alias(f"n{k}_{cls}")
                for k in range(len(columns))
                for cls in TEXT_CLASSES
            ],
            *[F.count(f"c{k}").alias(f"all{k}") for k in range(len(columns))],
        )
        entries = [
            F.struct(
                F.lit(name).alias("table"), F.lit(c).alias("column"), F.lit(cls).alias("class"),
                F.col(f"n{k}_{cls}").alias("values"),
                percent(F.col(f"n{k}_{cls}"), F.col(f"all{k}")).alias("percentage"),
            )
            for k, c in enumerate(columns)
            for cls in TEXT_CLASSES
        ]
        frames.append(row.select(F.inline(F.array(*entries))).where(F.col("values") > 0))
    return union_all(frames)


def text_health_issues(health: DataFrame) -> DataFrame:
    """Columns in which more than one class of text was found."""
    return (
        health.groupBy("table", "column").agg(F.count("*").alias("classes"))
        .where(F.col("classes") > 1)
    )
