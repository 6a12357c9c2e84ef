"""Profiling of raw match documents, before they are unnested."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from wicketflow.functions.columns import flag, percent, total
from wicketflow.operators.summaries import share_of, union_all, value_counts
from wicketflow.operators.unnest import event_part, first_date, parsed_date

LEVELS = ("top", "info", "innings", "over", "delivery")
_OBJECT, _LIST = "map<string,variant>", "array<variant>"


def _parsed(raw: DataFrame) -> DataFrame:
    """The texts as VARIANT, parsed once; NULL for a text that is not JSON.

    A filter on the result would be moved in front of the parse and so parse twice.
    """
    return raw.where(F.ltrim("raw").startswith("{")).select(F.try_parse_json("raw").alias("doc"))


def _part(value: Column, name: str, kind: str) -> Column:
    """A member of a JSON object, NULL where it is missing or of another kind."""
    return F.try_variant_get(value, f"$.{name}", kind)


def _walk(doc: Column, visit, levels=LEVELS) -> Column:
    """The lists that ``visit(level, object)`` gives for the objects of a document, one after the other.

    The objects stay inside the row: only what ``visit`` makes of them is written out.
    """
    here = lambda level, value: [visit(level, value.try_cast(_OBJECT))] if level in levels else []

    def inside(value, depth):
        """What the objects in the list below ``value`` give; lists and levels below a document."""
        name, level = (("innings", "innings"), ("overs", "over"), ("deliveries", "delivery"))[depth]
        deeper = any(x in levels for x in LEVELS[depth + 3:])

        def each(item):
            parts = [F.coalesce(x, none) for x in here(level, item)] + ([inside(item, depth + 1)] if deeper else [])
            return F.concat(*parts) if len(parts) > 1 else parts[0]

        return F.coalesce(F.flatten(F.transform(_part(value, name, _LIST), each)), none)

    none = F.slice(visit("top", F.create_map().cast(_OBJECT)), 1, 0)
    found = [F.coalesce(x, none) for x in here("top", doc) + here("info", _part(doc, "info", "variant"))]
    if any(x in levels for x in LEVELS[2:]):
        found.append(inside(doc, 0))
    return F.concat(*found) if len(found) > 1 else found[0]


def _key_set(level: str, keys: Column) -> Column:
    text = F.array_join(F.array_sort(F.map_keys(keys)), ",")
    one = F.struct(F.lit(level).alias("level"), text.alias("keys"))
    return F.when(keys.isNotNull(), F.array(one))


def schema_variants(raw: DataFrame, *levels: str) -> DataFrame:
    """How often each set of keys occurs at some levels of the documents, each parsed once and walked once."""
    # The outer form: the other one filters on the size first and so walks the documents twice.
    found = _parsed(raw).select(F.inline_outer(_walk(F.col("doc"), _key_set, levels))).where("level IS NOT NULL")
    return found.groupBy("level", "keys").agg(F.count("*").alias("count"))


def schema_profile(raw: DataFrame) -> DataFrame:
    return schema_variants(raw, *LEVELS)


def top_variants(variants: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent sets of keys of each level."""
    ordered = Window.partitionBy("level").orderBy(F.desc("count"), "keys")
    return variants.withColumn("at", F.row_number().over(ordered)).where(F.col("at") <= k).drop("at")


def doc_structure(parsed: DataFrame) -> DataFrame:
    """Outline of each document: keys, meta, innings, first team and its overs.

    ``parsed`` has the text next to the document (``match_id, raw, doc, reason``), so nothing is joined.
    """
    innings = F.col("doc.innings")
    first = F.get(innings, F.lit(0))
    return parsed.where("reason IS NULL").select(
        "match_id", F.array_join(F.json_object_keys("raw"), ",").alias("top_level_keys"),
        F.to_json("doc.meta").alias("meta"),
        innings.isNotNull().alias("has_innings"),
        _size(innings).alias("innings_count"),
        first["team"].alias("first_innings_team"),
        F.when(first.isNotNull(), _size(first["overs"])).alias("first_innings_overs"),
    )


def match_type_counts(docs: DataFrame) -> DataFrame:
    return value_counts(docs.select(F.col("info.match_type").alias("match_type")), "match_type")


def reject_report(rejects: DataFrame) -> DataFrame:
    """The number of rejected files, and for each the reason with length and digest of its text."""
    count = rejects.agg(F.count("*").alias("error_count"))
    account = F.concat_ws(", ", "reason", F.concat(F.length("record"), F.lit(" characters")), F.md5(F.col("record").cast("binary")))
    return union_all(
        [
            count.select(F.lit("error_count").alias("key"), F.col("error_count").cast("string").alias("value")),
            rejects.select(F.col("match_id").alias("key"), account.alias("value")),
        ]
    )


def field_presence(raw: DataFrame, threshold: float = 0.95) -> DataFrame:
    """How many deliveries have each field, and whether enough do for it to be required.

    ``percentage`` is of the deliveries; ``files_percentage`` relates the same count to the
    number of files, as it was first reported, and can pass 100. The totals travel as two
    marked fields, so one pass over the documents gives everything.
    """
    per_delivery = lambda _, keys: F.when(keys.isNotNull(), F.concat(F.array(F.lit("#delivery")), F.map_keys(keys)))
    fields = _walk(F.col("doc"), per_delivery, ("delivery",))
    marked = F.when(F.col("doc").isNotNull(), F.concat(F.array(F.lit("#file")), fields))
    counts = _parsed(raw).select(F.explode_outer(marked).alias("field")).groupBy("field").agg(F.count("*").alias("deliveries"))
    everything = Window.partitionBy()
    total_of = lambda mark: F.max(F.when(F.col("field") == mark, F.col("deliveries"))).over(everything)
    shares = counts.select("*", total_of("#delivery").alias("all_deliveries"), total_of("#file").alias("files"))
    return shares.where(~F.col("field").startswith("#")).select(
        "field", "deliveries",
        percent(F.col("deliveries"), F.col("all_deliveries")).alias("percentage"),
        percent(F.col("deliveries"), F.col("files")).alias("files_percentage"),
        (F.col("deliveries") / F.col("all_deliveries") >= threshold).alias("required"),
    )


def _size(items: Column) -> Column:
    return F.coalesce(F.when(items.isNotNull(), F.size(items)), F.lit(0))


def _joined(items: Column) -> Column:
    return F.coalesce(F.array_join(items, "|"), F.lit(""))


def _count_overs(measure) -> Column:
    """Sum of a measure of an innings over all innings of a document."""
    zero = F.lit(0)
    values = F.transform("innings", lambda i: F.coalesce(measure(i), zero))
    return F.coalesce(F.aggregate(values, zero, lambda a, b: a + b), zero)


def match_metadata(docs: DataFrame) -> DataFrame:
    """One row of 35 columns per document."""
    info = lambda name: F.col(f"info.{name}")
    officials = info("officials")
    squad = lambda k: _size(F.try_element_at(info("players"), F.get(info("teams"), F.lit(k))))
    balls = lambda i: F.aggregate(
        F.transform(i["overs"], lambda o: _size(o["deliveries"])), F.lit(0), lambda a, b: a + b
    )
    return docs.select(
        "match_id",
        F.col("meta.data_version"), F.col("meta.created").alias("created_date"), F.col("meta.revision"),
        info("match_type"), info("match_type_number"), info("gender"),
        _joined(info("teams")).alias("teams"),
        info("team_type"), info("overs"), info("balls_per_over"),
        first_date().alias("date"),
        info("city"), info("venue"), info("season"),
        event_part("name").alias("event_name"), event_part("group").alias("event_group"),
        F.when(officials.isNotNull(), _joined(officials["umpires"])).alias("umpires"),
        F.array_join(officials["referees"], "|").alias("referees"),
        info("toss.winner").alias("toss_winner"), info("toss.decision").alias("toss_decision"),
        info("outcome.winner").alias("outcome_winner"), info("outcome.result").alias("outcome_result"),
        info("outcome.method").alias("outcome_method"),
        info("outcome.by.runs").alias("outcome_by_runs"), info("outcome.by.wickets").alias("outcome_by_wickets"),
        _joined(info("player_of_match")).alias("player_of_match"),
        F.coalesce(squad(0), F.lit(0)).alias("team1_players"),
        F.coalesce(squad(1), F.lit(0)).alias("team2_players"),
        _size(info("registry.people")).alias("registry_count"),
        _joined(info("missing")).alias("missing_fields"),
        (_size(F.col("innings")) > 0).alias("has_innings_data"),
        _size(F.col("innings")).alias("innings_count"),
        _count_overs(lambda i: _size(i["overs"])).alias("total_overs_recorded"),
        _count_overs(balls).alias("total_deliveries"),
    )


def short_metadata(meta: DataFrame) -> DataFrame:
    """The nine columns of the short form."""
    return meta.select(
        "match_id", "match_type", "teams", "date", "city", "venue",
        "has_innings_data", "innings_count", "total_deliveries",
    )


def empty_matches(meta: DataFrame) -> DataFrame:
    return meta.where(~F.col("has_innings_data"))


def completeness_by_type(meta: DataFrame) -> DataFrame:
    share = lambda condition: percent(total(flag(condition)), F.count("*"))
    null = lambda c: F.col(c).isNull()
    return meta.where(F.col("match_type").isNotNull()).groupBy("match_type").agg(
        F.count("match_id").alias("count"),
        F.sum("total_deliveries").alias("total_deliveries"),
        F.avg("innings_count").alias("avg_innings"),
        share(null("city")).alias("pct_null_city"),
        share(null("venue")).alias("pct_null_venue"),
        share(~null("outcome_winner")).alias("pct_with_winner"),
        share(~null("outcome_result")).alias("pct_with_result"),
        share(F.col("player_of_match") != "").alias("pct_with_pom"),
        share(F.col("missing_fields") != "").alias("pct_with_missing_fields"),
    )


def matches_per_year(meta: DataFrame) -> DataFrame:
    """Matches by year; dates that do not parse are left out."""
    year = F.year(parsed_date(F.col("date")))
    return (
        meta.select(year.alias("year")).where(F.col("year").isNotNull())
        .groupBy("year").agg(F.count("*").alias("matches"))
    )


def registry_stats(meta: DataFrame) -> DataFrame:
    return meta.agg(
        F.avg("registry_count").alias("avg_players"),
        F.min("registry_count").alias("min_players"),
        F.max("registry_count").alias("max_players"),
    )


def quality_issues(meta: DataFrame) -> DataFrame:
    """Matches with too few deliveries, players or registry entries."""
    return meta.where(
        (F.col("total_deliveries") < 10)
        | (F.col("team1_players") < 11)
        | (F.col("team2_players") < 11)
        | (F.col("registry_count") < 22)
    )


def _type_name(value: Column) -> Column:
    """Plain name of a JSON value's type as given by ``schema_of_variant``, which is asked once."""
    name = lambda schema: (
        F.when(schema.startswith("OBJECT"), "dict")
        .when(schema.startswith("ARRAY"), "list")
        .when(schema == "STRING", "str")
        .when(schema == "BOOLEAN", "bool")
        .when(schema == "BIGINT", "int")
        .when(schema == "VOID", "NoneType")
        .otherwise("float")
    )
    return F.get(F.transform(F.array(F.schema_of_variant(value)), name), F.lit(0))


def _value_types(level: str, keys: Column) -> Column:
    """Section, field and type of each member of an object, those of a ball's own objects too."""
    section = "info" if level == "info" else "delivery"
    row = lambda field, value: F.struct(
        F.lit(section).alias("section"), field.alias("field"), _type_name(value).alias("type")
    )
    plain = F.transform(F.map_entries(keys), lambda e: row(e["key"], e["value"]))
    if level == "info":
        return plain
    inner = lambda e: F.transform(
        F.map_entries(e["value"].try_cast(_OBJECT)), lambda x: row(F.concat_ws(".", e["key"], x["key"]), x["value"])
    )
    nested = F.filter(F.transform(F.map_entries(keys), inner), lambda x: x.isNotNull())
    return F.concat(plain, F.flatten(nested))


def json_types(raw: DataFrame) -> DataFrame:
    """Value types of the info fields and, one level deep, of the delivery fields."""
    found = _parsed(raw).select(F.inline_outer(_walk(F.col("doc"), _value_types, ("info", "delivery")))).where("section IS NOT NULL")
    return found.groupBy("section", "field", "type").agg(F.count("*").alias("count"))


def raw_profile(raw: DataFrame) -> DataFrame:
    """All that is asked about the texts, from one parse and one walk: ``kind, level, name, type, count``.

    ``keys`` counts the key sets of a level, ``member`` the members of info and balls by type, ``nested`` the
    members of a ball's own objects.
    """
    none = F.lit(None).cast("string")
    entry = lambda kind, level, name, type_: F.struct(kind.alias("kind"), level.alias("level"), name.alias("name"), type_.alias("type"))

    def visit(level, keys):
        sets = F.transform(_key_set(level, keys), lambda x: entry(F.lit("keys"), x["level"], x["keys"], none))
        if level not in ("info", "delivery"):
            return sets
        kind = lambda x: F.when(F.map_contains_key(keys, x["field"]), "member").otherwise("nested")
        return F.concat(sets, F.transform(_value_types(level, keys), lambda x: entry(kind(x), x["section"], x["field"], x["type"])))

    found = _parsed(raw).select(F.inline_outer(_walk(F.col("doc"), visit))).where("kind IS NOT NULL")
    return found.groupBy("kind", "level", "name", "type").agg(F.count("*").alias("count"))


def variants_of(profile: DataFrame) -> DataFrame:
    """As :func:`schema_profile`, from a stored :func:`raw_profile`."""
    return profile.where("kind = 'keys'").select("level", F.col("name").alias("keys"), "count")


def types_of(profile: DataFrame) -> DataFrame:
    """As :func:`json_types`, from a stored :func:`raw_profile`."""
    return profile.where("kind <> 'keys'").select(F.col("level").alias("section"), F.col("name").alias("field"), "type", "count")


def presence_of(profile: DataFrame, threshold: float = 0.95) -> DataFrame:
    """As :func:`field_presence`, from a stored :func:`raw_profile`."""
    objects = lambda level: F.sum(F.when((F.col("kind") == "keys") & (F.col("level") == level), F.col("count")))
    totals = profile.agg(objects("delivery").alias("all_deliveries"), objects("top").alias("files")).first()
    fields = profile.where("kind = 'member' AND level = 'delivery'").groupBy(F.col("name").alias("field")).agg(F.sum("count").alias("deliveries"))
    every, files = F.lit(totals.all_deliveries), F.lit(totals.files)
    return fields.select(
        "field", "deliveries", percent(F.col("deliveries"), every).alias("percentage"), percent(F.col("deliveries"), files).alias("files_percentage"),
        (F.col("deliveries") / every >= threshold).alias("required"),
    )


def suspicious_deliveries(deliveries: DataFrame, above: int = 7) -> DataFrame:
    """Balls whose total is more than ``above``."""
    return deliveries.where(F.col("total_runs") > above).select(
        "match_id",
        F.coalesce("batter", F.lit("unknown")).alias("batter"),
        F.coalesce("bowler", F.lit("unknown")).alias("bowler"),
        "batter_runs", "extras", "total_runs",
    )


def run_share(deliveries: DataFrame) -> DataFrame:
    """Percentage of balls at each total from 0 to 7."""
    return share_of(deliveries, "total_runs", range(8))


def runs_distribution_raw(deliveries: DataFrame, k: int = 5) -> DataFrame:
    return value_counts(deliveries, "total_runs", k)


def _over_sizes(docs: DataFrame) -> DataFrame:
    return (
        docs.select(
            "match_id",
            F.coalesce("info.match_type", F.lit("unknown")).alias("match_type"),
            F.coalesce("info.balls_per_over", F.lit(6)).alias("expected"),
            F.explode("innings.overs").alias("overs"),
        )
        .select("match_id", "match_type", "expected", F.explode("overs").alias("o"))
        .where(F.col("o.deliveries").isNotNull())
        .select(
            "match_id", "match_type", "expected",
            F.coalesce("o.over", F.lit(-1)).alias("over_number"), F.size("o.deliveries").alias("deliveries"),
        )
    )


def over_stats_by_type(docs: DataFrame) -> DataFrame:
    """Deliveries per over by match type, with the standard deviation of the population."""
    size = F.col("deliveries")
    return _over_sizes(docs).groupBy("match_type").agg(
        F.count("*").alias("count"),
        F.avg(size).alias("mean"),
        F.stddev_pop(size).alias("std"),
        F.min(size).alias("min"),
        F.max(size).alias("max"),
    )


def outlier_overs(docs: DataFrame) -> DataFrame:
    """Overs with more than two deliveries above the expected number."""
    return _over_sizes(docs).where(F.col("deliveries") > F.col("expected") + 2)


def observe_profile(parsed: DataFrame) -> tuple[DataFrame, Observation]:
    """``parsed`` (``doc, reason``) with counts that are taken while it is written.

    Put it right before the write: counts of a later shuffle could include tasks that ran twice.
    """
    seen = Observation()
    read = F.col("reason").isNull()
    observed = parsed.observe(
        seen, F.count("*").alias("total_files"), F.count_if(read).alias("files_processed"), F.count_if(~read).alias("files_rejected"),
        F.collect_set(F.col("doc.info.match_type")).alias("match_types"),
        F.count_if(_size(F.col("doc.innings")) > 0).alias("matches_with_innings"),
    )
    return observed, seen


def profile_summary(spark: SparkSession, seen: Observation) -> DataFrame:
    """Files, files read, match types, matches with data and with innings, once the observed table is written."""
    found = seen.get
    counts = {
        **{k: found[k] for k in ("total_files", "files_processed", "files_rejected")},
        "match_types": len(found["match_types"]), "matches_with_data": found["files_processed"],
        "matches_with_innings": found["matches_with_innings"],
    }
    return spark.createDataFrame(list(counts.items()), "key string, value bigint")
