"""What the plans of the registered queries read: one scan, one parse, no shuffle where one is not needed."""

import json
import re

import pytest

from pyspark.sql import functions as F

import match_files
from wicketflow.operators import consistency, identity, profiling, summaries, unnest
from wicketflow.operators.player_innings import player_innings
from wicketflow.plans import catalogue, pipeline, projection
from wicketflow.scratch import stage
from wicketflow.sources import documents, reports, tables

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, folder=None):
    """Scans in a plan, of one stored table if its folder is given; a reused exchange is not printed again."""
    text = plan_of(df)
    return len(re.findall(r"FileScan", text)) if folder is None else len(re.findall(rf"FileScan[^\n]*{folder}", text))


def folder_of(df):
    return df.inputFiles()[0].rstrip("/").split("/")[-3]


@pytest.fixture(scope="module")
def docs(spark):
    return catalogue.match_documents(spark, SF_DIR)


@pytest.fixture(scope="module")
def names(docs):
    return catalogue._Names(docs)


def test_names_take_one_pass_over_the_documents(spark, docs, names):
    ledger = identity.ledger(docs)
    assert scans(ledger) == 1 and "Exchange" not in plan_of(ledger)
    counted = identity.spellings(docs.transform(identity.ledger))
    assert scans(counted) == 1 and plan_of(counted).count("Exchange") == 1
    assert scans(identity.players(names.counted, names.resolved)) == 2


def test_deliveries_read_the_documents_once_and_carry_no_map(spark, docs, names):
    out = unnest.deliveries(docs, names.maps())
    assert scans(out) == 2 and scans(out, folder_of(docs)) == 1
    generates = re.findall(r"Generate [^\n]*", plan_of(out))
    assert len(generates) == 3 and not any(re.search(r"info#|gap_ids#|ids#", g) for g in generates)
    # The balls are finished once: no filter in front of the first explode repeats the work.
    assert plan_of(out).count("wicket_player_out_id, if") <= 1


def test_ledger_counts_names(spark, docs):
    """Against counts of the exploded names."""
    spark.sql("SELECT 1")
    balls = unnest.deliveries(docs, catalogue._Names(docs).maps())
    used = {}
    for r in balls.collect():
        for role in ("batter", "bowler", "non_striker", "wicket_player_out", "wicket_fielder"):
            if r[role]:
                used[r.match_id, r[role]] = used.get((r.match_id, r[role]), 0) + 1
    for r in docs.select("match_id", "info.player_of_match").collect():
        for name in (r.player_of_match or [])[:1]:
            used[r.match_id, name] = used.get((r.match_id, name), 0) + 1
    rows = identity.ledger(docs).collect()
    assert {(r.match_id, r.name): r.times for r in rows if r.times} == used
    listed = {(r.match_id, n): i for r in docs.select("match_id", "info.registry.people").collect() for n, i in (r.people or {}).items() if i}
    assert {(r.match_id, r.name): r.player_id for r in rows if r.player_id} == listed and len(rows) == len(used.keys() | listed.keys())


@pytest.mark.parametrize("build", [
    profiling.schema_profile, lambda raw: profiling.top_variants(profiling.schema_profile(raw)), profiling.json_types, profiling.field_presence,
])
def test_texts_are_parsed_once(docs, build):
    assert plan_of(build(projection.raw_documents(docs))).count("parseJson") == 1
    assert scans(build(projection.raw_documents(docs))) == 1


def test_one_walk_answers_all(docs):
    raw = projection.raw_documents(docs)
    found = profiling.raw_profile(raw)
    assert plan_of(found).count("parseJson") == 1 and scans(found) == 1
    found = stage(raw.sparkSession, found)
    rows = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()))
    assert rows(profiling.variants_of(found)) == rows(profiling.schema_profile(raw))
    assert rows(profiling.types_of(found)) == rows(profiling.json_types(raw))
    assert rows(profiling.presence_of(found)) == rows(profiling.field_presence(raw))


def test_outline_joins_nothing(docs):
    out = profiling.doc_structure(documents.parse(projection.raw_documents(docs)))
    assert "Join" not in plan_of(out) and scans(out) == 1


def test_walk_finds_odd_places(spark):
    texts = [
        {"info": {"a": 1}, "innings": [{"team": "x", "overs": [{"over": 1, "deliveries": [{"b": {"z": 1}, "c": None}, 5]}, 7, {"over": 2}]}, "no", {"overs": "none"}]},
        {"info": "text", "innings": {"team": 1}}, {"innings": [None, {"overs": [None, {"deliveries": None}]}]}, [1, 2], 5,
    ]
    raw = spark.createDataFrame([(json.dumps(t),) for t in texts] + [("{ broken",), ("",), (None,)], "raw string")
    found = {(r.level, r.keys): r["count"] for r in profiling.schema_profile(raw).collect()}
    assert found == {
        ("top", "info,innings"): 2, ("top", "innings"): 1, ("info", "a"): 1, ("innings", "overs,team"): 1, ("innings", "overs"): 2,
        ("over", "deliveries,over"): 1, ("over", "over"): 1, ("over", "deliveries"): 1, ("delivery", "b,c"): 1,
    }
    types = {(r.section, r.field, r.type): r["count"] for r in profiling.json_types(raw).collect()}
    assert types == {("info", "a", "int"): 1, ("delivery", "b", "dict"): 1, ("delivery", "b.z", "int"): 1, ("delivery", "c", "NoneType"): 1}


def test_persons_read_each_table_once(spark):
    balls, players = (stage(spark, projection.table(spark, SF_DIR, n)) for n in ("nd", "np"))
    for build in (consistency.player_consistency, consistency.reduced_consistency, consistency.multiple_ids, consistency.missing_id_matches):
        out = build(consistency.person_table(balls, players))
        assert scans(out, folder_of(balls)) == 1 and scans(out, folder_of(players)) == 1
    pairs = consistency.name_variant_counts(consistency.id_name_pairs(balls))
    assert scans(pairs) == 1


def test_numbers_of_a_run_cost_no_scan(spark, tmp_path):
    raw = spark.createDataFrame([("a", '{"info": {"match_type": "T"}, "innings": [{}]}'), ("b", '{"info": {}}'), ("c", "{")], "match_id string, raw string")
    observed, seen = profiling.observe_profile(documents.parse(raw))
    observed.write.parquet(str(tmp_path / "x"))
    summary = profiling.profile_summary(spark, seen)
    assert scans(summary) == 0
    assert {r.key: r.value for r in summary.collect()} == {
        "total_files": 3, "files_processed": 2, "files_rejected": 1, "match_types": 1, "matches_with_data": 2, "matches_with_innings": 1,
    }


def test_buckets_are_joined_without_a_shuffle_and_pruned(spark, tmp_path):
    left = spark.range(500).selectExpr("cast(id % 50 AS string) AS innings_id", "id AS ball")
    right = spark.range(50).selectExpr("cast(id AS string) AS innings_id", "id * 2 AS total")
    joined = tables.join_bucketed(spark, {"balls": left, "totals": right}, str(tmp_path), 4)
    assert "Exchange" not in plan_of(joined) and joined.count() == 500
    one = joined.where("innings_id = '7'")
    assert "SelectedBucketsCount: 1 out of 4" in plan_of(one) and one.count() == 10


# Files.


def write_some(folder):
    text = json.dumps(match_files.files()["e01"])
    for name, content in {"m1.json": text, "m1.copy.json": text, "m1.other.json": text + " ", "m2.json": text, "m3.json": "{"}.items():
        (folder / name).write_text(content)


def test_double_files_are_found_without_their_texts(spark, tmp_path):
    write_some(tmp_path)
    doubles = documents.double_files(spark, str(tmp_path))
    # m1.copy comes before m1.json by path.
    assert [r.path.rsplit("/", 1)[1] for r in doubles.collect()] == ["m1.json"]
    shuffled = [line for line in plan_of(doubles).split("\n") if "Exchange" in line]
    assert shuffled and not any("value#" in line for line in shuffled)
    out = str(tmp_path / "out")
    ids = sorted(r.match_id for r in pipeline.ingest(spark, str(tmp_path), out).collect())
    assert ids == ["m1", "m1", "m2"]
    assert {r.key: r.value for r in spark.read.parquet(f"{out}/profile/summary").collect()}["total_files"] == 4


def test_written_files_are_read_back(spark, tmp_path):
    texts = {"a b": json.dumps(match_files.files()["e01"], indent=2), "c%d+": "line\nline", "e": ""}
    documents.write_raw(spark.createDataFrame(list(texts.items()), "match_id string, raw string"), str(tmp_path / "x"))
    assert sorted(p.name for p in (tmp_path / "x").iterdir() if p.suffix == ".json") == ["a b.json", "c%d+.json", "e.json"]
    assert {r.match_id: r.raw.rstrip("\n") for r in documents.read_raw(spark, str(tmp_path / "x")).collect()} == texts
    assert documents.read_matches(spark, str(tmp_path / "x")).select("match_id", "info.match_type").collect() == [("a b", "T20")]


def test_files_get_their_names_in_the_tasks(spark, tmp_path, monkeypatch):
    """The driver handles no single file; ids without a name have the one of a partitioned writer."""
    monkeypatch.setattr(documents, "unquote", None)
    rows = [(f"m{k}", f"{{{k}") for k in range(30)] + [(None, None)]
    documents.write_raw(spark.createDataFrame(rows, "match_id string, raw string").repartition(4), str(tmp_path / "x"))
    found = {p.name: p.read_text() for p in (tmp_path / "x").iterdir()}
    assert found == {**{f"{k}.json": f"{v}\n" for k, v in rows[:-1]}, "__HIVE_DEFAULT_PARTITION__.json": "\n"}


def test_whole_texts_are_not_shuffled_to_tell_their_outcome(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(catalogue.queries()["s02_read_raw"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" in text and text.index("Exchange") < text.index("substring(")


def test_lines_of_a_match_are_dealt_once(spark):
    """Numbering, over, innings and document go by the match: the balls are shuffled for none of them again."""
    text = plan_of(projection.documents(spark, SF_DIR))
    assert not re.search(r"Exchange hashpartitioning\((l_orderkey|innings_id|match_id#\d+, innings_id)", text)
    assert len(re.findall(r"Exchange hashpartitioning\(m#\d+, \d+\), REPARTITION_BY_NUM", text)) == 1
    named = plan_of(projection.table(spark, SF_DIR, "nd"))
    assert len(re.findall(r"(?:Join|Window) ", named)) == 2


def test_flat_tables_number_the_lines_once(spark):
    """The balls are numbered where their match was dealt to; matches and innings are made of distinct numbers, not of lines."""
    assert not re.search(r"Exchange hashpartitioning\(l_orderkey", plan_of(projection.table(spark, SF_DIR, "d")))
    for name, numbers in (("m", 1), ("i", 2)):
        keys = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", plan_of(projection.table(spark, SF_DIR, name)))
        assert len(keys[-1].split(", ")) == numbers
    t = catalogue.flat_tables(spark, SF_DIR)
    for name in ("overs", "players"):
        assert t[name].count() == projection.table(spark, SF_DIR, name[0]).count() == t[name].distinct().count()


def test_overs_of_a_bowler_do_not_multiply_the_rows(spark):
    """A row per innings and bowler meets in the shuffle for 64 overs; over numbers may be any."""
    numbers = [*range(-70, 200), *range(0, 5), None]
    rows = [("m", "i", n, 1, 0, 0, None, k % 9 == 0, "caught", "x" if k % 9 else "ace", "b", "ace") for k, n in enumerate(numbers)]
    ball = "match_id string, innings_id string, over_number int, ball_number int, batter_runs int, total_runs int, extras_type string," \
        " is_wicket boolean, wicket_kind string, wicket_player_out_id string, batter_id string, bowler_id string"
    balls = spark.createDataFrame(rows, ball).withColumn("non_striker_id", F.lit(None).cast("string")).withColumn("wicket_fielder_id", F.lit(None).cast("string"))
    found = player_innings(balls)
    told = {r.player_id: r for r in found.collect()}
    assert told["ace"].overs_bowled == 270 and told["b"].overs_bowled == 0 and told["ace"].dismissal_type == "caught"
    assert told["ace"].balls_bowled == len(numbers)
    assert "overs_from" in plan_of(found) and "over_bowled" not in plan_of(found)


@pytest.mark.parametrize("name", ["p01_doc_structure", "p11_empty_matches", "p18_json_types", "s02_read_raw"])
def test_filters_neither_write_nor_parse_texts(spark, name):
    text = plan_of(catalogue.queries()[name](spark, SF_DIR))
    assert not [line for line in text.splitlines() if re.search(r"\bFilter ", line) and re.search("from_json|StructsToJson", line)]


def test_values_are_counted_in_the_batch_they_are_read_in(spark):
    """No table of all distinct values in front of the shuffle; odd values count as they did."""
    df = spark.createDataFrame([("a", True, 1), ("a", None, 2), (None, False, 3), ("", True, 3)], "s string, b boolean, n int").withColumn("e", F.lit(None).cast("string"))
    found = {r.column: r for r in summaries.describe_all(df).collect()}
    assert set(found) == {"s", "b", "n"}
    assert tuple(found["s"])[:5] == ("s", 3, 2, "a", 2) and tuple(found["b"])[:5] == ("b", 3, 2, "true", 2)
    assert not re.search(r"partial_count[^\n]*\n[^\n]*(Filter|Generate)", plan_of(summaries.describe_all(df)))
    assert "MapInArrow" in plan_of(summaries.describe_all(df))


def test_roles_meet_the_names_of_a_match_in_one_row(spark):
    """As a join of every role would: several ids of a name give several rows, an unknown name one."""
    balls = spark.createDataFrame([("b1", "m1", "A", "B"), ("b2", "m1", None, "C"), ("b3", None, "A", None)], "ball string, match_id string, x string, y string")
    names = spark.createDataFrame(
        [("m1", "A", "a1"), ("m1", "A", "a2"), ("m1", "B", None), ("m1", None, "n"), (None, "A", "q"), ("m2", "C", "c")],
        "match_id string, name string, player_id string",
    )
    out = identity.resolve_ids(balls, names, ("x", "y"))
    assert out.columns == ["match_id", "name", "ball", "role", "player_id"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [
        ("m1", "A", "b1", "x", "a1"), ("m1", "A", "b1", "x", "a2"), ("m1", "B", "b1", "y", None),
        ("m1", "C", "b2", "y", None), (None, "A", "b3", "x", None),
    ]))
    # The rows are not multiplied in front of a shuffle.
    text = plan_of(out)
    assert 0 <= text.find("Generate explode(") < text.find("Join")


def test_rejects_say_why(spark):
    raw = spark.createDataFrame([("a", "{"), ("b", "[1]"), ("c", ""), ("d", None), ("e", "{}")], "match_id string, raw string")
    told = {r.match_id: r.message for r in documents.reject_messages(documents.rejects_of(documents.parse(raw))).collect()}
    assert set(told) == {"a", "b", "c", "d"} and "line 1 column 2" in told["a"] and told["b"] == "an object was expected, not list"


def test_a_failed_write_keeps_the_old_table(spark, tmp_path):
    tables.write_tables({"t": spark.range(3)}, str(tmp_path))
    with pytest.raises(Exception):
        tables.write_tables({"t": spark.range(3).selectExpr("assert_true(id < 2) AS x", "id")}, str(tmp_path), distinct=False)
    assert tables.read_tables(spark, str(tmp_path), ("t",))["t"].count() == 3
    # A table may be replaced by what is made of it.
    tables.write_tables({"t": tables.read_tables(spark, str(tmp_path), ("t",))["t"].where("id > 0")}, str(tmp_path))
    assert tables.read_tables(spark, str(tmp_path), ("t",))["t"].count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_csv_tells_empty_from_missing(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "a,\"b\"")], "n int, s string")
    reports.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, reports.read_csv(spark, str(tmp_path / "c"), df.schema).collect())) == [(1, ""), (2, None), (3, 'a,"b"')]
