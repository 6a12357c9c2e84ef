import zlib
from collections import Counter, defaultdict

import compare
import pytest
from pyspark.sql import functions as F

from wicketflow.llm import queries, sharding


def plain_checks(rows, texts, shards):
    """What the law asks for, whatever the order: gapless slots, sizes near equal, equal texts together."""
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share, largest = sum(r.size for r in rows) / shards, max(r.size for r in rows)
    held = Counter()
    for r in rows:
        held[r.shard] += r.size
    assert all(abs(held[s] - share) <= largest + sharding.SLACK * share for s in range(shards))


def test_odd_rows(docs, clashing):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    for table in (docs, clashing.withColumns({n: F.lit(1) for n in ("shard", "slot", "range", "start", "number", "k", "tie", "law")})):
        for shards in (1, 3):
            plain_checks(sharding.plan_shards(table, shards).collect(), texts, shards)
        whole = sharding.shard(table, 3)
        assert whole.columns == [c for c in table.columns if c not in ("shard", "slot")] + ["shard", "slot"]
        assert whole.count() == len(texts)


def test_empty(no_docs):
    assert sharding.plan_shards(no_docs).collect() == []
    assert sharding.shard(no_docs).collect() == []


def test_hot_text_and_repeated_rows(spark):
    rows = [(k, "the same text " * 5 if k % 3 == 0 else f"text {k} " * (k % 7 + 1)) for k in range(6000)] + [(7, "one row " * 9)] * 3000
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sharding.plan_shards(table, 12).collect()
    plain_checks(got, rows, 12)
    homes = defaultdict(set)
    for r in got:
        homes[r.text_crc32].add(r.shard)
    many = [c for c, s in homes.items() if len(s) > 1]
    assert sorted(many) == sorted(zlib.crc32(t.encode()) for t in ("the same text " * 5, "one row " * 9))
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.plan_shards(table, 12).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in got}


def test_overfull_ranges_are_subdivided(spark):
    """However few splitters the sample gives at first, no range stays far above its share."""
    rows = [(k, "x" * (k % 50)) for k in range(4000)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn(sharding.ROW, F.monotonically_increasing_id())
    records = sharding.text_records(table)
    splitters, sums = sharding.split_ranges(records, 400)
    total = sum(len(t) + 16 for _, t in rows)
    assert len(sums) == len(splitters) + 1 and sum(b for b, _ in sums) == total and sum(n for _, n in sums) == 4000
    assert max(b for b, _ in sums) <= 2 * total / 400 + 66
    places = sorted(tuple(r) for r in records.select("k", "tie", sharding.ROW).collect())
    numbered = records.withColumn("range", sharding.range_of(splitters)).groupBy("range").count().collect()
    below = lambda cut: sum(p < cut for p in places)
    assert {r.range: r["count"] for r in numbered} == {
        k: n for k, n in ((k, below(hi) - below(lo)) for k, (lo, hi) in enumerate(zip([(-1,), *splitters], [*splitters, (2**63,)]))) if n
    }


def test_written_shards(spark, docs, tmp_path):
    sharding.write_shards(docs.drop("n_chars"), str(tmp_path / "out"), 2)
    back = spark.read.parquet(str(tmp_path / "out"))
    planned = Counter((r.doc_id, r.shard, r.slot) for r in sharding.plan_shards(docs, 2).collect())
    assert Counter((r.doc_id, r.shard, r.slot) for r in back.collect()) == planned


def test_no_python_in_the_plan(docs, capsys):
    sharding.plan_shards(docs, 2).explain()
    sharding.text_records(docs.withColumn(sharding.ROW, F.lit(1))).explain()
    plan = capsys.readouterr().out
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("name", ["op13_sampled_shards"])
def test_sql_form(spark, sample_dir, name):
    con = compare.connect(sample_dir)
    assert compare.difference(spark, con, queries.queries()[name], queries.oracles()[name], sample_dir) is None
