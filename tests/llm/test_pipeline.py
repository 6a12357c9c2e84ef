"""The pipeline against plain versions of its stages."""

import os
import re
from collections import Counter

import pytest
from conftest_llm import lower_ascii, rows_of
from test_choices import plain_statistics
from test_dedup import plain_components, plain_fingerprint

import corpus_pipeline
from wicketflow.llm import decision_list, mixing
from wicketflow.llm.common import DOCUMENT_COLUMNS, table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_near_dedup", "mix_sources", "encode_pieces"]


def test_each_stage_on_its_predecessor(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    kept = {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        before = rows_of(docs)
        out = step(spark, docs, SF_DIR)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert tuple(out.columns) == DOCUMENT_COLUMNS
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = (before, rows_of(docs))

    before, after = kept["quality_rules"]
    rules = decision_list.fit(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))
    judged = {r.doc_id: r for r in decision_list.with_statistics(table(spark, SF_DIR, "documents")).collect()}
    want = set()
    for r in before:
        n, _, _, _, repeated = plain_statistics(r.text)
        if n >= 50 and 100 * repeated <= 50 * n and not any(all(c.holds(judged[r.doc_id][c.feature]) for c in rule) for rule in rules):
            want.add(r)
    assert set(after) == want and len(after) == len(want)

    before, after = kept["exact_dedup"]
    best = {}
    for r in before:
        best[lower_ascii(r.text)] = max(best.get(lower_ascii(r.text), r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(best.values()) and set(after) <= set(before)

    before, after = kept["simhash_near_dedup"]
    prints = {r.doc_id: plain_fingerprint(r.text) for r in before}
    root = plain_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    lowest = {}
    for i, p in prints.items():
        lowest[root[p]] = min(lowest.get(root[p], i), i)
    assert sorted(r.doc_id for r in after) == sorted(lowest.values()) and set(after) <= set(before)

    before, after = kept["mix_sources"]
    assert set(after) <= set(before) and max(Counter(after).values()) <= 3
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    totals = Counter()
    for r in before:
        totals[r.source] += size(r)
    targets = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(totals.items()), "source string, source_size bigint")).collect()}
    taken = Counter()
    for r in after:
        taken[r.source] += size(r)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 1.5 * max(size(r) for r in before if r.source == source)

    before, after = kept["encode_pieces"]
    assert Counter((r.doc_id, r.text) for r in before) == Counter((r.doc_id, r.decoded) for r in after)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_cuts_of_the_pipeline_keep_ids_alone():
    """What only digests need takes no room in the worker that encodes."""
    import public_tokenizers

    from wicketflow.llm.sentence_lattice import PieceModel

    model = PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    text = "some words, some more words"
    first = model.nbest(text)
    assert all(c.names is None and c.read is None for t in model.tables.values() for c in t.values())
    assert [(s, len(i)) for s, i in first] == [(s, k) for s, k, _, _ in model.nbest_digests(text)]
