import math
import re
from collections import Counter

import compare
import numpy as np
import pytest
from conftest_llm import lower_ascii

from wicketflow.llm import lexical_search, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def plain_search(docs, items, top):
    """docs, items: (id, text); every item against every document."""
    bags = [(i, Counter(TERM.findall(lower_ascii(t)))) for i, t in docs]
    n_docs, length = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            if bag:
                m = 10 + 90 * bag.total() * n_docs // length
                score = sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                    for t in set(TERM.findall(lower_ascii(text))) & set(bag)
                )
                scored += [(-score, doc_id is not None, doc_id or 0, doc_id)] if score > 0 else []
        out += [(item_id, k + 1, row[3], -row[0]) for k, row in enumerate(sorted(scored)[:top])]
    return Counter(out)


def found(docs, items, top):
    return Counter(tuple(r) for r in lexical_search.search(docs, items, top).collect())


@pytest.fixture(scope="module")
def items(spark):
    texts = [
        "hello TEXT", "word1 of2 the3 line", None, "", "no id here", "ÄÖ 日本語 x", "nowhere at-all", "same row", "same row", "  ,. ",
        "Line line other " * 30, "a" * 3000, "\x00x\x1c",
    ]
    return spark.createDataFrame([*enumerate(texts), (None, "hello word7 row"), (3, "id row")], ITEMS)


def test_odd_rows(docs, clashing, items):
    texts, asked = ([tuple(r) for r in t.collect()] for t in (docs.select("doc_id", "text"), items))
    for top in (1, 3, 20):
        assert found(docs, items, top) == plain_search(texts, asked, top)
    extra = clashing.withColumnsRenamed({"size": "n", "kept": "bag", "keep_id": "item_id", "copies": "score", "target": "number"})
    assert found(extra, items, 3) == plain_search(texts, asked, 3)


def test_empty(spark, docs, no_docs, items):
    assert lexical_search.search(no_docs, items).collect() == []
    none = lexical_search.search(docs, spark.createDataFrame([], ITEMS))
    assert none.collect() == [] and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_hot_bags_and_ties(spark):
    """A third of all documents are one class, and many classes have equal scores."""
    rng = np.random.default_rng(5)
    rows = [(k, "alpha beta Gamma" if k % 3 == 0 else " ".join(f"w{x}" for x in rng.integers(0, 30, 6))) for k in range(3000)]
    rows = [rows[k] for k in rng.permutation(3000)]
    items = [(k, t) for k, t in enumerate(["gamma", "w1 w2", "w3", "beta w29 w4", "w5 w6 w7 w8 alpha"])]
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(11), spark.createDataFrame(items, ITEMS), 10)
    assert got == plain_search(rows, items, 10)


def test_many_blocks_give_the_same(spark, docs, items, monkeypatch):
    one = found(docs, items, 5)
    monkeypatch.setattr(lexical_search, "VOCABULARY", 4)
    monkeypatch.setattr(lexical_search, "_PAIRS", 3)
    assert len(list(lexical_search.blocks(lexical_search.item_terms(items)))) > 3
    assert found(docs, items, 5) == one


def test_terms_are_those_of_the_pattern():
    text = "".join(map(chr, range(300))) + "aB9_z日本 \U0001f600"
    assert [t.decode() for t in lexical_search.terms_of(text.encode())] == TERM.findall(lower_ascii(text))


@pytest.mark.parametrize("name", ["op12_lexical_search"])
def test_sql_form(spark, sample_dir, name):
    con = compare.connect(sample_dir)
    assert compare.difference(spark, con, queries.queries()[name], queries.oracles()[name], sample_dir) is None
