import hashlib
import math
import zlib
from collections import defaultdict

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from wicketflow.llm import conversation_trie, queries

TURNS = "conv_id bigint, turn bigint, role string, text string"


def own_turns(rows):
    """(role, text) of each conversation in order."""
    held = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            held[conv_id].append((turn is not None, turn or 0, digest, role, text))
    return {c: [t[3:] for t in sorted(v)] for c, v in held.items()}


def with_heads(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def plain_trie(paths):
    """Members of every node, and each number from its definition."""
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
    out = set()
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = sum(len(n) == len(node) + 1 for n in below)
        leaves = sum(not any(len(x) == len(n) + 1 and x[: len(n)] == n for x in below) for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in own if len(paths[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.add((own[0], len(node), parent, len(own), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def collected(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def odd_conversations():
    rows = []
    for c in (100, 101, 102, 103, 150, 151, 152, 199, 201, 202, 305, 400, 402):
        rows += [(c, t, ("system", "user", "assistant")[t % 3], f"turn {t % 4}" if c % 2 else f"turn {t} of {c // 100}") for t in range(c % 9)]
    rows += [(500, t, "user", "long " * 50 if t % 2 else "é日\U0001f600") for t in range(40)]
    rows += [(k, t, "user", "long " * 50 if t % 2 else "é日\U0001f600") for k in (501, 503, 560) for t in range(2 * k % 43)]
    rows += [(600, None, None, None), (600, 2, "user", None), (600, 2, "user", "tie"), (600, 2, "user", "tie"), (601, 1, None, "x"), (602, 0, "", "x")]
    rows += [(None, 0, "user", "nobody"), (-3, 0, "user", "negative"), (-103, 5, "us", "er"), (-103, 6, "use", "r"), (0, 2000, "user", "a"), (0, 1, "user", "b"), (0, -5000, "user", "c")]
    return rows


@pytest.mark.parametrize("block", [1, 2, 7])
def test_odd_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(conversation_trie, "BLOCK", block)
    rows = odd_conversations()
    table = spark.createDataFrame(rows, TURNS).repartition(3)
    assert collected(conversation_trie.prefix_trie_with_shared_heads(table)) == plain_trie(with_heads(own_turns(rows)))
    if block == 2:
        extra = table.withColumns({n: F.lit(7) for n in "digest size place depth key owner n_convs end start".split()})
        assert collected(conversation_trie.prefix_trie(extra)) == plain_trie(own_turns(rows))


def test_empty(spark):
    none = spark.createDataFrame([], TURNS)
    assert conversation_trie.prefix_trie(none).collect() == []
    assert conversation_trie.prefix_trie_with_shared_heads(none).collect() == []
    # A conversation that is left without turns is a member of the root.
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6)
    rows = [(c, 0, "user", "dropped")]
    got = collected(conversation_trie.prefix_trie_with_shared_heads(spark.createDataFrame(rows, TURNS)))
    assert got == {(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}


def test_hot_turns_and_copies(spark, monkeypatch):
    """A common first turn, many equal conversations, a node with very many children, one very long conversation."""
    monkeypatch.setattr(conversation_trie, "_PART_BITS", 3)
    rng = np.random.default_rng(3)
    rows = []
    for c in range(600):
        own = [0] * 3 if c % 3 == 0 else [0, *rng.integers(0, 400, int(rng.integers(1, 7)))]
        rows += [(c, t, "user", f"text {x}") for t, x in enumerate(own)]
    rows += [(700, t, "user", f"text {t % 5}") for t in range(5000)]
    got = collected(conversation_trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(5)))
    short = plain_trie(own_turns([r for r in rows if r[0] != 700 or r[1] < 9]))
    # Below depth 9 the long conversation is alone; above it only its own texts are missing from nothing that is saved.
    assert {r for r in got if r[1] < 9} == {r for r in short if r[1] < 9}
    assert {r[:7] for r in got if r[1] >= 9 and r[0] == 700} == {(700, d, 700, 1, int(d < 5000), 1, 0) for d in range(9, 5001)}


def test_parents_by_broadcast_and_by_join_agree(spark, monkeypatch):
    rows = odd_conversations()
    digested = conversation_trie.digest_turns(spark.createDataFrame(rows, TURNS))
    expected = plain_trie(own_turns(rows))
    real = conversation_trie._owner_of_parent
    for hot_from in (0, 2, 10**6):
        monkeypatch.setattr(conversation_trie, "_owner_of_parent", lambda h, p, _, f=hot_from: real(h, p, f))
        assert collected(conversation_trie.build(*conversation_trie.paths_as_given(digested))) == expected


def test_last_turns(spark):
    rows = odd_conversations()
    table = spark.createDataFrame(rows, TURNS)
    convs, paths = conversation_trie.paths_with_shared_heads(conversation_trie.digest_turns(table))
    own = with_heads(own_turns(rows))
    got = conversation_trie.last_turns(conversation_trie.build(convs, paths), paths, table).collect()
    assert len(got) == len(plain_trie(own))
    assert all((r.role, r.text) == (own[r.conv_id][r.depth - 1] if r.depth else (None, None)) for r in got)


@pytest.mark.parametrize("name", ["op11_conversation_trie"])
def test_sql_form(spark, sample_dir, name):
    con = compare.connect(sample_dir)
    assert compare.difference(spark, con, queries.queries()[name], queries.oracles()[name], sample_dir) is None
