import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
from conftest_llm import lower_ascii, rows_of

from wicketflow.llm import exact_dedup, simhash, suffix_dedup


def test_exact_groups_match_a_plain_version(docs, clashing):
    rows = rows_of(docs)
    groups = defaultdict(list)
    for r in rows:
        groups[lower_ascii(r.text)].append(r.doc_id)
    for table in (docs, clashing):
        got = exact_dedup.mark_duplicates(table, salts=3).collect()
        assert len(got) == len(rows)
        for text, ids in groups.items():
            digest = hashlib.sha256(text.encode()).hexdigest()
            mine = [g for g in got if g.text_sha256 == digest]
            best = max((i for i in ids if i is not None), default=None)
            assert sorted((g.doc_id is None, g.doc_id) for g in mine) == sorted((i is None, i) for i in ids)
            assert {g.keep_id for g in mine} == {best} and {g.group_size for g in mine} == {len(ids)}
            assert [g.doc_id for g in mine if g.kept] == [best]


def test_exact_keeps_one_row_of_each_text_with_its_columns(clashing):
    kept = exact_dedup.drop_duplicates(clashing)
    assert kept.columns == clashing.columns
    texts = [lower_ascii(r.text) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({lower_ascii(r.text) for r in clashing.collect()})


def test_exact_hot_group(spark):
    rows = [(k, "Copy" if k % 3 else f"text {k}") for k in range(30_000)]
    got = exact_dedup.mark_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7))
    assert {tuple(r) for r in got.filter("group_size > 1").select("keep_id", "group_size").distinct().collect()} == {(29_999, 20_000)}
    assert got.count() == 30_000 and got.filter("kept").count() == 10_001


def test_empty_tables(no_docs):
    assert exact_dedup.mark_duplicates(no_docs).collect() == []
    assert simhash.mark_near_duplicates(no_docs).collect() == []
    assert suffix_dedup.remove_repeats(no_docs).collect() == []


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, near):
    root = {n: n for n in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for k, a in enumerate(nodes):
        for b in nodes[k + 1 :]:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_simhash_matches_a_plain_version(docs, clashing):
    rows = rows_of(docs)
    prints = sorted({plain_fingerprint(r.text) for r in rows})
    root = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    lowest = {}
    for r in rows:
        if r.doc_id is not None:
            c = root[plain_fingerprint(r.text)]
            lowest[c] = min(lowest.get(c, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f"{plain_fingerprint(r.text):016x}", str(lowest.get(root[plain_fingerprint(r.text)]))) for r in rows)
    for table in (docs, clashing):
        assert sorted((str(g.doc_id), g.fingerprint, str(g.component_id)) for g in simhash.mark_near_duplicates(table).collect()) == want


def test_simhash_links_chains_and_clusters(spark):
    rng = random.Random(4)
    prints = set()
    for _ in range(30):  # clusters in which many pairs are near, and chains that only steps connect
        at = rng.getrandbits(64)
        for _ in range(40):
            prints.add(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        prints |= {at ^ (1 << b) for b in range(20)}
    prints |= {rng.getrandbits(64) for _ in range(300)}
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(p,) for p in signed], "print bigint")
    links = simhash.links(table)
    assert all((a & (1 << 64) - 1 ^ b & (1 << 64) - 1).bit_count() <= 3 for a, b in links.collect())
    got = {r.node: r.root for r in simhash.components(spark, links).collect()}
    want = plain_components(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    assert {p: got.get(p, p) for p in signed} == want


def test_near_dedup_keeps_one_of_each_component(docs):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    marked = simhash.mark_near_duplicates(docs)
    assert kept.count() == marked.select("component_id").distinct().count()


def plain_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, y in zip(d, gone) if not y)
        runs = sum(1 for k in range(len(d)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_match_a_plain_version(docs, clashing):
    rows = rows_of(docs)
    want = sorted((str(r.doc_id), *x) for r, x in zip(rows, plain_repeats([r.text for r in rows], 400)))
    for table in (docs, clashing):
        got = suffix_dedup.remove_repeats(table).collect()
        assert sorted((str(g.doc_id), g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got) == want


def test_repeats_in_shared_passages(spark, monkeypatch):
    rng = random.Random(8)
    make = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passages = [make(n) for n in (380, 400, 450, 900, 2500)]
    texts = [make(rng.randint(0, 300)) + rng.choice(passages) + make(rng.randint(0, 300)) + rng.choice(passages) for _ in range(60)]
    texts += [make(30) + "x" * 1200, "x" * 500, make(900)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = [(k, *x) for k, x in enumerate(plain_repeats(texts, 400))]
    for block in (1 << 20, 3000, 1):  # 1: every anchor is divided to its end
        monkeypatch.setattr(suffix_dedup, "_BLOCK", block)
        got = suffix_dedup.remove_repeats(table).collect()
        assert sorted((g.doc_id, g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got) == want


def test_interval_expansion_on_small_alphabets():
    rng = random.Random(3)
    for _ in range(200):
        length = rng.choice([3, 5, 8])
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(length, 40))) for _ in range(rng.randint(1, 6))]
        seen = Counter(p[k : k + length] for p in parts for k in range(len(p) - length + 1))
        for p, flags in zip(parts, suffix_dedup.repeated_windows(parts, length)):
            assert flags.tolist() == [seen[p[k : k + length]] > 1 for k in range(len(p) - length + 1)]
