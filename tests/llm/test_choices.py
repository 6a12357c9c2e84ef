import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest_llm import rows_of
from pyspark.sql import functions as F

from wicketflow.llm import decision_list, html_extract, mixing, toxicity
from wicketflow.llm.common import held_out, is_held_out, table

LABELS = "doc_id bigint, quality int, toxic int"


# Quality rules.


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def random_texts(n=150):
    rng = random.Random(11)
    return [" ".join(rng.choice("a b c dd | #x é".split()) + rng.choice(["", "\n", "\t"]) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_statistics_match_a_plain_version(spark, docs):
    more = spark.createDataFrame([(100 + k, t) for k, t in enumerate(random_texts())], "doc_id bigint, text string")
    both = docs.select("doc_id", "text").union(more)
    got = sorted(str((r.doc_id, tuple(r[c] for c in decision_list.BASE))) for r in decision_list.with_statistics(both).collect())
    assert got == sorted(str((r.doc_id, plain_statistics(r.text))) for r in both.collect())


def test_windows_that_share_a_hash_are_told_apart(spark, monkeypatch):
    # With one bit of hash nearly all windows collide, so every text takes the exact way.
    weak = decision_list._REPEATED.replace("shiftleft(xxhash64(w[i], w[i+1], w[i+2]), 20)", "shiftleft(xxhash64(w[i], w[i+1], w[i+2]) & 1, 20)")
    assert weak != decision_list._REPEATED
    monkeypatch.setattr(decision_list, "_REPEATED", weak)
    df = spark.createDataFrame(list(enumerate(random_texts())), "doc_id bigint, text string")
    got = {r.doc_id: r.n_repeat_words for r in decision_list.with_statistics(df).collect()}
    assert got == {k: plain_statistics(t)[4] for k, t in enumerate(random_texts())}


def test_learned_rules_are_right_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = decision_list.judge(docs, labels).join(labels, "doc_id").filter(held_out(F.col("doc_id")) & ~F.col("base_failed"))
    counts = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    good, bad = counts.get((1, True), 0), counts.get((0, False), 0)
    assert good >= 0.98 * (good + counts.get((1, False), 0)) and bad >= 0.9 * (bad + counts.get((0, True), 0))


def test_rules_of_odd_tables(spark, docs, clashing, no_docs):
    none = spark.createDataFrame([], LABELS)
    got = decision_list.judge(docs, none).collect()
    assert len(got) == 14 and all(r.kept != r.base_failed for r in got)
    assert decision_list.judge(no_docs, none).collect() == []
    kept = decision_list.keep_good(clashing, none)
    assert kept.columns == clashing.columns and kept.count() == sum(r.kept for r in got)


def test_conditions_are_built_in_functions(spark, docs):
    labels = spark.createDataFrame([(6, 0, 0), (7, 1, 0)], LABELS)
    plan = decision_list.judge(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_learner_finds_a_conjunction():
    rng = random.Random(1)
    rows = []
    for k in range(3000):
        r = {f: rng.random() for f in decision_list.FEATURES}
        rows.append(Row(k, int(not (r["symbol_rate"] > 0.7 and r["bang_rate"] <= 0.5)), r))
    rules = decision_list.learn(rows)
    caught = lambda r: any(all(c.holds(r[c.feature]) for c in rule) for rule in rules)
    wrong = sum(caught(r) == bool(r["label"]) for r in rows)
    assert rules and wrong < 0.03 * len(rows)


class Row(tuple):
    """As much of Spark's Row as the learner uses."""

    def __new__(cls, doc_id, label, features):
        self = super().__new__(cls, (doc_id, label, *features.values()))
        self.names = {"doc_id": doc_id, "label": label, **features}
        return self

    def __getitem__(self, key):
        return self.names[key] if isinstance(key, str) else super().__getitem__(key)


# Mixing.


def test_targets_fill_up_to_their_limits(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, None: 90, "d": 0}
    got = {r.source: r for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    level_low, level_high = 0.0, 1e9
    for _ in range(200):
        level = (level_low + level_high) / 2
        if sum(min(weights[s] * level, 3 * sizes[s]) for s in sizes) < sum(sizes.values()):
            level_low = level
        else:
            level_high = level
    for s, r in got.items():
        assert r.weight == weights[s] and r.target == pytest.approx(min(weights[s] * level_low, 3 * sizes[s]))
    assert sum(r.target for r in got.values()) == pytest.approx(1600)


def test_taken_words_come_near_their_targets(spark):
    rng = random.Random(5)
    rows = [(k, "w " * int(rng.lognormvariate(4, 1)), "hot" if k % 3 else f"s{k % 7}") for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.plan_mix(docs).join(docs.select("doc_id", "source"), "doc_id")
    per = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("largest")).collect()
    for r in per:
        assert abs(r.taken - r.target) <= max(0.02 * r.target, r.largest)
    assert got.filter("taken > 3 * size OR taken % greatest(size, 1) != 0").count() == 0
    again = mixing.plan_mix(docs.repartition(5)).collect()
    assert sorted(again) == sorted(got.drop("source").collect())


def test_mix_of_odd_tables(docs, clashing, no_docs):
    assert mixing.plan_mix(no_docs).collect() == [] and mixing.plan_mix(docs).count() == 14
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns
    want = {str(r.doc_id): r.copies for r in mixing.with_copies(docs).filter("doc_id IS NOT NULL AND doc_id != 11").collect()}
    seen = Counter(str(r.doc_id) for r in mixed.collect())
    assert {k: seen.get(k, 0) for k in want} == want
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# Toxicity.


def labelled_index(rng, rows=200):
    terms = [f"t{k}" for k in range(12)]
    return toxicity.Index.build(
        terms, 1000, np.array([5.0 * k + 1 for k in range(12)]),
        [(k, k % 2, dict(Counter(rng.choices(range(12), k=rng.randint(0, 6))))) for k in range(rows)], 0.1,
    )


def test_neighbours_are_exact():
    rng = random.Random(7)
    index = labelled_index(rng)
    dense = np.zeros((len(index.ids), 12))
    for (t, b), w in index.weights.items():
        part = dense[b * 64 : (b + 1) * 64, t]
        part[:] = w[: len(part)]
    for _ in range(200):
        counts = dict(Counter(rng.choices(range(12), k=rng.randint(0, 5))))
        query = np.zeros(12)
        for t, w in index.vector(counts, index.idf).items():
            query[t] = w
        cosine = dense @ query
        want = sorted(((-round(float(c), 12), p) for p, c in enumerate(cosine) if c > 0))[:15]
        assert [(-c, p) for c, p in index.nearest(counts)] == [(pytest.approx(c, abs=1e-11), p) for c, p in want]


def test_scores_are_right_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.detect(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out")
    counts = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    hit, miss, false = counts.get((1, 1), 0), counts.get((1, 0), 0), counts.get((0, 1), 0)
    assert hit / (hit + miss) > 0.75 and false < 0.02 * sum(v for (t, _), v in counts.items() if t == 0)
    assert found.filter("predicted = 1").selectExpr("min(size(evidence))").first()[0] >= 1


def test_toxicity_of_odd_tables(spark, docs, clashing, no_docs):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.detect(docs, none).collect()} == {0.0}
    rows = [(k, 1, int(k % 2 == 0)) for k in range(1000, 1400)]
    texts = [(k, "you are a fool " * 3 if k % 2 == 0 else f"fine day {k}", "en", "a", 1) for k in range(1000, 1400)]
    labels = spark.createDataFrame(rows + rows[:3], LABELS)
    more = docs.union(spark.createDataFrame([(i, f"{k} {t}", *r) for k, (i, t, *r) in enumerate(texts)], docs.schema))
    index = toxicity.fit(more, labels)
    assert toxicity.score_documents(no_docs, index).collect() == []
    got = toxicity.score_documents(clashing, index).collect()
    assert len(got) == 14 and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id == 8] == [is_held_out(8)]


# HTML.


@pytest.fixture(scope="module")
def trained(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    return html_extract.fit(pages), [r.html for r in pages.collect()]


def plain_article(page):
    import html

    inner = page[page.find("<article>") :]
    inner = inner[: inner.find("</article>")]
    inner = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))
    return re.sub(r"\s+", " ", html.unescape(inner)).strip()


def test_pages_of_the_table(trained):
    model, pages = trained
    closed = [p for p in pages if "</article>" in p]
    assert sum(html_extract.extract(p, model) == plain_article(p) for p in closed) >= 0.97 * len(closed)


def test_pages_laid_out_anew(trained):
    model, pages = trained
    rng = random.Random(123)
    pool = [t for t in map(plain_article, pages) if t]
    exact = 0
    for _ in range(150):
        words, blocks = rng.choice(pool).split()[:1500], []
        while words:
            n = rng.randint(5, 80)
            blocks.append(" ".join(words[:n]))
            words = words[n:]
        page, _ = html_extract._layout(rng, blocks, pool)
        nodes = html_extract._marked(page)
        want = html_extract.main_text(nodes, [bool(x.label) for x in nodes])
        exact += html_extract.extract(page.replace(" data-b>", ">"), model) == want
    assert exact >= 120


def test_decoding_has_no_kept_node_in_a_dropped_one(trained):
    model, pages = trained
    rng = np.random.default_rng(1)
    nodes = html_extract.parse(pages[0])
    for _ in range(50):
        odds = rng.normal(size=len(nodes))
        kept = html_extract.decode(nodes, odds)
        assert all(kept[x.parent] for x, k in zip(nodes[1:], kept[1:]) if k)
    small = html_extract.parse("<div><p>a</p><ul><li>b</li><li>c</li></ul></div><span>d</span>")
    for _ in range(50):  # against all choices
        odds = rng.normal(size=len(small))
        worth = lambda kept: sum(o if k else -o for o, k in list(zip(odds, kept))[1:])
        best = max(
            worth(kept) for bits in range(2 ** (len(small) - 1))
            if all((kept := [True] + [bool(bits >> k & 1) for k in range(len(small) - 1)])[x.parent] or not kept[k] for k, x in enumerate(small) if k)
        )
        assert worth(html_extract.decode(small, odds)) == pytest.approx(best)


@pytest.mark.parametrize("page", ["<p>a<p>b", "x < y & z", "<a href='>'>q</a>", "<!-- <p>no</p> -->t", "<script>if (a<b) '</p>'</script>k", "<", "<>", "</p></div>", "<p", "<![CDATA[x]]>"])
def test_broken_pages_parse(page):
    nodes = html_extract.parse(page)
    assert "no" not in html_extract.main_text(nodes, [x.tag not in html_extract.NO_TEXT for x in nodes])


@pytest.mark.parametrize("page", [
    "<script>for(i=0;i<n;i++){f(i)}</script><article>k</article>", "<script>if (a<b) '</p>'</script>k", "<SCRIPT>a<b</Script >k",
    "<style>a::after{content:'<b'}</style>k", "<title>no <b</title>k", "<textarea><p>no</textarea>k", "<svg><path d='no'><p>no</svg>k",
    "<noscript><img alt='it's no'>no</noscript>k", "<template>k", "<noscript>k", "<svg>k", "<script>'</scripts>no'</script>k",
    "<script><!-- w('<script>no</script>no') --></script>k", "<script><!-- no\n</script>k",
])
def test_text_after_raw_elements_is_kept(page):
    nodes = html_extract.parse(page)
    assert html_extract.main_text(nodes, [x.tag not in html_extract.NO_TEXT for x in nodes]) == "k"


def test_long_articles_are_laid_out_whole():
    page = "<article>" + "".join(f"<p>Part number {k} of the text.</p>" for k in range(100)) + "</article>"
    anew = html_extract.training_nodes([page])[1:]
    assert any("Part number 99 of the text." in x.children for nodes in anew for x in nodes if x.label)


def test_text_of_blocks():
    nodes = html_extract.parse("<div>a<b>b</b>c<p>d&amp;amp; &eacute;&nbsp;\n e<br>f</p>g<style>x</style></div>")
    assert html_extract.main_text(nodes, [x.tag not in html_extract.NO_TEXT for x in nodes]) == "abc d&amp; é e f g"


def test_odd_page_tables(spark, trained):
    kind = "page_id bigint, url string, html string, text string"
    rows = [(1, None, None, "x"), (None, "u", "", "x"), (3, "u", "<article><p>one two three four five.</p></article>", "x")]
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_pages(spark.createDataFrame(rows, kind), trained[0]).collect()}
    assert got[1] == got[None] == ("", 0)
    assert html_extract.extract_pages(spark.createDataFrame([], kind)).collect() == []


# SQL forms.


def test_sql_forms(spark, sample_dir):
    import compare

    from wicketflow.llm import queries

    con = compare.connect(sample_dir)
    assert isinstance(con, duckdb.DuckDBPyConnection)
    for name, sql in queries.oracles().items():
        assert compare.difference(spark, con, queries.queries()[name], sql, sample_dir) is None
